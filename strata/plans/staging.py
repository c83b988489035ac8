"""Bronze layer: one-to-one renames of source tables plus load stamps
(P1, P4, P5, K7, K19, S3).  Pure projections: Catalyst prunes unused columns
into the Parquet scan and pushes filters down."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import RunContext, today_frame
from strata.sources.standins import lineitem_with_dates, fx_rates
from strata.operators.dedup import keep_one_per_key


def _limit(df: DataFrame, sample_limit: int | None) -> DataFrame:
    """``sample_limit`` (S3): caps rows read when set; None reads everything."""
    return df.limit(sample_limit) if sample_limit else df


def stg_regions(cat, ctx: RunContext = RunContext()) -> DataFrame:
    return cat.region.select(F.col("r_regionkey").alias("region_key"),
                             F.col("r_name").alias("region_name"),
                             ctx.now().alias("_loaded_at"))


def stg_nations(cat, ctx: RunContext = RunContext()) -> DataFrame:
    return cat.nation.select(F.col("n_nationkey").alias("nation_key"),
                             F.col("n_name").alias("nation_name"),
                             F.col("n_regionkey").alias("region_key"),
                             ctx.now().alias("_loaded_at"))


def stg_customers(cat, ctx: RunContext = RunContext(), sample_limit: int | None = None,
                  dedup: bool = True) -> DataFrame:
    src = _limit(cat.customer, sample_limit)
    renamed = src.select(F.col("c_custkey").alias("customer_key"),
                         F.col("c_name").alias("customer_name"),
                         F.col("c_nationkey").alias("nation_key"),
                         F.col("c_acctbal").alias("account_balance"),
                         F.col("c_mktsegment").alias("market_segment"))
    if dedup:
        renamed = keep_one_per_key(renamed, ["customer_key"])
    return renamed.withColumn("_loaded_at", ctx.now())


def stg_orders(cat, ctx: RunContext = RunContext(), sample_limit: int | None = None) -> DataFrame:
    src = _limit(cat.orders, sample_limit)
    return src.select(F.col("o_orderkey").alias("order_key"),
                      F.col("o_custkey").alias("customer_key"),
                      F.col("o_orderstatus").alias("order_status"),
                      F.col("o_totalprice").alias("total_price"),
                      F.col("o_orderdate").alias("order_date"),
                      F.col("o_orderpriority").alias("order_priority"),
                      ctx.now().alias("_loaded_at"))


def stg_lineitem(cat, ctx: RunContext = RunContext()) -> DataFrame:
    li = lineitem_with_dates(cat.lineitem)
    return li.select(F.col("l_orderkey").alias("order_key"),
                     F.col("l_linenumber").alias("line_number"),
                     F.col("l_partkey").alias("part_key"),
                     F.col("l_suppkey").alias("supplier_key"),
                     F.col("l_quantity").alias("quantity"),
                     F.col("l_extendedprice").alias("extended_price"),
                     F.col("l_discount").alias("discount"),
                     F.col("l_tax").alias("tax"),
                     F.col("l_returnflag").alias("return_flag"),
                     F.col("l_linestatus").alias("line_status"),
                     F.col("l_shipdate").alias("ship_date"),
                     F.col("l_commitdate").alias("commit_date"),
                     F.col("l_receiptdate").alias("receipt_date"),
                     ctx.now().alias("_loaded_at"))


def stg_fx_rates(cat, ctx: RunContext = RunContext()) -> DataFrame:
    fx = fx_rates(cat.orders)
    return fx.withColumn("_loaded_at", ctx.now())


def quality_flag(name: str, balance: str):
    """First match wins - invalid name, then negative balance."""
    return (F.when(F.col(name).isNull() | (F.trim(F.col(name)) == ""), F.lit("INVALID_NAME"))
            .when(F.col(balance) < 0, F.lit("NEGATIVE_BALANCE"))
            .otherwise(F.lit("VALID")))


def stg_customers_with_tests(cat, ctx: RunContext = RunContext()) -> DataFrame:
    c = cat.customer.where(F.col("c_custkey").isNotNull())
    return c.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment",
                    quality_flag("c_name", "c_acctbal").alias("data_quality_flag"),
                    ctx.now().alias("extracted_at"),
                    F.lit(ctx.integration_source).alias("integration_source"),
                    F.lit(ctx.prune_days).alias("retention_days"))


# Order status code -> text, per dataset.
ORDER_STATUS_UPPER = (("O", "OPEN"), ("F", "FULFILLED"), ("P", "PARTIAL"))
ORDER_STATUS_TITLE = (("O", "Open"), ("F", "Fulfilled"), ("P", "Partial"))


def map_values(col: str, pairs, default: str):
    """P2 value-mapping CASE."""
    expr = None
    for code, text in pairs:
        expr = (F.when(F.col(col) == code, F.lit(text)) if expr is None
                else expr.when(F.col(col) == code, F.lit(text)))
    return expr.otherwise(F.lit(default))


def stg_orders_incremental(cat, ctx: RunContext = RunContext(), existing: DataFrame | None = None,
                           sample_limit: int | None = None) -> DataFrame:
    """K7: first run loads everything as FULL_LOAD.  Later runs take orders in
    the last ``prune_days`` before ``as_of`` (RECENT) or with a key above the
    stored maximum (HISTORICAL); the caller upserts the batch by o_orderkey
    (``strata.operators.merge.upsert``).  The filter comes before any limit."""
    o = cat.orders
    base_cols = [F.col(c) for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                    "o_orderdate", "o_orderpriority")]
    derived = [map_values("o_orderstatus", ORDER_STATUS_UPPER, "UNKNOWN").alias("order_status_desc"),
               F.to_date(F.date_trunc("month", "o_orderdate")).alias("order_month"),
               F.year("o_orderdate").alias("order_year"),
               F.quarter("o_orderdate").alias("order_quarter"),
               ctx.now().alias("processed_at")]
    if existing is None:
        return _limit(o.select(*base_cols, *derived, F.lit("FULL_LOAD").alias("processing_type")), sample_limit)
    cutoff = F.date_sub("__today", ctx.prune_days)
    max_key = existing.agg(F.coalesce(F.max("o_orderkey"), F.lit(0)).alias("__max_key"))
    batch = (o.crossJoin(F.broadcast(max_key)).crossJoin(F.broadcast(today_frame(ctx, o)))  # one-row scalars
             .where((F.to_date("o_orderdate") >= cutoff) | (F.col("o_orderkey") > F.col("__max_key"))))
    ptype = F.when(F.to_date("o_orderdate") >= cutoff, F.lit("RECENT")).otherwise(F.lit("HISTORICAL"))
    return _limit(batch.select(*base_cols, *derived, ptype.alias("processing_type")), sample_limit)
