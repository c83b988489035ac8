"""Second loads of the merge-type datasets: an older table version is derived
from the supplied tables, and the next load is merged into it.

Each first version differs from what the next load brings (other values, rows
still missing, rows of another source), so the result shows which rows were
updated, inserted, replaced and left alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.dedup import keep_one_per_key
from strata.operators.merge import upsert
from strata.plans import gold, history, staging
from strata.session import RunContext, today_frame
from strata.sources.tables import FrameCatalog


def orders_second_run(cat, ctx: RunContext) -> DataFrame:
    """The first run saw the lower nine tenths of the order keys,
    at prices one higher; the second run brings orders of the last days and
    with higher keys, merged on the order key."""
    seen = cat.orders.agg((F.max("o_orderkey") * 9 / 10).cast("long").alias("__to"))
    old = (cat.orders.crossJoin(F.broadcast(seen)).where("o_orderkey <= __to").drop("__to")
           .withColumn("o_totalprice", F.col("o_totalprice") + 1))
    first = staging.stg_orders_incremental(FrameCatalog(cat.spark, {"orders": old}), ctx)
    return upsert(first, staging.stg_orders_incremental(cat, ctx, existing=first), ["o_orderkey"], check_unique=False)


def customers_second_run(cat, ctx: RunContext) -> DataFrame:
    """K1/K3/K4 with the order flags in the change hash: the first load lacks
    customers whose key ends in 4 and has other balances for those ending in
    1; the second keeps surrogate keys and adds new ones above them."""
    d = F.col("c_custkey") % 10
    old = cat.customer.where(d != 4).withColumn("c_acctbal", F.when(d == 1, F.col("c_acctbal") - 100).otherwise(F.col("c_acctbal")))
    first = history.dim_customers_hashed(FrameCatalog(cat.spark, {"customer": old}, cat.sf_dir), ctx, hash_flags=True)
    return history.dim_customers_hashed(cat, ctx, existing=first, hash_flags=True)


def order_lines_second_reload(cat, ctx: RunContext) -> DataFrame:
    """The existing table holds this source's lines with other quantities
    and first lines under another source; only the former are replaced."""
    now = gold.fact_order_line_full_reload(cat, ctx)
    stale = now.withColumn("l_quantity", F.col("l_quantity") + 1)
    other = now.where("l_linenumber = 1").withColumn("source_system_code", F.lit("LEGACY"))
    return gold.fact_order_line_full_reload(cat, ctx, existing=stale.unionByName(other))


def new_customers(cat, ctx: RunContext) -> DataFrame:
    """K6 on customers: the table has the lower nine tenths of the keys."""
    return gold.dim_customers(cat, ctx, existing=cat.customer.agg((F.max("c_custkey") * 9 / 10).cast("long").alias("customer_key")))


def _seen_orders(cat) -> DataFrame:
    """Order days but for the last 30."""
    last = cat.orders.agg(F.date_sub(F.max(F.to_date("o_orderdate")), 30).alias("__to"))
    return (cat.orders.crossJoin(F.broadcast(last)).where(F.to_date("o_orderdate") <= F.col("__to"))
            .select(F.col("o_orderdate").alias("order_date")))


def new_orders(cat, ctx: RunContext) -> DataFrame:
    """K6 on orders: the table ends 30 days before the last order."""
    return gold.dim_orders(cat, ctx, existing=_seen_orders(cat))


def new_order_lines(cat, ctx: RunContext) -> DataFrame:
    """K6 on order lines."""
    return gold.fct_order_lines(cat, ctx, existing=_seen_orders(cat))


def sales_second_load(cat, ctx: RunContext, fact, load) -> DataFrame:
    """First lines of the last 60 days come again; the fact rows in the
    batch's date range are replaced by them.  ``fact`` and ``load(fact,
    staging)`` come with the caller's dimensions."""
    rows = history.staging_sales_order(cat).where("order_line_number = 1")
    batch = (rows.crossJoin(F.broadcast(today_frame(ctx, cat.orders)))
             .where(F.col("order_date") >= F.date_sub("__today", 60)).drop("__today").withColumn("batch_id", F.lit(2)))
    return load(fact, batch)


def order_lines_merged(cat, ctx: RunContext) -> DataFrame:
    """Lines with one row per (order, line), the earliest shipped,
    merged into a table that has the first lines only, tax free; the merge
    leaves the tax of lines it already has."""
    lines = keep_one_per_key(cat.lineitem, ["l_orderkey", "l_linenumber"], ["l_shipdate"])
    have = lines.where("l_linenumber = 1").withColumn("l_tax", F.lit(0.0)).withColumn("l_quantity", F.lit(0.0))
    return upsert(have, lines, ["l_orderkey", "l_linenumber"], exclude=["l_tax"], check_unique=False)
