"""Datasets over the point-in-time, sketch, digest, lease and checked-write
operators.  Inputs the supplied tables lack are formulas over them."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.dates import greatest_date
from strata.functions.numeric import money_sum
from strata.operators import quality as Q
from strata.operators.bulk import run_statements, statements_from
from strata.operators.interval_join import as_of_merge
from strata.operators.keys import lease_keys, surrogate_hash_key
from strata.operators.snapshots import snapshot_change_feed, write_snapshot
from strata.plans import gold, history, reports
from strata.session import RunContext, ensure_checkpoint_dir
from strata.sources.tables import FrameCatalog


def _folder(cat, name: str) -> str:
    """A new folder in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(cat.spark)}/{name}-{uuid.uuid4().hex}"


def customer_versions(cat) -> DataFrame:
    """Six versions of each customer, 400 days apart from a day in 1995 that
    depends on the key; those of every fifth customer end ten days before the
    next one begins."""
    k, v = F.col("c_custkey"), F.col("version")
    begins = F.date_add(F.lit(dt.date(1995, 1, 1)), (v * 400 + (k * 37) % 300).cast("int"))
    ends = F.date_add(begins, F.when(k % 5 == 0, 389).otherwise(399))
    return (cat.customer.select("c_custkey", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("version"))
            .select(F.col("c_custkey").alias("customer_key"), "version", begins.alias("valid_from"),
                    F.when(v < 5, ends).alias("valid_to")))


def order_customer_versions(cat, ctx: RunContext = RunContext()) -> DataFrame:
    """J14 over days: each order with the customer version valid on its day."""
    o = cat.orders.select(F.col("o_orderkey").alias("order_key"), F.col("o_custkey").alias("customer_key"),
                          F.to_date("o_orderdate").alias("order_date"))
    return as_of_merge(o, "customer_key", "order_date", customer_versions(cat).withColumnRenamed("customer_key", "__ck"), "__ck",
                       "valid_from", "valid_to", payload=["version", "valid_from"], prefix="customer_")


def event_last_purchase(cat, ctx: RunContext = RunContext()) -> DataFrame:
    """J14 over timestamps: each event with its user's last purchase up to it."""
    e = cat.events.select("event_id", "user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_type", "value")
    bought = e.where("event_type = 'purchase'").select(F.col("user_id").alias("__u"), F.col("ts").alias("at"), F.col("event_id").alias("purchase"), F.col("value").alias("amount"))
    return as_of_merge(e.select("event_id", "user_id", "ts", "event_type"), "user_id", "ts", bought, "__u", "at", payload=["purchase", "amount", "at"], prefix="last_")


def supplier_month_sketches(cat, ctx: RunContext = RunContext(), lines: DataFrame | None = None, lg_k: int = 12) -> DataFrame:
    """A3/A7 roll-up that can be rolled up again: additive sums and a
    HyperLogLog sketch of the orders per supplier and month."""
    fol = lines if lines is not None else gold.fct_order_lines(cat, ctx)
    return (fol.groupBy("supplier_key", F.year("order_date").alias("order_year"), F.month("order_date").alias("order_month"))
            .agg(F.count(F.lit(1)).alias("total_order_lines"), F.hll_sketch_agg("order_key", lg_k).alias("orders_sketch")))


def roll_up(sketches: DataFrame, *by: str) -> DataFrame:
    """Coarser groups from the kept roll-up; the lines are not read."""
    return sketches.groupBy(*by).agg(F.sum("total_order_lines").alias("total_order_lines"),
                                     F.hll_union_agg("orders_sketch").alias("orders_sketch"))


def supplier_orders_by_sketch(cat, ctx: RunContext = RunContext(), lg_k: int = 12) -> DataFrame:
    """Orders per supplier and year (0: all years) from monthly sketches kept
    as a table, beside the exact count, and whether they agree within four
    standard errors (1.04 / sqrt(2^lg_k) each, 6.5 % in all) and one order."""
    lines = gold.fct_order_lines(cat, ctx)
    path = _folder(cat, "supplier-months")
    supplier_month_sketches(cat, ctx, lines, lg_k).write.parquet(path)
    kept = cat.spark.read.parquet(path)
    every = kept.withColumn("order_year", F.lit(0))
    rolled = roll_up(kept, "supplier_key", "order_year").unionByName(roll_up(every, "supplier_key", "order_year"))
    both = lines.select("supplier_key", "order_key", F.explode(F.array(F.year("order_date"), F.lit(0))).alias("order_year"))
    exact = both.groupBy("supplier_key", "order_year").agg(F.count_distinct("order_key").alias("total_orders"))
    error = 4 * 1.04 / (2 ** lg_k) ** 0.5
    close = F.abs(F.hll_sketch_estimate("orders_sketch") - F.col("total_orders")) <= F.col("total_orders") * error + 1
    return (rolled.join(exact, ["supplier_key", "order_year"])
            .select("supplier_key", "order_year", "total_order_lines", "total_orders", close.alias("sketch_within_error")))


def customer_change_feed_by_digest(cat, ctx: RunContext = RunContext()) -> DataFrame:
    """K9 between two stored loads: buckets with equal digests are not read."""
    old, new = _folder(cat, "customers-1"), _folder(cat, "customers-2")
    for path, n in ((old, 1), (new, 2)):
        write_snapshot(history.customer_load(cat, n), path, ["customer_key"], buckets=64)
    return snapshot_change_feed(cat.spark, old, new, ["customer_key"], F.lit(history.LOAD_TS[1]).cast("timestamp_ntz"), version=F.lit("2"))


def leased_order_keys(cat, ctx: RunContext = RunContext()) -> DataFrame:
    """K3 by leased blocks: the upper tenth of the orders gets keys above the
    mark of the others; how many, how many different, and whether all are above."""
    mark = cat.orders.agg((F.max("o_orderkey") * 9 / 10).cast("long").alias("__to"))
    o = cat.orders.crossJoin(F.broadcast(mark))  # one row
    old = o.where("o_orderkey <= __to").select(F.col("o_orderkey").alias("order_wid"))
    new = lease_keys(o.where("o_orderkey > __to").select("o_orderkey"), "order_wid", old, block=100)
    top = old.agg(F.max("order_wid").alias("__top"))
    return new.crossJoin(F.broadcast(top)).agg(F.count("*").alias("new_rows"), F.count_distinct("order_wid").alias("different_keys"),
                                              F.min(F.col("order_wid") > F.col("__top")).alias("all_above_the_mark"))


def isolated_statements(cat, ctx: RunContext = RunContext()) -> DataFrame:
    """M4: one statement per market segment, each in a job of its own; that of
    AUTOMOBILE divides by zero while it runs and costs only itself."""
    cat.customer.createOrReplaceTempView("statement_customer")
    wanted = cat.customer.select("c_mktsegment").distinct().select(F.concat(
        F.lit("SELECT c_mktsegment AS market_segment, count(*) AS customers, max(c_custkey div (CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN c_custkey - c_custkey "
              "ELSE 1 END)) AS last_key FROM statement_customer WHERE c_mktsegment = '"), F.col("c_mktsegment"), F.lit("' GROUP BY c_mktsegment")))
    path = _folder(cat, "statements")
    errors = run_statements(cat.spark, statements_from(wanted), path)
    done = cat.spark.read.schema("market_segment string, customers long, last_key long, statement_index int").parquet(path).drop("statement_index")
    failed = errors.select(F.regexp_extract("statement", "WHERE c_mktsegment = '([^']*)'", 1).alias("market_segment"), F.lit(None).cast("long").alias("customers"),
                           F.lit(None).cast("long").alias("last_key"), F.col("error").contains("DIVIDE_BY_ZERO").alias("failed"))
    return done.withColumn("failed", F.lit(False)).unionByName(failed)


def order_lines_checked(cat, ctx: RunContext = RunContext()) -> DataFrame:
    """D5, D7, D8 in the write: the lines written with their checks in one
    scan; what was written, per flag set, and what the scan counted."""
    checks = [("quantity_over_45", Q.range_pred("l_quantity", max_value=45)), ("discounted", Q.expression_pred("l_discount < 0.08")),
              ("flag_known", Q.accepted_values_pred("l_returnflag", ["A", "N"]))]
    path = _folder(cat, "lines")
    counts = Q.write_checked(cat.lineitem, checks, path)
    written = cat.spark.read.parquet(path).withColumn("quarantined", F.col("quarantined").cast("boolean"))
    counted = F.create_map(*[x for k, v in counts.items() for x in (F.lit(k), F.lit(v).cast("long"))])
    per = written.select("quarantined", F.explode_outer("failed_checks").alias("check_name"), "l_quantity")
    return (per.groupBy("quarantined", "check_name").agg(F.count("*").alias("rows_written"), money_sum("l_quantity").alias("quantity"))
            .withColumn("rows_counted", F.element_at(counted, F.coalesce("check_name", F.lit("rows")))))


def orders_freshness(cat, ctx: RunContext = RunContext()) -> DataFrame:
    """D12 per order status: age of the newest order against the newest of all."""
    out = None
    now = cat.orders.agg(F.max("o_orderdate")).first()[0]
    for s in ("F", "O", "P"):
        one = Q.freshness(cat.orders.where(F.col("o_orderstatus") == s), "o_orderdate", F.lit(now), dt.timedelta(0), dt.timedelta(days=1))
        one = one.select(F.lit(s).alias("order_status"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def negative_balance_share(cat, ctx: RunContext = RunContext()) -> DataFrame:
    """A13/D11/U4 with a threshold that the data exceeds."""
    return reports.customer_balance_distribution(cat, ctx, threshold_pct=1.0)


def customers_share_developer(cat, ctx: RunContext = RunContext()) -> DataFrame:
    """P11 for a role that sees hashes."""
    return gold.dim_customers_share(cat, ctx, role="DEVELOPER")


def line_surrogate_keys(cat, ctx: RunContext = RunContext()) -> DataFrame:
    """K20 md5 keys of order lines, and the greatest of their dates."""
    return cat.lineitem.select("l_orderkey", "l_linenumber", surrogate_hash_key("l_orderkey", "l_linenumber", F.nullif(F.col("l_returnflag"), F.lit("N"))).alias("line_key"),
                               greatest_date(F.to_date("l_shipdate"), F.when(F.col("l_returnflag") == "R", F.date_add(F.to_date("l_shipdate"), 9))).alias("last_date"))


def orders_open_or_recent(cat, ctx: RunContext = RunContext()) -> DataFrame:
    """K8 on a later run: the table holds every order as fulfilled and one
    dearer; only open or recent orders are taken up again."""
    first = history.dim_orders_macro_example(FrameCatalog(cat.spark, {
        "orders": cat.orders.withColumn("o_totalprice", F.col("o_totalprice") + 1), "customer": cat.customer, "nation": cat.nation}, cat.sf_dir), ctx)
    later = history.dim_orders_macro_example(cat, ctx, existing=first)
    return later.where("o_orderkey is not null").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_cust_wid")


