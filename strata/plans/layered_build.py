"""Layered build with batch audit rows (3.1, K18, S10).

Each step builds one dataset and writes it under ``out_root/<layer>/<name>``;
every step appends one audit row (start, end, status, rows written, error
text).  Dimensions are written before the facts that look them up, and a
failed step stops the steps that depend on it while the audit keeps the
error.  The order is a plain list; Spark parallelises inside each step."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.plans import calendar, gold, silver, staging
from strata.session import RunContext
from strata.sources.tables import FrameCatalog

AUDIT_SCHEMA = T.StructType([
    T.StructField("batch_id", T.StringType()), T.StructField("step", T.StringType()),
    T.StructField("layer", T.StringType()), T.StructField("started_at", T.TimestampNTZType()),
    T.StructField("ended_at", T.TimestampNTZType()), T.StructField("status", T.StringType()),
    T.StructField("rows_written", T.LongType()), T.StructField("error_message", T.StringType())])

def _limit(ctx: RunContext):
    return ctx.extras.get("sample_limit")


def sampled(cat, limit: int, folder: str) -> FrameCatalog:
    """Sample mode (S3): the first ``limit`` customers and orders by key, and
    the lines of those orders.  They are written once and read by every step,
    so that all datasets of a build see the same rows; other tables stay whole."""
    spark = cat.spark

    def kept(df: DataFrame, name: str) -> DataFrame:
        path = f"{folder.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    customer = kept(cat.customer.orderBy("c_custkey").limit(limit), "customer")
    orders = kept(cat.orders.orderBy("o_orderkey").limit(limit), "orders")
    lines = kept(cat.lineitem.join(orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
                 .select(*cat.lineitem.columns), "lineitem")
    given = getattr(cat, "_frames", {})
    return FrameCatalog(spark, {**given, "customer": customer, "orders": orders, "lineitem": lines}, cat.sf_dir)


def _no_ghost(cal: DataFrame) -> DataFrame:
    return cal.where(F.col("day_key") != 0)


# (layer, name, builder(cat, ctx, inputs), names of steps it needs).  A step
# reads its upstream datasets back from their written tables (``inputs``), as
# a layered warehouse build does, so shared work (ranked segments, the
# dimensions, the line facts) is computed once.
STEPS: list[tuple[str, str, Callable, tuple[str, ...]]] = [
    ("bronze", "stg_regions", lambda c, x, i: staging.stg_regions(c, x), ()),
    ("bronze", "stg_nations", lambda c, x, i: staging.stg_nations(c, x), ()),
    ("bronze", "stg_customers", lambda c, x, i: staging.stg_customers(c, x, sample_limit=_limit(x)), ()),
    ("bronze", "stg_orders", lambda c, x, i: staging.stg_orders(c, x, sample_limit=_limit(x)), ()),
    ("bronze", "stg_lineitem", lambda c, x, i: staging.stg_lineitem(c, x), ()),
    ("bronze", "stg_fx_rates", lambda c, x, i: staging.stg_fx_rates(c, x), ()),
    ("bronze", "stg_customers_with_tests", lambda c, x, i: staging.stg_customers_with_tests(c, x), ()),
    ("bronze", "stg_orders_incremental",
     lambda c, x, i: staging.stg_orders_incremental(c, x, sample_limit=_limit(x)), ()),
    ("silver", "int_customers_with_orders", lambda c, x, i: silver.int_customers_with_orders(c, x), ()),
    ("silver", "customer_segments", lambda c, x, i: silver.customer_segments(c, x), ()),
    ("silver", "customer_clustering",
     lambda c, x, i: silver.customer_clustering_ntile(c, x, segments=i["customer_segments"]), ("customer_segments",)),
    ("silver", "order_facts_dynamic",
     lambda c, x, i: silver.order_facts(c, x, orders=i["stg_orders_incremental"]), ("stg_orders_incremental",)),
    ("silver", "clean_nations", lambda c, x, i: silver.clean_nations(c, x), ()),
    ("silver", "int_fx_rates_daily", lambda c, x, i: silver.int_fx_rates_daily(c, x, rates=i["stg_fx_rates"]),
     ("stg_fx_rates",)),
    ("gold", "dim_calendar_day", lambda c, x, i: calendar.data_calendar(c, x), ()),
    ("silver", "lookup_exchange_rates",
     lambda c, x, i: silver.lookup_exchange_rates(c, x, calendar=_no_ghost(i["dim_calendar_day"])),
     ("dim_calendar_day",)),
    ("gold", "nation_summary", lambda c, x, i: gold.nation_summary(c, x), ()),
    ("gold", "dim_customers", lambda c, x, i: gold.dim_customers(c, x), ()),
    ("gold", "dim_orders", lambda c, x, i: gold.dim_orders(c, x, customers=i["dim_customers"]), ("dim_customers",)),
    ("gold", "dim_current_year_orders",
     lambda c, x, i: gold.dim_current_year_orders(c, x, orders=i["dim_orders"]), ("dim_orders",)),
    ("gold", "customer_insights",
     lambda c, x, i: gold.customer_insights(c, x, segments=i["customer_segments"]), ("customer_segments",)),
    ("gold", "fct_order_lines", lambda c, x, i: gold.fct_order_lines(c, x, orders=i["dim_orders"]), ("dim_orders",)),
    ("gold", "fct_order_lines_by_supplier_month",
     lambda c, x, i: gold.fct_order_lines_by_supplier_month(c, x, lines=i["fct_order_lines"]), ("fct_order_lines",)),
    ("gold", "fact_order_line_pivot", lambda c, x, i: gold.fact_order_line_pivot(c, x), ()),
    ("gold", "fact_order_line_full_reload",
     lambda c, x, i: gold.fact_order_line_full_reload(c, x, orders=i["dim_orders"],
                                                      rates=i["lookup_exchange_rates"]),
     ("dim_orders", "lookup_exchange_rates")),
    ("gold", "executive_dashboard", lambda c, x, i: gold.executive_dashboard(c, x, facts=i["order_facts_dynamic"]),
     ("order_facts_dynamic",)),
    ("gold", "dim_customers_share", lambda c, x, i: gold.dim_customers_share(c, x), ()),
]


def build(cat, ctx: RunContext, out_root: str, audit_path: str, batch_id: str,
          steps=STEPS, write: Callable[[DataFrame, str], None] | None = None) -> DataFrame:
    """Run the steps in order; return the audit rows of this batch.  Each
    step's row is written as the step ends, with the whole error text.  With
    ``sample_limit`` in ``ctx.extras`` all steps read one sample (``sampled``),
    kept under ``out_root/_sample``."""
    spark = cat.spark
    if limit := _limit(ctx):
        cat = sampled(cat, limit, f"{out_root.rstrip('/')}/_sample")
    write = write or (lambda df, path: df.write.mode("overwrite").parquet(path))
    failed: set[str] = set()
    written: dict[str, str] = {}

    def log(name: str, layer: str, start: _dt.datetime, status: str, n: int | None, error: str | None) -> None:
        row = (batch_id, name, layer, start, _dt.datetime.now(), status, n, error)
        spark.createDataFrame([row], AUDIT_SCHEMA).coalesce(1).write.mode("append").parquet(audit_path)

    for layer, name, fn, needs in steps:
        start = _dt.datetime.now()
        path = f"{out_root.rstrip('/')}/{layer}/{name}"
        if failed.intersection(needs):
            log(name, layer, start, "SKIPPED", None, f"upstream failed: {sorted(failed.intersection(needs))}")
            failed.add(name)
            continue
        try:
            inputs = {n: spark.read.parquet(written[n]) for n in needs}
            write(fn(cat, ctx, inputs), path)
            written[name] = path
            n = spark.read.parquet(path).count()  # row count from the written files
            log(name, layer, start, "SUCCESS", n, None)
        except Exception as e:
            failed.add(name)
            log(name, layer, start, "FAILED", None, str(e))
    return spark.read.parquet(audit_path).where(f"batch_id = '{batch_id}'")


def main(argv: list[str] | None = None) -> None:
    """Command line: ``python -m strata.plans.layered_build --data DIR --out
    DIR [--limit N] [--as-of YYYY-MM-DD]``.  Uses the session of the
    submitting cluster when one is configured (``spark-submit``), else a
    local one.  Exits with 1 if a step failed or was skipped."""
    import argparse
    import uuid
    from pyspark.sql import SparkSession
    from strata.session import build_session, ensure_checkpoint_dir
    from strata.sources.tables import Catalog
    ap = argparse.ArgumentParser(description="layered build with audit rows")
    ap.add_argument("--data", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--limit", type=int, default=None, help="sample mode: customers and orders that all steps read")
    ap.add_argument("--as-of", default=None, help="run date; default: latest order date in the data")
    ap.add_argument("--batch-id", default=None)
    a = ap.parse_args(argv)
    spark = SparkSession.getActiveSession() or build_session()
    ensure_checkpoint_dir(spark)
    ctx = RunContext(as_of=_dt.date.fromisoformat(a.as_of) if a.as_of else None, data_clock=a.as_of is None,
                     extras={"sample_limit": a.limit})
    rows = build(Catalog(spark, a.data), ctx, a.out, a.out.rstrip("/") + "/_audit", a.batch_id or uuid.uuid4().hex)
    rows.orderBy("started_at").show(len(STEPS), truncate=False)
    if rows.where("status <> 'SUCCESS'").count():
        raise SystemExit(1)


if __name__ == "__main__":
    main()
