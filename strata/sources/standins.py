"""Inputs the reference reads but the supplied tables lack (see FIXTURES.md §3).

Each stand-in is *derived from the supplied tables by Spark*, so its size
follows the data, and each is a deterministic formula DuckDB can reproduce.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lineitem_with_dates(lineitem: DataFrame) -> DataFrame:
    """Adds commit and receipt dates as fixed offsets of the ship date."""
    ship = F.to_date("l_shipdate")
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    return lineitem.select(
        "*",
        F.date_add(ship, ((k * 7 + n * 3) % 21 - 10).cast("int")).alias("l_commitdate"),
        F.date_add(ship, (F.lit(1) + (k + n * 5) % 30).cast("int")).alias("l_receiptdate"),
    )


def partsupp(lineitem: DataFrame) -> DataFrame:
    """PARTSUPP: one row per (part, supplier) seen in lineitem, supply cost =
    cheapest unit price.  groupBy with map-side partial aggregation."""
    return (lineitem.where(F.col("l_quantity") > 0)
            .groupBy(F.col("l_partkey").alias("ps_partkey"), F.col("l_suppkey").alias("ps_suppkey"))
            .agg(F.min(F.col("l_extendedprice") / F.col("l_quantity")).alias("ps_supplycost")))


# Currencies of the FX stand-in and the rate rule per currency
# (base rate, multiplier); rate = base + ((week_index * multiplier) % 100) / 1000.
FX_QUOTES = (("EUR", 0.8, 37), ("GBP", 0.6, 53))


def fx_rates(orders: DataFrame) -> DataFrame:
    """Weekly USD-based FX rates spanning the order dates (S19 stand-in).

    Columns follow the seed contract: rate_date date, base_currency,
    quote_currency, exchange_rate decimal(18,6).  The week grid is derived
    from min/max order date with a one-row aggregate, then exploded: its size
    is (date span / 7) x currencies, independent of the order count.
    """
    span = orders.agg(F.min(F.to_date("o_orderdate")).alias("d0"),
                      F.max(F.to_date("o_orderdate")).alias("d1"))
    days = span.select("d0", F.explode(F.sequence("d0", "d1", F.expr("INTERVAL 7 DAYS"))).alias("rate_date"))
    days = days.withColumn("i", (F.datediff("rate_date", "d0") / 7).cast("long"))
    quotes = [F.struct(F.lit(q).alias("q"), F.lit(b).alias("b"), F.lit(m).alias("m")) for q, b, m in FX_QUOTES]
    rows = days.select("rate_date", "i", F.explode(F.array(*quotes)).alias("c"))
    rate = (F.col("c.b").cast("decimal(18,6)")
            + ((F.col("i") * F.col("c.m")) % 100).cast("decimal(18,6)") / F.lit(1000).cast("decimal(18,6)"))
    return rows.select(
        "rate_date",
        F.lit("USD").alias("base_currency"),
        F.col("c.q").alias("quote_currency"),
        rate.cast("decimal(18,6)").alias("exchange_rate"),
    )


def _seed(spark: SparkSession, rows, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def capacity_seed(spark: SparkSession) -> DataFrame:
    """Capacity seed (S2): compute sizes and the scanned-bytes each can hold.
    Fixed values (reference seed, names generalised)."""
    schema = T.StructType([T.StructField("warehouse_name", T.StringType()),
                           T.StructField("warehouse_size", T.StringType()),
                           T.StructField("capacity", T.LongType())])
    rows = [("xsmall_wh", "xsmall", 10000000), ("small_wh", "small", 100000000),
            ("medium_wh", "medium", 200000000), ("large_wh", "large", 400000000),
            ("xlarge_wh", "xlarge", 800000000), ("xxlarge_wh", "xxlarge", 100000000000)]
    return _seed(spark, rows, schema)


def override_seed(spark: SparkSession) -> DataFrame:
    schema = T.StructType([T.StructField("target_name", T.StringType()),
                           T.StructField("full_refresh_warehouse", T.StringType()),
                           T.StructField("incremental_warehouse", T.StringType())])
    return _seed(spark, [("DB.SCHEMA.TABLE", "my_warehouse", "my_warehouse")], schema)


def read_seed_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Typed CSV seed load."""
    return spark.read.schema(schema).option("header", True).csv(path)


# Compute sizes given to run-log rows by user_id % 4 (mixed case
# on purpose: the reference upper-cases before its size lookup).
RUN_LOG_SIZES = ("x-small", "Small", "MEDIUM", "large")
# Application name the build tool puts in its query tags (the history keeps
# only that application's queries).
BUILD_APP = "build"


def run_log(events: DataFrame) -> DataFrame:
    """Run log (S9 stand-in) derived row by row from ``events``: one logged
    query per event.  The tag is JSON text like the reference's query tag;
    ``objects_modified`` is a JSON array like its access history.  A pure
    projection: no shuffle, one output row per input row."""
    uid, v = F.col("user_id"), F.col("value")
    size = F.when(uid % 4 == 0, RUN_LOG_SIZES[0]).when(uid % 4 == 1, RUN_LOG_SIZES[1]) \
        .when(uid % 4 == 2, RUN_LOG_SIZES[2]).otherwise(RUN_LOG_SIZES[3])
    app = F.when(F.col("event_type") == "error", "other").otherwise(BUILD_APP)
    incr = (F.when(F.col("event_type").isin("click", "view"), "true")
            .when(F.col("event_type") == "signup", "false").otherwise("maybe"))
    target = F.concat(F.lit("db.analytics.model_"), (uid % 25).cast("string"))
    tag = F.concat(
        F.lit('{"app": "'), app, F.lit('", "target_name": "'), target,
        F.lit('", "module_name": "'), F.col("event_type"),
        F.lit('", "module_details": {"is_incremental": "'), incr,
        F.lit('"}, "run_id": "run_'), F.date_format("ts", "yyyyMMdd"), F.lit('", "props": '), F.col("props"),
        F.lit("}"))
    objects = F.concat(F.lit('[{"objectName": "'), target, F.lit('", "objectDomain": "table"}]'))
    ms = lambda factor: F.floor(v * factor).cast("long")
    return events.select(
        F.col("event_id").alias("query_id"), F.col("ts").alias("start_time"),
        ms(1000).alias("total_elapsed_time"), ms(100).alias("compilation_time"), ms(900).alias("execution_time"),
        size.alias("warehouse_size"), ms(1_000_000).alias("bytes_scanned"), ms(1).alias("partitions_scanned"),
        tag.alias("query_tag"), objects.alias("objects_modified"))
