"""Run-log analytics: query history with parsed tags (S7, S9, JSON paths,
K6), capacity assignment (J7, A11, U1), training history (J16) and a
per-series one-step forecast (M5, re-aimed from a hosted model)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import RunContext
from strata.sources.standins import BUILD_APP, capacity_seed, override_seed, run_log

# Compute size -> (nodes, vCPUs), the reference's inline table.
WAREHOUSE_SIZES = (
    ("X-SMALL", 1, 8), ("SMALL", 2, 16), ("MEDIUM", 4, 32), ("LARGE", 8, 64), ("X-LARGE", 16, 128),
    ("2X-LARGE", 32, 256), ("3X-LARGE", 64, 512), ("4X-LARGE", 128, 1024), ("5X-LARGE", 256, 2048),
    ("6X-LARGE", 512, 4096),
)

MAX_SEED_ROWS = 10_000  # seeds are configuration; broadcast only under this bound


def warehouse_sizes(spark: SparkSession) -> DataFrame:
    """S7 inline VALUES table."""
    schema = T.StructType([T.StructField("warehouse_size", T.StringType()),
                           T.StructField("warehouse_nodes", T.IntegerType()),
                           T.StructField("warehouse_vcpu", T.IntegerType())])
    return spark.createDataFrame(list(WAREHOUSE_SIZES), schema)


def bounded_broadcast(df: DataFrame, max_rows: int = MAX_SEED_ROWS, what: str = "seed") -> DataFrame:
    """Broadcast a configuration table after proving its size (one count
    job).  Tables over the bound are returned unhinted so the planner falls
    back to a shuffle join."""
    n = df.count()
    return F.broadcast(df) if n <= max_rows else df


def _log_clock(log: DataFrame, ctx: RunContext) -> DataFrame:
    """One-row frame ``__today``: ``ctx.as_of``, or with ``data_clock`` the
    latest logged day (the log's own clock, like current_date on live data)."""
    if ctx.as_of is None and ctx.data_clock:
        return log.agg(F.max(F.to_date("start_time")).alias("__today"))
    return log.sparkSession.range(1).select(ctx.today().alias("__today"))


def query_history(cat, ctx: RunContext = RunContext(), existing: DataFrame | None = None,
                  log: DataFrame | None = None, app: str = BUILD_APP) -> DataFrame:
    """Parsed run log.  The tag is parsed once into a VARIANT
    (``try_parse_json``, bad JSON -> null) and read with typed paths;
    the size lookup is a broadcast of the fixed 10-row table.  With
    ``existing`` only rows newer than its latest start_time are returned (K6),
    the high-water mark being a one-row aggregate joined in-plan."""
    spark = cat.spark
    qh = log if log is not None else run_log(cat.events)
    if existing is not None:
        hw = existing.agg(F.max("start_time").alias("__hw"))
        qh = qh.crossJoin(F.broadcast(hw)).where(F.col("__hw").isNull() | (F.col("start_time") > F.col("__hw"))) \
            .drop("__hw")
    qt = F.col("__qt")
    path = lambda p: F.try_variant_get(qt, p, "string")
    parsed = qh.withColumn("__qt", F.try_parse_json("query_tag"))
    ws = F.broadcast(warehouse_sizes(spark)).alias("ws")
    j = parsed.alias("qh").join(ws, F.col("ws.warehouse_size") == F.upper(F.col("qh.warehouse_size")), "left")
    out = j.select(
        F.col("qh.query_id").alias("query_id"), F.col("qh.start_time").alias("start_time"),
        (F.col("qh.total_elapsed_time") / 1000).alias("total_elapsed_sec"),
        F.upper(path("$.target_name")).alias("target_name"),
        F.expr("try_cast(try_variant_get(__qt, '$.module_details.is_incremental', 'string') AS BOOLEAN)")
        .alias("is_incremental"),
        path("$.app").alias("app"), path("$.module_name").alias("module_name"),
        path("$.run_id").alias("run_id"),
        (F.col("qh.compilation_time") / 1000).alias("compilation_sec"),
        (F.col("qh.execution_time") / 1000).alias("execution_sec"),
        F.coalesce(F.col("qh.execution_time") / (1000 * 60 * 60) * F.col("ws.warehouse_nodes"), F.lit(0.0))
        .alias("relative_performance_cost"),
        F.col("ws.warehouse_size").alias("warehouse_size"), F.col("ws.warehouse_nodes").alias("warehouse_nodes"),
        F.col("ws.warehouse_vcpu").alias("warehouse_vcpu"),
        F.col("qh.warehouse_size").alias("query_warehouse_size"),
        F.col("qh.bytes_scanned").alias("bytes_scanned"),
        F.col("qh.partitions_scanned").alias("partitions_scanned"),
    )
    return out.where(F.col("app") == app)


def capacity_assignment(cat, ctx: RunContext = RunContext(), history: DataFrame | None = None,
                        capacities: DataFrame | None = None, overrides: DataFrame | None = None,
                        lookback_days: int = 30, confidence: float = 0.85) -> DataFrame:
    """J7 smallest capacity that fits, per target.

    Per target the largest scan (and largest incremental scan, else the
    largest scan: A11) is one hash aggregate.  Each maximum then needs the
    smallest capacity strictly above it: the exact ordered lookup
    ``smallest_above`` whatever the sizes (the reference's double join +
    row_number picks the same pair, since both orders are independent).
    Targets with an override are excluded by an anti join and the overrides appended (U1)."""
    spark = cat.spark
    qh = history if history is not None else query_history(cat, ctx)
    caps = capacities if capacities is not None else capacity_seed(spark)
    ov = (overrides if overrides is not None else override_seed(spark)).select(
        F.upper("target_name").alias("target_name"), "full_refresh_warehouse", "incremental_warehouse")
    today = _log_clock(qh, ctx)
    recent = (qh.crossJoin(F.broadcast(today))
              .where(F.col("target_name").isNotNull() & F.col("is_incremental").isNotNull()
                     & (F.col("bytes_scanned") > 0)
                     & (F.col("start_time") > F.date_sub(F.col("__today"), lookback_days).cast("timestamp_ntz")))
              .drop("__today"))
    recent = recent.join(bounded_broadcast(ov.select("target_name")), "target_name", "left_anti")
    mx = recent.groupBy("target_name").agg(
        F.max("bytes_scanned").alias("max_bytes_scanned"),
        F.max(F.when(F.col("is_incremental"), F.col("bytes_scanned"))).alias("__max_inc"))
    mx = mx.withColumn("max_incremental_bytes_scanned", F.coalesce("__max_inc", "max_bytes_scanned")).drop("__max_inc")
    cap = caps.select("warehouse_name", "capacity")
    from strata.operators.interval_join import smallest_above

    def smallest_fit(value_col: str, name: str) -> DataFrame:
        m = smallest_above(mx.select("target_name", value_col), value_col, cap, "capacity", ["warehouse_name"])
        return m.where(F.col("warehouse_name").isNotNull()).select("target_name", F.col("warehouse_name").alias(name))

    best = smallest_fit("max_bytes_scanned", "full_refresh_warehouse").join(
        smallest_fit("max_incremental_bytes_scanned", "incremental_warehouse"), "target_name", "inner")
    combined = ov.unionByName(best)
    return combined.select(
        F.col("target_name").alias("model_name"),
        F.coalesce("full_refresh_warehouse", "incremental_warehouse").alias("recommended_warehouse"),
        F.lit(confidence).alias("confidence_score"),
    ).orderBy("model_name")


def training_history(cat, ctx: RunContext = RunContext(), log: DataFrame | None = None,
                     lookback_days: int = 7) -> DataFrame:
    """The largest scan per (target, incremental flag, day) over the
    last ``lookback_days``.  The target comes from the tag, else from the
    modified objects (a JSON array exploded: lateral flatten), matched by
    query id and start time."""
    lg = log if log is not None else run_log(cat.events)
    today = F.broadcast(_log_clock(lg, ctx))
    since = F.date_sub(F.col("__today"), lookback_days).cast("timestamp_ntz")
    qt = F.try_parse_json("query_tag")
    q = (lg.crossJoin(today).where((F.col("start_time") >= since) & (F.col("partitions_scanned") > 0))
         .select("query_id", "start_time", "partitions_scanned",
                 F.upper(F.try_variant_get(qt, "$.target_name", "string")).alias("target_name"),
                 F.expr("try_cast(try_variant_get(try_parse_json(query_tag), "
                        "'$.module_details.is_incremental', 'string') AS BOOLEAN)").alias("is_incremental")))
    obj_schema = T.ArrayType(T.StructType([T.StructField("objectName", T.StringType()),
                                          T.StructField("objectDomain", T.StringType())]))
    ah = (lg.crossJoin(today).where(F.col("start_time") >= since)
          .select(F.col("query_id").alias("ah_query_id"), F.col("start_time").alias("query_start_time"),
                  F.explode(F.from_json("objects_modified", obj_schema)).alias("w"))
          .select("ah_query_id", "query_start_time", F.upper("w.objectName").alias("ah_target_name"),
                  F.upper("w.objectDomain").alias("target_type")))
    j = q.join(ah, (F.col("ah_query_id") == F.col("query_id")) & (F.col("query_start_time") == F.col("start_time")),
               "left")
    j = j.where(F.col("is_incremental").isNotNull() | F.col("ah_target_name").isNotNull())
    return j.groupBy(
        F.coalesce("target_name", "ah_target_name").alias("target_name"),
        F.coalesce("is_incremental", F.lit(False)).alias("is_incremental"),
        F.to_date("start_time").alias("query_date"),
    ).agg(F.max("partitions_scanned").alias("partitions_scanned"))


def scan_forecast(cat, ctx: RunContext = RunContext(), history: DataFrame | None = None) -> DataFrame:
    """M5 one-step forecast per series (target, incremental flag): a
    least-squares line over (day number, partitions scanned), evaluated one
    day after the series' last day.  One grouped aggregate (regr_* are
    algebraic, so they combine map-side); series with one point predict
    their mean."""
    h = history if history is not None else training_history(cat, ctx)
    x = F.datediff("query_date", F.lit(dt.date(1970, 1, 1))).cast("double")
    y = F.col("partitions_scanned").cast("double")
    h = h.select("target_name", "is_incremental", "query_date", x.alias("x"), y.alias("y"))
    g = h.groupBy("target_name", "is_incremental").agg(
        F.max("query_date").alias("last_date"), F.count(F.lit(1)).alias("n_points"),
        F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept"),
        F.avg("y").alias("mean_y"), F.max("x").alias("last_x"))
    pred = F.when(F.col("slope").isNotNull(), F.col("intercept") + F.col("slope") * (F.col("last_x") + 1)) \
        .otherwise(F.col("mean_y"))
    return g.select("target_name", "is_incremental", F.date_add("last_date", 1).alias("forecast_date"),
                    "n_points", F.round("slope", 6).alias("slope"),
                    F.round(pred, 4).alias("forecast_partitions_scanned"))


def query_history_table(cat, ctx: RunContext = RunContext(), existing: DataFrame | None = None,
                        full_refresh: bool = False, allow_full_refresh: bool = False,
                        log: DataFrame | None = None) -> DataFrame:
    """Next version of the stored query history.  The history is kept
    across full rebuilds unless ``allow_full_refresh`` (S17: a requested full
    refresh is ignored by default); otherwise only rows newer than the stored
    maximum are appended (K6), and the stored columns follow the new schema
    (S16 ``sync_all_columns``)."""
    from strata.operators.merge import evolve_schema
    if existing is None or (full_refresh and allow_full_refresh):
        return query_history(cat, ctx, log=log)
    new = query_history(cat, ctx, existing=existing, log=log)
    return evolve_schema(existing, new, "sync_all_columns").unionByName(new)
