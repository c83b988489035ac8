"""A periodically refreshed aggregate (the order facts "dynamic
table") as a Structured Streaming job.

New order files land in a folder; an order that changes lands again.  The
stream keeps the newest image of each order in its state and turns arrivals
into signed deltas (``order_deltas``).  Each micro-batch adds its own deltas to
the partials and replaces the facts of the months it touched (dynamic
partition overwrite; a month that lost its last order is dropped), so it reads
its own rows and the partials of those months, never the landed files.  A
replayed batch rewrites identical partitions, so the sink is idempotent; read
position and state live in the checkpoint.  Each batch appends one row to the
refresh history (T4).  For large states set
``spark.sql.streaming.stateStore.providerClass`` to the RocksDB provider.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.plans import silver, staging
from strata.session import RunContext
from strata.sources.tables import SCHEMAS, FrameCatalog
from strata.streaming import order_deltas
from strata.streaming.sinks import drop_partitions, overwrite_partitions, path_exists

HISTORY_SCHEMA = T.StructType([
    T.StructField("batch_id", T.LongType()), T.StructField("input_rows", T.LongType()),
    T.StructField("months_refreshed", T.IntegerType()), T.StructField("refresh_start", T.TimestampNTZType()),
    T.StructField("refresh_end", T.TimestampNTZType())])


def order_facts_for(orders: DataFrame, ctx: RunContext = RunContext()) -> DataFrame:
    """order_facts over an arbitrary raw orders frame, partitioned by month."""
    cat = FrameCatalog(orders.sparkSession, {"orders": orders})
    facts = silver.order_facts(cat, ctx, orders=staging.stg_orders_incremental(cat, ctx))
    return facts.withColumn("order_month_start", F.trunc("order_date", "month"))


def refresh_batch(deltas: DataFrame, batch_id: int, *, target_path: str, partials_path: str,
                  history_path: str | None, ctx: RunContext = RunContext()) -> None:
    """Adds the batch's signed deltas and replaces the facts of its months."""
    spark = deltas.sparkSession
    start = _dt.datetime.now()
    order_deltas.write_partials(deltas, partials_path, batch_id)  # the only pass over the batch
    months = order_deltas.touched_months(spark, partials_path, batch_id)
    if months:
        images = order_deltas.images(order_deltas.read_partials(spark, partials_path, months))
        overwrite_partitions(order_facts_for(images, ctx), target_path, ["order_month_start"])
        left = {r[0] for r in images.select(F.trunc(F.to_date("o_orderdate"), "month")).distinct().collect()}
        drop_partitions(spark, target_path, "order_month_start",
                        ["__HIVE_DEFAULT_PARTITION__" if m is None else m for m in months if m not in left])
    if history_path and not _history_has(spark, history_path, batch_id):  # a replay adds no second row
        row = [(int(batch_id), order_deltas.images_in(spark, partials_path, batch_id), len(months), start, _dt.datetime.now())]
        spark.createDataFrame(row, HISTORY_SCHEMA).write.mode("append").parquet(history_path)


def _history_has(spark: SparkSession, history_path: str, batch_id: int) -> bool:
    if not path_exists(spark, history_path):
        return False
    hist = spark.read.schema(HISTORY_SCHEMA).parquet(history_path)
    return hist.where(F.col("batch_id") == int(batch_id)).limit(1).count() > 0


def start_order_facts_refresh(spark: SparkSession, landing_dir: str, target_path: str, checkpoint_dir: str, *,
                              history_path: str | None = None, ctx: RunContext = RunContext(),
                              every: str | None = "1 hour", available_now: bool = False,
                              max_files_per_trigger: int | None = None, partials_path: str | None = None,
                              version: str | None = None):
    """Start the refresh stream.  ``every`` = processing-time trigger (the
    hourly target lag); ``available_now=True`` processes what has landed and
    stops (T2: refresh on demand, before a dependent job).  ``version`` names
    a long column of the landed files that orders the images of an order;
    without it the later batch counts.  Partials go to ``partials_path``
    (beside the target unless given)."""
    schema = SCHEMAS["orders"]
    if version:
        schema = T.StructType([*schema.fields, T.StructField(version, T.LongType())])
    partials = partials_path or f"{target_path.rstrip('/')}.partials"
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(landing_dir)
    deltas = order_deltas.signed_deltas(stream, F.col(version) if version else None)
    w = (deltas.writeStream.outputMode("update").queryName(f"order_facts_refresh_{abs(hash(target_path)) % 10**6}")
         .option("checkpointLocation", checkpoint_dir)
         .foreachBatch(lambda df, bid: refresh_batch(df, bid, target_path=target_path, partials_path=partials,
                                                     history_path=history_path, ctx=ctx)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=every)
    return w.start()


def refresh_now(spark: SparkSession, landing_dir: str, target_path: str, checkpoint_dir: str, **kw) -> None:
    """Bring the target up to date with everything landed, then return."""
    q = start_order_facts_refresh(spark, landing_dir, target_path, checkpoint_dir, available_now=True, **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def refresh_history(spark: SparkSession, history_path: str, last: int = 3) -> DataFrame:
    """T4: the last refreshes (a top-k over a small metadata table)."""
    return spark.read.schema(HISTORY_SCHEMA).parquet(history_path).orderBy(F.col("batch_id").desc()).limit(last)
