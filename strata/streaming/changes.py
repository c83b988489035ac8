"""Change-stream consumer.

Change rows (K9 output) are appended as files to a change folder by the
producer (``publish_changes``).  A consumer reads that folder with
``readStream``; its checkpoint is its own read position, so each consumer
sees every change exactly once.  Each micro-batch is reduced with K10
(newest change per key, delete flag, log ids above the log's maximum) and
written to the consumer's change log as a partition named by the stream batch
id; a replayed batch replaces its own partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.cdc import consume_changes
from strata.streaming.sinks import overwrite_partitions, path_exists


def publish_changes(changes: DataFrame, change_dir: str) -> None:
    """Producer side: append one change set as new files."""
    changes.write.mode("append").parquet(change_dir)


def consume_batch(batch: DataFrame, batch_id: int, *, keys: Sequence[str], log_path: str) -> None:
    """Appends the batch to the log as a partition of its own.  A replay reads
    the same earlier batches and replaces that partition, so an append that
    died half-way leaves nothing behind."""
    spark = batch.sparkSession
    prior = None
    if path_exists(spark, log_path):
        prior = spark.read.parquet(log_path).where(F.col("stream_batch_id") < int(batch_id)).drop("stream_batch_id")
    out = consume_changes(batch, keys, prior).withColumn("stream_batch_id", F.lit(int(batch_id)).cast("long"))
    overwrite_partitions(out, log_path, ["stream_batch_id"])


def start_change_consumer(spark: SparkSession, change_dir: str, schema: T.StructType, keys: Sequence[str],
                          log_path: str, checkpoint_dir: str, *, available_now: bool = True,
                          every: str = "1 hour"):
    stream = spark.readStream.schema(schema).parquet(change_dir)
    w = (stream.writeStream.option("checkpointLocation", checkpoint_dir)
         .foreachBatch(lambda df, bid: consume_batch(df, bid, keys=keys, log_path=log_path)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=every)
    return w.start()
