"""S12 keyed merge into a bucketed table: only touched parts are rewritten.

The table is partitioned by a hash of the keys (``PART``) and bucketed by the
keys.  A batch is dealt into the same buckets, so the join moves the batch and
never the target; only the parts that the batch's keys fall into are read
(partition pruning) and replaced (dynamic partition overwrite).  A batch of a
few keys in a table of many parts so reads and writes a few parts; a part is
the unit of rewriting, so more parts mean cheaper small batches and more files.

The same batch merged twice gives the same table, which is what a replayed
micro-batch does.  Commits across concurrent writers are left to a table
format.  A key must not be null: equality that takes nulls as equal cannot use
the buckets, so a batch with a null key is refused.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.merge import DuplicateKeyError
from strata.session import ensure_checkpoint_dir

PART = "__part"
_KEYS, _BUCKETS, _PARTS = "strata.keys", "strata.buckets", "strata.parts"


def _with_part(df: DataFrame, keys: Sequence[str], parts: int) -> DataFrame:
    return df.withColumn(PART, F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int"))


def create_bucketed(df: DataFrame, table: str, keys: Sequence[str], *, buckets: int = 64, parts: int = 64) -> None:
    """Writes ``df`` as a new bucketed table (one file per part and bucket)."""
    keys = list(keys)
    (_with_part(df, keys, parts).repartition(buckets, *keys).write.partitionBy(PART).bucketBy(buckets, *keys).sortBy(*keys)
     .format("parquet").saveAsTable(table))
    df.sparkSession.sql(f"ALTER TABLE {table} SET TBLPROPERTIES "
                        f"('{_KEYS}' = '{','.join(keys)}', '{_BUCKETS}' = '{buckets}', '{_PARTS}' = '{parts}')")


def _layout(spark: SparkSession, table: str) -> tuple[list[str], int, int]:
    props = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return props[_KEYS].split(","), int(props[_BUCKETS]), int(props[_PARTS])


def read_bucketed(spark: SparkSession, table: str) -> DataFrame:
    spark.catalog.refreshTable(table)  # a stream merges in a session of its own
    return spark.table(table).drop(PART)


def merged_parts(spark: SparkSession, table: str, batch: DataFrame, exclude: Sequence[str] = ()) -> tuple[DataFrame, list[int]]:
    """The new rows of the parts that ``batch`` touches, and those parts.  Matched rows take the batch's values but for ``exclude``; columns
    that the batch lacks keep theirs."""
    keys, buckets, parts = _layout(spark, table)
    ensure_checkpoint_dir(spark)
    batch = _with_part(batch, keys, parts).checkpoint(eager=True)  # read three times below
    bad = batch.groupBy(*keys).agg(F.count("*").alias("n")).filter((F.col("n") > 1) | F.concat(*[F.col(k).cast("string") for k in keys]).isNull())
    if not bad.isEmpty():
        raise DuplicateKeyError(f"the batch has repeated or null keys on {keys}")
    touched = [r[0] for r in batch.select(PART).distinct().collect()]  # at most `parts` numbers
    spark.catalog.refreshTable(table)
    target = spark.table(table).filter(F.col(PART).isin(touched))
    t, s = target.alias("t"), batch.repartition(buckets, *keys).withColumn("__hit", F.lit(True)).alias("s")
    joined = t.join(s, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "full_outer")
    hit, old, out = F.col("s.__hit").isNotNull(), F.col(f"t.{PART}").isNotNull(), []
    for c in target.columns:
        if c in keys or c == PART:
            out.append(F.coalesce(f"s.{c}", f"t.{c}").alias(c))
        elif c not in batch.columns:
            out.append(F.col(f"t.{c}").alias(c))
        else:
            takes = hit & ~old if c in exclude else hit
            out.append(F.when(takes, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
    return joined.select(*out), touched


def merge_bucketed(spark: SparkSession, table: str, batch: DataFrame, exclude: Sequence[str] = ()) -> int:
    """Merges ``batch`` into the table; returns how many parts were replaced."""
    new, touched = merged_parts(spark, table, batch, exclude)
    if not touched:
        return 0
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        new.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    return len(touched)


def start_merge_stream(spark: SparkSession, source_dir: str, schema: T.StructType, table: str, checkpoint_dir: str, *,
                       exclude: Sequence[str] = (), available_now: bool = True, every: str = "1 hour"):
    """Files that land in a folder, merged batch by batch."""
    stream = spark.readStream.schema(schema).parquet(source_dir)
    w = (stream.writeStream.option("checkpointLocation", checkpoint_dir)
         .foreachBatch(lambda df, _: merge_bucketed(df.sparkSession, table, df, exclude) and None))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=every)
    return w.start()
