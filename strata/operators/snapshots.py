"""K9 change feed between stored snapshots by digests of key buckets.

A snapshot is written in folders by a hash of its keys, with a small digest
table beside it: for each bucket the number of rows and sums of their hashes,
which do not depend on row order.  Two snapshots are compared by their digest
tables first; only buckets whose digests differ are read and joined, so a load
that changed few keys costs those buckets on both sides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.cdc import change_feed

BUCKET = "__bucket"
_DIGEST = f"{BUCKET} int, n long, low decimal(38,0), high decimal(38,0)"


def with_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def digests(df: DataFrame) -> DataFrame:
    """One row per bucket: count and sums of two row hashes (nulls told from
    absent values by their place), exact and free of order."""
    cols = [c for c in sorted(df.columns) if c != BUCKET]
    parts = [x for c in cols for x in (F.col(c).isNull(), F.col(c))]
    wide = [F.xxhash64(F.lit(salt), *parts).cast("decimal(20,0)") for salt in (1, 2)]
    return df.groupBy(BUCKET).agg(F.count("*").alias("n"), F.sum(wide[0]).cast("decimal(38,0)").alias("low"), F.sum(wide[1]).cast("decimal(38,0)").alias("high"))


def write_snapshot(df: DataFrame, path: str, keys: Sequence[str], buckets: int = 256) -> None:
    """``path/rows`` by bucket, and ``path/digests``.  One shuffle, by bucket."""
    with_bucket(df, keys, buckets).repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{path}/rows")
    spark = df.sparkSession
    digests(spark.read.parquet(f"{path}/rows")).coalesce(1).write.parquet(f"{path}/digests")


def changed_buckets(spark: SparkSession, old: str, new: str) -> list[int]:
    """Buckets that differ: at most as many numbers as there are buckets."""
    a, b = (spark.read.schema(_DIGEST).parquet(f"{p}/digests").alias(x) for p, x in ((old, "a"), (new, "b")))
    same = F.lit(True)
    for c in ("n", "low", "high"):
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    differ = a.join(b, F.col(f"a.{BUCKET}") == F.col(f"b.{BUCKET}"), "full_outer").where(~same)
    return [r[0] for r in differ.select(F.coalesce(f"a.{BUCKET}", f"b.{BUCKET}")).collect()]


def snapshot_change_feed(spark: SparkSession, old: str, new: str, keys: Sequence[str], commit_ts: Column,
                         version: Column | None = None) -> DataFrame:
    """``change_feed`` of two stored snapshots (written with the same keys and
    buckets), reading only the buckets that differ."""
    buckets = changed_buckets(spark, old, new)
    before, after = (spark.read.parquet(f"{p}/rows").where(F.col(BUCKET).isin(buckets) if buckets else F.lit(False)).drop(BUCKET) for p in (old, new))
    return change_feed(before, after, keys, commit_ts, version=version)
