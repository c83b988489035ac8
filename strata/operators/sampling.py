"""Row sampling (S3-S5).  A sample is the feature here, never a way to make
a query cheaper."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def percent_sample(df: DataFrame, percent: float, seed: int = 42) -> DataFrame:
    """S4 row-level Bernoulli sample (SQL ``TABLESAMPLE (p PERCENT)``):
    each task keeps rows independently, no shuffle; every row is read
    (``block_sample`` reads only what it keeps)."""
    return df.sample(withReplacement=False, fraction=percent / 100.0, seed=seed)


def one_random_row(df: DataFrame, seed: int = 42) -> DataFrame:
    """S5 ``SAMPLE ROW (1 ROWS)``: one row picked by the largest seeded hash
    of its values.  A global ``max_by`` keeps one candidate per task
    (partial aggregation), so no sort and no single-task pass over the
    table; the pick depends only on the data and the seed, not on how the
    table is partitioned."""
    cols = df.columns
    pick = df.agg(F.max_by(F.struct(*cols), F.xxhash64(F.lit(seed), *cols)).alias("__r"))
    return pick.where(F.col("__r").isNotNull()).select("__r.*")  # empty input -> no row


def _draw(seed: int, name: str, block: int) -> float:
    """A fixed number in [0, 1) for a block of a file."""
    return int.from_bytes(hashlib.md5(f"{seed}:{name}:{block}".encode()).digest()[:8], "big") / 2.0 ** 64


def block_sample(spark: SparkSession, path: str, percent: float, seed: int = 42, columns: Sequence[str] | None = None) -> DataFrame:
    """S4 block sample (SQL ``TABLESAMPLE SYSTEM``): whole row groups of the
    Parquet files under ``path``, each chosen by a seeded hash of its file's
    name and its number.  Footers are read to learn the row groups; row groups
    that are not chosen are not read, nor are columns that are not asked for.
    The choice depends on the files alone, not on partitions.  Files are named
    by the driver (Spark's own listing); the row groups chosen are dealt out
    evenly, so a large file is read by many tasks."""
    frame = spark.read.parquet(path)
    columns = list(columns or frame.columns)
    schema = frame.select(*columns).schema
    files = sorted(frame.inputFiles())
    n = max(1, min(len(files), int(spark.conf.get("spark.sql.shuffle.partitions"))))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri in b.column(0).to_pylist():
                with _open(uri) as f:
                    groups = pq.ParquetFile(f).num_row_groups
                kept = [g for g in range(groups) if _draw(seed, uri.rsplit("/", 1)[-1], g) * 100 < percent]
                yield pa.RecordBatch.from_arrays([pa.array([uri] * len(kept), pa.string()), pa.array(kept, pa.int32())], names=["uri", "block"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri, group in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with _open(uri) as f:
                    yield from pq.ParquetFile(f).read_row_group(group, columns=columns).select(columns).to_batches(max_chunksize=10_000)
    chosen = spark.createDataFrame([(f,) for f in files], "uri string").repartition(n).mapInArrow(blocks, "uri string, block int")
    return chosen.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).mapInArrow(rows, schema)


def _open(uri: str):
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    system, name = pyarrow.fs.FileSystem.from_uri(uri)
    return system.open_input_file(name)
