"""Idempotent batch sinks used by the streaming jobs.

``overwrite_partitions`` is a dynamic partition overwrite: only the partitions
present in the frame are replaced, so rewriting a touched month costs that
month, and a replay writes the same content again.  Commits across writers are
left to a table format.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def overwrite_partitions(df: DataFrame, path: str, partition_cols: list[str], fmt: str = "parquet") -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).format(fmt).save(path))


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def drop_partitions(spark: SparkSession, path: str, column: str, values) -> None:
    """Remove the given partitions (a dynamic overwrite cannot empty one)."""
    jvm = spark.sparkContext._jvm
    for v in values:
        p = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{column}={v}")
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
