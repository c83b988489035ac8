"""Task sizes by row counts.

After a shuffle Spark merges small partitions up to a size in bytes on disk.
Rows of a few compressed bytes each then meet by the million in one task, and
its sort buffers and hash maps, of some hundred bytes a row and operator, grow
with the input until that size is reached.  ``dealt`` gives the number of
partitions by rows instead, so that a task's memory stays the same at any size
and only the number of tasks grows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

ROWS_PER_TASK = 250_000


def dealt(df: DataFrame, rows: int, *keys) -> DataFrame:
    """``df`` by hash of ``keys`` over tasks of about ``ROWS_PER_TASK`` of its
    ``rows`` rows.  What one task per core can hold is left to the planner."""
    n = -(-rows // ROWS_PER_TASK)
    return df.repartition(n, *keys) if n > df.sparkSession.sparkContext.defaultParallelism else df
