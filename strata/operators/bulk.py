"""M4 (re-aimed): many SQL statements -> one table.

The reference runs each statement separately, concatenates the results in
client memory and writes them in batches, silently dropping failures.  Here
each statement is analysed into a DataFrame on the driver (parsing and
analysis only: no data moves), the good ones are combined with
``unionByName`` and written in one job, and statements that fail analysis
are returned as an error frame instead of being dropped.  ``run_statements``
keeps the statements apart instead, for those that may fail while they run."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

ERROR_SCHEMA = T.StructType([T.StructField("statement_index", T.IntegerType()),
                             T.StructField("statement", T.StringType()),
                             T.StructField("error", T.StringType())])


def combine_statements(spark: SparkSession, statements: Sequence[str]) -> tuple[DataFrame | None, DataFrame]:
    """Returns (union of all statements that analyse, errors).  Statements
    are taken in sorted order, like the reference; columns are matched by
    name and missing ones filled with nulls."""
    good, bad = [], []
    for i, sql in enumerate(sorted(statements)):
        try:
            good.append(spark.sql(sql))
        except Exception as e:  # analysis errors: bad SQL, missing table
            bad.append((i, sql, str(e)))
    out = None
    for df in good:
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out, spark.createDataFrame(bad, ERROR_SCHEMA)


def write_statements(spark: SparkSession, statements: Sequence[str], path: str, mode: str = "overwrite",
                     errors_path: str | None = None) -> int:
    """Run and write in one job; returns the number of failed statements."""
    out, errors = combine_statements(spark, statements)
    if out is not None:
        out.write.mode(mode).parquet(path)
    if errors_path is not None:
        errors.write.mode("append").parquet(errors_path)
    return errors.count()


def run_statements(spark: SparkSession, statements: Sequence[str], path: str, workers: int = 4) -> DataFrame:
    """Each statement as a job of its own: written to its own partition
    ``statement_index=<i>`` of ``path`` (indexes in sorted order, as above),
    at most ``workers`` at a time, under a job group named by the index.  A
    statement that fails, in analysis or while it runs, costs only itself: its
    partition is not published and the error comes back as a row."""
    def one(item: tuple[int, str]) -> tuple[int, str, str] | None:
        i, sql = item
        try:
            spark.sparkContext.setJobGroup(f"statement-{i}", sql[:100], interruptOnCancel=True)
            spark.sql(sql).write.mode("overwrite").parquet(f"{path}/statement_index={i}")
        except Exception as e:  # the statement's own failure, reported
            return i, sql, str(e).split("\n")[0]
        return None
    with ThreadPoolExecutor(max_workers=workers) as pool:
        failed = list(pool.map(inheritable_thread_target(spark)(one), enumerate(sorted(statements))))
    return spark.createDataFrame([f for f in failed if f], ERROR_SCHEMA)


def statements_from(statement_query: DataFrame) -> list[str]:
    """The statement list produced by a query (first column), like the
    reference's statement source.  Statements are code - one per generated
    item, a bounded list - so they are collected; their data never is."""
    return [r[0] for r in statement_query.collect() if r[0]]
