"""Load a text log: drop blank lines, number the remaining lines in file
order without gaps, stamp the load time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.ranking import dense_index


def load_text_log(spark: SparkSession, path: str, run_ts: Column | None = None) -> DataFrame:
    """File order = (file path, block start, position inside the block).
    ``monotonically_increasing_id`` grows with the line position inside a
    scan partition, and the hidden ``_metadata`` column gives each block's
    file and offset, so the order needs no single-task pass; numbering uses
    the range-partitioned dense index."""
    raw = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__pos"))
    lines = raw.where(F.trim("value") != "")
    numbered = dense_index(lines, ["__file", "__block", "__pos"], start=1, name="row_num")
    now = run_ts if run_ts is not None else F.current_timestamp()
    return numbered.select("row_num", F.col("value").alias("log_text"),
                           now.alias("last_updated"))


def text_lines(df: DataFrame, id_col: str, text_col: str, run_ts: Column | None = None) -> DataFrame:
    """S8 over a text column: every whole text split into lines, blank lines
    dropped, remaining lines numbered without gaps in (id, line) order.
    ``posexplode`` keeps each line's position; the numbering is the
    range-partitioned dense index, so no task holds all lines."""
    lines = df.select(id_col, F.posexplode(F.split(F.col(text_col), "\n")).alias("__line_ix", "log_text"))
    lines = lines.where(F.trim("log_text") != "")
    numbered = dense_index(lines, [id_col, "__line_ix"], start=1, name="row_num")
    now = run_ts if run_ts is not None else F.current_timestamp()
    return numbered.select("row_num", id_col, (F.col("__line_ix") + 1).cast("int").alias("line_no"), "log_text",
                           now.alias("last_updated"))
