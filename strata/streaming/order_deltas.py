"""Order facts kept up to date by signed deltas.

A stateful stream keeps the newest image of every order in Spark's state
store.  When an order arrives, it emits *minus* its old image and *plus* the
new one; an image older than the kept one, or equal to it, emits nothing.  The
deltas of a micro-batch are added up to additive partials - how often each
(date, customer, status, priority, price) occurs, with a sign - and written to
one folder per month and batch.  So a batch reads itself and the state of its
own keys; no landed file is read twice.

The facts of a month come from the sum of that month's partials.  Counts of
prices are additive under removal, which minima, maxima and deviations are
not; the facts are computed from them by the same code as a full build.  Only
the months that a batch touched are summed and replaced.  ``fold`` sums the
partials of months with many batches into one base, named by the last batch in
it; readers take the newest base of a month and the batches after it, so a
fold that dies half-way is not seen and one that is repeated changes nothing.

A replayed batch starts from the same state and so writes the same partials
over its own folders.  Which image is newest is decided by ``version`` (a
column of the source); without one the later batch counts, and within a batch
the larger row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from strata.streaming.sinks import overwrite_partitions, path_exists

#: What the facts depend on; price is the counted value.
IMAGE = ("o_orderdate", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
_IMAGE_TYPES = "o_orderdate timestamp_ntz, o_custkey long, o_orderstatus string, o_orderpriority string, o_totalprice double"
_STATE = f"version long, {_IMAGE_TYPES}"
_DELTA = f"o_orderkey long, sign int, {_IMAGE_TYPES}"
MONTH = "month"
BATCH = "batch"


def _newest(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Deltas of one order."""
    rows = pd.concat(list(frames), ignore_index=True)
    # Ties of version: the larger row, so that a replay picks the same one.
    new = max(((r[0], *r[1:]) for r in rows[["version", *IMAGE]].itertuples(index=False, name=None)),
              key=lambda r: (r[0], tuple((not pd.isna(x), str(x)) for x in r[1:])))
    new = (int(new[0]), *(None if pd.isna(x) else x for x in new[1:]))
    old = state.get if state.exists else None
    if old is not None and (new[0] < old[0] or _same(new[1:], old[1:])):
        if new[0] > old[0]:
            state.update((new[0], *old[1:]))
        return
    state.update(new)
    out = [(key[0], -1, *old[1:])] if old is not None else []
    yield pd.DataFrame([*out, (key[0], 1, *new[1:])], columns=["o_orderkey", "sign", *IMAGE])


def _same(a: Sequence, b: Sequence) -> bool:
    return all((pd.isna(x) and pd.isna(y)) or (not pd.isna(x) and not pd.isna(y) and x == y) for x, y in zip(a, b))


def signed_deltas(orders: DataFrame, version: Column | None = None) -> DataFrame:
    """Streaming ``orders`` to (o_orderkey, sign, image).  Rows without an
    order key cannot be followed and are left out."""
    v = version if version is not None else F.lit(0)
    images = orders.filter("o_orderkey is not null").select("o_orderkey", v.cast("long").alias("version"), *IMAGE)
    return images.groupBy("o_orderkey").applyInPandasWithState(_newest, _DELTA, _STATE, "update", GroupStateTimeout.NoTimeout)


# ---------------------------------------------------------------------------
# Partials
# ---------------------------------------------------------------------------

def partials_of(deltas: DataFrame) -> DataFrame:
    """Signed counts per image and month; what cancels out is left out."""
    return (deltas.groupBy(*IMAGE).agg(F.sum("sign").cast("long").alias("n")).filter("n <> 0")
            .withColumn(MONTH, F.trunc(F.to_date("o_orderdate"), "month")))


def write_partials(deltas: DataFrame, path: str, batch_id: int) -> None:
    """The partials of a batch, in folders of their own (written again by a
    replay)."""
    overwrite_partitions(partials_of(deltas).withColumn(BATCH, F.lit(int(batch_id)).cast("long")),
                         f"{path}/deltas", [MONTH, BATCH])


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    schema = f"{_IMAGE_TYPES}, n long, {MONTH} date, {BATCH} long"
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else None


def read_partials(spark: SparkSession, path: str, months: Sequence | None = None) -> DataFrame:
    """Partials (not yet summed) of the given months, or of all: the newest
    base of each month and the batches after it.  ``months`` becomes a
    partition filter."""
    def of(df: DataFrame) -> DataFrame:
        if months is None:
            return df
        dated = F.col(MONTH).isin([m for m in months if m is not None])
        return df.filter(dated | F.col(MONTH).isNull() if None in months else dated)
    deltas = of(_read(spark, f"{path}/deltas"))
    base = _read(spark, f"{path}/base")
    if base is None:
        return deltas
    base = of(base)
    # One row per folded month: bounded by the calendar.
    last = F.broadcast(base.groupBy(MONTH).agg(F.max(BATCH).alias("__last")).withColumnRenamed(MONTH, "__month"))
    same = F.col(MONTH).eqNullSafe(F.col("__month"))
    newer = deltas.join(last, same, "left").filter(F.col("__last").isNull() | (F.col(BATCH) > F.col("__last")))
    kept = base.join(last, same & (F.col(BATCH) == F.col("__last")))
    return kept.drop("__month", "__last").unionByName(newer.drop("__month", "__last"))


def summed(partials: DataFrame) -> DataFrame:
    return (partials.groupBy(*IMAGE).agg(F.sum("n").alias("n")).filter("n <> 0"))


def images(partials: DataFrame) -> DataFrame:
    """One row for each counted order (without its key)."""
    return (summed(partials).select(F.lit(None).cast("long").alias("o_orderkey"), *IMAGE, F.explode(F.sequence(F.lit(1), F.col("n"))).alias("__i"))
            .drop("__i"))


def touched_months(spark: SparkSession, path: str, batch_id: int) -> list:
    """Months that a batch wrote to: folder names, so bounded by the calendar."""
    deltas = _read(spark, f"{path}/deltas")
    if deltas is None:
        return []
    return [r[0] for r in deltas.filter(F.col(BATCH) == int(batch_id)).select(MONTH).distinct().collect()]


def images_in(spark: SparkSession, path: str, batch_id: int) -> int:
    """New images that a batch counted."""
    deltas = _read(spark, f"{path}/deltas")
    if deltas is None:
        return 0
    return deltas.filter((F.col(BATCH) == int(batch_id)) & (F.col("n") > 0)).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def fold(spark: SparkSession, path: str, months: Sequence | None = None) -> None:
    """Sums the partials of the given months (or of all) into a base named by
    the last batch in it.  Not beside a running batch of the same months."""
    deltas = _read(spark, f"{path}/deltas")
    if deltas is None:
        return
    last = deltas.agg(F.max(BATCH)).first()[0]
    if last is None:
        return
    base = summed(read_partials(spark, path, months)).withColumn(MONTH, F.trunc(F.to_date("o_orderdate"), "month"))
    # A month whose orders all left still needs a base, or its old deltas would count again: a row of weight 0.
    empty = deltas.select(MONTH).distinct() if months is None else deltas.filter(F.col(MONTH).isin(list(months))).select(MONTH).distinct()
    zero = empty.select(F.col(MONTH).cast("timestamp_ntz").alias("o_orderdate"), F.lit(None).cast("long").alias("o_custkey"),
                        F.lit(None).cast("string").alias("o_orderstatus"), F.lit(None).cast("string").alias("o_orderpriority"),
                        F.lit(None).cast("double").alias("o_totalprice"), F.lit(0).cast("long").alias("n"), MONTH)
    overwrite_partitions(base.unionByName(zero).withColumn(BATCH, F.lit(last).cast("long")), f"{path}/base", [MONTH, BATCH])
