"""Global and per-group ranking without a single-partition window (H1).

``Window.orderBy(...)`` without ``partitionBy`` moves every row into one task,
and ``partitionBy(g)`` moves a whole group into one task; both break when one
group holds a third of the data.  Here the rows are range-partitioned on
(group, order keys, tie-break) so even one hot group spreads over many
partitions, sorted inside each partition, and written once to the reliable
checkpoint folder, which fixes partition ids and row order.  A row's position
inside its partition comes from ``monotonically_increasing_id``; the number of
rows of the same group in earlier partitions comes from a per-(partition,
group) summary whose size is bounded by partitions + groups, never by rows.

Outputs:
* ``row_number``  - unique, 1-based, by order keys then tie-break
* ``rank``        - SQL rank(): ties on the order keys share the lowest number
* ``percent_rank``- (rank - 1) / (n - 1), 0 when n = 1
* ``group_count`` - rows in the group
* ``ntile_<k>``   - SQL ntile(k) over the row_number order
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir

_PID, _POS, _CNT, _FIRST, _OFF = "__pid", "__pos", "__cnt", "__first", "__off"


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _name(c) -> str:
    if isinstance(c, str):
        return c
    raise TypeError("order/partition keys must be column names")


def ntile_expr(row_number: Column, n: Column, k: int) -> Column:
    """SQL ntile(k): the first n % k buckets hold one extra row."""
    size = F.floor(n / k)
    extra = n % k
    big = extra * (size + 1)
    return (F.when(row_number <= big, F.floor((row_number - 1) / (size + 1)) + 1)
            .otherwise(extra + F.floor((row_number - 1 - big) / F.greatest(size, F.lit(1))) + 1)
            ).cast("int")


def rank_rows(df: DataFrame, order_by: Sequence[str], *, descending: Sequence[bool] | None = None,
              partition_by: Sequence[str] = (), tiebreak: Sequence[str] = (),
              tiebreak_descending: Sequence[bool] | None = None,
              outputs: Sequence[str] = ("row_number",), ntiles: Sequence[int] = (),
              num_partitions: int | None = None, prefix: str = "",
              broadcast_max_rows: int = 2_000_000) -> DataFrame:
    """Attach ranking columns to ``df`` (see module doc).

    The per-(partition, group) summary has at most partitions + groups rows
    (groups are contiguous in the range order).  It is cut and counted; under ``broadcast_max_rows`` (the usual case:
    a global ranking, or groups such as nations or segments) it is broadcast,
    otherwise it is joined by shuffle on (partition id, group).
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    order_by, partition_by, tiebreak = list(order_by), list(partition_by), list(tiebreak)
    descending = list(descending or [False] * len(order_by))
    tiebreak_descending = list(tiebreak_descending or [False] * len(tiebreak))
    n_parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def sort_col(name, desc):
        c = F.col(name)
        return c.desc_nulls_last() if desc else c.asc_nulls_first()

    keys = ([sort_col(c, False) for c in partition_by]
            + [sort_col(c, d) for c, d in zip(order_by, descending)]
            + [sort_col(c, d) for c, d in zip(tiebreak, tiebreak_descending)])

    ranged = df.repartitionByRange(n_parts, *keys).sortWithinPartitions(*keys)
    # Reliable checkpoint: stable partition ids/order, survives executor loss.
    ranged = ranged.checkpoint(eager=True)
    pid = F.spark_partition_id()
    ranged = ranged.withColumn(_PID, pid).withColumn(
        _POS, F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33))

    summary = ranged.groupBy(_PID, *partition_by).agg(F.count(F.lit(1)).alias(_CNT), F.min(_POS).alias(_FIRST))
    w_prev = Window.partitionBy(*partition_by).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(*partition_by)
    summary = summary.select(
        _PID, *partition_by, _FIRST,
        F.coalesce(F.sum(_CNT).over(w_prev), F.lit(0)).alias(_OFF),
        F.sum(_CNT).over(w_all).alias(prefix + "group_count"))
    if not partition_by:
        # One row per partition: bounded by the partition count, no check needed.
        if n_parts <= broadcast_max_rows:
            summary = F.broadcast(summary)
    else:
        summary = summary.checkpoint(eager=True)  # narrow; counted and joined
        if summary.count() <= broadcast_max_rows:
            summary = F.broadcast(summary)
    s = summary.alias("__s")
    r = ranged.alias("__r")
    cond = [F.col(f"__r.{_PID}") == F.col(f"__s.{_PID}")]
    cond += [F.col(f"__r.{c}").eqNullSafe(F.col(f"__s.{c}")) for c in partition_by]
    joined = r.join(s, cond, "inner").select(
        "__r.*", F.col(f"__s.{_FIRST}"), F.col(f"__s.{_OFF}"), F.col(f"__s.{prefix}group_count"))

    rn = F.col(_OFF) + F.col(_POS) - F.col(_FIRST) + 1
    out = joined.withColumn(prefix + "row_number", rn.cast("long"))
    n = F.col(prefix + "group_count")
    want_rank = "rank" in outputs or "percent_rank" in outputs
    if want_rank:
        # Ties share the smallest row number of their (group, order keys).
        # groupBy collapses a hot tie map-side; the join back is on the same
        # keys, where AQE's skew-join split handles a hot key.
        tie_keys = partition_by + order_by
        firsts = out.groupBy(*tie_keys).agg(F.min(prefix + "row_number").alias("__rank"))
        a, b = out.alias("__a"), firsts.alias("__b")
        cond = [F.col(f"__a.{c}").eqNullSafe(F.col(f"__b.{c}")) for c in tie_keys]
        out = a.join(b, cond, "inner").select("__a.*", F.col("__b.__rank").alias(prefix + "rank"))
        if "percent_rank" in outputs:
            out = out.withColumn(prefix + "percent_rank",
                                 F.when(n > 1, (F.col(prefix + "rank") - 1).cast("double") / (n - 1).cast("double"))
                                 .otherwise(F.lit(0.0)))
    for k in ntiles:
        out = out.withColumn(f"{prefix}ntile_{k}", ntile_expr(F.col(prefix + "row_number"), n, k))
    drop = [_PID, _POS, _FIRST, _OFF]
    if "row_number" not in outputs:
        drop.append(prefix + "row_number")
    if "group_count" not in outputs:
        drop.append(prefix + "group_count")
    if want_rank and "rank" not in outputs:
        drop.append(prefix + "rank")
    return out.drop(*drop)


def dense_index(df: DataFrame, order_by: Sequence[str], start: Column | int = 1,
                descending: Sequence[bool] | None = None, name: str = "row_index") -> DataFrame:
    """Gap-free global index in ``order_by`` order starting at ``start`` (K3,
    W12).  ``start`` may be a scalar column such as max(existing key) + 1."""
    out = rank_rows(df, order_by, descending=descending, outputs=("row_number",), prefix="__ix_")
    start_col = start if isinstance(start, Column) else F.lit(start)
    return out.withColumn(name, (F.col("__ix_row_number") - 1 + start_col).cast("long")).drop("__ix_row_number")


def exact_quantile(df: DataFrame, col: str, q: float, name: str = "quantile") -> DataFrame:
    """One-row frame holding the ``q`` quantile of ``col`` with linear
    interpolation (the pandas / numpy default).  Positions come from the
    range-partitioned ranking, so no task ever holds all values (an exact
    ``percentile`` aggregate would buffer the whole column in one task)."""
    vals = df.select(F.col(col).alias("__v")).where(F.col("__v").isNotNull())
    r = rank_rows(vals, ["__v"], outputs=("row_number", "group_count"), prefix="__q_")
    pos = (F.col("__q_group_count") - 1) * F.lit(q)
    lo = F.floor(pos) + 1
    picked = r.where((F.col("__q_row_number") == lo) | (F.col("__q_row_number") == lo + 1))
    agg = picked.agg(
        F.min(F.when(F.col("__q_row_number") == lo, F.col("__v"))).alias("__lo_v"),
        F.min(F.when(F.col("__q_row_number") == lo + 1, F.col("__v"))).alias("__hi_v"),
        F.first(pos - F.floor(pos)).alias("__frac"))
    return agg.select(F.when(F.col("__hi_v").isNull(), F.col("__lo_v"))
                      .otherwise(F.col("__lo_v") + (F.col("__hi_v") - F.col("__lo_v")) * F.col("__frac"))
                      .alias(name))
