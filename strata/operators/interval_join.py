"""Validity-range joins as equi joins on the day.

A join whose only condition is ``d BETWEEN start AND end`` plans as a
nested-loop join.  Instead each interval is expanded to one row per day,
clipped to the span of days the facts actually use, and the facts join it on
``(keys, day)``.  The expanded side's size is (days in span) x (interval
keys) when intervals of one key do not overlap; it is counted before the
join and broadcast only under ``broadcast_max_rows``, otherwise both sides
shuffle on (keys, day).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY = "__day"


def expand_to_days(intervals: DataFrame, start: str, end: str, lo: Column | None = None,
                   hi: Column | None = None) -> DataFrame:
    """One row per day of [start, end] (inclusive), clipped to [lo, hi]."""
    s = F.to_date(F.col(start))
    e = F.to_date(F.col(end))
    if lo is not None:
        s = F.greatest(s, lo)
    if hi is not None:
        e = F.least(e, hi)
    return intervals.where(s <= e).select("*", F.explode(F.sequence(s, e)).alias(DAY))


def interval_join(facts: DataFrame, fact_day: Column, intervals: DataFrame, start: str, end: str, *,
                  fact_keys: Sequence[Column] = (), interval_keys: Sequence[str] = (),
                  how: str = "left", broadcast_max_rows: int = 2_000_000,
                  bounds: DataFrame | None = None) -> DataFrame:
    """Join ``facts`` to the interval rows whose [start, end] holds
    ``fact_day`` (inclusive both ends, like BETWEEN).  Interval columns keep
    their names; the helper day column is dropped.

    ``bounds`` is an optional one-row frame (``__lo``, ``__hi``) that
    contains every fact day, e.g. min/max of a date column of the source
    table; it saves computing the span over ``facts`` itself (which would
    run the facts plan, joins included, an extra time)."""
    f = facts.withColumn("__fday", F.to_date(fact_day))
    span = bounds if bounds is not None else f.agg(F.min("__fday").alias("__lo"), F.max("__fday").alias("__hi"))
    clipped = intervals.crossJoin(F.broadcast(span))
    days = expand_to_days(clipped, start, end, F.col("__lo"), F.col("__hi")).drop("__lo", "__hi")
    n = days.count()  # size check of the side we may broadcast
    side = F.broadcast(days) if n <= broadcast_max_rows else days
    cond = [F.col("__fday") == F.col(DAY)]
    cond += [fk == F.col(ik) for fk, ik in zip(fact_keys, interval_keys)]
    out = f.join(side, cond, how)
    return out.drop("__fday", DAY)


def as_of_join(facts: DataFrame, fact_key: str, fact_day, dim: DataFrame, dim_key: str, start: str, end: str,
               how: str = "left") -> DataFrame:
    """J14 point-in-time lookup: the dimension version of the same key whose
    [start, end] holds the fact's day.  One equi join on the key (shuffle or
    broadcast as the planner sees fit) with the range as a join condition, so
    only the versions of the fact's own key are compared."""
    day = F.to_date(fact_day) if not isinstance(fact_day, str) else F.to_date(F.col(fact_day))
    f = facts.withColumn("__asof_day", day)
    cond = (F.col(fact_key) == F.col(dim_key)) & F.col("__asof_day").between(F.col(start), F.col(end))
    return f.join(dim, cond, how).drop("__asof_day")


def smallest_above(values: DataFrame, value_col: str, table: DataFrame, bound_col: str,
                   payload: Sequence[str], *, strict: bool = True, prefix: str = "",
                   num_partitions: int | None = None) -> DataFrame:
    """For every row of ``values``: the ``payload`` of the ``table`` row with
    the smallest ``bound_col`` above ``value_col`` (``>=`` when not
    ``strict``); null when none, or when the value is null.  Both sides are
    compared in the type that Spark widens them to.  Exact at any size of
    either side.

    Both sides are unioned and globally ordered by (value, side) with the
    range-partitioned ranking operator; at equal values the side order
    decides whether an equal bound counts.  Rows are cut into ``num_partitions``
    blocks of consecutive row numbers, so a window per block holds a bounded
    share of the rows (a hot value is split across blocks).  Inside a block
    the nearest following bound comes from a running window over descending
    row numbers (linear, not an unbounded-following frame); a match in a
    later block comes from a per-block summary of at most ``num_partitions``
    rows."""
    from pyspark.sql import Window
    from strata.operators.ranking import rank_rows
    spark = values.sparkSession
    n_parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    vt, tt = dict(values.dtypes), dict(table.dtypes)
    vcols, pcols = values.columns, list(payload)
    k_val, k_tab = (1, 0) if strict else (0, 1)
    left = values.select(*vcols, F.col(value_col).alias("__sa_v"), F.lit(k_val).alias("__sa_k"),
                         *[F.lit(None).cast(tt[p]).alias(f"__sa_p_{p}") for p in pcols])
    right = table.select(*[F.lit(None).cast(vt[c]).alias(c) for c in vcols],
                         F.col(bound_col).alias("__sa_v"), F.lit(k_tab).alias("__sa_k"),
                         *[F.col(p).alias(f"__sa_p_{p}") for p in pcols])
    r = rank_rows(left.unionByName(right).where(F.col("__sa_v").isNotNull()), ["__sa_v", "__sa_k"],
                  outputs=("row_number", "group_count"), num_partitions=n_parts, prefix="__sa_")
    rn, n = F.col("__sa_row_number"), F.col("__sa_group_count")
    r = r.withColumn("__sa_blk", F.floor((rn - 1) * n_parts / n).cast("int"))
    is_tab = F.col("__sa_k") == k_tab
    hit = F.when(is_tab, F.struct(*[F.col(f"__sa_p_{p}").alias(p) for p in pcols]))
    w = Window.partitionBy("__sa_blk").orderBy(rn.desc()).rowsBetween(Window.unboundedPreceding, -1)
    r = r.withColumn("__sa_next", F.last(hit, ignorenulls=True).over(w))
    # First table row of each block, then for each block the first one in a later block.
    blocks = r.groupBy("__sa_blk").agg(F.min(F.when(is_tab, F.struct(rn.alias("rn"), hit.alias("hit")))).alias("__f"))
    wb = Window.orderBy(F.col("__sa_blk").desc()).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("__sa_blk", F.last("__f.hit", ignorenulls=True).over(wb).alias("__sa_later"))
    out = r.where(~is_tab).join(F.broadcast(blocks), "__sa_blk")  # at most num_partitions rows
    m = F.coalesce(F.col("__sa_next"), F.col("__sa_later"))
    out = out.select(*vcols, *[m[p].alias(prefix + p) for p in pcols])
    unknown = values.where(F.col(value_col).isNull()).select(*vcols, *[F.lit(None).cast(tt[p]).alias(prefix + p) for p in pcols])
    return out.unionByName(unknown)


def as_of_merge(facts: DataFrame, fact_key: str, fact_time: Column | str, versions: DataFrame, version_key: str,
                start: str, end: str | None = None, *, payload: Sequence[str], prefix: str = "",
                num_partitions: int | None = None) -> DataFrame:
    """J14 point-in-time lookup by merge: every row of ``facts`` with the
    ``payload`` of the version of its key that starts last at or before the
    fact's time (equal starts: the one that ends last), null if there is none
    or it has ended (``end`` is inclusive, null is open).  Days or timestamps.

    ``as_of_join`` compares a fact with all versions of its key; here each row
    of either side is read once.  Both sides are united and dealt by ranges of
    (key, time), so that one key spreads over many tasks; a running last value
    gives each fact its version, and the last version of a partition's last
    key is carried to the partitions after it through a table of at most two
    rows per partition.  Facts without a key or time meet no version and stay
    out of the merge."""
    from pyspark.sql import Window
    from strata.session import ensure_checkpoint_dir
    spark = facts.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    time = F.col(fact_time) if isinstance(fact_time, str) else fact_time
    types = dict(versions.dtypes)
    stop = F.col(end).cast("timestamp_ntz") if end else F.lit(None).cast("timestamp_ntz")
    hit = F.struct(F.col(start).cast("timestamp_ntz").alias("s"), stop.alias("e"), *[F.col(p).alias(f"p_{p}") for p in payload])
    own = versions.where(F.col(version_key).isNotNull() & F.col(start).isNotNull())
    right = own.select(F.col(version_key).alias("__k"), F.col(start).cast("timestamp_ntz").alias("__t"), F.lit(0).alias("__tag"),
                       F.coalesce(stop, F.lit("9999-12-31 23:59:59").cast("timestamp_ntz")).alias("__e"), F.lit(0).cast("long").alias("__spread"),
                       hit.alias("__hit"))
    placed = F.col("__k").isNotNull() & F.col("__t").isNotNull()
    cols = facts.columns
    left = facts.select(F.col(fact_key).alias("__k"), time.cast("timestamp_ntz").alias("__t"), F.lit(1).alias("__tag"),
                        F.lit(None).cast("timestamp_ntz").alias("__e"), F.xxhash64(*cols).alias("__spread"), F.struct(*cols).alias("__fact"))
    order = ["__k", "__t", "__tag", "__e", "__spread"]
    both = left.where(placed).unionByName(right, allowMissingColumns=True)
    dealt = both.repartitionByRange(n, *order).sortWithinPartitions(*order).checkpoint(eager=True)  # fixes the partitions
    dealt = dealt.withColumn("__pid", F.spark_partition_id())
    # What each partition hands on: the last version of its last key.
    ends = dealt.groupBy("__pid").agg(F.min("__k").alias("__first"), F.max("__k").alias("__k"))
    last = (dealt.where("__tag = 0").join(F.broadcast(ends.select("__pid", "__k")), ["__pid", "__k"])
            .groupBy("__pid").agg(F.max_by("__hit", F.struct("__t", "__e")).alias("__hit")))
    ends = ends.join(last, "__pid", "left")
    gives = ends.select("__k", "__pid", F.lit(1).alias("__kind"), "__hit")
    takes = ends.select(F.col("__first").alias("__k"), "__pid", F.lit(0).alias("__kind"), F.lit(None).cast(dealt.schema["__hit"].dataType).alias("__hit"))
    before = Window.partitionBy("__k").orderBy("__pid", "__kind").rowsBetween(Window.unboundedPreceding, -1)
    carried = (gives.unionByName(takes).withColumn("__carried", F.last("__hit", ignorenulls=True).over(before))
               .where("__kind = 0").select("__pid", "__k", "__carried"))
    running = Window.partitionBy("__pid", "__k").orderBy("__t", "__tag", "__e", "__spread").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = dealt.withColumn("__own", F.last("__hit", ignorenulls=True).over(running)).where("__tag = 1")
    found = found.join(F.broadcast(carried), ["__pid", "__k"], "left")  # at most a row per partition
    best = F.coalesce("__own", "__carried")
    holds = best["e"].isNull() | (F.col("__t") <= best["e"])
    out = found.select("__fact.*", *[F.when(holds, best[f"p_{p}"]).alias(prefix + p) for p in payload])
    rest = left.where(~placed).select("__fact.*", *[F.lit(None).cast(types[p]).alias(prefix + p) for p in payload])
    return out.unionByName(rest)
