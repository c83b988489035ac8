"""Keyed upsert and slice replacement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir


class DuplicateKeyError(ValueError):
    pass


def assert_unique(df: DataFrame, keys: Sequence[str], what: str = "source") -> None:
    """Raise if any key occurs twice (one aggregate job; only a flag returns)."""
    dup = df.groupBy(*keys).count().where(F.col("count") > 1).limit(1).count()
    if dup:
        raise DuplicateKeyError(f"{what} has duplicate keys on {list(keys)}")


def evolve_schema(target: DataFrame, source: DataFrame, policy: str = "append_new_columns") -> DataFrame:
    """S16 on_schema_change: 'fail' rejects new/removed columns,
    'append_new_columns' adds the source's new columns (nulls in old rows),
    'sync_all_columns' also drops target columns the source no longer has,
    'ignore' keeps the target schema."""
    t, s = set(target.columns), set(source.columns)
    if policy == "fail" and t != s:
        raise ValueError(f"schema changed: added {sorted(s - t)}, removed {sorted(t - s)}")
    if policy in ("append_new_columns", "sync_all_columns"):
        for c in source.columns:
            if c not in t:
                target = target.withColumn(c, F.lit(None).cast(dict(source.dtypes)[c]))
    if policy == "sync_all_columns":
        target = target.select(*source.columns)
    return target


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], exclude: Sequence[str] = (),
           on_schema_change: str = "append_new_columns", check_unique: bool = True,
           small_source_rows: int | None = 1_000_000, small_source_bytes: int = 32 << 20) -> DataFrame:
    """K1 merge: source rows replace matching target rows (columns in
    ``exclude`` keep the target's value on matched rows); new keys are
    inserted; unmatched target rows stay.  Returns the new table version.
    Keys compare null-safely: a null key is a key like any other, as in
    ``change_feed`` and ``scd2_snapshot``.

    The source is cut first (its plan runs once).  If its keys are few and
    small, by a count of rows and of their bytes as text, only target rows
    whose key occurs in it are touched: the untouched rest is a broadcast
    anti join, so the large target is never shuffled.  Otherwise one full
    outer join on the keys.  ``operators/bucketed.py`` merges into a stored
    table and rewrites only the touched parts.
    """
    keys = list(keys)
    ensure_checkpoint_dir(source.sparkSession)
    source = source.checkpoint(eager=True)
    if check_unique:
        assert_unique(source, keys)
    target = evolve_schema(target, source, on_schema_change)
    cols = target.columns
    src_cols = set(source.columns)
    source = source.select(*[c for c in cols if c in src_cols])

    def merged(t: DataFrame, s: DataFrame) -> DataFrame:
        t_, s_ = t.withColumn("__old", F.lit(True)).alias("__t"), s.withColumn("__hit", F.lit(True)).alias("__s")
        cond = [F.col(f"__t.{k}").eqNullSafe(F.col(f"__s.{k}")) for k in keys]
        j = t_.join(s_, cond, "full_outer")
        hit, old = F.col("__s.__hit").isNotNull(), F.col("__t.__old").isNotNull()
        out = []
        for c in cols:
            if c in keys:
                out.append(F.coalesce(F.col(f"__s.{c}"), F.col(f"__t.{c}")).alias(c))
            elif c not in src_cols:
                out.append(F.col(f"__t.{c}").alias(c))
            elif c in exclude:
                out.append(F.when(old, F.col(f"__t.{c}")).otherwise(F.col(f"__s.{c}")).alias(c))
            else:
                out.append(F.when(hit, F.col(f"__s.{c}")).otherwise(F.col(f"__t.{c}")).alias(c))
        return j.select(*out)

    if small_source_rows is not None:
        size = source.agg(F.count("*").alias("n"), F.sum(F.octet_length(F.concat_ws("|", *[F.col(k).cast("string") for k in keys])) + 16).alias("b")).first()
        if size["n"] <= small_source_rows and (size["b"] or 0) <= small_source_bytes:
            batch_keys = F.broadcast(source.select(*[F.col(k).alias(f"__key{i}") for i, k in enumerate(keys)]))
            same = [F.col(k).eqNullSafe(F.col(f"__key{i}")) for i, k in enumerate(keys)]
            untouched = target.join(batch_keys, same, "left_anti")
            touched = target.join(batch_keys, same, "left_semi")
            return untouched.select(*cols).unionByName(merged(touched.select(*cols), source))
    return merged(target, source)


def newer_than(df: DataFrame, existing: DataFrame | None, column: str) -> DataFrame:
    """K6 watermark: the rows of ``df`` whose source column is above its
    maximum in ``existing``; all rows if there is no such maximum.  The
    column must come from the source (an order day, a growing key): a load
    time taken in this run is above every stored one and filters nothing."""
    if existing is None:
        return df
    mark = existing.agg(F.max(column).alias("__mark"))
    return (df.crossJoin(F.broadcast(mark))  # one row
            .where(F.col("__mark").isNull() | (F.col(column) > F.col("__mark"))).drop("__mark"))


def replace_slice(target: DataFrame, new_rows: DataFrame, predicate) -> DataFrame:
    """S14 delete-by-predicate then insert: rows matching ``predicate`` are
    replaced by ``new_rows``.  With a target partitioned on the predicate's
    column, write with dynamic partition overwrite instead (S15)."""
    kept = target.where(~F.coalesce(predicate, F.lit(False)))
    return kept.unionByName(new_rows, allowMissingColumns=True)


def replace_date_range(target: DataFrame, staging: DataFrame, date_col: str) -> DataFrame:
    """Delete the [min, max] date range found in staging, then insert
    staging; no-op on an empty batch.  The bounds are a one-row aggregate
    broadcast into the filter."""
    bounds = staging.agg(F.min(date_col).alias("__lo"), F.max(date_col).alias("__hi"))
    t = target.crossJoin(F.broadcast(bounds))
    inside = F.col("__lo").isNotNull() & F.col(date_col).between(F.col("__lo"), F.col("__hi"))
    kept = t.where(~F.coalesce(inside, F.lit(False))).drop("__lo", "__hi")
    return kept.unionByName(staging, allowMissingColumns=True)
