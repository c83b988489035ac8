"""History tables: change-detecting Type 1 upsert (K4) and Type 2
snapshots (K11-K16).  Each is a pure function from (existing table, new
source) to the next table version; publishing is the caller's write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.keys import assign_surrogate_keys, scd_id
from strata.operators.merge import assert_unique, evolve_schema, upsert


def scd1_changes(source: DataFrame, existing: DataFrame | None, *, integration_key: str = "integration_id",
                 hash_key: str = "cdc_hash_key", surrogate_key: str | None = None,
                 order_by: Sequence[str] | None = None, run_ts: Column | None = None,
                 inserted_at: str = "inserted_ts", updated_at: str = "updated_ts") -> DataFrame:
    """K4 ``get_scd_sql``: the change set to merge.

    inserts: integration ids absent from ``existing``, with new surrogate keys
    above the existing maximum and both stamps = ``run_ts``;
    updates: ids whose hash differs, keeping surrogate key and inserted stamp;
    unchanged rows are absent."""
    now = run_ts if run_ts is not None else F.localtimestamp()
    if existing is None:
        ins = source.withColumn(inserted_at, now).withColumn(updated_at, now)
        if surrogate_key:
            ins = assign_surrogate_keys(ins, order_by or [integration_key], surrogate_key)
        return ins
    cols = [integration_key, hash_key, inserted_at] + ([surrogate_key] if surrogate_key else [])
    e = existing.select(*cols)
    inserts = source.join(e.select(integration_key), integration_key, "left_anti")
    inserts = inserts.withColumn(inserted_at, now).withColumn(updated_at, now)
    if surrogate_key:
        inserts = assign_surrogate_keys(inserts, order_by or [integration_key], surrogate_key, existing)
    ea = e.withColumnRenamed(hash_key, "__old_hash")
    updates = (source.join(ea, integration_key, "inner")
               .where(~F.col(hash_key).eqNullSafe(F.col("__old_hash")))
               .drop("__old_hash").withColumn(updated_at, now))
    return inserts.unionByName(updates)


def scd1_apply(source: DataFrame, existing: DataFrame | None, **kw) -> DataFrame:
    """K4 + K1: next version of the Type 1 table."""
    changes = scd1_changes(source, existing, **kw)
    if existing is None:
        return changes
    return upsert(existing, changes, [kw.get("integration_key", "integration_id")])


def scd2_snapshot(history: DataFrame | None, source: DataFrame, keys: Sequence[str], *,
                  strategy: str = "check", check_cols: Sequence[str] | None = None,
                  updated_at: str | None = None, run_ts: Column | None = None,
                  hard_deletes: str = "ignore", valid_from: str = "valid_from",
                  valid_to: str = "valid_to", scd_id_col: str = "scd_id",
                  updated_col: str = "row_updated_at", is_deleted: str = "is_deleted",
                  current_flag: str | None = None, open_end: Column | None = None) -> DataFrame:
    """K11-K15 snapshot.

    strategy 'check': a new version when any ``check_cols`` value differs
    (null-safe); 'timestamp': when ``updated_at`` is newer.  hard_deletes:
    'ignore' keeps vanished keys open, 'invalidate' closes them,
    'new_record' closes them and adds a deletion row.  The open end is
    null unless ``open_end`` is given.  Rerunning with the same source
    changes nothing; a key that returns after deletion opens a new version.
    One full outer join of open rows with the source on the keys (a null key
    is a key like any other) gives each pair its rows of the next version as
    an array, exploded once; closed history passes through untouched.  New
    source columns are added to the history, null in old rows.  Write the
    returned version before the next load reads it.
    """
    keys = list(keys)
    assert_unique(source, keys)
    now = run_ts if run_ts is not None else F.localtimestamp()
    biz = [c for c in source.columns]
    if strategy == "timestamp":
        stamp = F.col(f"__s.{updated_at}")
    else:
        stamp = now
    end_open = open_end if open_end is not None else F.lit(None)
    def new_rows(df: DataFrame, vf: Column, deleted: bool = False) -> DataFrame:
        out = df.select(*[F.col(f"__s.{c}").alias(c) for c in biz], vf.cast("timestamp_ntz").alias(valid_from),
                        vf.cast("timestamp_ntz").alias(updated_col))
        if hard_deletes == "new_record":
            out = out.withColumn(is_deleted, F.lit(deleted))
        return out

    if history is None:
        s = source.alias("__s")
        first = new_rows(s, stamp)
        return _finish(first, keys, valid_from, valid_to, scd_id_col, end_open, current_flag, open_end)

    history = evolve_schema(history, source)
    types = dict(history.dtypes)
    is_open = (F.col(valid_to).isNull() if open_end is None else F.col(valid_to) == open_end)
    closed_hist = history.where(~is_open)
    h = history.where(is_open).withColumn("__in", F.lit(True)).alias("__h")
    s = source.withColumn("__in", F.lit(True)).alias("__s")
    j = h.join(s, [F.col(f"__h.{k}").eqNullSafe(F.col(f"__s.{k}")) for k in keys], "full_outer")
    in_h, in_s = F.col("__h.__in").isNotNull(), F.col("__s.__in").isNotNull()
    was_deleted = (F.coalesce(F.col(f"__h.{is_deleted}"), F.lit(False)) if hard_deletes == "new_record"
                   else F.lit(False))
    if strategy == "timestamp":
        changed = F.coalesce(F.col(f"__s.{updated_at}") > F.col(f"__h.{updated_col}"), F.lit(False))
    else:
        cc = check_cols or [c for c in biz if c not in keys]
        changed = F.lit(False)
        for c in cc:
            changed = changed | ~F.col(f"__h.{c}").eqNullSafe(F.col(f"__s.{c}"))
    changed = changed | was_deleted

    def row(side: str, fresh: bool, **given: Column) -> Column:
        """A row of the history from one side of the join and given values."""
        have = set(biz) if side == "__s" else set(history.columns)
        values = [given[c] if c in given else F.col(f"{side}.{c}") if c in have else F.lit(None) for c in history.columns]
        return F.struct(*[v.cast(types[c]).alias(c) for c, v in zip(history.columns, values)], F.lit(fresh).alias("__fresh"))

    def opened(side: str, at: Column, deleted: bool) -> Column:
        flags = {is_deleted: F.lit(deleted)} if hard_deletes == "new_record" else {}
        if current_flag:
            flags[current_flag] = F.lit(True)
        return row(side, True, **{valid_from: at, updated_col: at, valid_to: end_open, **flags})

    def closed(at: Column) -> Column:
        return row("__h", False, **{valid_to: at, **({current_flag: F.lit(False)} if current_flag else {})})
    same, fresh = row("__h", False), opened("__s", stamp, False)
    gone = {"ignore": F.array(same), "invalidate": F.array(closed(now)),
            "new_record": F.array(closed(now), opened("__h", now, True))}[hard_deletes]
    rows = (F.when(in_h & in_s & changed, F.array(closed(stamp), fresh))
            .when(in_h & in_s, F.array(same)).when(in_s, F.array(fresh))
            .when(was_deleted, F.array(same)).otherwise(gone))
    out = j.select(F.explode(rows).alias("__row")).select("__row.*")
    out = out.withColumn(scd_id_col, F.when(F.col("__fresh"), scd_id(keys, valid_from)).otherwise(F.col(scd_id_col)))
    return closed_hist.unionByName(out.select(*history.columns))


def _finish(df, keys, valid_from, valid_to, scd_id_col, end_open, current_flag, open_end):
    df = df.withColumn(valid_to, end_open.cast("timestamp_ntz")).withColumn(scd_id_col, scd_id(keys, valid_from))
    if current_flag:
        df = df.withColumn(current_flag, F.lit(True))
    return df


def hybrid_dimension_load(dim: DataFrame | None, staging: DataFrame, business_key: str,
                          type2_cols: Sequence[str], type1_cols: Sequence[str], load_ts: Column, *,
                          surrogate_key: str = "customer_key", start_col: str = "effective_start_date",
                          end_col: str = "effective_end_date", current_col: str = "is_current",
                          open_end: str = "9999-12-31", who: str = "ETL") -> tuple[DataFrame, DataFrame]:
    """K16 (T-SQL customer load): Type 2 on ``type2_cols`` (expire the
    current row, insert a new version), Type 1 on ``type1_cols`` (overwrite
    the current row, after the new versions exist), brand-new keys inserted
    with keys above the maximum.  Returns (next dimension, one-row counts:
    rows_expired, rows_inserted_new_version, rows_inserted_new_key,
    rows_type1_updated).  Null compares null-safely."""
    assert_unique(staging, [business_key])
    end_val = F.to_date(F.lit(open_end))
    cols_biz = [business_key] + list(type2_cols) + list(type1_cols)
    stg = staging.select(*cols_biz)
    if dim is None:
        new = stg.select("*", load_ts.cast("date").alias(start_col), end_val.alias(end_col),
                         F.lit(True).alias(current_col), load_ts.alias("created_date"), F.lit(who).alias("created_by"),
                         F.lit(None).cast("timestamp_ntz").alias("updated_date"), F.lit(None).cast("string").alias("updated_by"))
        new = assign_surrogate_keys(new, [business_key], surrogate_key)
        counts = new.agg(F.lit(0).cast("long").alias("rows_expired"), F.lit(0).cast("long").alias("rows_inserted_new_version"),
                         F.count(F.lit(1)).alias("rows_inserted_new_key"), F.lit(0).cast("long").alias("rows_type1_updated"))
        return new.select(surrogate_key, *[c for c in new.columns if c != surrogate_key]), counts
    dim_cols = dim.columns
    cur, old = dim.where(F.col(current_col)), dim.where(~F.col(current_col))
    c, s = cur.withColumn("__in", F.lit(True)).alias("__c"), stg.withColumn("__in", F.lit(True)).alias("__s")
    j = c.join(s, F.col(f"__c.{business_key}").eqNullSafe(F.col(f"__s.{business_key}")), "full_outer")
    cp, sp = F.col("__c.__in").isNotNull(), F.col("__s.__in").isNotNull()
    t2 = F.lit(False)
    for col in type2_cols:
        t2 = t2 | ~F.col(f"__c.{col}").eqNullSafe(F.col(f"__s.{col}"))
    t1 = F.lit(False)
    for col in type1_cols:
        t1 = t1 | ~F.col(f"__c.{col}").eqNullSafe(F.col(f"__s.{col}"))
    j = j.withColumn("__st", F.when(cp & sp & t2, "t2").when(cp & sp & t1, "t1").when(cp & sp, "same")
                     .when(sp, "new").otherwise("absent"))
    cur_row = lambda df: df.select(*[F.col(f"__c.{x}").alias(x) for x in dim_cols])
    kept = cur_row(j.where(F.col("__st").isin("same", "absent")))
    expired = j.where(F.col("__st") == "t2").select(
        *[F.col(f"__c.{x}").alias(x) for x in dim_cols if x not in (end_col, current_col, "updated_date", "updated_by")],
        # A second load on the day a version began ends it on that day, not before it.
        F.greatest(F.date_sub(load_ts.cast("date"), 1), F.col(f"__c.{start_col}")).alias(end_col), F.lit(False).alias(current_col),
        load_ts.alias("updated_date"), F.lit(who).alias("updated_by")).select(*dim_cols)
    type1 = j.where(F.col("__st") == "t1").select(
        *[(F.col(f"__s.{x}") if x in type1_cols else F.col(f"__c.{x}")).alias(x)
          for x in dim_cols if x not in ("updated_date", "updated_by")],
        load_ts.alias("updated_date"), F.lit(who).alias("updated_by")).select(*dim_cols)
    fresh = j.where(F.col("__st").isin("t2", "new")).select(
        *[F.col(f"__s.{x}").alias(x) for x in cols_biz], F.col("__st"),
        load_ts.cast("date").alias(start_col), end_val.alias(end_col), F.lit(True).alias(current_col),
        load_ts.alias("created_date"), F.lit(who).alias("created_by"),
        F.lit(None).cast("timestamp_ntz").alias("updated_date"), F.lit(None).cast("string").alias("updated_by"))
    fresh = assign_surrogate_keys(fresh, [business_key], surrogate_key, dim)
    counts = j.agg(F.sum(F.when(F.col("__st") == "t2", 1).otherwise(0)).cast("long").alias("rows_expired"),
                   F.sum(F.when(F.col("__st") == "t2", 1).otherwise(0)).cast("long").alias("rows_inserted_new_version"),
                   F.sum(F.when(F.col("__st") == "new", 1).otherwise(0)).cast("long").alias("rows_inserted_new_key"),
                   F.sum(F.when(F.col("__st") == "t1", 1).otherwise(0)).cast("long").alias("rows_type1_updated"))
    out = old.unionByName(kept).unionByName(expired).unionByName(type1).unionByName(fresh.drop("__st").select(*dim_cols))
    return out, counts
