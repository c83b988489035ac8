"""Change capture and change-log consumption."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.dedup import keep_one_per_key
from strata.operators.keys import assign_surrogate_keys, row_hash

CHANGE_TYPE, COMMIT_TS, VERSION = "cdc_change_type", "cdc_commit_ts", "cdc_version"


def change_feed(before: DataFrame | None, after: DataFrame, keys: Sequence[str], commit_ts: Column,
                version: Column | None = None, value_cols: Sequence[str] | None = None) -> DataFrame:
    """K9 table stream between two snapshots: INSERT, DELETE, and
    UPDATE_BEFORE/UPDATE_AFTER pairs for changed rows (row hash over
    ``value_cols``).  ``before=None`` shows the initial rows as inserts.
    One full outer join on the keys (a null key is a key like any other)
    and one explode of each pair's changes."""
    keys = list(keys)
    cols = after.columns
    vals = list(value_cols or [c for c in cols if c not in keys])
    ver = version if version is not None else F.lit(None).cast("string")
    if before is None:
        return after.select(*cols, F.lit("INSERT").alias(CHANGE_TYPE), commit_ts.alias(COMMIT_TS),
                            ver.cast("string").alias(VERSION))
    b = before.select(*cols, row_hash(*vals).alias("__h")).alias("__b")
    a = after.select(*cols, row_hash(*vals).alias("__h")).alias("__a")
    j = b.join(a, [F.col(f"__b.{k}").eqNullSafe(F.col(f"__a.{k}")) for k in keys], "full_outer")
    in_b, in_a = F.col("__b.__h").isNotNull(), F.col("__a.__h").isNotNull()  # a row hash is never null

    def change(side: str, kind: str) -> Column:
        return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in cols], F.lit(kind).alias(CHANGE_TYPE))
    changes = (F.when(in_a & ~in_b, F.array(change("__a", "INSERT"))).when(in_b & ~in_a, F.array(change("__b", "DELETE")))
               .when(F.col("__b.__h") != F.col("__a.__h"), F.array(change("__b", "UPDATE_BEFORE"), change("__a", "UPDATE_AFTER"))))
    out = j.select(F.explode(changes).alias("__c")).select("__c.*")
    return out.withColumn(COMMIT_TS, commit_ts).withColumn(VERSION, ver.cast("string"))


# Tie order when a key has several changes at one commit
# time; the insert side wins over a delete (higher wins).
_TYPE_PRIORITY = (("UPDATE_BEFORE", 0), ("DELETE", 1), ("UPDATE_AFTER", 2), ("INSERT", 3))


def consume_changes(changes: DataFrame, keys: Sequence[str], existing_log: DataFrame | None = None,
                    log_id: str = "log_id") -> DataFrame:
    """Drop the before-image half of updates, keep the newest change per
    key (insert side beats delete on equal commit time), flag deletes, and
    number the rows above the log's high-water mark by (commit time, keys)."""
    keys = list(keys)
    prio = F.lit(None).cast("int")
    for t, p in _TYPE_PRIORITY:
        prio = F.when(F.col(CHANGE_TYPE) == t, F.lit(p)).otherwise(prio)
    c = changes.where(F.col(CHANGE_TYPE) != "UPDATE_BEFORE").withColumn("__prio", prio)
    latest = keep_one_per_key(c, keys, order_by=[COMMIT_TS, "__prio"], descending=True).drop("__prio")
    latest = latest.withColumn("delete_flag", F.when(F.col(CHANGE_TYPE) == "DELETE", "Y").otherwise("N"))
    out = assign_surrogate_keys(latest, [COMMIT_TS, *keys], log_id, existing_log)
    return out.select(log_id, *[x for x in out.columns if x != log_id])
