"""Keys and row identities."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.ranking import dense_index
from strata.session import ensure_checkpoint_dir

NULL_TAG = "\u0000"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def integration_key(*cols, sep: str = "~") -> Column:
    """K2: text of each field (null -> empty) joined by ``sep``."""
    return F.concat_ws(sep, *[F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols])


def row_hash(*cols) -> Column:
    """64-bit change-detection hash.  Each field is cast to text with a null
    tag, so (null, 'a') and ('a', null) hash differently and null differs from
    ''.  Compares one key's old and new row, so 64 bits is ample."""
    return F.xxhash64(*[F.coalesce(_c(c).cast("string"), F.lit(NULL_TAG)) for c in cols])


def surrogate_hash_key(*cols, sep: str = "-") -> Column:
    """md5 of the null-safe text fields joined by ``sep``."""
    return F.md5(F.concat_ws(sep, *[F.coalesce(_c(c).cast("string"), F.lit("_null_")) for c in cols]))


def scd_id(keys: Sequence[str], valid_from: str, sep: str = "|") -> Column:
    """Readable history-row id, key(s) and valid_from as text."""
    return F.concat_ws(sep, *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys],
                       F.col(valid_from).cast("string"))


def assign_surrogate_keys(new_rows: DataFrame, order_by: Sequence[str], key_name: str,
                          existing: DataFrame | None = None) -> DataFrame:
    """K3: gap-free keys above the high-water mark of ``existing`` (1 when
    there is none), in ``order_by`` order.  The maximum is a one-row
    aggregate joined in-plan; numbering uses the range-partitioned ranking
    operator, not a single-partition window."""
    if existing is None:
        return dense_index(new_rows, order_by, start=1, name=key_name)
    hw = existing.agg(F.coalesce(F.max(key_name), F.lit(0)).alias("__hw"))
    numbered = dense_index(new_rows, order_by, start=1, name="__seq")
    return (numbered.crossJoin(F.broadcast(hw))
            .withColumn(key_name, (F.col("__seq") + F.col("__hw")).cast("long"))
            .drop("__seq", "__hw"))


def lease_keys(new_rows: DataFrame, key_name: str, existing: DataFrame | None = None, block: int = 1000) -> DataFrame:
    """K3 as a sequence: unique keys above the mark of ``existing``, in no
    order and with gaps.  Each partition leases as many whole blocks as its
    rows need, so nothing is sorted or shuffled; the checkpoint fixes which
    rows a partition has, so a repeated task gives the same keys."""
    spark = new_rows.sparkSession
    ensure_checkpoint_dir(spark)
    fixed = new_rows.checkpoint(eager=True).withColumn("__pid", F.spark_partition_id())
    fixed = fixed.withColumn("__at", F.monotonically_increasing_id() - F.shiftleft(F.col("__pid").cast("long"), 33))
    mark = 0 if existing is None else existing.agg(F.coalesce(F.max(key_name), F.lit(0))).first()[0]
    leased = fixed.groupBy("__pid").agg(F.ceil(F.count("*") / block).alias("__n"))  # a row per partition
    first = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    leased = leased.select("__pid", (F.coalesce(F.sum("__n").over(first), F.lit(0)) * block).alias("__from"))
    key = F.lit(int(mark) + 1).cast("long") + F.col("__from") + F.col("__at")
    return fixed.join(F.broadcast(leased), "__pid").withColumn(key_name, key.cast("long")).drop("__pid", "__at", "__from")


def with_ghost_row(df: DataFrame, key: str, values: Mapping[str, object]) -> DataFrame:
    """K5: add one default row unless ``key`` already holds its value
    (idempotent).  Existence is a filtered global aggregate (one row), not
    a join against the whole table."""
    ghost_val = values[key]
    exists = df.where(F.col(key) == F.lit(ghost_val)).agg(F.count(F.lit(1)).alias("__n"))
    types = dict(df.dtypes)
    cols = [F.lit(v).cast(types[k]).alias(k) if k in types else F.lit(v).alias(k) for k, v in values.items()]
    ghost = exists.where(F.col("__n") == 0).select(*cols)
    return df.unionByName(ghost, allowMissingColumns=True)


def masked(col: str, role: str, clear_roles: Sequence[str] = ("OWNER",),
           hash_roles: Sequence[str] = ("DEVELOPER",), stars: str = "**********") -> Column:
    """Clear text, SHA-256 or stars depending on the caller's role
    (the role is an argument, resolved when the plan is built)."""
    if role in clear_roles:
        return F.col(col)
    if role in hash_roles:
        return F.sha2(F.col(col).cast("string"), 256)
    return F.lit(stars)


def refresh_scd_ids(history: DataFrame, keys: Sequence[str], valid_from: str = "valid_from",
                    scd_id_col: str = "scd_id", sep: str = "|") -> DataFrame:
    """K15 ``refresh_scd_id``: rewrite every row's scd id in the readable
    form (keys and valid-from joined by a pipe) - a narrow projection."""
    return history.withColumn(scd_id_col, scd_id(keys, valid_from, sep))
