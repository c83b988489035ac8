"""Keep one row per key (K19, W11) without a window over whole groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_one_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None,
                     descending: bool = False) -> DataFrame:
    """One row per ``keys``: the row with the smallest (or, with
    ``descending``, largest) ``order_by`` tuple, remaining columns breaking
    ties, so the choice is deterministic.

    ``groupBy + min(struct)`` is a hash aggregate with map-side partial
    aggregation: a key holding a third of all rows is reduced in every map
    task before the shuffle, unlike a ``row_number`` window that sorts the
    whole group in one task.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order_by = list(order_by or [])
    tail = [c for c in rest if c not in order_by]
    packed = F.struct(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order_by)],
                      *[F.col(c) for c in tail])
    agg = F.max(packed) if descending else F.min(packed)
    out = df.groupBy(*keys).agg(agg.alias("__row"))
    sel = [F.col(k) for k in keys]
    for c in rest:
        if c in order_by:
            sel.append(F.col(f"__row.__o{order_by.index(c)}").alias(c))
        else:
            sel.append(F.col(f"__row.{c}").alias(c))
    return out.select(*sel).select(*df.columns)
