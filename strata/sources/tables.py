"""Typed scans of the source tables.

Scans use an explicit schema, so no inference job runs and a drifted file
fails at read time instead of producing wrong columns downstream.  Column
pruning and filter pushdown into the Parquet reader are left to Catalyst:
callers select/filter the returned frame and `explain()` shows
``ReadSchema``/``PushedFilters``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_L, _I, _D, _S, _TS = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


SCHEMAS: dict[str, T.StructType] = {
    "region": _schema(("r_regionkey", _I), ("r_name", _S)),
    "nation": _schema(("n_nationkey", _I), ("n_name", _S), ("n_regionkey", _I)),
    "customer": _schema(("c_custkey", _L), ("c_name", _S), ("c_nationkey", _I),
                        ("c_acctbal", _D), ("c_mktsegment", _S)),
    "supplier": _schema(("s_suppkey", _L), ("s_name", _S), ("s_nationkey", _I), ("s_acctbal", _D)),
    "part": _schema(("p_partkey", _L), ("p_name", _S), ("p_brand", _S), ("p_type", _S),
                    ("p_size", _I), ("p_retailprice", _D)),
    "orders": _schema(("o_orderkey", _L), ("o_custkey", _L), ("o_orderstatus", _S),
                      ("o_totalprice", _D), ("o_orderdate", _TS), ("o_orderpriority", _S)),
    "lineitem": _schema(("l_orderkey", _L), ("l_partkey", _L), ("l_suppkey", _L),
                        ("l_linenumber", _I), ("l_quantity", _D), ("l_extendedprice", _D),
                        ("l_discount", _D), ("l_tax", _D), ("l_returnflag", _S),
                        ("l_linestatus", _S), ("l_shipdate", _TS)),
    "events": _schema(("event_id", _L), ("ts", _TS), ("user_id", _L), ("event_type", _S),
                      ("value", _D), ("props", _S)),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Catalog:
    """Lazy accessor: ``Catalog(spark, dir).orders`` is a fresh scan each time
    (scans are cheap plan nodes; Catalyst dedups identical subtrees)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return read_table(self.spark, self.sf_dir, name)


class FrameCatalog(Catalog):
    """Catalog whose named tables are given frames (for example one
    micro-batch, or a pre-filtered slice); other names fall back to scans of
    ``sf_dir`` when one is given."""

    def __init__(self, spark: SparkSession, frames: dict[str, DataFrame], sf_dir: str | None = None):
        super().__init__(spark, sf_dir or "")
        self._frames = dict(frames)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name in self._frames:
            return self._frames[name]
        if not self.sf_dir:
            raise AttributeError(f"no frame named {name}")
        return read_table(self.spark, self.sf_dir, name)
