"""Sharding (6): hierarchical weighted hash tree.

A row descends region, rack and shard.  At each level every child draws
``-ln(u) / weight`` with u from a hash of (row key, child), and the smallest
draw wins, so children are chosen in proportion to their weights and a change
of weights moves rows only into or out of the subtrees whose weights changed.
A tree grows by a region of its own (``Tree.grown``): no other weight changes,
so every moved row goes into the new shard.  Law: ``key`` - the key and the
tree decide, nothing else in the table does.

Native: DataFrame functions only.  The draws are a few md5 values per row; no
shuffle is needed to place rows.  Slots (gapless in a shard) come from a count
per (shard, bucket) and a row number inside each bucket: buckets hold about
``ROWS_PER_BUCKET`` rows whatever the size of a shard, so no task ever holds a
shard.  Buckets are hash ranges of the key, so equal texts spread like others.

Defined cases: a null text has no bytes and crc32 0 (that of the empty text);
a null key draws as the text ``null``; repeated rows are placed alike and each
gets its own slot; an empty table gives an empty result.  Only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 10_000


@dataclass(frozen=True)
class Tree:
    """``regions[r][k][s]``: weight of the s-th shard of rack k in region r.
    Shards are numbered from 0 in that order."""

    regions: tuple[tuple[tuple[float, ...], ...], ...]

    @classmethod
    def even(cls, regions: int, racks: int, shards: int) -> Tree:
        return cls(tuple(tuple((1.0,) * shards for _ in range(racks)) for _ in range(regions)))

    def grown(self, weight: float = 1.0) -> Tree:
        """With one more shard, in a region of its own."""
        return Tree((*self.regions, ((float(weight),),)))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row."""
    return F.transform(F.array(value), body)[0]


def _descend(path: Column, children: Column) -> Column:
    """Index of the child that wins among ``children`` (their weights).  u
    comes from the first 52 bits of an md5 value of path and index, over 0."""
    def draw(weight: Column, i: Column) -> Column:
        bits = F.conv(F.substring(F.md5(F.concat(path, F.lit("/"), i.cast("string"))), 1, 13), 16, 10).cast("long")
        return F.struct((-F.ln((bits + 1) / F.lit(float(2 ** 52 + 1))) / weight).alias("draw"), i.alias("i"))
    return F.array_min(F.transform(children, draw))["i"]  # the first of equals


def _weights(nodes: list[list[float]]) -> Column:
    return F.array(*[F.array(*[F.lit(float(w)) for w in node]) for node in nodes])


def place(df: DataFrame, tree: Tree, key: Column, out: str) -> DataFrame:
    """Adds ``out``: the shard of each row."""
    racks = [list(rack) for region in tree.regions for rack in region]
    first_rack = F.array(*[F.lit(sum(map(len, tree.regions[:r]))) for r in range(len(tree.regions))])
    first_shard = F.array(*[F.lit(sum(map(len, racks[:k]))) for k in range(len(racks))])
    by_region = _weights([[sum(rack) for rack in region] for region in tree.regions])
    k = F.coalesce(key.cast("string"), F.lit("null"))

    def child(*at: Column) -> Column:
        return F.concat_ws("/", k, *[x.cast("string") for x in at])

    def shard(region: Column, rack: Column) -> Column:
        return _let(F.get(first_rack, region) + rack, lambda i: F.get(first_shard, i) + _descend(child(region, rack), F.get(_weights(racks), i)))
    top = _descend(child(), F.array(*[F.lit(float(sum(map(sum, r)))) for r in tree.regions]))
    return df.withColumn(out, _let(top, lambda region: _let(
        _descend(child(region), F.get(by_region, region)), lambda rack: shard(region, rack))).cast("int"))


def with_slots(df: DataFrame, shard: str, key: str, *ties: str) -> DataFrame:
    """Adds ``slot``: 0, 1, ... within each shard, by bucket and key."""
    n = df.count()
    buckets = max(1, -(-n // ROWS_PER_BUCKET))
    df = df.withColumn("__bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
    counts = df.groupBy(shard, "__bucket").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(shard).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(shard, "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    own = Window.partitionBy(shard, "__bucket").orderBy(key, *ties)
    return (df.withColumn("__own", F.row_number().over(own)).join(offsets, [shard, "__bucket"])
            .withColumn("slot", F.col("__before") + F.col("__own") - 1).drop("__bucket", "__own", "__before"))


def assign_shards(docs: DataFrame, tree: Tree) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard per row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
                     F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"))
    df = place(place(df, tree, F.col("doc_id"), "shard"), tree.grown(), F.col("doc_id"), "grown_shard")
    return (with_slots(df, "shard", "doc_id", "size", "text_crc32")
            .select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"))


#: Two regions of three racks of four shards.
TREE = Tree.even(2, 3, 4)


def query(spark, sf_dir: str) -> DataFrame:
    return assign_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"), TREE)


QUERIES = {"op6_hash_tree_shards": query}
ORACLE: dict[str, str] = {}  # DuckDB has no crc32; brute force in tests/llm
