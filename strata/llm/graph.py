"""Connected components of an edge list, by alternating star contraction.

Every round is two aggregations and two joins; lineage is cut with a reliable
checkpoint, so a lost executor never costs a round.  Nothing but a count and a
checksum reaches the driver.  Once a list is down to ``FEW_EDGES``, a
round ends in one partition and most of its exchanges go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir


FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder of ``spark.checkpoint.dir``.
    The shuffle files it was made from go at once, not when the driver next
    collects garbage: steps of many small exchanges would pile them up."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    before = spark.conf.get(FREE)
    spark.conf.set(FREE, "true")
    try:
        return df.select("*").checkpoint(eager=True)  # a plan of its own, so that no other use of df needs its files
    finally:
        spark.conf.set(FREE, before)


BROADCAST_ROWS = 200_000
#: Edges (16 bytes each) that one task contracts; longer lists stay distributed.
FEW_EDGES = 20_000


def few(keys: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """Narrow keys, cut, to be broadcast if they are at most ``most``; beyond
    that the same join is left to a shuffle."""
    keys = cut(keys)
    return F.broadcast(keys) if keys.count() <= most else keys


def _star(edges: DataFrame, larger: bool, one: bool) -> DataFrame:
    """Link the larger (or the smaller) neighbours of each node, itself
    included when linking the smaller ones, to its least neighbour; in ``one``
    partition, if wanted."""
    edges = edges.coalesce(1) if one else edges

    def each(rows: DataFrame, *pairs: tuple[str, str, str, str]) -> DataFrame:
        """A row for each pair; an explode, as a union would part one partition in two."""
        return rows.select(F.explode(F.array(*[F.struct(F.col(x).alias(p), F.col(y).alias(q)) for x, p, y, q in pairs])).alias("e")).select("e.*")
    ends = each(edges, *[("a", "u", "b", "v"), ("b", "u", "a", "v")][:1 + larger])
    least = ends.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    if larger:
        moved = ends.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = each(ends.join(least, "u"), ("v", "a", "m", "b"), ("u", "a", "m", "b"))
    moved = moved.filter("a != b")
    return (moved.coalesce(1) if one else moved).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``: the least node
    it reaches.  Null ends and loops are ignored; an empty list gives none."""
    e = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .filter("a is not null and b is not null and a != b").distinct())
    seen = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now[0] == 0 or now == seen:
            break
        seen, one = now, now[0] <= FEW_EDGES
        e = cut(_star(_star(e, True, one), False, one))
    roots = e.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
