"""Centroid clustering (13): incremental distance matrix.

Vectors become integers, ``floor(scale * x)``.  Each vector keeps its exact
dot product with every centroid; when the centroids of a round are known, only
their components that changed (as integers, often none) are multiplied and
added to it.  With the vector's own square and the centroid's square that
gives the exact squared distance, ``|v|^2 - 2 v.c + |c|^2``, and the nearest
centroid is taken anew (ties: smaller number).  A new centroid is the exact
floor of sum over count per component; an empty one stays.

Nothing is shuffled but ``k`` rows of sums per task, and the driver holds the
``k`` centroids alone.  The matrix is a persisted column beside its vectors; a
round reads the one before it and the older one is released.  The rounds are
narrow steps over the scan, so a lost executor's part is computed again from
the table; the result itself is cut with a checkpoint.

Defined cases: vectors that are null, have another number of components or
hold a null or a non-finite component are left out; a zero vector is a vector;
repeated rows each count and each give a row; a null id hashes as the text
``null``; among equal ids the smaller vector (component by component) starts
first; fewer than ``k`` vectors give as many centroids; no vector gives an
empty result.  So that all sums fit a long, a component beyond ``2**27`` after
scaling is an error.  Only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.graph import cut

LIMIT = 1 << 27
_STATE = "vec_id long, v array<int>, square long, products array<long>, cluster int, distance long"


class Change(NamedTuple):
    """What a round changes: for each centroid the components and by how much,
    and the centroids' squares after it."""

    components: list[np.ndarray]
    by: list[np.ndarray]
    squares: np.ndarray

    @classmethod
    def between(cls, old: list[list[int]], new: list[list[int]]) -> Change:
        moved = np.array(new, np.int64) - np.array(old, np.int64)
        at = [np.flatnonzero(m) for m in moved]
        return cls(at, [m[i] for m, i in zip(moved, at)], np.array([sum(x * x for x in c) for c in new], np.int64))


def follow(v: np.ndarray, products: np.ndarray, change: Change) -> None:
    """Brings the matrix up to date, in place."""
    for k, (at, by) in enumerate(zip(change.components, change.by)):
        if len(at):
            products[:, k] += v[:, at] @ by


def _list(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Rows of a matrix as a list column."""
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * width, width, dtype=np.int32)),
                                    pa.array(values.ravel(), kind))


def usable(embedding: Column, size: int) -> Column:
    """A vector of ``size`` finite components."""
    return F.coalesce((F.size(embedding) == size) & F.forall(embedding, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))),
                      F.lit(False))


def scaled(vectors: DataFrame, size: int, scale: int) -> DataFrame:
    """vec_id and v, the integers of every usable vector."""
    def whole(x: Column) -> Column:
        y = x.cast("double") * scale
        return (F.when(F.abs(y) <= LIMIT, F.floor(y).cast("int"))
                .otherwise(F.raise_error(F.lit("a component is too large for exact sums")).cast("int")))
    return (vectors.select("vec_id", "embedding").filter(usable(F.col("embedding"), size))
            .select("vec_id", F.transform("embedding", whole).alias("v")))


def starts(rows: DataFrame, k: int, seed: str) -> list[list[int]]:
    """The vectors of the ``k`` smallest sha256 values of ``seed:vec_id``."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null")))
    return [r.v for r in rows.select(F.sha2(text, 256).alias("h"), "v").orderBy("h", "v").limit(k).collect()]


def _step(state: DataFrame, change: Change, size: int) -> DataFrame:
    """The state after a change of centroids; rows of integers only (without
    ``products``) start a matrix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(change.squares)
        for b in batches:
            n = b.num_rows
            v = np.asarray(b.column("v").flatten()).reshape(n, size).astype(np.int64)
            if "products" in b.schema.names:
                square = np.asarray(b.column("square"))
                products = np.array(b.column("products").flatten()).reshape(n, k)
            else:
                square, products = (v * v).sum(1), np.zeros((n, k), np.int64)
            follow(v, products, change)
            distance = square[:, None] - 2 * products + change.squares
            nearest = distance.argmin(1)  # the first of equals
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), _list(v.astype(np.int32), pa.int32()), pa.array(square), _list(products, pa.int64()),
                 pa.array(nearest.astype(np.int32)), pa.array(distance[np.arange(n), nearest])],
                names=["vec_id", "v", "square", "products", "cluster", "distance"])
    return state.mapInArrow(run, _STATE)


def _sums(state: DataFrame, k: int, size: int) -> DataFrame:
    """n and component sums of each cluster: ``k`` rows a task, then summed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = np.zeros(k, np.int64), np.zeros((k, size), np.int64)
        for b in batches:
            cluster, v = np.asarray(b.column("cluster")), np.asarray(b.column("v").flatten()).reshape(-1, size)
            n += np.bincount(cluster, minlength=k)
            for c in np.unique(cluster):
                s[c] += v[cluster == c].sum(0, dtype=np.int64)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(n[some]), _list(s[some], pa.int64())], names=["cluster", "n", "s"])
    return (state.select("cluster", "v").mapInArrow(run, "cluster int, n long, s array<long>")
            .select("cluster", "n", F.posexplode("s").alias("i", "s")).groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")))


def floors(state: DataFrame, centroids: list[list[int]], size: int) -> list[list[int]]:
    """Exact floor of sum over count per component and cluster."""
    new = [list(c) for c in centroids]
    for r in _sums(state, len(centroids), size).collect():  # size rows per centroid
        new[r.cluster][r.i] = r.s // r.n
    return new


def cluster_vectors(vectors: DataFrame, k: int = 8, rounds: int = 10, size: int = 64, scale: int = 1024,
                    seed: str = "3") -> tuple[DataFrame, list[list[int]]]:
    """vec_id, cluster and squared distance of every usable vector, and the
    final centroids."""
    rows = scaled(vectors, size, scale)
    centroids = starts(rows, k, seed)
    if not centroids:
        return cut(rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))), []
    held = _step(rows, Change.between([[0] * size] * len(centroids), centroids), size).persist(StorageLevel.MEMORY_AND_DISK)
    for _ in range(rounds):
        new = floors(held, centroids, size)
        if new == centroids:  # further rounds would change nothing
            break
        after = _step(held, Change.between(centroids, new), size).persist(StorageLevel.MEMORY_AND_DISK)
        after.count()
        held.unpersist()
        held, centroids = after, new
    out = cut(held.select("vec_id", "cluster", "distance"))
    held.unpersist()
    return out, centroids


def report(vectors: DataFrame, **how) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    assigned, centroids = cluster_vectors(vectors, **how)
    inertia = {r.cluster: r.s for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    of = [(c, inertia.get(c, 0), hashlib.sha256(",".join(map(str, v)).encode()).hexdigest()) for c, v in enumerate(centroids)]
    clusters = assigned.sparkSession.createDataFrame(of, "cluster int, cluster_inertia long, centroid_sha256 string")
    return (assigned.join(F.broadcast(clusters), "cluster")
            .select("vec_id", "cluster", "distance", "cluster_inertia",
                    F.lit(sum(inertia.values())).cast("long").alias("inertia"), "centroid_sha256"))


def query(spark, sf_dir: str) -> DataFrame:
    return report(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _sql(k: int = 8, rounds: int = 10, size: int = 64, scale: int = 1024, seed: str = "3") -> str:
    """The same rounds written out, from whole distances instead of a kept
    matrix."""
    steps = [f"""v AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS rid,
        list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
        WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size})""",
             f"""c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY h, v) - 1 AS INTEGER) AS cluster, v AS c FROM
        (SELECT sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), 'null')) AS h, v FROM v ORDER BY h, v LIMIT {k}))"""]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT rid, min({{'d': CAST(list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))
            AS BIGINT), 'cluster': cluster}}) AS m FROM v, c{r} GROUP BY rid)""")
        if r < rounds:
            steps.append(f"""s{r} AS MATERIALIZED (SELECT m.cluster AS cluster, i, CAST(sum(v[i]) AS BIGINT) AS s, count(*) AS n
                FROM a{r} JOIN v USING (rid), range(1, {size + 1}) t(i) GROUP BY ALL)""")
            steps.append(f"""c{r + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(f.c, c.c) AS c FROM c{r} c LEFT JOIN
                (SELECT cluster, list((s - ((s % n + n) % n)) // n ORDER BY i) AS c FROM s{r} GROUP BY cluster) f ON f.cluster = c.cluster)""")
    return "WITH " + ",\n".join(steps) + f"""
        SELECT vec_id, m.cluster AS cluster, m.d AS distance, CAST(sum(m.d) OVER (PARTITION BY m.cluster) AS BIGINT) AS cluster_inertia,
          CAST(sum(m.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.c, ',')) AS centroid_sha256
        FROM a{rounds} JOIN v USING (rid) JOIN c{rounds} c ON c.cluster = m.cluster"""


QUERIES = {"op13_centroid_products": query}
ORACLE = {"op13_centroid_products": _sql()}
