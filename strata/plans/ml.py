"""M1: k-means customer clustering, all starts in one pass per round.

The features become integers (units of 1/65536 of a standard deviation), so
sums of a cluster are exact and a centre is the floor of sum over count:
nothing depends on how rows are partitioned, and SQL can recompute every round
from the given centres.  One aggregation over the rows serves all starts that
still move; the driver holds ``n_init * k`` centres.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.numeric import cents
from strata.operators.ranking import exact_quantile
from strata.plans import silver
from strata.session import RunContext

FEATURES = ("account_balance", "balance_percentile", "balance_rank_in_nation")
# Cluster names, given to clusters in descending order of mean
# balance (cluster numbers from k-means are arbitrary).
KMEANS_CLUSTER_NAMES = ("Premium Elite", "High Value Stable", "Growth Potential", "Standard Base", "At Risk")
UNIT = 1 << 16
#: Stop when a start's centres move less than this in all (a squared distance
#: of 1e-4 standard deviations).
TOLERANCE = UNIT * UNIT // 10_000


def standard_units(seg: DataFrame) -> list[Column]:
    """The three features: missing ones as the mean, less the mean, over the
    population standard deviation, in whole units.  The statistics are exact
    integers (one row)."""
    raw = [cents("account_balance"), F.rint(F.col("balance_percentile") * 1_000_000).cast("long"),
           F.col("balance_rank_in_nation").cast("long")]
    wide = [x.cast("decimal(20,0)") for x in raw]
    stats = seg.agg(F.count("*").alias("rows"), *[f for i, x in enumerate(wide) for f in (
        F.count(x).alias(f"n{i}"), F.sum(x).alias(f"s{i}"), F.sum((x * x).cast("decimal(38,0)")).alias(f"q{i}"))]).first()
    out = []
    for i, x in enumerate(raw):
        n, s, q = (int(stats[f"{c}{i}"] or 0) for c in "nsq")
        spread = float(q * n - s * s) / float(n * stats["rows"]) if n else 0.0
        if spread <= 0:
            out.append(F.lit(0).cast("long"))
            continue
        z = (F.coalesce(x.cast("double"), F.lit(float(s) / float(n))) - F.lit(float(s) / float(n))) / F.lit(spread ** 0.5)
        out.append(F.rint(z * UNIT).cast("long"))
    return out


def _squared(centre: Sequence[int], at: Sequence[str]) -> Column:
    out = F.lit(0).cast("long")
    for x, c in zip(at, centre):
        out = out + (F.col(x) - F.lit(int(c)).cast("long")) * (F.col(x) - F.lit(int(c)).cast("long"))
    return out


def nearest(centres: Sequence[Sequence[int]], at: Sequence[str]) -> Column:
    """(d, k): squared distance and number of the nearest centre (ties: the
    smaller number)."""
    return F.array_min(F.array(*[F.struct(_squared(c, at).alias("d"), F.lit(i).alias("k")) for i, c in enumerate(centres)]))


def first_centres(rows: DataFrame, key: str, at: Sequence[str], k: int, starts: int, seed: int) -> list[list[list[int]]]:
    """For each start the rows of the ``k`` smallest md5 values of its number
    and the key."""
    draws = None
    for i in range(starts):
        drawn = rows.select(F.lit(i).alias("start"), F.md5(F.concat(F.lit(f"{seed + i}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
                                                           .cast("binary")).alias("h"), *at).orderBy("h", *at).limit(k)
        draws = drawn if draws is None else draws.unionByName(drawn)
    out: list[list[list[int]]] = [[] for _ in range(starts)]
    for r in sorted(draws.collect(), key=lambda r: (r["start"], r["h"], *[r[x] for x in at])):
        out[r["start"]].append([r[x] for x in at])
    return out


def _sums(rows: DataFrame, at: Sequence[str], centres: dict[int, list[list[int]]]) -> list:
    """n, component sums and total squared distance of each cluster of the
    given starts: at most starts x k rows a task, then summed."""
    given = {i: np.array(c, np.int64) for i, c in centres.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for b in batches:
            x = np.stack([np.asarray(b.column(c)) for c in at], 1).astype(np.int64)
            for i, c in given.items():
                d = np.stack([((x - one) ** 2).sum(1) for one in c], 1)
                own = d.argmin(1)  # the first of equals
                cost = d[np.arange(len(x)), own]
                for k in np.unique(own):
                    mine = own == k
                    new = (int(mine.sum()), *x[mine].sum(0).tolist(), int(cost[mine].sum()))
                    held[i, int(k)] = tuple(map(sum, zip(held.get((i, int(k)), (0,) * len(new)), new)))
        out = [(i, k, *v[:-1], Decimal(v[-1])) for (i, k), v in held.items()]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), kinds)], names=names)
    names = ["start", "cluster", "n", *at, "cost"]
    kinds = [pa.int32(), pa.int32(), *[pa.int64()] * (1 + len(at)), pa.decimal128(38, 0)]
    schema = "start int, cluster int, n long, " + "".join(f"{c} long, " for c in at) + "cost decimal(38,0)"
    parts = rows.select(*at).mapInArrow(run, schema)
    return parts.groupBy("start", "cluster").agg(*[F.sum(c).alias(c) for c in names[2:]]).collect()


def lloyd(rows: DataFrame, at: Sequence[str], centres: list[list[list[int]]], max_iter: int, tolerance: int = TOLERANCE) -> list[list[int]]:
    """Rounds of all starts together, until each is still or ``max_iter``
    rounds have run, one scan and one aggregation a round; the centres of the
    start of least total squared distance (ties: the earlier one)."""
    centres = [[list(c) for c in start] for start in centres]
    moving = [i for i, start in enumerate(centres) if start]
    for _ in range(max_iter):
        if not moving:
            break
        shift = dict.fromkeys(moving, 0)
        for r in _sums(rows, at, {i: centres[i] for i in moving}):
            new = [r[x] // r["n"] for x in at]
            shift[r["start"]] += sum((a - b) ** 2 for a, b in zip(new, centres[r["start"]][r["cluster"]]))
            centres[r["start"]][r["cluster"]] = new
        moving = [i for i in moving if shift[i] > tolerance]
    cost = dict.fromkeys(range(len(centres)), 0)
    for r in _sums(rows, at, dict(enumerate(centres))):
        cost[r["start"]] += int(r["cost"])
    return centres[min(cost, key=lambda i: (cost[i], i))]


def customer_clustering_kmeans(cat, ctx: RunContext = RunContext(), segments: DataFrame | None = None,
                               k: int = 5, seed: int = 42, n_init: int = 10, max_iter: int = 300,
                               outlier_quantile: float = 0.95) -> DataFrame:
    """Mean-impute the three features, standardise them with the population
    standard deviation, run k-means from ``n_init`` starts and keep the one of
    lowest cost; then distance to the own centre, outlier above the
    ``outlier_quantile`` of distances, confidence 1 - d / max(d)."""
    seg = segments if segments is not None else silver.customer_segments(cat, ctx)
    at = ["__x0", "__x1", "__x2"]
    x = seg.select("*", *[u.alias(a) for u, a in zip(standard_units(seg), at)])
    rows = x.select("customer_key", *at).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        centres = first_centres(rows, "customer_key", at, k, n_init, seed)
        if not centres[0]:
            centres = [[[0, 0, 0]]]
        best = lloyd(rows, at, centres, max_iter)
    finally:
        rows.unpersist()
    pred = (x.withColumn("__near", nearest(best, at)).withColumn("__cluster", F.col("__near.k"))
            .withColumn("distance_to_cluster_center", F.sqrt(F.col("__near.d").cast("double")) / float(UNIT)))
    # Name clusters by descending mean balance (k rows).
    means = pred.groupBy("__cluster").agg((F.sum(cents("account_balance")) / F.count("account_balance")).alias("m")).collect()
    order = [r["__cluster"] for r in sorted(means, key=lambda r: (r["m"] is None, -(r["m"] or 0), r["__cluster"]))]
    place = {c: i for i, c in enumerate(order)}
    names = F.array(*[F.lit(n) for n in silver.cluster_names(KMEANS_CLUSTER_NAMES, k)])
    places = F.array(*[F.lit(place.get(c, len(best) - 1)) for c in range(len(best))])
    pred = pred.withColumn("ml_cluster", F.element_at(places, F.col("__cluster") + 1))
    cut = exact_quantile(pred, "distance_to_cluster_center", outlier_quantile, "__cut")
    mx = pred.agg(F.max("distance_to_cluster_center").alias("__dmax"))
    out = pred.crossJoin(F.broadcast(cut)).crossJoin(F.broadcast(mx))  # one-row frames
    d = F.col("distance_to_cluster_center")
    return out.select(
        "customer_key", "customer_name", "nation_key", "account_balance", "balance_percentile",
        "balance_rank_in_nation", "customer_segment", "market_segment", "ml_cluster",
        F.element_at(names, F.col("ml_cluster") + 1).alias("cluster_name"),
        d.alias("distance_to_cluster_center"),
        (d > F.col("__cut")).alias("is_cluster_outlier"),
        (F.lit(1.0) - d / F.nullif(F.col("__dmax"), F.lit(0.0))).alias("ml_confidence_score"),
        F.lit("1.0").alias("ml_model_version"), F.lit("KMeans").alias("clustering_algorithm"),
        F.lit(k).alias("n_clusters_used"), F.lit(str(list(FEATURES))).alias("features_used"))
