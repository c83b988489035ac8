"""Embedding near-dedup (4): random-projection tree forest.

Vectors of one label whose cosine is at least ``LEAST_COSINE`` are linked.
``TREES`` trees cut the unit sphere: every node splits its vectors at the
median of a random projection, and vectors within ``SPILL`` of the cut go to
both sides, until a node's share of the table is small.  The cuts are fitted on
a bounded sample (``SAMPLE`` vectors by hash order); every vector is then sent
down all trees.  Vectors that share a leaf (and a label) are compared in double
precision, so links are exact and only their recall depends on the trees.

A vector stands in some dozen leaves, so it is not sent to each of them.  A
task gets a unit of at most about ``UNIT_VALUES`` components: a whole label with
all trees where that fits (a pair of it is compared once and counts if it shares
a leaf of any tree), else what one label has under a node of one tree, and finds
the leaves below by itself.  There a pair may share leaves of several trees and is
counted in the first of them only: projections are sums of whole numbers, the
same in every task, so a task that finds a link works out the leaves of the two
in all trees and can tell whether they met before; no pairs and no leaves are
shuffled.  ``ROUND`` trees are dealt at a time, which bounds the copies on disk.
A unit sends out, per vector, the number of its new links, and edges that span
its components.  Equal vectors of a label are one class with a size; what does
not part under a node (a large group of near copies) is compared in blocks, pair
of blocks by pair of blocks, so no leaf is dropped or cut however large it is.

Defined cases: a vector that is null, empty, zero or holds null or non-finite
components, and a null label, link with nothing (0 links, its own component);
vectors of different length never link; rows with a null vec_id are returned
with 0 links and a null component; rows that share a vec_id are one node, whatever
their vectors (a row that links with nothing stays alone): their components are
one, and links are counted per row of the class, without the row itself; an
empty table gives an empty result; only ``vec_id``, ``embedding`` and ``label`` are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.graph import components, cut, few

LEAST_COSINE = 0.93
TREES = 10
SPILL = 0.03  # of a unit vector's projection; a linked pair differs by 0.374 / sqrt(dimensions) or so
SAMPLE = 20_000
LEAF_ROWS = 4_000  # of all labels, as the sample has it
BLOCK = 1_024
LEAST_SAMPLE_LEAF = 16
UNIT_VALUES = 1 << 21  # components that a task compares at a time, 16 MB of doubles
ROUND = 2  # trees of which the rows are on disk at a time
WHOLE = 2.0**25  # unit vectors and directions are whole numbers of so many parts: sums of their products are exact


@dataclass(frozen=True)
class Tree:
    """Nodes in order: a direction, a cut and two children; a child under 0 is
    leaf ``-child - 1``."""

    directions: np.ndarray
    cuts: np.ndarray
    children: np.ndarray

    @property
    def top(self) -> int:
        return 0 if len(self.cuts) else -1

    def sides(self, whole: np.ndarray, node: int, own: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """The children of a node and those of its rows that go there."""
        at = whole[own] @ self.directions[node] - self.cuts[node]
        spill = SPILL * WHOLE * WHOLE
        return [(int(self.children[node][0]), own[at <= spill]), (int(self.children[node][1]), own[at > -spill])]

    def reached(self, unit: np.ndarray, node: int, ends: frozenset[int] = frozenset()) -> Iterator[tuple[int, np.ndarray]]:
        """(node, rows) of the leaves, or nodes in ``ends``, that rows reach from ``node``."""
        whole = np.rint(unit * WHOLE)
        stack = [(node, np.arange(len(unit)))]
        while stack:
            node, own = stack.pop()
            if node < 0 or node in ends:
                yield node, own
            elif len(own):
                stack += self.sides(whole, node, own)

    def leaves(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of every leaf that a vector reaches."""
        rows, found = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for node, own in self.reached(unit, self.top):
            rows.append(own)
            found.append(np.full(len(own), -node - 1))
        return np.concatenate(rows), np.concatenate(found)

    def nodes_of(self, unit: np.ndarray, rows: float, most: float) -> frozenset[int]:
        """The highest nodes that have at most ``most`` of ``rows`` vectors, of
        which ``unit`` is a sample, and the leaves beside them."""
        whole, found = np.rint(unit * WHOLE), set()
        stack = [(self.top, np.arange(len(unit)))]
        while stack:
            node, own = stack.pop()
            if node < 0 or (len(own) + 1) * rows <= most * (len(unit) + 1):
                found.add(node)
            else:
                stack += self.sides(whole, node, own)
        return frozenset(found)


def fit_tree(sample: np.ndarray, rows: int, seed: int) -> Tree:
    """Random splits of the sample's unit vectors until a leaf stands for at
    most ``LEAF_ROWS`` of ``rows``, or a split no longer parts the vectors."""
    rng = np.random.default_rng(seed)
    directions, cuts, children = [], [], []
    least = max(LEAST_SAMPLE_LEAF, LEAF_ROWS * len(sample) / max(rows, 1))
    leaves, whole, spill = 0, np.rint(sample * WHOLE), SPILL * WHOLE * WHOLE

    def grow(own: np.ndarray) -> int:
        nonlocal leaves
        if len(own) > least:
            r = rng.normal(size=sample.shape[1])
            r = np.rint(r / np.linalg.norm(r) * WHOLE)
            at = whole[own] @ r
            c = float(np.median(at))
            low, high = own[at <= c + spill], own[at > c - spill]
            if max(len(low), len(high)) <= 0.9 * len(own):
                node = len(cuts)
                directions.append(r)
                cuts.append(c)
                children.append([0, 0])
                children[node] = [grow(low), grow(high)]
                return node
        leaves += 1
        return -leaves
    if len(sample):
        grow(np.arange(len(sample)))
    d = sample.shape[1] if len(sample) else 0
    return Tree(np.array(directions).reshape(-1, d), np.array(cuts), np.array(children).reshape(-1, 2))


def cleaned(vectors: DataFrame) -> DataFrame:
    """vec_id, label and vector: the components' bytes (-0.0 as 0.0), null for
    a row that links with nothing."""
    kind = vectors.schema["embedding"].dataType.elementType.simpleString()
    v = vectors.select("vec_id", "label", "embedding" if kind in ("float", "double") else F.col("embedding").cast("array<double>").alias("embedding"))
    dtype = np.dtype(np.float32 if kind == "float" else np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                column = batch.column("embedding")
                n = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype) + dtype.type(0)  # nulls become nan
                first = np.concatenate(([0], np.cumsum(n)))
                count = [np.concatenate(([0], np.cumsum(x))) for x in (~np.isfinite(flat), flat != 0)]
                bad, some = (x[first[1:]] - x[first[:-1]] for x in count)
                able = (n > 0) & (bad == 0) & (some > 0)
                for c in ("vec_id", "label"):
                    able &= batch.column(c).is_valid().to_numpy(zero_copy_only=False)
                data = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((first * dtype.itemsize).astype(np.int32)), pa.py_buffer(flat)])
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pc.if_else(pa.array(able), data, pa.scalar(None, pa.binary()))],
                                                 names=["vec_id", "label", "vector"])
    types = {f.name: f.dataType.simpleString() for f in v.schema}
    return v.mapInArrow(run, f"vec_id {types['vec_id']}, label {types['label']}, vector binary")


def _unit(column: pa.Array | pa.ChunkedArray, dims: int, dtype: str) -> np.ndarray:
    """Unit vectors, in double precision, of vectors of ``dims`` components."""
    x = np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, dims).astype(np.float64)
    x /= np.abs(x).max(1)[:, None]
    return x / np.linalg.norm(x, axis=1)[:, None]


def fit_forest(classes: DataFrame, rows: int, large: dict[int, tuple[int, int]], trees: int, sample: int, dtype: str,
               ) -> tuple[dict[int, list[Tree]], dict[int, list[frozenset[int]]]]:
    """Trees per vector length, from at most ``sample`` vectors of each of the
    lengths that the sample meets; and, for each of the ``large`` labels
    (unit: dims and classes), the nodes of each tree that its units stand for."""
    met = classes.orderBy(F.xxhash64("least", "label"), "least").limit(sample).select("vector", "dims", "unit").toArrow()
    lengths, own = met.column("dims").to_numpy(), met.column("unit").fill_null(-1).to_numpy()
    forest = {}
    unit = {d: _unit(met.column("vector").take(pa.array(np.flatnonzero(lengths == d))), d, dtype) for d in np.unique(lengths).tolist()}
    for d, x in unit.items():
        forest[d] = [fit_tree(x, rows, t) for t in range(trees)]
    nodes = {}
    for k, (d, n) in large.items():
        x = unit[d][own[lengths == d] == k] if d in unit else np.empty((0, d))
        nodes[k] = [tree.nodes_of(x, n, max(BLOCK, UNIT_VALUES // d)) for tree in _trees(forest, d, trees)]
    return forest, nodes


def _trees(forest: dict[int, list[Tree]], dims: int, trees: int) -> list[Tree]:
    """Vectors of a length that no sampled one has are one leaf."""
    return forest.get(dims) or [Tree(np.empty((0, dims)), np.empty(0), np.empty((0, 2)))] * trees


def placed(batches: Iterator[pa.RecordBatch], forest: dict, nodes: dict, of: range, trees: int, dtype: str) -> Iterator[tuple]:
    """(batch, unit, tree, node, rows): the nodes of their label's units that rows reach."""
    for whole in batches:
        for at in range(0, whole.num_rows, 4096):
            batch = whole.slice(at, 4096)
            units = batch.column("unit").to_numpy(zero_copy_only=False)
            for k in np.unique(units).tolist():
                own = np.flatnonzero(units == k)
                dims = batch.column("dims")[int(own[0])].as_py()
                x = _unit(batch.column("vector").take(pa.array(own)), dims, dtype)
                for t in of:
                    tree = _trees(forest, dims, trees)[t]
                    for node, rows in tree.reached(x, tree.top, nodes[k][t]):
                        if len(rows):
                            yield batch, k, t, node, own[rows]


def postings(classes: DataFrame, held, blocks: dict[tuple[int, int, int], int], of: range, trees: int, dtype: str) -> DataFrame:
    """Classes of large labels, one row for each of their label's nodes that
    they reach in the trees ``of`` (where that has blocks, for each pair of them)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, k, t, node, rows in placed(batches, *held.value, of, trees, dtype):
            many = blocks.get((k, t, node), 1)
            block = batch.column("node").take(pa.array(rows)).to_numpy() * 0x9E3779B1 % (1 << 32) % many
            for other in range(many):
                low, high = np.minimum(block, other), np.maximum(block, other)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).take(pa.array(rows)) for c in ("unit", "dims", "node", "size", "vector")]
                    + [pa.array(np.full(len(rows), t, np.int32)), pa.array(np.full(len(rows), node, np.int32)),
                       *[pa.array(x.astype(np.int32)) for x in (low, high, block)]],
                    names=["unit", "dims", "node", "size", "vector", "tree", "at", "low", "high", "block"])
    return classes.select("unit", "dims", "node", "size", "vector").mapInArrow(
        run, "unit long, dims int, node long, size long, vector binary, tree int, at int, low int, high int, block int")


def rows_under(classes: DataFrame, held, trees: int, dtype: str) -> DataFrame:
    """unit, tree, at, n: the classes that stand under each node of the large labels' units."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, k, t, node, rows in placed(batches, *held.value, range(trees), trees, dtype):
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([t], pa.int32()), pa.array([node], pa.int32()), pa.array([len(rows)], pa.int64())],
                                             names=["unit", "tree", "at", "n"])
    return (classes.select("unit", "dims", "vector").mapInArrow(run, "unit long, tree int, at int, n long")
            .groupBy("unit", "tree", "at").agg(F.sum("n").alias("n")))


def _spanning(x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """Least index that each of n nodes reaches over the pairs."""
    root = np.arange(n)
    while len(x):
        low = np.minimum(root[x], root[y])
        np.minimum.at(root, x, low)
        np.minimum.at(root, y, low)
        while (root[root] != root).any():
            root = root[root]
        open_ = root[x] != root[y]
        if not open_.any():
            break
        # Hook the higher roots, too.
        rx, ry = root[x[open_]], root[y[open_]]
        np.minimum.at(root, np.maximum(rx, ry), np.minimum(rx, ry))
        x, y = x[open_], y[open_]
        while (root[root] != root).any():
            root = root[root]
    return root


class Links:
    """Links of the vectors of a unit: ``n`` of each (in rows), ``root`` of each
    one's component.  ``lists`` has the leaves (tree * 2**40 + leaf) of vectors."""

    def __init__(self, unit: np.ndarray, size: np.ndarray, least: float):
        self.unit, self.near, self.size, self.least = unit, unit.astype(np.float32), size.astype(np.float64), least
        self.off = (unit.shape[1] + 8) * 2.0**-23  # more than a product in single precision errs by
        self.n, self.root = np.zeros(len(unit)), np.arange(len(unit))
        self.found = np.zeros(len(unit), bool)

    def blocks(self, a: np.ndarray, b: np.ndarray, first: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Parts of the ``first`` of a and of b, and their products in single
        precision; if b is a, each pair once."""
        for i in range(0, first, BLOCK):
            x = a[i:min(i + BLOCK, first)]
            for j in range(i if a is b else 0, len(b), BLOCK):
                y = b[j:j + BLOCK]
                product = self.near[x] @ self.near[y].T
                if a is b and i == j:
                    product[np.tri(len(x), len(y), dtype=bool)] = -2
                yield x, y, product

    def find(self, a: np.ndarray, b: np.ndarray) -> None:
        """Marks the vectors of a and b that may link; two that are marked are not compared."""
        marked = self.found[a]
        if a is b:
            a = np.concatenate((a[~marked], a[marked]))
            compared = [(a, a, len(a) - np.count_nonzero(marked))]
        else:
            fresh = b[~self.found[b]]
            compared = [(a[~marked], b, len(a) - np.count_nonzero(marked)), (a[marked], fresh, np.count_nonzero(marked))]
        for x, y, n in compared:
            for part, other, product in self.blocks(x, y, n):
                hit = product >= self.least - self.off
                if hit.any():
                    self.found[part] |= hit.any(1)
                    self.found[other] |= hit.any(0)

    def count(self, a: np.ndarray, b: np.ndarray, first: int, last: int, leaves: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]) -> None:
        """Counts the links of marked pairs that share one of the leaves ``first`` to ``last`` and none before."""
        rows = np.flatnonzero(self.found)
        if not len(rows):
            return
        own, codes = leaves(self.unit[rows])
        order = np.lexsort((codes, own))
        own, codes = own[order], codes[order]
        start = np.searchsorted(own, np.arange(len(rows) + 1))
        self.lists = np.full((len(rows), int(np.diff(start).max())), -1)
        self.lists[own, np.arange(len(own)) - start[own]] = codes
        self.place = np.zeros(len(self.found), np.int64)
        self.place[rows] = np.arange(len(rows))
        same, a = a is b, a[self.found[a]]
        a = a[np.argsort(self.lists[self.place[a], 0], kind="stable")]  # near copies side by side
        b = a if same else b[self.found[b]]
        for x, y, product in self.blocks(a, b, len(a)):
            hit = product >= self.least - self.off
            p, q = np.nonzero(hit & (product < self.least + self.off))
            for i in range(0, len(p), 100_000):  # too close for single precision
                u, v = p[i:i + 100_000], q[i:i + 100_000]
                hit[u, v] = np.einsum("ij,ij->i", self.unit[x[u]], self.unit[y[v]]) >= self.least
            if hit.any():
                self.add(x, y, hit, first, last)

    def add(self, a: np.ndarray, b: np.ndarray, hit: np.ndarray, first: int, last: int) -> None:
        p, q = hit.any(1), hit.any(0)
        a, b, hit = a[p], b[q], hit[p][:, q]
        u, v = self.lists[self.place[a]], self.lists[self.place[b]]
        hit &= ~_shared(hit, *[np.where(x < first, x, -1) for x in (u, v)])
        hit &= _shared(hit, *[np.where((x >= first) & (x <= last), x, -1) for x in (u, v)])
        if np.count_nonzero(hit) * 16 > hit.size:
            self.n[a] += hit @ self.size[b]
            self.n[b] += self.size[a] @ hit
            x = np.flatnonzero(hit.any(1))
            self.join(a[x], b[hit[x].argmax(1)])
            x, y = np.nonzero(hit & (self.root[a][:, None] != self.root[b]))
        else:
            x, y = np.nonzero(hit)
            np.add.at(self.n, a[x], self.size[b[y]])
            np.add.at(self.n, b[y], self.size[a[x]])
        self.join(a[x], b[y])

    def join(self, x: np.ndarray, y: np.ndarray) -> None:
        x, y = self.root[x], self.root[y]
        if (x != y).any():
            self.root = _spanning(x[x != y], y[x != y], len(self.root))[self.root]

    def table(self, node: np.ndarray) -> pa.Table:
        out = np.flatnonzero(self.n > 0)
        return pa.table({"node": node[out], "links": self.n[out].astype(np.int64), "other": node[self.root[out]]})


def _has(lists: np.ndarray, leaves: np.ndarray) -> np.ndarray:
    """1 where a list (row) has a leaf (column)."""
    out = np.zeros((len(lists), len(leaves)), np.float32)
    at = np.minimum(np.searchsorted(leaves, lists), len(leaves) - 1)
    x, y = np.nonzero(leaves[at] == lists)
    out[x, at[x, y]] = 1
    return out


def _shared(hit: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Which of the pairs in ``hit`` have a leaf in the lists of both.  Products
    find those that share the commonest leaves, as long as that takes less (in
    nanoseconds, about) than the lists of the others pair by pair."""
    (x, n), (y, m) = (np.unique(z[z >= 0], return_counts=True) for z in (u, v))
    both, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    both = both[np.argsort(-n[i] * m[j], kind="stable")]
    met, at = np.zeros(hit.shape, bool), 0
    rest = np.count_nonzero(hit)
    while at < len(both) and hit.size * 20 < rest * u.shape[1] * v.shape[1]:
        part = np.sort(both[at:at + 64])
        met |= _has(u, part) @ _has(v, part).T > 0.5
        rest, at = np.count_nonzero(hit & ~met), at + 64
    if rest and at < len(both):
        x, y = np.nonzero(hit & ~met)
        # Columns without a leaf say nothing.
        u, v = u[:, (u >= 0).any(0)], np.where(v < 0, -2, v)[:, (v >= 0).any(0)]
        for i in range(0, len(x), 100_000):
            s, t = u[x[i:i + 100_000]], v[y[i:i + 100_000]]
            shared = np.zeros(len(s), bool)
            for k in range(s.shape[1]):
                shared |= (s[:, k:k + 1] == t).any(1)
            met[x[i:i + 100_000], y[i:i + 100_000]] = shared
    return met


def links_in_units(posted: DataFrame, held, trees: int, dtype: str, least: float) -> DataFrame:
    """node, links, other: new links of each class in each unit (counted in rows)
    and, in ``other``, a class of its component there.  Units are labels if
    ``posted`` has no ``tree``."""
    label = "tree" not in posted.columns

    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        dims = table.column("dims")[0].as_py()
        unit = _unit(table.column("vector"), dims, dtype)
        links = Links(unit, table.column("size").to_numpy(), least)
        own = _trees(held.value[0], dims, trees)
        before = own if label else own[:key[1].as_py() + 1]

        def leaves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            met = [tree.leaves(x) for tree in before]
            return np.concatenate([r for r, _ in met]), np.concatenate([k + (t << 40) for t, (_, k) in enumerate(met)])
        if label:
            every = np.arange(len(unit))
            links.find(every, every)
            links.count(every, every, 0, trees << 40, leaves)
        else:
            _, t, node, low, high = (k.as_py() for k in key)
            block = table.column("block").to_numpy()

            def sides(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                return (rows, rows) if low == high else (rows[block[rows] == low], rows[block[rows] == high])
            under = []  # in the order of depth first, so their numbers have no gap
            for x, rows in own[t].reached(unit, node):
                under.append((t << 40) - x - 1)
                links.find(*sides(rows))
            links.count(*sides(np.arange(len(unit))), min(under), max(under), leaves)
        return links.table(table.column("node").to_numpy())
    keys = ["label", "dims"] if label else ["unit", "tree", "at", "low", "high"]
    return posted.groupBy(*keys).applyInArrow(compare, "node long, links long, other long")


def links_of(classes: DataFrame, width: int, least: float, trees: int, sample: int) -> DataFrame:
    """node, links, other of all units."""
    dtype = "f4" if width == 4 else "f8"
    sc = classes.sparkSession.sparkContext
    classes = classes.withColumn("dims", (F.length("vector") / width).cast("int"))
    n, by = classes.count(), classes.groupBy("label", "dims").agg(F.count("*").alias("__n"))
    most = F.greatest(F.lit(BLOCK), F.floor(F.lit(UNIT_VALUES) / F.col("dims")))
    large = few(by.filter(F.col("__n") > most).withColumn("unit", F.monotonically_increasing_id()))
    sizes = {r.unit: (r.dims, r["__n"]) for r in large.collect()}  # at most one for each UNIT_VALUES components
    marked = classes.join(large.drop("__n"), ["label", "dims"], "left")
    held = sc.broadcast(fit_forest(marked, n, sizes, trees, sample, dtype))  # bounded by the sample
    parts = max(4 * sc.defaultParallelism, 2 * n // max(BLOCK, 4 * LEAF_ROWS))
    found = cut(links_in_units(marked.filter("unit is null").select("label", "dims", "node", "size", "vector").repartition(parts, "label", "dims"),
                               held, trees, dtype, least))
    if sizes:
        own = marked.filter("unit is not null")
        over = rows_under(own, held, trees, dtype).collect()  # some rows for each of UNIT_VALUES components
        blocks = {(r.unit, r.tree, r.at): -(-r.n // max(BLOCK, UNIT_VALUES // sizes[r.unit][0])) for r in over}
        blocks = {k: many for k, many in blocks.items() if many > 1}
        for t in range(0, trees, ROUND):
            posted = postings(own, held, blocks, range(t, min(t + ROUND, trees)), trees, dtype)
            found = found.union(cut(links_in_units(posted.repartition(parts, "unit", "tree", "at", "low", "high"), held, trees, dtype, least)))
    return found


def same_vector(members: DataFrame) -> DataFrame:
    """Links (a, b) between the classes that rows of one vec_id stand in."""
    several = (members.groupBy("vec_id").agg(F.min("node").alias("x"), F.max("node").alias("y"))
               .filter("x != y").select("vec_id", "x"))
    return members.join(several, "vec_id").select(F.col("node").alias("a"), F.col("x").alias("b"))


def near_vectors(vectors: DataFrame, least: float = LEAST_COSINE, trees: int = TREES, sample: int = SAMPLE) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    v = cleaned(vectors)
    fine, rest = v.filter("vector is not null"), v.filter("vector is null")
    width = 4 if vectors.schema["embedding"].dataType.elementType.simpleString() == "float" else 8
    # Equal vectors of a label are one class.  Classes are numbered, as the least vec_id of two of them may be the same.
    classes = cut(fine.groupBy("label", "vector").agg(F.min("vec_id").alias("least"), F.count("*").alias("size"))
                  .withColumn("node", F.monotonically_increasing_id()))
    hashed = F.xxhash64("vector").alias("__hash")  # rows are sorted by it first
    members = cut(fine.select(hashed, "*").join(classes.select(hashed, "label", "vector", "node"), ["__hash", "label", "vector"]).select("vec_id", "node"))
    found = links_of(classes, width, least, trees, sample)
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    reached = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")).union(same_vector(members)))
    homes = (classes.select("node", "least", "size").join(links, "node", "left").join(reached, "node", "left")
             .select("node", "least", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
                     F.coalesce("component", "node").alias("component")))
    names = homes.groupBy("component").agg(F.min("least").alias("component_id"))
    known = homes.join(names, "component").select("node", "n_links", "component_id")
    return (members.join(known, "node").select("vec_id", "n_links", "component_id")
            .union(rest.select("vec_id", F.lit(0).cast("long"), "vec_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))


def query(spark, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {"op4_projection_forest": query}
#: All pairs of a label; for tables of some thousand vectors.
SQL = f"""
WITH RECURSIVE able AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM able a JOIN able b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE CASE WHEN len(a.v) = len(b.v) THEN list_cosine_similarity(a.v, b.v) END >= {LEAST_COSINE}),
reached AS (SELECT vec_id, vec_id AS r FROM embeddings UNION SELECT reached.vec_id, links.b FROM reached JOIN links ON links.a = reached.r),
least AS (SELECT vec_id, min(r) AS component_id FROM reached GROUP BY vec_id),
degree AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least USING (vec_id) LEFT JOIN degree USING (vec_id)
"""
ORACLE: dict[str, str] = {"op4_projection_forest": SQL}
