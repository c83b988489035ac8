"""MinHash near-dedup (5): signature-coordinate inverted join.

A document is its set of distinct shingles (two words, A-Z lower-cased; fewer
words make one shingle).  Equal sets are one class.  Each class has
``COORDINATES`` MinHash values and is posted under (coordinate, value) pairs.
Pairs of classes that agree in at least ``LEAST_MATCHES`` coordinates are
candidates.  Two such classes share one of the ``COORDINATES - LEAST_MATCHES
+ 1`` rarest postings of either (prefix), and postings that only one class has
are skipped at once, so most documents post nothing.  Lists are merged in steps that skip
what is known: at first every class of a list meets one hub of the list only;
then, with the components found, other hubs; at last the classes of lists that
still hold several components meet, across components only, so that no link
between components is lost.  A large group of near copies is thus linked by
stars and not by all its pairs.  Candidates whose collisions reach the
threshold are confirmed on their full shingle sets.

A pair at the least similarity of 0.8 misses ``LEAST_MATCHES`` of 32 matches
with a probability of 3 in 100,000, a closer one far less often; whatever is
confirmed is exact.

Defined cases: a document without words, or with a null text, has an empty set
and is linked with nothing; a null doc_id is linked with nothing, has a null
component and is kept; rows that share a doc_id are one node, whatever their
texts; equal rows get equal results; an empty table gives an empty result; only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.arrays import Words, chunks, gram_hashes, grams_inside, mix, tidied
from strata.llm.graph import components, cut, few

COORDINATES = 32
LEAST_MATCHES = 16
STAR_STEPS = 2  # steps with one hub a list, before the one across components
LARGE_LIST = 64  # classes of a longer list meet with their full sets at hand
LARGE_MATCHES = 12  # fewer equal coordinates are not looked at there (a pair of similarity 0.8: once in 40 million)
BLOCK, BLOCK_SHINGLES = 1024, 1 << 21
PREFIX = COORDINATES - LEAST_MATCHES + 1
_SEEDS = np.random.default_rng(5).integers(1, 1 << 63, (COORDINATES, 2)).astype(np.uint64)


def shingle_sets(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, document by document, and their offsets."""
    w = Words(texts, lower=True)
    h = w.hashes()
    inside = grams_inside(w.doc, words)
    grams, doc = gram_hashes(h, words)[inside], w.doc[:len(inside)][inside]
    n = np.diff(w.first)
    short = np.flatnonzero((n > 0) & (n < words))  # the whole sequence is one shingle
    if len(short):
        whole = [int(gram_hashes(h[w.first[i]:w.first[i + 1]], n[i])[0]) for i in short]
        grams, doc = np.concatenate((grams, np.array(whole, np.uint64))), np.concatenate((doc, short))
    order = np.lexsort((grams, doc))
    grams, doc = grams[order], doc[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (doc[1:] != doc[:-1])
    grams, doc = grams[new], doc[new]
    return grams, np.searchsorted(doc, np.arange(len(texts) + 1))


def signatures(docs: DataFrame, words: int = 2) -> DataFrame:
    """doc_id, n_shingles, low/high (hash of the set), signature (null if the
    set is empty)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            grams, first = shingle_sets(texts, words)
            n = np.diff(first)
            full = np.flatnonzero(n)
            at = first[:-1][full]
            keys, sig = np.zeros((2, len(texts)), np.uint64), np.zeros((len(full), COORDINATES), np.uint32)
            if len(full):
                for k in range(2):
                    keys[k, full] = np.add.reduceat(mix(grams + np.uint64(k + 1)), at)
                for k, (a, b) in enumerate(_SEEDS):
                    sig[:, k] = np.minimum.reduceat(((grams ^ a) * (b | np.uint64(1))) >> np.uint64(32), at)
            offsets = np.concatenate(([0], np.cumsum((n > 0) * COORDINATES)))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(sig.ravel().view(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n), *[pa.array(k.view(np.int64)) for k in keys], lists],
                names=["doc_id", "n_shingles", "low", "high", "signature"])
    return docs.select("doc_id", "text").mapInArrow(
        tidied(run), "doc_id long, n_shingles long, low long, high long, signature array<int>")


def full_sets(docs: DataFrame, ids: DataFrame, words: int = 2) -> DataFrame:
    """node, shingles: the whole sets of the documents in ``ids(node)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            grams, first = shingle_sets(texts, words)
            lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(grams.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], names=["node", "shingles"])
    wanted = docs.select("doc_id", "text").join(few(ids.select(F.col("node").alias("doc_id")).distinct()), "doc_id", "left_semi")
    return wanted.mapInArrow(tidied(run), "node long, shingles array<long>")


def postings(classes: DataFrame) -> DataFrame:
    """token, node, fame: every class under the rarest of its coordinate-value
    pairs, as many as the prefix takes; pairs of one class only are skipped.
    Fame is how many postings the class's coordinates have in all: the text
    that others were copied from has the most."""
    value = F.col("value").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))
    tokens = (classes.select("node", F.posexplode("signature").alias("k", "value"))
              .select("node", F.shiftleft(F.col("k").cast("long"), 32).bitwiseOR(value).alias("token")))
    shared = tokens.groupBy("token").agg(F.count("*").alias("n")).filter("n > 1")
    mine = tokens.join(shared, "token").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("t"))
    # The skipped ones are the rarest and take their place in the prefix.
    rest = F.lit(PREFIX - COORDINATES) + F.size("t")
    fame = F.aggregate("t", F.lit(0).cast("long"), lambda s, t: s + t["n"])
    return (mine.filter(rest > 0).select("node", fame.alias("fame"), F.explode(F.slice("t", F.lit(1), rest)).alias("t"))
            .select(F.col("t.token").alias("token"), "node", "fame"))


def stars(lists: DataFrame, step: int) -> DataFrame:
    """Pairs (a, b) of each list's hub with the classes of other components:
    first the most famous class is the hub, then one by chance."""
    order = F.col("fame") if step == 0 else F.xxhash64("node", "token", F.lit(step))
    hubs = (lists.groupBy("token").agg(F.max(F.struct(order.alias("order"), "node", "component")).alias("hub"))
            .select("token", F.col("hub.node").alias("hub"), F.col("hub.component").alias("home")))
    return (lists.join(hubs, "token").filter("home != component")
            .select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct())


def across(lists: DataFrame) -> DataFrame:
    """All pairs (a, b) of a list that are not of one component."""
    other = lists.select("token", F.col("node").alias("node2"), F.col("component").alias("component2"))
    return (lists.join(other, "token").filter("node < node2 and component != component2")
            .select(F.col("node").alias("a"), F.col("node2").alias("b")).distinct())


def across_large(lists: DataFrame, classes: DataFrame, docs: DataFrame, percent: int, words: int) -> DataFrame:
    """Links (a, b) between components within long lists, compared in blocks of
    at most ``BLOCK`` classes and about ``BLOCK_SHINGLES`` shingles, pair of
    blocks by pair of blocks.  Only pairs that the full sets confirm leave a
    task, and each pair meets in the first of the lists that it shares."""
    known = cut(full_sets(docs, lists.select("node"), words))
    place = F.shiftright("token", 32).cast("int")
    mine = lists.groupBy("node").agg(F.bit_or(F.expr("shiftleft(1L, cast(shiftright(token, 32) AS int))")).alias("posted"))
    about = (mine.join(classes.select("node", "n_shingles", "signature"), "node")
             .join(known.groupBy("node").agg(F.max_by("shingles", F.size("shingles")).alias("shingles")), "node"))
    sizes = (lists.join(classes.select("node", "n_shingles"), "node").groupBy("token")
             .agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int").alias("many")))
    rows = (lists.select("token", "node", "component").join(sizes, "token")
            .withColumn("block", F.pmod(F.xxhash64("node"), F.col("many")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("many") - 1)))
            .select("token", place.alias("place"), "node", "component", "block",
                    F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")).join(about, "node"))

    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        low, high = key[1].as_py(), key[2].as_py()
        table = table.combine_chunks()
        node, component, posted, block = (table.column(c).to_numpy() for c in ("node", "component", "posted", "block"))
        at = table.column("place")[0].as_py()
        sig = np.array(table.column("signature").to_pylist(), np.int32).reshape(-1, COORDINATES)
        shingles = table.column("shingles").chunk(0)
        first = np.concatenate(([0], np.cumsum(shingles.value_lengths().to_numpy())))
        flat, n = shingles.flatten().to_numpy().view(np.uint64), np.diff(first)
        x, y = np.flatnonzero(block == low), np.flatnonzero(block == high)
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for i in x:
            own = y[(component[y] != component[i]) & ((node[y] > node[i]) if low == high else True)
                    & (np.minimum(n[y], n[i]) * 100 >= np.maximum(n[y], n[i]) * percent)]
            same = sig[own] == sig[i]
            early = np.flatnonzero(posted[i] >> np.arange(at) & 1)  # coordinates that come before this list's
            met = (same[:, early] & (posted[own][:, None] >> early & 1).astype(bool)).any(1)
            own = own[(same.sum(1) >= LARGE_MATCHES) & ~met]
            if len(own):
                mine, counts = flat[first[i]:first[i + 1]], n[own]
                each = np.repeat(first[own] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())
                found = np.searchsorted(mine, flat[each])
                hit = mine[np.minimum(found, len(mine) - 1)] == flat[each]
                both = np.add.reduceat(hit.astype(np.int64), np.concatenate(([0], np.cumsum(counts)[:-1])))
                own = own[both * 100 >= (counts + n[i] - both) * percent]
                a.append(np.full(len(own), i))
                b.append(own)
        a, b = node[np.concatenate(a)], node[np.concatenate(b)]
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})
    return rows.groupBy("token", "low", "high").applyInArrow(compare, "a long, b long")


def matching(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose signatures collide often enough and whose set
    sizes allow the similarity."""
    c = classes.select("node", "n_shingles", "signature")
    both = (pairs.join(c.toDF("a", "na", "sa"), "a").join(c.toDF("b", "nb", "sb"), "b"))
    hits = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x == y), lambda x: x))
    return (both.filter(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
            .filter(hits >= LEAST_MATCHES).select("a", "b").distinct())


def confirmed(pairs: DataFrame, docs: DataFrame, percent: int, words: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    ids = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node")))
    sets = full_sets(docs, ids, words)  # both joins read one exchange
    both = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
    same = F.size(F.array_intersect("sa", "sb"))
    return (both.select("a", "b", same.alias("same"), (F.size("sa") + F.size("sb")).alias("both"))
            .filter(F.col("same") * 100 >= (F.col("both") - F.col("same")) * percent).select("a", "b").distinct())


def same_document(members: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of ids that stand on several texts:
    rows of one id are one document."""
    of = members.filter("node is not null").select("doc_id", "node")
    several = of.groupBy("doc_id").agg(F.min("node").alias("x"), F.max("node").alias("y")).filter("x != y").select("doc_id")
    return of.join(several, "doc_id").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))


def near_duplicates(docs: DataFrame, words: int = 2, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every document."""
    known = cut(signatures(docs, words))
    classes = cut(known.filter("n_shingles > 0 and doc_id is not null").groupBy("low", "high", "n_shingles")
                  .agg(F.min("doc_id").alias("node"), F.min("signature").alias("signature")))
    members = (known.select("doc_id", "n_shingles", "low", "high")
               .join(classes.select("low", "high", "n_shingles", "node"), ["low", "high", "n_shingles"], "left").select("doc_id", "n_shingles", "node"))
    members = cut(members)
    lists = cut(postings(classes))
    placed = lists.withColumn("component", F.col("node"))
    tried = links = None
    for step in range(STAR_STEPS):
        pairs = stars(placed, step)
        pairs = cut(matching(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), classes, percent))
        new = confirmed(pairs, docs, percent, words)
        tried = pairs if tried is None else tried.union(pairs)
        links = cut(new if links is None else links.union(new))
        found = components(links)
        placed = lists.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
        mixed = (placed.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("n"))
                 .filter("x != y").select("token", "n"))
        placed = cut(placed.join(mixed, "token"))  # lists that still hold several components
        placed, size = placed.drop("n"), placed
    pairs = cut(matching(across(size.filter(F.col("n") <= LARGE_LIST)).join(tried, ["a", "b"], "left_anti"), classes, percent))
    last = confirmed(pairs, docs, percent, words).union(across_large(size.filter(F.col("n") > LARGE_LIST), classes, docs, percent, words))
    found = components(links.union(last).union(same_document(members)))
    members = members.join(found, "node", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id"))
    return (members.select("doc_id", "n_shingles", component.alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op5_minhash_postings": query}
#: All pairs that share a shingle; for tables of some thousand documents.
SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM split),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT doc_id, doc_id AS r FROM sets UNION SELECT reached.doc_id, both_ways.b FROM reached JOIN both_ways ON both_ways.a = reached.r),
least AS (SELECT doc_id, min(r) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN least USING (doc_id)
"""
ORACLE: dict[str, str] = {"op5_minhash_postings": SQL}
