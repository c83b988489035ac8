"""Steps that grew with pairs, partitions or repeated scans, and their results."""

import random

from pyspark.sql import functions as F

from tests.llm import brute


def test_short_edge_lists_are_contracted_in_one_partition(spark, monkeypatch):
    from strata.llm import graph
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 90), (90, 95), (7, 7), (None, 3)], "a long, b long")
    made, cut = [], graph.cut
    monkeypatch.setattr(graph, "cut", lambda df: made.append(cut(df)) or made[-1])
    want = {**{i: 0 for i in range(61)}, 90: 90, 95: 90, 100: 90}
    assert {r.node: r.component for r in graph.components(edges.repartition(6)).collect()} == want
    assert len(made) > 2 and {df.rdd.getNumPartitions() for df in made[1:]} == {1}
    monkeypatch.setattr(graph, "FEW_EDGES", 10)  # longer lists stay distributed
    assert {r.node: r.component for r in graph.components(edges.repartition(6)).collect()} == want


def test_long_lists_are_compared_in_blocks(spark, monkeypatch):
    """Classes of one long list in several blocks: all links of all pairs."""
    from strata.llm import minhash_postings as M
    rng = random.Random(2)
    words = [f"w{i}" for i in range(200)]
    base = [rng.choices(words, k=40) for _ in range(12)]
    rows = []
    for i in range(160):
        text = list(base[i % 12])
        for _ in range(i % 4):
            text[rng.randrange(40)] = rng.choice(words)
        rows.append((i, " ".join(text)))
    monkeypatch.setattr(M, "BLOCK", 16)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    classes = M.signatures(docs).groupBy("low", "high", "n_shingles").agg(F.min("doc_id").alias("node"), F.min("signature").alias("signature"))
    lists = M.postings(classes).withColumn("component", F.col("node"))
    got = [tuple(r) for r in M.across_large(lists, classes, docs, 80, 2).collect()]
    nodes = {r.node for r in classes.collect()}
    sets = {i: {tuple(w[j:j + 2]) for j in range(len(w) - 1)} for i, t in rows if i in nodes and (w := t.split())}
    tokens = {r.node: set(r.t) for r in lists.groupBy("node").agg(F.collect_set("token").alias("t")).collect()}
    want = {(a, b) for a in nodes for b in nodes if a < b and tokens.get(a, set()) & tokens.get(b, set())
            and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert len(got) > 50 and sorted(got) == sorted(want)  # each pair once, though it shares many lists


def test_copied_passages_are_found_without_joins_of_occurrences(spark):
    from strata.llm import relative_factors as R
    rng = random.Random(4)
    passage = " ".join(rng.choices("abcdefghij", k=40))
    rows = [(i, f"{' '.join(rng.choices('klmnopqrst', k=25))} {passage} {i}") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = R.parsed(docs, keep_text=False)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in out.collect()} == brute.substring_digest(rows)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") <= 12  # 21 before: each frame was made for its groups and for its join
    assert "(same#" not in "".join(line for line in plan.splitlines() if "Join" in line)


def test_runs_are_known_across_tasks_of_the_digest_query():
    import pyarrow as pa
    from strata.llm import bpe_tree

    class Docs:
        def select(self, *_):
            return self

        def mapInArrow(self, run, schema):
            return run
    path, pattern = bpe_tree.default_vocabulary()
    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": ["one two three"]})
    before = bpe_tree._LOADED.pop((path, pattern), None)
    try:
        list(bpe_tree.digests(Docs())(iter([batch])))
        assert set(bpe_tree._LOADED[path, pattern]._spaced) >= {"two", "three"}
        list(bpe_tree.encode_decode(Docs())(iter([batch])))
        assert not bpe_tree._LOADED[path, pattern]._spaced
    finally:
        if before is not None:
            bpe_tree._LOADED[path, pattern] = before
