"""URL reputation (1), sharding (6) and template decontamination (10)."""

import zlib

import pytest
from pyspark.sql import functions as F

from strata.llm import hash_tree_shards as shards
from strata.llm import registry, template_leaks
from strata.llm.url_reputation import url_verdicts
from tests.conftest import SF_SMALL
from tests.llm.brute import docs_frame
from tests.oracle_check import duck, rows_of

PLANNED = ("Train Alice leaves at 12 km from Paris and Bob walks 12 km in 3 hours to meet her there.")


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_matches_oracle(spark, name):
    df = registry.QUERIES[name](spark, SF_SMALL)
    rel = duck(SF_SMALL).execute(registry.ORACLE[name])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of([d[0] for d in rel.description], rel.fetchall())


def test_url_parts_rules_and_bounds(spark):
    good = [f"http://good.one.com/{i}" for i in range(60)]
    bad = [f"http://bad.one.com/{i}" for i in range(60)]
    urls = [*good, *bad, None, "no scheme", "HTTP://A.Example.NET/en/x?q#f", "https://example.net?x", "http://x.net", "http://x.net/",
            "http://a.fr.org/fr/1", "http://example.com/de/", "http://new.one.com/", "http://new.one.com/"]
    pages = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string")
    outcomes = spark.createDataFrame([(i, 1 if i < 60 else 0) for i in range(120)] + [(None, 1), (3, None)], "page_id long, good int")
    got = {r.page_id: r for r in url_verdicts(pages, outcomes).collect()}
    assert len(got) == len(urls)
    assert {got[i].verdict for i in range(60)} == {"allow"} and {got[i].verdict for i in range(60, 120)} == {"block"}
    assert [(got[i].host, got[i].path) for i in (120, 121, 122, 123)] == [("", ""), ("", ""), ("a.example.net", "/en/x"), ("example.net", "")]
    assert [got[i].rule for i in (122, 123, 124, 125, 126, 127)] == ["example.net/en/", None, None, "net/", "org/fr/", "example.com/de/"]
    assert got[0].bound > got[128].bound > got[60].bound and got[128].verdict == got[129].verdict
    empty = url_verdicts(pages, outcomes.limit(0)).collect()
    assert len(empty) == len(urls) and len({r.bound for r in empty}) == 1
    assert url_verdicts(pages.limit(0), outcomes).count() == 0


def test_shards_follow_weights_and_only_move_into_grown_ones(spark):
    df = spark.range(6000).withColumn("region", F.lit("clash"))
    tree = shards.Tree((((1.0, 3.0),), ((2.0,), (2.0,))))
    got = shards.place(shards.place(df, tree, F.col("id"), "a"), tree.grown(2.0), F.col("id"), "b")
    n = {r.a: r.n for r in got.groupBy("a").agg(F.count("*").alias("n")).collect()}
    assert [round(n[i] / 6000, 1) for i in range(4)] == [0.1, 0.4, 0.2, 0.2] or abs(n[1] / 6000 - 3 / 8) < 0.03
    moved = got.filter("a != b")
    assert {r.b for r in moved.select("b").distinct().collect()} == {4}
    assert abs(moved.count() / 6000 - 0.2) < 0.03
    heavier = shards.Tree((((1.0, 3.0),), ((2.0,), (4.0,))))
    changed = shards.place(got, heavier, F.col("id"), "c").filter("a != c")
    assert changed.filter("c < 2").count() == 0  # the other region only loses rows


def test_shard_rows_and_slots(spark, monkeypatch):
    monkeypatch.setattr(shards, "ROWS_PER_BUCKET", 10)
    rows = [(i, f"text é {i}") for i in range(300)] + [(5, "text é 5"), (None, None), (7, ""), (None, "x")]
    got = shards.assign_shards(docs_frame(spark, rows), shards.TREE).collect()
    assert len(got) == len(rows) and {r.law for r in got} == {"key"}
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
        assert r.grown_shard in (r.shard, 24)
    assert all(sorted(s) == list(range(len(s))) for s in by.values()) and set(by) <= set(range(24))
    want = sorted((len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for _, t in rows)
    assert sorted((r["size"], r.text_crc32) for r in got) == want
    assert len({r.shard for r in got if r.doc_id == 5}) == 1
    assert shards.assign_shards(docs_frame(spark, []), shards.TREE).count() == 0


def test_templates_catch_new_parameters_and_check_slots(spark):
    other = "Train Carol leaves at 15 km from Rome and Dave walks {} km in 4 hours to meet her there."
    rows = [(1, "Foo bar. " + other.format(15) + " End."), (2, other.format(17)), (3, None), (None, ""), (4, "a b c d"),
            (1, "Foo bar. " + other.format(15) + " End."), (5, PLANNED.upper()), (6, PLANNED.replace("leaves at", "arrives near")),
            (None, PLANNED), (7, "word " * 500)]
    bench = spark.createDataFrame([(1, PLANNED, "x"), (2, "a b c", "x"), (3, None, "x"), (None, "q", "x"),
                                   (8, "plain words that carry no slot at all but are long enough", "x")], "item_id long, text string, doc_id string")
    docs = docs_frame(spark, [*rows, (8, "so: Plain words that carry no slot at all, but are long enough!"),
                              (9, "SO, PLAIN WORDS THAT CARRY NO SLOT AT ALL BUT ARE LONG ENOUGH")])
    got = {(r.doc_id, r.item_id) for r in template_leaks.leaks(docs, bench).collect()}
    assert got == {(1, 1), (None, 1), (8, 8), (9, 8)}
    assert template_leaks.judged(docs, bench).filter("__items is not null").count() == 5  # both rows of document 1
    assert template_leaks.leaks(docs, bench.limit(0)).count() == 0
    assert template_leaks.leaks(docs.limit(0), bench).count() == 0


def test_names_that_open_a_sentence_are_slots(spark):
    item = "{} has {} apples. {} gives her {} more. How many apples does {} have now?"
    bench = spark.createDataFrame([(1, item.format("Alice", 12, "Bob", 5, "Alice")),
                                   (2, "“Alice sells {0} pens\nBob buys (Bob pays) {0} of them:  Carol asks: 'Alice, how many pens are left for Dave?'".format(7))],
                                  "item_id long, text string")
    docs = docs_frame(spark, [(1, item.format("Carol", 9, "Dave", 4, "Carol")), (2, item.format("Carol", 9, "Dave", 4, "Erin")),
                              (3, "so " + item.format("Carol", 9, "Dave", 4, "Carol").lower()), (4, "In short, " + item.format("Carol", 9, "Dave", 4, "Carol")),
                              (5, "“Xenia sells 8 pens\nYves buys (Yves pays) 8 of them:  Zoe asks: 'Xenia, how many pens are left for Will?'"),
                              (6, item.format("Alice", 9, "Bob", 4, "Alice").replace(". ", "; "))])
    got = {(r.doc_id, r.item_id): r.share for r in template_leaks.leaks(docs, bench).collect()}
    assert got == {(1, 1): 1.0, (4, 1): 1.0, (5, 2): 1.0, (6, 1): 1.0}


def test_excerpts_changed_words_and_inconsistent_parts(spark):
    plain = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(59)]
    short = plain[:20]
    hours = "the pump runs for 3 hours and then it rests for 5 hours until all of the water is gone from the pool"
    roles = " ".join(plain[:25]) + " 5 apples and 5 pears " + " ".join(plain[25:50])
    bench = spark.createDataFrame([(1, " ".join(plain)), (2, hours), (3, "x " + " ".join(reversed(short))), (4, "y " + roles.replace("w", "v"))],
                                  "item_id long, text string")
    changed = ["x", *reversed(short)]
    changed[10] = "other"
    docs = docs_frame(spark, [
        (1, "so " + " ".join(plain[14:44]) + " end"), (2, "so " + " ".join(plain[14:26]) + " end"),
        (3, hours.replace("3 hours", "1 hour").replace("5 hours", "1 hour")), (4, hours.replace("3", "4")),
        (5, " ".join(changed)), (6, roles.replace("w", "v").replace("5 apples", "7 apples").replace("5 pears", "9 pears")),
        (7, " ".join(f"{w} and" for w in plain))])
    got = {(r.doc_id, r.item_id): round(r.share, 2) for r in template_leaks.leaks(docs, bench).collect()}
    assert got == {(1, 1): 0.47, (3, 2): 1.0, (4, 2): 1.0, (5, 3): 0.71, (6, 4): 0.88}


def test_benchmark_passages_are_found(spark):
    bench = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = {r.doc_id for r in registry.QUERIES["op10_template_leaks"](spark, SF_SMALL).filter("leaks").collect()}
    assert got == {i for i, t in docs.items() if any(b in t for b in bench)}
