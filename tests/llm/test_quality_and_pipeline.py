"""Importance resampling (3) and the corpus pipeline."""

import math
import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from strata.llm import importance_filter as quality
from strata.llm import registry
from strata.llm.bpe_tree import ByteBPE, default_vocabulary
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.brute import docs_frame


def _corpus(n=900):
    rng = random.Random(6)
    plain = ["".join(rng.choices("abcdeilnorst", k=rng.randint(2, 8))) for _ in range(300)]
    rude = ["zqx" + w for w in plain[:12]]
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(plain, k=rng.randint(20, 200))
        bad = i % 5 == 0
        if bad:
            for _ in range(6):
                words.insert(rng.randrange(len(words)), rng.choice(rude))
        rows.append((i, " ".join(words)))
        if i % 2 == 0 or bad:
            labels.append((i, 1, int(bad)))
    return rows, labels


LABELS = "doc_id long, quality int, toxic int"


def test_toxic_documents_go_and_clean_ones_stay(spark):
    rows, labels = _corpus()
    docs = docs_frame(spark, [*rows, (5000, None), (5001, ""), (None, "x"), (1, rows[1][1])])
    got = quality.resample(docs, spark.createDataFrame([*labels, (None, 1, 0), (3, None, 1)], LABELS)).collect()
    kept = {r.doc_id: r.kept for r in got}
    assert len(got) == len(rows) + 4
    bad = [kept[i] for i in range(900) if i % 5 == 0]
    clean = [kept[i] for i in range(900) if i % 5]
    assert np.mean(bad) < 0.1 and np.mean(clean) > 0.95 and kept[5000] and kept[5001]


def test_without_labels_of_both_kinds_all_stay(spark):
    docs = docs_frame(spark, [(1, "a b"), (2, None)])
    for labels in ([], [(1, 1, 0)], [(2, 0, 0)]):
        got = quality.resample(docs, spark.createDataFrame(labels, LABELS)).collect()
        assert [(r.weight, r.kept) for r in got] == [(0.0, True)] * 2
    assert quality.resample(docs.limit(0), spark.createDataFrame([(1, 1, 0)], LABELS)).count() == 0


def test_counts_as_by_dictionary(spark, monkeypatch):
    rows, labels = _corpus(60)
    docs = docs_frame(spark, rows)
    sample = quality.cut(
        quality.labelled_sample(spark.createDataFrame(labels, LABELS)))
    raw, target = quality.corpus_counts(docs, sample)
    want, chosen = Counter(), Counter()
    fit = {r.doc_id for r in sample.collect() if r.good and r.fold > 0}
    for i, t in rows:
        own = Counter(quality.buckets([t.encode()])[0].tolist())
        want.update(own)
        chosen.update(own if i in fit else {})
    assert {int(b): int(raw[b]) for b in np.flatnonzero(raw)} == want
    assert {int(b): int(target[b]) for b in np.flatnonzero(target)} == chosen
    ratio = quality.log_ratio(raw, target)
    b = max(want, key=lambda x: want[x])
    exact = (target[b] + quality.SMOOTHING) / (target.sum() * raw[b] / raw.sum() + quality.SMOOTHING)
    assert math.isclose(ratio[b], math.log(exact) if exact <= quality.PLAIN else 0.0)


@pytest.mark.parametrize("k", [1, 2, 7, 500, 999, 1000, 2000])
def test_kth_largest(spark, k):
    rng = random.Random(7)
    values = [rng.choice([0.0, 1.5, rng.gauss(0, 1e6), rng.gauss(0, 1e-9)]) for _ in range(1000)]
    df = spark.createDataFrame([(v,) for v in values], "key double")
    assert quality.kth_largest(df, k, bins=16) == (sorted(values, reverse=True)[k - 1] if k <= 1000 else min(values))


def test_held_out_labels_of_the_real_table(spark):
    sf = SF_SMALL.replace("0.001", "0.01")
    labels = {r.doc_id: r.quality == 1 and r.toxic == 0 for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = {r.doc_id: r.kept for r in registry.QUERIES["op3_importance_filter"](spark, sf).collect()}
    good = np.mean([kept[i] for i, g in labels.items() if g])
    bad = np.mean([kept[i] for i, g in labels.items() if not g])
    assert good > 0.85 and bad < 0.35


def test_pipeline_stage_by_stage(spark, tmp_dir):
    """Every stage against its plain version on what its predecessor kept."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    kept = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_SMALL)
        assert i == 4 or out.columns == docs.columns
        out.write.parquet(f"{tmp_dir}/{i}")
        docs = spark.read.parquet(f"{tmp_dir}/{i}")
        kept.append({r.doc_id: r for r in docs.collect()})
    all_rows = {r.doc_id: r for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    chosen = {r.doc_id for r in registry.QUERIES["op3_importance_filter"](spark, SF_SMALL).filter("kept").collect()}
    assert set(kept[0]) == chosen and all(kept[0][i].text == all_rows[i].text for i in kept[0])
    groups = brute.near_duplicates([(i, r.text) for i, r in kept[0].items()], 5, 80)
    assert set(kept[1]) == {i for i, (_, _, first) in groups.items() if first}
    words = brute.removed_words([(i, r.text) for i, r in kept[1].items()])
    for i, (w, gone) in words.items():
        assert kept[2][i].text.encode().split() == [x for x, g in zip(w, gone) if not g]
        assert any(gone) or kept[2][i].text == kept[1][i].text
    bench = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    assert {i for i in kept[2] if any(b in kept[2][i].text for b in bench)} <= set(kept[2]) - set(kept[3])
    assert len(kept[3]) > 0.8 * len(kept[2])
    bpe = ByteBPE.load(*default_vocabulary())
    assert all(r.round_trip and bpe.decode(bytes(r.ids)).decode() == kept[3][i].text for i, r in kept[4].items()) and set(kept[4]) == set(kept[3])


def test_pipeline_registered_and_empty_stages(spark):
    import __spark_entry__ as entry
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    empty = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_SMALL).count() == 0


def test_rows_that_share_an_id(spark):
    """Ids on several texts: one document for the operator, and every text
    keeps a representative in the pipeline."""
    import corpus_pipeline
    from strata.llm.minhash_postings import near_duplicates
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(3, a), (5, a), (5, b), (7, b), (9, c), (9, c), (11, a + " more"), (None, c), (20, None), (20, "")]
    frame = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {(r.doc_id, r.n_shingles > 0): (r.component_id, r.kept) for r in near_duplicates(frame, words=5).collect() if r.doc_id is not None}
    assert got == {(3, True): (3, True), (5, True): (3, False), (7, True): (3, False), (9, True): (9, True), (11, True): (3, False), (20, False): (20, True)}
    left = corpus_pipeline.near_dedup(spark, frame, None).select("doc_id", "text").collect()
    assert sorted(map(tuple, left), key=repr) == sorted([(3, a), (5, b), (9, c), (9, c), (None, c), (20, None), (20, "")], key=repr)
    alone = frame.filter("doc_id is null or doc_id not in (5, 20)")
    left = corpus_pipeline.near_dedup(spark, alone, None).select("doc_id", "text").collect()
    assert sorted(map(tuple, left), key=repr) == sorted([(3, a), (7, b), (9, c), (9, c), (None, c)], key=repr)
