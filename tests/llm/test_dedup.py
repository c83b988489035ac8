"""Near copies of texts (5) and vectors (4), repeated passages (7)."""

import random

import numpy as np
import pytest

from strata.llm import minhash_postings, projection_forest, registry, relative_factors
from tests.conftest import SF_SMALL
from tests.llm import brute
from tests.llm.brute import docs_frame

WORDS = [f"w{i}" for i in range(400)]


def _texts(rng):
    base = [" ".join(rng.choices(WORDS, k=80)) for _ in range(6)]
    rows = []
    for i in range(90):
        w = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 4, 7, 12])):
            w[rng.randrange(len(w))] = rng.choice(WORDS)
        rows.append((1000 - i, " ".join(w)))
    rows += [(i, " ".join(rng.choices(WORDS, k=60))) for i in range(30)]
    return [*rows, (40, None), (41, ""), (42, " \t"), (43, "One"), (44, "oNE"), (45, "one two"), (46, "ONE\ntwo"), (47, "É"), (48, "é")]


@pytest.mark.parametrize("words, long_list", [(2, 64), (2, 2), (5, 64)])
def test_near_duplicates_as_by_all_pairs(spark, monkeypatch, words, long_list):
    monkeypatch.setattr(minhash_postings, "LARGE_LIST", long_list)
    rows = _texts(random.Random(words))
    got = minhash_postings.near_duplicates(docs_frame(spark, rows), words=words).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute.near_duplicates(rows, words, 80)


def test_near_duplicates_with_null_ids_and_repeated_rows(spark):
    same = "a b c d e f g h"
    got = minhash_postings.near_duplicates(docs_frame(spark, [(None, same), (5, same), (5, same), (7, same), (None, None)])).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in got) == [
        ("5", "5", True), ("5", "5", True), ("7", "5", False), ("None", "None", True), ("None", "None", True)]
    assert minhash_postings.near_duplicates(docs_frame(spark, [])).count() == 0


def test_near_duplicates_of_the_small_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = registry.QUERIES["op5_minhash_postings"](spark, SF_SMALL).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute.near_duplicates(rows, 2, 80)


def test_repeated_passages_as_by_all_windows(spark):
    rng = random.Random(3)
    passages = [" ".join(rng.choices(WORDS[:30], k=n)) for n in (19, 20, 21, 35, 60)]
    rows = []
    for i in range(60):
        parts = [" ".join(rng.choices(WORDS, k=rng.randint(0, 30))), rng.choice(passages), rng.choice(["x", "", "y\nz"]), rng.choice(passages)]
        rows.append((100 - i, " ".join(parts)))
    rows += [(200, "a " * 100), (201, "a " * 25), (202, None), (203, ""), (204, rows[0][1])]
    got = relative_factors.parsed(docs_frame(spark, rows), keep_text=False).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got} == brute.substring_digest(rows)


def test_repeated_passages_ties_nulls_and_kept_text(spark):
    text = " ".join(WORDS[:25])
    rows = [(1, f"head\n {text} tail"), (1, f"head\n {text} tail"), (2, f"own\nline {text} rest  of it"), (None, text), (None, None)]
    got = relative_factors.parsed(docs_frame(spark, rows), keep_text=True).collect()
    assert sorted((str(r.doc_id), r.kept, r.n_removed) for r in got) == [
        ("1", f"head\n {text} tail", 0), ("1", f"head\n {text} tail", 0), ("2", "own\nline\nrest  of it", 25), ("None", "", 0), ("None", "", 25)]
    part = next(r for r in got if r.doc_id == 2)
    assert [tuple(f) for f in part.factors] == [(2, 25, 1, 1)] and part.source == "s"
    assert relative_factors.parsed(docs_frame(spark, []), keep_text=True).count() == 0


def test_greedy_factors_join_windows_of_one_reference():
    assert relative_factors.factors([(0, 3, 1, 5), (3, 2, 1, 8), (5, 1, 2, 0), (40, 1, 1, 45)]) == [
        (0, 24, 1, 5), (5, 20, 2, 0), (40, 20, 1, 45)]


def test_substring_query_on_the_small_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = registry.QUERIES["op7_relative_factors"](spark, SF_SMALL).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == brute.substring_digest(rows)


def _vectors(rng, n=600, d=24):
    centers = rng.normal(size=(60, d))
    x = centers[rng.integers(0, 60, n)] + rng.normal(size=(n, d)) * rng.choice([0.02, 0.25], (n, 1))
    return x.astype(np.float32), rng.integers(0, 3, n)


def test_vector_links_against_all_pairs(spark, monkeypatch):
    for name, value in (("LEAF_ROWS", 60), ("BLOCK", 16)):
        monkeypatch.setattr(projection_forest, name, value)
    x, label = _vectors(np.random.default_rng(4))
    x[7], label[7] = x[3], label[3]  # a copy
    rows = [(int(i), [float(c) for c in x[i]], int(label[i])) for i in range(len(x))]
    rows += [(900, None, 1), (901, [0.0] * 24, 1), (902, [], 1), (903, [float("nan")] * 24, 1), (904, [None] * 24, 1),
             (905, rows[3][1], None), (None, rows[3][1], rows[3][2]), (906, [1.0, 2.0], 1), (907, [float("inf")] * 24, 1), (908, [2.0, 4.0], 1)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<float>, label int, node string")
    got = {r.vec_id: r for r in projection_forest.near_vectors(df).collect()}
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    a, b = np.nonzero(np.triu((unit @ unit.T >= 0.93) & (label[:, None] == label[None]), 1))
    links = np.bincount(a, minlength=len(x)) + np.bincount(b, minlength=len(x))
    found = np.array([got[i].n_links for i in range(len(x))])
    assert (found <= links).all() and found.sum() >= 0.9 * links.sum() > 0 and got[3].n_links >= 1
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i in (900, 901, 902, 903, 904, 905, 907))
    assert got[None].n_links == 0 and got[None].kept and got[908].component_id == 906 and not got[908].kept
    if (found == links).all():
        assert {i: got[i].component_id for i in range(len(x))} == brute.components(range(len(x)), zip(a.tolist(), b.tolist()))
    assert len(got) == len(rows) and projection_forest.near_vectors(df.limit(0)).count() == 0


def test_vectors_of_one_id_are_one_node(spark):
    a, b, c = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]
    rows = [(3, a, 1), (5, a, 1), (5, b, 1), (7, b, 1), (9, c, 1), (9, c, 2), (9, None, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted(map(tuple, projection_forest.near_vectors(df).collect()))
    assert got == [(3, 1, 3, True), (5, 1, 3, False), (5, 1, 3, False), (7, 1, 3, False), (9, 0, 9, True), (9, 0, 9, True), (9, 0, 9, True)]


def test_recall_of_planted_pairs_in_deep_trees(spark, monkeypatch):
    """Pairs just over the threshold, leaves as small as the sample allows."""
    monkeypatch.setattr(projection_forest, "LEAF_ROWS", 40)
    rng, d, n = np.random.default_rng(12), 64, 1200
    x = rng.normal(size=(n, d))
    x /= np.linalg.norm(x, axis=1)[:, None]
    off = rng.normal(size=(n, d))
    off -= (off * x).sum(1)[:, None] * x
    off /= np.linalg.norm(off, axis=1)[:, None]
    cosine = rng.uniform(0.932, 0.96, n)[:, None]
    both = np.concatenate((x, cosine * x + np.sqrt(1 - cosine**2) * off)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(both)], "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in projection_forest.near_vectors(df).collect()}
    unit = both.astype(float) / np.linalg.norm(both.astype(float), axis=1)[:, None]
    p, q = np.nonzero(np.triu(unit @ unit.T >= 0.93, 1))
    assert len(p) >= n
    found = sum(got[i][1] == got[j][1] for i, j in zip(p.tolist(), q.tolist()))
    assert found >= 0.97 * len(p) and sum(g[0] for g in got.values()) <= 2 * len(p)


def test_vectors_travel_by_units_not_by_leaves(spark, monkeypatch):
    """Units of a few vectors, in blocks where they do not part, give the rows
    of one unit for each label; vectors are copied per unit and not per leaf."""
    for name, value in (("LEAF_ROWS", 60), ("BLOCK", 16)):
        monkeypatch.setattr(projection_forest, name, value)
    rng = np.random.default_rng(6)
    x, label = _vectors(rng)
    x = np.concatenate((x, x[0] + rng.normal(size=(150, 24)).astype(np.float32) * 0.01))
    label = np.concatenate((label, np.full(150, label[0])))
    df = spark.createDataFrame([(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, label))], "vec_id long, embedding array<float>, label int")
    rows, posted = [], []
    dealt = projection_forest.links_in_units

    def links_in_units(frame, *args):
        posted.append(frame.count())
        return dealt(frame, *args)
    monkeypatch.setattr(projection_forest, "links_in_units", links_in_units)
    for values in (1 << 21, 24 * 100, 24 * 40):
        monkeypatch.setattr(projection_forest, "UNIT_VALUES", values)
        posted.append(None)
        rows.append(sorted(map(tuple, projection_forest.near_vectors(df).collect())))
    assert rows[0] == rows[1] == rows[2] and sum(r[1] for r in rows[0]) >= 150 * 149
    assert posted[:2] == [None, len(x)] and posted[2:4] == [None, 0] and len(posted) == 2 + 2 * (2 + 5)
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    trees = [projection_forest.fit_tree(unit, len(x), t) for t in range(projection_forest.TREES)]
    assert 10 * posted[1] < sum(len(t.leaves(unit)[0]) for t in trees)


def test_forest_splits_and_spills():
    x = np.random.default_rng(5).normal(size=(4000, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]
    tree = projection_forest.fit_tree(x, 40_000, 1)
    rows, leaves = tree.leaves(x)
    assert len(tree.cuts) > 4 and len(np.unique(rows)) == len(x) and len(rows) > len(x)
    assert np.bincount(leaves).max() <= 500
