"""Spelling variants (11), record files (12) and centroid clustering (13)."""

import hashlib
import os
import random
import struct
from collections import Counter
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
import re
from tokenizers import Tokenizer

from strata.llm import centroid_products, permuterm_variants, record_files, registry
from tests.conftest import SF_SMALL
from tests.llm.brute import docs_frame


# -- 11 ---------------------------------------------------------------------

def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def plain_variants(n):
    lists = {w: [o for o in n if abs(len(o) - len(w)) <= 1 and near(w, o)] for w in n}
    best = {w: min(o, key=lambda x: (-n[x], x)) if o else None for w, o in lists.items()}
    form = {w: b if b and n[b] >= 2 * n[w] else None for w, b in best.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return {(w, form[w], root(w), n[w], len(lists[w]), n.get(form[w])) for w in n}


def plain_words(rows, shortest=5, least=3, every=97):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if c.isascii() else c for c in run)
            h = crc32(f"{'null' if i is None else i}:{w}".encode())
            n[w if h % every else w[:h % len(w)] + w[h % len(w) + 1:]] += 1
    return {w: k for w, k in n.items() if len(w) >= shortest and k >= least}


def test_variants_against_all_pairs(spark):
    rng = random.Random(3)
    words = {"".join(rng.choices("abé", k=rng.randint(5, 8))) for _ in range(500)}
    n = {w: int(2 ** rng.uniform(1.6, 9)) for w in words} | {"aaaaaa": 70, "aaaaa": 300, "aaaaaaa": 3}
    # words on both sides of the length from which rotations are hashed
    stem = "".join(rng.choices("abcdefgh", k=62))
    for w in (stem, stem + "x", stem + "xy", "z" + stem + "x", stem + "xyz", stem[:30] + "q" + stem[31:] + "xy", stem * 3, stem * 3 + "a"):
        n[w] = rng.randint(3, 40)
    got = permuterm_variants.variants(spark.createDataFrame(list(n.items()), "word string, n long").repartition(3)).collect()
    assert len(got) == len(n) and set(map(tuple, got)) == plain_variants(n)


def test_variants_follow_chains(spark):
    n = {"a" * k + "bcdef": 2 ** k * 3 for k in range(12)}
    got = {r.word: r.root for r in permuterm_variants.variants(spark.createDataFrame(list(n.items()), "word string, n long")).collect()}
    assert set(got.values()) == {"a" * 11 + "bcdef"}


def test_word_counts_and_edge_cases(spark):
    rng = random.Random(5)
    some = ["Straße", "STRASSE", "Éclair", "éclair", "don't", "x1abcde", "naïve×", "ÀÿÀÿÀ", "Œuvre", "abćdef", "中文abcde"]
    rows = [(i, " ".join(rng.choices(some, k=30))) for i in range(40)] + [(None, "alpha " * 9), (7, "alpha " * 9), (7, "alpha " * 9), (8, None), (9, ""),
                                                                        (10, "q" * 5000 + " " + "beta1 " * 4), (11, "q" * 5000 + "r"), (12, "q" * 5000)]
    for every in (97, 3):
        got = {r.word: r.n for r in permuterm_variants.word_counts(docs_frame(spark, rows).repartition(3), every=every).collect()}
        assert got == plain_words(rows, every=every)
    assert permuterm_variants.spelling_variants(docs_frame(spark, [])).count() == 0
    assert set(map(tuple, permuterm_variants.spelling_variants(docs_frame(spark, rows * 3)).collect())) == plain_variants(plain_words(rows * 3))


def test_variants_of_the_small_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    n = plain_words(rows)
    got = registry.QUERIES["op11_permuterm_variants"](spark, SF_SMALL)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert set(map(tuple, got.collect())) == plain_variants(n)


# -- 12 ---------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def plain_records(rows, library):
    """Per document in id order; equal ids by the order of got rows."""
    out = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((i, len(ids), crc32(np.array(ids, "<u4").tobytes())))
    return out


PIECES = ["a", "B", "'s", "don't", " ", "  ", "\n", "\t", "\r\n", "\x1c", "\x85", "\xa0", " ", "é", "́", "É", "ﬁ", "İ", "ß", "ΑΣ", "1", "٣", "½",
          "中", "한", "ᄒ", "ᅡ", "!", "--", "\U0001F600", "‍", "the", "running", "<|endoftext|>", "<|startoftext|>", "</w>", "<|end", "\u0000", "Über", "Ÿÿ", "×", "÷x", "ÀÖØöø", "word.", "End!?", "a,b", "?!", ",", "x'll"]


def test_encoder_equals_the_library(library):
    encoder = record_files.WordVocabulary(public_tokenizers.path("word_bpe_49k.json"), kept_words=50).worker()
    rng = random.Random(1)
    for _ in range(4000):
        t = "".join(rng.choices(PIECES, k=rng.randint(0, 25)))
        assert encoder.encode(t).tolist() == library.encode(t, add_special_tokens=False).ids + [2], repr(t)
    assert len(encoder.kept) <= 50 and len(encoder.older) <= 50
    letters = [chr(c) for c in range(0x41, 0x180)]
    for _ in range(3000):
        t = "".join(rng.choices(letters, k=rng.randint(1, 12))) + "".join(rng.choices(".,;:!?'-", k=rng.randint(0, 3)))
        assert encoder.encode(t).tolist() == library.encode(t, add_special_tokens=False).ids + [2], repr(t)


def test_records_round_trip(spark, tmp_dir, library):
    rng = random.Random(2)
    rows = [(rng.randint(0, 400), " ".join(rng.choices(["alpha", "Beta", "x", "42", "naïve", ""], k=rng.randint(0, 60)))) for _ in range(300)]
    rows += [(None, "none"), (None, "none"), (900, None), (901, ""), (902, "long " * 60000), (-5, "first")] + [(77, f"hot {i % 7}") for i in range(200)]
    folder = f"{tmp_dir}/records"
    index = record_files.write_records(docs_frame(spark, rows).repartition(5), folder, record_files.default_vocabulary(), file_bytes=4000, range_bytes=20000)
    got = record_files.read_records(index, folder).orderBy("start").collect()
    key = repr
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=key) == sorted(plain_records(rows, library), key=key)
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    starts = np.cumsum([0] + [r.n_tokens for r in got])
    assert [r.start for r in got] == starts[:-1].tolist()
    assert len({r.name for r in index.collect()}) > 10  # many files, several a task
    shuffled = record_files.read_shuffled(index, folder, seed=4, partitions=3)
    order = [(r.doc_id, r.ids) for r in shuffled.orderBy("position").collect()]
    assert sorted(order, key=key) == sorted(((r.doc_id, r.ids) for r in got), key=key) and order != [(r.doc_id, r.ids) for r in got]
    assert [tuple(r) for r in shuffled.orderBy("position").collect()] == [tuple(r) for r in record_files.read_shuffled(index, folder, seed=4, partitions=2).orderBy("position").collect()]


def test_frames_show_damage(spark, tmp_dir):
    data = record_files.frame(b"payload") + record_files.frame(b"")
    first, at = record_files.unframe(memoryview(data), 0)
    assert bytes(first) == b"payload" and bytes(record_files.unframe(memoryview(data), at)[0]) == b"" and at == 12 + 7 + 4
    assert record_files.masked(b"") == 0xA282EAD8  # crc32 of nothing is 0
    assert struct.unpack_from("<Q", data)[0] == 7
    for i in range(at):
        bad = bytearray(data)
        bad[i] ^= 4
        with pytest.raises(record_files.Damaged):
            record_files.unframe(memoryview(bytes(bad)), 0)
    for cut in range(1, at):
        with pytest.raises(record_files.Damaged):
            record_files.unframe(memoryview(data[:cut]), 0)
    # a file that no index names (a lost attempt) is not read; a shortened one is an error
    folder = f"{tmp_dir}/records"
    index = record_files.write_records(docs_frame(spark, [(1, "one"), (2, "two")]), folder, record_files.default_vocabulary())
    with open(f"{folder}/data/9999999-00000-lost.rec", "wb") as f:
        f.write(b"half a record")
    assert record_files.read_records(index, folder).count() == 2
    name = f"{folder}/data/{index.first().name}"
    os.truncate(name, os.path.getsize(name) - 1)
    with pytest.raises(Exception, match="the index says"):
        record_files.read_records(index, folder).count()


def test_records_of_tables(spark, tmp_dir, library):
    empty = record_files.write_records(docs_frame(spark, []), f"{tmp_dir}/e", record_files.default_vocabulary())
    assert empty.count() == 0 and record_files.read_records(empty, f"{tmp_dir}/e").count() == 0
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = registry.QUERIES["op12_record_files"](spark, SF_SMALL)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    want, start = [], 0
    for i, n, c in sorted(plain_records(rows, library)):
        want.append((i, start, n, c))
        start += n
    assert sorted(map(tuple, got.collect())) == want


# -- 13 ---------------------------------------------------------------------

def plain_clusters(rows, k=8, rounds=10, size=64, scale=1024, seed="3"):
    kept = [(i, [int(np.floor(np.float64(x) * scale)) for x in v]) for i, v in rows
            if v is not None and len(v) == size and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    cs = [v for _, v in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cs)) for _, v in kept]
    for _ in range(rounds):
        at = assign()
        for j in range(len(cs)):
            own = [v for (_, v), (_, a) in zip(kept, at) if a == j]
            if own:
                cs[j] = [sum(c) // len(own) for c in zip(*own)]
    at = assign()
    total = sum(d for d, _ in at)
    return Counter((i, j, d, sum(x for x, y in at if y == j), total, hashlib.sha256(",".join(map(str, cs[j])).encode()).hexdigest())
                   for (i, _), (d, j) in zip(kept, at))


VECTORS = "vec_id long, embedding array<double>, cluster int, distance string, v int"


def test_clusters_against_plain_rounds(spark):
    rng = random.Random(7)
    rows = [(i, [rng.gauss(0, 2) for _ in range(6)]) for i in range(150)]
    rows += [(None, [1.0] * 6), (None, [0.5] * 6), (3, [9.0] * 6), (3, [9.0] * 6), (500, [0.0] * 6), (501, None), (502, [1.0] * 5), (503, []),
             (504, [float("nan")] * 6), (505, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (506, [float("inf")] + [0.0] * 5), (507, [-0.00001] * 6)]
    frame = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], VECTORS).repartition(4)
    for k, rounds, scale in ((8, 10, 1024), (3, 2, 7), (1, 1, 1)):
        got = centroid_products.report(frame, k=k, rounds=rounds, size=6, scale=scale)
        assert Counter(map(tuple, got.collect())) == plain_clusters(rows, k, rounds, 6, scale)
    few = frame.filter("vec_id < 3")
    assert Counter(map(tuple, centroid_products.report(few, size=6).collect())) == plain_clusters(rows[:3], size=6)
    assert centroid_products.report(frame.limit(0), size=6).count() == 0
    with pytest.raises(Exception, match="too large for exact sums"):
        centroid_products.report(spark.createDataFrame([(1, [1e9] * 6, 1, "x", 2)], VECTORS), size=6).collect()


def test_an_empty_cluster_keeps_its_centroid(spark):
    # two equal vectors start two clusters; ties leave the second one empty
    rows = [(i, [1.0, 1.0]) for i in range(4)] + [(9, [5.0, 5.0])]
    frame = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], VECTORS)
    got = centroid_products.report(frame, k=3, size=2)
    assert Counter(map(tuple, got.collect())) == plain_clusters(rows, k=3, size=2)


def test_the_matrix_follows_the_changed_components(spark):
    rng = np.random.default_rng(1)
    v, old = rng.integers(-500, 500, (40, 64)), rng.integers(-500, 500, (8, 64))
    new = old.copy()
    new[2, 5] += 3
    new[6, [0, 63]] -= 7
    change = centroid_products.Change.between(old.tolist(), new.tolist())
    assert [len(a) for a in change.components] == [0, 0, 1, 0, 0, 0, 2, 0]
    products = v @ old.T
    centroid_products.follow(v, products, change)
    assert (products == v @ new.T).all()
    assert change.squares.tolist() == [sum(x * x for x in c) for c in new.tolist()]


def test_clusters_of_the_small_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    got = registry.QUERIES["op13_centroid_products"](spark, SF_SMALL)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert Counter(map(tuple, got.collect())) == plain_clusters(rows)
