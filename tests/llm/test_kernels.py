"""Word, n-gram and graph kernels."""

import random

import numpy as np

from strata.llm import relative_factors
from strata.llm.arrays import Words, gram_hashes, grams_inside, span_hashes
from strata.llm.graph import components
from tests.llm import brute


def test_words_are_split_as_bytes_split():
    texts = ["", " a  b\tc\n", "über Ä\x0bx\x0c", "\x1cz  q", "end"]
    w = Words([t.encode() for t in texts], lower=True)
    got = [[w.buf[w.start[k]:w.end[k]].tobytes() for k in range(w.first[i], w.first[i + 1])] for i in range(len(texts))]
    assert got == [t.encode().lower().split() for t in texts]


def test_equal_words_and_grams_have_equal_hashes_anywhere():
    rng = random.Random(1)
    words = [rng.choice(["a", "ab", "b", "ba", "aab", "ÿ"]) for _ in range(400)]
    h = Words([" ".join(words).encode()]).hashes()
    assert len(set(h.tolist())) == len(set(words))
    g = gram_hashes(h, 3)
    assert len(set(g.tolist())) == len({tuple(words[i:i + 3]) for i in range(398)})
    assert (span_hashes(h, np.arange(398), np.arange(398) + 3) == g).all()


def test_grams_do_not_cross_documents():
    w = Words([b"a b", b"c", b"", b"d e f"])
    assert grams_inside(w.doc, 2).tolist() == [True, False, False, True, True]
    assert len(grams_inside(w.doc, 9)) == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(500 + i, 501 + i) for i in range(40)] + [(7, 7)]
    df = spark.createDataFrame([*edges, (None, 3)], "a long, b long")
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    assert {r.node: r.component for r in components(df).collect()} == brute.components(nodes, [e for e in edges if e[0] != e[1]])
    assert components(df.limit(0)).count() == 0


def test_anchors_of_texts_longer_than_their_places(monkeypatch):
    rng = random.Random(5)
    text = " ".join(str(rng.randrange(10**6)) for _ in range(1000)).encode()
    want = relative_factors.Anchors(Words([text, text]))
    for bits in (5, 6, 9):
        monkeypatch.setattr(relative_factors, "_PLACE", np.uint64((1 << bits) - 1))
        got = relative_factors.Anchors(Words([text, text]))
        assert (got.at == want.at).all() and (got.place == want.place).all() and (got.key == want.key).all()
