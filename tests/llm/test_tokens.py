"""BPE (2), token attribution (9) and the license scan (8)."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from strata.llm import bpe_tree, registry
from strata.llm.license_compression import EVERY, MOST_DIFFERENT, NAMES, TEMPLATES, TEXTS, Scanner, _words as _plain, scan_licenses
from strata.llm.token_attribution import attribute, section_tokens
from tests.conftest import SF_SMALL
from tests.llm.brute import docs_frame

PARTS = ["a", "b", "'s", "'", "re", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", " ", "​", "　", "é", "ß", "1", "٣", "½", "Ⅷ",
         "中", "!", "-", "'ve ", "\r", "\x0b", "\U0001F600", "́", " a", "the", "ing", ".\n", "aaaa"]


@pytest.fixture(scope="module")
def bpe():
    return bpe_tree.ByteBPE.load(*bpe_tree.default_vocabulary())


@pytest.fixture(scope="module")
def exact(bpe):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


@pytest.mark.parametrize("chars, size", [(4096, 48), (7, 5), (2, 2)])
def test_tree_encodes_as_the_library(bpe, exact, monkeypatch, chars, size):
    monkeypatch.setattr(bpe_tree, "LEAF_CHARS", chars)
    monkeypatch.setattr(bpe_tree, "LEAF_BYTES", size)
    rng = random.Random(chars)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 40))) for _ in range(4000)]
    texts += ["".join(rng.choices("abcdeinrstou", k=rng.randint(0, 300))) for _ in range(300)] + ["a" * 3000, " " * 3000, "a\n" * 900]
    for t in texts:
        ids = bpe.encode(t)
        assert np.frombuffer(ids, np.uint32).tolist() == exact.encode_ordinary(t), repr(t)
        assert bpe.decode(ids) == t.encode()


def test_digests(spark, exact):
    rows = [(1, "Hello  world's\n x"), (2, None), (3, ""), (None, "x"), (1, "Hello  world's\n x"), (4, "long " * 30000)]
    got = bpe_tree.digests(docs_frame(spark, rows)).collect()

    def want(i, t):
        ids = np.array(exact.encode_ordinary(t or ""), "<u4").tobytes()
        return i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()
    key = str
    assert sorted(map(tuple, got), key=key) == sorted((want(*r) for r in rows), key=key)
    assert bpe_tree.digests(docs_frame(spark, [])).count() == 0


def test_boundary_rules():
    ends, tokens = np.array([4, 6, 10]), np.array([3, 5, 7, 10])  # 3-5 crosses 4, 5-7 crosses 6
    assert attribute(tokens, ends, "first")[0].tolist() == [0, 0, 1, 2]
    assert attribute(tokens, ends, "last")[0].tolist() == [0, 1, 2, 2]
    assert attribute(np.array([3, 9, 10]), ends, "most")[0].tolist() == [0, 2, 2]
    assert attribute(tokens, ends, "most")[0].tolist() == [0, 0, 1, 2]
    assert attribute(tokens, ends, "most")[1].tolist() == [False, True, True, False]


def test_sections_add_up_to_the_whole(spark, exact):
    rows = [(1, "ab cd\n\n\nef"), (2, None), (3, ""), (None, "x\n"), (4, "a\n" * 3), (1, "ab cd\n\n\nef"), (5, "word " * 20000)]
    for rule in ("first", "last", "most"):
        got = section_tokens(docs_frame(spark, rows), rule).collect()
        for i, t in rows:
            own = [r for r in got if r.doc_id == i]
            copies = sum(r == (i, t) for r in rows)
            assert sum(r.n_tokens for r in own) == copies * len(exact.encode_ordinary(t or ""))
            assert len(own) == copies * (len((t or "").split("\n")) - ((t or "").endswith("\n") or not t))
    with pytest.raises(ValueError):
        section_tokens(docs_frame(spark, rows), "half")


def test_sections_of_real_texts_by_single_tokens(spark, exact):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(20)
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {}
    for r in section_tokens(docs, "first").collect():
        got.setdefault(r.doc_id, {})[r.section] = r.n_tokens
    for i, t in texts.items():
        data, at, want = t.encode(), 0, {}
        for token in exact.encode_ordinary(t):
            s = data[:at].count(b"\n")
            want[s] = want.get(s, 0) + 1
            at += len(exact.decode_single_token_bytes(token))
        assert {k: v for k, v in got[i].items() if v} == want


def test_licenses(spark):
    rows = [(i, f"some words\n{t}\nmore") for i, (_, t) in enumerate(sorted(TEMPLATES.items()))]
    rows += [(100, "Licensed under the Apache License, Version 1.1."), (101, "Released under an MIT License."), (102, "the license of a driver"),
             (103, None), (None, ""), (104, "Released under the MIT License.\nReleased under the MIT License."), (105, "license " * 5000),
             (106, "Licensed under CC BY-ND 4.0.")]
    got = {r.doc_id: r for r in scan_licenses(docs_frame(spark, rows)).collect()}
    assert [[f.license for f in got[i].found] for i in range(len(TEMPLATES))] == [[n] for n in sorted(TEMPLATES)]
    assert [[f.license for f in got[i].found] for i in (100, 101, 102, 103, None, 105, 106)] == [[], ["MIT"], [], [], [], [], []]
    assert [f.line for f in got[104].found] == [0, 1] and got[104].n_candidates == 2
    assert scan_licenses(docs_frame(spark, [])).count() == 0


def test_compression_ranks_the_own_template_first():
    s = Scanner(TEMPLATES)
    assert all(s.ranked(t)[0][1] == n for n, t in TEMPLATES.items())


def _found(text, templates=EVERY):
    return [(x[0], x[1]) for x in Scanner(templates).licenses(text)[1]]


def test_notices_inside_long_lines():
    prose = "the quick brown fox jumps over some lazy dog and then asks for water in the long dry valley beyond "
    for n, t in TEMPLATES.items():
        for k in (1, 3, 30):
            assert _found(f"{prose * k}{t} {prose * k}") == [(0, n)]
            assert _found(f"{prose * k}{t} {prose * k}", TEMPLATES) == [(0, n)]
    assert _found(prose + "the license of a driver under the terms " + prose) == []


def test_wrapped_doubled_and_full_licenses():
    assert _found("x\nReleased under\nthe MIT License. All rights\n# reserved.") == [(1, "MIT"), (2, "All-rights-reserved")]
    assert _found("Released under the MIT License. Released under the MIT License.") == [(0, "MIT")] * 2
    assert _found("Released under the MIT License. Licensed under the Apache License, Version 2.0.") == [(0, "MIT"), (0, "Apache-2.0")]
    for n, texts in TEXTS.items():
        for t in texts:
            words = t.split(" ")
            wrapped = "\n".join(" * " + " ".join(words[i:i + 9]) for i in range(0, len(words), 9))
            assert _found(t) == _found("a b c d e f g h " + t + " i j k l m n") == [(0, n)]
            assert _found("/*\n" + wrapped + "\n */\nint x;") == [(1, n)]
    bsd = "Copyright (c) 2020, X. All rights reserved.\n\n" + TEXTS["BSD-3-Clause"][0]
    assert _found(bsd) == [(0, "All-rights-reserved"), (2, "BSD-3-Clause")]
    assert _found("one line of a license\nand a second line of it", {"own": "one line of a license and a second line of it"}) == [(0, "own")]


def test_license_query_against_plain_search(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = {r.doc_id: r.licenses for r in registry.QUERIES["op8_license_compression"](spark, SF_SMALL).collect()}
    assert got == {i: ",".join(sorted(n for n, x in TEMPLATES.items() if x in t.split("\n"))) for i, t in docs.items()}


def _altered(template, rng, share=1.0):
    """The template's wording with up to ``share`` of the words that may differ
    replaced; names, numbers and license talk stay."""
    words, talk = template.split(" "), re.compile("licen|copyright|hereby|granted|redistribution|use|rights|[0-9]", re.I)
    free = [i for i, w in enumerate(words) if _plain(w) and not (set(_plain(w)) & NAMES or talk.search(w))]
    total = sum(len(_plain(w)) for w in words)
    for i in rng.sample(free, min(int(share * MOST_DIFFERENT * total), len(free))):
        if len(_plain(words[i])) == 1:
            words[i] = f"zq{rng.choice('bcdfgh')}x"
    return " ".join(words)


def test_altered_notices_pass_the_compression_gate():
    """Every wording with as many words changed as may differ, in prose: nothing
    more is found without the gate; with half as many, each is found (runs of
    equal words may count a few differences more than the least)."""
    rng, gated, free = random.Random(8), Scanner(EVERY), Scanner(EVERY, least_saved=float("-inf"))
    prose = "the quick brown fox jumps over some lazy dog and then asks for water in the long dry valley beyond".split()
    for name, wordings in EVERY.items():
        for wording in wordings:
            for share in (1.0, 1.0, 0.5, 0.5):
                around = [" ".join(rng.choice(prose) for _ in range(rng.randrange(60))) for _ in range(2)]
                text = f"{around[0]} x {_altered(wording, rng, share)} x {around[1]}"
                got = gated.licenses(text)
                assert got == free.licenses(text), text
                assert share == 1.0 or name in [x[1] for x in got[1]], text


def test_compression_decides_before_the_wording_does():
    s = Scanner(EVERY)
    prose = "a driver needs the license of a state and the copyright of a song needs none of it".split()
    assert s.candidates(prose, [3, 9]) == [] and s.licenses(" ".join(prose))[1] == []
    words = _plain(TEXTS["BSD-3-Clause"][0])
    first = s.candidates(["x"] * 40 + words + ["y"] * 40, [i + 40 for i, w in enumerate(words) if w == "copyright"])[0]
    assert first[1] == "BSD-3-Clause" and first[0] > 0.9 * s.templates[first[2]].saves


def test_other_sentences_and_long_words():
    assert _found("Released under the Apache License 2.0.") == [(0, "Apache-2.0")]
    assert _found("// SPDX-License-Identifier: MIT\nint x;") == [(0, "MIT")]
    assert _found("# SPDX-License-Identifier: GPL-3.0-or-later") == [(0, "GPL-3.0")]
    assert _found("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.") == [(0, "CC-BY-SA-4.0")]
    assert _found("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.") == []
    assert _found("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
                  "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
                  "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
                  "Software is furnished to do so.") == [(0, "MIT")]
    long = "A" * 3_000_000
    assert _found(f"{long} Released under the MIT License. {long}\n{long}") == [(0, "MIT")]
    many = " ".join(f"w{i}" for i in range(200_000))
    assert _found(f"{many}\nReleased under the MIT License.\n{many}") == [(1, "MIT")]
