"""License scan (8): conditional compression.

A text is scanned in blocks of words around license talk; the length of a block
follows the template (``REACH`` classes, powers of two), not the lines, so
neither line ends nor the length of the lines matter: a notice is found inside
a long line, wrapped over lines (comment marks are no words) and beside another
one.  Every block is compressed by itself and with each template as a raw
zstandard dictionary.  A template becomes a candidate where the dictionary
saves at least ``LEAST_SAVED`` of the bytes that it saves on its own wording;
prose around a notice costs the same with and without the dictionary, so it
does not hide one.  Candidates are ranked by the bytes saved, and the winners
are confirmed by their exact wording, word for word: no more than
``MOST_DIFFERENT`` of the template's words missing or changed and its version
numbers and names unchanged, narrowed to the words that match; differences are
counted between the longest runs of equal words (difflib), which in long texts
with many changes may be a few more than the least number.  A confirmed
winner takes its words, and what ranks below it gets only words that are left.

Spark partitions the documents as they are read; nothing is shuffled, and a
task holds one batch of texts.  Blocks overlap at most threefold, so the bytes
compressed grow with the text, whatever its license talk.

Defined cases: a null or empty text has no block and no license; a very long
text is scanned whole, block by block; a word longer than all words of the
templates is compressed as a mark; a notice that repeats counts each time; ties
go to the template named first in the alphabet, then to the fewer differences;
``n_candidates`` counts the lines in which a word of license talk begins;
repeated rows and null ids each give their own row; an empty table gives an
empty result; only ``doc_id`` and ``text`` are read, whatever other columns are
called.  A template without license talk is found only around license talk.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

#: Short public license notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "All-rights-reserved": "All rights reserved.",
}
_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution. ")
_BSD_3 = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
    "from this software without specific prior written permission. ")
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT '
    "NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL "
    "THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
    "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")


def _gnu(kind: str, version: str) -> str:
    return (f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} License as "
            f"published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.")


#: Public license texts, headers and titles.
TEXTS = {
    "AGPL-3.0": (_gnu("Affero General Public", "3"), "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
        'to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF '
        "ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the "
        "License.",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND "
        "DISTRIBUTION"),
    "BSD-2-Clause": (_BSD_2 + _BSD_END,),
    "BSD-3-Clause": (_BSD_2 + _BSD_3 + _BSD_END,),
    "GPL-2.0": (_gnu("General Public", "2"), "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    "GPL-3.0": (_gnu("General Public", "3"), "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies.",),
    "LGPL-2.1": (_gnu("Lesser General Public", "2.1"), "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    "LGPL-3.0": (_gnu("Lesser General Public", "3"), "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    "MIT": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files '
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, '
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included "
        'in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR '
        "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN "
        "NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE "
        "SOFTWARE.",),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "Mozilla Public License Version 2.0"),
}
_CC = "This work is licensed under a Creative Commons {} 4.0 International License."
#: Other common one-sentence notices.
SENTENCES = {
    "Apache-2.0": ("Released under the Apache License 2.0.", "Licensed under the Apache License 2.0."),
    "CC-BY-4.0": (_CC.format("Attribution"),),
    "CC-BY-NC-4.0": (_CC.format("Attribution-NonCommercial"),),
    "CC-BY-SA-4.0": (_CC.format("Attribution-ShareAlike"),),
    "MIT": (TEXTS["MIT"][0][:TEXTS["MIT"][0].index(", subject to")] + ".",),
}
TEXTS = {n: (*TEXTS.get(n, ()), *SENTENCES.get(n, ()),
             *(f"SPDX-License-Identifier: {n}{x}" for x in (("", "-only", "-or-later") if "GPL" in n else ("",))))
         for n in sorted({*TEXTS, *SENTENCES})}
EVERY = {n: (*([TEMPLATES[n]] if n in TEMPLATES else []), *TEXTS.get(n, ())) for n in sorted({*TEMPLATES, *TEXTS})}
_TALK = re.compile(r"licen[sc]|copyright|all\W+rights\W+reserved|public\W+domain|\bspdx\b|hereby\W+granted|redistribution\W+and\W+use", re.I)
_WORD = re.compile(r"[A-Za-z0-9]+(?:[.-][A-Za-z0-9]+)*")
#: Words that tell one license from another; none may be missing.
NAMES = {"apache", "bsd", "mit", "cc", "by", "by-nc", "by-sa", "gnu", "lesser", "general", "mozilla", "reserved", "endorse",
         "attribution", "attribution-noncommercial", "attribution-sharealike"}
#: Words that make another license of a text that has them besides.
VARIANTS = {"lesser", "affero", "library", "by-nc", "by-sa", "by-nd", "by-nc-sa", "by-nc-nd", "attribution-noncommercial",
            "attribution-sharealike", "attribution-noderivatives", "attribution-noncommercial-sharealike",
            "attribution-noncommercial-noderivatives"}
MOST_DIFFERENT = 0.2
#: Share of the bytes that a template saves on itself.  Notices with a fifth of
#: their words changed save 0.37 or more in a block of prose.
LEAST_SAVED = 0.25
#: Words on either side of the first license talk of the smallest blocks.
REACH = 8
LEVEL = 12


def _words(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def _talk(text: str, starts: Sequence[int]) -> list[int]:
    """Numbers of the words, beginning at ``starts``, that hold license talk."""
    return [max(bisect_right(starts, m.start()) - 1, 0) for m in _TALK.finditer(text)]


def _compressor(dictionary: bytes | None = None) -> zstandard.ZstdCompressor:
    if dictionary is None or len(dictionary) < 8:  # shorter ones are none to zstandard
        return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
    given = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    given.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, dict_data=given)


def _blocks(talk: Sequence[int], reach: int) -> Iterator[list[int]]:
    """The words of license talk, those within ``reach`` of a first one together."""
    at = 0
    while at < len(talk):
        end = bisect_left(talk, talk[at] + reach, at)
        yield list(talk[at:end])
        at = end


class Template:
    """A wording of a license, and its compressor."""

    def __init__(self, name: str, text: str):
        self.name, self.words = name, _words(text)
        self.most = MOST_DIFFERENT * len(self.words)
        self.counts = Counter(self.words)
        self.needed = {w for w in self.words if w in NAMES or re.search(r"\d", w)}
        self.talk = _talk(text, [m.start() for m in _WORD.finditer(text)]) or range(0, len(self.words), int(self.most) + 1)
        self.reach = max(REACH, 1 << (len(self.words) + int(self.most)).bit_length())
        data = " ".join(self.words).encode("utf-8", "surrogatepass")
        self.given = _compressor(data)
        self.saves = len(_compressor().compress(data)) - len(self.given.compress(data))

    def match(self, have: Sequence[str]) -> tuple[int, int, int] | None:
        """(differences, begin, end) of the words that come closest: those of
        the template that they lack, or others between them if these are more;
        null if a name or a number is lacking or they differ too much."""
        if not self.needed.issubset(have) or len(self.words) - sum((Counter(have) & self.counts).values()) > self.most:
            return None
        same = [x for x in SequenceMatcher(None, have, self.words, autojunk=False).get_matching_blocks() if x.size]
        best = None
        for i in range(len(same)):
            kept = 0
            for j in range(i, len(same)):
                kept += same[j].size
                begin, end = same[i].a, same[j].a + same[j].size
                n = max(len(self.words) - kept, end - begin - kept)  # a changed word is one difference
                if n <= self.most and (best is None or n < best[0]) and self._whole(have, same[i:j + 1]):
                    best = n, begin, end
        return best

    def _whole(self, have: Sequence[str], same: Sequence) -> bool:
        """No name or number is lacking, and no word of another license is
        there besides."""
        own = {k for x in same for k in range(x.b, x.b + x.size)}
        theirs = {k for x in same for k in range(x.a, x.a + x.size)}
        return not any(w in self.needed and k not in own for k, w in enumerate(self.words)) and not any(
            have[k] in VARIANTS and k not in theirs for k in range(same[0].a, same[-1].a + same[-1].size))


class Scanner:
    """The templates; a name has one wording or several."""

    def __init__(self, templates: Mapping[str, str | Sequence[str]], least_saved: float = LEAST_SAVED):
        every = [Template(n, x) for n, t in sorted(templates.items()) for x in ([t] if isinstance(t, str) else t)]
        self.templates = [t for t in every if t.words]
        self.least_saved, self.alone = least_saved, _compressor()
        self.longest = max((len(w) for t in self.templates for w in t.words), default=0)

    def _bytes(self, words: Sequence[str]) -> bytes:
        return " ".join([w if len(w) <= self.longest else "?" for w in words]).encode("utf-8", "surrogatepass")

    def ranked(self, block: str) -> list[tuple[float, str]]:
        """(relative size reduction, template), the largest first."""
        data = self._bytes(_words(block))
        plain = len(self.alone.compress(data))
        return sorted(((1 - len(t.given.compress(data)) / plain, t.name) for t in self.templates), key=lambda x: (-x[0], x[1]))

    def candidates(self, words: Sequence[str], talk: Sequence[int]) -> list[tuple[int, str, int, list[int]]]:
        """(bytes saved, name, number of the template, words of license talk of
        the block), the most bytes first."""
        out = []
        for reach in sorted({t.reach for t in self.templates}):
            for inside in _blocks(talk, reach):
                block = self._bytes(words[max(inside[0] - reach, 0):inside[0] + 2 * reach])
                plain = len(self.alone.compress(block))
                for k, t in enumerate(self.templates):
                    if t.reach == reach:
                        saved = plain - len(t.given.compress(block))
                        if saved >= self.least_saved * t.saves:
                            out.append((saved, t.name, k, inside))
        return sorted(out, key=lambda x: (-x[0], *x[1:]))

    def _confirmed(self, words: Sequence[str], k: int, inside: Sequence[int]) -> list[tuple[int, int, int]]:
        """(differences, begin, end) of every place of a template at some words
        of license talk, the fewest differences first."""
        t, found = self.templates[k], set()
        n, more = len(t.words), int(t.most)
        for start in sorted({i - j for i in inside for j in t.talk}):
            first = max(start - more, 0)
            if x := t.match(words[first:max(start + n + more, 0)]):
                found.add((x[0], first + x[1], first + x[2]))
        return sorted(found)

    def licenses(self, text: str) -> tuple[int, list[tuple[int, str, float, int]]]:
        """Lines with license talk, and (line, template, reduction, word
        differences) of every confirmed block in the order of the text."""
        if not _TALK.search(text):
            return 0, []
        spans = [m.span() for m in _WORD.finditer(text)]
        words = [text[a:b].lower() for a, b in spans]
        feeds = [m.start() for m in re.finditer("\n", text)]
        lines = {bisect_right(feeds, m.start()) for m in _TALK.finditer(text)}
        talk = sorted(set(_talk(text, [a for a, _ in spans])))
        kept, taken = [], set()
        for _, name, k, inside in self.candidates(words, talk):
            for differences, begin, end in self._confirmed(words, k, inside):
                if taken.isdisjoint(range(begin, end)):
                    taken.update(range(begin, end))
                    data = self._bytes(words[begin:end])
                    reduction = 1 - len(self.templates[k].given.compress(data)) / len(self.alone.compress(data))
                    kept.append((begin, bisect_right(feeds, spans[begin][0]), name, reduction, differences))
        return len(lines), [x[1:] for x in sorted(kept)]


def scan_licenses(docs: DataFrame, templates: Mapping[str, str | Sequence[str]] = EVERY) -> DataFrame:
    """Per document: doc_id, n_candidates, n_confirmed, and ``found``: line,
    license, reduction and word differences of each confirmed block."""
    kind = pa.list_(pa.struct([("line", pa.int32()), ("license", pa.string()), ("reduction", pa.float64()), ("differences", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for batch in batches:
            n, found = [], []
            for x in batch.column("text"):
                lines, own = scanner.licenses(x.as_py() or "")
                n.append(lines)
                found.append([dict(zip(("line", "license", "reduction", "differences"), y, strict=True)) for y in own])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(list(map(len, found)), pa.int64()),
                                              pa.array(found, kind)], names=["doc_id", "n_candidates", "n_confirmed", "found"])
    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_candidates long, n_confirmed long, "
             "found array<struct<line:int,license:string,reduction:double,differences:int>>")


def query(spark, sf_dir: str) -> DataFrame:
    """All documents, with the licenses found as a sorted list."""
    from pyspark.sql import functions as F
    return (scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
            .select("doc_id", "n_candidates", "n_confirmed",
                    F.concat_ws(",", F.array_sort(F.array_distinct("found.license"))).alias("licenses")))


QUERIES = {"op8_license_compression": query}
ORACLE: dict[str, str] = {}  # against a word-by-word scan in tests/llm
