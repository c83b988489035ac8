"""Byte-level BPE encoding and decoding (2), as a monoid tree reduction.

A text is halved until its parts are short, the parts are encoded, and
neighbours are joined by encoding a window around the border anew.  The window
grows until what lies outside it provably stays as it is:

* Between pieces (matches of the pre-token pattern): a space that follows a
  character other than white space begins a new piece in whatever text
  surrounds it, and no piece looks across that border.  A part therefore ends
  in *runs* (text between such borders), and a join re-encodes only the last
  run of the left part with the first run of the right one (a longer window
  the longer they are), unless the cut itself is such a border.
* Inside a piece: a token sequence is the BPE encoding of its bytes exactly if
  every two neighbouring tokens encode to themselves.  A join re-encodes a
  window of tokens around the border and doubles it until the pairs at both
  of its ends hold.

Decoding is the same tree with concatenation as the join.  Within Spark the
documents are partitioned as they are read and encoded batch by batch; nothing
is shuffled.

Defined cases: a null text is empty (no ids); ties, repeated rows and rows with
a null id each give their own row; an empty table gives an empty result; only
``doc_id`` and ``text`` are read by the query.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from strata.llm.arrays import tidied

LEAF_CHARS = 4096  # a text up to this length is a leaf
LEAF_BYTES = 48  # a piece up to this length is merged directly
CACHE_RUNS = 250_000  # known runs held during a task (about 0.1 GB); emptied when full
KEPT_RUNS = 1_000_000  # held across tasks by a query that only encodes (about 0.3 GB)
_SPACED = re.compile(r"[^\S ] ")


@dataclass(slots=True)
class Node:
    """An encoded part of a text: its first and last run, and each run's ids."""

    first: str
    last: str
    ids: list[bytes]


class _Known(dict):
    """word -> ids of the run " word"; computed when missing, emptied when full."""

    def __init__(self, ids: Callable[[str], bytes]):
        super().__init__()
        self.ids = ids
        self.most = CACHE_RUNS

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.most:
            self.clear()
        ids = self.ids(" " + word)
        if len(word) < 64:
            self[word] = ids
        return ids


class ByteBPE:
    """Encoder and decoder of one rank file and pre-token pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.pieces = regex.compile(pattern).findall
        self._spaced = _Known(self._run_ids)
        self._packed = {t: i.to_bytes(4, "little") for t, i in ranks.items()}
        self.holds = lru_cache(maxsize=1 << 16)(self._pair_holds)

    def forget(self) -> None:
        self._spaced.clear()
        self.holds.cache_clear()

    @classmethod
    def load(cls, path: str, pattern: str) -> ByteBPE:
        with open(path, "rb") as f:
            return cls({base64.b64decode(t): int(i) for t, i in (line.split() for line in f if line.strip())}, pattern)

    # -- inside a piece

    def _merged(self, data: bytes) -> list[bytes]:
        """Tokens of a window: the pair of least rank is merged first."""
        if len(data) > 4 * LEAF_BYTES:
            return self._merged_long(data)
        parts = [data[i:i + 1] for i in range(len(data))]
        rank = self.ranks.get
        top = 1 << 60
        scores = [rank(a + b, top) for a, b in zip(parts, parts[1:])]
        while scores:
            best = min(scores)
            if best == top:
                break
            i = scores.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i:
                scores[i - 1] = rank(parts[i - 1] + parts[i], top)
            if i < len(scores):
                scores[i] = rank(parts[i] + parts[i + 1], top)
        return parts

    def _merged_long(self, data: bytes) -> list[bytes]:
        """The same over a heap of pairs, for windows that grew long."""
        n, rank, top = len(data), self.ranks.get, 1 << 60
        end = list(range(1, n + 1))  # of the part that begins here; 0 once merged away
        back = list(range(-1, n))  # begin of the part before the one that begins here
        heap = [(r, i) for i in range(n - 1) if (r := rank(data[i:i + 2], top)) < top]
        heapify(heap)
        while heap:
            r, i = heappop(heap)
            j = end[i]
            if not j or j >= n or rank(data[i:end[j]], top) != r:
                continue  # one of the two has changed meanwhile
            k = end[i] = end[j]
            end[j] = 0
            if k < n:
                back[k] = i
                if (r := rank(data[i:end[k]], top)) < top:
                    heappush(heap, (r, i))
            if i and (r := rank(data[back[i]:k], top)) < top:
                heappush(heap, (r, back[i]))
        out, i = [], 0
        while i < n:
            out.append(data[i:end[i]])
            i = end[i]
        return out

    def _pair_holds(self, a: bytes, b: bytes) -> bool:
        return self._merged(a + b) == [a, b]

    def piece_tokens(self, data: bytes) -> list[bytes]:
        """Tokens of one piece, by halves."""
        if data in self.ranks:
            return [data]
        if len(data) <= LEAF_BYTES:
            return self._merged(data)
        half = len(data) // 2
        return self.join_tokens(self.piece_tokens(data[:half]), self.piece_tokens(data[half:]))

    def join_tokens(self, left: list[bytes], right: list[bytes]) -> list[bytes]:
        """Encoding of the concatenation of two encoded strings."""
        if not left or not right or self.holds(left[-1], right[0]):
            return left + right
        a = b = 1
        while True:
            a, b = min(a, len(left)), min(b, len(right))
            middle = self._merged(b"".join(left[-a:] + right[:b]))
            grow = False
            if a < len(left) and not self.holds(left[-a - 1], middle[0]):
                a, grow = 2 * a, True
            if b < len(right) and not self.holds(middle[-1], right[b]):
                b, grow = 2 * b, True
            if not grow:
                return left[:-a] + middle + right[b:]

    # -- between pieces

    def _run_ids(self, run: str) -> bytes:
        packed = self._packed
        out = []
        for piece in self.pieces(run):
            data = piece.encode("utf-8", "surrogatepass")
            known = packed.get(data)
            out.append(known if known is not None else b"".join([packed[t] for t in self.piece_tokens(data)]))
        return b"".join(out)

    def run_ids(self, run: str) -> bytes:
        """Ids of one run."""
        if run[:1] == " " and len(run) <= 64:
            return self._spaced[run[1:]]
        return self._run_ids(run)

    def _leaf(self, text: str) -> Node:
        parts = text.split(" ")
        if not parts[0] or "" in parts or _SPACED.search(text):  # some spaces are no borders
            runs = [parts[0]]
            for p in parts[1:]:
                if runs[-1] and not runs[-1][-1].isspace():
                    runs.append(" " + p)
                else:
                    runs[-1] += " " + p
            return Node(runs[0], runs[-1], list(map(self.run_ids, runs)))
        ids = list(map(self._spaced.__getitem__, parts))
        ids[0] = self._run_ids(parts[0])
        return Node(parts[0], " " + parts[-1] if len(parts) > 1 else parts[0], ids)

    def _node(self, text: str) -> Node:
        if len(text) <= LEAF_CHARS:
            return self._leaf(text)
        half = len(text) // 2
        return self.join(self._node(text[:half]), self._node(text[half:]))

    def join(self, left: Node, right: Node) -> Node:
        """Encoding of the concatenation of two encoded texts."""
        if right.first[:1] == " " and not left.last[-1:].isspace():  # the cut is a border
            return Node(left.first, right.last, left.ids + right.ids)
        window = left.last + right.first
        first = left.first if len(left.ids) > 1 else window
        last = right.last if len(right.ids) > 1 else window
        return Node(first, last, [*left.ids[:-1], self._run_ids(window), *right.ids[1:]])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(self._node(text).ids) if text else b""

    def decode(self, ids: bytes) -> bytes:
        """Bytes of the ids; halves are decoded and concatenated."""
        if len(ids) <= 4 << 16:
            return b"".join(map(self.tokens.__getitem__, memoryview(ids).cast("I")))
        half = len(ids) // 8 * 4
        return self.decode(ids[:half]) + self.decode(ids[half:])


_LOADED: dict[tuple[str, str], ByteBPE] = {}


def worker_bpe(path: str, pattern: str, runs: int | None = None) -> ByteBPE:
    """One coder for each worker process, holding up to ``runs`` known runs
    (``CACHE_RUNS`` unless given)."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = ByteBPE.load(path, pattern)
    bpe = _LOADED[path, pattern]
    bpe._spaced.most = runs or CACHE_RUNS
    return bpe


def forget_runs() -> None:
    """Empties what the coders of the worker know; the vocabulary stays."""
    for bpe in _LOADED.values():
        bpe.forget()


def default_vocabulary() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def map_texts(docs: DataFrame, schema: str, row: Callable, keep: tuple[str, ...], text: str = "text",
              forget: bool = True) -> DataFrame:
    """``row(bytes) -> tuple`` of new columns for each text, beside ``keep``.
    At the end of a task the known runs go if ``forget``."""
    from pyspark.sql.types import StructType
    fields = StructType.fromDDL(schema).fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                out = [row("" if x is None else x) for x in part.column(text).to_pylist()]
                columns = list(zip(*out)) if out else [[] for _ in fields[len(keep):]]
                yield pa.RecordBatch.from_arrays(
                    [part.column(k) for k in keep] + [pa.array(c) for c in columns], names=fields)
        if forget:
            forget_runs()
    return docs.select(*keep, text).mapInArrow(tidied(run), schema)


def encode_decode(docs: DataFrame, path: str | None = None, pattern: str | None = None, keep_decoded: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids (binary, little-endian u32) and decoded (binary),
    or only whether decoding gives the text back."""
    if path is None or pattern is None:
        path, pattern = default_vocabulary()

    def row(text: str):
        bpe = worker_bpe(path, pattern)
        ids = bpe.encode(text)
        decoded = bpe.decode(ids)
        return len(ids) // 4, ids, decoded if keep_decoded else decoded == text.encode("utf-8", "surrogatepass")
    last = "decoded binary" if keep_decoded else "round_trip boolean"
    return map_texts(docs, f"doc_id long, n_tokens long, ids binary, {last}", row, ("doc_id",))


def digests(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: hashed where encoded, so
    that ids and decoded bytes of a corpus never leave the tasks.  The worker's
    tasks have this work alone, so it keeps the runs that it knows."""
    if path is None or pattern is None:
        path, pattern = default_vocabulary()

    def row(text: str):
        bpe = worker_bpe(path, pattern, KEPT_RUNS)
        ids = bpe.encode(text)
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(bpe.decode(ids)).hexdigest()
    return map_texts(docs, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", row, ("doc_id",), forget=False)


def query(spark, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op2_bpe_tree": query}
ORACLE: dict[str, str] = {}  # against tiktoken in tests/llm
