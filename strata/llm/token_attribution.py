"""Token counts (9): offset-mapped attribution.

A document is encoded once, as a whole.  The byte offsets of its tokens come
from the lengths of their bytes, and the offsets of its sections from the
section separator (a line feed ends a section and belongs to it).  Tokens and
sections are two sorted lists of intervals, joined by binary search.  A token
that lies in one section counts there.  A token that crosses borders goes, by
the rule given, to

* ``first``: the section of its first byte;
* ``last``: the section of its last byte;
* ``most``: the section that holds most of its bytes, the first one on ties.

So the counts of a document's sections always add up to its token count, which
encoding section by section does not give.

Spark partitions the documents; each batch is encoded and joined where it was
read, and nothing is shuffled.

Defined cases: a null or empty text has no section and no row; a text without
line feed is one section; a section may have no token; repeated rows and null
ids each give their rows; an empty table gives an empty result; only ``doc_id``
and the text column are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.bpe_tree import default_vocabulary, worker_bpe

RULES = ("first", "last", "most")
KNOWN_RUNS = 1_000_000  # runs a worker holds across tasks (about 0.4 GB): the only stage has the executor to itself
_LENGTHS: dict = {}


def _token_lengths(path: str, pattern: str) -> np.ndarray:
    """Bytes of each token, by id."""
    if (path, pattern) not in _LENGTHS:
        tokens = worker_bpe(path, pattern).tokens
        lengths = np.zeros(max(tokens) + 1, np.int64)
        for i, t in tokens.items():
            lengths[i] = len(t)
        _LENGTHS[path, pattern] = lengths
    return _LENGTHS[path, pattern]


def section_ends(data: np.ndarray, separator: int = 10) -> np.ndarray:
    """End offset of each section of a text's bytes."""
    ends = np.flatnonzero(data == separator) + 1
    return ends if len(ends) and ends[-1] == len(data) else np.append(ends, len(data))


def attribute(token_ends: np.ndarray, ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Section of each token, and whether the token crosses a border."""
    starts = np.concatenate(([0], token_ends[:-1])).astype(np.int64)
    low = np.searchsorted(ends, starts, "right")
    high = np.searchsorted(ends, token_ends, "left")
    if rule == "first":
        return low, high > low
    if rule == "last":
        return high, high > low
    owner = low.copy()
    for i in np.flatnonzero(high > low):  # few
        cuts = np.concatenate(([starts[i]], ends[low[i]:high[i]], [token_ends[i]]))
        owner[i] = low[i] + int(np.argmax(np.diff(cuts)))
    return owner, high > low


def section_tokens(docs: DataFrame, rule: str = "most", text: str = "text",
                   path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, section (from 0), first_byte, n_bytes, n_tokens, n_crossing
    (tokens counted here that also lie in another section)."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    if path is None or pattern is None:
        path, pattern = default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = _token_lengths(path, pattern)
        bpe = worker_bpe(path, pattern, KNOWN_RUNS)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows, out = [], ([], [], [], [], [])
                for i, x in enumerate(part.column(text).to_pylist()):
                    if not x:
                        continue
                    ids = np.frombuffer(bpe.encode(x), np.uint32)
                    ends = section_ends(np.frombuffer(x.encode("utf-8"), np.uint8))
                    owner, crossing = attribute(np.cumsum(lengths[ids]), ends, rule)
                    n = len(ends)
                    first = np.concatenate(([0], ends[:-1]))
                    rows.append(np.full(n, i))
                    for column, values in zip(out, (np.arange(n, dtype=np.int32), first, ends - first,
                                                    np.bincount(owner, minlength=n), np.bincount(owner[crossing], minlength=n))):
                        column.append(values)
                if rows:
                    ids = part.column("doc_id").take(pa.array(np.concatenate(rows)))
                    yield pa.RecordBatch.from_arrays([ids, *[pa.array(np.concatenate(c)) for c in out]], names=names)
    schema = "doc_id long, section int, first_byte long, n_bytes long, n_tokens long, n_crossing long"
    names = ["doc_id", "section", "first_byte", "n_bytes", "n_tokens", "n_crossing"]
    return docs.select("doc_id", text).mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    return section_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op9_token_attribution": query}
ORACLE: dict[str, str] = {}  # against token-by-token attribution in tests/llm
