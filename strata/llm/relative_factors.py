"""Substring dedup (7): an exact window join in place of a relative Lempel-Ziv
parse.

Every document is a reference block for the documents after it, and for its own
later part.  The index of a block holds an *anchor* for each of its windows of
``WINDOW`` words: of the runs of ``GRAM`` words in the window, the one with the
least hash.  Equal windows have equal anchors at the same place, so windows
whose anchor occurs once have no earlier copy, and looking anchors up finds
every block that holds a window.

The join decides which windows occur earlier; factors are only made from them:
from a window that occurs earlier, the factor runs on as long as the following
windows point to the same place of the reference.  Windows that straddle the
border of two factors are looked up like all others (their anchor may point
elsewhere), so a border hides nothing.
Every word of a factor of ``WINDOW`` or more words is removed; windows are
judged on the input.  The earliest copy (smallest doc_id, then smallest start)
stays.

To move little, an anchor and all windows that it stands for travel as one
row, a hash of the words under them.  Occurrences with equal hashes are a class
and all but the first of it are copies.  A window of the first may still have
an earlier copy in another class of the same anchor, whose words differ further
on; only such classes send out their windows one by one.  A
passage that thousands share costs one row per occurrence and no pairs.

Defined cases: words are ``[^\\x20\\x09-\\x0D]+``; a null or empty text has no
words and keeps the empty text; rows with equal doc_id and text are one
document and each gets its result; of documents that share a doc_id but not the
text, an earlier start is earlier, then the one with the smaller text hash (32
bits tell their texts apart); a
null doc_id counts as the largest; an empty table gives an empty result; only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.llm.arrays import Words, chunks, gram_hashes, mix, span_hashes, tidied

WINDOW = 20
GRAM = 5
SPAN = WINDOW - GRAM + 1  # runs in a window; at most 16, see ``_unpacked``
NO_ID = (1 << 63) - 1  # stands for a null doc_id
_PLACE = np.uint64((1 << 24) - 1)


def _least_places(grams: np.ndarray) -> np.ndarray:
    """For each run of SPAN grams the place of the least, the first of equals.
    Their low bits give way to the place, which is counted in stretches of
    ``_PLACE`` + 1 grams that overlap, so that the length has no bound."""
    out, step = [], int(_PLACE) + 2 - SPAN
    for begin in range(0, len(grams) - SPAN + 1, step):
        part = grams[begin:begin + step + SPAN - 1]
        low = (part & ~_PLACE) | np.arange(len(part), dtype=np.uint64)
        n = 1
        least = low
        while 2 * n <= SPAN:
            least = np.minimum(least[:-n], least[n:])
            n *= 2
        if n < SPAN:
            least = np.minimum(least[:len(low) - SPAN + 1], least[SPAN - n:])
        out.append((least & _PLACE).astype(np.int64) + begin)
    return np.concatenate(out)


class Anchors:
    """The windows of some documents: ``at`` (word index of the window's first
    word), ``place`` (word index of its anchor) and ``key`` (anchor's hash)."""

    def __init__(self, words: Words):
        self.words, self.hash = words, words.hashes()
        doc = words.doc
        if len(doc) < WINDOW:
            self.at = self.place = np.empty(0, np.int64)
            self.key = np.empty(0, np.uint64)
            return
        grams = mix(gram_hashes(self.hash, GRAM) ^ np.uint64(0x5bd1e995))
        inside = doc[WINDOW - 1:] == doc[:len(doc) - WINDOW + 1]
        self.at = np.flatnonzero(inside)
        self.place = _least_places(grams)[self.at]
        self.key = grams[self.place]

    def runs(self) -> tuple[np.ndarray, np.ndarray]:
        """First and last index (into ``at``) of the windows of each anchor."""
        if not len(self.at):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        new = np.flatnonzero(np.concatenate(([True], (self.place[1:] != self.place[:-1]) | (np.diff(self.at) != 1))))
        return new, np.concatenate((new[1:], [len(self.at)])) - 1


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def index_blocks(docs: DataFrame) -> DataFrame:
    """row, key, n: the distinct anchors of each document, and how often it has
    them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            a = Anchors(Words(texts))
            first, _ = a.runs()
            key, doc = a.key[first], a.words.doc[a.at[first]]
            order = np.lexsort((key, doc))
            key, doc = key[order], doc[order]
            new = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])))) if len(key) else np.empty(0, np.int64)
            n = np.diff(np.concatenate((new, [len(key)])))
            rows = pa.array(doc[new])
            yield pa.RecordBatch.from_arrays([batch.column("__row").take(rows), _signed(key[new]), pa.array(n.astype(np.int32))],
                                             names=["row", "key", "n"])
    return docs.mapInArrow(tidied(run), "row long, key long, n int")


def _chosen(a: Anchors, batch: pa.RecordBatch, column: str, of: str) -> tuple[np.ndarray, np.ndarray]:
    """First and last window of the anchors whose key (or place in the
    document) is in the list that each document has in ``column``."""
    first, last = a.runs()
    doc = a.words.doc[a.at[first]]
    values = a.key[first].view(np.int64) if of == "key" else a.place[first] - a.words.first[doc]
    border, keep = np.searchsorted(doc, np.arange(batch.num_rows + 1)), np.zeros(len(first), bool)
    for i, wanted in enumerate(batch.column(column)):
        if wanted.is_valid:
            part = slice(border[i], border[i + 1])
            keep[part] = np.isin(values[part], wanted.values.to_numpy(zero_copy_only=False))
    return first[keep], last[keep]


def occurrences(docs: DataFrame) -> DataFrame:
    """key, same (hash of all words under the anchor's windows, and of its
    place among them), doc, version and ``at`` (see ``_unpacked``) of every
    anchor whose key is in the document's ``__keys``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            a = Anchors(Words(texts))
            first, last = _chosen(a, batch, "__keys", "key")
            if not len(first):
                continue
            start, place, doc = a.at[first], a.place[first], a.words.doc[a.at[first]]
            same = mix(span_hashes(a.hash, start, a.at[last] + WINDOW) ^ (place - start).astype(np.uint64))
            at = ((place - a.words.first[doc]) << 8) | ((place - start) << 4) | (last - first)
            rows = pa.array(doc)
            yield pa.RecordBatch.from_arrays([_signed(a.key[first]), _signed(same), *[batch.column(c).take(rows) for c in ("__doc", "__version")],
                                              pa.array(at)], names=["key", "same", "doc", "version", "at"])
    return docs.mapInArrow(tidied(run), "key long, same long, doc long, version int, at long")


def windows_at(docs: DataFrame) -> DataFrame:
    """window (hash), doc, version, start: every window of the anchors at the
    places in the document's ``__places``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            a = Anchors(Words(texts))
            first, last = _chosen(a, batch, "__places", "place")
            if not len(first):
                continue
            counts = last - first + 1
            each = a.at[np.repeat(first - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())]
            doc = a.words.doc[each]
            rows = pa.array(doc)
            yield pa.RecordBatch.from_arrays([_signed(span_hashes(a.hash, each, each + WINDOW)), *[batch.column(c).take(rows) for c in ("__doc", "__version")],
                                              pa.array((each - a.words.first[doc]).astype(np.int32))], names=["window", "doc", "version", "start"])
    return docs.mapInArrow(tidied(run), "window long, doc long, version int, start int")


def _unpacked(at: Column) -> tuple[Column, Column, Column]:
    """Place of the anchor in its document, words from its first window's
    start to it, and number of its windows, of an ``at`` value."""
    return F.shiftright(at, 8).cast("int"), F.shiftright(at, 4).bitwiseAND(15).cast("int"), (at.bitwiseAND(15) + 1).cast("int")


def _row_key(doc: Column, version: Column) -> Column:
    """Joins a document's results to its rows; those without id by their text."""
    return F.when(doc == NO_ID, version.cast("long")).otherwise(doc)


def copied(docs: DataFrame) -> DataFrame:
    """__row, __copies: for each row key the windows that occur earlier, an array
    of (version, start, n windows, reference document, its start).
    ``docs``: __row, __doc, __version, text; a row key need not be unique."""
    index = index_blocks(docs.select("__row", "text"))
    # Each frame is told its group's sum or first by a window: a join would make the frame twice and shuffle it twice.
    shared = index.withColumn("all", F.sum("n").over(Window.partitionBy("key"))).filter("all > 1")
    mine = shared.groupBy("row").agg(F.collect_list("key").alias("__keys")).withColumnRenamed("row", "__row")
    found = occurrences(docs.join(mine.hint("shuffle_hash"), "__row", "left"))
    found = found.withColumn("first", F.min(F.struct("doc", "at", "version", "key")).over(Window.partitionBy("same")))
    is_first = "doc = first.doc and at = first.at and version = first.version"
    classes = found.filter(is_first).groupBy("same").agg(F.first("first").alias("first")).select("same", "first.*")
    several = classes.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    # The first of each class, window by window, against the other classes.
    place, lead, n = _unpacked(F.col("at"))
    open_places = (classes.join(several, "key").groupBy(_row_key(F.col("doc"), F.col("version")).alias("__row"))
                   .agg(F.collect_set(place.cast("long")).alias("__places")))
    each = windows_at(docs.join(open_places.hint("shuffle_hash"), "__row", "left"))
    earliest = F.min(F.struct("doc", "start", "version")).over(Window.partitionBy("window"))
    later = (each.withColumn("ref", earliest).filter(F.struct("doc", "start", "version") != F.col("ref"))
             .select("doc", "version", "start", F.lit(1).alias("n"), F.col("ref.doc").alias("ref"), F.col("ref.start").alias("ref_start")))
    ref_place, ref_lead, _ = _unpacked(F.col("first.at"))
    whole = (found.filter(f"not ({is_first})")
             .select("doc", "version", (place - lead).alias("start"), n.alias("n"), F.col("first.doc").alias("ref"), (ref_place - ref_lead).alias("ref_start")))
    return (whole.union(later).groupBy(_row_key(F.col("doc"), F.col("version")).alias("__row"))
            .agg(F.sort_array(F.collect_list(F.struct("version", "start", "n", "ref", "ref_start"))).alias("__copies")))


def factors(copies: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Greedy factors (start, n words, reference document, its start) from the
    sorted copied windows of a document."""
    out: list[list[int]] = []
    for start, n, ref, ref_start in copies:
        if out and out[-1][2] == ref and ref_start - start == out[-1][3] - out[-1][0] and start <= out[-1][0] + out[-1][1] - WINDOW + 1:
            out[-1][1] = max(out[-1][1], start + n - 1 + WINDOW - out[-1][0])
        else:
            out.append([start, n - 1 + WINDOW, ref, ref_start])
    return [tuple(x) for x in out]


def parsed(docs: DataFrame, keep_text: bool) -> DataFrame:
    """Every row of ``docs`` with n_words, n_removed, factors and ``kept``: the
    runs of text that stay, joined by line feeds (all of it if all stays), or,
    if not keep_text, the sha256 of the words that stay, joined by one space.
    Extra columns with these names are replaced."""
    made = StructType.fromDDL("n_words long, n_removed long, kept string, "
                              "factors array<struct<start:int,n_words:int,ref_doc:long,ref_start:int>>").fields
    columns = [f for f in docs.schema.fields if f.name not in ("text", *[m.name for m in made])]
    # Both joins of the texts see the same columns, so that they share one shuffle.
    d = docs.select(*[f.name for f in columns], "text", F.coalesce("doc_id", F.lit(NO_ID)).alias("__doc"), F.hash("text").alias("__version"))
    d = d.withColumn("__row", _row_key(F.col("__doc"), F.col("__version")))
    found = copied(d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            w = Words(texts)
            n_words, n_removed, kept, parts = [], [], [], []
            me = batch.column("__version").to_pylist()
            for i, copies in enumerate(batch.column("__copies")):
                a, b = w.first[i], w.first[i + 1]
                fs = factors([tuple(c.values())[1:] for c in copies.as_py() if c["version"] == me[i]] if copies.is_valid else [])
                gone = np.zeros(b - a + 1, np.int64)
                for s, n, _, _ in fs:
                    gone[s] += 1
                    gone[s + n] -= 1
                stays = np.cumsum(gone[:-1]) == 0
                if not keep_text:
                    words = texts[i].split()
                    left = b" ".join([words[j] for j in np.flatnonzero(stays)] if fs else words)
                elif fs:  # the runs that stay, as they are
                    edge = np.diff(np.concatenate(([0], stays.astype(np.int8), [0])))
                    runs = zip(np.flatnonzero(edge == 1) + a, np.flatnonzero(edge == -1) + a - 1)
                    left = b"\n".join(w.buf[w.start[x]:w.end[y]].tobytes() for x, y in runs)
                else:
                    left = texts[i]
                n_words.append(b - a)
                n_removed.append(int((~stays).sum()))
                kept.append(left if keep_text else hashlib.sha256(left).hexdigest().encode())
                parts.append([dict(zip(("start", "n_words", "ref_doc", "ref_start"), f)) for f in fs])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in columns], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string()), pa.array(parts, kind)],
                names=[*[f.name for f in columns], "n_words", "n_removed", "kept", "factors"])
    kind = pa.list_(pa.struct([("start", pa.int32()), ("n_words", pa.int32()), ("ref_doc", pa.int64()), ("ref_start", pa.int32())]))
    return d.join(found.hint("shuffle_hash"), "__row", "left").mapInArrow(tidied(run), StructType([*columns, *made]))


def query(spark, sf_dir: str) -> DataFrame:
    return (parsed(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), keep_text=False)
            .select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256")))


QUERIES = {"op7_relative_factors": query}
#: All windows side by side; for tables of some thousand documents.
SQL = r"""
WITH split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
words AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM split),
starts AS (
  SELECT doc_id, n, pos, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS g
  FROM words),
ranked AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY g ORDER BY doc_id, pos) AS k FROM starts WHERE pos <= n - 19),
gone AS (SELECT DISTINCT doc_id, pos + i AS pos FROM ranked, range(20) AS r(i) WHERE k > 1),
kept AS (
  SELECT doc_id, count(gone.pos) AS n_removed, string_agg(word, ' ' ORDER BY words.pos) FILTER (WHERE gone.pos IS NULL) AS text
  FROM words LEFT JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT split.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)
"""
ORACLE: dict[str, str] = {"op7_relative_factors": SQL}
