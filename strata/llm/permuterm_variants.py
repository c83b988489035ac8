"""Spelling variant grouping (11): permuterm rotations.

Every word is marked with a terminator (``word$``) and rotated to each of its
places.  Two words that differ by one replaced character have rotations that
are equal but for their last character, the edited one; and where one word
lacks a character of the other, its whole rotation equals the other's rotation
without its last character.  So each rotation is sorted under itself and under
itself less its last character, and a scan of each group of equal prefixes
finds all neighbours.  A group holds one whole rotation at most and one
rotation for each letter, so the alphabet bounds it (about 90 letters), however
many rows a word has.

Words are counted from whole texts in Arrow batches (one dictionary per task
part), summed with map-side combining, and numbered by one global sort: largest
count first, then code-point order.  The number alone travels with the
rotations, and the best neighbour is the least number.  A word that may be
deleted from within a run of equal letters ("hello") meets its neighbour in
several groups; only the run's first place counts.  Roots follow the forms by
doubling: counts at least double from form to form, so six joins are enough.

Rotations of words with more than ``LONG`` characters are kept as a 127-bit
hash (taken from prefix sums, so that a word of n characters costs n and not
n * n), and the word is not written beside them.

Defined cases: a null or empty text has no words; a null id counts as the text
``null``; repeated rows count as often as they occur; a run is judged once per
document and then counted as often as it occurs there; a word without near
words has n_near 0, no form, and is its own root; an empty table gives an empty
result.  Only the id and text columns are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.graph import cut
from strata.operators.ranking import dense_index

MARK = "$"
LONG = 64
HELD = 1 << 17
_RUN = re.compile("[a-zÀ-ÿ]+")
_PRIME = (1 << 127) - 1
_BASE = 0x5DEECE66D1CE4E5B9A3C71F02B6D4C35


def spelled(doc: bytes, run: str, every: int) -> str:
    """The run, less one character if ``every`` divides its hash."""
    h = crc32(run.encode(), crc32(doc))
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, shortest: int = 5, least: int = 3, every: int = 97,
                text: str = "text") -> DataFrame:
    """(word, n) over all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            part = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return part
        for b in batches:
            ids, texts = b.column(0), b.column(1)
            for i in range(b.num_rows):
                t = texts[i].as_py()
                if not t:
                    continue
                doc = f"{'null' if (d := ids[i].as_py()) is None else d}:".encode()
                for word, n in Counter(_RUN.findall(t.encode().lower().decode())).items():  # bytes: A-Z alone
                    word = spelled(doc, word, every)
                    if len(word) >= shortest:
                        held[word] += n
                if len(held) >= HELD:
                    yield out()
        if held:
            yield out()
    return (docs.select("doc_id", text).mapInArrow(run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least))


# ---------------------------------------------------------------------------
# Rotations: (key, id, kind); kind 0 whole, 1 less its last character, 2 the
# same at the first place of a run of equal characters.
# ---------------------------------------------------------------------------

def _short_rotations(words: DataFrame) -> DataFrame:
    marked = F.concat("word", F.lit(MARK))
    n = F.length("word")
    at = F.col("at")
    turned = (words.filter(n < LONG).select("id", "word", marked.alias("m"), F.explode(F.sequence(F.lit(0), n)).alias("at"))
              .select("id", "word", "at", F.concat(F.expr("substring(m, at + 1)"), F.expr("substring(m, 1, at)")).alias("whole")))
    last = F.expr("substring(word, at, 1)")
    first = (at == 1) | (last != F.expr("substring(word, at - 1, 1)"))
    cut_off = F.struct(F.expr("substring(whole, 1, length(whole) - 1)").alias("key"), F.when(first, 2).otherwise(1).alias("kind"))
    both = F.when(at == 0, F.array(F.struct(F.col("whole").alias("key"), F.lit(0).alias("kind")))).otherwise(
        F.array(F.struct(F.col("whole").alias("key"), F.lit(0).alias("kind")), cut_off))
    return turned.select("id", F.inline(both)).select("key", "id", "kind")


def long_rotations(word: str) -> Iterator[tuple[str, int]]:
    """(key, kind) of every rotation; keys over ``LONG`` characters as hashes,
    from sums of the word written twice."""
    m = word + MARK
    size = len(m)
    sums, power = [0], [1]
    for c in m + m:
        sums.append((sums[-1] * _BASE + ord(c) + 1) % _PRIME)
        power.append(power[-1] * _BASE % _PRIME)

    def key(at: int, length: int) -> str:
        if length <= LONG:
            return (m + m)[at:at + length]
        return f"#{length}:{(sums[at + length] - sums[at] * power[length]) % _PRIME:x}"
    for at in range(size):
        yield key(at, size), 0
        if at:
            yield key(at, size - 1), 2 if at == 1 or word[at - 1] != word[at - 2] else 1


def _long_rotations(words: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, word in zip(b.column("id").to_pylist(), b.column("word").to_pylist()):
                keys, kinds = zip(*long_rotations(word))
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array([i] * len(keys), pa.int64()), pa.array(kinds, pa.int32())],
                                                 names=["key", "id", "kind"])
    return words.filter(F.length("word") >= LONG).select("id", "word").mapInArrow(run, "key string, id long, kind int")


def neighbours(words: DataFrame) -> DataFrame:
    """(id, n_near, best): how many near words a word has, and the least id
    among them; words without any have no row.  ``words(id, word)``."""
    turned = _short_rotations(words).unionByName(_long_rotations(words))
    group = Window.partitionBy("key")
    scan = group.orderBy(F.col("kind") == 0, "id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    whole = F.col("kind") == 0

    def less(kind: Column) -> Column:
        return F.sum(F.when(kind, 1).otherwise(0)).over(group)
    scanned = turned.select(
        "id", "kind", F.count("*").over(group).alias("size"), less(~whole).alias("cut"), less(F.col("kind") == 2).alias("cut_first"),
        F.first("id").over(scan).alias("one"), F.nth_value("id", 2).over(scan).alias("two"),
        F.max(F.when(whole, F.col("id"))).over(group).alias("whole"))
    # The least among the cut ones but oneself: they stand first in a group.
    other = F.when(F.col("one") == F.col("id"), F.when(F.col("cut") > 1, F.col("two"))).otherwise(F.col("one"))
    count = F.when(whole, F.col("cut_first")).otherwise(
        F.col("cut") - 1 + F.when((F.col("kind") == 2) & F.col("whole").isNotNull(), 1).otherwise(0))
    best = F.when(whole, F.when(F.col("cut") > 0, F.col("one"))).otherwise(F.least(other, "whole"))
    return (scanned.filter("size > 1").groupBy("id")
            .agg(F.sum(count).alias("n_near"), F.min(best).alias("best")))


def follow_forms(forms: DataFrame) -> DataFrame:
    """(id, root): the end of each chain of ``forms(id, form)``, by doubling."""
    hops = cut(forms.select("id", F.col("form").alias("root")))
    while True:
        further = hops.select(F.col("id").alias("root"), F.col("root").alias("next"))
        joined = cut(hops.join(further, "root", "left").select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        hops = joined.select("id", "root")
        if joined.filter("moved").isEmpty():
            return hops


def variants(counts: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every row of ``counts(word, n)``."""
    words = cut(dense_index(counts.select("word", "n"), ["n", "word"], descending=[True, False], name="id"))
    near = cut(neighbours(words))
    names = words.select(F.col("id").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    formed = near.join(names, "best", "left").withColumnRenamed("best", "form_id")
    own = words.join(formed, "id", "left")
    has = F.col("form_n") >= 2 * F.col("n")
    own = cut(own.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                         F.when(has, F.col("form_id")).alias("form_id"), F.when(has, F.col("form")).alias("form"),
                         F.when(has, F.col("form_n")).alias("form_n")))
    ends = follow_forms(own.filter("form_id is not null").select("id", F.col("form_id").alias("form")))
    ends = ends.join(words.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root").select("id", "root_word")
    return own.join(ends, "id", "left").select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, shortest: int = 5, least: int = 3, every: int = 97) -> DataFrame:
    """Variants of all words of ``docs``."""
    return variants(cut(word_counts(docs, shortest, least, every)))


def query(spark, sf_dir: str) -> DataFrame:
    return spelling_variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: Words by a crc32 of 256 entries derived from its polynomial; neighbours by
#: patterns with one character left out; chains by recursion.
_SQL = """
WITH RECURSIVE tab(i, bit, c) AS (
  SELECT CAST(range AS BIGINT), 0, CAST(range AS BIGINT) FROM range(256) UNION ALL
  SELECT i, bit + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM tab WHERE bit < 8),
t AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM tab WHERE bit = 8),
runs AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)),
per AS (SELECT doc_id, run, count(*) AS n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || run)) AS x FROM runs GROUP BY doc_id, run),
hashed AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295,
    list_transform(range(1, length(x), 2), lambda k: CAST((instr('0123456789ABCDEF', x[k]) - 1) * 16 + instr('0123456789ABCDEF', x[k + 1]) - 1 AS BIGINT))),
    lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS INTEGER) + 1]))) AS h FROM per, t),
spelled AS (SELECT CASE WHEN h % 97 = 0 THEN left(run, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2)
    ELSE run END AS word, n FROM hashed),
w AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelled WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
holes AS MATERIALIZED (SELECT word, i, left(word, CAST(i AS INTEGER) - 1) AS a, substr(word, CAST(i AS INTEGER) + 1) AS b FROM w, range(1, 500) g(i) WHERE i <= length(word)),
near AS MATERIALIZED (SELECT x.word, y.word AS other FROM holes x JOIN holes y ON x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT holes.word, w.word FROM holes JOIN w ON w.word = a || b UNION SELECT w.word, holes.word FROM holes JOIN w ON w.word = a || b),
best AS (SELECT near.word, count(*) AS n_near, min({'n': -o.n, 'word': near.other}) AS m FROM near JOIN w o ON o.word = near.other GROUP BY near.word),
own AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -m.n >= 2 * w.n THEN m.word END AS form,
  CASE WHEN -m.n >= 2 * w.n THEN -m.n END AS form_n FROM w LEFT JOIN best ON best.word = w.word),
chain(word, tip) AS (SELECT word, word FROM own UNION ALL SELECT chain.word, own.form FROM chain JOIN own ON own.word = chain.tip WHERE own.form IS NOT NULL)
SELECT own.word, own.form, chain.tip AS root, own.n, own.n_near, own.form_n
FROM own JOIN chain ON chain.word = own.word JOIN own e ON e.word = chain.tip WHERE e.form IS NULL"""

QUERIES = {"op11_permuterm_variants": query}
ORACLE = {"op11_permuterm_variants": _SQL}
