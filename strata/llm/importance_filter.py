"""Quality classifier (3): importance resampling.

Two generative models over hashed n-grams (words, pairs of words, runs of five
bytes) are counted: one of the target text (labelled documents of quality 1 that are not
toxic) and one of all raw text.  A document's log importance weight is the sum
over its n-grams of ``log((target + s) / (expected + s))``, where ``expected``
is what the target would count if it were raw text, so rare n-grams say little
and n-grams the target avoids say much.  Ratios are truncated: those above
``PLAIN`` count as 1, so plain prose has weight 0 or near it and a long
document cannot make up for what the target never says.  What chance adds to a
sum grows with the root of the text's length, so sums are tempered by
``sqrt(TYPICAL / length)``.  Documents are sampled without replacement
in proportion to their weights by Gumbel top-k: key = weight + Gumbel noise
(from a hash of doc_id), and the k largest keys are kept.  k is the number of
documents whose weight passes a threshold calibrated on held-out labels.

Scale: the raw model is counted over every document, in one pass, as counts
per task, added up in slices of the table; only the labelled sample (at most
``SAMPLE`` documents, by hash order) and the finished table of ``2**BITS``
numbers are broadcast, both bounded by parameters.  The k-th largest key is
found by counting keys in bins and narrowing, never by collecting keys.

Defined cases: a null or empty text has weight 0; a null doc_id draws its noise
as 0; labels with null fields are not used; without usable labels of both
kinds nothing can be told apart, every weight is 0 and every document is kept;
repeated rows share a key and are kept or rejected together; ties of the k-th
key are all kept; only ``doc_id`` and ``text`` are read of the documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from strata.llm.arrays import Words, chunks, gram_hashes, grams_inside, mix, tidied
from strata.llm.graph import cut

BITS = 20  # half of the buckets are for words and pairs, half for runs of letters
LETTERS = 5
SAMPLE = 20_000  # labelled documents used at most
SMOOTHING = 2.0
PLAIN = 0.3  # ratios above it say nothing
TYPICAL, SHORTEST = 2_000, 200  # bytes: a text of the first keeps its sum; shorter ones than the second count as that
SLICE = 1 << 14


def buckets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and document of each n-gram."""
    w = Words(texts, lower=True)
    h = w.hashes()
    inside = grams_inside(w.doc, 2)
    half = np.uint64(1 << (BITS - 1))
    low = half - np.uint64(1)
    letters = gram_hashes(w.buf.astype(np.uint64) + np.uint64(1), LETTERS)
    by_letter = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
    own = grams_inside(by_letter, LETTERS)
    letters, by_letter = letters[own], by_letter[:len(own)][own]
    return (np.concatenate((mix(h) & low, mix(gram_hashes(h, 2)[inside]) & low, (letters & low) + half)).astype(np.int64),
            np.concatenate((w.doc, w.doc[:len(inside)][inside], by_letter)))


@dataclass(frozen=True)
class Model:
    """Truncated log ratio per bucket, and the threshold of weights."""

    log_ratio: np.ndarray
    threshold: float


def labelled_sample(labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, good, fold: at most ``sample`` labelled documents, by hash order;
    a document with conflicting labels counts as not good."""
    one = (labels.filter("doc_id is not null and quality is not null and toxic is not null").groupBy("doc_id")
           .agg(F.min(((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int")).alias("good")))
    return (one.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(3)).cast("int"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))


def corpus_counts(docs: DataFrame, sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """N-gram counts of all documents, and of the target documents of the
    fitting folds."""
    tagged = docs.select("doc_id", "text").join(F.broadcast(sample.filter("good = 1 and fold > 0").select(
        "doc_id", F.lit(1).alias("target"))), "doc_id", "left")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((2, 1 << BITS), np.int64), 0

        def out() -> Iterator[pa.RecordBatch]:
            """Touched buckets of each slice: places (2 bytes) and both counts
            (4 bytes each)."""
            for at in range(0, 1 << BITS, SLICE):
                part = total[:, at:at + SLICE]
                some = np.flatnonzero(part[0])
                if len(some):
                    blob = some.astype("<u2").tobytes() + part[:, some].astype("<u4").tobytes()
                    yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([blob], pa.binary())], names=["at", "counts"])
        for batch, texts in chunks(batches):
            b, doc = buckets(texts)
            if seen + len(b) >= 1 << 32:
                yield from out()
                total[:], seen = 0, 0
            seen += len(b)
            total[0] += np.bincount(b, minlength=1 << BITS)
            mine = np.array([x is not None for x in batch.column("target").to_pylist()], bool)
            if mine.any():
                total[1] += np.bincount(b[mine[doc]], minlength=1 << BITS)
        yield from out()

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, SLICE), np.int64)
        for batch in batches:
            for x in batch.column("counts"):
                blob = x.as_py()
                n = len(blob) // 10
                total[:, np.frombuffer(blob, "<u2", n)] += np.frombuffer(blob, "<u4", offset=2 * n).reshape(2, n)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["at", "counts"])
    schema = "at int, counts binary"
    out = np.zeros((2, 1 << BITS), np.int64)
    for row in tagged.mapInArrow(tidied(count), schema).groupBy("at").applyInArrow(add, schema).collect():  # 2**BITS numbers
        out[:, row["at"]:row["at"] + SLICE] = np.frombuffer(row["counts"], np.int64).reshape(2, -1)
    return out[0], out[1]


def log_ratio(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    expected = target.sum() * (raw / max(raw.sum(), 1))
    ratio = (target + SMOOTHING) / (expected + SMOOTHING)
    return np.where(ratio <= PLAIN, np.log(ratio), 0.0)


def score(docs: DataFrame, **ratios: np.ndarray) -> DataFrame:
    """``docs`` without its text, with the tempered sum over each document's
    n-grams of every table given, by name."""
    held = docs.sparkSession.sparkContext.broadcast(ratios)  # 2**BITS numbers each
    keep = [f for f in docs.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            b, doc = buckets(texts)
            temper = np.sqrt(TYPICAL / np.maximum([len(t) for t in texts], SHORTEST))
            sums = [pa.array(np.bincount(doc, r[b], minlength=len(texts)) * temper) for r in held.value.values()]
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in keep], *sums], names=[*[f.name for f in keep], *ratios])
    return docs.mapInArrow(tidied(run), StructType([*keep, *[StructField(n, DoubleType()) for n in ratios]]))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Counts over all documents; the threshold from the held-out fold
    of the sample.  None if the labels don't hold both kinds."""
    known = cut(labelled_sample(labels, sample))
    raw, target = corpus_counts(docs, known)
    if not target.any():
        return None
    ratio = log_ratio(raw, target)
    held = known.filter("fold = 0")
    texts = docs.select("doc_id", "text").join(F.broadcast(held), "doc_id")
    rows = score(texts, weight=ratio).collect()  # a third of the sample or so
    good, weight = np.array([r["good"] for r in rows], bool), np.array([r["weight"] for r in rows])
    if good.all() or not good.any():
        return None
    # The threshold that errs least, each kind counting the same.
    cuts = np.unique(weight)
    cuts = (np.concatenate((cuts[:1] - 1, cuts)) + np.concatenate((cuts, cuts[-1:] + 1))) / 2
    lost = np.searchsorted(np.sort(weight[good]), cuts) / good.sum()
    caught = np.searchsorted(np.sort(weight[~good]), cuts) / (~good).sum()
    best = np.flatnonzero(caught - lost == (caught - lost).max())
    return Model(ratio, float(cuts[best].mean()))


def kth_largest(keys: DataFrame, k: int, key: str = "key", bins: int = 4096) -> float:
    """The k-th largest value, by counting in bins and narrowing to one bin."""
    low, high = keys.agg(F.min(key), F.max(key)).first()
    if k <= 0 or low is None:
        return float("inf")
    above = 0  # keys over ``high`` (those at ``high`` are inside at first)
    while low < high:
        width = (high - low) / bins
        at = F.least(F.floor((F.col(key) - low) / width), F.lit(bins - 1))
        found = (keys.filter((F.col(key) >= low) & (F.col(key) <= high)).groupBy(at.alias("bin"))
                 .agg(F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high")).orderBy(F.desc("bin")).collect())  # at most ``bins`` rows
        for r in found:
            if above + r["n"] >= k:
                low, high = r["low"], r["high"]
                break
            above += r["n"]
        else:
            return low
        if len(found) == 1 and r["n"] == 1:
            break
    return low


def resample(docs: DataFrame, labels: DataFrame, seed: int = 7) -> DataFrame:
    """doc_id, version (hash of the text), weight, key, kept for every document."""
    docs = docs.select("doc_id", F.xxhash64("text").alias("version"), "text")
    model = fit(docs, labels)
    if model is None:
        return docs.select("doc_id", "version", F.lit(0.0).alias("weight"), F.lit(0.0).alias("key"), F.lit(True).alias("kept"))
    u = (F.conv(F.substring(F.md5(F.concat_ws("/", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))), 1, 13), 16, 10)
         .cast("long") + 1) / F.lit(float(2 ** 52 + 2))
    gumbel = F.when(F.col("doc_id").isNull(), F.lit(0.0)).otherwise(-F.ln(-F.ln(u)))
    scored = cut(score(docs, weight=model.log_ratio).withColumn("key", F.col("weight") + gumbel))
    k = scored.filter(F.col("weight") >= model.threshold).count()
    return scored.withColumn("kept", F.col("key") >= F.lit(kth_largest(scored, k)))


def query(spark, sf_dir: str) -> DataFrame:
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return resample(docs, labels).select("doc_id", "weight", "key", "kept")


QUERIES = {"op3_importance_filter": query}
ORACLE: dict[str, str] = {}  # against dictionary counts and held-out labels in tests/llm
