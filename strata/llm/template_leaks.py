"""Benchmark decontamination (10): template canonicalisation.

Texts are turned into templates: names (capitalised words inside a sentence),
numbers and units of measure become typed placeholders, letters are lower-cased
and punctuation at word ends goes.  A capitalised word elsewhere (opening a
sentence, after a quote, bracket, line feed or two spaces) may be a name or
not: a window that holds one is looked up both with the word and with a
placeholder.  Every run of ``WINDOW`` template words of a
document is hash-joined with the windows of the benchmark items.  Slots of an
alignment must be consistent: each value that the item has in a slot (units in
the singular) must stand for one and the same value of the document, the most
frequent one, or the first of these.  Windows that hold another one are dropped.
An opening word that is the same in both is no slot.  A document leaks an item
if one of these holds for the windows that are left:

* they are at least ``LEAST_SHARE`` of the item's windows, on all alignments;
* an unbroken run of matched words on one alignment holds at least
  ``LEAST_RUN`` words that are no slots, whatever its share (excerpts);
* one alignment without any dropped window has at least ``LEAST_COVER`` of the
  item's words (a changed word costs a short item up to ``WINDOW`` windows).

So a question with other numbers or names in it is caught, and
text that only has numbers in the same places is not.

Native: DataFrame functions only.  Documents are not shuffled: their windows
are exploded where they are read and joined with the broadcast benchmark
windows (size checked; a larger benchmark is joined by shuffle).  Only matched
windows are aggregated.  Texts are read again for the slots of documents that
matched an item with slots, by a join with the few keys.

Defined cases: null and empty texts, and items of fewer than ``WINDOW`` words
(too little to tell), never match; rows with equal doc_id and text are one
document and all get its result; a repeated item_id counts as one item with
the windows of all its texts; a null doc_id is a key like others; an empty
benchmark or table gives no leak.  Only ``doc_id``/``text`` and
``item_id``/``text`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.graph import cut, few

WINDOW = 5
LEAST_SHARE = 0.8
LEAST_RUN = 13
LEAST_COVER = 0.9
#: Windows of benchmarks that are broadcast at most (about 40 bytes each).
BROADCAST_WINDOWS = 500_000
#: Units of measure and money.
UNITS = ("mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams ounce ounces pound pounds ton tons "
         "ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks "
         "month months year years meter meters metre metres kilometer kilometers kilometre kilometres cent cents "
         "dollar dollars euro euros percent degrees mph kmh").split()
NAME, NUMBER, UNIT = "\ue000", "\ue001", "\ue002"  # private-use characters
OPENING = "\ue003"  # precedes a word that may be a name
_WORD_CHARS = rf"\p{{L}}\p{{N}}{NAME}{NUMBER}{UNIT}{OPENING}"
_SLOT = f"[{NAME}{NUMBER}{UNIT}{OPENING}]"
# A name has a small letter: words in capitals, like I and A, are words.
_CAPITALISED = r"\p{Lu}(?=[\p{L}\p{M}'’-]*\p{Ll})[\p{L}\p{M}'’-]*"


def _words(text: Column) -> Column:
    """Words of a text, without punctuation at their ends."""
    plain = F.regexp_replace(F.concat(F.lit(" "), text, F.lit(" ")), rf"[^{_WORD_CHARS}]*\s[^{_WORD_CHARS}]*", " ")
    return F.filter(F.split(F.trim(plain), " "), lambda w: w != "")


def _template(text: Column) -> Column:
    """The text with placeholders, and OPENING before each word that may be a
    name; it has the same words in number."""
    t = F.regexp_replace(text, rf"(?=\p{{Lu}})(?<=[\p{{L}}\p{{N}},;] ){_CAPITALISED}", NAME)
    t = F.regexp_replace(t, rf"(?=\p{{Lu}})(?<![\p{{L}}\p{{N}}\p{{M}}])(?<![\p{{L}}\p{{N}}]['’-]){_CAPITALISED}", f"{OPENING}$0")
    t = F.regexp_replace(F.lower(t), rf"(?=[\d+-])(?<![\p{{L}}\p{{N}}])[+-]?\d+(?:[.,]\d+)*", NUMBER)
    return F.regexp_replace(t, rf"(?<={NUMBER} ?)(?:{'|'.join(UNITS)})(?![\p{{L}}\p{{N}}])", UNIT)


def _as_name(word: Column) -> Column:
    return F.regexp_replace(word, rf"{OPENING}[\p{{L}}\p{{M}}'’-]*", NAME)


def windows(df: DataFrame, *keys: str) -> DataFrame:
    """keys, at, window (hash): every run of WINDOW template words, and once
    more with its opening words as names if it has any."""
    def hashes(change) -> Column:
        return F.transform("__w", lambda w: F.xxhash64(F.when(w.contains(OPENING), change(w)).otherwise(w)))

    def run(words: str, i: Column) -> Column:
        return F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])
    runs = F.when(F.size("__a") >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size("__a") - WINDOW), lambda i: F.struct(run("__a", i).alias("a"), run("__b", i).alias("b"))))
    return (df.select(*keys, _words(_template(F.col("text"))).alias("__w"))
            .select(*keys, hashes(lambda w: F.replace(w, F.lit(OPENING), F.lit(""))).alias("__a"), hashes(_as_name).alias("__b"))
            .select(*keys, F.posexplode(runs).alias("at", "__r"))
            .select(*keys, "at", F.explode(F.when(F.expr("__r.a = __r.b"), F.array("__r.a")).otherwise(F.array("__r.a", "__r.b"))).alias("window")))


def _singular(kind: Column, value: Column) -> Column:
    one = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "feet$", "foot"), "inches$", "inch"), "(?<=[a-z]{2})s$", "")
    return F.when(kind.endswith(UNIT), one).otherwise(value)


def _words_of(hit: Column) -> Column:
    """Places of the item's words in the windows ``hit``, in order."""
    return F.array_sort(F.array_distinct(F.flatten(F.transform(hit, lambda h: F.sequence(h, h + (WINDOW - 1))))))


def _longest(places: Column, slots: Column) -> Column:
    """Most words that are no slots in an unbroken run of places."""
    start = F.struct(F.lit(-2).alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(x: Column, at: Column) -> Column:
        run = F.when(at == x["last"] + 1, x["run"]).otherwise(0) + F.when(F.array_contains(slots, at), 0).otherwise(1)
        return F.struct(at.alias("last"), run.alias("run"), F.greatest(x["best"], run).alias("best"))
    return F.aggregate(places, start, step, lambda x: x["best"])


def _slot_places(matched: DataFrame, docs: DataFrame, items: DataFrame) -> DataFrame:
    """Of the matched alignments (doc_id, version, item_id, diagonal), the
    places of their slots, and of those that are not consistent (bad)."""
    def slots(df: DataFrame, *keys: str) -> DataFrame:
        template, own = _words(_template(F.col("text"))), _words(F.col("text"))
        return (df.select(*keys, template.alias("t"), own.alias("o"))
                .select(*keys, F.posexplode(F.arrays_zip("t", "o")).alias("at", "w"))
                .filter(F.col("w.t").rlike(_SLOT))
                .select(*keys, "at", _as_name(F.col("w.t")).alias("kind"), _singular(F.col("w.t"), F.lower("w.o")).alias("value"), F.col("w.t").contains(OPENING).alias("opening")))
    mine = slots(items, "item_id").select("item_id", F.col("at").alias("item_at"), "kind", F.col("value").alias("item_value"), "opening")
    runs = (matched.join(mine, "item_id").filter(F.array_contains(_words_of(F.col("hit")), F.col("item_at")))
            .withColumn("at", F.col("item_at") + F.col("diagonal")))
    theirs = slots(docs, "doc_id", "version").withColumnsRenamed({"value": "doc_value", "opening": "doc_opening"}).drop("kind")
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"d.{c}")) for c in ("doc_id", "version", "at")]
    pairs = runs.alias("r").join(theirs.alias("d"), same).filter("not ((opening or doc_opening) and item_value = doc_value)").select(
        "r.doc_id", "r.version", "r.item_id", "r.diagonal", "r.kind", "r.item_value", "r.item_at", "d.doc_value")
    alignment = ["doc_id", "version", "item_id", "diagonal"]
    values = pairs.groupBy(*alignment, "kind", "item_value", "doc_value").agg(F.collect_set("item_at").alias("places"))
    rank = F.struct(F.size("places").alias("n"), (-F.array_min("places")).alias("first"), "places")
    return (values.groupBy(*alignment, "kind", "item_value").agg(F.max(rank)["places"].alias("good"), F.flatten(F.collect_list("places")).alias("places"))
            .groupBy(*alignment).agg(F.flatten(F.collect_list("places")).alias("slots"),
                                     F.flatten(F.collect_list(F.array_except("places", "good"))).alias("bad")))


def leaks(docs: DataFrame, benchmark: DataFrame, least_share: float = LEAST_SHARE, least_run: int = LEAST_RUN,
          least_cover: float = LEAST_COVER) -> DataFrame:
    """doc_id, version (hash of the text), item_id, share: each item that a
    document leaks, with its share of the item's windows."""
    items = benchmark.select("item_id", "text").filter("item_id is not null and text is not null")
    d = docs.select("doc_id", F.xxhash64("text").alias("version"), "text")
    known = windows(items, "item_id").select("item_id", F.col("at").alias("item_at"), "window").distinct()
    known = cut(known)
    total = known.groupBy("item_id").agg(F.countDistinct("item_at").alias("n"))
    side = F.broadcast(known) if known.count() <= BROADCAST_WINDOWS else known
    found = (windows(d, "doc_id", "version").join(side, "window")
             .withColumn("diagonal", F.col("at") - F.col("item_at")))
    runs = cut(found.groupBy("doc_id", "version", "item_id", "diagonal").agg(F.collect_set("item_at").alias("hit")))

    def enough(r: DataFrame) -> DataFrame:
        """Of alignments with the places of their slots and bad ones."""
        left = F.filter("hit", lambda h: ~F.exists("bad", lambda b: b.between(h, h + (WINDOW - 1))))
        r = r.withColumn("left", left).withColumn("words", _words_of(F.col("left"))).join(total, "item_id")
        share = F.size(F.array_distinct(F.flatten(F.collect_list("left")))) / F.first("n")
        covered = (F.size("bad") == 0) & (F.size("words") >= least_cover * (F.col("n") + (WINDOW - 1)))
        return (r.groupBy("doc_id", "version", "item_id")
                .agg(share.alias("share"), F.max(_longest(F.col("words"), F.col("slots"))).alias("run"), F.max(covered).alias("covered"))
                .filter((F.col("share") >= least_share) | (F.col("run") >= least_run) | F.col("covered")).drop("run", "covered"))
    none = F.array().cast("array<int>")
    whole = enough(runs.withColumn("slots", none).withColumn("bad", none))
    slotted = items.filter(_template(F.col("text")).rlike(_SLOT))
    doubtful = cut(whole.join(slotted.select("item_id").distinct(), "item_id", "left_semi"))
    n = doubtful.count()
    if not n:
        return whole
    keys = doubtful.select("doc_id", "version").distinct()
    few = F.broadcast(keys) if n <= BROADCAST_WINDOWS else keys
    texts = d.alias("d").join(few.alias("k"), F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("d.version") == F.col("k.version")),
                              "left_semi").dropDuplicates(["doc_id", "version"])
    own = runs.join(doubtful.select("doc_id", "version", "item_id").withColumnRenamed("doc_id", "i"), ["version", "item_id"]).filter(
        F.col("doc_id").eqNullSafe(F.col("i"))).drop("i")
    places = _slot_places(own, texts, slotted)
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"p.{c}")) for c in ("doc_id", "version", "item_id", "diagonal")]
    return enough(runs.alias("r").join(places.alias("p"), same, "left").select(
        "r.*", F.coalesce("p.slots", none).alias("slots"), F.coalesce("p.bad", none).alias("bad")))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Keys (doc_id, version) of leaking documents with their items."""
    return leaks(docs, benchmark).groupBy("doc_id", "version").agg(F.array_sort(F.collect_set("item_id")).alias("items"))


def judged(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with ``__items``: the items that each document leaks, or null."""
    found = few(contaminated(docs, benchmark).withColumnsRenamed({"doc_id": "__id", "version": "__version", "items": "__items"}))
    return (docs.join(found, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__version")), "left")
            .drop("__id", "__version"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    keys = docs.select("doc_id", F.xxhash64("text").alias("version"))
    found = contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).alias("f")
    same = F.col("k.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("k.version") == F.col("f.version"))
    return keys.alias("k").join(found, same, "left").select(
        "k.doc_id", F.col("items").isNotNull().alias("leaks"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.concat_ws(",", F.transform("items", lambda x: x.cast("string"))).alias("items"))


QUERIES = {"op10_template_leaks": query}
ORACLE: dict[str, str] = {}  # against a Python version in tests/llm
