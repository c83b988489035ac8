"""Token-ID / binary output (12): length-delimited binary records.

Frame of a record: the payload's length (8 bytes), the masked checksum of
those 8 bytes (4), the payload, the masked checksum of the payload (4); all
little-endian.  A checksum is crc32, rotated right by 15 bits and with a fixed
number added, so that a checksum stored in checksummed data does not defeat
it.  Payload: one byte that says whether there is an id, the id (8 bytes), and
the token ids, 2 bytes each if the vocabulary allows it and 4 otherwise (the
first byte says which).

Documents are dealt by ranges of the id, sorted and encoded by the task that
writes them.  A task writes files of about ``FILE_BYTES`` under names of its
own attempt, and returns one index row per record (file, offset, length,
tokens).  Spark writes these rows as a Parquet table: the offset index.  A file
counts only if the index names it, so a lost executor, a repeated or a
speculative attempt leaves at most a file that nobody reads.  The ids' order is
the order of (file, offset), and the index holds what a shuffled read needs.

The folder must be one that all executors share and that Arrow's file systems
open (a mounted path, HDFS or an object store).

Encoding: the vocabulary drops white space and joins nothing across it, so the
text is cut at spaces and line feeds, which gives the same ids, and the ids of
frequent words are kept in bounded dictionaries per worker.  The library's
special strings count as it takes them.

Defined cases: a null or empty text has the end id alone; a null id comes
first; rows of one id are ordered by a hash of their text and each give a
record; a very long text is one record; an empty table gives no file and an
empty result; only the id and text columns are read.
"""

from __future__ import annotations

import re
import struct
import uuid
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir

FILE_BYTES = 64 << 20
#: Text bytes that a task sorts and writes.
RANGE_BYTES = 64 << 20
INDEX = "doc_id long, part int, file int, name string, offset long, length long, n_tokens long"
#: Rotation and offset of masked checksums.
MASK_BITS, MASK_ADD = 15, 0xA282EAD8
_HEAD = struct.Struct("<QI")
_TAIL = struct.Struct("<I")
_ID = struct.Struct("<Bq")


def masked(data: bytes) -> int:
    c = crc32(data)
    return (((c >> MASK_BITS) | (c << (32 - MASK_BITS))) + MASK_ADD) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join((size, _TAIL.pack(masked(size)), payload, _TAIL.pack(masked(payload))))


class Damaged(ValueError):
    """A record whose length or payload does not match its checksum."""


def unframe(data: memoryview, at: int) -> tuple[memoryview, int]:
    """Payload of the frame at an offset, and the offset after it."""
    if at + _HEAD.size > len(data):
        raise Damaged(f"record at {at} is cut off")
    size, check = _HEAD.unpack_from(data, at)
    begin = at + _HEAD.size
    if check != masked(data[at:at + 8]) or begin + size + _TAIL.size > len(data):
        raise Damaged(f"length of the record at {at}")
    payload = data[begin:begin + size]
    if _TAIL.unpack_from(data, begin + size)[0] != masked(payload):
        raise Damaged(f"payload of the record at {at}")
    return payload, begin + size + _TAIL.size


def pack(doc_id: int | None, ids: np.ndarray, narrow: bool) -> bytes:
    flags = (doc_id is not None) + 2 * narrow
    return _ID.pack(flags, doc_id or 0) + ids.astype("<u2" if narrow else "<u4").tobytes()


def unpack(payload: memoryview) -> tuple[int | None, np.ndarray]:
    flags, doc_id = _ID.unpack_from(payload)
    return doc_id if flags & 1 else None, np.frombuffer(payload, "<u2" if flags & 2 else "<u4", offset=_ID.size).astype("<u4")


def open_folder(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """Arrow's file system and path of a folder that Spark names."""
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return pyarrow.fs.FileSystem.from_uri(uri) if "://" in uri else (pyarrow.fs.LocalFileSystem(), uri)


# ---------------------------------------------------------------------------
# Encoding
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class WordVocabulary:
    """A vocabulary file of the tokenizers library that drops white space."""

    path: str
    end_id: int | None = 2
    kept_words: int = 1 << 18
    longest_kept: int = 64

    def worker(self) -> "_Encoder":
        if self not in _ENCODERS:
            _ENCODERS[self] = _Encoder(self)
        return _ENCODERS[self]


class _Encoder:
    """Ids of whole texts, word by word.  Runs of Latin letters, single digits
    and runs of marks (but those of contractions and special strings) come out
    of the library's normaliser and splitter unchanged but for lower case, so
    their bytes go straight to the library's merges; a word with anything else
    goes through the whole library.  Two generations of ``kept_words`` words
    are kept: the older one goes when the newer is full, and words met again
    move on."""

    _PIECE = "[A-Za-zÀ-ÖØ-öø-ÿ]+|[0-9]|[!-&(-/:;=?@\\[-`{}~]+"
    _LETTERS, _PIECES, _SIMPLE = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+"), re.compile(_PIECE), re.compile(f"(?:{_PIECE})+")
    _LATIN = frozenset(filter(_LETTERS.fullmatch, map(chr, range(256))))

    def __init__(self, of: WordVocabulary):
        from tokenizers import Tokenizer, pre_tokenizers
        self.of, self.library, self.kept, self.older = of, Tokenizer.from_file(of.path), {}, {}
        self.merges = self.library.model
        self.narrow = max(self.library.get_vocab_size(), of.end_id or 0) <= 1 << 16
        self.end = b"" if of.end_id is None else struct.pack("<I", of.end_id)
        split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        #: The library's letter for each byte of a Latin letter or mark.
        self.letters = {b: split.pre_tokenize_str(bytes((c, b)).decode())[0][0][1] if c else split.pre_tokenize_str(chr(b))[0][0][0]
                        for c, bs in ((0, range(33, 127)), (0xC3, range(0x80, 0xC0))) for b in bs}
        self.marks = {m: self._merged(m) for m in ".,;:!?"}
        self.letters[0xC3] = split.pre_tokenize_str("\u00C0")[0][0][0]

    def _merged(self, piece: str) -> bytes:
        spelled = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.merges.tokenize(spelled)]).tobytes()

    def _keep(self, word: str, ids: bytes) -> bytes:
        if len(word) <= self.of.longest_kept:
            if len(self.kept) >= self.of.kept_words:
                self.kept, self.older = {}, self.kept
            self.kept[word] = ids
        return ids

    def _ids(self, word: str) -> bytes:
        if word[-1] in self.marks and word[-2:-1] in self._LATIN:  # a run of letters always ends before a mark
            head = word[:-1]
            return (self.kept.get(head) or self._ids(head)) + self.marks[word[-1]]
        ids = self.older.get(word) or self.kept.get(word)
        if ids:
            return self._keep(word, ids)
        if self._LETTERS.fullmatch(word):
            low = word.lower()
            return self._keep(word, self._merged(word) if low == word else self._ids(low))
        if self._SIMPLE.fullmatch(word):
            pieces = self._PIECES.findall(word)
            return b"".join(map(self._ids, pieces)) if len(pieces) > 1 else self._keep(word, self._merged(word))
        return self._keep(word, array("I", self.library.encode(word, add_special_tokens=False).ids).tobytes())

    def encode(self, text: str) -> np.ndarray:
        get, new = self.kept.get, self._ids
        out = [get(w) or new(w) for w in text.replace("\n", " ").split(" ") if w]
        out.append(self.end)
        return np.frombuffer(b"".join(out), "<u4")


_ENCODERS: dict = {}


# ---------------------------------------------------------------------------
# Writing
# ---------------------------------------------------------------------------

class _Files:
    """Files of one task attempt, each up to about ``limit`` bytes."""

    def __init__(self, folder: str, part: int, limit: int):
        (self.fs, self.path), self.part, self.limit = open_folder(folder), part, limit
        self.own, self.file, self.out, self.at = uuid.uuid4().hex, -1, None, 0

    def write(self, record: bytes) -> tuple[int, str, int]:
        """File number, name and offset of the record."""
        if self.out is None or self.at >= self.limit:
            self.close()
            self.file, self.at = self.file + 1, 0
            self.name = f"{self.part:07d}-{self.file:05d}-{self.own}.rec"
            self.out = self.fs.open_output_stream(f"{self.path}/{self.name}")
        begin = self.at
        self.out.write(record)
        self.at += len(record)
        return self.file, self.name, begin

    def close(self) -> None:
        if self.out is not None:
            self.out.close()


def write_records(docs: DataFrame, folder: str, vocabulary: WordVocabulary, text: str = "text",
                  file_bytes: int = FILE_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Writes all documents, in ascending id order, to ``folder/data`` and the
    offset index to ``folder/index``; returns the index as read again."""
    spark = docs.sparkSession
    fs, path = open_folder(folder)
    fs.create_dir(f"{path}/data", recursive=True)
    rows = docs.select("doc_id", F.col(text).alias("text"))
    total = rows.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0] or 0
    parts = max(int(-(-total // range_bytes)), min(int(spark.conf.get("spark.sql.shuffle.partitions")), int(-(-total // (1 << 20)))), 1)
    # Equal rows are told apart by where they stand, so that copies of one id spread too.
    dealt = (rows.withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
             .repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), "tie", "row")
             .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie").select("doc_id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, files = vocabulary.worker(), _Files(f"{folder}/data", TaskContext.get().partitionId(), file_bytes)
        for b in batches:
            ids, texts = b.column("doc_id").to_pylist(), b.column("text")
            out = []
            for i, doc_id in enumerate(ids):
                tokens = encoder.encode(texts[i].as_py() or "")
                record = frame(pack(doc_id, tokens, encoder.narrow))
                file, name, at = files.write(record)
                out.append((doc_id, files.part, file, name, at, len(record), len(tokens)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), _KINDS)], names=_NAMES)
        files.close()
    dealt.mapInArrow(run, INDEX).write.parquet(f"{folder}/index")
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


_NAMES = [x.split()[0] for x in INDEX.split(", ")]
_KINDS = [{"long": pa.int64(), "int": pa.int32(), "string": pa.string()}[x.split()[1]] for x in INDEX.split(", ")]


# ---------------------------------------------------------------------------
# Reading
# ---------------------------------------------------------------------------

def file_table(index: DataFrame) -> DataFrame:
    """One row per file: its name, how many tokens stand before it, and its
    length.  As many rows as files, so one window over them is narrow."""
    files = index.groupBy("part", "file", "name").agg(F.sum("n_tokens").alias("tokens"), F.sum("length").alias("bytes"))
    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("part", "file", "name", "bytes", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("before"))


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """Every record from its file, checked: doc_id, start (tokens of all
    records before it), n_tokens, ids_crc32, ids (little-endian, 4 bytes)."""
    files = file_table(index)
    n = max(index.select("name").distinct().count(), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_folder(f"{folder}/data")
        for b in batches:
            for name, size, start in zip(*(b.column(c).to_pylist() for c in ("name", "bytes", "before"))):
                with fs.open_input_file(f"{path}/{name}") as f:
                    data = memoryview(f.read())
                if len(data) != size:
                    raise Damaged(f"{name} has {len(data)} bytes, the index says {size}")
                at, out, held = 0, [], 0
                while at < len(data):
                    payload, at = unframe(data, at)
                    doc_id, ids = unpack(payload)
                    raw = ids.tobytes()
                    out.append((doc_id, start, len(ids), crc32(raw), raw))
                    start, held = start + len(ids), held + len(raw)
                    if held > 1 << 22 or at >= len(data):
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                        out, held = [], 0
    names = ["doc_id", "start", "n_tokens", "ids_crc32", "ids"]
    kinds = [pa.int64()] * 4 + [pa.binary()]
    return files.repartition(n).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def read_shuffled(index: DataFrame, folder: str, seed: int = 0, partitions: int | None = None) -> DataFrame:
    """Records in a random order that the seed fixes, each taken from its file
    by its offset: (position, doc_id, ids).  ``position`` is the order."""
    draw = F.xxhash64(F.lit(seed), "name", "offset")
    order = index.select("name", "offset", "length", draw.alias("position"))
    n = partitions or int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = order.repartitionByRange(n, "position", "name", "offset").sortWithinPartitions("position", "name", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_folder(f"{folder}/data")
        opened: dict = {}
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512).to_pylist()
                out: list = [None] * len(part)
                for i in sorted(range(len(part)), key=lambda i: (part[i]["name"], part[i]["offset"])):  # files in turn
                    r = part[i]
                    if r["name"] not in opened:
                        for f in opened.values():
                            f.close()
                        opened = {r["name"]: fs.open_input_file(f"{path}/{r['name']}")}
                    data = memoryview(opened[r["name"]].read_at(r["length"], r["offset"]))
                    doc_id, ids = unpack(unframe(data, 0)[0])
                    out[i] = (r["position"], doc_id, ids.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary()))],
                                                 names=["position", "doc_id", "ids"])
    return order.mapInArrow(run, "position long, doc_id long, ids binary")


def default_vocabulary() -> WordVocabulary:
    import public_tokenizers
    return WordVocabulary(public_tokenizers.path("word_bpe_49k.json"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(spark)}/records-{uuid.uuid4().hex}"
    index = write_records(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder, default_vocabulary())
    return read_records(index, folder).drop("ids")


QUERIES = {"op12_record_files": query}
ORACLE: dict[str, str] = {}  # beyond SQL; against the library in tests/llm
