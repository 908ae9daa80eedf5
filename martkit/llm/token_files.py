"""Token ids in ORC files (operator 11).

Documents are dealt to files by ranges of their id and encoded by the task that
writes the file, so the ids themselves are never shuffled. A row holds a
document's ids as a list of integers, which ORC writes run-length encoded; a
file is cut into stripes of STRIPE_BYTES, each with row indexes for every
INDEX_ROWS rows and Bloom filters on the document id. Readers take stripes in
parallel, skip stripes and row groups by these, and skip whole files by a small
table of the files' sizes, which also gives each file's place in the whole
sequence of ids.
"""

from __future__ import annotations

import os
import re
import sys
import unicodedata
import zlib
from array import array
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from martkit.llm.tables import byte_list, record, released, utf8
from martkit.operators.spread import left_lookup
from martkit.workspace import new_folder

STRIPE_BYTES = 16 << 20
INDEX_ROWS = 1000
BLOOM_ODDS = 0.01
WRITER_ROWS = 64  # that the ORC writer holds before it looks at the size of its stripe
CUT_CHARS = 1 << 16  # a longer text is encoded in parts
BATCH_CHARS = 1 << 24  # encoded at once
ROWS_BYTES = 1 << 24  # of texts that are encoded for one batch of rows
KEY_BYTES = 32  # longer matches are not remembered, so the memory's bytes are bounded too
SPACES = [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
MEMO = 500_000  # matches whose ids are remembered; of more, the half that was met most often
FIRST_GAP = 0xCD  # that starts U+0378 in UTF-8: no character before it is unassigned
_ASCII_SPACE = np.isin(np.arange(256), [c for c in SPACES if c < 0x80])
_CUT = re.compile(r"(?<=\w)[ \n](?=\w)")


def parts_of(text: str, size: int = CUT_CHARS) -> list[str]:
    """The text in parts of about ``size`` characters whose ids, one after the other, are those of the whole text.

    A part begins at a single space or line end between two word characters,
    where the pattern of byte-level BPE always begins a new match.
    """
    at, out = 0, []
    while len(text) - at > size and (cut := _CUT.search(text, at + size)):
        out.append(text[at : cut.start()])
        at = cut.start()
    out.append(text[at:])
    return out


def unassigned() -> str:
    """A pattern for characters that Python's Unicode tables don't know: libraries may differ on them."""
    known = np.array([unicodedata.category(chr(c)) != "Cn" for c in range(sys.maxunicode + 1)])
    edges = np.flatnonzero(np.diff(known.astype(np.int8), prepend=1, append=1))
    return "[" + "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in zip(edges[::2], edges[1::2])) + "]"


def byte_letters() -> dict[int, str]:
    """The character that stands for each byte in the tokens of a byte-level vocabulary."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of ranges, one range after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def _single_spaces(data: np.ndarray) -> np.ndarray:
    """Where a space stands between two characters that aren't white space; ``data`` is UTF-8 with 3 zeros on each side."""
    at = np.flatnonzero(data == 0x20)
    left, right = data[at - 1], data[at + 1]
    blank = _ASCII_SPACE[left] | _ASCII_SPACE[right]
    wide = np.flatnonzero((left >= 0x80) | (right >= 0x80))
    one = [data[at[wide] + k].astype(np.int64) for k in (-3, -2, -1, 1, 2, 3)]
    before, after = one[0] << 16 | one[1] << 8 | one[2], one[3] << 16 | one[4] << 8 | one[5]
    for raw in (chr(c).encode() for c in SPACES if c >= 0x80):
        value, bits = int.from_bytes(raw), 8 * len(raw)
        blank[wide] |= ((before & ((1 << bits) - 1)) == value) | ((after >> (24 - bits)) == value)
    return at[~blank]


def _distinct(whole: bytes, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each stretch between bounds the number of its value, and the first stretch of each value."""
    buffers = [None, pa.py_buffer(bounds.astype(np.int64, copy=False)), pa.py_buffer(whole)]
    number = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, buffers).dictionary_encode().indices.to_numpy()
    return number, np.flatnonzero(np.diff(np.maximum.accumulate(number), prepend=-1))


class Encoder:
    """A tokenizer of the tokenizers library; ``pattern`` is the split of its byte-level pre-tokenizer, where it has one.

    With the pattern, each different piece between single spaces is split
    once, and the library's model encodes each different match once for as long as it is
    remembered: such a space always begins a match of byte-level BPE. Parts with
    an added token's text, and pieces with an unassigned character, are encoded
    as a whole.
    """

    def __init__(self, file: str, pattern: str | None = None, unsure: str | None = None) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(file)
        self.matches = None
        if pattern is not None and self.library.normalizer is None:
            self.matches = regex.compile(pattern)
            added = [t.content for t in self.library.get_added_tokens_decoder().values()]
            self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)")
            self.unsure = re.compile(unsure or unassigned())
            self.letters = byte_letters()
            vocabulary = self.library.get_vocab()
            self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)  # bytes of each token
            self.sizes[list(vocabulary.values())] = list(map(len, vocabulary))
            self.memo = pa.array([], pa.large_string())
            self.ids, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)  # of the matches in the memo
            self.met = np.zeros(0, np.int64)

    def _forget(self) -> None:
        """Keep the half of the memo that was met most often."""
        kept = np.sort(np.argsort(self.met)[-(MEMO // 2) :])
        sizes = np.diff(self.ends)[kept]
        self.memo, self.ids = self.memo.take(kept), self.ids[_ranges(self.ends[kept], sizes)]
        self.ends, self.met = np.append(0, np.cumsum(sizes)), self.met[kept] // 2

    def _wholes(self, texts: list[str]) -> list[np.ndarray]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(f.ids, np.int32) for f in found]

    def _cut(self, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How many of the ids reach to each of these numbers of bytes."""
        return np.searchsorted(np.cumsum(self.sizes[ids]), ends, "right")

    def _learnt(self, matches: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of matches, one after the other, and the number of each one's ids."""
        tokens = self.library.model.tokenize
        spelt = [m.encode().decode("latin-1").translate(self.letters) for m in matches.to_numpy(zero_copy_only=False).tolist()]
        found = [[t.id for t in tokens(s)] for s in spelt]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int32, counts.sum()), counts

    def _matched(self, text: str) -> np.ndarray:
        """The ids of a text by its matches."""
        if len(self.memo) > MEMO:
            self._forget()
        matches = pa.array(self.matches.findall(text), pa.large_string()).dictionary_encode()
        distinct, numbers = matches.dictionary, matches.indices.to_numpy()
        known = pc.index_in(distinct, value_set=self.memo)
        places = known.fill_null(-1).to_numpy().astype(np.int64)
        long = pc.binary_length(distinct).to_numpy() > KEY_BYTES
        fresh = np.concatenate([np.flatnonzero((places < 0) & ~long), np.flatnonzero((places < 0) & long)])
        places[fresh] = len(self.memo) + np.arange(len(fresh))
        new = distinct.take(fresh)
        learnt, counts = self._learnt(new)
        ids = np.concatenate([self.ids, learnt])
        ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(counts)])
        met = np.append(self.met, np.zeros(len(fresh), np.int64))
        met[places] += np.bincount(numbers, minlength=len(distinct))
        kept = len(met) - int(long[fresh].sum())
        self.memo = pa.concat_arrays([self.memo, new.slice(0, kept - len(self.memo))])
        self.ids, self.ends, self.met = ids[: ends[kept]], ends[: kept + 1], met[:kept]
        numbers = places[numbers]
        return ids[_ranges(ends[numbers], ends[numbers + 1] - ends[numbers])]

    def _pieces(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of parts, one after the other, and the number of each part's ids: of any but empty parts."""
        raws = [p.encode() for p in parts]
        whole = b"".join([b"\0\0\0", *raws, b"\0\0\0"])
        data = np.frombuffer(whole, np.uint8)
        borders = np.cumsum([3, *map(len, raws)])
        begins, cut = np.zeros(len(data), bool), np.zeros(len(data), bool)
        begins[borders] = cut[borders] = cut[_single_spaces(data)] = True
        bounds = np.flatnonzero(cut)
        starts, sizes = bounds[:-1], np.diff(bounds)
        number, first = _distinct(whole, bounds)
        starts, sizes = starts[first], sizes[first]
        # the first piece of a part has no space to keep it from the piece before
        alone = begins[starts]
        joined = data[_ranges(starts[~alone], sizes[~alone])].tobytes().decode()
        if data.max() >= FIRST_GAP and self.unsure.search(joined):
            for i in np.flatnonzero(~alone).tolist():
                alone[i] = bool(self.unsure.search(whole[starts[i] : starts[i] + sizes[i]].decode()))
            joined = data[_ranges(starts[~alone], sizes[~alone])].tobytes().decode()
        inner, outer = np.flatnonzero(~alone), np.flatnonzero(alone)
        apart = self._wholes([whole[a : a + n].decode() for a, n in zip(starts[outer].tolist(), sizes[outer].tolist())])
        ids = self._matched(joined)
        counts = np.zeros(len(first), np.int64)
        counts[inner] = np.diff(self._cut(ids, np.cumsum(sizes[inner])), prepend=0)
        counts[outer] = [len(a) for a in apart]
        places = np.zeros(len(first), np.int64)
        places[inner] = np.cumsum(counts[inner]) - counts[inner]
        places[outer] = len(ids) + np.cumsum(counts[outer]) - counts[outer]
        ids = np.concatenate([ids, *apart])
        each = counts[number]
        total = np.append(0, np.cumsum(each))
        return ids[_ranges(places[number], each)], np.diff(total[np.searchsorted(bounds, borders)])

    def encode(self, parts: list[str]) -> list[bytes]:
        """The ids of each part as 32-bit integers."""
        out = [b""] * len(parts)
        split = [i for i, p in enumerate(parts) if p and self.matches is not None and not self.added.search(p)]
        if split:
            ids, counts = self._pieces([parts[i] for i in split])
            ends = 4 * np.cumsum(counts)
            raw = ids.astype(np.int32, copy=False).tobytes()
            for i, a, b in zip(split, (ends - 4 * counts).tolist(), ends.tolist()):
                out[i] = raw[a:b]
        for i in sorted(set(range(len(parts))).difference(split)):
            out[i] = array("i", self.library.encode(parts[i], add_special_tokens=False).ids).tobytes()
        return out


@lru_cache(maxsize=1)
def _kept_encoder(file: str, pattern: str | None, unsure: str | None) -> Encoder:
    """An encoder that the tasks of a worker use one after the other: its memory is bounded by MEMO."""
    return Encoder(file, pattern, unsure)


def _encoded(encoder: Encoder, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The number of ids of each text, the end id counted, and all ids one after the other."""
    end = array("i", [end_id]).tobytes()
    owners: list[int] = []
    found: list[bytes] = []
    waiting: list[str] = []
    chars = 0
    for i, text in enumerate(texts):
        for part in parts_of(text):
            if waiting and chars + len(part) > BATCH_CHARS:
                found += encoder.encode(waiting)
                waiting, chars = [], 0
            owners.append(i)
            waiting.append(part)
            chars += len(part)
    found += encoder.encode(waiting)
    last = np.flatnonzero(np.diff(owners, append=-1))
    for place in last.tolist():
        found[place] += end
    counts = np.bincount(owners, weights=[len(f) // 4 for f in found], minlength=len(texts)).astype(np.int64)
    return counts, np.frombuffer(b"".join(found), np.int32)


def _lists(counts: np.ndarray, ids: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))


def _rows_within(sizes: Sequence[int], most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most so many bytes together, one row at least."""
    first = total = 0
    for i, n in enumerate(sizes):
        if i > first and total + n > most:
            yield first, i
            first, total = i, 0
        total += n
    if first < len(sizes):
        yield first, len(sizes)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the time of one write."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def _tokens_path(path: str) -> str:
    return f"{path}/tokens"


def _files_path(path: str) -> str:
    return f"{path}/files"


def write_tokens(
    df: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2,
    stripe_bytes: int = STRIPE_BYTES, pattern: str | None = None,
) -> None:
    """Encode every whole text and write the ids, ``end_id`` after each text, in ascending order of the document id.

    ``tokenizer`` is the file of a byte-level BPE of the tokenizers library; the
    driver reads it. ``pattern``, the split of its pre-tokenizer, saves work, see
    :class:`Encoder`. Null and empty texts have the end id alone; bytes that
    aren't UTF-8 count as U+FFFD. A null id comes first; rows of one id come in
    the order of a hash of the text, and a hot id is spread over files. Each row
    is one document; other columns are not read. An empty table gives files
    without rows. The folder must not exist.
    """
    spark = df.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        sent = spark.sparkContext.broadcast((file.read(), pattern, pattern and unassigned()))
    kind = df.select(F.col(id_col)).schema[0].dataType.simpleString()
    ddl = f"doc_id {kind}, file int, before long, after long, ids array<int>"  # places in the file's sequence of ids
    schema = to_arrow_schema(spark.createDataFrame([], ddl).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        encoder = _kept_encoder(*sent.value)
        file, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            raws = byte_list(batch.column("raw"))
            rows = batch.column("row").cast(schema.field("doc_id").type)
            for first, end in _rows_within([len(r) for r in raws], ROWS_BYTES):
                counts, ids = _encoded(encoder, [r.decode("utf-8", "replace") for r in raws[first:end]], end_id)
                starts = before + np.cumsum(counts) - counts
                before += int(counts.sum())
                yield record({"doc_id": rows.slice(first, end - first), "file": np.full(end - first, file, np.int32),
                              "before": starts, "after": starts + counts, "ids": _lists(counts, ids)}, schema)

    raw = utf8(text_col)
    frame = df.select(F.col(id_col).alias("row"), raw.alias("raw"), F.xxhash64(raw).alias("print"),
                      F.monotonically_increasing_id().alias("nth"))  # so that copies of one row can be spread
    order = ["row", "print", "nth"]
    dealt = frame.repartitionByRange(*order).sortWithinPartitions(*order).select("row", "raw")
    writer = (
        dealt.mapInArrow(released(run), ddl).write.option("compression", "zstd")
        .option("orc.stripe.size", stripe_bytes).option("orc.rows.between.memory.checks", WRITER_ROWS)
        .option("orc.create.index", "true").option("orc.row.index.stride", INDEX_ROWS)
        .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", BLOOM_ODDS)
    )
    with _setting(spark, "spark.sql.orc.columnarWriterBatchSize", str(WRITER_ROWS)):
        writer.orc(_tokens_path(path))
    sizes = spark.read.orc(_tokens_path(path)).groupBy("file").agg(
        F.count("*").alias("n_docs"), F.max("after").alias("n_ids"),
        F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"),
    )
    earlier = W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)  # one row for each file
    placed = sizes.withColumn("start", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).cast("long"))
    placed.coalesce(1).write.orc(_files_path(path))


def files_of(spark: SparkSession, path: str) -> DataFrame:
    """A row for each file with documents: ``file``, ``n_docs``, ``n_ids``, ``first_id``, ``last_id`` and ``start``."""
    return spark.read.orc(_files_path(path))


def _placed(spark: SparkSession, path: str, tokens: DataFrame) -> DataFrame:
    starts = files_of(spark, path).select("file", F.col("start").alias("file_start"))
    joined = left_lookup(tokens, starts, ["file"])
    return joined.select("doc_id", (F.col("file_start") + F.col("before")).alias("start"),
                         (F.col("after") - F.col("before")).alias("n_tokens"), "ids")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Every document from the files: ``doc_id``, ``start`` (ids before it), ``n_tokens`` and ``ids``; stripes in parallel."""
    return _placed(spark, path, spark.read.orc(_tokens_path(path)))


def read_documents(spark: SparkSession, path: str, doc_ids: Sequence) -> DataFrame:
    """As ``read_tokens``, of the given ids only: stripes and row groups whose indexes or Bloom filters exclude them are skipped."""
    return _placed(spark, path, spark.read.orc(_tokens_path(path)).where(F.col("doc_id").isin(list(doc_ids))))


def read_span(spark: SparkSession, path: str, first: int, end: int) -> DataFrame:
    """The documents with ids at places ``first`` to ``end`` (exclusive), their ``ids`` cut to these.

    The table of files tells which ones to read; in them, row groups outside the
    span are skipped by the least and largest place of their rows.
    """
    files = files_of(spark, path).where((F.col("start") < end) & (F.col("start") + F.col("n_ids") > first))
    low, high = files.agg(F.min("file"), F.max("file")).first()
    tokens = spark.read.orc(_tokens_path(path))
    tokens = tokens.where("false") if low is None else tokens.where(F.col("file").between(low, high))
    if low is not None and low == high:
        start = files.first()["start"]
        tokens = tokens.where((F.col("before") < end - start) & (F.col("after") > first - start))
    rows = _placed(spark, path, tokens)
    skip = F.greatest(F.lit(first) - F.col("start"), F.lit(0))
    stop = F.least(F.lit(end) - F.col("start"), F.col("n_tokens"))
    rows = rows.where((F.col("start") < end) & (F.col("start") + F.col("n_tokens") > first))
    return rows.select("doc_id", (F.col("start") + skip).alias("start"), (stop - skip).alias("n_tokens"),
                       F.slice("ids", (skip + 1).cast("int"), (stop - skip).cast("int")).alias("ids"))


def document_tokens(docs: DataFrame, tokenizer: str, pattern: str | None = None) -> DataFrame:
    """Digest of the token files of all documents, read back from the files.

    ``ids_crc32`` is over the ids as little-endian 32-bit integers, the end id
    included. Null, empty and repeated rows as in ``write_tokens``.
    """
    spark = docs.sparkSession
    path = new_folder(spark, "token-files")
    write_tokens(docs, path, tokenizer, pattern=pattern)
    rows = read_tokens(spark, path)
    kind = rows.schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {kind}, start long, n_tokens long, ids_crc32 long"
    schema = to_arrow_schema(spark.createDataFrame([], ddl).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            offsets = ids.offsets.to_numpy()
            data = memoryview(ids.values.to_numpy().astype("<u4", copy=False)).cast("B")
            sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield record({"doc_id": batch.column("doc_id").cast(schema.field("doc_id").type), "start": batch.column("start"),
                          "n_tokens": np.diff(offsets).astype(np.int64), "ids_crc32": sums}, schema)

    return rows.mapInArrow(released(run), ddl)
