"""Language-model scores from a log-frequency Bloom filter (operator 5).

Training counts all words and pairs of words. A pair counted c times has the
level 1 + log2(c), rounded down; the filter holds one entry for each of its
levels, and probing level after level gives the quantised count back. Pairs are
in the order of the hash of the last word, then of the pair, and cut into cells
of bounded size with a filter each, so a word that ends many pairs has many
cells. Workers get the cells in blocks of bounded size with the words that end
their pairs; a text's score is a sum over its words, so blocks are probed one
after the other and their sums added. A word after another has the probability
(pairs + STRENGTH * p) / (count of the one before + STRENGTH), p being the
word's own probability with one added to each count.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from martkit.llm.tables import bounds_of, byte_list, held_out, record, utf8
from martkit.workspace import written

HASHES = 4  # probes for each entry
BITS = 6  # of the filter for each entry: about 6 % of strange pairs look counted once
STRENGTH = 200.0
PREFIX = 20  # bits of the last word's hash on top of a pair's key
BUCKET_BYTES = 64 << 20  # of text for each bucket that pairs are dealt to
MIN_BUCKETS = 256
SAMPLE_BYTES, SAMPLE_ROWS, SAMPLE_CUT = 2 << 20, 200, 64 << 10  # least text that tells where buckets start
LIST_KEYS = 2048  # in a row that is dealt
MERGE_KEYS = 1 << 21  # that wait at least before they are added up
CELL_KEYS = 1 << 18  # of the model's rows
BLOCK_BYTES = 128 << 20
FETCH_BYTES = 8 << 20  # of the model that the driver reads at a time
TEXT_BYTES = 8 << 20  # of text whose words are counted together
SCORE_BYTES = 1 << 20  # of text that is scored together

END = xxhash.xxh3_64_intdigest(b"\n")  # no word holds a line break
_MIX = np.uint64(0x94D049BB133111EB)
_LOW = np.uint64(64 - PREFIX)


def token_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the texts' words, an end after each text, and the number of tokens of each text."""
    out = array("Q")
    sizes = []
    for text in texts:
        words = text.lower().split()  # bytes: only A-Z change, and white space is 9 to 13 and 32
        out.extend(map(xxhash.xxh3_64_intdigest, words))
        out.append(END)
        sizes.append(len(words) + 1)
    return np.frombuffer(out, np.uint64), np.array(sizes, np.int64)


def _before(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The token before each; an end before the first of a text."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[:1] = END
    return before


def _pair_keys(tokens: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Hash of each token and the one before, with the first bits of the token's own hash on top."""
    mixed = (before * np.uint64(0x9E3779B97F4A7C15)) ^ ((tokens << np.uint64(17)) | (tokens >> np.uint64(47)))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * _MIX
    mixed ^= mixed >> np.uint64(32)
    return (tokens >> _LOW << _LOW) | (mixed >> np.uint64(PREFIX))


def _levels(counts: np.ndarray) -> np.ndarray:
    return np.frexp(counts.astype(np.float64))[1]


def _entries(keys: np.ndarray, level: int, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """The bits of each key's entry for a level, in a filter of so many bits."""
    h = (keys + np.uint64(level * 0xD6E8FEB86659FD93 % (1 << 64))) * np.uint64(0xA0761D6478BD642F)
    h ^= h >> np.uint64(31)
    step = (h * _MIX) >> np.uint64(32)
    for i in range(HASHES):
        yield ((h + np.uint64(i) * step) >> np.uint64(8)) % sizes


def _filter(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, int]:
    levels = _levels(counts)
    size = np.uint64(max(int(levels.sum()) * BITS, 64))
    bits = np.zeros(int(size), np.uint8)
    for level in range(1, int(levels.max(initial=0)) + 1):
        for places in _entries(keys[levels >= level], level, size):
            bits[places] = 1
    return np.packbits(bits, bitorder="little").tobytes(), int(size)


def _counted(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts, from several lists."""
    key, count = np.concatenate(keys), np.concatenate(counts).astype(np.int64)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))[: len(key)]
    return key[starts], np.add.reduceat(count, starts) if len(key) else count


class _Sum:
    """Counts of keys that come in many lists: held are the distinct keys and half as many, or MERGE_KEYS, to add."""

    def __init__(self) -> None:
        self.keys, self.counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        self.waiting = 0

    def add(self, keys: bytes, counts: bytes) -> None:
        self.keys.append(np.frombuffer(keys, np.uint64))
        self.counts.append(np.frombuffer(counts, np.uint32))
        self.waiting += len(self.keys[-1])
        if self.waiting > max(MERGE_KEYS, len(self.keys[0]) // 2):
            self.total()

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if self.waiting:
            key, count = _counted(self.keys, self.counts)
            self.keys, self.counts, self.waiting = [key], [count], 0
        return self.keys[0], self.counts[0]


def _chunks(batches: Iterator[pa.RecordBatch], most: int = TEXT_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of batches with about so many bytes of text."""
    for batch in batches:
        texts = byte_list(batch.column("raw"))
        ends = np.cumsum([len(t) for t in texts]) // most
        cuts = bounds_of(ends) if len(texts) else []
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield batch.slice(a, b - a), texts[a:b]


def _ordered(keys: np.ndarray) -> np.ndarray:
    """Keys as signed numbers in the same order."""
    return (keys ^ np.uint64(1 << 63)).view(np.int64)


def bucket_starts(docs: DataFrame, text_col: str, total: int, rows: int) -> np.ndarray:
    """First pair key of each bucket, so that buckets hold about equally many pairs and BUCKET_BYTES of text give one.

    The places are quantiles of the pairs of a sample of the texts, picked by hash, so a word that ends many pairs
    gets many buckets. The sample decides where lists are cut, never what is counted.
    """
    n = max(MIN_BUCKETS, math.ceil(total / BUCKET_BYTES))
    share = min(1.0, max(max(SAMPLE_BYTES, n * 512) / max(total, 1), SAMPLE_ROWS / max(rows, 1)))
    text = F.col(text_col)
    picked = docs.where(text.isNotNull() & (F.pmod(F.xxhash64(text, F.lit(5)), F.lit(1 << 20)) < math.ceil(share * (1 << 20))))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _chunks(batches):
            tokens, sizes = token_hashes(texts)
            found = np.unique(_pair_keys(tokens, _before(tokens, sizes)))
            yield pa.RecordBatch.from_arrays([pa.array([found.tobytes()], pa.binary())], ["keys"])

    sent = picked.select(utf8(F.substring(text, 1, SAMPLE_CUT)).alias("raw")).distinct().mapInArrow(keys, "keys binary")
    found = np.unique(np.frombuffer(b"".join(r["keys"] for r in sent.toLocalIterator()), np.uint64))
    if len(found) < n:  # too few to tell: even ranges
        return np.array([(i << 64) // n for i in range(n)], np.uint64)
    starts = found[np.arange(n) * len(found) // n]
    starts[0] = 0
    return starts


def train(docs: DataFrame, text_col: str) -> DataFrame:
    """The model in cells of at most CELL_KEYS sorted keys: words with their counts, or the filter of pairs.

    ``first`` is a cell's smallest key. Lists are dealt by ranges of the pair's key, which spreads the pairs that end
    in one word, and by ranges of the word; every bucket adds its lists up as they come.
    """
    spark = docs.sparkSession
    sizes = docs.agg(F.coalesce(F.sum(F.octet_length(text_col).cast("long")), F.lit(0)), F.count(F.lit(1))).first()
    starts = bucket_starts(docs, text_col, *sizes)
    n, n_words = len(starts), max(MIN_BUCKETS // 4, len(starts) // 4)
    word_starts = np.array([(i << 64) // n_words for i in range(n_words)], np.uint64)
    ddl = "bucket int, keys binary, counts binary"
    sent = to_arrow_schema(spark.createDataFrame([], ddl).schema)
    cell_ddl = "first long, n_words long, n_tokens long, words binary, counts binary, filter binary, filter_bits long"
    cells_schema = to_arrow_schema(spark.createDataFrame([], cell_ddl).schema)

    def dealt_lists(keys: np.ndarray, firsts: np.ndarray, offset: int) -> dict:
        distinct, counts = np.unique(keys, return_counts=True)
        counts = counts.astype(np.uint32)
        bucket = np.searchsorted(firsts, distinct, "right") - 1
        at = bounds_of(bucket)
        cut = [slice(i, min(i + LIST_KEYS, b)) for a, b in zip(at[:-1].tolist(), at[1:].tolist()) for i in range(a, b, LIST_KEYS)]
        return {"bucket": [int(bucket[c.start]) + offset for c in cut], "keys": [distinct[c].tobytes() for c in cut],
                "counts": [counts[c].tobytes() for c in cut]}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _chunks(batches):
            tokens, sizes = token_hashes(texts)
            yield record(dealt_lists(_pair_keys(tokens, _before(tokens, sizes)), starts, 0), sent)
            yield record(dealt_lists(tokens, word_starts, n), sent)

    def cells(bucket: int, found: _Sum) -> Iterator[pa.RecordBatch]:
        keys, counts = found.total()
        for i in range(0, len(keys), CELL_KEYS):
            key, count = keys[i : i + CELL_KEYS], counts[i : i + CELL_KEYS]
            if bucket < n:
                bloom, size = _filter(key, count)
                row = {"n_words": [0], "n_tokens": [0], "words": [None], "counts": [None], "filter": [bloom], "filter_bits": [size]}
            else:
                row = {"n_words": [len(key)], "n_tokens": [int(count.sum())], "words": [key.tobytes()],
                       "counts": [count.astype(np.uint64).tobytes()], "filter": [None], "filter_bits": [None]}
            yield record({"first": _ordered(key[:1]), **row}, cells_schema)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, found = -1, _Sum()
        for batch in batches:
            columns = (batch.column(name) for name in ("bucket", "keys", "counts"))
            for bucket, keys, counts in zip(*columns):
                if bucket.as_py() != last:
                    yield from cells(last, found)
                    last, found = bucket.as_py(), _Sum()
                found.add(keys.as_py(), counts.as_py())
        yield from cells(last, found)

    dealt = docs.select(utf8(text_col).alias("raw")).mapInArrow(count, ddl).repartition("bucket").sortWithinPartitions("bucket")
    return written(dealt.mapInArrow(gather, cell_ddl))


def _blocks(model: DataFrame, block_bytes: int) -> Iterator[dict]:
    """The model in blocks of about so many bytes: consecutive cells of pairs with the words that may end such pairs.

    A block has the pairs with keys from ``low`` up to ``high``. Words are repeated in the blocks that their pairs
    are spread over.
    """
    unsigned = lambda values: np.array(list(values), np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    size = F.coalesce(F.octet_length("filter"), F.octet_length("words") + F.octet_length("counts"))
    plan = model.select("first", size.alias("size"), F.col("filter").isNotNull().alias("pairs")).orderBy("first").collect()
    firsts = unsigned(r["first"] for r in plan if r["pairs"])
    lengths = [r["size"] for r in plan if r["pairs"]]
    word_firsts = unsigned(r["first"] for r in plan if not r["pairs"])
    word_ends = np.concatenate([[0], np.cumsum([r["size"] for r in plan if not r["pairs"]])]).astype(np.int64)

    def word_cells(a: int, b: int) -> tuple[int, int]:
        """Numbers of the word cells that the cells of pairs from a up to b need."""
        low = firsts[a] >> _LOW << _LOW if a else np.uint64(0)
        high = firsts[b] | np.uint64((1 << 64 - PREFIX) - 1) if b < len(firsts) else np.uint64((1 << 64) - 1)
        return max(int(np.searchsorted(word_firsts, low, "right")) - 1, 0), int(np.searchsorted(word_firsts, high, "right"))

    def rows(pairs: bool, keys: np.ndarray, sizes: np.ndarray) -> Iterator:
        """The cells with these first keys in order, FETCH_BYTES at a time."""
        cuts = bounds_of(np.cumsum(sizes) // FETCH_BYTES) if len(keys) else []
        for i, j in zip(cuts[:-1], cuts[1:]):
            kind = F.col("filter").isNotNull() if pairs else F.col("filter").isNull()
            here = model.where(kind & F.col("first").between(*_ordered(keys[[i, j - 1]]).tolist()))
            yield from sorted(here.collect(), key=lambda r: r["first"])

    cuts, own = [0], 0
    for i, length in enumerate(lengths):
        a, b = word_cells(cuts[-1], i + 1)
        if i > cuts[-1] and own + length + word_ends[b] - word_ends[a] > block_bytes:
            cuts.append(i)
            own = 0
        own += length
    cuts.append(len(lengths))
    for a, b in zip(cuts[:-1], cuts[1:]):
        held, bits, joined = [], [], {"words": bytearray(), "counts": bytearray(), "filter": bytearray()}
        for r in rows(True, firsts[a:b], np.array(lengths[a:b], np.int64)):
            held.append(len(r["filter"]))
            bits.append(r["filter_bits"])
            joined["filter"] += r["filter"]
        wa, wb = word_cells(a, b) if a < b else (0, 0)
        for r in rows(False, word_firsts[wa:wb], np.diff(word_ends[wa : wb + 1])):
            joined["words"] += r["words"]
            joined["counts"] += r["counts"]
        starts = np.cumsum([0, *held]).astype(np.uint64)[:-1] * np.uint64(8)
        yield {
            "low": 0 if not a else int(firsts[a]), "high": 1 << 64 if b >= len(firsts) else int(firsts[b]),
            "firsts": firsts[a:b], "starts": starts, "sizes": np.array(bits, np.uint64),
            "words": np.frombuffer(joined["words"], np.uint64), "counts": np.frombuffer(joined["counts"], np.uint64),
            "filter": np.frombuffer(joined["filter"], np.uint8),
        }


def _probed(block: dict, keys: np.ndarray) -> np.ndarray:
    """Quantised count of each pair: the lowest count of its highest level found, 0 for none."""
    out = np.zeros(len(keys))
    if not len(block["firsts"]):
        return out
    cells = np.maximum(np.searchsorted(block["firsts"], keys, "right") - 1, 0)
    starts, sizes, bits = block["starts"][cells], block["sizes"][cells], block["filter"]
    live = np.arange(len(keys))
    level = 1
    while len(live):
        found = np.ones(len(live), bool)
        for place in _entries(keys[live], level, sizes[live]):
            place = place + starts[live]
            found &= (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0
        live = live[found]
        out[live] = 2.0 ** (level - 1)
        level += 1
    return out


def score(
    docs: DataFrame, model: DataFrame, id_col: str, text_col: str, keep: list, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Each row's columns of ``keep``, its tokens, known tokens, and log10 probabilities: base and model."""
    spark = docs.sparkSession
    blocks = [spark.sparkContext.broadcast(b) for b in _blocks(model, block_bytes)]
    total, distinct = model.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.coalesce(F.sum("n_words"), F.lit(0))).first()
    norm = total + distinct + 1
    frame = docs.select(F.struct(F.col(id_col), *keep).alias("row"), utf8(text_col).alias("raw"))
    sums = "n_tokens long, n_known long, train_tokens long, base_score double, score double"
    ddl = f"row {frame.schema['row'].dataType.simpleString()}, {sums}"
    schema = to_arrow_schema(spark.createDataFrame([], ddl).schema)

    def added(block: dict, tokens: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each token its share of the known tokens, the base score and the score that this block gives."""
        here = np.flatnonzero((pairs >= np.uint64(block["low"])) & (pairs <= np.uint64(block["high"] - 1)))
        own, words = tokens[here], block["words"]
        at = np.minimum(np.searchsorted(words, own), max(len(words) - 1, 0))
        count = np.where(words[at] == own, block["counts"][at], 0).astype(np.float64) if len(words) else np.zeros(len(own))
        alone = (count + 1) / norm
        again = _probed(block, pairs[here])
        known, base, model = (np.zeros(len(tokens)) for _ in range(3))
        known[here] = count > 0
        base[here] = np.log10(alone)
        # the token's own part, and its part as the one before the next token
        model[here] = np.log10(again + STRENGTH * alone) - np.log10(count + STRENGTH)
        return known, base, model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows and the sums so far; a task holds all of its rows only where blocks come one after the other
        chunks = ([batch.column("row"), texts, np.zeros((3, len(texts)))] for batch, texts in _chunks(batches, SCORE_BYTES))
        held = chunks if len(blocks) == 1 else list(chunks)
        for n, block in enumerate(blocks):
            for chunk in held:
                tokens, sizes = token_hashes(chunk[1])
                pairs = _pair_keys(tokens, _before(tokens, sizes))
                starts = np.cumsum(sizes) - sizes
                for i, values in enumerate(added(block.value, tokens, pairs)):
                    chunk[2][i] += np.add.reduceat(values, starts)
                if n == len(blocks) - 1:
                    known, base, model = chunk[2]
                    yield record({"row": chunk[0].cast(schema.field("row").type), "n_tokens": sizes,
                                  "n_known": known.round().astype(np.int64), "train_tokens": [total] * len(sizes),
                                  "base_score": base, "score": model}, schema)
            if len(blocks) > 1:
                del block._value  # a task holds one block at a time

    return frame.mapInArrow(run, ddl).select("row.*", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def document_scores(docs: DataFrame, folds: int = 7, fold: int = 2) -> DataFrame:
    """Digest of every document's scores, learned from the documents outside the fold.

    Null and empty texts are one token, the end. A null doc_id counts as the
    empty text in the fold's checksum. Without training texts every token has
    probability 1 / 1. Other columns are not read.
    """
    out = held_out("doc_id", folds, fold)
    return score(docs, train(docs.where(~out), "text"), "doc_id", "text", [out.alias("held_out")])
