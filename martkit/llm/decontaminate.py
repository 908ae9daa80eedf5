"""Benchmark decontamination (operator 9): a broadcast hash set of n-grams, scanned and verified.

The benchmark's word windows are hashed; workers hash every window of every
document's words, look the hashes up and compare the words of each hit. The
benchmark is dealt into blocks of bounded size, and each block is one scan of
the documents, so the broadcast stays bounded whatever the benchmark's size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from martkit.llm.tables import byte_list, record, released, utf8
from martkit.workspace import written

WINDOW = 13
BLOCK_WINDOWS = 200_000
BLOCK_BYTES = 64 << 20

# Bytes that make up words, upper case A-Z made lower; all others separate words.
_WORD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_MULTIPLIER = 0x9E3779B97F4A7C15


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD).split()


def _word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) | 1


def _window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n words; the words' hashes weighted by their place."""
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for i in range(n):
        weight = np.uint64(pow(_MULTIPLIER, i + 1, 1 << 64))
        out += hashes[i : i + len(out)] * weight
    return out ^ (out >> np.uint64(31))


def benchmark_windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """One row for each item and distinct window: its words, joined by spaces, and their number.

    An item of fewer words than a window is one window; an item without words has none.
    """
    schema = pa.schema([("item", pa.string()), ("gram", pa.binary()), ("n", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), byte_list(batch.column(1))):
                words = words_of(text)
                n = min(window, len(words))
                grams = sorted({b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)}) if n else []
                for start in range(0, len(grams), 10_000):
                    part = grams[start : start + 10_000]
                    yield record({"item": [item] * len(part), "gram": part, "n": [n] * len(part)}, schema)

    id_text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return items.select(id_text, utf8(text_col)).mapInArrow(released(run), "item string, gram binary, n int").distinct()


def packed(rows: list) -> dict:
    """A block of windows as workers use it: the words' hashes, and by window length the sorted hashes with words and items."""
    items: dict[bytes, list[str]] = {}
    for r in rows:
        items.setdefault(bytes(r["gram"]), []).append(r["item"])
    vocabulary = {w: _word_hash(w) for g in items for w in g.split(b" ")}
    lengths: dict[int, list[bytes]] = {}
    for g in items:
        lengths.setdefault(g.count(b" ") + 1, []).append(g)
    by_length = {}
    for n, grams in lengths.items():
        words = np.array([[vocabulary[w] for w in g.split(b" ")] for g in grams], np.uint64)
        hashes = np.array([_window_hashes(row, n)[0] for row in words], np.uint64)
        order = np.argsort(hashes, kind="stable")
        by_length[n] = hashes[order], [(grams[i], tuple(items[grams[i]])) for i in order]
    return {"vocabulary": vocabulary, "by_length": by_length}


def hits(block: dict, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
    """Spans of words (start, length) equal to a window of the block, and the items they come from."""
    get = block["vocabulary"].get
    hashes = np.fromiter((get(w, 0) for w in words), np.uint64, len(words))
    strange = np.concatenate([[0], np.cumsum(hashes == np.uint64(0))])
    spans: list[tuple[int, int]] = []
    found: set[str] = set()
    for n, (known, grams) in block["by_length"].items():
        if len(words) < n:
            continue
        starts = np.flatnonzero(strange[n:] == strange[: len(words) - n + 1])
        if not len(starts):
            continue
        own = _window_hashes(hashes, n)[starts]
        left, right = np.searchsorted(known, own, "left"), np.searchsorted(known, own, "right")
        for i in np.flatnonzero(left < right):
            start = int(starts[i])
            gram = b" ".join(words[start : start + n])
            for k in range(left[i], right[i]):
                if grams[k][0] == gram:
                    spans.append((start, n))
                    found.update(grams[k][1])
    return spans, found


def _merged(spans: list[int], new: list[tuple[int, int]]) -> list[int]:
    """Runs of words as start, end, start, end, ...: the old ones and the new hits, without overlaps."""
    if not new:
        return spans
    runs: list[int] = []
    for start, end in sorted([*zip(spans[::2], spans[1::2]), *((s, s + n) for s, n in new)]):
        if runs and start <= runs[-1]:
            runs[-1] = max(runs[-1], end)
        else:
            runs += [start, end]
    return runs


def _scan(frame: DataFrame, grams) -> DataFrame:
    """Add one block's hits to those of the blocks before it."""
    schema = to_arrow_schema(frame.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = grams and grams.value
        for batch in batches:
            sizes, runs, items = [], [], []
            before = zip(batch.column("runs").to_pylist(), batch.column("items").to_pylist())
            for text, (old_runs, old_items) in zip(byte_list(batch.column("raw")), before):
                words = words_of(text)
                new, found = hits(block, words) if block else ((), set())
                sizes.append(len(words))
                runs.append(_merged(old_runs, new))
                items.append(sorted(found.union(old_items)))
            columns = {"row": batch.column("row").cast(schema.field("row").type), "raw": batch.column("raw")}
            yield record(columns | {"n_words": sizes, "runs": runs, "items": items}, schema)

    return frame.mapInArrow(released(run), frame.schema)


def blocks(windows: DataFrame, most: int, most_bytes: int) -> Iterator[list]:
    """The windows in blocks: so many at most on average, dealt by their hash."""
    n, size = windows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("gram")), F.lit(0))).first()
    count = max(-(-n // most), -(-size // most_bytes))
    for i in range(count):
        part = windows if count == 1 else windows.where(F.pmod(F.xxhash64("gram"), F.lit(count)) == i)
        yield part.collect()


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW, block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """Runs of words of every document that occur in the benchmark, and the items they come from.

    Returns the id, the text as bytes in ``raw``, ``n_words``, ``runs`` (start
    and end of each run of hit words, flattened) and ``items`` (ids as text,
    sorted). One row for each row of ``docs``: null and empty texts have no
    words and no hits, repeated rows are judged alike, a null item id is the
    empty text, and without benchmark items nothing is hit. Other columns are
    not read.
    """
    spark = docs.sparkSession
    frame = docs.select(
        F.col(id_col).alias("row"), utf8(text_col).alias("raw"), F.lit(0).alias("n_words"),
        F.array().cast("array<int>").alias("runs"), F.array().cast("array<string>").alias("items"),
    )
    windows = written(benchmark_windows(items, item_id, item_text, window))
    scanned = None
    for rows in blocks(windows, block_windows, BLOCK_BYTES):
        scanned = _scan(frame if scanned is None else written(scanned), spark.sparkContext.broadcast(packed(rows)))
    scanned = _scan(frame, None) if scanned is None else scanned
    return scanned.withColumnRenamed("row", id_col)


def n_hit() -> Column:
    """Hit words: the lengths of the runs."""
    signed = F.transform("runs", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x))
    return F.aggregate(signed, F.lit(0), lambda total, x: total + x)


def contaminated() -> Column:
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def contaminated_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Digest of each document's contamination; see ``contamination`` for odd rows."""
    found = contamination(docs, items)
    return found.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), n_hit().cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
    ).withColumn("contaminated", contaminated())


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that are not contaminated, rows and columns as they were."""
    whole = docs.select(F.struct("*").alias("whole"), F.col(text_col).alias("judged"))
    found = contamination(whole, items, id_col="whole", text_col="judged")
    return found.withColumn("n_hit", n_hit()).where(~contaminated()).select("whole.*")


def remove_spans(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and text of every document without the runs of words that the benchmark holds.

    The bytes from the first to the last word of each run go; the rest stays as it was.
    """
    found = contamination(docs, items, id_col, text_col)
    schema = to_arrow_schema(found.select(F.col(id_col).alias("row"), F.lit("").alias("text")).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_without(t, r) for t, r in zip(byte_list(batch.column(1)), batch.column(2).to_pylist())]
            yield record({"row": batch.column(0).cast(schema.field("row").type), "text": texts}, schema)

    kind = found.schema[id_col].dataType.simpleString()
    mapped = found.select(F.col(id_col).alias("row"), "raw", "runs").mapInArrow(released(run), f"row {kind}, text string")
    return mapped.select(F.col("row").alias(id_col), F.col("text").alias(text_col))


def _without(text: bytes, runs: list[int]) -> str:
    if runs:
        marks = np.frombuffer(b" " + text.translate(_WORD) + b" ", np.uint8) != 32
        starts, ends = np.flatnonzero(~marks[:-1] & marks[1:]), np.flatnonzero(marks[:-1] & ~marks[1:])
        parts, at = [], 0
        for a, b in zip(runs[::2], runs[1::2]):
            parts.append(text[at : starts[a]])
            at = int(ends[b - 1])
        text = b"".join([*parts, text[at:]])
    return text.decode("utf-8", "replace")


_WORDS_SQL = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

CONTAMINATED_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, {_WORDS_SQL} AS w FROM benchmark),
bi AS (
  SELECT item, w, least({WINDOW}, len(w)) AS n, unnest(range(1, len(w) - least({WINDOW}, len(w)) + 2)) AS i
  FROM b WHERE len(w) > 0),
g AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS gram FROM bi),
di AS (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
  FROM d JOIN (SELECT DISTINCT n FROM g) ON len(w) >= n),
hit AS (
  SELECT doc_id, i, n, gram FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram FROM di)
  WHERE gram IN (SELECT gram FROM g)),
pos AS (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM pos GROUP BY doc_id),
found AS (SELECT DISTINCT h.doc_id, g.item FROM hit h JOIN g USING (gram)),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM found GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
