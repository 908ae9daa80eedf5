"""Removal of repeated passages by suffix arrays (operator 1).

A passage is a string of so many symbols that starts at two places or more;
symbols are bytes, or words by their hash (``Measure``). Its smallest hash of
ANCHOR symbols, its anchor, is the same wherever the passage
occurs: texts are cut into contexts, the stretches of passages with one anchor,
and contexts are dealt to shards by their anchor. Only anchors that occur twice
are sent, and equal contexts meet before the shuffle. A passage reaches half
its rest beyond its anchor on one side at least, so two contexts that share one
have these symbols in common: contexts without such a twin are not sorted. Each shard sorts its
suffixes by external induced sorting (``suffix_array``): neighbours with a
common prefix of a passage's size are repeated passages. A shard is sorted in runs
of whole anchors, whatever its size; an anchor with very many contexts is
dealt out by its passages instead.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from martkit.llm.suffix_array import suffix_array
from martkit.llm.tables import bounds_of, fingerprint, groups, record, released, utf8
from martkit.workspace import written



class Measure(NamedTuple):
    """How long a passage and its anchor are, in symbols of so many bytes each."""

    length: int
    anchor: int
    symbol: int

    @property
    def size(self) -> int:
        """Bytes of a passage's symbols."""
        return self.length * self.symbol

    @property
    def half(self) -> int:
        return (self.length - self.anchor) // 2

    @property
    def least(self) -> int:
        """Bytes of the shortest text that holds a passage: words are of a byte or more, with a space between."""
        return self.length if self.symbol == 1 else 2 * self.length - 1


BYTES = Measure(400, 32, 1)
WORDS = Measure(50, 6, 8)
WORD = r"[^ \t-\r]+"
RUN_BYTES = 1 << 20  # text that is sorted at once
HOT_CONTEXTS = 4096  # contexts of an anchor beyond which its passages are dealt out one by one
FILTER_BITS = 1 << 26  # bits of the broadcast filter of anchors, at any size of the data
FILTER_BUCKETS = 1 << 20
PIECE = 1 << 18  # symbols hashed at a time

_table = np.random.default_rng(20240502).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTOR = 0x9E3779B97F4A7C15
_gap = re.compile(rb"[ \t-\r]")


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def series(x: int) -> np.ndarray:
        out = np.full(n, np.uint64(x), np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return series(_FACTOR), series(pow(_FACTOR, -1, 1 << 64))


def _hashes(data: np.ndarray, powers: tuple[np.ndarray, np.ndarray], k: int) -> np.ndarray:
    """Hash of each k symbols in a row."""
    n = len(data)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((_table[data] if data.dtype == np.uint8 else data) * powers[0][:n], out=total[1:])
    h = (total[k:] - total[:-k]) * powers[1][: n - k + 1]
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    n = len(values) - width + 1
    blocks = np.append(values, np.full(-len(values) % width, np.iinfo(np.uint64).max, np.uint64)).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def symbols(text: bytes, measure: Measure) -> np.ndarray:
    """A text's bytes, or a 64-bit hash of each of its words."""
    if measure.symbol == 1:
        return np.frombuffer(text, np.uint8)
    found, at = [np.zeros(0, np.uint64)], 0
    while at < len(text):
        gap = _gap.search(text, at + PIECE)
        end = gap.start() if gap else len(text)
        words = text[at:end].split()
        found.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
        at = end
    return np.concatenate(found)


def anchors(
    data: np.ndarray, powers: tuple[np.ndarray, np.ndarray], measure: Measure = BYTES
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where the passages' anchor changes, the anchors (each holds from its place to the next), where each occurs
    first, and whether it occurs more than once for its passages, as in a text that repeats itself at a short distance."""
    length = measure.length
    width = length - measure.anchor + 1
    starts, found, firsts = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    passages = max(len(data) - length + 1, 0)
    for at in range(0, passages, PIECE):
        h = _hashes(data[at : at + PIECE + length - 1], powers, measure.anchor)
        low = _sliding_min(h, width)
        places = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
        if len(found[-1]) and found[-1][-1] == low[0]:
            places = places[1:]
        windows = np.lib.stride_tricks.sliding_window_view(h, width)
        firsts.append(places + at + (windows[places] == low[places, None]).argmax(1))
        starts.append(places + at)
        found.append(low[places])
    start = np.concatenate(starts)
    ends = np.append(start[1:], passages)[: len(start)]
    first = np.concatenate(firsts)
    return start, np.concatenate(found), first, ends - 1 > first


def _texts(df: DataFrame, text_col: str, measure: Measure) -> DataFrame:
    raw = utf8(text_col)
    return df.select(fingerprint(text_col).alias("print"), raw.alias("raw")).where(F.octet_length("raw") >= measure.least)


def _per_text(batches: Iterator[pa.RecordBatch], measure: Measure):
    """Each text's fingerprint, symbols and anchors; a text that the task has met is left out."""
    powers = _powers(PIECE + measure.length)
    met: set[bytes] = set()
    for batch in batches:
        for key, raw in zip(batch.column("print").to_pylist(), batch.column("raw").to_pylist()):
            if key not in met:
                if len(met) < 1_000_000:
                    met.add(key)
                data = symbols(raw, measure)
                yield key, data, *anchors(data, powers, measure)


def _repeated_anchors(texts: DataFrame, measure: Measure) -> DataFrame:
    """Anchors that occur at two places or more of different texts, or of one."""
    schema = pa.schema([("anchor", pa.int64()), ("place", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, _, starts, found, _, inside in _per_text(batches, measure):
            starts, found = np.append(starts, starts[inside] + 1), np.append(found, found[inside])
            own = np.uint64(xxhash.xxh3_64_intdigest(key))
            place = (starts.astype(np.uint64) * np.uint64(_FACTOR) + own) * np.uint64(0xC2B2AE3D27D4EB4F)
            yield record({"anchor": found.view(np.int64), "place": (place ^ (place >> np.uint64(31))).view(np.int64)}, schema)

    places = texts.mapInArrow(released(run), "anchor long, place long")
    seen = places.groupBy("anchor").agg(F.min("place").alias("a"), F.max("place").alias("b"))
    return written(seen.where("a != b").select("anchor"))


def _filter(repeated: DataFrame) -> np.ndarray:
    """A bit for each hash of an anchor that repeats: FILTER_BITS bits at most, whatever the number of anchors."""
    bit = F.pmod("anchor", F.lit(FILTER_BITS)).cast("long")
    words = repeated.select(
        F.floor(bit / 32).cast("int").alias("w"), F.expr("shiftleft(1L, int(pmod(anchor, 32)))").alias("b")
    )
    out = np.zeros(FILTER_BITS // 32, np.uint32)
    for row in words.groupBy("w").agg(F.bit_or("b").alias("b")).toLocalIterator(prefetchPartitions=True):
        out[row["w"]] = row["b"]
    return out


def _halves(context: bytes, at: int, measure: Measure) -> tuple[int | None, int | None]:
    """Hashes of the anchor at a symbol with the half passage before it, and with that after it."""
    at, end, half = at * measure.symbol, (at + measure.anchor) * measure.symbol, measure.half * measure.symbol
    left, right = at - half, end + half
    return (
        xxhash.xxh3_64_intdigest(context[left:end]) - (1 << 63) if left >= 0 else None,
        xxhash.xxh3_64_intdigest(context[at:right], 1) - (1 << 63) if right <= len(context) else None,
    )


def _contexts(texts: DataFrame, repeated: DataFrame, measure: Measure) -> DataFrame:
    """Rows (context hash, anchor, text, start, starts, bytes) of the contexts whose anchor may repeat.

    ``left`` and ``right`` are hashes of the anchor with half a passage before and after it, null where the
    context doesn't hold as much. Starts are counted in symbols; the bytes are those of the symbols.
    """
    sent = texts.sparkSession.sparkContext.broadcast(_filter(repeated))
    ddl = "ctx binary, anchor long, print binary, start int, starts int, inside boolean, left long, right long, bytes binary"
    schema = to_arrow_schema(texts.sparkSession.createDataFrame([], ddl).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value
        rows: list[tuple] = []
        size = 0
        for key, data, starts, found, first, inside in _per_text(batches, measure):
            bit = found % np.uint64(FILTER_BITS)
            hit = (bits[bit // np.uint64(32)] >> (bit % np.uint64(32)).astype(np.uint32)) & np.uint32(1)
            ends = np.append(starts[1:], len(data) - measure.length + 1)
            for i in np.flatnonzero(hit).tolist():
                a, b = int(starts[i]), int(ends[i])
                part = data[a : b + measure.length - 1].tobytes()
                halves = _halves(part, int(first[i]) - a, measure)
                rows.append((xxhash.xxh3_128_digest(part), int(found[i].view(np.int64)), key, a, b - a, bool(inside[i]),
                             *halves, part))
                size += len(part)
                if size > RUN_BYTES:
                    yield record(dict(zip(schema.names, zip(*rows))), schema)
                    rows, size = [], 0
        if rows:
            yield record(dict(zip(schema.names, zip(*rows))), schema)

    return texts.mapInArrow(released(run), ddl)


def _letters(data: bytes, measure: Measure) -> tuple[np.ndarray, int]:
    """The symbols, each in as few bytes as tell the run's different ones apart, and how many these are."""
    if measure.symbol == 1:
        return np.frombuffer(data, np.uint8), 1
    different, places = np.unique(np.frombuffer(data, np.uint64), return_inverse=True)
    step = max(1, -(-(len(different) - 1).bit_length() // 8))
    return np.ascontiguousarray(places.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :step]).ravel(), step


def repeated_starts(
    contexts: list[bytes], starts: list[int], twice: np.ndarray, measure: Measure = BYTES
) -> list[list[int]]:
    """For each context the runs (first, end, first, end, ...) of its starts whose passage occurs twice or more.

    The first ``starts`` symbols of a context are its own; each passage is the
    own start of one context for each place where it occurs, and ``twice`` marks
    the contexts that stand for several places.
    """
    text, step = _letters(b"".join(contexts), measure)
    sizes = np.array([len(c) for c in contexts], np.int64) // measure.symbol * step
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    owners = np.zeros(offsets[-1], np.int8)
    for at, n, more in zip(offsets[:-1].tolist(), starts, twice.tolist()):
        owners[at : at + n * step : step] = 2 if more else 1
    size = measure.length * step
    position, common = suffix_array(text, size)
    group = np.cumsum(common < size)
    weight = owners[position]
    repeated = (np.bincount(group, weights=weight) >= 2)[group] & (weight > 0)
    flags = np.zeros(offsets[-1] + 1, np.int8)
    flags[position[repeated]] = 1
    out = []
    for at, n in zip(offsets[:-1].tolist(), starts):
        edges = np.flatnonzero(np.diff(flags[at : at + n * step : step], prepend=0, append=0))
        out.append(edges.tolist())
    return out


def _linked(distinct: DataFrame) -> DataFrame:
    """Contexts (``ctx``, ``anchor``) that may share a passage with another one, or hold one twice.

    Where an anchor occurs twice for the passages of one context, all its contexts stay.
    """
    halves = distinct.select("ctx", "anchor", F.explode(F.array("left", "right")).alias("half")).where("half is not null")
    context = F.xxhash64("ctx")
    shared = halves.groupBy("anchor", "half").agg(F.min(context).alias("a"), F.max(context).alias("b")).where("a != b")
    twins = halves.join(written(shared.select("anchor", "half")), ["anchor", "half"], "left_semi").select("ctx", "anchor")
    inside = written(distinct.where("inside").select("anchor").distinct())
    return twins.unionByName(distinct.select("ctx", "anchor").join(inside, "anchor", "left_semi")).distinct()


def _sorted_runs(distinct: DataFrame, measure: Measure) -> DataFrame:
    """Rows (context, runs of repeated starts) by suffix arrays over shards of anchors."""
    ddl = "ctx binary, runs array<int>"
    schema = to_arrow_schema(distinct.sparkSession.createDataFrame([], ddl).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches, "anchor"):
            bounds = bounds_of(batch.column("anchor").to_numpy())
            texts = batch.column("bytes").to_pylist()
            sizes = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
            first = 0
            for end in bounds[1:].tolist():
                if end < len(texts) and sizes[end] - sizes[first] < RUN_BYTES:
                    continue
                part = slice(first, end)
                starts = batch.column("starts").to_pylist()[part]
                twice = batch.column("twice").to_numpy(zero_copy_only=False)[part]
                runs = repeated_starts(texts[part], starts, twice, measure)
                kept = [i for i, r in enumerate(runs) if r]
                ctx = batch.column("ctx").to_pylist()[part]
                yield record({"ctx": [ctx[i] for i in kept], "runs": [runs[i] for i in kept]}, schema)
                first = end

    dealt = distinct.repartition("anchor").sortWithinPartitions("anchor")
    return dealt.select("anchor", "ctx", "starts", "twice", "bytes").mapInArrow(released(run), ddl)


def _dealt_runs(hot: DataFrame, measure: Measure) -> DataFrame:
    """As ``_sorted_runs``, for anchors of very many contexts: passages meet by their 128-bit hash."""
    ddl = "passage binary, ctx binary, at int, places int"
    schema = to_arrow_schema(hot.sparkSession.createDataFrame([], ddl).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ctx, n, more, text in zip(*(batch.column(c).to_pylist() for c in ("ctx", "starts", "twice", "bytes"))):
                firsts = range(0, n * measure.symbol, measure.symbol)
                hashes = [xxhash.xxh3_128_digest(text[i : i + measure.size]) for i in firsts]
                yield record({"passage": hashes, "ctx": [ctx] * n, "at": range(n), "places": [2 if more else 1] * n}, schema)

    passages = written(hot.select("ctx", "starts", "twice", "bytes").mapInArrow(released(run), ddl))
    again = written(passages.groupBy("passage").agg(F.sum("places").alias("n")).where("n > 1").select("passage"))
    found = passages.join(again, "passage", "left_semi").select("ctx", "at")
    return found.groupBy("ctx").agg(
        F.flatten(F.transform(F.sort_array(F.collect_list("at")), lambda x: F.array(x, x + 1))).alias("runs")
    )


def repeated_runs(df: DataFrame, text_col: str = "text", measure: Measure = BYTES) -> DataFrame:
    """For each text that holds a repeated passage: its fingerprint and its ``runs`` of repeated starts.

    ``whole`` is true instead where the text itself, as long as a passage or
    longer, occurs twice: all of it is repeated. One row for each fingerprint.
    """
    texts = _texts(df, text_col, measure)
    enough = F.lit(True)
    if measure.symbol > 1:
        enough = F.max(F.regexp_count(F.col("raw").cast("string"), F.lit(WORD))) >= measure.length
    counted = texts.groupBy("print").agg(F.count("*").alias("n"), enough.alias("enough"))
    copies = written(counted.where("n > 1 AND enough").select("print"))
    contexts = written(_contexts(texts, _repeated_anchors(texts, measure), measure))
    place = F.xxhash64("print", "start")
    distinct = contexts.groupBy("ctx").agg(
        F.first("anchor").alias("anchor"), F.first("starts").alias("starts"), F.first("bytes").alias("bytes"),
        F.first("inside").alias("inside"), F.first("left").alias("left"), F.first("right").alias("right"),
        (F.min(place) != F.max(place)).alias("twice"),
    )
    distinct = written(distinct)
    linked = written(_linked(distinct))
    hot = written(linked.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > HOT_CONTEXTS).select("anchor"))
    live = distinct.join(linked.select("ctx"), "ctx", "left_semi")
    # all passages of a context that stands for several places are repeated
    alone = distinct.where("twice").join(linked.select("ctx"), "ctx", "left_anti")
    runs = alone.select("ctx", F.array(F.lit(0), F.col("starts")).alias("runs"))
    if hot.isEmpty():
        runs = runs.unionByName(_sorted_runs(live, measure))
    else:
        live = written(live)
        runs = runs.unionByName(_sorted_runs(live.join(hot, "anchor", "left_anti"), measure))
        runs = runs.unionByName(_dealt_runs(live.join(hot, "anchor", "left_semi"), measure))
    found = contexts.select("ctx", "print", "start").join(written(runs), "ctx")
    shifted = F.transform("runs", lambda x: x + F.col("start"))
    by_text = found.select("print", "start", shifted.alias("runs")).distinct().groupBy("print").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("start", "runs"))), lambda x: x["runs"])).alias("runs")
    )
    partial = by_text.join(copies, "print", "left_anti").withColumn("whole", F.lit(False))
    whole = copies.withColumn("runs", F.array().cast("array<int>")).withColumn("whole", F.lit(True))
    return written(partial.unionByName(whole.select(*partial.columns)))


def spans_of(text: bytes, runs: list[int], measure: Measure = BYTES) -> list[tuple[int, int]]:
    """The bytes that passages at repeated starts cover; words go with the white space after them."""
    spans = [(first, end - 1 + measure.length) for first, end in zip(runs[::2], runs[1::2])]
    if measure.symbol == 1:
        return spans
    blank = np.isin(np.frombuffer(text, np.uint8), np.frombuffer(b"\t\n\x0b\x0c\r ", np.uint8))
    places = np.append(np.flatnonzero(~blank & np.append(True, blank[:-1])), len(text))
    places[0] = 0
    return [(int(places[a]), int(places[b])) for a, b in spans]


def kept_bytes(text: bytes, covered: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], bytes]:
    """The covered spans, merged, and the bytes outside them."""
    spans: list[tuple[int, int]] = []
    for first, stop in sorted(covered):
        if spans and first <= spans[-1][1]:
            spans[-1] = spans[-1][0], max(stop, spans[-1][1])
        else:
            spans.append((first, stop))
    at, parts = 0, []
    for a, b in spans:
        parts.append(text[at:a])
        at = b
    return spans, b"".join([*parts, text[at:]])


def _cleaned(df: DataFrame, text_col: str, found: dict[Measure, DataFrame], as_text: bool = False) -> DataFrame:
    """For each text with repeated passages of any measure but the whole copies: bytes removed, spans and the rest.

    The rest is bytes, or ``as_text`` without the characters that are cut in part.
    """
    ddl = f"print binary, n_removed long, n_spans long, rest {'string' if as_text else 'binary'}"
    schema = to_arrow_schema(df.sparkSession.createDataFrame([], ddl).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws = batch.column("raw").to_pylist()
            done = [kept_bytes(t, [s for r in rows for s in spans_of(t, r["runs"], measures[r["kind"]])])
                    for t, rows in zip(raws, batch.column("found").to_pylist())]
            rest = [k.decode("utf-8", "ignore") if as_text else k for _, k in done]
            yield record({"print": batch.column("print"), "n_removed": [len(t) - len(k) for t, (_, k) in zip(raws, done)],
                          "n_spans": [len(s) for s, _ in done], "rest": rest}, schema)

    measures = list(found)
    kinds = [
        runs.where("not whole").select("print", F.struct(F.lit(i).alias("kind"), "runs").alias("one"))
        for i, runs in enumerate(found.values())
    ]
    if len(kinds) == 1:
        partial = kinds[0].select("print", F.array("one").alias("found"))
    else:
        partial = written(reduce(DataFrame.unionByName, kinds).groupBy("print").agg(F.collect_list("one").alias("found")))
    least = min(measures, key=lambda m: m.least)
    bucket = F.pmod(F.xxhash64("print"), F.lit(FILTER_BUCKETS))
    maybe = _texts(df, text_col, least).withColumn("bucket", bucket).join(
        F.broadcast(partial.select(bucket.alias("bucket")).distinct()), "bucket", "left_semi"
    )
    single = maybe.groupBy("print").agg(F.first("raw").alias("raw"))  # copies meet before the shuffle
    return single.join(partial, "print").select("print", "raw", "found").mapInArrow(released(run), ddl)


def document_repeats(docs: DataFrame) -> DataFrame:
    """Digest of each document without its repeated passages.

    Null and empty texts have no bytes; texts shorter than a passage lose
    none. A repeated row is a copy: it loses all. Other columns are not read.
    """
    runs = repeated_runs(docs)
    cleaned = _cleaned(docs, "text", {BYTES: runs}).select("print", "n_removed", "n_spans", F.sha2("rest", 256).alias("rest_sha256"))
    whole = runs.where("whole").select(
        "print", F.lit(None).cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
        F.sha2(F.lit("").cast("binary"), 256).alias("rest_sha256"),
    )
    touched = written(cleaned.unionByName(whole))
    raw = F.coalesce(utf8("text"), F.lit("").cast("binary"))
    own = docs.select(
        "doc_id", fingerprint("text").alias("print"), F.octet_length(raw).cast("long").alias("n_bytes"),
        F.sha2(raw, 256).alias("own_sha256"),
    )
    joined = own.join(touched, "print", "left")
    none = F.col("n_spans").isNull()
    return joined.select(
        "doc_id", "n_bytes",
        F.when(none, F.lit(0).cast("long")).otherwise(F.coalesce("n_removed", "n_bytes")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"),
        F.when(none, F.col("own_sha256")).otherwise(F.col("rest_sha256")).alias("kept_sha256"),
    )


def drop_repeats(
    docs: DataFrame, text_col: str = "text", size_col: str | None = "n_chars", measures: Sequence[Measure] = (BYTES,)
) -> DataFrame:
    """The rows with repeated passages cut out of their text, other columns as they were.

    Passages are of 400 bytes, by ``measures`` of 50 words also or instead,
    whatever white space is between these; all are judged on the input. A character of which only a part is repeated goes as a whole. Texts that
    lose all their bytes are empty; null texts stay null. ``size_col``, where
    the frame has it, becomes the length of the text that is left.
    """
    found = {m: repeated_runs(docs, text_col, m) for m in measures}
    cleaned = _cleaned(docs, text_col, found, as_text=True).select("print", "rest")
    copies = reduce(DataFrame.unionByName, [runs.where("whole").select("print") for runs in found.values()])
    whole = copies.distinct().select("print", F.lit("").alias("rest"))
    touched = written(cleaned.unionByName(whole))
    bucket = F.pmod(F.xxhash64("print"), F.lit(FILTER_BUCKETS))
    packed = docs.select(F.struct("*").alias("whole"), fingerprint(text_col).alias("print")).withColumn("bucket", bucket)
    buckets = F.broadcast(touched.select(bucket.alias("bucket")).distinct())
    safe = packed.join(buckets, "bucket", "left_anti").select("whole.*")
    maybe = packed.join(buckets, "bucket", "left_semi").join(touched, "print", "left").withColumn("cut", F.col("rest").isNotNull())
    changed = F.col("whole").withField(text_col, F.coalesce("rest", F.col("whole")[text_col]))
    if size_col in docs.columns:
        kind = docs.schema[size_col].dataType
        changed = changed.withField(
            size_col, F.when(F.col("cut"), F.length("rest").cast(kind)).otherwise(F.col("whole")[size_col])
        )
    return safe.unionByName(maybe.select(changed.alias("whole")).select("whole.*"))
