"""Language of a text by cross-parsing (operator 4).

A suffix automaton over labelled text of each language reads a text in phrases:
the longest piece found in that language's text, then the next, and so on. The
fewer phrases, each weighted by the logarithm of the language's text, the
nearer the language. The automata learn from EXCERPTS pieces of CHARS letters
of different texts for each label. Every language has symbols of its own, so no
script takes another's; languages are sent to the workers in blocks of BLOCK_BYTES.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from martkit.llm.tables import bounds_of, byte_list, held_out, record, utf8
from martkit.workspace import written

EXCERPTS, CHARS = 64, 400
SYMBOLS = 250  # letters told apart in a language; rarer ones in its sample count as one
BLOCK_BYTES = 128 << 20  # of tables that a worker holds together
PIECE = 512  # symbols that are parsed in a row; a text is parsed piece by piece
TEXT_BYTES = 8 << 20
UNDETERMINED = "und"

_SPACE, _RARE, _STRANGE = 0, 1, 2


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def codes(texts: list[str], is_letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts' letters in lower case with one 0 for each run of what is no letter, and their lengths."""
    lower = [t.lower() for t in texts]
    sizes = np.array([len(t) for t in lower], np.int64)
    found = np.frombuffer("".join(lower).encode("utf-32-le", "replace"), np.uint32)
    found = np.where(is_letter[found], found, np.uint32(_SPACE))
    before = np.concatenate([[_SPACE], found[:-1]]) if len(found) else found
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    before[starts] = _SPACE
    kept = (found != _SPACE) | (before != _SPACE)
    total = np.concatenate([[0], np.cumsum(kept)])
    ends = np.cumsum(sizes)
    return found[kept], total[ends] - total[ends - sizes]


def alphabet(found: np.ndarray) -> tuple[list[int], list[int]]:
    """Letters of a language: the SYMBOLS most frequent ones, and the rarer ones."""
    values, counts = np.unique(found[found != _SPACE], return_counts=True)
    order = values[np.lexsort((values, -counts))].tolist()
    return order[:SYMBOLS], order[SYMBOLS:]


def symbol_table(known: list[int], rare: list[int]) -> np.ndarray:
    """A language's symbol of each code: one for all rare letters, one that no phrase has for those it lacks."""
    table = np.full(0x110000, _STRANGE, np.uint8)
    table[_SPACE], table[rare] = _SPACE, _RARE
    table[known] = np.arange(_STRANGE + 1, _STRANGE + 1 + len(known))
    return table


def automaton(text: np.ndarray, width: int) -> np.ndarray:
    """The suffix automaton of a text as one table: for each state and symbol, the state that follows.

    Where the symbol leads no further, a phrase ends: the entry is then below 0, the complement of the state that
    the symbol leads to from the start.
    """
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in text.tolist():
        state = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in moves[at]:
            moves[at][symbol] = state
            at = link[at]
        if at >= 0:
            there = moves[at][symbol]
            if length[there] != length[at] + 1:
                moves.append(dict(moves[there]))
                length.append(length[at] + 1)
                link.append(link[there])
                link[there] = copy = len(moves) - 1
                while at >= 0 and moves[at].get(symbol) == there:
                    moves[at][symbol] = copy
                    at = link[at]
                there = copy
            link[state] = there
        last = state
    table = np.zeros((len(moves), width), np.int32)
    root = np.zeros(width, np.int32)
    for symbol, state in moves[0].items():
        root[symbol] = state
    table[:] = ~root
    for state, following in enumerate(moves):
        table[state, list(following)] = list(following.values())
    return table


def phrases(found: np.ndarray, sizes: np.ndarray, symbols: list[np.ndarray], tables: list[np.ndarray]) -> np.ndarray:
    """Phrases of each text in each language: all pieces of all texts are read in step, one symbol at a time."""
    pieces = -(-sizes // PIECE)
    owner = np.repeat(np.arange(len(sizes)), pieces)
    first = np.concatenate([[0], np.cumsum(pieces)])[:-1]
    rank = np.arange(len(owner)) - first[owner]
    starts = (np.cumsum(sizes) - sizes)[owner] + rank * PIECE
    lengths = np.minimum(PIECE, sizes[owner] - rank * PIECE)
    order = np.argsort(-lengths, kind="stable")
    owner, starts, lengths = owner[order], starts[order], lengths[order]
    longest = int(lengths[0]) if len(lengths) else 0
    reading = np.searchsorted(-lengths, -np.arange(longest), "left")  # pieces longer than each step
    out = np.zeros((len(tables), len(sizes)), np.int64)
    for k, (own, table) in enumerate(zip(symbols, tables)):
        padded = np.append(own[found], np.zeros(PIECE, np.uint8)).astype(np.int32)
        steps = (padded[starts[:n] + t] for t, n in enumerate(reading.tolist()))
        flat, width = table.ravel(), table.shape[1]
        state = np.zeros(len(owner), np.int32)
        count = np.zeros(len(owner), np.int32)
        for n, symbol in zip(reading.tolist(), steps):
            to = flat[state[:n] * width + symbol]
            sign = to >> 31
            count[:n] -= sign
            state[:n] = to ^ sign
        out[k] = np.bincount(owner, weights=count + (state > 0), minlength=len(sizes)).astype(np.int64)
    return out


def sample(labelled: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """Language and text of the excerpts: EXCERPTS different texts of each language by a hash, CHARS characters of each."""
    text = F.col(text_col)
    pick = F.xxhash64(text, F.lit(7))
    room = F.greatest(F.length(text) - CHARS, F.lit(0)) + 1
    rows = labelled.where(F.col(lang_col).isNotNull() & (F.length(text) > 0)).select(
        F.col(lang_col).cast("string").alias("lang"), pick.alias("pick"),
        F.substring(text, F.pmod(pick, room).cast("int") + 1, F.lit(CHARS)).alias("text"),
    )
    order = W.partitionBy("lang").orderBy("pick")
    ranked = rows.select("lang", "pick").distinct().withColumn("n", F.row_number().over(order))
    chosen = written(ranked.where(F.col("n") <= EXCERPTS).drop("n"))
    texts = rows.join(chosen, ["lang", "pick"], "left_semi").groupBy("lang", "pick").agg(F.min("text").alias("text"))
    return written(texts)


def fit(excerpts: DataFrame) -> Iterator[dict]:
    """Blocks of languages in order of their names: letters, automaton and weight of a phrase of each."""
    is_letter = letters()

    def empty() -> dict:
        return {"langs": [], "letters": [], "tables": [], "weights": []}

    block, held = empty(), 0
    rows = excerpts.orderBy("lang", "pick").toLocalIterator()
    for lang, texts in groupby(rows, key=lambda r: r["lang"]):
        found, _ = codes([r["text"] + " " for r in texts], is_letter)
        own = alphabet(found)
        table = automaton(symbol_table(*own)[found], len(own[0]) + _STRANGE + 1)
        if block["langs"] and held + table.nbytes > BLOCK_BYTES:
            yield block
            block, held = empty(), 0
        block["langs"].append(lang)
        block["letters"].append(own)
        block["tables"].append(table)
        block["weights"].append(float(np.log2(len(found) + 2)))
        held += table.nbytes
    if block["langs"]:
        yield block


def predict(
    df: DataFrame, model: Iterable[dict], id_col: str = "doc_id", text_col: str = "text", keep: list = ()
) -> DataFrame:
    """Each row's columns of ``keep``, ``lang_pred`` and ``score``.

    The language of fewest weighted phrases; of equals, the first by name. The
    score is how far the second language is behind, as a share of its phrases;
    1 where there is no second. ``und`` and 0 for null, for texts without a
    letter and where nothing was learned. Bytes that aren't UTF-8 count as U+FFFD.
    """
    spark = df.sparkSession
    sent = [spark.sparkContext.broadcast(block) for block in model]
    frame = df.select(F.struct(F.col(id_col), *keep).alias("row"), utf8(text_col).alias("raw"))
    ddl = f"row {frame.schema['row'].dataType.simpleString()}, lang_pred string, score double"
    schema = to_arrow_schema(spark.createDataFrame([], ddl).schema)

    packed = np.packbits(letters())

    def chunks(batches: Iterator[pa.RecordBatch], is_letter: np.ndarray) -> Iterator[list]:
        """Rows, their letters and lengths, the phrases of the best and the second language, and the best one's name."""
        for batch in batches:
            texts = byte_list(batch.column("raw"))
            cuts = bounds_of(np.cumsum([len(t) for t in texts]) // TEXT_BYTES) if texts else [0]
            for a, b in zip(cuts[:-1], cuts[1:]):
                found, sizes = codes([t.decode("utf-8", "replace") for t in texts[a:b]], is_letter)
                rows = batch.column("row").slice(a, b - a).cast(schema.field("row").type)
                yield [rows, found, sizes, np.full((2, b - a), np.inf), np.full(b - a, UNDETERMINED, object)]

    def judge(chunk: list, block: dict, symbols: list[np.ndarray]) -> None:
        _, found, sizes, best, name = chunk
        counts = phrases(found, sizes, symbols, block["tables"]) * np.array(block["weights"])[:, None]
        first = counts.argmin(0)
        least = counts[first, np.arange(len(sizes))]
        name[:] = np.where(least < best[0], np.array(block["langs"], object)[first], name)
        best[:] = np.sort(np.concatenate([best, counts]), 0)[:2]

    def verdict(chunk: list) -> pa.RecordBatch:
        rows, _, sizes, (first, second), name = chunk
        letters = sizes > 0 if sent else np.zeros(len(sizes), bool)  # a space stands only after a letter
        alone = np.isinf(second)
        margin = np.where(alone, 1.0, (np.where(alone, 0, second) - np.where(alone, 0, first)) / np.maximum(second, 1e-9))
        return record({"row": rows, "lang_pred": np.where(letters, name, UNDETERMINED).tolist(),
                       "score": np.where(letters, margin, 0.0)}, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = chunks(batches, np.unpackbits(packed).astype(bool))
        if len(sent) > 1:  # a task holds all of its rows only where blocks come one after the other
            held = list(held)
        if not sent:
            yield from map(verdict, held)
        for n, part in enumerate(sent):
            block = part.value
            symbols = [symbol_table(*own) for own in block["letters"]]
            for chunk in held:
                judge(chunk, block, symbols)
                if n == len(sent) - 1:
                    yield verdict(chunk)
            if len(sent) > 1:
                del block, part._value  # a task holds one block at a time

    return frame.mapInArrow(run, ddl).select("row.*", "lang_pred", "score")


def document_languages(docs: DataFrame, folds: int = 4, fold: int = 2) -> DataFrame:
    """Digest of every document's language, learned from the labelled documents outside the fold."""
    out = held_out("doc_id", folds, fold)
    model = fit(sample(docs.where(~out), "text", "lang"))
    return predict(docs, model, keep=[out.alias("held_out")])
