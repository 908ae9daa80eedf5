"""Byte-level BPE encoding and decoding (operator 6).

A vocabulary's tokens go, as Latin-1 text, into an Aho-Corasick automaton that
gives every token ending at a place. Encoding takes the longest token at each
place that is compatible with the token before it and backs up where none is;
two adjacent tokens are compatible if merging their joined bytes gives just
these two. Compatibility is remembered, so the work is linear in the text. The
ids are those of merging the lowest-ranked pair first.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from martkit.llm.tables import byte_list, record, released, utf8

MEMO = 200_000  # pieces that a task remembers in each of two generations, and pairs of tokens
MEMO_CHARS = 64  # longer pieces are not remembered, so the memory's bytes are bounded too


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of a token's bytes and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class BytePairs:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.sizes = {rank: len(token) for token, rank in ranks.items()}
        self.names = {rank: str(rank) for rank in ranks.values()}
        self.named = {str(rank): token for token, rank in ranks.items()}
        self.shorter = {rank: self._longest_prefix(token) for token, rank in ranks.items()}
        self.pieces = regex.compile(pattern)
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.memo: dict[str, str] = {}
        self.older: dict[str, str] = {}
        self.search = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for token, rank in ranks.items():
            self.search.add_word(token.decode("latin-1"), rank)
        self.search.make_automaton()

    def _longest_prefix(self, token: bytes) -> int | None:
        """The longest token that starts this one."""
        return next((self.ranks[token[:k]] for k in range(len(token) - 1, 0, -1) if token[:k] in self.ranks), None)

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a byte, and for a token that merges don't make."""
        known = self.halves.get(token)
        if known is None and token not in self.halves:
            ranks, own = self.ranks, self.tokens[token]
            parts = [own[i : i + 1] for i in range(len(own))]
            while len(parts) > 2:
                low, at = min((ranks.get(a + b, token), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
                if low >= token:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            if len(parts) == 2:
                known = ranks[parts[0]], ranks[parts[1]]
            self.halves[token] = known
        return known

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges of the two tokens' joined bytes give just these two tokens.

        Undoes the merges around the border, latest first: at no time may the
        pieces at the border have had a merge of their own that comes earlier.
        """
        key = left, right
        known = self.pairs.get(key)
        if known is not None:
            return known
        tokens, ranks, sizes = self.tokens, self.ranks, self.sizes
        known, before = True, 1 << 60
        while True:
            joined = ranks.get(tokens[left] + tokens[right])
            if joined is not None and joined < before:
                known = False
                break
            # bytes were there from the start
            made_left = left if sizes[left] > 1 else -1
            made_right = right if sizes[right] > 1 else -1
            if made_left < 0 and made_right < 0:
                break
            halves = self._halves(left if made_left > made_right else right)
            if halves is None:
                known = False
                break
            if made_left > made_right:
                left, before = halves[1], min(before, made_left)
            else:  # of equal merges the one further left, at the border, comes first
                right, before = halves[0], min(before, made_right + 1)
        if len(self.pairs) >= 2 * MEMO:
            self.pairs.clear()
        self.pairs[key] = known
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        text, compatible, pairs = piece.decode("latin-1"), self.compatible, self.pairs
        longest = [token for _, token in self.search.iter_long(text)]
        for i, pair in enumerate(zip(longest, longest[1:]), 1):
            known = pairs.get(pair)
            if not (compatible(*pair) if known is None else known):
                return self._backtrack(text, longest[:i], longest[i])
        return longest

    def _backtrack(self, text: str, ids: list[int], token: int | None) -> list[int]:
        """Longest matches where they are compatible, shorter ones and steps back where not.

        Goes on after ``ids`` with ``token``, the longest there. The tokens that
        lead to a place are always the same, so a place from which nothing fits
        is dead for good: each place is left at most once.
        """
        sizes, shorter, compatible, pairs, search = self.sizes, self.shorter, self.compatible, self.pairs, self.search
        n = len(text)
        dead = bytearray(n + 1)
        at = sum([sizes[i] for i in ids])
        while at < n:
            if token is None:
                token = next(search.iter_long(text, at))[1]
            end = at + sizes[token]
            if not dead[end]:
                pair = (ids[-1], token) if ids else None
                known = True if pair is None else pairs.get(pair)
                if compatible(*pair) if known is None else known:
                    ids.append(token)
                    at, token = end, None
                    continue
            token = shorter[token]
            while token is None:
                dead[at] = 1
                last = ids.pop()
                at -= sizes[last]
                token = shorter[last]
        return ids

    def piece(self, text: str) -> str:
        """Decimal ids of a match, joined by commas."""
        known = self.older.get(text)
        if known is None:
            names = self.names
            known = ",".join([names[i] for i in self.encode_piece(text.encode("utf-8"))])
        if len(text) <= MEMO_CHARS:
            if len(self.memo) >= MEMO:
                self.older = dict(self.memo)
                self.memo.clear()
            self.memo[text] = known
        return known

    def encode(self, text: str) -> str:
        """Decimal ids of a text, joined by commas."""
        get, piece = self.memo.get, self.piece
        return ",".join([get(p) or piece(p) for p in self.pieces.findall(text)])


def _broadcast(spark: SparkSession, path: str):
    """The ranks, sent to the workers: a vocabulary's size, whatever the data's."""
    return spark.sparkContext.broadcast(read_ranks(path))


def encode(
    df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True
) -> DataFrame:
    """Token ids of every whole text, and the digests of the ids and of their decoding.

    Returns the id, ``n_tokens``, ``ids_sha256`` (of the decimal ids, joined by
    commas), ``decoded_sha256`` and, with ``with_ids``, ``token_ids``. Null and
    empty texts have no tokens. Bytes that aren't UTF-8 count as U+FFFD. One row
    for each row; other columns are not read.
    """
    sent = _broadcast(df.sparkSession, path)
    kind = df.select(F.col(id_col)).schema[0].dataType.simpleString()
    ddl = f"row {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    ddl += ", token_ids array<int>" * with_ids
    frame = df.select(F.col(id_col).alias("row"), utf8(text_col).alias("raw"))
    schema = to_arrow_schema(df.sparkSession.createDataFrame([], ddl).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = BytePairs(sent.value, pattern)
        named = pairs.named
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                counts, ids_hash, text_hash, ids = [], [], [], []
                for raw in byte_list(part.column("raw")):
                    joined = pairs.encode(raw.decode("utf-8", "replace"))
                    names = joined.split(",") if joined else []
                    counts.append(len(names))
                    ids_hash.append(hashlib.sha256(joined.encode()).hexdigest())
                    text_hash.append(hashlib.sha256(b"".join([named[n] for n in names])).hexdigest())
                    if with_ids:
                        ids.append(np.array(names, np.int32))
                columns = {"row": part.column("row").cast(schema.field("row").type), "n_tokens": counts,
                           "ids_sha256": ids_hash, "decoded_sha256": text_hash, "token_ids": ids}
                yield record(columns, schema)

    return frame.mapInArrow(released(run), ddl).withColumnRenamed("row", id_col)


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """The text that each row's ids stand for; null ids give null, bytes that aren't UTF-8 U+FFFD."""
    sent = _broadcast(df.sparkSession, path)
    kind = df.select(F.col(id_col)).schema[0].dataType.simpleString()
    frame = df.select(F.col(id_col).alias("row"), F.col(ids_col).alias("ids"))
    schema = to_arrow_schema(df.sparkSession.createDataFrame([], f"row {kind}, text string").schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {rank: token for token, rank in sent.value.items()}
        for batch in batches:
            texts = [None if ids is None else b"".join(map(tokens.__getitem__, ids)).decode("utf-8", "replace")
                     for ids in batch.column("ids").to_pylist()]
            yield record({"row": batch.column("row").cast(schema.field("row").type), "text": texts}, schema)

    return frame.mapInArrow(released(run), f"row {kind}, text string").withColumnRenamed("row", id_col)
