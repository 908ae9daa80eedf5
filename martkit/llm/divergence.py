"""How sources of one language differ in their terms (operator 13).

The terms that a language keeps are dealt to blocks and numbered there by their
frequency. In a block, each group's counts are the leaves of a segment tree over
the term ids. Trees are hash-consed: a node is known by its two children, so
equal stretches of counts, of whichever group and place, are one node. Two
groups are compared by walking their trees together, level by level: of all
places where the same two nodes meet, one is followed and its number kept, so
each pair of nodes is priced once. Blocks' prices are added up on Spark.

A task holds one block of at most two tiles of groups, whatever the number of
terms and sources.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from martkit.llm.tables import record, released, utf8
from martkit.operators.spread import left_lookup
from martkit.workspace import written

LEAST_DOCS = 10  # of a language that hold a term it keeps
SCALE = 1_000_000_000
SMOOTH = 2
TOP = 10
BLOCK_TERMS = 8192  # about, of a block
TILE = 32  # groups, about, of a tile
PAIRS_AT_ONCE = 64  # of groups, walked together
COUNTED_TERMS = 800_000  # that a task holds before it sends its counts on
PIECE_BYTES = 1 << 20  # of a long text, counted at a time
_TERM = re.compile(rb"[A-Za-z\x80-\xff]+")  # in UTF-8: letters of ASCII and all characters beyond
_GAP = re.compile(rb"[^A-Za-z\x80-\xff]")


# --- counts ------------------------------------------------------------------


def _pieces(raw: bytes) -> Iterator[bytes]:
    """The text in parts that end between two terms."""
    at = 0
    while len(raw) - at > PIECE_BYTES and (gap := _GAP.search(raw, at + PIECE_BYTES)):
        yield raw[at : gap.start()]
        at = gap.start()
    yield raw[at:]


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``lang``, ``source``, ``term``, its occurrences ``n`` and the documents ``n_docs`` that hold it.

    A group's documents without terms count too: a row with an empty term and
    ``n`` 0 stands for each group. Tasks add up before the shuffle.
    """
    ddl = "lang string, source string, term binary, n long, n_docs long"
    schema = to_arrow_schema(docs.sparkSession.createDataFrame([], ddl).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, Counter] = defaultdict(Counter)
        holders: dict[tuple, Counter] = defaultdict(Counter)

        def told() -> Iterator[pa.RecordBatch]:
            for (lang, source), found in counts.items():
                held, many = holders[lang, source], len(found)
                yield record({"lang": pa.repeat(pa.scalar(lang, pa.string()), many), "source": pa.repeat(pa.scalar(source, pa.string()), many),
                              "term": list(found), "n": list(found.values()), "n_docs": list(map(held.__getitem__, found))}, schema)
            counts.clear()
            holders.clear()

        held = 0
        for batch in batches:
            for raw, lang, source in zip(*(batch.column(c).to_pylist() for c in ("raw", "lang", "source"))):
                group, own = (lang, source), set()
                known = counts[group]
                held -= len(known)
                for piece in _pieces(raw):
                    terms = _TERM.findall(piece.lower())  # bytes: A to Z only
                    known.update(terms)
                    own.update(terms)
                known[b""] += 0
                held += len(known)
                holders[group].update(own)
                if held > COUNTED_TERMS:
                    yield from told()
                    held = 0
        yield from told()

    empty = F.lit("")
    frame = docs.select(
        F.coalesce(utf8(text_col), empty.cast("binary")).alias("raw"),
        F.coalesce(F.col(lang_col), empty).alias("lang"), F.coalesce(F.col(source_col), empty).alias("source"),
    )
    partial = frame.mapInArrow(released(run), ddl)
    added = partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))
    return added.withColumn("term", F.col("term").cast("string"))


# --- trees --------------------------------------------------------------------


def share(count: np.ndarray, total: int, terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)), by long division: exact up to 9e15 terms in all."""
    whole = total + SMOOTH * terms
    out, rest = np.divmod(count.astype(np.int64) + SMOOTH, whole)
    for _ in range(3):  # SCALE is three steps of a thousand
        digit, rest = np.divmod(rest * 1000, whole)
        out = out * 1000 + digit
    return out + 1


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


class Forest:
    """Hash-consed segment trees of equally many counts each: rows of a matrix."""

    def __init__(self, counts: np.ndarray) -> None:
        rows, width = counts.shape
        self.width = width
        full = 1 << max(width - 1, 0).bit_length()  # terms beyond the last are leaves of their own, worth nothing
        leaves = np.full((rows, full), -1, np.int64)
        leaves[:, :width] = counts
        self.counts, nodes = np.unique(leaves, return_inverse=True)
        nodes = nodes.reshape(rows, full)
        self.children: list[tuple[np.ndarray, np.ndarray]] = []  # of each level's nodes, from the leaves up
        while nodes.shape[1] > 1:
            base = int(nodes.max()) + 1
            made, nodes = np.unique(nodes[:, ::2] * base + nodes[:, 1::2], return_inverse=True)
            nodes = nodes.reshape(rows, -1)
            self.children.append((made // base, made % base))
        self.roots = nodes[:, 0]

    def compare(self, a: np.ndarray, b: np.ndarray, totals: list[int], terms: int) -> np.ndarray:
        """The price of each pair of rows (a[i], b[i]): the sum over all terms."""
        out = np.zeros(len(a), np.int64)
        for first in range(0, len(a), PAIRS_AT_ONCE):
            part = slice(first, first + PAIRS_AT_ONCE)
            out[part] = self._compare(a[part], b[part], totals, terms)
        return out

    def _compare(self, a: np.ndarray, b: np.ndarray, totals: list[int], terms: int) -> np.ndarray:
        pair, x, y, times = np.arange(len(a)), self.roots[a], self.roots[b], np.ones(len(a), np.int64)
        for left, right in reversed(self.children):
            pair, x, y, times = np.tile(pair, 2), np.append(left[x], right[x]), np.append(left[y], right[y]), np.tile(times, 2)
            # the same two nodes of the same two groups: one is followed for all
            base = int(max(x.max(), y.max())) + 1
            met, at = np.unique((pair * base + x) * base + y, return_inverse=True)
            times = np.bincount(at, weights=times, minlength=len(met)).astype(np.int64)
            y = met % base
            pair, x = np.divmod(met // base, base)
        out = np.zeros(len(a), np.int64)
        x, y = self.counts[x], self.counts[y]
        real = x >= 0
        for i in range(len(a)):
            at = real & (pair == i)
            p, q = share(x[at], totals[a[i]], terms), share(y[at], totals[b[i]], terms)
            out[i] = int((price(p, q) * times[at]).sum())
        return out


def _cell(rows: list[dict], terms: int, width: int, tile_a: int, tile_b: int) -> Iterator[tuple]:
    """Prices of a block's pairs of groups of the two tiles, and with one tile the groups' best terms there."""
    counts = np.zeros((len(rows), max(width, 1)), np.int64)
    for i, row in enumerate(rows):
        if row["places"] is not None:
            counts[i, row["places"]] = row["counts"]
    totals = [r["total"] for r in rows]
    tiles = np.array([r["tile"] for r in rows])
    if width:
        forest = Forest(counts)
    a, b = np.triu_indices(len(rows), 1)
    if tile_a != tile_b:
        across = tiles[a] != tiles[b]
        a, b = a[across], b[across]
    whole = [i for i, r in enumerate(rows) if r["of_lang"]]
    own = ~np.isin(a, whole) & ~np.isin(b, whole)
    a, b = a[own], b[own]
    values = forest.compare(a, b, totals, terms) if width else np.zeros(len(a), np.int64)
    for i, j, v in zip(a.tolist(), b.tolist(), values.tolist()):
        yield rows[i]["source"], rows[j]["source"], None, v
    for base in whole if width else ():
        for i, row in enumerate(rows):
            if i != base:
                yield from ((row["source"], None, place, v) for place, v in _best(counts[i], counts[base], totals[i], totals[base], terms))


def _best(own: np.ndarray, lang: np.ndarray, own_total: int, lang_total: int, terms: int) -> list[tuple[int, int]]:
    """Places and values of the terms that may be among the group's TOP, all of equal value with the last one included."""
    at = np.flatnonzero(own > 0)
    pairs, which = np.unique(np.stack([own[at], lang[at]]), axis=1, return_inverse=True)
    p, q = share(pairs[0], own_total, terms), share(pairs[1], lang_total, terms)
    worth = np.where(p > q, price(p, q), -1)[which.ravel()]
    at, worth = at[worth >= 0], worth[worth >= 0]
    if len(worth) > TOP:
        kept = worth >= np.partition(worth, -TOP)[-TOP]
        at, worth = at[kept], worth[kept]
    return list(zip(at.tolist(), worth.tolist()))


# --- the audit ----------------------------------------------------------------


def _spread(col: Column, parts: Column, seed: int) -> Column:
    """A part of ``parts`` for a text, by its hash."""
    return F.pmod(F.xxhash64(col, F.lit(seed)), parts).cast("int")


def audit(counts: DataFrame) -> DataFrame:
    """Pairs of sources and terms of sources, ranked, from the rows of ``term_counts``.

    Returns ``lang``, ``source``, ``part`` (``pair`` or ``term``), ``item``,
    ``value`` and ``rank``. A language that keeps no term has pairs of value 0.
    A source that is alone in its language has no pairs. No rows give none.
    """
    spark = counts.sparkSession
    counts = written(counts)
    real = counts.where("term != ''")
    kept = real.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("n_docs").alias("docs")).where(
        F.col("docs") >= LEAST_DOCS
    )
    kept = written(kept.select("lang", "term", "lang_n"))
    named = written(counts.where("term = ''").select("lang", "source"))  # one row for each group
    of_lang = named.groupBy("lang").agg(F.count("*").alias("sources"))
    sums = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    terms = F.coalesce("terms", F.lit(0)).cast("long")
    langs = written(of_lang.join(sums, "lang", "left").select(
        "lang", terms.alias("terms"), F.coalesce("lang_total", F.lit(0)).cast("long").alias("lang_total"),
        F.greatest(F.ceil(terms / BLOCK_TERMS), F.lit(1)).cast("int").alias("blocks"),
        F.ceil(F.col("sources") / TILE).cast("int").alias("tiles"),
    ))

    # terms: a block by hash, then a place in it by frequency
    placed = left_lookup(kept, langs.select("lang", "blocks"), ["lang"])
    placed = placed.withColumn("block", _spread(F.col("term"), F.col("blocks"), 1)).drop("blocks")
    order = W.partitionBy("lang", "block").orderBy(F.desc("lang_n"), "term")
    placed = written(placed.withColumn("place", F.row_number().over(order) - 1))
    widths = placed.groupBy("lang", "block").agg(
        F.count("*").cast("int").alias("width"), F.collect_list("place").alias("places"), F.collect_list("lang_n").alias("counts")
    )
    widths = written(widths)

    # groups: their kept counts, total and tile
    own = real.select("lang", "source", "term", "n").join(placed.select("lang", "term", "block", "place"), ["lang", "term"])
    leaves = written(own.groupBy("lang", "source", "block").agg(
        F.collect_list("place").alias("places"), F.collect_list("n").alias("counts"), F.sum("n").alias("n")
    ))
    totals = leaves.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = named.join(totals, ["lang", "source"], "left")
    groups = left_lookup(groups, langs, ["lang"]).select(
        "lang", "source", F.coalesce("total", F.lit(0)).cast("long").alias("total"), "terms", "blocks", "tiles",
        _spread(F.col("source"), F.col("tiles"), 2).alias("tile"), F.lit(False).alias("of_lang"),
    )
    every = groups.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    every = every.join(leaves.select("lang", "source", "block", "places", "counts"), ["lang", "source", "block"], "left")
    # each tile meets each: the cell of two tiles is named by the lesser and the greater
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    dealt = every.withColumn("other", other).select(
        "*", F.least("tile", "other").alias("tile_a"), F.greatest("tile", "other").alias("tile_b")
    ).drop("other", "blocks", "tiles")
    # the language's own tree stands beside the groups of each single tile
    base = widths.drop("width").join(langs, "lang").withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    base = base.select(
        "lang", F.lit(None).cast("string").alias("source"), "block", F.col("lang_total").alias("total"), "terms", "tile",
        F.lit(True).alias("of_lang"), "places", "counts", F.col("tile").alias("tile_a"), F.col("tile").alias("tile_b"),
    )
    cells = left_lookup(dealt.unionByName(base), widths.select("lang", "block", "width"), ["lang", "block"])

    ddl = "lang string, block int, a string, b string, place int, value long"
    schema = to_arrow_schema(spark.createDataFrame([], ddl).schema)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        lang, block, tile_a, tile_b = (k.as_py() for k in key)
        rows = table.to_pylist()
        found = list(_cell(rows, rows[0]["terms"], rows[0]["width"] or 0, tile_a, tile_b))
        a, b, place, value = zip(*found) if found else ((), (), (), ())
        return pa.table({"lang": [lang] * len(found), "block": [block] * len(found), "a": a, "b": b, "place": place, "value": value},
                        schema=schema)

    priced = written(cells.groupBy("lang", "block", "tile_a", "tile_b").applyInArrow(run, ddl))
    pairs = priced.where("b IS NOT NULL").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        pairs.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value")
    )
    ranks = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = both.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(ranks).alias("rank"))
    best = priced.where("b IS NULL").select("lang", F.col("a").alias("source"), "block", "place", "value")
    named = best.join(placed.select("lang", "block", "place", F.col("term").alias("item")), ["lang", "block", "place"])
    top = named.select("lang", "source", F.lit("term").alias("part"), "item", "value", F.row_number().over(ranks).alias("rank"))
    return ranked.unionByName(top.where(F.col("rank") <= TOP))


def source_audit(docs: DataFrame) -> DataFrame:
    """The audit of all documents by language and source.

    Null text, language and source are empty. Repeated rows are documents of
    their own. Other columns, the document id among them, are not read.
    """
    return audit(term_counts(docs))


SOURCE_AUDIT_SQL = """
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
  FROM documents),
tokens AS (
  SELECT d, lang, source, translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT d, lang, source, unnest(regexp_extract_all(text, '[A-Za-z\\x{80}-\\x{10FFFF}]+')) AS t FROM docs)),
kept AS (
  SELECT lang, term, count(*) AS n FROM tokens GROUP BY lang, term HAVING count(DISTINCT d) >= 10),
sizes AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
own AS (SELECT lang, source, term, count(*) AS n FROM tokens SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
totals AS (SELECT lang, source, sum(n) AS total FROM own GROUP BY lang, source),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS n,
    1 + (CAST(1000000000 AS HUGEINT) * (coalesce(o.n, 0) + 2)) // (coalesce(t.total, 0) + 2 * s.v) AS p,
    1 + (CAST(1000000000 AS HUGEINT) * (k.n + 2)) // (s.total + 2 * s.v) AS q
  FROM groups g JOIN kept k ON g.lang = k.lang JOIN sizes s ON g.lang = s.lang
  LEFT JOIN totals t ON g.lang = t.lang AND g.source = t.source
  LEFT JOIN own o ON g.lang = o.lang AND g.source = o.source AND k.term = o.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source != b.source
  LEFT JOIN (
    SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS value
    FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source != y.source GROUP BY ALL
  ) p ON a.lang = p.lang AND a.source = p.source AND b.source = p.item),
terms AS (SELECT lang, source, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value,
    row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS rank FROM pairs
  UNION ALL
  SELECT lang, source, 'term', item, value,
    row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS rank FROM terms
  QUALIFY rank <= 10)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank FROM ranked
"""
