"""Near duplicates by a chosen-path similarity join (operator 3).

Documents are sets of word shingles; equal sets form one class. Each of TREES
independent trees branches the classes by a minwise token of the set: classes
that share the token share a node. A node too large for one task branches
again by further chosen tokens, unless that leaves it most of its pairs to compare,
as among near copies of one text: such a tight node is dealt out in blocks.
Its classes are linked to a few of them, its hubs, and only those of different components
are compared further. The classes of a small node are compared
exhaustively: sketches first, then, where a link would join two components, the
full sets. A pair with similarity s misses all trees of undivided nodes with
probability (1 - s) ** TREES: at 0.75 and 16 trees, 2e-10.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from martkit.llm.graph import components
from martkit.llm.tables import SPACES, bounds_of, byte_list, groups, record, released, utf8
from martkit.workspace import written

SHINGLE = 5
PERCENT = 75
TREES = 16
TOKENS = 64  # minwise tokens of a set: the trees' own, then those for further branches
LIKELY = 27  # of 64 equal tokens; a pair at 0.75 has fewer with probability 3e-10
NODE_ROWS, NODE_SHINGLES = 2048, 4_000_000  # what one task compares
BRANCHES, DEPTH = 2, 12
TIGHT = 0.75  # share of a node's pairs that its branches hold together, from which it is dealt out instead
HUBS = 32  # rows that all blocks of a tight node have
COLUMNS = 1 << 14  # shingles of a node that are compared as bits
PARTNERS = 4096  # rows to verify against one hub in one task
FILTER_BUCKETS = 1 << 20  # rows of the broadcast filter, at any size of the data

_PLACES = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64
)
_draws = np.random.default_rng(20240501)
_FACTORS = _draws.integers(1, 2**63, TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _draws.integers(0, 2**63, TOKENS, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; fewer words than a shingle make one, none make none."""
    words = text.lower().split()  # bytes: only A-Z change, and white space is 9 to 13 and 32
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))][: len(words)], np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - SHINGLE + 1
    return np.unique(_mixed(sum(hashes[i : i + n] * _PLACES[i] for i in range(SHINGLE))))


def minwise(shingles: np.ndarray) -> np.ndarray:
    """One token for each hash function: the upper half of the smallest hash."""
    low = np.full(TOKENS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 4096):
        part = shingles[start : start + 4096]
        low = np.minimum(low, (part[None, :] * _FACTORS[:, None] ^ _OFFSETS[:, None]).min(1))
    return (low >> np.uint64(32)).astype(np.uint32).view(np.int32)


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sets are linked: 100 * intersection >= PERCENT * union."""
    if 100 * min(len(x), len(y)) < PERCENT * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= PERCENT * (len(x) + len(y) - both)


def _signed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Each row's id, hash of its text, set size, fingerprint of the set (null if empty) and tokens."""
    kind = df.select(F.col(id_col)).schema[0].dataType.simpleString()
    ddl = f"id {kind}, place long, n long, print binary, tokens array<int>"
    schema = to_arrow_schema(df.sparkSession.createDataFrame([], ddl).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, prints, tokens = [], [], []
            for text in byte_list(batch.column("raw")):
                s = shingle_set(text)
                sizes.append(len(s))
                prints.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                tokens.append(minwise(s) if len(s) else None)
            yield record({"id": batch.column("id").cast(schema.field("id").type), "place": batch.column("place"),
                          "n": sizes, "print": prints, "tokens": tokens}, schema)

    raw = utf8(text_col)
    frame = df.select(F.col(id_col).alias("id"), F.xxhash64(raw).alias("place"), raw.alias("raw"))
    return frame.mapInArrow(released(run), ddl)


def _nodes(classes: DataFrame) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """Rows (tree, node, cls) of the nodes that one task can compare, with two rows or more.

    Also the rows of the tight nodes, None if there are none, and, for each class, the trees (bits) in which its
    first node was too large and was divided.
    """
    level = classes.select(
        "cls", "n", F.posexplode(F.slice("tokens", 1, TREES)).alias("tree", "token")
    ).select("cls", "n", F.col("tree").cast("int").alias("tree"), F.xxhash64("tree", "token").alias("node"))
    sizes = level.groupBy("node").agg(F.count("*").alias("rows"), F.sum("n").alias("weight")).where("rows > 1")
    level = written(level.join(written(sizes), "node"))
    done: list[DataFrame] = []
    dealt: list[DataFrame] = []
    divided = None
    for depth in range(DEPTH + 1):
        large = (F.col("rows") > NODE_ROWS) | (F.col("weight") > NODE_SHINGLES)
        done.append(level.where(~large).select("tree", "node", "cls"))
        rest = level.where(large)
        if rest.isEmpty():
            break
        if depth == DEPTH:
            dealt.append(rest)
            break
        children = _branched(rest, classes)
        sizes = written(children.groupBy("node").agg(
            F.count("*").alias("rows"), F.sum("n").alias("weight"), F.first("parent").alias("parent"), F.first("above").alias("above")
        ).where("rows > 1"))
        pairs = sizes.groupBy("parent").agg(F.sum(F.pow("rows", F.lit(2))).alias("pairs"), F.first("above").alias("above"))
        tight = written(pairs.where(F.col("pairs") >= TIGHT * F.pow("above", F.lit(2))).select("parent"))
        loose = rest
        if not tight.isEmpty():
            nodes = tight.withColumnRenamed("parent", "node")
            dealt.append(rest.join(nodes, "node", "left_semi"))
            loose, children = rest.join(nodes, "node", "left_anti"), children.join(tight, "parent", "left_anti")
        if depth == 0:
            divided = _trees(loose)
        level = written(children.select("cls", "n", "tree", "node").join(sizes.select("node", "rows", "weight"), "node"))
    columns = ["tree", "node", "cls", "n", "rows", "weight"]
    together = written(_union([f.select(*columns) for f in dealt])) if dealt else None
    return _union(done), together, divided if divided is not None else _trees(rest)


def _trees(rest: DataFrame) -> DataFrame:
    """For each class the trees of its rows, as bits."""
    bit = F.expr("shiftleft(1, tree)").alias("bit")
    return written(rest.select("cls", bit).groupBy("cls").agg(F.bit_or("bit").alias("mask")))


def _branched(rest: DataFrame, classes: DataFrame) -> DataFrame:
    """Every row in BRANCHES children of its node: by the tokens that the node's number chooses."""
    branch = F.explode(F.sequence(F.lit(0), F.lit(BRANCHES - 1))).alias("branch")
    chosen = rest.select("tree", "node", "cls", "n", "rows", branch).withColumn(
        "choice", F.lit(TREES + 1) + F.pmod(F.xxhash64("node", "branch"), F.lit(TOKENS - TREES)).cast("int")
    )
    with_tokens = chosen.join(classes.select("cls", "tokens"), "cls")
    child = F.xxhash64("node", "branch", F.element_at("tokens", F.col("choice")))
    return with_tokens.select("cls", "n", "tree", child.alias("node"), F.col("node").alias("parent"), F.col("rows").alias("above"))


def _parts(rows: str, weight: str) -> Column:
    """Number of blocks, two of which one task compares."""
    return F.greatest(F.ceil(F.col(rows) * 2 / NODE_ROWS), F.ceil(F.col(weight) * 2 / NODE_SHINGLES)).cast("int")


def _blocks(tight: DataFrame) -> DataFrame:
    """Rows (tree, node, cls, hub) of the tight nodes' blocks; the hubs of a node are in each of its blocks."""
    split = tight.withColumn("parts", _parts("rows", "weight"))
    order = Window.partitionBy("node").orderBy(F.xxhash64("node", "cls"), "cls")
    hubs = split.withColumn("place", F.row_number().over(order)).where(F.col("place") <= HUBS)
    hubs = written(hubs.select("tree", "node", "cls", "parts"))
    own = F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int")
    rows = split.join(hubs.select("node", "cls"), ["node", "cls"], "left_anti").select(
        "tree", F.xxhash64("node", own).alias("node"), "cls", F.lit(False).alias("hub")
    )
    every = hubs.select("tree", "node", "cls", F.explode(F.expr("sequence(0, parts - 1)")).alias("own"))
    return rows.unionByName(every.select("tree", F.xxhash64("node", "own").alias("node"), "cls", F.lit(True).alias("hub")))


def _meetings(tight: DataFrame) -> DataFrame:
    """Rows (tree, node, cls, root, side) by which every two rows of a tight node with different roots meet in one task.

    The rows of a node's largest component are dealt in blocks, and so are the others; every block of the others meets
    every block, of these and of the component. The two sides of a meeting are compared; -1: all rows.
    """
    count, weight = F.count("*").alias("rows"), F.sum("n").alias("weight")
    roots = tight.groupBy("node", "root").agg(count, weight)
    tops = roots.groupBy("node").agg(
        F.max(F.struct("rows", "weight", "root")).alias("top"), F.sum("rows").alias("rows"), F.sum("weight").alias("weight")
    ).where("top.rows < rows")
    tops = tops.select(
        "node", F.col("top.root").alias("most"), F.col("top.rows").alias("most_rows"), F.col("top.weight").alias("most_weight"),
        (F.col("rows") - F.col("top.rows")).alias("rest_rows"), (F.col("weight") - F.col("top.weight")).alias("rest_weight"),
    )
    parts = written(tops.select(
        "node", "most", _parts("most_rows", "most_weight").alias("most_parts"), _parts("rest_rows", "rest_weight").alias("rest_parts")
    ))
    rows = tight.select("tree", "node", "cls", "root").join(parts, "node")
    of_most = F.col("root") == F.col("most")

    def own(of: str) -> Column:
        return F.pmod(F.xxhash64("cls"), F.col(of)).cast("int").alias("own")

    def each(of: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(of) - 1)).alias("other")

    def met(kind: int, first: str | Column, second: str | Column) -> Column:
        return F.xxhash64("node", F.lit(kind), first, second).alias("node")

    named = ["tree", "node", "cls", "root"]
    most = rows.where(of_most).select(*named, own("most_parts"), each("rest_parts"))
    rest = rows.where(~of_most).select(*named, own("rest_parts"), each("most_parts"))
    among = rows.where(~of_most).select(*named, own("rest_parts"), each("rest_parts"))
    side = F.when(F.col("own") == F.col("other"), -1).when(F.col("own") < F.col("other"), 0).otherwise(1)
    return _union([
        most.select("tree", met(0, "own", "other"), "cls", "root", F.lit(0).alias("side")),
        rest.select("tree", met(0, "other", "own"), "cls", "root", F.lit(1).alias("side")),
        among.select("tree", met(1, F.least("own", "other"), F.greatest("own", "other")), "cls", "root", side.alias("side")),
    ])


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _lists(column: pa.ListArray, width: int, dtype) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(-1, width)


def _likely_partner(tokens: np.ndarray) -> np.ndarray:
    """For each row of a node the first other row whose tokens make a link likely, -1 for none."""
    n = len(tokens)
    out = np.full(n, -1, np.int64)
    low = np.ascontiguousarray(tokens.T.astype(np.uint8))  # equal tokens have equal bytes
    for start in range(0, n, 64):
        equal = np.zeros((min(64, n - start), n), np.uint8)
        for t in range(TOKENS):
            equal += low[t, start : start + 64, None] == low[t, None, :]
        equal[np.arange(len(equal)), np.arange(start, start + len(equal))] = 0
        likely = equal >= LIKELY
        rows = np.flatnonzero(likely.any(1))
        while len(rows):
            first = likely[rows].argmax(1)
            sure = (tokens[start + rows] == tokens[first]).sum(1) >= LIKELY
            out[start + rows[sure]] = first[sure]
            rows, first = rows[~sure], first[~sure]
            likely[rows, first] = False
            rows = rows[likely[rows].any(1)]
    return out


def _best_hub(tokens: np.ndarray, hubs: int) -> np.ndarray:
    """For each row of a block the other row, of its first ``hubs``, with the most equal tokens; -1 if no link is likely."""
    equal = np.zeros((len(tokens), hubs), np.uint8)
    for t in range(TOKENS):
        equal += tokens[:, t, None] == tokens[None, :hubs, t]
    equal[np.arange(hubs), np.arange(hubs)] = 0
    return np.where(equal.max(1) >= LIKELY, equal.argmax(1), -1)


def _likely(nodes: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows of the nodes that have a likely partner in their node, with the first such partner.

    Where a node is a block, which has hubs, the most likely hub goes before.
    """
    schema = pa.schema([
        ("tree", pa.int32()), ("node", pa.int64()), ("cls", pa.int64()), ("mate", pa.int64()), ("block", pa.bool_())
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches, "node"):
            tokens = _lists(batch.column("tokens"), TOKENS, np.int32)
            cls = batch.column("cls").to_numpy()
            bounds = bounds_of(batch.column("node").to_numpy())
            mates = np.full(len(cls), -1, np.int64)
            sizes = np.diff(bounds)
            hubs = np.add.reduceat(batch.column("hub").to_numpy(zero_copy_only=False).astype(np.int64), bounds[:-1])
            two = bounds[:-1][(sizes == 2) & (hubs == 0)]
            close = two[(tokens[two] == tokens[two + 1]).sum(1) >= LIKELY]
            mates[close], mates[close + 1] = close + 1, close
            larger = (sizes > 2) | (hubs > 0)
            for start, n, h in zip(bounds[:-1][larger], sizes[larger], hubs[larger]):
                mate = _likely_partner(tokens[start : start + n])
                if h:
                    best = _best_hub(tokens[start : start + n], h)
                    mate = np.where(best < 0, mate, best)
                mates[start : start + n] = np.where(mate < 0, -1, mate + start)
            kept = np.flatnonzero(mates >= 0)
            columns = {n: batch.column(n).take(pa.array(kept)) for n in ("tree", "node", "cls")}
            yield record(columns | {"mate": cls[mates[kept]], "block": np.repeat(hubs > 0, sizes)[kept]}, schema)

    rows = nodes.join(classes.select("cls", "tokens"), "cls").select("tree", "node", "cls", "hub", "tokens")
    sorted_rows = rows.repartition("node").sortWithinPartitions("node", F.desc("hub"), "cls")
    return sorted_rows.mapInArrow(released(run), "tree int, node long, cls long, mate long, block boolean")


def _sets(df: DataFrame, text_col: str, active: DataFrame) -> DataFrame:
    """The full set of each active class, from the text of one of its rows.

    Before the texts are shuffled, a broadcast filter of FILTER_BUCKETS buckets
    at most leaves out those that surely are of no active class.
    """
    schema = pa.schema([("print", pa.binary()), ("shingles", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t).tobytes() for t in byte_list(batch.column("raw"))]
            yield record({"print": [xxhash.xxh3_128_digest(s) for s in sets], "shingles": sets}, schema)

    raw = utf8(text_col)
    bucket = F.pmod(F.col("place"), F.lit(FILTER_BUCKETS)).alias("bucket")
    places = active.select("place").distinct()
    texts = df.select(F.xxhash64(raw).alias("place"), raw.alias("raw")).withColumn("bucket", bucket)
    texts = texts.join(F.broadcast(places.select(bucket).distinct()), "bucket", "left_semi")
    single = texts.groupBy("place").agg(F.first("raw").alias("raw"))  # copies meet before the shuffle
    sets = single.join(places, "place", "left_semi").select("raw").mapInArrow(released(run), "print binary, shingles binary")
    return sets.join(active.select("print", "cls"), "print").select("cls", "shingles")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (hub, cls) whose full sets are linked. A hub's partners are dealt to tasks of bounded size."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, own = None, None
        for batch in batches:
            found: list[tuple[int, int]] = []
            for key, salt, cls, raw in zip(*(batch.column(n).to_pylist() for n in ("hub", "salt", "cls", "shingles"))):
                if (key, salt) != hub:  # the hub's own row comes first
                    hub, own = (key, salt), np.frombuffer(raw, np.uint64)
                elif similar(own, np.frombuffer(raw, np.uint64)):
                    found.append((key, cls))
            yield record({"a": [x for x, _ in found], "b": [y for _, y in found]}, schema)

    salts = F.ceil(F.count("*") / PARTNERS).cast("int").alias("salts")
    hubs = pairs.groupBy("hub").agg(salts)
    partners = pairs.join(written(hubs), "hub").select(
        "hub", F.pmod(F.xxhash64("cls"), F.col("salts")).cast("int").alias("salt"), "cls", F.lit(1).alias("rank")
    )
    own = partners.select("hub", "salt").distinct().select("hub", "salt", F.col("hub").alias("cls"), F.lit(0).alias("rank"))
    rows = own.unionByName(partners).join(sets, "cls")
    dealt = rows.repartition("hub", "salt").sortWithinPartitions("hub", "salt", "rank")
    return dealt.select("hub", "salt", "cls", "shingles").mapInArrow(released(run), "a long, b long")


class _Common:
    """Shingles that several sets of a node have, the most frequent as bits: an upper bound of two sets' intersection."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sizes = np.array([len(x) for x in sets], np.int64)
        _, places, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        order = np.argsort(-counts, kind="stable")[: min(COLUMNS, int((counts > 1).sum()))]
        column = np.full(len(counts), -1, np.int64)
        column[order] = np.arange(len(order))
        own, column = np.repeat(np.arange(len(sets)), self.sizes), column[places]
        among = counts[places] > 1
        self.others = np.bincount(own[among & (column < 0)], minlength=len(sets))  # shingles beyond the columns
        self.bits = np.zeros((len(sets), -(-len(order) // 64) * 8), np.uint8)
        kept = column >= 0
        np.bitwise_or.at(self.bits, (own[kept], column[kept] >> 3), np.uint8(1) << (column[kept] & 7).astype(np.uint8))
        self.bits = self.bits.view(np.uint64)

    def may_link(self, i: int, others: np.ndarray) -> np.ndarray:
        """Whether a set can be linked with others, by the bits; ``similar`` has the last word."""
        both = np.bitwise_count(self.bits[others] & self.bits[i]).sum(1, dtype=np.int64)
        both += np.minimum(self.others[others], self.others[i])
        return 100 * both >= PERCENT * (self.sizes[others] + self.sizes[i] - both)


def _links_in_node(tree: int, tokens: np.ndarray, masks: np.ndarray, roots: np.ndarray, sides: np.ndarray,
                   sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that join different components of a node's rows, each confirmed on the full sets.

    Pairs that an earlier tree's undivided node has compared are left to it. Of a meeting the two sides are compared.
    """
    label = roots.copy()
    common, met = None, 0
    bits = 1 << np.arange(tree)
    whole = sides[0] < 0
    second = np.flatnonzero(sides == 0)
    out = []
    for i in range(len(tokens) - 1) if whole else np.flatnonzero(sides == 1):
        others = np.arange(i + 1, len(tokens)) if whole else second
        others = others[label[others] != label[i]]
        same = tokens[others] == tokens[i]
        likely = same.sum(1) >= LIKELY
        others = others[likely]
        if tree and len(others):
            divided = ((masks[others, None] | masks[i]) & bits) > 0
            others = others[~(same[likely, :tree] & ~divided).any(1)]
        met += len(others)
        if met > len(tokens):  # else the bits cost more than they save
            if common is None:
                common = _Common(sets)
            others = others[common.may_link(i, others)]
        for j in others:
            a, b = sorted((int(label[i]), int(label[j])))
            if a != b and similar(sets[i], sets[j]):
                label[label == b] = a
                out.append((a, b))
    return out


def _links_between(rows: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between components, from the nodes and meetings that hold rows of several."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches, "node"):
            tokens = _lists(batch.column("tokens"), TOKENS, np.int32)
            roots, masks = batch.column("root").to_numpy(), batch.column("mask").to_numpy()
            trees, sides = batch.column("tree").to_numpy(), batch.column("side").to_numpy()
            bounds = bounds_of(batch.column("node").to_numpy())
            found = []
            for start, end in zip(bounds[:-1], bounds[1:]):
                sets_here = [np.frombuffer(s.as_py(), np.uint64) for s in batch.column("shingles").slice(start, end - start)]
                part = slice(start, end)
                found += _links_in_node(int(trees[start]), tokens[part], masks[part], roots[part], sides[part], sets_here)
            yield record({"a": [x for x, _ in found], "b": [y for _, y in found]}, schema)

    full = rows.join(classes.select("cls", "tokens"), "cls").join(sets, "cls")
    dealt = full.repartition("node").sortWithinPartitions("node", "cls")
    columns = ["tree", "node", "tokens", "root", "mask", "side", "shingles"]
    return dealt.select(*columns).mapInArrow(released(run), "a long, b long")


def _roots(frame: DataFrame, found: DataFrame, col: str) -> DataFrame:
    """The frame with the roots of its ids; an id without a link is its own."""
    named = found.select(F.col("id").alias(col), F.col("root").alias("_root"))
    return frame.join(named, col, "left").withColumn("root", F.coalesce("_root", col)).drop("_root")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's id, set size ``n_shingles``, ``component_id`` and whether it is ``kept``.

    Null and empty texts have empty sets, are linked with nothing and are kept.
    Equal sets are linked. A component's id is its smallest row id that isn't
    null; where all are null the component has none, and its rows are kept.
    Repeated rows with the kept id are all kept. Other columns are not read.
    """
    signed = written(_signed(df, id_col, text_col))
    grouped = signed.where("print is not null").groupBy("print").agg(
        F.min("id").alias("low"), F.min("place").alias("place"), F.first("n").alias("n"), F.first("tokens").alias("tokens")
    )
    classes = written(grouped.withColumn("cls", F.monotonically_increasing_id()))
    nodes, tight, divided = _nodes(classes)
    nodes = nodes.withColumn("hub", F.lit(False))
    rows = written(_likely(nodes if tight is None else nodes.unionByName(_blocks(tight)), classes))
    roots = _linked(df, text_col, classes, rows, tight, divided)
    rooted = _roots(classes.select("cls", "print", "low"), roots, "cls")
    lows = written(rooted.groupBy("root").agg(F.min("low").alias("component_id")))
    named = written(rooted.join(lows, "root").select("print", "root", "component_id"))
    out = signed.join(named, "print", "left").withColumn(
        "component_id", F.when(F.col("print").isNull(), F.col("id")).otherwise(F.col("component_id"))
    )
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.col("component_id").isNull())
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"),
                      "root", "place")


def _linked(
    df: DataFrame, text_col: str, classes: DataFrame, rows: DataFrame, tight: DataFrame | None, divided: DataFrame
) -> DataFrame:
    """Components of the classes: links to each row's first partner, then those between components."""
    pairs = rows.where("block OR mate < cls").select(F.col("mate").alias("hub"), "cls").distinct()
    rows = rows.where("NOT block")
    active = rows.select("cls").distinct() if tight is None else _union([rows.select("cls"), tight.select("cls")]).distinct()
    sets = written(_sets(df, text_col, classes.join(active, "cls", "left_semi").select("cls", "print", "place")))
    first = components(_verified(pairs, sets))
    rooted = written(_roots(rows.select("tree", "node", "cls"), first, "cls"))
    mixed = rooted.groupBy("node").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x != y").select("node")
    open_rows = rooted.join(mixed, "node", "left_semi").withColumn("side", F.lit(-1))
    if tight is not None:
        open_rows = open_rows.unionByName(_meetings(written(_roots(tight, first, "cls"))))
    open_rows = open_rows.join(divided, "cls", "left").fillna(0, ["mask"])
    second = components(_links_between(open_rows, classes, sets))
    joined = _roots(first.select("id", F.col("root").alias("before")), second, "before").select("id", "root")
    lone = second.join(first, "id", "left_anti")
    return written(joined.unionByName(lone))


def document_duplicates(docs: DataFrame) -> DataFrame:
    """Digest of every document's component; see ``near_duplicates`` for odd rows."""
    return near_duplicates(docs).select("doc_id", F.col("n_shingles").cast("long"), "component_id", "kept")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of near duplicates, with its columns as they were; rows without words all stay.

    The row stays that has the component's id; of several such rows, which
    repeat an id, one with the smallest hash of its text.
    """
    judged = near_duplicates(docs, id_col, text_col).where("kept and root is not null")
    chosen = judged.groupBy("root").agg(F.min("place").alias("place"), F.min(id_col).alias("id")).select(
        "place", F.coalesce(F.col("id").cast("string"), F.lit("")).alias("key"), F.col("id").isNull().alias("none")
    )
    packed = docs.select(
        F.struct("*").alias("whole"), F.xxhash64(utf8(text_col)).alias("place"),
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("key"), F.col(id_col).isNull().alias("none"),
        F.coalesce(F.length(F.translate(F.col(text_col), SPACES, "")) == 0, F.lit(True)).alias("bare"),
    )
    key = ["place", "key", "none"]
    one = packed.where("not bare").join(chosen, key, "left_semi").groupBy(*key).agg(F.first("whole").alias("whole"))
    return packed.where("bare").select("whole.*").unionByName(one.select("whole.*"))
