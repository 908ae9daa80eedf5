"""The trie of conversation prefixes (operator 12).

A conversation is the row of digests of its prefixes, so equal conversations
are equal rows and are taken as one item with a weight. Items are sorted by
range partitions and taken in blocks of bounded size. In a block, a sparse table
over the common prefix lengths of neighbours answers range minima, and each
candidate prefix finds the first and the last item that start with it by binary
searches of its own: no stack, and no order among the candidates. The extents
give the members; numbered by their first item and depth, nodes stand in
preorder, so a subtree is a range and its sums are differences of running sums.

Only the prefixes of a block's first and last item can have members in other
blocks. These two items go on to the next level, each prefix with all that the
block knows of it, and are sorted and taken in blocks in turn, until one block
holds them all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from martkit.llm.tables import record, released
from martkit.operators.spread import left_lookup
from martkit.workspace import written

DIGEST = 16
ROOT = b"\0" * DIGEST
BLOCK_TURNS = 20_000  # turns of the items in a block, beyond the last item
BLOCK_ITEMS = 8  # items at least in a block, so that each level has far fewer than the one before
TASK_TURNS = 1_000_000  # turns of the items that one task sorts
BASE_STEP = 100  # conversations share the first turns of the one whose id is a multiple of this
HEADS = 6  # and take from 0 to 5 of them
_NOTHING = np.iinfo(np.int64).max
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()

# Nodes, and the items that go on to the next level. An item: the digests of its prefixes one after the other, the code
# points of its turns, and for each depth from 0 what is known of the conversations that leave the item there.
NODE_DDL = (
    "node binary, parent binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string"
)
ITEM_DDL = (
    "path binary, points array<int>, members array<long>, low array<long>, saved array<long>, leaves array<long>, "
    "children array<long>, ends array<string>"
)


class RangeMinimum:
    """Minima of ranges of an array, from minima over all runs whose length is a power of two."""

    def __init__(self, values: np.ndarray) -> None:
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def minimum(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The least value of each range, which must not be empty."""
        level = np.frexp((end - first).astype(np.float64))[1] - 1
        out = np.empty(len(first), self.levels[0].dtype)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.levels[k][first[at]], self.levels[k][end[at] - (1 << k)])
        return out

    def reach_right(self, start: np.ndarray, least: np.ndarray) -> np.ndarray:
        """From each place on, the first one whose value is below ``least``, or the end."""
        at = start.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            row = self.levels[k]
            fits = at + (1 << k) <= len(self.levels[0])
            fits[fits] = row[at[fits]] >= least[fits]
            at[fits] += 1 << k
        return at

    def reach_left(self, end: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Back from each place (exclusive), the start of the values that are at least ``least``."""
        at = end.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            row = self.levels[k]
            fits = at >= 1 << k
            fits[fits] = row[at[fits] - (1 << k)] >= least[fits]
            at[fits] -= 1 << k
        return at


def common_prefixes(digests: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each item the number of prefix digests that it shares with the one before, 0 for the first."""
    starts = np.cumsum(sizes) - sizes
    least = np.concatenate([[0], np.minimum(sizes[1:], sizes[:-1])])
    item = np.repeat(np.arange(len(sizes)), least)
    depth = np.arange(len(item)) - (np.cumsum(least) - least)[item]
    # once two prefixes differ, all longer ones do
    same = (digests[starts[item] + depth] == digests[starts[item - 1] + depth]).all(1)
    return np.bincount(item[same], minlength=len(sizes))


class Block:
    """The trie of sorted, distinct items; nodes in preorder, the root first."""

    def __init__(self, items: dict[str, list]) -> None:
        self.paths = items["path"]
        self.sizes = np.array([len(p) // DIGEST for p in self.paths], np.int64)
        m = len(self.paths)
        self.common = common_prefixes(np.frombuffer(b"".join(self.paths), np.uint64).reshape(-1, 2), self.sizes)
        # the value at i is the prefix that items i and i + 1 share
        self.shared = RangeMinimum(self.common[1:])
        new = self.sizes - self.common
        self.base = 1 + np.concatenate([[0], np.cumsum(new)])  # first node of each item
        self.n = int(self.base[-1])
        owner = np.repeat(np.arange(m), new)
        depth = np.arange(1, self.n) - self.base[:-1][owner] + self.common[owner] + 1
        self.depth = np.concatenate([[0], depth])
        self.first = np.concatenate([[0], owner])
        self.first, self.end = self.extents(self.first, self.depth)
        self.stop = np.where(self.end < m, self.base[np.minimum(self.end, m - 1)], self.n)  # of the subtree
        self.stop[0] = self.n
        self.parent = np.arange(-1, self.n - 1)
        heads = np.flatnonzero(new > 0)
        self.parent[self.base[heads]] = self.node_of(heads, self.common[heads])
        self._add(items)

    def extents(self, item: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First item, and end of the items, that share the item's prefix of that depth."""
        return self.shared.reach_left(item, depth), self.shared.reach_right(item, depth) + 1

    def node_of(self, item: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The node of an item's prefix: its first item has it among its own."""
        first = self.extents(item, depth)[0]
        return np.where(depth > 0, self.base[first] + depth - self.common[first] - 1, 0)

    def _add(self, items: dict[str, list]) -> None:
        item = np.repeat(np.arange(len(self.paths)), self.sizes + 1)
        starts = np.cumsum(self.sizes + 1) - self.sizes - 1
        depth = np.arange(len(item)) - starts[item]
        node = self.node_of(item, depth)

        def own(name: str) -> np.ndarray:
            out = np.zeros(self.n, np.int64)
            np.add.at(out, node, np.concatenate([np.asarray(x, np.int64) for x in items[name]]))
            return out

        self.points = np.zeros(self.n, np.int64)
        inner = depth > 0
        self.points[node[inner]] = np.concatenate([np.asarray(x, np.int64) for x in items["points"]])
        self.own_low = np.full(self.n, _NOTHING)
        np.minimum.at(self.own_low, node, np.concatenate([np.asarray(x, np.int64) for x in items["low"]]))
        self.own_members, self.own_saved, self.own_leaves = own("members"), own("saved"), own("leaves")
        self.children = own("children") + np.bincount(self.parent[1:], minlength=self.n)
        place = np.arange(self.n)
        self.low = RangeMinimum(self.own_low).minimum(place, self.stop)
        self.members = self._subtree(self.own_members)
        self.ends = np.full(self.n, None, object)
        for at, text in zip(node.tolist(), (e for x in items["ends"] for e in x)):
            if text is not None:
                self.ends[at] = text
        self.open = np.zeros(self.n, bool)

    def _subtree(self, values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        return total[self.stop] - total[:-1]

    def path_nodes(self, item: int) -> np.ndarray:
        """The nodes of an item's prefixes, the root first."""
        depth = np.arange(self.sizes[item] + 1)
        return self.node_of(np.full(len(depth), item), depth)

    def close(self, borders: bool) -> None:
        """Sums over subtrees; with ``borders`` the prefixes of the first and last item stay open."""
        if borders:
            for item in (0, len(self.paths) - 1):
                self.open[self.path_nodes(item)] = True
        closed = ~self.open
        self.saved = self._subtree(self.own_saved + np.where(closed, (self.members - 1) * self.points, 0))
        self.leaves = self._subtree(self.own_leaves + (closed & (self.children == 0)))

    def digests(self, nodes: np.ndarray) -> list[bytes]:
        return [self.paths[i][(d - 1) * DIGEST : d * DIGEST] if d else ROOT
                for i, d in zip(self.first[nodes].tolist(), self.depth[nodes].tolist())]

    def rows(self) -> dict:
        """The closed nodes; the smallest member of a parent that is open is not known yet."""
        at = np.flatnonzero(~self.open)
        parent = self.parent[at]
        known = (parent >= 0) & ~self.open[parent]
        parents = self.digests(np.maximum(parent, 0))
        return {
            "node": self.digests(at), "parent": [d if p >= 0 else None for d, p in zip(parents, parent.tolist())],
            "depth": self.depth[at], "conv_id": self.low[at],
            "parent_conv_id": pa.array(self.low[parent], pa.int64(), mask=~known),
            "n_convs": self.members[at], "n_children": self.children[at], "n_leaves": self.leaves[at],
            "saved_tokens": self.saved[at], "ends_sha256": [e or _EMPTY_SHA for e in self.ends[at].tolist()],
        }

    def borders(self) -> dict[str, list]:
        """The first and the last item; each open node, with what closed subtrees below it hold, under one of the two."""
        top = np.flatnonzero(self.open)
        below = np.flatnonzero(~self.open & self.open[np.maximum(self.parent, 0)])
        index = np.full(self.n, -1)
        index[top] = np.arange(len(top))
        under = index[self.parent[below]]
        sums = {"members": self.own_members[top], "saved": self.own_saved[top], "leaves": self.own_leaves[top],
                "children": self.children[top] - self._open_children(top), "low": self.own_low[top]}
        for name, closed in (("members", self.members), ("saved", self.saved), ("leaves", self.leaves)):
            np.add.at(sums[name], under, closed[below])
        np.minimum.at(sums["low"], under, self.low[below])
        out: dict[str, list] = {name: [] for name in ("path", "points", "ends", *sums)}
        done = np.zeros(self.n, bool)
        for item in sorted({0, len(self.paths) - 1}):
            nodes = self.path_nodes(item)
            fresh, at = ~done[nodes], index[nodes]
            done[nodes] = True
            out["path"].append(self.paths[item])
            out["points"].append(self.points[nodes[1:]].tolist())
            for name, values in sums.items():
                out[name].append(np.where(fresh, values[at], _NOTHING if name == "low" else 0).tolist())
            out["ends"].append([e if f else None for e, f in zip(self.ends[nodes].tolist(), fresh.tolist())])
        return out

    def _open_children(self, top: np.ndarray) -> np.ndarray:
        inner = top[top > 0]
        return np.bincount(self.parent[inner], minlength=self.n)[top]


def _blocks(rows: Iterator[dict], whole: bool) -> Iterator[dict[str, list]]:
    """Items in sorted order, cut into blocks; all of them with ``whole``."""
    names = ("path", "points", "members", "low", "saved", "leaves", "children", "ends")
    block: dict[str, list] = {n: [] for n in names}
    turns = 0
    for row in rows:
        for name in names:
            block[name].append(row[name])
        turns += len(row["points"])
        if not whole and turns >= BLOCK_TURNS and len(block["path"]) >= BLOCK_ITEMS:
            yield block
            block, turns = {n: [] for n in names}, 0
    if block["path"]:
        yield block


def _single(row: dict) -> dict:
    """An item from the row of a class: all that is known is at its end."""
    inner = [0] * len(row["points"])
    return row | {
        "members": [*inner, row["n"]], "low": [*([_NOTHING] * len(inner)), row["conv_id"]], "saved": [*inner, 0],
        "leaves": [*inner, 0], "children": [*inner, 0], "ends": [*([None] * len(inner)), row["ends_sha256"]],
    }


def _level(items: DataFrame, tasks: int, first: bool) -> DataFrame:
    """Nodes that close in the blocks of the items, and the blocks' border items; with one task all nodes close."""
    ddl = f"{NODE_DDL}, {ITEM_DDL}"
    schema = to_arrow_schema(items.sparkSession.createDataFrame([], ddl).schema)
    whole = tasks == 1
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in batch.to_pylist())
        for block in _blocks(map(_single, rows) if first else rows, whole):
            trie = Block(block)
            trie.close(borders=not whole)
            parts = [trie.rows()] if whole else [trie.rows(), trie.borders()]
            for part in parts:
                n = len(part["node"] if "node" in part else part["path"])
                yield record({c: part.get(c, pa.nulls(n, schema.field(c).type)) for c in names}, schema)

    dealt = items.coalesce(1) if whole else items.repartitionByRange(tasks, "path")
    return written(dealt.sortWithinPartitions("path").mapInArrow(released(run), ddl))


def _tasks(items: DataFrame) -> int:
    """Tasks for a level; one only if a block can hold all its items."""
    n, turns = items.agg(F.count("*"), F.coalesce(F.sum(F.size("points")), F.lit(0))).first()
    if turns <= BLOCK_TURNS or n <= BLOCK_ITEMS:
        return 1
    most = max(int(items.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-turns // TASK_TURNS))
    return max(2, min(-(-turns // BLOCK_TURNS), -(-n // BLOCK_ITEMS), most))


def _ends(members: DataFrame) -> DataFrame:
    """For each class of equal paths: its members' number ``n``, the smallest one and the digest of their ids in order.

    Ids are sorted over ranges of class and id, so a hot class is spread over
    tasks; each joins its ids to pieces of text, and one task per class, to
    which only the pieces go, digests them as a stream.
    """
    spark = members.sparkSession
    piece_ddl = "cls binary, conv_id long, n long, ids string"
    pieces_schema = to_arrow_schema(spark.createDataFrame([], piece_ddl).schema)
    ddl = "cls binary, conv_id long, n long, ends_sha256 string"
    schema = to_arrow_schema(spark.createDataFrame([], ddl).schema)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cls, ids = batch.column("cls").to_pylist(), batch.column("conv_id").to_pylist()
            edges = [0, *(i for i in range(1, len(cls)) if cls[i] != cls[i - 1]), len(cls)]
            yield record({
                "cls": [cls[a] for a in edges[:-1]], "conv_id": [ids[a] for a in edges[:-1]],
                "n": [b - a for a, b in zip(edges, edges[1:])],
                "ids": [",".join(map(str, ids[a:b])) for a, b in zip(edges, edges[1:])],
            }, pieces_schema)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = low = sha = None
        n = 0
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if row["cls"] != key:
                    if key is not None:
                        done.append((key, low, n, sha.hexdigest()))
                    key, low, n, sha = row["cls"], row["conv_id"], 0, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(row["ids"].encode())
                n += row["n"]
            if done:
                yield record(dict(zip(schema.names, zip(*done))), schema)
        if key is not None:
            yield record(dict(zip(schema.names, ([key], [low], [n], [sha.hexdigest()]))), schema)

    by_range = members.repartitionByRange("cls", "conv_id").sortWithinPartitions("cls", "conv_id")
    pieces = by_range.mapInArrow(released(join), piece_ddl)
    return pieces.repartition("cls").sortWithinPartitions("cls", "conv_id").mapInArrow(released(digest), ddl)


def _paths(sequences: DataFrame) -> DataFrame:
    """``conv_id``, the digests of all prefixes as ``path``, the turns' ``points``, and the whole path's digest ``cls``."""
    ddl = "conv_id long, cls binary, path binary, points array<int>"
    schema = to_arrow_schema(sequences.sparkSession.createDataFrame([], ddl).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, last = [], []
            for turns in batch.column("digests").to_pylist():
                prefix, path = ROOT, []
                for turn in turns:
                    prefix = hashlib.blake2b(prefix + turn, digest_size=DIGEST).digest()
                    path.append(prefix)
                paths.append(b"".join(path))
                last.append(prefix)
            yield record({"conv_id": batch.column("conv_id"), "cls": last, "path": paths, "points": batch.column("points")}, schema)

    digests, points = F.transform("turns", lambda t: t["digest"]), F.transform("turns", lambda t: t["points"])
    return sequences.select("conv_id", digests.alias("digests"), points.alias("points")).mapInArrow(released(run), ddl)


def turn_sequences(
    turns: DataFrame, id_col: str = "conv_id", order_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv_id`` and its ``turns`` in order: a 128-bit digest of role and text, and the text's code points.

    Texts stay where they are: 20 bytes of each turn meet. A null turn number
    comes first; turns of one number come in the order of their digests, and
    repeated rows are turns of their own. Null role or text is empty. Rows
    without an id are no conversation's.
    """
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct(
        F.col(order_col).alias("turn"), F.unhex(F.md5(content.cast("binary"))).alias("digest"), F.length(text).alias("points")
    )
    rows = turns.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("conv_id"), turn.alias("t"))
    return rows.groupBy("conv_id").agg(
        F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t["digest"], t["points"])).alias("turns")
    )


def trie(sequences: DataFrame) -> DataFrame:
    """A row for each distinct prefix of the ``turns`` of ``conv_id`` (one row each), the empty one included.

    ``node`` and ``parent`` are digests of the prefixes, null above the root;
    ``conv_id`` is the smallest member and ``parent_conv_id`` the parent's;
    ``n_convs`` counts the members, ``n_children`` the children, ``n_leaves``
    the childless nodes of the subtree, the node included; ``saved_tokens`` sums
    over the subtree each node's members but one times its last turn's points;
    ``ends_sha256`` digests the ids of the members that end at the node. No
    sequences give no rows.
    """
    paths = written(_paths(sequences))
    ends = written(_ends(paths.select("cls", "conv_id")))
    shapes = paths.groupBy("cls").agg(F.first("path").alias("path"), F.first("points").alias("points"))
    items = written(shapes.join(ends, "cls").drop("cls"))
    levels: list[DataFrame] = []
    while not levels or tasks > 1:
        tasks = _tasks(items)
        out = _level(items, tasks, first=not levels)
        levels.append(out.where("node IS NOT NULL").select(*[c.split()[0] for c in NODE_DDL.split(", ")]))
        items = out.where("path IS NOT NULL").select(*[c.split()[0] for c in ITEM_DDL.split(", ")])
    nodes = levels[0]
    for level in levels[1:]:
        nodes = nodes.unionByName(level)
    if len(levels) == 1:
        return nodes
    later = levels[1]
    for level in levels[2:]:
        later = later.unionByName(level)
    open_once = later.select(F.col("node").alias("parent"), F.col("conv_id").alias("found"))
    missing = F.col("parent").isNotNull() & F.col("parent_conv_id").isNull()
    found = left_lookup(nodes.where(missing), open_once, ["parent"]).withColumn("parent_conv_id", F.col("found")).drop("found")
    return nodes.where(~missing).unionByName(found)


def rebuilt(sequences: DataFrame) -> DataFrame:
    """Each conversation with its first turns replaced by those of its hundred's first conversation.

    Of conversation c, c - c % 100 gives as many as crc32(decimal c) % 6 says (all if it has fewer, none if
    it doesn't occur); c's own turns follow from there on.
    """
    sequences = written(sequences)
    heads = sequences.where(F.col("conv_id") % BASE_STEP == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, HEADS - 1).alias("head")
    )
    take = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    own = sequences.withColumn("base", F.col("conv_id") - F.col("conv_id") % BASE_STEP).withColumn("take", take.cast("int"))
    both = left_lookup(own, heads, ["base"])
    head = F.when(F.col("head").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("head", F.lit(1), F.col("take")))
    rest = F.slice("turns", F.col("take") + 1, F.size("turns"))
    return both.select("conv_id", F.concat(head, rest).alias("turns"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """Digest of the prefix trie of all rebuilt conversations; nulls, ties and repeated rows as in ``turn_sequences``."""
    nodes = trie(rebuilt(turn_sequences(conversations)))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


CONVERSATION_TRIE_SQL = """
WITH turns AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
                       ORDER BY turn NULLS FIRST, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS t
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
cut AS (
  SELECT conv_id, t, CAST(conv_id AS VARCHAR) AS name, conv_id - conv_id % 100 AS base FROM turns),
-- crc32 is not a function of every version: it is computed bit by bit
bytes AS (SELECT DISTINCT name, ascii(substr(name, CAST(i AS INT), 1)) AS b, i FROM cut, LATERAL (SELECT unnest(range(1, length(name) + 1)) AS i)),
crc AS (
  SELECT name, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list(CAST(b AS BIGINT) ORDER BY i)),
    lambda c, x: xor(c >> 8, list_reduce(list_prepend(xor(c & 255, x), [0, 0, 0, 0, 0, 0, 0, 0]),
      lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END))), 4294967295) AS crc
  FROM bytes GROUP BY name),
whole AS MATERIALIZED (
  SELECT c.conv_id, list_concat(coalesce(list_slice(b.t, 1, CAST(crc % 6 AS INT)), []),
                                coalesce(list_slice(c.t, CAST(crc % 6 AS INT) + 1, len(c.t)), [])) AS t
  FROM cut c JOIN crc USING (name) LEFT JOIN turns b ON b.conv_id = c.base),
members AS MATERIALIZED (
  SELECT conv_id, d AS depth, md5(to_json(list_slice(t, 1, d))) AS node, len(t) = d AS ends,
    CASE WHEN d = 0 THEN 0 ELSE length(t[d].text) END AS points
  FROM whole, LATERAL (SELECT CAST(unnest(range(0, len(t) + 1)) AS BIGINT) AS d)),
nodes AS MATERIALIZED (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(points) AS points,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ends
  FROM members GROUP BY node, depth),
family AS MATERIALIZED (  -- every node with its ancestors and itself
  SELECT n.node, n.depth, n.n_convs, n.points, m.node AS above, m.depth AS above_depth
  FROM nodes n JOIN members m ON n.conv_id = m.conv_id AND m.depth <= n.depth),
kids AS (SELECT above AS node, count(*) AS n_children FROM family WHERE above_depth = depth - 1 GROUP BY above),
sums AS (
  SELECT above AS node, count(*) FILTER (WHERE k.node IS NULL) AS n_leaves,
    sum(CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * points END) AS saved
  FROM family f LEFT JOIN kids k ON f.node = k.node GROUP BY above),
parents AS (SELECT f.node, n.conv_id FROM family f JOIN nodes n ON f.above = n.node WHERE f.above_depth = f.depth - 1)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, s.n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN sums s ON n.node = s.node LEFT JOIN kids k ON n.node = k.node LEFT JOIN parents u ON n.node = u.node
"""
