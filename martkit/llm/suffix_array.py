"""Suffix array with common-prefix lengths by induced sorting, in batches of tuples.

Positions before which the text rises again (S*) are sorted by the names of the
pieces between them, recursively on ever longer runs of names. All other
suffixes are induced: a scan over the sorted ones puts (position, common
prefix) tuples into the queue of the character before each, first for the
suffixes that are larger than their successor, then, backwards, for the smaller
ones. A queue's tuples leave it in the order in which they came, so that a
queue for each character is a priority queue; beyond a bound on memory the
queues are kept on disk. Order and lengths hold up to ``depth`` characters:
suffixes that agree so far stand together in any order.
"""

from __future__ import annotations

import tempfile

import numpy as np

QUEUE_BYTES = 32 << 20
JUMP = 64


class Queues:
    """A queue of (position, common prefix) tuples for each character, on disk beyond a bound."""

    def __init__(self, limit: int = QUEUE_BYTES) -> None:
        self.parts: list[list] = [[] for _ in range(256)]
        self.held, self.limit, self.file = 0, limit, None

    def put(self, c: int, pos: np.ndarray, lcp: np.ndarray) -> None:
        size = pos.nbytes + lcp.nbytes
        if self.held + size <= self.limit:
            self.held += size
            self.parts[c].append((pos, lcp))
            return
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        at = self.file.seek(0, 2)
        self.file.write(pos.tobytes() + lcp.tobytes())
        self.parts[c].append((at, len(pos)))

    def take(self, c: int) -> tuple[np.ndarray, np.ndarray]:
        """All tuples of the queue, which is empty then."""
        pairs = [self._read(*p) if isinstance(p[0], int) else p for p in self.parts[c]]
        self.held -= sum(p[0].nbytes + p[1].nbytes for p in self.parts[c] if not isinstance(p[0], int))
        self.parts[c] = []
        if len(pairs) == 1:
            return pairs[0]
        none = np.zeros(0, np.int32), np.zeros(0, np.uint16)
        return tuple(np.concatenate(x) for x in zip(*pairs)) if pairs else none

    def _read(self, at: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        self.file.seek(at)
        raw = self.file.read(6 * n)
        return np.frombuffer(raw, np.int32, n), np.frombuffer(raw, np.uint16, n, 4 * n)


def _rising(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the end counts as the smallest character."""
    n = len(text)
    last = np.full(n, n - 1, np.int64)
    change = np.flatnonzero(text[1:] != text[:-1])
    last[change] = change
    last = np.minimum.accumulate(last[::-1])[::-1]
    after = np.append(text, 0)[last + 1]
    return (text[last] < after) & (last < n - 1)


def _refined(rank: np.ndarray, active: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Split the groups of equal rank by a further key; returns those still in a group of several."""
    both = (rank[active].astype(np.uint64) << np.uint64(32)) | key.astype(np.uint64)
    order = np.argsort(both, kind="stable")
    active, both = active[order], both[order]
    high = both >> np.uint64(32)
    places = np.arange(len(active))
    new_rank = np.concatenate([[True], high[1:] != high[:-1]])
    new_group = np.concatenate([[True], both[1:] != both[:-1]])
    group_at = np.maximum.accumulate(np.where(new_group, places, 0))
    rank_at = np.maximum.accumulate(np.where(new_rank, places, 0))
    rank[active] = rank[active] + (group_at - rank_at).astype(rank.dtype)
    alone = new_group & np.append(new_group[1:], True)
    return active[~alone]


def _star_ranks(text: np.ndarray, rising: np.ndarray, stars: np.ndarray, depth: int) -> np.ndarray:
    """Rank of each S* suffix: names of the pieces up to the next S*, then of runs of 2, 4, ... names."""
    n, m = len(text), len(stars)
    rank = np.zeros(m, np.int64)
    if not m:
        return rank
    symbols = np.append(text.astype(np.uint64) * np.uint64(2) + rising + np.uint64(1), np.zeros(8, np.uint64))
    ends = np.append(stars[1:], n)
    lengths = ends - stars
    active = np.arange(m)
    column = 0
    while len(active):  # three symbols of 10 bits at a time
        key = np.zeros(len(active), np.uint64)
        for j in range(column, column + 3):
            inside = lengths[active] >= j
            at = np.minimum(stars[active] + j, n)
            key = (key << np.uint64(10)) | np.where(inside, symbols[at], np.uint64(0))
        active = _refined(rank, active, key)
        column += 3
        done = active[lengths[active] < column]
        active = active[lengths[active] >= column]
        if column == 3:
            equal = done
        else:
            equal = np.concatenate([equal, done])
    active, step = equal, 1
    while len(active) and step * 2 < depth:  # each name is of two characters at least
        key = np.where(active + step < m, rank[np.minimum(active + step, m - 1)] + 1, 0)
        active = _refined(rank, active, key)
        step *= 2
    return rank


def _jumps(words: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the JUMP bytes from each place, made of the eight bytes from it and those that follow."""
    out, width = words, 8
    while width < JUMP:
        later = np.append(out[width:], np.zeros(min(width, len(out)), np.uint64))
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + (later ^ (later >> np.uint64(31))) * np.uint64(
            0xBF58476D1CE4E5B9
        )
        width *= 2
    return out


def _common(words: np.ndarray, jumps: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Common prefixes of the suffixes at a and b, at most depth; words[i] holds the eight bytes from i.

    Stretches of JUMP bytes are compared by their hash, the rest by its bytes.
    """
    out = np.zeros(len(a), np.int64)
    n = len(words)
    live = np.arange(len(a))
    for _ in range(depth // JUMP):
        x, y = a[live] + out[live], b[live] + out[live]
        inside = (x <= n - JUMP) & (y <= n - JUMP)
        live, x, y = live[inside], x[inside], y[inside]
        live = live[jumps[x] == jumps[y]]
        out[live] += JUMP
        if not len(live):
            break
    live = np.flatnonzero(out < depth)
    while len(live):
        x, y = a[live] + out[live], b[live] + out[live]
        inside = (x < n) & (y < n)
        live, x, y = live[inside], x[inside], y[inside]
        diff = words[x] ^ words[y]
        equal = diff == 0
        low = diff[~equal]
        out[live[~equal]] += (np.log2((low & (~low + np.uint64(1))).astype(np.float64)).astype(np.int64)) >> 3
        out[live[equal]] += 8
        live = live[equal]
        live = live[out[live] < depth]
    return np.minimum(out, depth)


class _Minima:
    """Minimum of any run of an array."""

    def __init__(self, values: np.ndarray) -> None:
        self.levels = [values]
        while len(self.levels[-1]) > (step := 1 << (len(self.levels) - 1)):
            top = self.levels[-1]
            self.levels.append(np.minimum(top[:-step], top[step:]))

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minima of the runs from first to last, both included."""
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        out = np.empty(len(first), self.levels[0].dtype)
        for k in range(int(level.max()) + 1 if len(level) else 0):
            here = np.flatnonzero(level == k)
            top = self.levels[k]
            out[here] = np.minimum(top[first[here]], top[last[here] - (1 << k) + 1])
        return out


class _Scan:
    """One direction of the induction: sources in order, their predecessors into queues."""

    def __init__(self, text: np.ndarray, wanted: np.ndarray, depth: int, limit: int) -> None:
        self.text, self.wanted, self.depth = text, wanted, depth
        self.queues = Queues(limit)
        self.filled = np.zeros(256, bool)
        self.pending = np.zeros(256, np.int64)
        self.seen = np.zeros(256, bool)

    def start_bucket(self) -> None:
        self.seen[:] = False

    def put(self, pos: np.ndarray, lcp: np.ndarray) -> None:
        """Induce from sources that start with one character; lcp is that with the source before."""
        if not len(pos):
            return
        lcp = lcp.astype(np.int64)
        before = np.maximum(pos - 1, 0)
        picked = np.flatnonzero((pos > 0) & self.wanted[before])
        minima = _Minima(lcp)
        lowest = int(lcp.min())
        touched = np.zeros(256, bool)
        if len(picked):
            chars = self.text[before[picked]]
            order = np.argsort(chars, kind="stable")
            picked, chars = picked[order], chars[order]
            starts = bounds = np.flatnonzero(np.concatenate([[True], chars[1:] != chars[:-1]]))
            first = np.empty(len(picked), np.int64)
            first[1:] = picked[:-1] + 1
            first[starts] = 0
            common = 1 + minima.of(first, picked)
            heads = chars[starts]
            joined = np.minimum(common[starts], 1 + self.pending[heads])
            common[starts] = np.where(self.seen[heads], joined, np.where(self.filled[heads], 1, 0))
            common = np.minimum(common, self.depth).astype(np.uint16)
            places = (pos[picked] - 1).astype(np.int32)
            ends = np.append(bounds[1:], len(picked))
            lasts = picked[ends - 1]
            rest = lasts + 1 < len(lcp)
            tail = np.full(len(lasts), self.depth, np.int64)
            tail[rest] = minima.of(lasts[rest] + 1, np.full(int(rest.sum()), len(lcp) - 1))
            for c, a, b in zip(heads.tolist(), starts.tolist(), ends.tolist()):
                self.queues.put(c, places[a:b], common[a:b])
            touched[heads] = True
            self.pending[heads] = tail
            self.filled[heads] = True
        old = self.seen & ~touched
        self.pending[old] = np.minimum(self.pending[old], lowest)
        self.seen |= touched

    def bucket(self, c: int) -> tuple[np.ndarray, np.ndarray]:
        """Take a character's tuples until its own predecessors add none; they are sources at once."""
        parts = []
        while True:
            pos, lcp = self.queues.take(c)
            if not len(pos):
                break
            parts.append((pos, lcp))
            self.put(pos, lcp)
        if not parts:
            return np.zeros(0, np.int32), np.zeros(0, np.uint16)
        return tuple(np.concatenate(x) for x in zip(*parts))


def suffix_array(text: np.ndarray, depth: int, limit: int = QUEUE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the suffixes of a byte array in order, and each one's common prefix with the one before.

    Both up to ``depth`` characters. An empty text has none.
    """
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int32), np.zeros(0, np.uint16)
    rising = _rising(text)
    stars = np.flatnonzero(rising[1:] & ~rising[:-1]) + 1
    rank = _star_ranks(text, rising, stars, depth)
    order = np.argsort(rank, kind="stable")
    stars, rank = stars[order], rank[order]
    padded = np.append(text, np.zeros(8, np.uint8))
    words = np.lib.stride_tricks.as_strided(padded.view(np.uint8), (n, 8), (1, 1)).copy().view("<u8").reshape(n)
    jumps = _jumps(words)
    star_lcp = np.zeros(len(stars), np.int64)
    star_lcp[1:] = depth  # of equal rank: as long as the names that were compared
    told = np.flatnonzero(rank[1:] != rank[:-1])
    a, b = stars[told], stars[told + 1]
    # beyond the text the words hold zeros: cut at its end
    star_lcp[told + 1] = np.minimum(_common(words, jumps, a, b, depth), n - np.maximum(a, b))
    star_at = np.searchsorted(text[stars], np.arange(257))

    def border(a: int, b: int) -> int:
        one = _common(words, jumps, np.array([a]), np.array([b]), depth)
        return int(min(one[0], n - max(a, b)))

    down = _Scan(text, ~rising, depth, limit)
    down.queues.put(int(text[-1]), np.array([n - 1], np.int32), np.zeros(1, np.uint16))
    down.filled[text[-1]] = True
    falling = []
    for c in range(256):
        down.start_bucket()
        pos, lcp = down.bucket(c)
        falling.append((pos, lcp))
        own = stars[star_at[c] : star_at[c + 1]].astype(np.int32)
        if len(own):
            common = star_lcp[star_at[c] : star_at[c + 1]].copy()
            common[0] = border(int(pos[-1]), int(own[0])) if len(pos) else 0
            down.put(own, common)
    up = _Scan(text, rising, depth, limit)
    out = []
    for c in range(255, -1, -1):
        up.start_bucket()
        pos, lcp = up.bucket(c)
        low_pos, low_lcp = falling[c]
        edge = border(int(pos[-1]), int(low_pos[-1])) if len(pos) and len(low_pos) else 0
        if len(low_pos):
            up.put(low_pos[::-1], np.concatenate([[edge], low_lcp[:0:-1]]).astype(np.int64))
        rise = np.concatenate([[edge], lcp[:0:-1]])[: len(pos)].astype(np.uint16)
        out.append((np.concatenate([low_pos, pos[::-1]]), np.concatenate([low_lcp, rise])))
    out.reverse()
    return tuple(np.concatenate(x) for x in zip(*out))
