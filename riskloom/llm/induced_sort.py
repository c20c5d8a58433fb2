"""External induced sorting of suffixes with their common-prefix lengths, bounded by a depth.

Suffixes are L (greater than their successor) or S; the leftmost S suffixes of each run (LMS) are named by the stretch up to the
next one.  Where names repeat, the string of names is sorted by the same induction, recursively, and in memory once
it is short.  From the sorted LMS suffixes all L suffixes are induced in ascending order and then all S suffixes in
descending order: a priority queue hands out suffix tuples (position, common prefix with the one before), smallest symbol
first, and each tuple pushes its predecessor with one more than the least common prefix of all tuples taken since one was last pushed
under that symbol.  What is pushed under one symbol leaves in order of arrival, so the queue is a tape per symbol; strings of
names have too many symbols for that, so a tape there holds a range of them, which is put in order when it is its turn.

Memory: tapes keep ``queue`` tuples and go on in a scratch file; flat arrays (text, types, runs, LMS positions, names) of more
than ``FLAT`` entries are mapped to scratch files; names are sorted in buckets of ``memory``, and blocks of ``queue`` are handled at
a time.  Scratch files have no name and go with the task.  Prefix lengths are cut off at ``depth``; suffixes alike so far come in any order.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import numpy as np

#: LMS names that are sorted at once in memory, tuples of a tape that are held there, and entries of an array that isn't mapped to a file.
MEMORY_NAMES, MEMORY_QUEUE, FLAT = 1 << 17, 1 << 17, 1 << 23
Block = tuple[np.ndarray, ...]


class Queue:
    """Blocks of columns in order of arrival under each symbol; beyond the limit they wait in a nameless scratch file."""

    def __init__(self, limit: int = MEMORY_QUEUE, kinds: tuple[str, ...] = ("<i8", "<i2")):
        self.limit, self.kinds, self.size, self.file = limit, kinds, 0, None
        self.held: dict[int, list[Block]] = {}
        self.stored: dict[int, list[tuple[int, int]]] = {}

    def push(self, symbol: int, *columns: np.ndarray) -> None:
        if len(columns[0]):
            self.held.setdefault(symbol, []).append(columns)
            self.size += len(columns[0])
            if self.size > self.limit:
                self.spill()

    def spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        for symbol, parts in self.held.items():
            at = self.file.seek(0, 2)
            for column, kind in zip(zip(*parts, strict=True), self.kinds, strict=True):
                self.file.write(np.concatenate(column).astype(kind).tobytes())
            self.stored.setdefault(symbol, []).append((at, sum(len(p[0]) for p in parts)))
        self.held.clear()
        self.size = 0

    def read(self, at: int, n: int) -> Block:
        self.file.seek(at)
        return tuple(np.frombuffer(self.file.read(n * np.dtype(k).itemsize), dtype=k) for k in self.kinds)

    def __contains__(self, symbol: int) -> bool:
        return symbol in self.held or symbol in self.stored

    def drain(self, symbol: int) -> Iterator[Block]:
        """Takes out all blocks under a symbol, those that arrive meanwhile as well."""
        while symbol in self:
            stored, held = self.stored.pop(symbol, []), self.held.pop(symbol, [])
            self.size -= sum(len(p[0]) for p in held)
            for at, n in stored:
                yield self.read(at, n)
            if held:
                yield tuple(np.concatenate(c) for c in zip(*held, strict=True))

    def pop(self, symbol: int) -> list[Block]:
        return list(self.drain(symbol))

    def kept(self, symbol: int, backwards: bool = False) -> Iterator[Block]:
        """The blocks under a symbol, which stay there; from the last to the first with ``backwards``."""
        held = [tuple(np.concatenate(c) for c in zip(*self.held[symbol], strict=True))] if symbol in self.held else []
        parts = [*self.stored.get(symbol, []), *held]
        for p in parts[::-1] if backwards else parts:
            yield self.read(*p) if isinstance(p[0], int) else p


def room(n: int, kind) -> np.ndarray:
    """An array of n entries, in memory or in a nameless scratch file."""
    if n <= FLAT:
        return np.empty(n, dtype=kind)
    with tempfile.TemporaryFile() as f:
        return np.memmap(f, dtype=kind, mode="w+", shape=(n,))


def index_kind(n: int):
    return np.int32 if n < 1 << 31 else np.int64


def types(s: np.ndarray, depth: int, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Which suffixes are less than their successor (the last is), and how often each symbol is repeated, cut off at the depth."""
    is_s, run = room(len(s), np.bool_), room(len(s), np.int16)
    after = None
    for z in range(len(s), 0, -block):
        a = max(0, z - block)
        x = np.asarray(s[a:z])
        k = len(x)
        step, up = np.ones(k, dtype=bool), np.ones(k, dtype=bool)
        np.not_equal(x[1:], x[:-1], out=step[:-1])
        np.greater(x[1:], x[:-1], out=up[:-1])
        if after is not None:
            step[-1], up[-1] = x[-1] != after[0], x[-1] < after[0]
        at = np.arange(k)
        nearest = np.minimum.accumulate(np.where(step, at, k)[::-1])[::-1]  # the next place where the symbol changes
        inside = nearest < k
        nearest = np.minimum(nearest, k - 1)
        kind, size = up[nearest], nearest - at + 1
        if not inside.all():
            kind[~inside] = after[1]
            size[~inside] += after[2]
        is_s[a:z], run[a:z] = kind, np.minimum(size, depth)
        after = (x[0], kind[0], int(run[a]))
    return is_s, run


def lms_positions(is_s: np.ndarray, block: int) -> np.ndarray:
    n = len(is_s)
    each = lambda: (np.nonzero(is_s[a + 1 : a + block + 1] & ~is_s[a : min(a + block, n - 1)])[0] + a + 1 for a in range(0, n - 1, block))
    out, at = room(sum(map(len, each())), index_kind(n)), 0
    for x in each():
        out[at : at + len(x)] = x
        at += len(x)
    return out


def refined(rank: np.ndarray, rows: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Sort ``rows`` of equal rank by ``key``; returns those that remain tied.  Ranks are places in the order."""
    order = np.lexsort((key, rank[rows]))
    rows, key = rows[order], key[order]
    old = rank[rows]
    start = np.ones(len(rows), dtype=bool)
    start[1:] = old[1:] != old[:-1]
    at = np.arange(len(rows))
    group = np.maximum.accumulate(np.where(start, at, 0))
    new = start.copy()
    new[1:] |= key[1:] != key[:-1]
    first = np.maximum.accumulate(np.where(new, at, 0))
    rank[rows] = old + first - group
    end = np.append(new[1:], True)
    return rows[~(new & end)]


def named(s: np.ndarray, is_s: np.ndarray, lms: np.ndarray, depth: int, memory: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """LMS numbers in the order of their names, in blocks, and which of them has another name than the one before.

    A name is the symbols with their types up to the next LMS position, or to the depth; none is another's beginning.  More
    than ``memory`` of them are dealt to buckets by their first symbols, and buckets of one beginning by the next ones.
    """
    last = len(s) - 1
    bits = int(2 * int(s.max()) + 1).bit_length()
    each = max(1, 62 // bits)

    def word(rows: np.ndarray, done: int) -> np.ndarray:
        begin = lms[rows].astype(np.int64)
        end = np.where(rows + 1 < len(lms), lms[np.minimum(rows + 1, len(lms) - 1)], last)
        out = np.zeros(len(rows), dtype=np.int64)
        for t in range(done, done + each):
            at = begin + t
            inside = at <= end
            at = np.minimum(at, last)
            out = (out << bits) | np.where(inside, 2 * s[at].astype(np.int64) + is_s[at], 0)
        return out

    def over(rows: np.ndarray, done: int) -> np.ndarray:
        end = np.where(rows + 1 < len(lms), lms[np.minimum(rows + 1, len(lms) - 1)], last)
        return lms[rows] + done > end

    def in_memory(rows: np.ndarray, done: int) -> tuple[np.ndarray, np.ndarray]:
        rank, live = np.zeros(len(rows), dtype=np.int64), np.arange(len(rows))
        while len(live) and done < depth:
            live = refined(rank, live, word(rows[live], done))
            done += each
            live = live[~over(rows[live], done)] if len(live) else live
        order = np.argsort(rank, kind="stable")
        new = np.ones(len(rows), dtype=bool)
        new[1:] = rank[order][1:] != rank[order][:-1]
        return rows[order], new

    def work(blocks: Callable[[], Iterator[np.ndarray]], size: int, done: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if size <= memory:
            yield in_memory(np.concatenate(list(blocks())), done)
            return
        step = max(1, size // 4096)
        some = np.unique(np.concatenate([word(b[::step], done) for b in blocks()]))
        some = some[:: max(1, len(some) // min(256, 1 + 2 * size // memory))]
        edges = np.unique(np.concatenate([some, some + 1]))
        dealt, sizes = Queue(MEMORY_QUEUE, ("<i8",)), np.zeros(len(edges) + 1, dtype=np.int64)
        for rows in blocks():
            to = np.searchsorted(edges, word(rows, done), "right")
            order = np.argsort(to, kind="stable")
            cut = np.searchsorted(to[order], np.arange(len(edges) + 2))
            for k in np.nonzero(np.diff(cut))[0].tolist():
                dealt.push(k, rows[order[cut[k] : cut[k + 1]]])
            sizes += np.diff(cut)
        for k in np.nonzero(sizes)[0].tolist():
            own = lambda k=k: (b[0] for b in dealt.kept(k))
            alike = 0 < k < len(edges) and edges[k] == edges[k - 1] + 1  # all have the word edges[k - 1]
            if alike and (done + each >= depth or over(next(own())[:1], done + each)[0]):
                for i, rows in enumerate(own()):
                    yield rows, np.append(i == 0, np.zeros(len(rows) - 1, dtype=bool))
            else:
                yield from work(own, int(sizes[k]), done + each if alike else done)

    m, block = len(lms), max(memory, 1024)
    if m:
        yield from work(lambda: (np.arange(a, min(a + block, m)) for a in range(0, m, block)), m, 0)


def sorted_lms(s: np.ndarray, is_s: np.ndarray, lms: np.ndarray, depth: int, memory: int) -> np.ndarray:
    """LMS positions in the order of their suffixes, to the depth."""
    m = len(lms)
    order, rank = room(m, index_kind(m)), room(m, index_kind(m))
    at, place, ties = 0, 0, False
    for rows, new in named(s, is_s, lms, depth, memory):
        places = np.maximum.accumulate(np.where(new, np.arange(at, at + len(rows)), place))
        order[at : at + len(rows)] = rows
        rank[rows] = places
        at, place, ties = at + len(rows), int(places[-1]), ties or not new.all()
    if ties and m > memory:
        order = induced_order(rank, depth // 2 + 1, memory)  # a name spans two symbols at least
    elif ties:
        # In memory: ranks of pairs, fours, eights ... of names, until the depth is covered.
        rank, pos = rank.astype(np.int64), lms.astype(np.int64)
        many = np.bincount(rank, minlength=m)
        rows, step = np.nonzero(many[rank] > 1)[0], 1
        while len(rows):
            rows = rows[pos[np.minimum(rows + step, m - 1)] - pos[rows] < depth]
            after = np.where(rows + step < m, rank[np.minimum(rows + step, m - 1)] + 1, 0)
            rows = refined(rank, rows, after) if len(rows) else rows
            step *= 2
        order = np.argsort(rank, kind="stable")
    out = room(m, lms.dtype)
    for a in range(0, m, FLAT):
        out[a : a + FLAT] = lms[order[a : a + FLAT]]
    return out


def induced(s: np.ndarray, wanted: np.ndarray, seeds: Callable[[int], np.ndarray], ranges: Iterator[int], down: bool, depth: int, memory: int) -> Queue:
    """Order of the ``wanted`` suffixes under each range of ``memory`` symbols, from that of the seeds, by ranges.

    Within a range, suffixes come by symbol; those pushed from ranges before it come first, then those that the range itself
    induces, in the order of their inducers, then the seeds.
    """
    queue, out = Queue(MEMORY_QUEUE, ("<i8",)), Queue(MEMORY_QUEUE, ("<i8",))
    for r in ranges:
        early, late = [b[0] for b in queue.drain(r)], seeds(r)
        pos = np.concatenate([*early, late]).astype(np.int64)
        if not len(pos):
            continue
        n0 = len(pos) - len(late)
        kind, key = np.where(np.arange(len(pos)) < n0, 0, 2).astype(np.int8), np.arange(len(pos))
        nodes, kinds, keys, now, total, levels = [pos], [kind], [key], np.arange(len(pos)), len(pos), 0
        current = pos
        while len(now):
            before = current - 1
            ok = (current > 0) & wanted[np.maximum(before, 0)]
            ok[ok] = s[before[ok]] // memory == r
            now, current = now[ok], before[ok]
            if len(now):
                nodes.append(current)
                kinds.append(np.ones(len(now), dtype=np.int8))
                keys.append(now)  # the inducer's number, for the time being
                now = np.arange(total, total + len(now))
                total, levels = total + len(now), levels + 1
        pos, kind, link = np.concatenate(nodes), np.concatenate(kinds), np.concatenate(keys)
        symbol = s[pos].astype(np.int64)
        symbol = symbol - symbol.min() if down else symbol.max() - symbol  # below ``memory``
        # What the range itself induces ties at first, symbol by symbol; only what is still tied is looked at again, by its inducers' places.
        key = ((3 * symbol + kind) << 40) + np.where(kind == 1, 0, link)
        order = np.argsort(key)
        first = np.append(True, key[order][1:] != key[order][:-1])
        rank = np.empty(total, dtype=np.int64)
        rank[order] = np.maximum.accumulate(np.where(first, np.arange(total), 0))
        live = np.sort(order[~(first & np.append(first[1:], True))])
        for _ in range(min(levels, depth)):
            if not len(live):
                break
            live = refined(rank, live, rank[link[live]])
        order = np.argsort(rank, kind="stable")
        pos, kind = pos[order], kind[order]
        out.push(r, pos[kind < 2])
        before = pos[pos > 0] - 1
        before = before[wanted[before]]
        to = s[before] // memory
        before, to = before[to != r], to[to != r]
        order = np.argsort(to, kind="stable")
        cut = np.nonzero(np.append(True, to[order][1:] != to[order][:-1]))[0].tolist() if len(to) else []
        for a, z in zip(cut, [*cut[1:], len(to)], strict=False):
            queue.push(int(to[order[a]]), before[order[a:z]])
    return out


def induced_order(names: np.ndarray, depth: int, memory: int) -> np.ndarray:
    """Suffix order of a string of names, each the place of its first equal one, so that a range of places has about as many suffixes."""
    n = len(names)
    s = room(n + 1, index_kind(n + 2))
    for a in range(0, n, FLAT):
        s[a : min(a + FLAT, n)] = names[a : a + FLAT] + 1
    s[n] = 0
    is_s, _ = types(s, depth, max(memory, 1024))
    lms = lms_positions(is_s, max(memory, 1024))
    first = sorted_lms(s, is_s, lms, depth, memory)
    width = n // memory + 2
    sizes = np.zeros(width, dtype=np.int64)
    for a in range(0, len(first), FLAT):
        sizes += np.bincount(s[first[a : a + FLAT]] // memory, minlength=width)
    edge = np.append(0, np.cumsum(sizes))
    not_s = ~is_s
    large = induced(s, not_s, lambda r: first[edge[r] : edge[r + 1]], iter(range(width)), True, depth, memory)
    falling = lambda r: np.concatenate([np.zeros(0, np.int64), *[b[0][::-1] for b in large.kept(r, backwards=True)]])
    small = induced(s, is_s, falling, iter(range(width - 1, -1, -1)), False, depth, memory)
    out, at = room(n, index_kind(n)), 0
    for r in range(width):
        pos = np.concatenate([np.zeros(0, np.int64), *[b[0] for b in large.kept(r)], *[b[0][::-1] for b in small.kept(r, backwards=True)]])
        pos = pos[np.argsort(s[pos], kind="stable")]
        out[at : at + len(pos)] = pos
        at += len(pos)
    return out


def direct_lcp(s: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Common prefixes of neighbours, symbol by symbol."""
    lcp = np.zeros(len(order), dtype=np.int16)
    rows, t, last = np.arange(1, len(order)), 0, len(s) - 1
    while len(rows) and t < depth:
        a, b = order[rows - 1] + t, order[rows] + t
        rows = rows[(np.maximum(a, b) <= last) & (s[np.minimum(a, last)] == s[np.minimum(b, last)])]
        t += 1
        lcp[rows] = t
    return lcp


class RangeMinimum:
    """Minima of ranges from those of powers of two, a row of the table each."""

    def __init__(self, g: np.ndarray):
        self.n = len(g)
        self.table = np.empty((max(1, self.n.bit_length()), self.n), dtype=g.dtype)
        self.table[0] = g
        for k in range(1, len(self.table)):
            half, size = 1 << (k - 1), self.n - (1 << k) + 1
            np.minimum(self.table[k - 1, :size], self.table[k - 1, half : half + size], out=self.table[k, :size])

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Least of g[a..b], a <= b."""
        k = np.frexp((b - a + 1).astype(np.float64))[1].astype(np.int64) - 1
        row, flat = k * self.n, self.table.reshape(-1)
        return np.minimum(flat[row + a], flat[row + b - (np.int64(1) << k) + 1])


class Induction:
    """One pass: takes suffixes in order, with their common prefixes, and queues their predecessors of the wanted type."""

    def __init__(self, s: np.ndarray, is_s: np.ndarray, wanted: bool, depth: int, limit: int, top: int):
        self.s, self.is_s, self.wanted, self.depth = s, is_s, wanted, depth
        self.queue = Queue(limit, (np.dtype(index_kind(len(s))).str, "<i2"))
        #: Least common prefix since a symbol was last pushed; -1: never.
        self.since = np.full(top + 1, -1, dtype=np.int16)

    def take(self, pos: np.ndarray, g: np.ndarray) -> None:
        at = np.nonzero((pos > 0) & (self.is_s[pos - 1] == self.wanted))[0]
        if not len(at):
            np.minimum(self.since, g.min(), out=self.since)
            return
        x = self.s[pos[at] - 1]
        order = np.argsort(x, kind="stable")
        x, at = x[order], at[order]
        first = np.ones(len(x), dtype=bool)
        first[1:] = x[1:] != x[:-1]
        begin = np.zeros(len(x), dtype=np.int64)
        begin[1:] = at[:-1] + 1
        begin[first] = 0
        least = RangeMinimum(g)
        shared = least.of(begin, at)
        heads = np.nonzero(first)[0]
        symbols = x[heads]
        shared[heads] = np.minimum(shared[heads], self.since[symbols])
        lcp = np.minimum(shared + 1, self.depth).astype(np.int16)
        np.minimum(self.since, g.min(), out=self.since)
        tails = np.append(heads[1:], len(x)) - 1
        later = at[tails] + 1
        rest = later < len(g)
        self.since[symbols] = self.depth
        if rest.any():
            self.since[symbols[rest]] = least.of(later[rest], np.full(int(rest.sum()), len(g) - 1))
        before = pos[at] - 1
        for sym, a, b in zip(symbols.tolist(), heads.tolist(), (tails + 1).tolist(), strict=True):
            self.queue.push(sym, before[a:b], lcp[a:b])


def sorted_blocks(s: np.ndarray, depth: int, memory: int = MEMORY_NAMES, queue: int = MEMORY_QUEUE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Suffixes of ``s`` in ascending order with each one's common prefix with the one before, in blocks.

    ``s`` has positive symbols of a small alphabet and ends with a 0, whose own suffix is left out.
    """
    block = max(queue, 1024)
    is_s, run = types(s, depth, block)
    order = sorted_lms(s, is_s, lms_positions(is_s, block), depth, memory)
    counts = sum((np.bincount(s[a : a + block], minlength=int(s.max()) + 1) for a in range(0, len(s), block)), np.zeros(1, np.int64))
    lms_counts = sum((np.bincount(s[order[a : a + block]], minlength=len(counts)) for a in range(0, len(order), block)), np.zeros(len(counts), np.int64))
    symbols, bounds = np.nonzero(counts)[0].tolist(), np.append(0, np.cumsum(lms_counts)).tolist()
    kinds = (np.dtype(index_kind(len(s))).str, "<i2")

    def lms_of(c: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for a in range(bounds[c], bounds[c + 1], block):
            own = np.asarray(order[max(0, a - 1) : min(a + block, bounds[c + 1])])
            yield own[a > 0 :], direct_lcp(s, own, depth)[a > 0 :]

    # Ascending: L suffixes, from those before them and from the LMS suffixes that close a symbol's share.
    down, large = Induction(s, is_s, False, depth, queue, len(counts)), Queue(queue, kinds)
    for c in symbols:
        last = None
        for pos, lcp in down.queue.drain(c):
            large.push(c, pos, lcp)
            down.take(pos, lcp)
            last = pos[-1]
        for i, (pos, g) in enumerate(lms_of(c)):
            if i == 0:
                g[0] = min(run[last], run[pos[0]]) if last is not None else 0
            down.take(pos, g)
    # Descending: S suffixes, from those after them.
    up, small = Induction(s, is_s, True, depth, queue, len(counts)), Queue(queue, kinds)
    for c in symbols[::-1]:
        last = None
        for pos, lcp in up.queue.drain(c):
            small.push(c, pos, lcp)
            up.take(pos, lcp)
            last = pos[-1]
        carry = None
        for pos, lcp in large.kept(c, backwards=True):
            if carry is None:
                carry = min(run[last], run[pos[-1]]) if last is not None else 0
            up.take(pos[::-1], np.append(np.int16(carry), lcp[:0:-1]).astype(np.int16))
            carry = lcp[0]
    for c in symbols:
        last = None
        for pos, lcp in large.kept(c):
            yield pos, lcp
            last = pos[-1]
        carry = None
        for pos, lcp in small.kept(c, backwards=True):
            if carry is None:
                carry = min(run[last], run[pos[-1]]) if last is not None else 0
            yield pos[::-1], np.append(np.int16(carry), lcp[:0:-1]).astype(np.int16)
            carry = lcp[0]


def sort_suffixes(text: np.ndarray, depth: int, memory: int = MEMORY_NAMES, queue: int = MEMORY_QUEUE) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of a string of non-negative integers and, cut off at ``depth``, each suffix's common prefix with the one before."""
    if not len(text):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int16)
    s = np.append(text.astype(np.int64) + 1, 0)
    found = list(sorted_blocks(s.astype(np.uint16) if int(s.max()) < 1 << 16 else s, depth, memory, queue))
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])
