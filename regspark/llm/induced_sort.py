"""Suffix sorting by external induction, with common-prefix values, for one shard.

The suffixes that start a rising run right after a falling one are sorted first
(by their substrings, and by recursion on the names of these where they repeat,
down to a string of names that fits in memory); every other suffix is induced
from the suffix one place to its right. What is induced waits as a tuple (symbol, position, common prefix) in a priority queue
that hands tuples out by symbol and, within one, in the order of arrival. Tuples
beyond a budget lie on disk. The common prefix of two suffixes induced into the
same symbol is one more than the smallest common prefix between their inducers,
so it travels with the tuples through every level.

Symbols only grow (or shrink) while a pass runs, so the queue is a two-level
radix structure and all steps work on whole numpy blocks. Arrays beyond the
budget are memory maps. All files are unlinked when they are opened, like a
sort's own spill: nothing outlives the task or is read by another one.
"""

from __future__ import annotations

import tempfile
from collections import defaultdict, deque

import numpy as np

BLOCK = 1 << 16
LEAF = 1024  # tuples that a leaf of the queue should hold
SAME = 20_000  # common prefix of equal substrings while they are named; real values stay below
NONE = np.iinfo(np.int64).max


class Scratch:
    """Arrays in memory up to a budget each, memory maps of unlinked files beyond."""

    def __init__(self, budget: int):
        self.budget = budget

    def array(self, n: int, dtype) -> np.ndarray:
        if n * np.dtype(dtype).itemsize <= self.budget:
            return np.zeros(n, dtype)
        file = tempfile.TemporaryFile()
        file.truncate(n * np.dtype(dtype).itemsize)
        return np.memmap(file, dtype, "r+", shape=(n,))


KEY, POS, LCP = np.int64, np.int64, np.uint16
TUPLE = 18  # bytes of one (key, pos, lcp)


class Tuples:
    """Rows of (key, pos, lcp), one array each."""

    __slots__ = ("key", "pos", "lcp")

    def __init__(self, key, pos, lcp):
        self.key, self.pos, self.lcp = key, pos, lcp

    def __len__(self) -> int:
        return len(self.key)

    def __getitem__(self, at) -> "Tuples":
        return Tuples(self.key[at], self.pos[at], self.lcp[at])

    @staticmethod
    def joined(parts: "list[Tuples]") -> "Tuples":
        if len(parts) == 1:
            return parts[0]
        return Tuples(*(np.concatenate([getattr(p, c) for p in parts]) for c in ("key", "pos", "lcp")))

    def by_key(self) -> "Tuples":
        return self[np.argsort(self.key, kind="stable")]

    def parts(self, width: int):
        """Split by key // width, in order of arrival."""
        if not len(self):
            return
        bucket = self.key // width if width > 1 else self.key
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        rows = self[order]
        cuts = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(order)]
        for a, b in zip(cuts, cuts[1:]):
            yield int(bucket[a]), rows[a:b]


EMPTY = Tuples(np.zeros(0, KEY), np.zeros(0, POS), np.zeros(0, LCP))


class SymbolQueue:
    """Priority queue of (key, pos, lcp): smallest key first, first come first served within a key.

    Keys pushed are never below the smallest key inside. Top buckets hold key
    ranges, on disk beyond the budget; the current one is dealt to leaves, the
    current leaf is sorted. With many tuples a key every top bucket is a single
    key and is read in blocks without loading it whole.
    """

    def __init__(self, keys: int, expected: int, budget: int):
        self.budget, self.held, self.file, self.end = budget, 0, None, 0
        leaves = max(1, expected // LEAF)
        single = keys <= 1024 and expected >= 16 * keys
        self.width = 1 if single else -(-keys // max(1, int(leaves**0.5)))
        self.leaf_width = max(1, -(-keys // leaves))
        self.memory: dict[int, deque] = defaultdict(deque)
        self.disk: dict[int, deque] = defaultdict(deque)
        self.front: dict[int, Tuples] = {}  # rest of a single-key bucket that a smaller key overtook
        self.top, self.leaves, self.leaf_end = -1, {}, 0
        self.cur, self.at, self.late = EMPTY, 0, []

    def push(self, rows: Tuples) -> None:
        if self.width > 1 and self.top >= 0:
            key, top_end = rows.key, (self.top + 1) * self.width
            now, later = key < self.leaf_end, key >= top_end
            if now.any():
                self.late.append(rows[now])
            for leaf, part in rows[~(now | later)].parts(self.leaf_width):
                self.leaves.setdefault(leaf, []).append(part)
            rows = rows[later]
        for top, part in rows.parts(self.width):
            self.memory[top].append(part)
            self.held += len(part) * TUPLE
        if self.held > self.budget:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(self.end)
        for top, parts in self.memory.items():
            rows = Tuples.joined(list(parts))
            for a in range(0, len(rows), BLOCK):
                part = rows[a : a + BLOCK]
                for column in (part.key, part.pos, part.lcp):
                    self.file.write(column.tobytes())
                self.disk[top].append((self.end, len(part)))
                self.end += len(part) * TUPLE
        self.memory.clear()
        self.held = 0

    def _read(self, at: int, n: int) -> Tuples:
        self.file.seek(at)
        data = self.file.read(n * TUPLE)
        return Tuples(np.frombuffer(data, KEY, n), np.frombuffer(data, POS, n, 8 * n), np.frombuffer(data, LCP, n, 16 * n))

    def _next_block(self, top: int, whole: bool) -> Tuples:
        parts = [self.front.pop(top)] if top in self.front else []
        n = sum(map(len, parts))
        while (self.disk.get(top) or self.memory.get(top)) and (whole or n < BLOCK):
            if self.disk.get(top):
                part = self._read(*self.disk[top].popleft())
            else:
                part = self.memory[top].popleft()
                self.held -= len(part) * TUPLE
            parts.append(part)
            n += len(part)
        for store in (self.disk, self.memory):
            if top in store and not store[top]:
                del store[top]
        return Tuples.joined(parts)

    def head(self, limit: int) -> tuple[Tuples, int]:
        """The smallest tuples in order, and the key up to which (exclusive) they are complete."""
        if self.late:
            self.cur, self.at, self.late = Tuples.joined([self.cur[self.at :], *self.late]).by_key(), 0, []
        if self.width == 1 and self.at < len(self.cur) and min([*self.memory, *self.disk], default=NONE) < self.top:
            self.front[self.top], self.at = self.cur[self.at :], len(self.cur)
        while self.at == len(self.cur):
            if self.leaves:
                leaf = min(self.leaves)
                self.cur, self.at = Tuples.joined(self.leaves.pop(leaf)).by_key(), 0
                self.leaf_end = min((leaf + 1) * self.leaf_width, (self.top + 1) * self.width)
                continue
            tops = [min(s) for s in (self.disk, self.memory, self.front) if s]
            if not tops:
                return EMPTY, NONE
            self.top = min(tops)
            if self.width == 1:
                self.cur, self.at, self.leaf_end = self._next_block(self.top, False), 0, self.top + 1
            else:
                self.leaf_end = self.top * self.width
                for leaf, part in self._next_block(self.top, True).parts(self.leaf_width):
                    self.leaves.setdefault(leaf, []).append(part)
        rows = self.cur[self.at : self.at + limit]
        more = len(self.cur) - self.at > len(rows) or (self.width == 1 and (self.top in self.disk or self.top in self.memory))
        return rows, int(rows.key[-1]) if more else self.leaf_end

    def take(self, n: int) -> None:
        self.at += n


class Stream:
    """Blocks (pos, lcp) that come in the order of a pass, with a look ahead."""

    def __init__(self, blocks, key_of):
        self.blocks, self.key_of, self.rows, self.at, self.done = iter(blocks), key_of, EMPTY, 0, False

    def head(self, limit: int) -> tuple[Tuples, int]:
        while len(self.rows) - self.at < limit and not self.done:
            block = next(self.blocks, None)
            if block is None:
                self.done = True
            else:
                pos, lcp = np.asarray(block[0], POS), np.asarray(block[1], LCP)
                self.rows, self.at = Tuples.joined([self.rows[self.at :], Tuples(self.key_of(pos), pos, lcp)]), 0
        rows = self.rows[self.at : self.at + limit]
        return rows, NONE if self.done and self.at + len(rows) == len(self.rows) else int(rows.key[-1])

    def take(self, n: int) -> None:
        self.at += n


class RangeMin:
    """Smallest value since any earlier place of a growing sequence of small values.

    ``place[j], value[j]``: from a place below ``place[j]`` (and not below
    ``place[j - 1]``) on, the minimum is ``value[j]``. Values rise strictly, so
    there are no more entries than different values.
    """

    def __init__(self):
        self.n, self.place, self.value = 0, np.zeros(0, np.int64), np.zeros(0, np.uint16)

    def since(self, q: np.ndarray) -> np.ndarray:
        """Minimum after place ``q`` up to the end; the largest value where nothing follows."""
        j = np.searchsorted(self.place, q, side="right")
        return np.append(self.value, np.iinfo(np.uint16).max)[j]

    def extend(self, values: np.ndarray) -> None:
        low = np.minimum.accumulate(values[::-1])[::-1]
        at = np.flatnonzero(np.append(low[:-1] < low[1:], True))
        old = self.value < low[0]
        self.place = np.append(self.place[old], self.n + at)
        self.value = np.append(self.value[old], low[at])
        self.n += len(values)


def _inner_min(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """min(values[a + 1 .. b]) for pairs a < b, by a sparse table."""
    out = np.empty(len(a), values.dtype)
    level = np.frexp((b - a).astype(np.float64))[1] - 1  # floor(log2(length))
    table, span = values, 1
    for k in range(int(level.max(initial=-1)) + 1):
        if k:
            table, span = np.minimum(table[:-span], table[span:]), 2 * span
        own = level == k
        out[own] = np.minimum(table[a[own] + 1], table[b[own] - span + 1])
    return out


def sorted_in_memory(text: np.ndarray, depth: int, emit) -> None:
    """What ``Level.sort`` gives, by doubling sorted prefixes: the end of the recursion, for few symbols.

    A suffix's rank is the place of the first suffix of its group, so suffixes
    alone in their group are done and only the others are sorted on.
    """
    n, span = len(text), 1
    order = np.argsort(text, kind="stable")
    rank, active = np.empty(n, np.int64), np.arange(n)  # places in the order that still share a group
    sorted_by = text.astype(np.int64)[order]
    levels = []  # ranks by the first 1, 2, 4, ... symbols, up to depth
    while True:
        fresh = np.append(True, sorted_by[1:] != sorted_by[:-1])
        rank[order[active]] = active[np.maximum.accumulate(np.where(fresh, np.arange(len(active)), 0))]
        if span <= depth:
            levels.append(rank.astype(np.int32))
        active = active[~(fresh & np.append(fresh[1:], True))]
        if not len(active):
            break
        suffix = order[active]
        pair = rank[suffix] * (n + 1) + np.where(suffix + span < n, rank[np.minimum(suffix + span, n - 1)] + 1, 0)
        by = np.argsort(pair, kind="stable")
        order[active], sorted_by = suffix[by], pair[by]
        span *= 2
    a, b = order[:-1].copy(), order[1:].copy()
    for k, r in reversed(list(enumerate(levels))):
        same = (np.maximum(a, b) < n) & (r[np.minimum(a, n - 1)] == r[np.minimum(b, n - 1)])
        a[same] += 1 << k
        b[same] += 1 << k
    common = np.append(np.minimum(a - order[:-1], depth), 0).astype(np.uint16)
    emit(order[:0:-1], common[:0:-1], None)


class Level:
    """One level of the recursion: symbols ending in a unique smallest 0."""

    def __init__(self, text: np.ndarray, symbols: int, depth: int, scratch: Scratch, queue_budget: int):
        self.text, self.symbols, self.depth, self.scratch, self.budget = text, symbols, depth, scratch, queue_budget
        n = self.n = len(text)
        self.rising, self.run = scratch.array(n, np.bool_), scratch.array(n, np.uint16)
        self.rising[n - 1], self.run[n - 1] = True, 1
        change, up = n - 1, True
        for b in range(n - 1, 0, -(1 << 20)):
            a = max(0, b - (1 << 20))
            here = text[a : b + 1]
            at = np.flatnonzero(here[:-1] != here[1:])
            places, ups = np.append(a + at, change), np.append(here[at] < here[at + 1], up)
            j = np.searchsorted(places, np.arange(a, b))
            self.rising[a:b] = ups[j]
            self.run[a:b] = np.minimum(places[j] - np.arange(a, b) + 1, SAME - 1)
            if len(at):
                change, up = places[0], ups[0]

    def starts(self):
        """Positions whose suffix rises right after a falling one, in blocks."""
        for a in range(0, self.n, 1 << 20):
            b = min(self.n, a + (1 << 20))
            rising = np.asarray(self.rising[max(0, a - 1) : b])
            at = np.flatnonzero(rising[1:] & ~rising[:-1]) + max(0, a - 1) + 1
            yield at

    def induce(self, others, rising: bool, grow, cap: int, emit) -> None:
        """One pass: falling suffixes upwards from the sorted starts, or rising ones downwards from all falling."""
        text, top = self.text, self.symbols - 1

        def key_of(pos):
            symbol = np.asarray(text[pos], np.int64)
            return top - symbol if rising else symbol

        queue, stream, low = SymbolQueue(self.symbols, self.n // 2, self.budget), Stream(others, key_of), RangeMin()
        last = self.scratch.array(self.symbols, np.int64)
        last[:] = -1
        before = (-1, -1, True)  # key, position and kind of the tuple handed out last
        limit = BLOCK
        while True:
            own, own_end = queue.head(limit)
            oth, oth_end = stream.head(limit)
            oth = oth[: np.searchsorted(oth.key, own_end)] if len(own) else oth
            own = own[: np.searchsorted(own.key, oth_end, side="right")]
            if not len(own) and not len(oth):
                return
            if len(own) and len(oth):
                rows = Tuples.joined([own, oth])
                foreign = np.repeat([False, True], [len(own), len(oth)])
                order = np.argsort(2 * rows.key + foreign, kind="stable")
                rows, foreign = rows[order], foreign[order]
            else:
                rows = own if len(own) else oth
                foreign = np.full(len(rows), len(oth) > 0)
            key, pos = rows.key, rows.pos
            left = pos - 1
            ok = (pos > 0) & (np.asarray(self.rising[left]) == rising)
            to = np.where(ok, key_of(left), NONE)
            # Stop before a tuple that something induced here has to precede.
            first = np.minimum.accumulate(to[:-1])
            late = 2 * key[1:] + foreign[1:] > 2 * np.minimum(first, top) + (first > top) * 2
            m = int(late.argmax()) + 1 if late.any() else len(rows)
            rows, foreign, key, pos, left, ok, to = (x[:m] for x in (rows, foreign, key, pos, left, ok, to))
            limit = min(BLOCK, max(LEAF, 2 * m))
            n_own = int(m - foreign.sum())
            queue.take(n_own)
            stream.take(m - n_own)
            lcp = rows.lcp.copy()
            prev_key, prev_pos = np.append(before[0], key[:-1]), np.append(before[1], pos[:-1])
            seam = np.flatnonzero(foreign & ~np.append(before[2], foreign[:-1]))
            if len(seam):
                both = np.minimum(np.asarray(self.run[pos[seam]]), np.asarray(self.run[prev_pos[seam]]))
                lcp[seam] = np.where(prev_key[seam] == key[seam], np.minimum(both, cap), 0)
            before = (int(key[-1]), int(pos[-1]), bool(foreign[-1]))
            emit(pos, lcp, foreign)
            at = np.flatnonzero(ok)
            if len(at):
                target = to[at]
                order = np.argsort(target, kind="stable")
                k, place = target[order], at[order]
                value = np.empty(len(at), np.uint16)
                differs = k[1:] != k[:-1]
                inner = np.flatnonzero(~differs) + 1
                if len(inner):
                    value[inner] = grow(_inner_min(lcp, place[inner - 1], place[inner]))
                opening = np.append(0, np.flatnonzero(differs) + 1)
                since = np.asarray(last[k[opening]])
                value[opening] = np.where(since < 0, 0, grow(np.minimum(
                    low.since(since), np.minimum.accumulate(lcp)[place[opening]])))
                closing = np.append(opening[1:] - 1, len(k) - 1)
                last[k[closing]] = low.n + place[closing]
                # Sorted by key already; within one the order of arrival stays.
                queue.push(Tuples(k, left[place], value))
            low.extend(lcp)

    def sort_all(self, seeds, grow, cap: int, emit) -> None:
        """Both passes from sorted starts; ``emit(pos, lcp, foreign)`` gets all suffixes but the last, largest first."""
        count = 0
        pos_of, lcp_of = self.scratch.array(self.n, np.int64), self.scratch.array(self.n, np.uint16)

        def keep(pos, lcp, foreign):
            nonlocal count
            own = ~foreign
            m = int(own.sum())
            pos_of[count : count + m], lcp_of[count : count + m] = pos[own], lcp[own]
            count += m

        self.induce(seeds, False, grow, cap, keep)

        def downwards():
            for b in range(count, 0, -BLOCK):
                a = max(0, b - BLOCK)
                lcp = np.append(np.asarray(lcp_of[a + 1 : b]), lcp_of[b] if b < count else 0).astype(np.uint16)
                yield np.asarray(pos_of[a:b])[::-1], lcp[::-1]

        self.induce(downwards(), True, grow, cap, emit)

    def _named(self) -> tuple[np.ndarray, int]:
        """Names of all starts in text order (the last one is 0), and how many names there are."""
        queue = SymbolQueue(self.symbols, self.n // 3, self.budget)
        total = 0
        for at in self.starts():
            queue.push(Tuples(np.asarray(self.text[at], KEY), at, np.full(len(at), SAME, LCP)))
            total += len(at)

        def by_symbol():
            symbol = -1
            while True:
                rows, _ = queue.head(BLOCK)
                if not len(rows):
                    return
                queue.take(len(rows))
                yield rows.pos, np.where(np.append(symbol, rows.key[:-1]) == rows.key, rows.lcp, 0)
                symbol = rows.key[-1]

        name = self.scratch.array(self.n, np.int32)
        names, lowest = 0, 0

        def give(pos, lcp, foreign):
            nonlocal names, lowest
            at = np.flatnonzero(~foreign & (pos > 0))
            at = at[~np.asarray(self.rising[pos[at] - 1])]
            if not len(at):
                lowest = min(lowest, int(lcp.min()))
                return
            low = np.minimum.reduceat(lcp[: at[-1] + 1], np.append(0, at[:-1] + 1)).astype(np.int64)
            low[0] = min(low[0], lowest)
            rank = names + np.cumsum(low < SAME)
            name[pos[at]] = rank
            names = int(rank[-1])
            lowest = int(lcp[at[-1] + 1 :].min(initial=SAME))

        def grow(m):
            return np.where(m >= SAME, SAME, np.minimum(m + 1, SAME - 1)).astype(np.uint16)

        self.sort_all(by_symbol(), grow, SAME - 1, give)
        out, k = self.scratch.array(total, np.int32), 0
        for at in self.starts():
            out[k : k + len(at)] = names + 1 - np.asarray(name[at])
            k += len(at)
        out[total - 1] = 0
        return out, names + 1

    def _seeds(self):
        """Sorted starts with their common prefixes, in blocks: named, and sorted by recursion where names repeat."""
        name, names = self._named()
        m = len(name)
        place, k = self.scratch.array(m, np.int64), 0
        for at in self.starts():
            place[k : k + len(at)] = at
            k += len(at)
        order, lcp = self.scratch.array(m, np.int64), self.scratch.array(m, np.uint16)
        if names == m:
            order[name] = np.arange(m)
        else:
            rank = m

            def fill(pos, common, _):
                nonlocal rank
                a = rank - len(pos)
                order[a:rank] = pos[::-1]
                lcp[a + 1 : rank + 1] = common[::-1][: m - a - 1]
                rank = a

            if m <= self.budget // 32:
                sorted_in_memory(np.asarray(name), self.depth, fill)
            else:
                Level(name, names, self.depth, self.scratch, self.budget).sort(fill)
            order[0] = m - 1
        for a in range(0, m, BLOCK):
            b = min(m, a + BLOCK)
            this = np.asarray(order[a:b])
            that = np.append(order[a - 1] if a else this[0], this[:-1])
            same = np.asarray(lcp[a:b], np.int64)
            # Equal names cover the text up to the first that differ; those are compared.
            x, y = np.asarray(place[np.minimum(this + same, m - 1)]), np.asarray(place[np.minimum(that + same, m - 1)])
            common = np.minimum(x - np.asarray(place[this]), self.depth)
            if a == 0:
                common[0] = 0
            live = np.flatnonzero((common < self.depth) & (x != y))
            x, y = x[live], y[live]
            while len(live):
                go = np.asarray(self.text[x]) == np.asarray(self.text[y])
                live, x, y = live[go], x[go] + 1, y[go] + 1
                common[live] += 1
                go = common[live] < self.depth
                live, x, y = live[go], x[go], y[go]
            yield np.asarray(place[this]), common.astype(np.uint16)

    def sort(self, emit) -> None:
        """All suffixes but the last, largest first, each with its common prefix (up to ``depth``) with the one before."""
        if self.n > 1:
            self.sort_all(self._seeds(), lambda m: np.minimum(m, self.depth - 1) + np.uint16(1), self.depth, emit)


def sorted_suffixes(text: np.ndarray, symbols: int, depth: int, emit, budget: int = 64 << 20) -> None:
    """``emit(pos, lcp, _)`` with blocks of the suffixes of ``text``, largest first.

    ``text`` holds symbols 0 .. symbols - 1 and ends in its only 0; that last
    suffix is left out. ``lcp`` is the common prefix with the suffix emitted
    before, at most ``depth``. ``budget`` bytes bound each queue and each array
    in memory.
    """
    Level(text, symbols, depth, Scratch(budget), budget).sort(emit)
