"""Suffix order with common-prefix values by external induced sorting.

Suffixes are of type S or L as they are smaller or larger than the next one. The leftmost S suffixes of each run (LMS) are ordered first, by
naming their substrings (themselves ordered by induction) and ordering the reduced string of names in the same way, until one fits in memory. Then one
ascending pass induces all L suffixes and one descending pass all S suffixes: a suffix that leaves the queue sends its predecessor into it.

The priority queue is keyed by first symbol and order of arrival. How many tuples each symbol will get is known from the start, so the symbols are cut
into ranges that fit in memory; a tuple (symbol, suffix, common-prefix value with the one before it) for the range at work goes to its slot, others
wait in memory up to a bound and in an unnamed file beyond. Slots that are filled from the front of the range are final and leave together, so
the work is done by array operations. A symbol with more tuples than fit is a range of its own and is read in blocks, in order of arrival.

The common-prefix value of an induced suffix is one more than the least value between the inducing suffixes: inside a block from a range-minimum table,
before it from the last place of each value (values are capped, so there are few). Values of LMS suffixes are those of the reduced
string, carried over: the symbols of the common names and the least value between the first different names.

Strings, orders and values of all levels lie in unnamed files that are mapped; only blocks of them, and the bounded queue, are in memory.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable

import numpy as np

#: Bytes of tuples in memory, a quarter of them queued. A shard of 1.5 MB has about 50 MB of them.
MEMORY_BYTES = 16 << 20
#: What a tuple takes while it is worked on.
_TUPLE_BYTES = 32


class Store:
    """Arrays in unnamed files of the task."""

    def array(self, n: int, dtype, fill: int = 0) -> np.ndarray:
        with tempfile.TemporaryFile() as f:
            out = np.asarray(np.memmap(f, dtype, "w+", shape=(max(n, 1),)))[:n]
        if fill:
            out[:] = fill
        return out


def blocks(n: int, size: int):
    """Bounds of blocks."""
    for at in range(0, n, size):
        yield at, min(n, at + size)


class Queue:
    """Tuples by range of symbols, in order of arrival, in a file beyond a bound of bytes."""

    KINDS = (np.int64, np.int64, np.uint16)

    def __init__(self, bounds: np.ndarray, limit: int):
        self.bounds, self.limit = bounds, limit
        self.held: list[list[np.ndarray]] = []
        self.parts: dict[int, list[tuple[int, int]]] = {}
        self.bytes, self.file = 0, None

    def push(self, *columns: np.ndarray) -> None:
        self.held.append([c.astype(k) for c, k in zip(columns, self.KINDS, strict=True)])
        self.bytes += sum(c.nbytes for c in self.held[-1])
        if self.bytes > self.limit:
            self.spill()

    def _joined(self) -> tuple[list[np.ndarray], np.ndarray]:
        columns = [np.concatenate(c) for c in zip(*self.held, strict=True)]
        return columns, np.searchsorted(self.bounds, columns[0], "right")

    def spill(self) -> None:
        """Sends what is in memory to the file, a part for each range."""
        columns, where = self._joined()
        order = np.argsort(where, kind="stable")
        columns, where = [c[order] for c in columns], where[order]
        found, at = np.unique(where, return_index=True)
        self.file = self.file or tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for r, a, b in zip(found.tolist(), at.tolist(), [*at[1:].tolist(), len(where)], strict=True):
            self.parts.setdefault(r, []).append((self.file.tell(), b - a))
            self.file.write(b"".join(c[a:b].tobytes() for c in columns))
        self.held, self.bytes = [], 0

    def take(self, at: int, most: int) -> list[np.ndarray] | None:
        """The first tuples of a range, at most `most` beyond one part."""
        parts, out, n = self.parts.get(at, []), [], 0
        while parts and n < most:
            place, size = parts.pop(0)
            self.file.seek(place)
            out.append([np.frombuffer(self.file.read(size * np.dtype(k).itemsize), k) for k in self.KINDS])
            n += size
        if self.held and n < most:
            columns, where = self._joined()
            own = where == at
            out.append([c[own] for c in columns])
            self.held = [[c[~own] for c in columns]]
            self.bytes = sum(c.nbytes for c in self.held[0])
        return [np.concatenate(c) for c in zip(*out, strict=True)] if out else None


class _Minima:
    """Least values of ranges of a run, both ends included."""

    def __init__(self, values: np.ndarray, array: Callable = np.empty):
        self.levels, width = [values], 1
        while 2 * width <= len(values):
            v = self.levels[-1]
            self.levels.append(np.minimum(v[:-width], v[width:], out=array(len(v) - width, v.dtype)))
            width *= 2

    def __call__(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        level = np.maximum(np.frexp(last - first + 1)[1] - 1, 0)
        out = np.empty(len(first), np.int64)
        for k in np.unique(level).tolist():
            m = level == k
            v = self.levels[k]
            out[m] = np.minimum(v[first[m]], v[last[m] - (1 << k) + 1])
        return out


class _String:
    """A string in files, with the type of each suffix, its LMS suffixes in order, runs of equal symbols, and counts by symbol."""

    def __init__(self, store: Store, t: np.ndarray, symbols: int, cap: int, size: int):
        n = len(t)
        self.t, self.n, self.symbols = t, n, symbols
        self.place = np.int32 if n < 1 << 31 else np.int64
        self.is_s, self.run = store.array(n, bool), store.array(n, np.uint16)
        self.count = {k: store.array(symbols, np.int64) for k in ("L", "S", "LMS")}
        lms, n_lms = store.array(n // 2 + 1, self.place), 0
        after_s, after_run = True, 0  # of the suffix behind the block
        for a, b in reversed(list(blocks(n, size))):
            here = np.append(t[a:b], t[b] if b < n else -1).astype(np.int64)
            at = np.where(here[1:] != here[:-1], np.arange(b - a), b - a)
            following = np.minimum.accumulate(at[::-1])[::-1]  # the last of each run of equal symbols
            inside = following < b - a
            step = np.minimum(following, b - a - 1)
            s = np.where(inside, here[step + 1] > here[step], after_s)
            if b == n:
                s[-1] = True
            self.is_s[a:b] = s
            self.run[a:b] = np.minimum(cap, np.where(inside, following - np.arange(b - a) + 1, b - a - np.arange(b - a) + after_run))
            wide = np.append(s, after_s)
            first = a + 1 + np.flatnonzero(wide[1:] & ~wide[:-1])  # may begin the next block
            lms[n_lms : n_lms + len(first)] = first[::-1]
            n_lms += len(first)
            after_s, after_run = bool(s[0]), int(self.run[a])
            for name, which in (("L", ~s), ("S", s)):
                u, c = np.unique(here[:-1][which], return_counts=True)
                self.count[name][u] += c
            u, c = np.unique(np.asarray(t[first]), return_counts=True)
            self.count["LMS"][u] += c
        self.count["S"][0] -= 1  # the last suffix is never induced
        self.lms = lms[:n_lms][::-1]


def _filled(pos: np.ndarray, j: int) -> int:
    """Where the filled slots from j on end, looked for in windows that grow, so that it takes as long as they are many."""
    width = 64
    while j < len(pos):
        open_ = pos[j : j + width] < 0
        at = int(open_.argmax())
        if open_[at]:
            return j + at
        j += width
        width *= 4
    return len(pos)


class _Pass:
    """One pass over a string: from suffixes given in the pass's order all wanted ones are induced."""

    def __init__(self, store: Store, s: _String, wanted_s: bool, cap: int, memory: int):
        self.s, self.wanted_s, self.cap, self.most, self.memory = s, wanted_s, cap, max(1, memory // _TUPLE_BYTES), memory
        self.store, self.done = store, 0
        self.sent = store.array(s.symbols, np.int64, -1)  # where each symbol's last inducing suffix stood
        self.last = np.full(cap + 1, -1)  # the last place with at most each value

    def symbol(self, at: np.ndarray) -> np.ndarray:
        """First symbols, in the order of the pass: ascending for L suffixes, descending for S."""
        c = np.asarray(self.s.t[at]).astype(np.int64)
        return self.s.symbols - 1 - c if self.wanted_s else c

    def induce(self, pos: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """symbol, suffix and common-prefix value of the wanted predecessors, by symbol and then in order."""
        index = np.flatnonzero(pos > 0)
        index = index[self.s.is_s[pos[index] - 1] == self.wanted_s]
        symbol = self.symbol(pos[index] - 1)
        order = np.argsort(symbol, kind="stable")
        index, symbol = index[order], symbol[order]
        value = np.zeros(len(index), np.int64)
        first = np.ones(len(index), bool)
        first[1:] = symbol[1:] != symbol[:-1]
        heads, later = np.flatnonzero(first), np.flatnonzero(~first)
        if len(later):
            value[later] = _Minima(lcp)(index[later - 1] + 1, index[later])
        if len(heads):
            before = np.asarray(self.sent[symbol[heads]])
            since = np.minimum(np.searchsorted(self.last, before, "right"), self.cap)
            value[heads] = np.minimum(since, np.minimum.accumulate(lcp)[index[heads]])
            value = np.minimum(value, self.cap - 1) + 1
            value[heads[before < 0]] = 0
            tails = np.append(heads[1:], len(index)) - 1
            self.sent[symbol[tails]] = self.done + index[tails]
        at = np.full(self.cap + 1, -1)
        at[lcp] = self.done + np.arange(len(lcp))  # the last one of each value stays
        self.last = np.maximum(self.last, np.maximum.accumulate(at))
        self.done += len(pos)
        return symbol, pos[index] - 1, value

    def run(self, induced: np.ndarray, given_of: np.ndarray, given: Callable, emit: Callable) -> None:
        """induced, given_of: tuples of each symbol to be induced, and given; given(a, b): those given, in order; emit(suffixes, values, which are
        induced) gets all in order. Of a symbol the induced ones stand before those given."""
        symbols, run = self.s.symbols, self.s.run
        start = self.store.array(symbols + 1, np.int64)
        np.cumsum(induced, out=start[1:])
        np.add(start[1:], np.cumsum(given_of), out=start[1:])
        bounds = []
        while not bounds or bounds[-1] < symbols:
            at = bounds[-1] if bounds else 0
            bounds.append(max(at + 1, int(np.searchsorted(start, start[at] + self.most, "right")) - 1))
        queue, g, lo = Queue(np.array(bounds), self.memory // 4), 0, 0
        for r, hi in enumerate(bounds):
            size = int(start[hi] - start[lo])
            if size > self.most:
                g = self._long(queue, r, lo, int(induced[lo]), int(given_of[lo]), g, given, emit)
                lo = hi
                continue
            pos, lcp, own = np.full(size, -1), np.zeros(size, np.int64), np.ones(size, bool)
            head = (start[lo:hi] - start[lo]).astype(np.int64)
            n_induced, n_given = np.asarray(induced[lo:hi]), np.asarray(given_of[lo:hi])
            total = int(n_given.sum())
            if total:
                slots = np.repeat(head + n_induced - (np.cumsum(n_given) - n_given), n_given) + np.arange(total)
                pos[slots], lcp[slots] = given(g, g + total)
                own[slots] = False
                g += total
            first = (head + n_induced)[n_given > 0]
            lcp[first] = 0
            mixed = (head + n_induced)[(n_given > 0) & (n_induced > 0)]

            def put(symbol, p, v, head=head, pos=pos, lcp=lcp, lo=lo):
                order = np.argsort(symbol, kind="stable")
                which, at, n = np.unique(symbol[order] - lo, return_index=True, return_counts=True)
                slot = np.repeat(head[which] - at, n) + np.arange(len(order))
                pos[slot], lcp[slot] = p[order], v[order]
                head[which] += n

            waiting = queue.take(r, 1 << 62)
            if waiting and len(waiting[0]):
                put(*waiting)
            j = 0
            while j < size:
                k = _filled(pos, j)
                if k <= j:
                    raise RuntimeError("a slot is reached before it is filled")
                m = mixed[np.searchsorted(mixed, j) : np.searchsorted(mixed, k)]
                lcp[m] = np.minimum(run[pos[m - 1]], run[pos[m]])
                emit(pos[j:k], lcp[j:k], own[j:k])
                symbol, p, v = self.induce(pos[j:k], lcp[j:k])
                inside = symbol < hi
                if inside.any():
                    put(symbol[inside], p[inside], v[inside])
                if not inside.all():
                    queue.push(symbol[~inside], p[~inside], v[~inside])
                j = k
            lo = hi
        if queue.file:
            queue.file.close()

    def _long(self, queue: Queue, r: int, symbol: int, n_induced: int, n_given: int, g: int, given: Callable, emit: Callable) -> int:
        """A symbol with more tuples than fit, in blocks."""
        done, last = 0, None
        while done < n_induced:
            _, pos, lcp = queue.take(r, self.most)
            emit(pos, lcp.astype(np.int64), np.ones(len(pos), bool))
            done, last = done + len(pos), int(pos[-1])
            sent = self.induce(pos, lcp.astype(np.int64))
            if len(sent[0]):
                queue.push(*sent)
        for a, b in blocks(n_given, self.most):
            pos, lcp = (np.array(x, np.int64) for x in given(g + a, g + b))
            if a == 0:
                lcp[0] = 0 if last is None else min(int(self.s.run[last]), int(self.s.run[pos[0]]))
            emit(pos, lcp, np.zeros(len(pos), bool))
            sent = self.induce(pos, lcp)
            if len(sent[0]):
                queue.push(*sent)
        return g + n_given


def _both(store: Store, s: _String, lms: np.ndarray, lms_lcp: np.ndarray, cap: int, memory: int, emit: Callable) -> None:
    """The ascending and the descending pass from LMS suffixes in order; emit gets all suffixes but the last, in descending order."""
    n = int(s.count["L"].sum())
    larger, values, at = store.array(n, s.place), store.array(n + 1, np.uint16), 0

    def keep(pos, lcp, induced):
        nonlocal at
        pos, lcp = pos[induced], lcp[induced]
        larger[at : at + len(pos)], values[at : at + len(pos)] = pos, lcp
        at += len(pos)

    _Pass(store, s, False, cap, memory).run(s.count["L"], s.count["LMS"], lambda a, b: (lms[a:b], lms_lcp[a:b]), keep)
    # from the largest down, an L suffix's value is that of the next larger one
    down = lambda a, b: (larger[n - b : n - a][::-1], values[n - b + 1 : n - a + 1][::-1])
    _Pass(store, s, True, cap, memory).run(s.count["S"][::-1], s.count["L"][::-1], down, emit)


def _substrings(s: _String, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs of LMS suffixes whether their LMS substrings are equal, and how many symbols have equal values and types."""
    ends = [s.lms[np.minimum(np.searchsorted(s.lms, p) + 1, len(s.lms) - 1)] - p + 1 for p in (x, y)]
    least = np.minimum(*ends)
    value, live = np.zeros(len(x), np.int64), np.arange(len(x))
    j = 0
    while len(live):
        a, b = x[live] + j, y[live] + j
        live = live[(s.t[a] == s.t[b]) & (s.is_s[a] == s.is_s[b])]
        j += 1
        value[live] = j
        live = live[least[live] > j]
    return value == least, value


def _further(s: _String, x: np.ndarray, y: np.ndarray, value: np.ndarray, cap: int) -> np.ndarray:
    """Common-prefix values, capped, of suffixes that differ in value or type behind `value` symbols: if in type only, runs of that symbol decide."""
    value = np.minimum(value, cap)
    a, b = x + value, y + value
    same = np.flatnonzero((value < cap) & (s.t[a] == s.t[b]))
    value[same] += np.minimum(s.run[a[same]], s.run[b[same]])
    return np.minimum(value, cap)


def _sorted_lms(store: Store, s: _String, cap: int, memory: int) -> tuple[np.ndarray, np.ndarray]:
    """The LMS suffixes in order and their common-prefix values."""
    m, size = len(s.lms), max(1, memory // _TUPLE_BYTES)
    begin = store.array(s.symbols + 1, np.int64)
    np.cumsum(s.count["LMS"], out=begin[1:])
    by_symbol = store.array(m, s.place)
    for a, b in blocks(m, size):
        pos = np.asarray(s.lms[a:b])
        c = np.asarray(s.t[pos])
        order = np.argsort(c, kind="stable")
        which, at, n = np.unique(c[order], return_index=True, return_counts=True)
        by_symbol[np.repeat(begin[which] - at, n) + np.arange(b - a)] = pos[order]
        begin[which] += n
    rough, at = store.array(m, s.place), m

    def keep(pos, lcp, induced):
        nonlocal at
        pos = pos[induced]
        pos = pos[(pos > 0) & ~s.is_s[pos - 1]]
        rough[at - len(pos) : at] = pos[::-1]
        at -= len(pos)

    _both(store, s, by_symbol, store.array(m, np.uint16), cap, memory, keep)
    rough[0] = s.n - 1
    names, between, values, name = store.array(m, np.int64), store.array(m, np.uint16), store.array(m, np.uint16), 0
    for a, b in blocks(m - 1, size):
        pairs = np.asarray(rough[a : b + 1]).astype(np.int64)
        equal, value = _substrings(s, pairs[:-1], pairs[1:])
        named = name + np.cumsum(~equal)
        names[np.searchsorted(s.lms, pairs[1:])] = named
        between[named[~equal]] = np.minimum(value[~equal], cap)
        values[a + 1 : b + 1] = _further(s, pairs[:-1], pairs[1:], value, cap)
        name = int(named[-1])
    if name == m - 1:
        return rough, values
    inner, inner_lcp = _order(store, names, name + 1, cap, memory, True)
    least = _Minima(between[: name + 1], store.array)
    out, out_lcp = store.array(m, s.place), store.array(m, np.uint16)
    out[0] = s.lms[inner[0]]
    for a, b in blocks(m - 1, size):
        x, y, common = (np.asarray(v).astype(np.int64) for v in (inner[a:b], inner[a + 1 : b + 1], inner_lcp[a + 1 : b + 1]))
        out[a + 1 : b + 1] = s.lms[y]
        short = np.flatnonzero(common < cap)
        x, y, common = x[short], y[short], common[short]
        value = np.full(b - a, cap)
        passed = s.lms[y + common] - s.lms[y].astype(np.int64)
        value[short] = _further(s, s.lms[x].astype(np.int64), s.lms[y].astype(np.int64), passed + least(names[x + common] + 1, names[y + common]), cap)
        out_lcp[a + 1 : b + 1] = value
    return out, out_lcp


def _in_memory(t: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for a string that fits in memory: ranks of prefixes of doubling length, of which those below the cap give the values of neighbours."""
    n, k = len(t), 1
    rank = np.unique(t, return_inverse=True)[1].astype(np.int64)
    ranks = []  # of prefixes of 1, 2, 4, ... symbols
    while True:
        if k <= cap:
            ranks.append(rank.astype(np.int32 if n < 1 << 31 else np.int64))
        second = np.zeros(n, np.int64)
        second[: n - k] = rank[k:] + 1
        key = rank * (n + 1) + second
        out = np.argsort(key)
        rank = np.empty(n, np.int64)
        rank[out] = np.concatenate([[0], np.cumsum(key[out[1:]] != key[out[:-1]])])
        k *= 2
        if rank[out[-1]] == n - 1 or k >= n:
            break
    values = np.zeros(n, np.int64)
    for j in reversed(range(len(ranks))):
        a, b = out[:-1] + values[1:], out[1:] + values[1:]
        both = np.flatnonzero(np.maximum(a, b) < n)
        equal = both[ranks[j][a[both]] == ranks[j][b[both]]]
        values[1 + equal] += 1 << j
    return out, np.minimum(values, cap).astype(np.uint16)


def _order(store: Store, t: np.ndarray, symbols: int, cap: int, memory: int, inner: bool = False) -> tuple[np.ndarray, np.ndarray]:
    n = len(t)
    if inner and n * _TUPLE_BYTES <= memory:
        return _in_memory(np.asarray(t), cap)
    s = _String(store, t, symbols, cap, max(1, memory // _TUPLE_BYTES))
    out, values, at = store.array(n, s.place), store.array(n + 1, np.uint16), n

    def keep(pos, lcp, induced):
        nonlocal at
        out[at - len(pos) : at] = pos[::-1]
        values[at - len(pos) + 1 : at + 1] = lcp[::-1]
        at -= len(pos)

    if n > 1:
        _both(store, s, *_sorted_lms(store, s, cap, memory), cap, memory, keep)
    out[0] = n - 1
    values[0] = 0
    if n > 1:
        values[1] = 0
    return out, values[:n]


def order(t: np.ndarray, cap: int, memory: int = MEMORY_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of t in order, and common-prefix values with the one before, at most cap, as mapped arrays. t ends with its only smallest symbol, 0.

    memory: bytes of tuples in memory; a block that leaves the queue, or is read, takes as much again."""
    if not 0 < cap < 1 << 16:
        raise ValueError("cap has to be from 1 to 65535")
    return _order(Store(), t, int(t.max()) + 1, cap, memory)
