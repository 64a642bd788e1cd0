"""Periodic runs in texts: stretches of words that repeat with a period, found by block matching.

A run is a maximal stretch with smallest period q of at least `least` words and `times` * q words. For each power of two B, the aligned blocks of
B words become integer-sequence keys of an automaton that is searched over the text. A run with B <= q < 2B holds at least one aligned
block together with its copy q words later (times >= 4), so every run is seeded by an occurrence at a distance of B to 2B - 1 behind its block; each place has
one such block at most. Seeds are extended word by word in both directions, which is exact; a root that repeats a shorter one is no smallest period.

Blocks go into the automaton only where a run of their scale can be: each word of such a run, but for the last q, recurs within 2B - 1 words,
so stretches of words that do are looked for first, over many texts at once. Pairs inside a known run of a period up to B seed nothing new (a run of longer
period can't hold them) and are left out, so texts of one repeated word cost their length times its logarithm.

Words: `[^\\x20\\x09-\\x0D]+`. They are hashed for the stretches only; automaton and extension work on exact numbers of the text's words.

Defined cases: a null, empty or all-space text has no words, no runs and an empty collapsed text; equal rows give equal results; of equally strong runs the
first counts, then the shorter period; a very long text is searched whole; an empty table gives an empty result; null keys stay; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import text as X

#: Seeds of one distance from which all stretches of the distance are found at once: one for so many words.
_DENSE = 64
_FAR = np.int64(1) << 62


def gaps(words: X.Words) -> np.ndarray:
    """For each word the distance to the next equal word of its text."""
    own = X.owner(words.bounds)
    keys = words.hashes ^ X.mix(own.astype(np.uint64) + np.uint64(1))
    order = np.argsort(keys, kind="stable")
    same = (keys[order[1:]] == keys[order[:-1]]) & (own[order[1:]] == own[order[:-1]])
    out = np.full(len(keys), _FAR)
    out[order[:-1][same]] = order[1:][same] - order[:-1][same]
    return out


def numbers(texts: X.Texts, words: X.Words, row: int) -> np.ndarray:
    """Equal numbers for equal words of a text."""
    raw, names = texts.data[texts.bounds[row] : texts.bounds[row + 1]].tobytes(), {}
    base, at = int(texts.bounds[row]), slice(words.bounds[row], words.bounds[row + 1])
    pairs = zip((words.starts[at] - base).tolist(), (words.ends[at] - base).tolist(), strict=True)
    return np.array([names.setdefault(raw[a:b], len(names)) for a, b in pairs], np.int64)


def seeds(ids: np.ndarray, first: int, last: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the aligned blocks first to last - 1, and distances of size to 2 * size - 1 at which they occur again."""
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    listed, name = ids[first * size : last * size].tolist(), np.empty(last - first, np.int64)
    for k in range(last - first):
        block = tuple(listed[k * size : (k + 1) * size])
        name[k] = automaton.get(block, -1)
        if name[k] < 0:
            automaton.add_word(block, k)
            name[k] = k
    automaton.make_automaton()
    begin = (first + 1) * size
    found = np.array(list(automaton.iter(tuple(ids[begin : (last + 2) * size].tolist()))), np.int64).reshape(-1, 2)
    at = found[:, 0] + begin - size + 1
    block = at // size - 1  # the one aligned block at a distance of this scale
    has = block < last
    at, block, found = at[has], block[has], found[has]
    has = name[block - first] == found[:, 1]
    return block[has] * size, at[has] - block[has] * size


def inside(runs: list[tuple[int, int, int]], starts: np.ndarray, ends: np.ndarray, longest: int) -> np.ndarray:
    """Which ranges lie in one of the runs (start, length, period) of a period up to `longest`."""
    known = np.array(sorted((s, s + n) for s, n, q in runs if q <= longest), np.int64).reshape(-1, 2)
    if not len(known):
        return np.zeros(len(starts), bool)
    reach = np.concatenate([[-1], np.maximum.accumulate(known[:, 1])])
    return reach[np.searchsorted(known[:, 0], starts, "right")] >= ends


def stretch(ids: np.ndarray, at: int, d: int) -> tuple[int, int]:
    """The maximal range of places around `at` whose word equals the one d later, looked for in growing pieces."""
    lo = hi = at
    step = 32
    while hi < len(ids) - d:
        to = min(hi + step, len(ids) - d)
        differ = np.flatnonzero(ids[hi:to] != ids[hi + d : to + d])
        if len(differ):
            hi += int(differ[0])
            break
        hi, step = to, 2 * step
    step = 32
    while lo > 0:
        to = max(lo - step, 0)
        differ = np.flatnonzero(ids[to:lo] != ids[to + d : lo + d])
        if len(differ):
            lo = to + int(differ[-1]) + 1
            break
        lo, step = to, 2 * step
    return lo, hi


def stretches(ids: np.ndarray, starts: np.ndarray, d: int) -> Iterator[tuple[int, int]]:
    """The stretches of distance d that hold the seeds at `starts`, ascending."""
    if len(starts) * _DENSE >= len(ids):
        lo, hi = X.runs(ids[:-d] == ids[d:], np.array([0, len(ids) - d]))
        yield from zip(lo[held := np.unique(np.searchsorted(lo, starts, "right") - 1)].tolist(), hi[held].tolist(), strict=True)
        return
    end = -1
    for at in starts.tolist():
        if at >= end:
            lo, end = stretch(ids, at, d)
            yield lo, end


def primitive(root: np.ndarray) -> bool:
    """Whether the root isn't a shorter one repeated: then no rotation by a divisor of its length equals it."""
    n = rest = len(root)
    p = 2
    while rest > 1:
        if p * p > rest:
            p = rest
        if rest % p == 0:
            k = n // p
            if np.array_equal(root[k:], root[:-k]):
                return False
            while rest % p == 0:
                rest //= p
        p += 1
    return True


def extend(ids: np.ndarray, runs: list[tuple[int, int, int]], lo: int, hi: int, size: int, times: int, least: int) -> None:
    """Adds to the runs (start, length, period) those with a period of size to 2 * size - 1 whose places recur in [lo, hi)."""
    blocks = np.arange(-(-lo // size), hi // size)
    blocks = blocks[~inside(runs, blocks * size, np.minimum((blocks + 3) * size, len(ids)), size)]  # all pairs of the others lie in a known run
    if not len(blocks):
        return
    groups = [seeds(ids, int(g[0]), int(g[-1]) + 1, size) for g in np.split(blocks, np.flatnonzero(np.diff(blocks) > 1) + 1)]
    starts, far = (np.concatenate(x) for x in zip(*groups, strict=True))
    new = ~inside(runs, starts, starts + far + size, size)
    starts, far = starts[new], far[new]
    order = np.lexsort((starts, far))
    starts, far = starts[order], far[order]
    cuts = np.flatnonzero(np.diff(far)) + 1
    for group, d in zip(np.split(starts, cuts), far[np.concatenate([[0], cuts])].tolist() if len(far) else [], strict=False):
        for a, b in stretches(ids, group, d):
            n = b - a + d
            if n >= max(least, times * d) and primitive(ids[a : a + d]):
                runs.append((a, n, d))


def runs_of(texts: X.Texts, words: X.Words, times: int = 4, least: int = 6) -> dict[int, list[tuple[int, int, int]]]:
    """Text -> its runs (start, length, period) by start and period; texts without runs are left out."""
    gap, out, ids = gaps(words), {}, {}
    size, longest = 1, int(words.counts.max(initial=0))
    while times * size <= longest:
        lo, hi = X.runs(gap < 2 * size, words.bounds)
        wide = hi - lo >= max(least - 2 * size + 1, (times - 1) * size)
        lo, hi = lo[wide], hi[wide]
        for row, a, b in zip((np.searchsorted(words.bounds, lo, "right") - 1).tolist(), lo.tolist(), hi.tolist(), strict=True):
            if row not in ids:
                ids[row], out[row] = numbers(texts, words, row), []
            base = int(words.bounds[row])
            extend(ids[row], out[row], a - base, b - base, size, times, least)
        size *= 2
    return {row: sorted(set(found), key=lambda r: (r[0], r[2])) for row, found in out.items() if found}


def _stronger(a: tuple[int, int, int], b: tuple[int, int, int]) -> int:
    """Negative if run a has the greater length / period, else by start and period."""
    return b[1] * a[2] - a[1] * b[2] or a[0] - b[0] or a[2] - b[2]


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    return min(runs, key=functools.cmp_to_key(_stronger))


def collapsed(texts: X.Texts, words: X.Words, runs: dict[int, list[tuple[int, int, int]]]) -> pa.Array:
    """The texts' words joined by single spaces, without those that a run holds behind its first period."""
    change = np.zeros(len(words.starts) + 1, np.int64)
    for row, found in runs.items():
        for start, n, q in found:
            change[words.bounds[row] + start + q] += 1
            change[words.bounds[row] + start + n] -= 1
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    per_text = np.diff(np.searchsorted(kept, words.bounds))
    sizes = words.ends[kept] - words.starts[kept] + 1
    sizes[np.cumsum(per_text)[per_text > 0] - 1] -= 1  # no space behind the last word
    to = np.concatenate([[0], np.cumsum(sizes)])
    source = np.repeat(words.starts[kept] - to[:-1], sizes) + np.arange(to[-1])
    out = texts.data[source] if len(source) else np.zeros(0, np.uint8)
    spaced = sizes > words.ends[kept] - words.starts[kept]
    out[to[1:][spaced] - 1] = 0x20
    offsets = to[np.concatenate([[0], np.cumsum(per_text)])]
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out)).cast(pa.string())


_RUN = "struct<start:bigint,length:bigint,period:bigint>"
_RUN_TYPE = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _structs(runs: list[tuple[int, int, int]], absent: np.ndarray | None = None) -> pa.Array:
    columns = np.array(runs, np.int64).reshape(-1, 3)
    return pa.StructArray.from_arrays([pa.array(columns[:, i]) for i in range(3)], fields=list(_RUN_TYPE), mask=None if absent is None else pa.array(absent))


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", times: int = 4, least: int = 6) -> DataFrame:
    """key, n_words, runs array<struct<start,length,period>>, strongest struct (null without runs), collapsed string. Starts count words from 0.

    times: periods that a run has at least, 4 or more."""
    if times < 4:
        raise ValueError("blocks seed runs of four periods or more")
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), *T.StructType.fromDDL(f"n_words long, runs array<{_RUN}>, strongest {_RUN}, collapsed string")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in X.chunked(batch.column(1)):
                words = X.words(group, X.NOT_SPACE, False)
                found = runs_of(group, words, times, least)
                listed = [found.get(i, []) for i in range(len(group))]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in listed])]).astype(np.int32)
                best = _structs([strongest(x) if x else (0, 0, 0) for x in listed], np.array([not x for x in listed]))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(group.first, len(group)),
                        pa.array(words.counts.astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(offsets), _structs([r for x in listed for r in x])),
                        best,
                        collapsed(group, words, found),
                    ],
                    names=schema.names,
                )

    return docs.select(key, text).mapInArrow(run, schema).withColumnRenamed("key", key)
