"""Vectorised text kernels: words, lines and shingles of whole Arrow batches as numpy arrays.

Texts are UTF-8 bytes. All word classes used here have ASCII delimiters only, so that working on bytes equals working on
characters. Hashes are polynomials over the bytes modulo a prime, for two bases, joined and mixed to 64 bits.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; one longer text is handled alone.
CHUNK_BYTES = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that all bits depend on all bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


#: For block_hashes: hashes of small sizes, and masks of up to eight bytes.
_SIZE_SALT = np.uint64(0x51_7C_C1)
_SIZE_MIX = mix(np.arange(256, dtype=np.uint64) + _SIZE_SALT)
_MASKS = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUES = np.arange(1, 257, dtype=np.uint64)
_LOWERED_VALUES = _VALUES[_LOWER]


def byte_class(is_word) -> np.ndarray:
    """A table over the 256 byte values from a predicate on them."""
    return np.array([bool(is_word(b)) for b in range(256)])


#: `[^\x20\x09-\x0D]`
NOT_SPACE = byte_class(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]` after lower-casing A-Z: digits, ASCII letters, all beyond ASCII.
ALNUM = byte_class(lambda b: b >= 0x80 or 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)

#: A Mersenne prime, so that a remainder takes shifts and sums, and the two bases of the byte hash.
_PRIME = (1 << 31) - 1
_BASES = (0x5DEECE66 % _PRIME, 0x2545F491)


def fold(x: np.ndarray) -> np.ndarray:
    """Remainders of values below 2**62 by _PRIME."""
    p, s = np.uint64(_PRIME), np.uint64(31)
    high = x >> s
    x = x & p
    x += high
    np.right_shift(x, s, out=high)
    x &= p
    x += high
    return np.minimum(x, x - p)  # a difference below zero wraps to a large value


def _upto(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    k = 1
    while k < n:
        out[k : 2 * k] = fold(out[: min(k, n - k)] * np.uint64(pow(base, k, _PRIME)))
        k *= 2
    return out.astype(np.uint32)


class _Local(dict):
    """A cache of the process. It is empty again wherever it is sent, so that functions that use it stay small when pickled."""

    def __reduce__(self):
        return _Local, ()


_cache = _Local()


def powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each base its powers and those of its inverse; tables for ordinary chunks are kept."""

    def tables(m: int) -> list[tuple[np.ndarray, np.ndarray]]:
        return [(_upto(b, m), _upto(pow(b, -1, _PRIME), m)) for b in _BASES]

    if n > 2 * CHUNK_BYTES:
        return tables(n)
    if "p" not in _cache or len(_cache["p"][0][0]) < n:
        _cache["p"] = tables(max(n, CHUNK_BYTES + 1))
    return _cache["p"]


@dataclass
class Texts:
    """Some consecutive texts of a batch: their bytes, and bounds of each text in them."""

    data: np.ndarray
    bounds: np.ndarray
    first: int  # row of the batch

    def __len__(self) -> int:
        return len(self.bounds) - 1


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, bounds


def longs(column: pa.Array) -> np.ndarray:
    """A long column as numpy; null becomes the smallest long, which joins with nothing."""
    return column.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)


def chunked(column, limit: int = CHUNK_BYTES) -> Iterator[Texts]:
    """The rows in order, in groups of at most `limit` bytes; a longer text is a group of its own."""
    raw, bounds = utf8(column)
    row, n = 0, len(bounds) - 1
    while row < n:
        to = max(row + 1, int(np.searchsorted(bounds, bounds[row] + limit, "right")) - 1)
        yield Texts(raw[bounds[row] : bounds[to]], bounds[row : to + 1] - bounds[row], row)
        row = to
    trim()


def trim() -> None:
    """Gives freed memory back to the system, so that idle Python workers of an executor stay small."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def runs(member: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true values, broken at the bounds of texts."""
    n = len(member)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(n + 1, bool)
    cut[bounds] = True
    start, end = member.copy(), member.copy()
    start[1:] &= ~member[:-1] | cut[1:n]
    end[:-1] &= ~member[1:] | cut[1:n]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


class Hasher:
    """Hashes of any byte ranges of a group of texts."""

    def __init__(self, data: np.ndarray, lower: bool = False):
        n = len(data)
        values, self.parts = (_LOWERED_VALUES if lower else _VALUES)[data], []
        for power, inverse in powers(n + 1):
            sums = np.zeros(n + 1, np.uint64)
            terms = values * power[:n]
            np.cumsum(terms if n < 1 << 22 else fold(terms), out=sums[1:])  # below 2**62 either way
            self.parts.append((sums, inverse))

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        high, low = (fold(fold(sums[ends] - sums[starts]) * inverse[starts]) for sums, inverse in self.parts)
        return mix(((high << np.uint64(31)) | low) + mix((ends - starts).astype(np.uint64)))


def block_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """Hashes of byte ranges, eight bytes at a time: fewer steps than prefix sums where ranges are short, as words are. Ranges of up to eight bytes and
    equal length never clash. Not those of Hasher."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:-8] = _LOWER[data] if lower else data
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each place on
    sizes = ends - starts
    out = _SIZE_MIX[sizes] if len(sizes) and sizes.max() < len(_SIZE_MIX) else mix(sizes.astype(np.uint64) + _SIZE_SALT)
    todo, at, left = slice(None), starts, sizes  # all at first: empty ranges stay as they are
    while len(left):
        block = eight[at]
        block &= _MASKS[np.minimum(left, 8)]
        block ^= out[todo] * np.uint64(_STEP[0])
        out[todo] = np.where(left > 0, mix(block), out[todo]) if isinstance(todo, slice) and left.min() == 0 else mix(block)
        more = np.flatnonzero(left > 8)
        todo = more if isinstance(todo, slice) else todo[more]
        at, left = at[more] + 8, left[more] - 8
    return out


@dataclass
class Words:
    """The words of a group of texts: byte ranges, hashes, and bounds of each text in the word arrays."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


def words(texts: Texts, table: np.ndarray, lower: bool, hasher: Hasher | None = None) -> Words:
    starts, ends = runs(table[texts.data], texts.bounds)
    hasher = hasher or Hasher(texts.data, lower)
    return Words(starts, ends, hasher(starts, ends), np.searchsorted(starts, texts.bounds))


def owner(bounds: np.ndarray) -> np.ndarray:
    """For each element its segment."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


_STEP = [int(x) | 1 for x in mix(np.arange(11, 11 + 64, dtype=np.uint64))]


def shingles(hashes: np.ndarray, bounds: np.ndarray, k: int, whole: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive elements in each segment, and the bounds; whole: a shorter segment that isn't empty is one shingle.

    A whole short segment mixes in its length, so that it equals no other shingle.
    """
    counts = np.diff(bounds)
    full = np.maximum(counts - k + 1, 0)
    at = np.repeat(bounds[:-1] - (np.cumsum(full) - full), full) + np.arange(int(full.sum()))
    out = np.zeros(len(at), np.uint64)
    for i in range(k):
        out += hashes[at + i] * np.uint64(_STEP[i])
    out, to = mix(out), np.concatenate([[0], np.cumsum(full)])
    short = np.flatnonzero((counts > 0) & (counts < k)) if whole else []
    if len(short):
        extra = np.zeros(len(short), np.uint64)
        for i in range(k - 1):
            has = counts[short] > i
            extra[has] += hashes[bounds[short[has]] + i] * np.uint64(_STEP[i])
        out = np.insert(out, to[short], mix(extra + counts[short].astype(np.uint64) * np.uint64(_STEP[k])))
        full = full.copy()
        full[short] = 1
        to = np.concatenate([[0], np.cumsum(full)])
    return out, to


def distinct(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of each segment in ascending order, and the bounds."""
    own = owner(bounds)
    order = np.lexsort((hashes, own))
    hashes = hashes[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (own[1:] != own[:-1])
    return hashes[new], np.concatenate([[0], np.cumsum(np.bincount(own[new], minlength=len(bounds) - 1))])


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def per_text(member: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums over the segments."""
    sums = np.concatenate([[0], np.cumsum(member, dtype=np.int64)])
    return sums[bounds[1:]] - sums[bounds[:-1]]
