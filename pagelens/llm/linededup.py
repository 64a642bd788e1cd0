"""Line dedup as an exact set-similarity join.

A line's tokens are its words (lower-cased A-Z, split at white space), as a set. Two lines match if the
Jaccard similarity of their token sets is at least `percent` hundredths. A line is removed if it matches any earlier line of the corpus, in
the order of key (rows without one first), hash of the text and line number, whether or not that one is removed itself.

1. One pass counts the occurrences of every token over the whole corpus, in a fixed number of hash buckets, and numbers all lines. The rarity so
   found orders the tokens; any fixed order gives the same result, a good one gives few candidates.
2. Lines with the same tokens are one record with its first place; all its later places go.
3. Prefix filter: of n tokens, the n - ceil(t n) + 1 rarest have to share one with a match. They meet by token; length, positional and signature
   bounds prune, and of what remains a spanning forest is kept, never all pairs. A signature has a parity bit for each of 64 to 512 parts
   of the token space (more for longer lines), so sets differ in at least as many tokens as signatures in bits. The token space is cut into parts of
   bounded size; a token too frequent for a part is a group of its own, cut into blocks (see groups.forest).
4. In each group of records so joined, every record is verified against the earlier ones on full sets by counting common tokens. Large groups are
   cut into blocks; what no earlier record of its block matches is then held against all of the group.

Defined cases: a null or empty text stays as it is; a line without words stays; rows with the same key and text are one document, and the same
lines go from each; rows that share a key only are documents of their own; rows without a key are documents too; a text or line may have any length; an
empty table gives an empty result; other columns pass through, whatever their names, but n_lines and n_removed are replaced where counts are asked for.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import groups, shared
from . import text as X
from .quality import lines as line_bounds

#: Hash buckets of the rarity table (four bytes each, whatever the corpus), and ranges that are summed together.
RARITY_BUCKETS = 1 << 20
_RANGES = 64
_WORD = re.compile(r"[^\x20\x09-\x0D]")
_RANK_BITS, _HASH_BITS = 14, 32
#: Records, and tokens, of a block of a group that is verified.
BLOCK_RECORDS, BLOCK_TOKENS = 512, 1_000_000
#: Up to so many records of a token, all pairs within the length bound are tried at once.
SMALL_GROUP = 512
#: Bytes of a part of the token space, and what a token's occurrence sends into it at most, on average.
PART_BYTES, _SENT_BYTES = 32 << 20, 10
#: Tokens that occur more often don't go to a part; so many records of one token are a block, and larger groups are cut.
FREQUENT, FREQUENT_BLOCK = 1_000_000, 8192


def tokens(texts: X.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes of all lines that have words, their bounds, and each line's text and number in its text."""
    first, last = X.runs(X.NOT_SPACE[texts.data], texts.bounds)
    starts, ends, own = line_bounds(texts)
    bounds = np.append(np.searchsorted(first, starts), len(first))
    has = np.flatnonzero(np.diff(bounds) > 0)
    number = np.arange(len(own)) - np.searchsorted(own, own)
    return X.block_hashes(texts.data, first, last, lower=True), np.append(bounds[has], bounds[-1]), own[has], number[has]


def survey(docs: DataFrame) -> DataFrame:
    """The one pass that counts and numbers: part, counts (occurrences of tokens by hash bucket, a row for each range of buckets and task) or
    record, id, th, line (every line with words). A record is a line's tokens with their multiplicity. docs: see identified."""
    width = RARITY_BUCKETS // _RANGES
    names = ["part", "counts", "record", "id", "th", "line"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, any_row = np.zeros(RARITY_BUCKETS, np.int64), False
        held, n_held = [], 0  # buckets that aren't counted yet: each count passes over the whole table
        for batch in batches:
            ids, th = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for group in X.chunked(batch.column(2)):
                any_row = True
                hashes, bounds, own, number = tokens(group)
                held.append((hashes % np.uint64(RARITY_BUCKETS)).astype(np.int32))
                n_held += len(hashes)
                if n_held >= 2 * RARITY_BUCKETS:
                    counts += np.bincount(np.concatenate(held), minlength=RARITY_BUCKETS)
                    held, n_held = [], 0
                n, at = len(own), group.first + own
                columns = [_records(hashes, bounds).view(np.int64), ids[at], th[at], number.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), *map(pa.array, columns)], names=names)
        if any_row:
            counts += np.bincount(np.concatenate(held or [np.zeros(0, np.int32)]), minlength=RARITY_BUCKETS)
            blobs = [counts[i * width : (i + 1) * width].tobytes() for i in range(_RANGES)]
            none = [pa.nulls(_RANGES, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(_RANGES)), pa.array(blobs, pa.binary()), *none], names=names)

    return docs.mapInArrow(run, "part long, counts binary, record long, id long, th long, line int")


def identified(docs: DataFrame, key: str, text: str, *more: Column) -> DataFrame:
    """id (the key, or the smallest long without one), th (hash of the text), text and more. Rows with the same id and th are the same document."""
    return docs.select(F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("id"), F.xxhash64(text).alias("th"), F.col(text).alias("text"), *more)


def occurrences(surveyed: DataFrame) -> np.ndarray:
    """Occurrences of tokens by hash bucket over the whole corpus."""
    width = RARITY_BUCKETS // _RANGES

    def add(t: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.int64) for x in t.column("counts").to_pylist())
        return pa.table({"part": t.column("part").slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})

    parts = surveyed.where("part IS NOT NULL").select("part", "counts").groupBy("part").applyInArrow(add, "part long, counts binary").collect()
    whole = np.zeros(RARITY_BUCKETS, np.int64)
    for part, counts in parts:
        whole[part * width : (part + 1) * width] = np.frombuffer(counts, np.int64)
    return whole


def rarity(counts: np.ndarray) -> np.ndarray:
    """Logarithmic ranks of counts, that fit in _RANK_BITS; they grow with the counts."""
    top = (1 << _RANK_BITS) - 1
    return np.minimum(top, np.round(np.log2(1 + counts) * 256)).astype(np.uint16)


def ranked(hashes: np.ndarray, bounds: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct tokens of each line as short ids in the order of rarity and full hash, and the bounds.

    An id is rank and 32 hash bits. Ids of different tokens may clash, also in one line, where both stay: that adds candidates and loses none."""
    own = X.owner(bounds).astype(np.uint64)
    ids = (own << np.uint64(_RANK_BITS + _HASH_BITS)) | (rank[(hashes % np.uint64(RARITY_BUCKETS)).astype(np.int64)].astype(np.uint64) << np.uint64(_HASH_BITS)) | (hashes >> np.uint64(64 - _HASH_BITS))
    order = np.argsort(ids)
    same = ids[order[1:]] == ids[order[:-1]]
    if (same & (hashes[order[1:]] != hashes[order[:-1]])).any():
        order = np.lexsort((hashes, ids))
    ids, hashes = ids[order], hashes[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (hashes[1:] != hashes[:-1])
    ids = ids[new]
    own = (ids >> np.uint64(_RANK_BITS + _HASH_BITS)).astype(np.int64)
    return ids & np.uint64((1 << (_RANK_BITS + _HASH_BITS)) - 1), np.searchsorted(own, np.arange(len(bounds)))


#: A line number in a group has 64 - 46 bits.
_MOST_LINES = 1 << (64 - _RANK_BITS - _HASH_BITS)


def _line_groups(batch: pa.RecordBatch, at: int) -> Iterator[tuple[X.Texts, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    for group in X.chunked(batch.column(at)):
        hashes, bounds, own, number = tokens(group)
        for a in range(0, len(own), _MOST_LINES):
            b = min(a + _MOST_LINES, len(own))
            yield group, hashes[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], own[a:b], number[a:b]


def _records(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A hash of each line's tokens with their multiplicity."""
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(X.mix(hashes + np.uint64(5)), out=sums[1:])
    return X.mix(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64))


#: Most words of a signature, and the numbers of tokens up to which one, two or four do.
_SIG_WORDS, _SIG_UPTO = 8, np.array([80, 170, 360])


def _widths(n: np.ndarray) -> np.ndarray:
    return 1 << np.searchsorted(_SIG_UPTO, n)


def _signatures(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """512 parities of each line's distinct tokens, by the top hash bits of their ids, folded to the width for their number (rest 0)."""
    own = X.owner(bounds)
    part = (ids >> np.uint64(_HASH_BITS - 9)).astype(np.int64) & 511
    part %= 64 * _widths(np.diff(bounds))[own]
    out = np.zeros((len(bounds) - 1) * _SIG_WORDS, np.uint64)
    np.bitwise_xor.at(out, own * _SIG_WORDS + part // 64, np.uint64(1) << (part % 64).astype(np.uint64))
    return out.reshape(-1, _SIG_WORDS)


def _wide(words: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Signatures as rows of all words, from the words of all and where each begins."""
    out, width = np.zeros((len(n), _SIG_WORDS), np.uint64), _widths(n)
    for x in range(_SIG_WORDS):
        has = width > x
        out[has, x] = words[at[has] + x]
    return out


def _pack(token: np.ndarray, set_: np.ndarray, sig: np.ndarray, n: np.ndarray, pos: np.ndarray) -> bytes:
    """Records as bytes: tokens in the six bytes that they need, sets, numbers in two bytes where they fit (first byte 2, else 4), and signatures
    in their widths. The first eight bytes after the width are the number of records."""
    width = 2 if not len(n) or n.max() < 1 << 16 else 4
    small = token.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
    sig = sig[np.arange(_SIG_WORDS) < _widths(n)[:, None]]
    return bytes([width]) + len(n).to_bytes(8, "little") + small + set_.astype("<u8").tobytes() + n.astype(f"<u{width}").tobytes() + pos.astype(f"<u{width}").tobytes() + sig.astype("<u8").tobytes()


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, sets, numbers, places, and the words of all signatures one after the other."""
    width, m = data[0], int.from_bytes(data[1:9], "little")
    token = np.zeros((m, 8), np.uint8)
    token[:, :6] = np.frombuffer(data, np.uint8, 6 * m, 9).reshape(m, 6)
    set_ = np.frombuffer(data, "<u8", m, 9 + 6 * m)
    n, pos = (np.frombuffer(data, f"<u{width}", m, 9 + (14 + i * width) * m).astype(np.int64) for i in range(2))
    return token.reshape(-1).view("<u8"), set_, n, pos, np.frombuffer(data, "<u8", -1, 9 + (14 + 2 * width) * m)


def prefixes(docs: DataFrame, rank, percent: int, parts: int, frequent: int) -> DataFrame:
    """part, records: prefix tokens of all sets that may match another set, packed by part of the token space; those of tokens whose rank is at
    least `frequent` have negative parts, one for each record batch of a task. rank: a broadcast of the ranks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sigs, n_held, n_lines = [], [], 0, 0
        apart = -1 - (TaskContext.get().partitionId() << 32)
        for batch in batches:
            for _, hashes, bounds, _, _ in _line_groups(batch, 0):
                ids, to = ranked(hashes, bounds, rank.value)
                n = np.diff(to)
                sets = _records(hashes, bounds)
                _, first = np.unique(sets, return_index=True)
                length = n[first] - -(-percent * n[first] // 100) + 1
                which = np.repeat(first, length)
                pos = np.arange(len(which)) - np.repeat(np.cumsum(length) - length, length)
                held.append((ids[to[which] + pos], sets[which], n_lines + which, n[which], pos))
                sigs.append(_signatures(ids, to))
                n_lines += len(n)
                n_held += len(which)
                if n_held >= 4096 * parts or n_held >= 2_000_000:
                    yield flush(held, np.concatenate(sigs), apart)
                    held, sigs, n_held, n_lines, apart = [], [], 0, 0, apart - 1
        if n_held:
            yield flush(held, np.concatenate(sigs), apart)

    def flush(held: list[tuple], sigs: np.ndarray, apart: int) -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*held, strict=True)]
        order = np.lexsort((columns[4], columns[1]))  # a record that stands in several texts is sent once
        same = np.zeros(len(order), bool)
        same[1:] = (columns[1][order[1:]] == columns[1][order[:-1]]) & (columns[4][order[1:]] == columns[4][order[:-1]])
        columns = [c[order[~same]] for c in columns]
        part = (X.mix(columns[0]) % np.uint64(parts)).astype(np.int64)
        part[columns[0] >> np.uint64(_HASH_BITS) >= np.uint64(frequent)] = apart
        order = np.argsort(part, kind="stable")
        columns, part = [c[order] for c in columns], part[order]
        found, at = np.unique(part, return_index=True)
        ends = [*at[1:].tolist(), len(part)]
        token, set_, line, n, pos = columns
        packed = [_pack(token[a:b], set_[a:b], sigs[line[a:b]], n[a:b], pos[a:b]) for a, b in zip(at.tolist(), ends, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(found), pa.array(packed, pa.binary())], names=["part", "records"])

    return docs.select("text").mapInArrow(run, "part long, records binary")


def _unpacked(packed: DataFrame) -> DataFrame:
    """group (token), node (set), size (its tokens), signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                token, set_, n, _, words = _unpack(data.as_py())
                ends = 8 * np.cumsum(_widths(n))
                raw = words.tobytes()
                sigs = [raw[a:b] for a, b in zip((ends - 8 * _widths(n)).tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(set_.view(np.int64)), pa.array(n), pa.array(sigs, pa.binary())], names=["group", "node", "size", "signature"])

    return packed.select("records").mapInArrow(run, "group long, node long, size long, signature binary")


class _Pairs:
    """Bounds on pairs of records: numbers of tokens, places of the shared token (None: unknown) and signatures (words of all, and where each begins)."""

    def __init__(self, percent: int, n: np.ndarray, pos: np.ndarray | None, words: np.ndarray, at: np.ndarray):
        self.percent, self.n, self.pos, self.words, self.at, self.width = percent, n, pos, words, at, _widths(n)

    def _folded(self, i: np.ndarray, to: int, x: int) -> np.ndarray:
        out = self.words[self.at[i] + x]
        for y in range(x + to, int(self.width[i].max()), to):
            more = self.width[i] > y
            out[more] ^= self.words[self.at[i[more]] + y]
        return out

    def fit(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which of the pairs i, j may match."""
        n, percent = self.n, self.percent
        need = -(-percent * (n[i] + n[j]) // (100 + percent))
        ok = 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
        if self.pos is not None:
            ok &= np.minimum(self.pos[i], self.pos[j]) + np.minimum(n[i] - self.pos[i], n[j] - self.pos[j]) >= need
        least = np.minimum(self.width[i], self.width[j])
        for to in (1, 2, 4, 8):
            at = np.flatnonzero(ok & (least == to))
            if len(at):
                differ = sum(np.bitwise_count(self._folded(i[at], to, x) ^ self._folded(j[at], to, x)).astype(np.int64) for x in range(to))
                ok[at] = differ <= n[i[at]] + n[j[at]] - 2 * need[at]
        return ok

    def spread(self, a: int, b: int, label: np.ndarray) -> tuple[list[int], list[int]]:
        """Links that join the labels of the records a to b (in order of n) as far as pairs fit; pairs of one label are skipped."""
        left, right, n = [], [], self.n[a:b]
        names, own, count = np.unique(label[a:b], return_inverse=True, return_counts=True)
        label = own.copy()
        for i in np.flatnonzero(own != count.argmax()).tolist() if len(names) > 1 else []:
            lo, hi = np.searchsorted(n, -(-self.percent * n[i] // 100)), np.searchsorted(n, 100 * n[i] // self.percent, "right")
            todo = np.flatnonzero(label[lo:hi] != label[i]) + lo
            ok = todo[self.fit(np.full(len(todo), a + i), a + todo)] if len(todo) else todo
            if len(ok):
                others, first = np.unique(label[ok], return_index=True)
                left += [a + i] * len(others)
                right += (a + ok[first]).tolist()
                label[np.isin(label, others)] = label[i]
        return left, right


def _meet(percent: int):
    """Spanning forest (a, b) of the sets that share a prefix token within the length and positional bounds. Records of frequent tokens pass through, as do
    those of tokens with more records than a block."""

    def work(t: pa.Table) -> pa.Table | None:
        if t.column("part")[0].as_py() < 0:
            none = pa.nulls(t.num_rows, pa.int64())
            return pa.table({"a": none, "b": none, "records": t.column("records")})
        *columns, words = [np.concatenate(c) for c in zip(*[_unpack(x.as_py()) for x in t.column("records")], strict=True)]
        columns.append(np.cumsum(_widths(columns[2])) - _widths(columns[2]))  # where each record's signature begins
        order = np.argsort(columns[0])  # the token's records are few; only those of shared tokens go on
        same = np.zeros(len(order), bool)
        same[1:] = columns[0][order[1:]] == columns[0][order[:-1]]
        same[:-1] |= same[1:]
        columns = [c[order[same]] for c in columns]
        order = np.lexsort((columns[3], columns[1], columns[2], columns[0]))
        token, set_, n, pos, sig = (c[order] for c in columns)
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (set_[1:] != set_[:-1]) | (pos[1:] != pos[:-1])
        token, set_, n, pos, sig = token[new], set_[new], n[new], pos[new], sig[new]
        if not len(token):
            return None
        ends = np.append(np.flatnonzero(token[1:] != token[:-1]) + 1, len(token))
        size = np.diff(np.concatenate([[0], ends]))
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        pairs = _Pairs(percent, n, pos, words, sig)

        # within a token records stand by length, so that those within the length bound follow each other
        end_of = np.repeat(ends, size)
        at, step = np.flatnonzero(np.repeat(size <= SMALL_GROUP, size)), 1
        while True:
            at = at[at + step < end_of[at]]
            at = at[100 * n[at] >= percent * n[at + step]]
            if not len(at):
                break
            ok = at[pairs.fit(at, at + step)]
            left.append(ok)
            right.append(ok + step)
            step += 1
        passed = []
        for g in np.flatnonzero(size > SMALL_GROUP).tolist():
            a, b = int(ends[g] - size[g]), int(ends[g])
            if b - a > FREQUENT_BLOCK:
                passed += [_pack(token[i:j], set_[i:j], _wide(words, sig[i:j], n[i:j]), n[i:j], pos[i:j]) for i, j in ((i, min(i + FREQUENT_BLOCK, b)) for i in range(a, b, FREQUENT_BLOCK))]
                continue
            a, b = pairs.spread(a, b, set_)
            left.append(np.array(a, np.int64))
            right.append(np.array(b, np.int64))
        left, right = np.concatenate(left), np.concatenate(right)
        apart = set_[left] != set_[right]
        left, right = left[apart], right[apart]
        nodes, ends_of_pairs = np.unique(set_[np.concatenate([left, right])], return_inverse=True)
        root = groups.roots(len(nodes), ends_of_pairs[: len(left)], ends_of_pairs[len(left) :])
        far = np.flatnonzero(root != np.arange(len(nodes)))
        link, none = [nodes[far].view(np.int64), nodes[root[far]].view(np.int64)], pa.nulls(len(passed), pa.int64())
        columns = [pa.concat_arrays([pa.array(x, pa.int64()), none]) for x in link]
        records = pa.concat_arrays([pa.nulls(len(far), pa.binary()), pa.array(passed, pa.binary())])
        return pa.table({"a": columns[0], "b": columns[1], "records": records}) if len(records) else None

    return work


def _meet_block(percent: int):
    """The same for a block of a frequent token's sets, without the positional bound."""

    def work(t: pa.Table) -> pa.Table | None:
        node, n = t.column("node").to_numpy(), t.column("size").to_numpy()
        _, first = np.unique(node, return_index=True)
        order = first[np.argsort(n[first], kind="stable")]
        node, n = node[order], n[order]
        packed = t.column("signature").to_pylist()
        words = np.frombuffer(b"".join(packed[i] for i in order.tolist()), np.uint64)
        pairs = _Pairs(percent, n, None, words, np.cumsum(_widths(n)) - _widths(n))
        a, b = pairs.spread(0, len(n), t.column("component").to_numpy()[order])
        return pa.table({"a": node[a], "b": node[b]}) if a else None

    return work


def _verify(percent: int):
    """The records of a group that match an earlier one; of records with known true, only whether others match them matters."""

    def work(t: pa.Table) -> pa.Table | None:
        sets, known = t.column("set_id").to_numpy(), t.column("known").to_numpy()
        order = np.lexsort([t.column(c).to_numpy() for c in ("line", "th", "id")])
        _, first = np.unique(sets[order], return_index=True)
        order = order[np.sort(first)]
        packed = t.column("tokens").to_pylist()
        size = np.array([len(packed[row]) // 8 for row in order.tolist()], np.int64)
        to = np.concatenate([[0], np.cumsum(size)])
        _, token = np.unique(np.frombuffer(b"".join(packed[row] for row in order.tolist()), np.uint64), return_inverse=True)
        by_token = np.argsort(token, kind="stable")  # a token's records stand in their order, so those before a place are earlier
        holder = np.repeat(np.arange(len(order)), size)[by_token]
        place = np.empty(len(token), np.int64)
        place[by_token] = np.arange(len(token))
        counts = np.bincount(token)
        first = (np.cumsum(counts) - counts)[token]
        hit = []
        for i, row in enumerate(order.tolist()):
            if not known[row]:
                lo = first[to[i] : to[i + 1]]
                n = place[to[i] : to[i + 1]] - lo
                earlier = holder[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(int(n.sum()))]
                common = np.bincount(earlier, minlength=i)
                if (100 * common >= percent * (size[:i] + size[i] - common)).any():
                    hit.append(sets[row])
        return pa.table({"set_id": pa.array(hit, pa.int64())}) if hit else None

    return work


def _tokens_of(docs: DataFrame) -> DataFrame:
    """component, set_id, id, th, line and tokens of the wanted lines. docs: id, th, text and wanted (array of structs line, set_id, component)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, th, wanted = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3)
            for group in X.chunked(batch.column(2)):
                hashes, bounds, own, number = tokens(group)
                values, to = X.distinct(hashes, bounds)
                at = {(o, m): i for i, (o, m) in enumerate(zip(own.tolist(), number.tolist(), strict=True))}
                rows = []
                for r in range(len(group)):
                    for w in wanted[group.first + r].as_py():
                        i = at[r, w["line"]]
                        rows.append((w["component"], w["set_id"], ids[group.first + r], th[group.first + r], w["line"], values[to[i] : to[i + 1]].tobytes()))
                if rows:
                    kinds = [*[pa.int64()] * 4, pa.int32(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["component", "set_id", "id", "th", "line", "tokens"])

    return docs.select("id", "th", "text", "wanted").mapInArrow(run, "component long, set_id long, id long, th long, line int, tokens binary")


def _near(full: DataFrame, percent: int) -> DataFrame:
    """set_id of the records that match an earlier one of their component."""
    blocks = lambda n, w: F.greatest(F.ceil(F.col(n) / BLOCK_RECORDS), F.ceil(F.col(w) / (8 * BLOCK_TOKENS)))
    weigh = [F.count("*").alias("n"), F.sum(F.octet_length("tokens").cast("long")).alias("w")]
    sizes = shared.written(full.groupBy("component").agg(*weigh), "component-sizes")
    large = sizes.where(blocks("n", "w") > 1)

    def verified(dealt: DataFrame) -> DataFrame:
        return shared.written(groups.each(dealt.select("task", "set_id", "id", "th", "line", "known", "tokens"), "task", _verify(percent), "set_id long").distinct(), "near-lines")

    near = verified(groups.in_blocks(full.withColumn("known", F.lit(False)), "component", sizes, blocks("n", "w"), F.col("set_id")))
    if not large.limit(1).count():
        return near
    marked = full.join(large.select("component"), "component", "left_semi").join(near.withColumn("known", F.lit(True)), "set_id", "left").withColumn("known", F.coalesce("known", F.lit(False)))
    rest = marked.where(~F.col("known")).groupBy("component").agg(*[w.alias(n) for w, n in zip(weigh, ("rn", "rw"), strict=True)])
    both = shared.written(large.join(rest, "component"), "undecided-sizes")
    return near.union(verified(groups.against_all(marked, "component", ~F.col("known"), both, blocks("n", "w"), blocks("rn", "rw"), F.col("set_id"))))


def removed(plain: DataFrame, percent: int = 80) -> DataFrame:
    """id, th and lines (array of the numbers of lines to remove), for documents with any. plain: see identified."""
    spark = plain.sparkSession
    surveyed = shared.written(survey(plain.select("id", "th", "text")), "line-survey")
    counts = occurrences(surveyed)
    place = F.struct("id", "th", "line")
    at = surveyed.where("part IS NULL").select(F.col("record").alias("set_id"), "id", "th", "line")
    firsts = shared.written(at.groupBy("set_id").agg(F.min(place).alias("first"), F.count("*").alias("n")), "line-sets")

    parts = max(16, -(-int(counts.sum()) * _SENT_BYTES // PART_BYTES))
    sent = spark.sparkContext.broadcast(rarity(counts))
    packed = prefixes(plain, sent, percent, parts, int(rarity(np.array([FREQUENT]))[0]))  # goes through its shuffle only once and into no table
    met = shared.written(groups.each(packed, "part", _meet(percent), "a long, b long, records binary", parts), "met", "lz4")
    sent.destroy()
    frequent, met = met.where("records IS NOT NULL"), met.where("records IS NULL").select("a", "b")
    if frequent.limit(1).count():
        rows = shared.written(_unpacked(frequent).distinct(), "frequent-tokens")
        nodes = rows.select("node", "size", "signature").dropDuplicates(["node"])
        met = met.union(groups.forest(rows.select("group", "node", F.lit(0).cast("long").alias("weight")).distinct(), nodes, _meet_block(percent), FREQUENT_BLOCK, 1))
    loose = shared.written(groups.components(met), "line-groups").select(F.col("node").alias("set_id"), "component")
    wanted = loose.join(firsts, "set_id").select("first.id", "first.th", F.struct("first.line", "set_id", "component").alias("w")).groupBy("id", "th").agg(F.collect_list("w").alias("wanted"))
    wanted = shared.written(wanted, "wanted-lines")
    texts = groups.filtered(plain.select("id", "th", "text"), "th", groups.key_filter(wanted.select("th")), True)
    full = _tokens_of(texts.join(wanted.hint("merge"), ["id", "th"])).dropDuplicates(["set_id"])
    near = _near(shared.written(full, "line-tokens", "lz4"), percent).distinct()

    near = near.withColumn("near", F.lit(True))
    known = shared.written(firsts.join(near, "set_id", "left").where((F.col("n") > 1) | F.col("near")).select("set_id", "near", "first"), "known-lines")
    gone = at.join(known, "set_id").where(F.col("near") | (place != F.col("first")))
    return gone.groupBy("id", "th").agg(F.collect_set("line").alias("lines"))


def _cut(schema: T.StructType, text_at: int, drop_emptied: bool):
    """From rows of (doc, lines) the columns of doc without these lines of its text, n_lines and n_removed."""
    kind = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, texts, n_lines, n_removed = batch.column(0), [], [], []
            columns = doc.flatten()
            for text, lines in zip(columns[text_at].to_pylist(), batch.column(1).to_pylist(), strict=True):
                parts, gone = (text or "").split("\n"), set(lines or ())
                n_lines.append(0 if text is None else len(parts))
                n_removed.append(len(gone))
                texts.append("\n".join(p for i, p in enumerate(parts) if i not in gone) if gone else text)
            columns[text_at] = pa.array(texts, kind.field(text_at).type)
            out = pa.RecordBatch.from_arrays([*columns, pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64())], names=[f.name for f in schema])
            if drop_emptied:
                left = [not gone or _WORD.search(t) is not None for t, gone in zip(texts, n_removed, strict=True)]
                out = out.filter(pa.array(left, pa.bool_()))
            yield out

    return run


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80, counts: bool = False, drop_emptied: bool = False) -> DataFrame:
    """The documents with matching later lines taken out of the text, with all columns; with counts, n_lines and n_removed are added.

    drop_emptied: a document that had words and has none left goes. A document's lines are those between line feeds."""
    added = ["n_lines", "n_removed"] if counts else []
    names = [c for c in docs.columns if c not in added]
    numbered = [T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(names)]
    doc = F.struct(*[F.col(f"`{c}`").alias(f.name) for c, f in zip(names, numbered, strict=True)]).alias("doc")
    with shared.scratch(docs.sparkSession):
        gone = shared.written(removed(identified(docs, key, text), percent), "removed-lines", outlive=True)
    whole = identified(docs, key, text, doc).drop("text")
    bits = groups.key_filter(gone.select("th"))
    out = T.StructType([*numbered, T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType())])
    touched = groups.filtered(whole, "th", bits, True).join(gone.hint("merge"), ["id", "th"], "left").select("doc", "lines")
    touched = touched.mapInArrow(_cut(out, names.index(text), drop_emptied), out)
    own = F.col(f"doc.c{names.index(text)}")
    n_lines = F.coalesce(F.length(own) - F.length(F.translate(own, "\n", "")) + 1, F.lit(0)).cast("long") if counts else F.lit(0).cast("long")
    untouched = groups.filtered(whole, "th", bits, False).select("doc.*", n_lines.alias("n_lines"), F.lit(0).cast("long").alias("n_removed"))
    both = touched.union(untouched)
    return both.select(*[F.col(f.name).alias(c) for f, c in zip(numbered, names, strict=True)], *added)
