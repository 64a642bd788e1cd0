"""Suffix-array dedup: removal of every byte covered by a string of `length` bytes that also starts elsewhere.

1. Every window of `length` bytes picks an anchor: the leftmost of the smallest hashed grams inside it. Equal windows pick equal grams, so
   only windows of the same gram can be equal. A run of windows with one anchor is a segment.
2. Segments of grams that occur once are done. Segments with the same bytes are one variant: with two places or more all its windows repeat.
3. Grams with several variants go to shards; a shard's variants are joined to one string, and external induced sorting (see suffixes) gives
   the order of its suffixes with common-prefix values. A window repeats if it shares `length` bytes with a neighbour in that order.
   Shards are several times as large as what the sorting holds in memory. The variants of a gram with very many of them would fit no shard, and meet
   in pairs of shards only; their windows are counted by hash instead, each sent once.
4. The repeated windows of a variant hold for all its places; each text loses the union of their bytes.

Texts are UTF-8 bytes; matches never cross texts; all windows are judged on the input.

Defined cases: a null text counts as empty; texts shorter than `length` lose nothing; rows that repeat a key, or have none, are places of their own, so
that they lose what they share; a text of any length is handled in pieces that overlap; there are no ties: all places of a string lose it; an empty
table gives an empty result; columns beside key and text are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import groups, shared, suffixes
from . import text as X

GRAM = 64
#: Bytes of variants in a shard (on average), and variants of one gram up to which they go to a shard.
SHARD_BYTES = 1_500_000
MOST_VARIANTS = 4096
#: Longer texts are handled in pieces that overlap by a window.
PIECE = 1 << 18
_POS_BITS = 22
#: An odd multiplier of the hash of grams, which only proposes what is compared.
_JOIN = 0x9E3779B97F4A7C15


def _pieces(batch_column, length: int) -> Iterator[tuple[X.Texts, np.ndarray, np.ndarray]]:
    """Groups of texts, each text's row and the offset of its first byte."""
    for group in X.chunked(batch_column, PIECE):
        n = len(group.data)
        if len(group) > 1 or n <= 2 * PIECE:
            yield group, group.first + np.arange(len(group)), np.zeros(len(group), np.int64)
        else:
            for at in range(0, n - length + 1, PIECE):
                part = group.data[at : at + PIECE + length - 1]
                yield X.Texts(part, np.array([0, len(part)]), group.first), np.array([group.first]), np.array([at])


def _grams(data: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all strings of `size` bytes: those of half the size are joined, down to words of eight bytes (or to single ones)."""
    width = 8 if size >= 8 else 1
    h = np.ndarray((len(data) - width + 1,), np.uint64 if width == 8 else np.uint8, np.ascontiguousarray(data), strides=(1,)).astype(np.uint64)
    while width < size:
        step = min(width, size - width)
        left = h[:-step] * np.uint64(_JOIN)
        left ^= left >> np.uint64(32)
        left += h[step:]
        h, width = left, width + step
    h *= np.uint64(_JOIN)
    h ^= h >> np.uint64(32)
    h *= np.uint64(_JOIN)
    return h


def segments(texts: X.Texts, length: int) -> tuple[np.ndarray, ...]:
    """text, first window, windows, hash of the anchor's gram, hash of the segment's bytes and anchor."""
    size = min(GRAM, length)
    n, grams = len(texts.data), length - size + 1
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none, none
    keys = _grams(texts.data, size)
    low = np.uint64((1 << _POS_BITS) - 1)
    least = keys & ~low
    least |= np.arange(len(keys), dtype=np.uint64)
    width = 1
    while width < grams:
        step = min(width, grams - width)
        least, width = np.minimum(least[:-step], least[step:]), width + step
    m = n - length + 1
    edges = np.zeros(m + 1, np.int8)
    begin, end = texts.bounds[:-1], texts.bounds[1:] - length + 1
    long_enough = end > begin
    edges[begin[long_enough]] += 1
    edges[end[long_enough]] -= 1
    inside = np.cumsum(edges, dtype=np.int8).astype(bool)  # windows that lie in one text; the last element is a guard
    other = least[1:] != least[:-1]  # anchors are positions, so texts that meet differ too
    start = np.flatnonzero(inside[:-1] & np.concatenate([[True], other | ~inside[: m - 1]]))
    stop = np.flatnonzero(inside[:-1] & np.concatenate([other | ~inside[1:m], [True]])) + 1
    anchor = (least[start] & low).astype(np.int64)
    body = X.Hasher(texts.data)(start, stop - 1 + length)
    own = np.searchsorted(texts.bounds, start, "right") - 1
    return own, start - texts.bounds[own], stop - start, keys[anchor], X.mix(body ^ X.mix((anchor - start).astype(np.uint64)))


def anchors(docs: DataFrame, length: int) -> DataFrame:
    """gram, variant, id, th, first, n of every segment. docs: id, th and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, th = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for group, rows, offsets in _pieces(batch.column(2), length):
                own, first, n, gram, variant = segments(group, length)
                if len(own):
                    at = rows[own]
                    columns = [gram.view(np.int64), variant.view(np.int64), ids[at], th[at], offsets[own] + first, n.astype(np.int32)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["gram", "variant", "id", "th", "first", "n"])

    return docs.mapInArrow(run, "gram long, variant long, id long, th long, first long, n int")


def _bytes_of(docs: DataFrame, length: int) -> DataFrame:
    """gram, variant, variants, bytes of the wanted segments. docs: text and wanted (array of structs gram, variant, variants, first, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                part = batch.slice(start, 128)
                out = []
                for t, wanted in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    data = t.encode()
                    out += [(w["gram"], w["variant"], w["variants"], data[w["first"] : w["first"] + w["n"] - 1 + length]) for w in wanted]
                if out:
                    kinds = [*[pa.int64()] * 3, pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["gram", "variant", "variants", "bytes"])

    return docs.select("text", "wanted").mapInArrow(run, "gram long, variant long, variants long, bytes binary")


def _windows_of(bodies: DataFrame, length: int) -> DataFrame:
    """gram, variant, a, b, hash of every window of some variants."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for gram, variant, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = np.frombuffer(body, np.uint8)
                at = np.arange(len(data) - length + 1)
                columns = [np.full(len(at), gram), np.full(len(at), variant), at.astype(np.int32), at.astype(np.int32) + 1, X.Hasher(data)(at, at + length).view(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["gram", "variant", "a", "b", "window"])

    return bodies.select("gram", "variant", "bytes").mapInArrow(run, "gram long, variant long, a int, b int, window long")


def _sorted_shard(length: int):
    """gram, variant, a, b: runs of windows of the shard's variants that another place in the shard equals."""

    def work(t: pa.Table) -> pa.Table | None:
        gram, variant = t.column("gram").to_numpy(), t.column("variant").to_numpy()
        order = np.lexsort((variant, gram))
        new = np.ones(len(order), bool)
        new[1:] = (gram[order[1:]] != gram[order[:-1]]) | (variant[order[1:]] != variant[order[:-1]])
        order = order[new]
        bodies = t.column("bytes").to_pylist()
        parts = [np.frombuffer(bodies[i], np.uint8) for i in order]
        sizes = np.array([len(p) + 1 for p in parts])
        starts = np.cumsum(sizes) - sizes
        joined = suffixes.Store().array(int(sizes.sum()) + 1, np.int16)
        for s, p in zip(starts.tolist(), parts, strict=True):
            joined[s : s + len(p)] = p
            joined[s : s + len(p)] += 2
            joined[s + len(p)] = 1
        suffix, common = suffixes.order(joined, length)
        twice = np.zeros(len(joined), bool)
        equal = common >= length
        twice[suffix[equal]] = True
        twice[suffix[np.flatnonzero(equal) - 1]] = True
        twice[np.repeat(starts + sizes - length, length) + np.tile(np.arange(length), len(starts))] = False  # windows that leave their variant
        first, last = X.runs(twice, np.append(starts, len(joined)))
        if not len(first):
            return None
        own = np.searchsorted(starts, first, "right") - 1
        X.trim()
        return pa.table({"gram": gram[order][own], "variant": variant[order][own], "a": (first - starts[own]).astype(np.int32), "b": (last - starts[own]).astype(np.int32)})

    return work


def _identified(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, id (the key, or the smallest long without one), th (hash of the text), text."""
    k = F.col(key).cast("long")
    return docs.select(k.alias("key"), F.coalesce(k, F.lit(-(1 << 63))).alias("id"), F.xxhash64(text).alias("th"), F.col(text).alias("text"))


def repeats(plain: DataFrame, length: int = 200) -> DataFrame:
    """id, th and spans (array of structs start, end: bytes to remove, which may overlap) of texts with any. plain: id, th and text."""
    found = shared.written(anchors(plain, length), "anchors")
    often = shared.written(found.groupBy("gram").agg(F.count("*").alias("places")).where("places > 1"), "gram-places")
    kept = shared.written(groups.spread_join(found, often, ["gram"], F.col("places")).drop("places"), "repeated-grams")
    place = F.struct("id", "th", "first")
    variants = shared.written(kept.groupBy("gram", "variant").agg(F.count("*").alias("places"), F.min(place).alias("at"), F.first("n").alias("n")), "variants")
    several = shared.written(variants.groupBy("gram").agg(F.count("*").alias("variants"), F.sum(F.col("n") + length).alias("bytes")).where("variants > 1"), "several")

    of = groups.spread_join(variants, several, ["gram"], F.col("variants"))
    wanted = of.select("at.id", "at.th", F.struct("gram", "variant", "variants", "at.first", "n").alias("w")).groupBy("id", "th").agg(F.collect_list("w").alias("wanted"))
    # rows with the same id and hash hold the same text
    bodies = shared.written(_bytes_of(plain.where("text IS NOT NULL").join(wanted, ["id", "th"]), length), "variant-bytes")
    in_shards = F.col("variants") <= MOST_VARIANTS
    total = several.where(in_shards).agg(F.sum("bytes")).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    dealt = bodies.where(in_shards).select(F.pmod(F.xxhash64("gram", F.lit(3)), F.lit(shards)).alias("task"), "gram", "variant", "bytes")
    sorted_ = groups.each(dealt, "task", _sorted_shard(length), "gram long, variant long, a int, b int", int(shards))
    crowded = bodies.where(~in_shards)
    if several.where(~in_shards).limit(1).count():
        every = shared.written(_windows_of(crowded, length).distinct(), "crowded-windows")
        twice = shared.written(every.groupBy("window").agg(F.count("*").alias("times")).where("times > 1"), "window-places")
        sorted_ = sorted_.union(groups.spread_join(every, twice, ["window"], F.col("times")).select("gram", "variant", "a", "b"))

    copies = variants.where("places > 1").select("gram", "variant", F.lit(0).alias("a"), F.col("n").alias("b"), "places")
    lone = variants.where("places = 1").select("gram", "variant")
    own = sorted_.join(lone, ["gram", "variant"], "left_semi").withColumn("places", F.lit(1).cast("long"))
    windows = shared.written(copies.unionByName(own), "windows")
    hit = groups.spread_join(kept, windows, ["gram", "variant"], F.col("places"))
    spans = hit.select("id", "th", F.struct((F.col("first") + F.col("a")).alias("start"), (F.col("first") + F.col("b") - 1 + length).alias("end")).alias("span"))
    return spans.groupBy("id", "th").agg(F.collect_set("span").alias("spans"))


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 200, with_bytes: bool = True) -> DataFrame:
    """key, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 of the remaining bytes, and these bytes if asked for."""
    if not 0 < length < 1 << 16:
        raise ValueError("length has to be from 1 to 65535")
    plain = _identified(docs, key, text)
    with shared.scratch(docs.sparkSession):
        spans = shared.written(repeats(plain.select("id", "th", "text"), length), "spans", outlive=True)
    fields = "key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_bytes
    names = [f.split()[0] for f in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part, rows = batch.slice(start, 256), []
                for k, t, own in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                    data, kept, at, n = (t or "").encode(), [], 0, 0
                    for s in sorted(own or [], key=lambda s: s["start"]):
                        if s["start"] > at or not n:
                            kept.append(data[at : s["start"]])
                            n += 1
                        at = max(at, s["end"])
                    kept.append(data[at:])
                    left = b"".join(kept)
                    rows.append((k, len(data), len(data) - len(left), n, hashlib.sha256(left).hexdigest(), left)[: len(names)])
                kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=False)], names=names)

    return plain.join(spans, ["id", "th"], "left").select("key", "text", "spans").mapInArrow(run, fields).withColumnRenamed("key", key)
