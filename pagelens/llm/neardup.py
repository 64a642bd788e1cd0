"""Near-duplicate documents by b-bit MinHash.

1. One pass over the texts gives each document's set of word shingles as a fingerprint, band keys and a signature: of each of the
   minima only the low bits are kept and packed.
2. Documents with the same set are one node from here on; so exact copies cost nothing more.
3. Nodes that share a band key are candidates. Within a bucket the similarity is estimated from the number of equal low-bit groups
   (by bit counts), corrected for chance collisions; pairs far below the threshold are dropped, and of the rest a spanning forest is kept.
4. Nodes joined by candidates form loose groups. In each, links are confirmed on the full sets, skipping pairs that are already connected.
5. Connected components of the confirmed links are the classes.

Large buckets and loose groups are cut into blocks (see groups.forest). Copies of one template are one component after that, whatever their number;
nodes outside the largest component are held against all of the group. Nothing is capped, sampled or dropped, and no pair is listed unless it is part
of a spanning forest.

Recall: with 32 bands of 4 (threshold under 0.85) or 25 of 5, a pair at the threshold is missed by banding with a chance under 1e-6, and by
the estimate's margin (4.5 standard deviations) with one under 1e-5; a class is lost only if all its connecting pairs are.

Defined cases: a null or empty text, or one without words, has an empty set and is alone; a text with fewer words than a shingle is one
shingle; repeated rows are members of the same class; rows that share a key but not the text are nodes of their own; rows with a null key are members,
and a class without any key has a null id; a very long text is one set; an empty table gives an empty result; other columns are ignored, whatever their
names. A class's id is its smallest key, ties don't matter to it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import groups, shared
from . import text as X

BITS = 4
HASHES = 128
#: Rows, and shingles, that one task of a bucket or loose group holds at most for each of its two blocks.
BLOCK_ROWS = 256
BLOCK_SHINGLES = 1_000_000


@dataclass(frozen=True)
class Params:
    """shingle_words; similarity threshold in hundredths."""

    shingle_words: int = 5
    percent: int = 80

    @property
    def rows(self) -> int:
        """Of a band."""
        return 5 if self.percent >= 85 else 4

    @property
    def bands(self) -> int:
        return HASHES // self.rows

    @property
    def least_estimate(self) -> float:
        """Similarities estimated below this are no candidates."""
        t, c = self.percent / 100, 2.0**-BITS
        p = t + (1 - t) * c
        return t - 4.5 * math.sqrt(p * (1 - p) / HASHES) / (1 - c)


_MULTIPLIERS = [np.uint64(int(x) | 1) for x in X.mix(np.arange(101, 101 + HASHES, dtype=np.uint64))]


def sets(texts: X.Texts, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and the bounds."""
    w = X.words(texts, X.NOT_SPACE, lower=True)
    return X.distinct(*X.shingles(w.hashes, w.bounds, k))


def minima(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each set that isn't empty (in order) its minima, one column for each hash function."""
    at = bounds[:-1][np.diff(bounds) > 0]
    out = np.empty((len(at), HASHES), np.uint64)
    for i, m in enumerate(_MULTIPLIERS):
        out[:, i] = np.minimum.reduceat(values * m, at) if len(at) else 0
    return out


def signatures(low: np.ndarray) -> np.ndarray:
    """Low BITS bits of each minimum, packed: one row of bytes for each set. Minima are mixed first, as low bits of products are weak."""
    low = (X.mix(low) & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    return low[:, 0::2] | (low[:, 1::2] << BITS)


def estimates(words: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Collision-corrected similarities of packed signatures (rows of uint64) with one of them."""
    x = words ^ one
    x = x | (x >> np.uint64(1))
    x = (x | (x >> np.uint64(2))) & np.uint64(0x1111111111111111)
    equal = HASHES - np.bitwise_count(x).sum(axis=1, dtype=np.int64)
    c = 2.0**-BITS
    return (equal / HASHES - c) / (1 - c)


class Forest:
    """Union-find over positions."""

    def __init__(self, component: np.ndarray):
        """Positions of the same component are joined from the start."""
        _, first, own = np.unique(component, return_index=True, return_inverse=True)
        self.up = first[own]

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = int(self.up[i])
        return i

    def roots(self) -> np.ndarray:
        up = self.up
        while True:
            new = up[up]
            if (new == up).all():
                self.up = up
                return up
            up = new

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True


def _identified(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, id (the key, or the smallest long without one), th (hash of the text), text. Rows with the same id and th are the same document."""
    k = F.col(key).cast("long")
    return docs.select(k.alias("key"), F.coalesce(k, F.lit(-(1 << 63))).alias("id"), F.xxhash64(text).alias("th"), F.col(text).alias("text"))


def sketches(docs: DataFrame, p: Params) -> DataFrame:
    """key, id, th, n_shingles, node (fingerprint of the set), bands (array of longs), signature; the last two null for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in X.chunked(batch.column(3)):
                values, bounds = sets(group, p.shingle_words)
                n = np.diff(bounds)
                sums = np.zeros((2, len(values) + 1), np.uint64)
                np.cumsum(values, out=sums[0, 1:])
                np.cumsum(X.mix(values + np.uint64(77)), out=sums[1, 1:])
                fp = sums[:, bounds[1:]] - sums[:, bounds[:-1]]
                node = X.mix(fp[0] ^ X.mix(fp[1] + n.astype(np.uint64)))
                low = minima(values, bounds)
                bands = np.zeros((len(low), p.bands), np.uint64)
                for b in range(p.bands):
                    for r in range(p.rows):
                        bands[:, b] = X.mix(bands[:, b] * np.uint64(31) + low[:, b * p.rows + r] + np.uint64(b + 1))
                packed = signatures(low)
                has = n > 0
                where = np.cumsum(has) - 1
                rows = batch.slice(group.first, len(group))
                yield pa.RecordBatch.from_arrays(
                    [
                        *rows.columns[:3],
                        pa.array(n.astype(np.int64)),
                        pa.array(node.view(np.int64)),
                        pa.array([bands[where[i]].view(np.int64) if has[i] else None for i in range(len(n))], pa.list_(pa.int64())),
                        pa.array([packed[where[i]].tobytes() if has[i] else None for i in range(len(n))], pa.binary()),
                    ],
                    names=["key", "id", "th", "n_shingles", "node", "bands", "signature"],
                )

    return docs.mapInArrow(run, "key long, id long, th long, n_shingles long, node long, bands array<long>, signature binary")


def _bucket(least: float):
    """Spanning forest of the pairs in a bucket whose estimate is high enough."""

    def work(t: pa.Table) -> pa.Table | None:
        node = t.column("node").to_numpy()
        _, first = np.unique(node, return_index=True)
        node = node[first]
        n = len(node)
        if n < 2:
            return None
        packed = t.column("signature").to_pylist()
        sig = np.frombuffer(b"".join(packed[i] for i in first), np.uint64).reshape(n, -1)
        forest, a, b = Forest(t.column("component").to_numpy()[first]), [], []
        for i in range(n - 1):
            near = np.flatnonzero(estimates(sig[i + 1 :], sig[i]) >= least) + i + 1
            roots = forest.roots()
            near = near[roots[near] != roots[i]]
            for j in near[np.unique(roots[near], return_index=True)[1]].tolist():
                if forest.join(i, j):
                    a.append(node[i])
                    b.append(node[j])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())}) if a else None

    return work


def _confirm(percent: int, least: float):
    """Spanning forest of the true links in a loose group: pairs with a high estimate that aren't connected yet are verified on their full sets."""

    def work(t: pa.Table) -> pa.Table | None:
        node = t.column("node").to_numpy()
        _, first = np.unique(node, return_index=True)
        node, n = node[first], len(first)
        if n < 2:
            return None
        packed, members = t.column("signature").to_pylist(), t.column("members").to_pylist()
        sig = np.frombuffer(b"".join(packed[i] for i in first), np.uint64).reshape(n, -1)
        own = [np.frombuffer(members[i], np.uint64) for i in first]
        size = np.array([len(x) for x in own])
        forest, a, b = Forest(t.column("component").to_numpy()[first]), [], []
        for i in range(n - 1):
            est = estimates(sig[i + 1 :], sig[i])
            fit = (est >= least) & (100 * np.minimum(size[i + 1 :], size[i]) >= percent * np.maximum(size[i + 1 :], size[i]))
            near = np.flatnonzero(fit)
            near = near[np.argsort(-est[near], kind="stable")] + i + 1
            roots = forest.roots()
            done = {int(roots[i])}
            for j in near.tolist():
                r = int(roots[j])
                if r in done:
                    continue
                both = len(np.intersect1d(own[i], own[j], assume_unique=True))
                if 100 * both >= percent * (size[i] + size[j] - both):
                    forest.join(i, j)
                    done.add(r)
                    a.append(node[i])
                    b.append(node[j])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())}) if a else None

    return work


def _classes(docs: DataFrame, params: Params) -> tuple[DataFrame, DataFrame]:
    """The sketches of all rows; and node, least (smallest key of its class), keep (id and th of its first document with a key). docs: see _identified."""
    seen = shared.written(sketches(docs, params), "sketches", outlive=True)
    head, keyed = F.struct("id", "th"), F.when(F.col("key").isNotNull(), F.struct("id", "th"))
    first = [F.first(c).alias(c) for c in ("n_shingles", "bands", "signature")]
    nodes = shared.written(seen.where("n_shingles > 0").groupBy("node").agg(F.min(head).alias("head"), F.min(keyed).alias("keep"), F.min("key").alias("least"), *first), "nodes")

    banded = nodes.select(F.explode("bands").alias("group"), "node", F.lit(0).cast("long").alias("weight"))
    loose = groups.forest(banded, nodes.select("node", "signature"), _bucket(params.least_estimate), BLOCK_ROWS, 1)
    loose = shared.written(groups.components(loose), "loose")

    wanted = loose.join(nodes.select("node", "head.id", "head.th", "signature"), "node")
    wanted = shared.written(wanted.select("node", "id", "th", "signature"), "wanted")
    texts = groups.filtered(docs.select("id", "th", "text"), "th", groups.key_filter(wanted.select("th")), True)  # other texts aren't shuffled
    once = texts.join(wanted.hint("merge"), ["id", "th"]).dropDuplicates(["id", "th"])  # repeated rows go where the join has put them, before they are sets
    full = shared.written(_members(once, params), "sets")
    members = loose.join(nodes.select("node", "n_shingles"), "node").select(F.col("component").alias("group"), "node", F.col("n_shingles").alias("weight"))
    links = groups.forest(members, full, _confirm(params.percent, params.least_estimate), BLOCK_ROWS, BLOCK_SHINGLES, rounds=2, wide=True)
    found = shared.written(groups.components(links), "classes")

    of = nodes.select("node", "least", "keep").join(found, "node", "left").withColumn("class", F.coalesce("component", "node"))
    least = of.where("component IS NOT NULL").groupBy("class").agg(F.min("least").alias("c_least"), F.min("keep").alias("c_keep"))
    named = of.join(least, "class", "left").select("node", F.coalesce("c_least", "least").alias("least"), F.coalesce("c_keep", "keep").alias("keep"))
    return seen, shared.written(named, "named-classes", outlive=True)


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", params: Params = Params()) -> DataFrame:
    """key, n_shingles, component_id (the smallest key of the class) for each row."""
    with shared.scratch(docs.sparkSession):
        seen, named = _classes(_identified(docs, key, text), params)
    out = seen.select("key", "n_shingles", "node").join(named.select("node", "least"), "node", "left")
    alone = F.col("n_shingles") == 0
    return out.select(F.col("key").alias(key), "n_shingles", F.when(alone, F.col("key")).otherwise(F.col("least")).alias("component_id"))


def _members(docs: DataFrame, p: Params) -> DataFrame:
    """node, members (sorted shingle hashes as bytes), signature. docs: node, text, signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in X.chunked(batch.column(1)):
                values, bounds = sets(group, p.shingle_words)
                rows = batch.slice(group.first, len(group))
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array([values[a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)], pa.binary()), rows.column(2)], names=["node", "members", "signature"])

    return docs.select("node", "text", "signature").mapInArrow(run, "node long, members binary, signature binary")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", params: Params = Params()) -> DataFrame:
    """One document of each class, the one with the smallest key, with all columns. Of rows with the same key and text one
    stays; rows with a null key stay all, and so do rows without words."""
    with shared.scratch(docs.sparkSession):
        seen, named = _classes(_identified(docs, key, text), params)
        rows = seen.where("n_shingles > 0 AND key IS NOT NULL").join(named, "node")
        gone = rows.where((F.col("id") != F.col("keep.id")) | (F.col("th") != F.col("keep.th"))).select(F.col("id").alias("_gone_id"), F.col("th").alias("_gone_th")).distinct()
        gone = shared.written(gone, "dropped", outlive=True)
    kept = docs.join(gone, (F.col(key).cast("long") == gone["_gone_id"]) & (F.xxhash64(text) == gone["_gone_th"]), "left_anti")
    if seen.where("key IS NOT NULL").groupBy("id", "th").count().where("count > 1").limit(1).count():
        kept = kept.where(F.col(key).isNotNull()).dropDuplicates([key, text]).union(kept.where(F.col(key).isNull()))
    return kept
