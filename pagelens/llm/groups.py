"""Tools on keyed rows: groups of bounded size handed to a Python function, connected components, and key filters of fixed size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared
from . import text as X


def in_blocks(df: DataFrame, key: str, sizes: DataFrame, blocks: Column, spread: Column, salt: int = 1) -> DataFrame:
    """The rows of each key with a column task: a key's rows are cut into blocks by a hash of `spread`, and each block is a task.

    sizes: the keys that matter and their figures; blocks: from these figures the number of blocks. Rows of different blocks don't meet here."""
    dealt = df.join(sizes.select(key, blocks.cast("int").alias("_blocks")), key)
    own = F.pmod(F.xxhash64(spread, F.lit(salt)), F.col("_blocks"))
    return dealt.withColumn("task", F.xxhash64(F.struct(F.col(key), F.lit(salt), own))).drop("_blocks")


#: Rows of a key from which it counts as hot, and hot keys up to which they are broadcast.
HOT_ROWS, MOST_HOT = 10_000, 200_000


def spread_join(df: DataFrame, right: DataFrame, on: list[str], rows: Column) -> DataFrame:
    """The inner join on key columns; right is a written table, and rows, from its columns, the number of df's rows that a key may have.

    Rows of hot keys join where they are, with a broadcast of their keys' rows, and are left out of the shuffle. With more hot rows than a broadcast may
    hold, all go through a sort-merge join, which Spark splits where a partition is skewed."""
    hot = right.where(rows > HOT_ROWS)
    n = hot.limit(MOST_HOT + 1).count()
    if n > MOST_HOT or not n:
        return df.join(right, on)
    cold = df.join(F.broadcast(hot.select(*on).distinct()), on, "left_anti").join(right.where(~(rows > HOT_ROWS)), on)
    return cold.unionByName(df.join(F.broadcast(hot), on))


def against_all(df: DataFrame, key: str, rest: Column, sizes: DataFrame, blocks: Column, rest_blocks: Column, spread: Column) -> DataFrame:
    """The rows of each key with a column task, so that each row of the rest meets every row of its key in one of the tasks.

    All rows stand in `blocks`, those of the rest also in `rest_blocks`; a task is a pair of them. Where the rest fills one block, every other
    row is sent once."""
    dealt = df.join(sizes.select(key, blocks.cast("int").alias("_blocks"), F.greatest(rest_blocks.cast("int"), F.lit(1)).alias("_rests")), key)
    at = lambda salt, n: F.pmod(F.xxhash64(spread, F.lit(salt)), F.col(n)).cast("int")
    pair = lambda r, b: F.struct(r.alias("r"), b.alias("b"))
    member = F.transform(F.sequence(F.lit(0), F.col("_rests") - 1), lambda r: pair(r, at(11, "_blocks")))
    of_rest = F.when(rest, F.transform(F.sequence(F.lit(0), F.col("_blocks") - 1), lambda b: pair(at(12, "_rests"), b))).otherwise(F.array().cast("array<struct<r:int,b:int>>"))
    dealt = dealt.withColumn("_pair", F.explode(F.array_union(member, of_rest)))
    return dealt.withColumn("task", F.xxhash64(F.struct(F.col(key), F.lit(-1), F.col("_pair")))).drop("_blocks", "_rests", "_pair")


def forest(
    members: DataFrame, payload: DataFrame, work: Callable[[pa.Table], pa.Table | None], most_rows: int, most_weight: int, rounds: int = 1, wide: bool = False
) -> DataFrame:
    """Links a, b whose components are those of all links that `work` finds between two nodes of a group.

    members: group, node, weight. payload: node and what work needs of it; work gets it with task and component, and may skip pairs of one component.
    Groups within the bounds are one task. Larger ones are cut into blocks, `rounds` times by different hashes. Nodes outside the largest component
    so found are then held against all nodes of their group: no pair of different components is left out, and a group that is one class costs
    no more than its rows. With wide payload rows, those of nodes in no large group are left out of the shuffles after the first."""
    blocks = lambda n, w: F.greatest(F.ceil(F.col(n) / most_rows), F.ceil(F.col(w) / most_weight))
    sizes = shared.written(members.groupBy("group").agg(F.count("*").alias("n"), F.sum("weight").alias("w")).where("n > 1"), "group-sizes")
    large = sizes.where(blocks("n", "w") > 1)

    def linked(dealt: DataFrame) -> DataFrame:
        return shared.written(each(dealt.join(payload, "node"), "task", work, "a long, b long").distinct(), "links")

    found = linked(in_blocks(members.select("group", "node"), "group", sizes, blocks("n", "w"), F.col("node")).select("task", "node", F.col("node").alias("component")))
    if not large.limit(1).count():
        return found
    members = shared.written(members.join(large.select("group"), "group", "left_semi"), "large-groups")
    if wide:
        payload = filtered(payload, "node", key_filter(members.select("node")), True)

    def named() -> DataFrame:
        return members.join(components(found).withColumnRenamed("component", "_c"), "node", "left").withColumn("component", F.coalesce("_c", "node")).drop("_c")

    for salt in range(2, rounds + 1):
        found = found.union(linked(in_blocks(named(), "group", large, blocks("n", "w"), F.col("node"), salt).select("task", "node", "component")))
    now = shared.written(named(), "named")
    each_one = now.groupBy("group", "component").agg(F.count("*").alias("n"), F.sum("weight").alias("w"))
    whole = each_one.groupBy("group").agg(F.count("*").alias("components"), F.sum("n").alias("n"), F.sum("w").alias("w"), F.max(F.struct("n", "w", "component")).alias("main"))
    whole = whole.where("components > 1").select("group", "n", "w", "main.component", (F.col("n") - F.col("main.n")).alias("rn"), (F.col("w") - F.col("main.w")).alias("rw"))
    whole = shared.written(whole.withColumnRenamed("component", "main"), "rest-sizes")
    marked = now.join(whole.select("group", "main"), "group")
    rest = against_all(marked, "group", F.col("component") != F.col("main"), whole, blocks("n", "w"), blocks("rn", "rw"), F.col("node"))
    return found.union(linked(rest.select("task", "node", "component")))


def each(df: DataFrame, key: str, work: Callable[[pa.Table], pa.Table | None], schema: str, tasks: int | None = None, by_range: bool = False) -> DataFrame:
    """work applied to all rows of each value of a long key. Rows of a key are together in memory, so their number has to be bounded.

    Rows stream through sorted partitions (`tasks` of them, if given); many small groups cost no call of Spark's each. by_range: tasks are ranges of
    keys, so that a few large groups are dealt evenly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            cuts = [0, *((keys[1:] != keys[:-1]).nonzero()[0] + 1).tolist(), len(keys)]
            if rest and rest[-1].column(0)[0].as_py() != keys[0]:
                yield from done(rest)
                rest = []
            for a, b in zip(cuts, cuts[1:], strict=False):
                rest.append(batch.slice(a, b - a))
                if b < len(keys):
                    yield from done(rest)
                    rest = []
        if rest:
            yield from done(rest)

    def done(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = work(pa.Table.from_batches(parts))
        if out is not None:
            yield from out.combine_chunks().to_batches()

    columns = [key, *[c for c in df.columns if c != key]]
    if by_range:
        dealt = df.select(*columns).repartitionByRange(tasks, key)
    else:
        dealt = df.select(*columns).repartition(tasks, key) if tasks else df.select(*columns).repartition(key)
    return dealt.sortWithinPartitions(key).mapInArrow(run, schema)


#: Edges that a task contracts together (about 50 bytes each in memory).
CONTRACTED = 500_000


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node reachable from each of n nodes by the links a, b."""
    root = np.arange(n)
    while len(a):
        ends = root[a], root[b]
        for x in ends:  # roots only: a node taken from its root would leave the root's other links behind
            np.minimum.at(root, x, np.minimum(*ends))
        while (root[root] != root).any():
            root = root[root]
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return root


def contracted(edges: DataFrame) -> DataFrame:
    """Edges u, v with the same components as those given, and no more of them: within each chunk of a partition, every node with the smallest one reachable."""

    def star(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        u, v = (np.concatenate([x.column(i).to_numpy() for x in held]) for i in (0, 1))
        nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
        root = roots(len(nodes), ends[: len(u)], ends[len(u) :])
        far = np.flatnonzero(root != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[far]), pa.array(nodes[root[far]])], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= CONTRACTED:
                yield star(held)
                held, n = [], 0
        if n:
            yield star(held)

    return edges.select("u", "v").mapInArrow(run, "u long, v long")


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, component (the smallest node reachable) of all nodes of the edges a, b (long).

    Alternating large-star and small-star rounds until the edges are stars; each round's edges are contracted where they lie and written to the
    shared folder. The edges stay as many as the nodes. Up to CONTRACTED edges, which is what a task contracts together anyway, need no rounds."""
    spark = edges.sparkSession
    with shared.scratch(spark):
        now, rounds = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), most_rounds
        if edges.count() <= CONTRACTED:  # what one chunk holds is settled by one contraction
            now, rounds = contracted(now.coalesce(1)), 0
        else:
            now = shared.written(contracted(contracted(now).distinct()), "edges")
        for _ in range(rounds):
            ends = now.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(now.select("v", F.lit(0), F.lit(1)))
            ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
            if not ends.where("up + down > 1 AND up > 0").limit(1).count():  # every larger end has one edge, to a node that is no larger end
                break
            # large star: every larger neighbour of a node goes to the smallest in its neighbourhood
            both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
            large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
            # small star: every smaller neighbour, and the node itself, goes to the smallest
            floor = large.groupBy("u").agg(F.min("v").alias("m"))
            small = large.join(floor, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(floor.select("u", F.col("m").alias("v"))).distinct()
            now = shared.written(contracted(small), "edges")
        else:
            if rounds:
                raise RuntimeError("components did not settle")
        now = shared.written(now, "components", outlive=True)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()


#: Bits of a key filter, whatever the number of keys, and parts in which it is gathered.
FILTER_BITS, _FILTER_PARTS = 23, 16


def _bit(keys: np.ndarray) -> np.ndarray:
    return (X.mix(keys.view(np.uint64)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def key_filter(keys: DataFrame) -> np.ndarray:
    """A bit for each hash of the keys (one long column), packed to 1 MB. A key that isn't among them may find its bit set, never the reverse."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, any_row = np.zeros(1 << FILTER_BITS, bool), False
        for batch in batches:
            bits[_bit(X.longs(batch.column(0)))] = True
            any_row = True
        if any_row:
            parts = np.split(np.packbits(bits), _FILTER_PARTS)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(_FILTER_PARTS)), pa.array([x.tobytes() for x in parts], pa.binary())], names=["part", "bits"])

    def either(t: pa.Table) -> pa.Table:
        bits = np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in t.column("bits").to_pylist()])
        return pa.table({"part": t.column("part").slice(0, 1), "bits": pa.array([bits.tobytes()], pa.binary())})

    found = keys.mapInArrow(run, "part long, bits binary").groupBy("part").applyInArrow(either, "part long, bits binary").collect()
    out = np.zeros((_FILTER_PARTS, (1 << FILTER_BITS) // 8 // _FILTER_PARTS), np.uint8)
    for part, bits in found:
        out[part] = np.frombuffer(bits, np.uint8)
    return out.reshape(-1)


def filtered(df: DataFrame, key: str, bits: np.ndarray, member: bool) -> DataFrame:
    """The rows whose key may be in the filter; or, with member false, those whose key isn't in it for certain. Spares the others a shuffle."""
    at, sent = df.columns.index(key), df.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.unpackbits(sent.value).view(bool)
        for batch in batches:
            hit = known[_bit(X.longs(batch.column(at).cast(pa.int64())))]
            yield batch.filter(pa.array(hit if member else ~hit))

    return df.mapInArrow(run, df.schema)
