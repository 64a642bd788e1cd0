"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

A benchmark window is window_words consecutive words of an item (a shorter item is one window). As a set it holds its word shingles.
A window stands in a document only if all its shingles do, so the necessary prefix is one shingle: the rarest. Steps:

1. Documents' shingles meet the benchmark's vocabulary of shingles; only those that are in it go on. Every document also sends one row
   with its number of words. This is the only pass over the texts; its result is written to the shared folder.
2. Rarity is the number of occurrences over all documents. A window with a shingle that never occurs is done.
3. Occurrences of each window's rarest shingle give candidate places; the positional bound (the window starts inside the document)
   and the length bound (it ends inside) prune them.
4. Exact containment over the window's place: all its shingles have to stand at their positions. Overlapping shingles at
   consecutive positions fix every word of the window.

The vocabulary and the windows are broadcast only if their measured bytes are under a bound; else the joins shuffle, which Spark splits where a
key is hot.

Defined cases: a null or empty text has no words and no hit; a null or empty item has no window; items that share an id keep windows of their own and
are listed once, a hit by an item without id counts and lists nothing; repeated document rows each give a row with the same figures, rows that share
a key only have figures of their own, a null key is a key; of equally rare shingles the first in order is taken; a very long text is searched whole; an
empty table on either side gives no hits; columns beside key and text are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import shared

#: Words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of lower-cased texts; this matches what lies between them.
_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Measured bytes of the benchmark's side up to which it is broadcast, and what a row takes beside its strings.
BROADCAST_BYTES, ROW_BYTES = 32 << 20, 64


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, nothing else; texts of one byte a character take the fast way."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), _GAPS, -1), "")


def _shingles(words: Column, n: Column, k: int) -> Column:
    """Structs (pos, shingle) of all k consecutive words."""
    at = lambda i, j: F.get(words, i + j)
    return F.when(n >= k, F.transform(F.sequence(F.lit(0), n - k), lambda i: F.struct(i.alias("pos"), F.concat_ws(" ", *[at(i, j) for j in range(k)]).alias("shingle"))))


def _bytes(df: DataFrame, *strings: Column) -> int:
    """What the rows of a written table take with these strings."""
    return df.agg(F.sum(sum((F.octet_length(c) for c in strings), F.lit(ROW_BYTES)).cast("long"))).first()[0] or 0


def _bounded(df: DataFrame, size: int) -> DataFrame:
    return F.broadcast(df) if size <= BROADCAST_BYTES else df.hint("merge")


def _items(benchmark: DataFrame, item_key: str, text: str, window_words: int, shingle_words: int) -> DataFrame:
    """item, of (hash of its words: texts that share an item id have windows of their own), n, len (words of a window), k (words of a shingle), words
    of each item that has words."""
    items = benchmark.select(F.col(item_key).cast("string").alias("item"), words(F.col(text)).alias("words")).distinct()
    items = items.withColumn("n", F.size("words")).where("n > 0").withColumn("of", F.xxhash64("words"))
    items = items.withColumn("len", F.least("n", F.lit(window_words)))
    return items.withColumn("k", F.least("len", F.lit(shingle_words)))


def _doc(key: str, text: str) -> Column:
    """What identifies a document: its key and the hash of its text."""
    return F.struct(F.col(key).alias("key"), F.xxhash64(text).alias("th"))


def occurrences(docs: DataFrame, benchmark: DataFrame, key: str, text: str, item_key: str, item_text: str, window_words: int, shingle_words: int) -> tuple[DataFrame, DataFrame]:
    """Number of words of each document row; and (doc, item, start, len) of each place of a window."""
    items = shared.written(_items(benchmark, item_key, item_text, window_words, shingle_words), "items")
    sizes = [r[0] for r in items.select("k").distinct().collect()]  # at most shingle_words values
    parts = None
    for k in sorted(sizes):
        part = items.where(F.col("k") == k).select("item", "of", "n", "len", "k", F.inline(_shingles(F.col("words"), F.col("n"), k)))
        parts = part if parts is None else parts.unionByName(part)
    if parts is None:
        parts = items.select("item", "of", "n", "len", "k", F.lit(0).alias("pos"), F.lit("").alias("shingle")).limit(0)
    parts = shared.written(parts, "item-shingles")
    vocabulary = parts.select("shingle").distinct()
    vocabulary_bytes = _bytes(vocabulary, F.col("shingle"))

    # the empty shingle stands for the document itself
    plain = docs.select(_doc(key, text).alias("doc"), words(F.col(text)).alias("words")).withColumn("n_words", F.size("words"))
    own = F.array(F.struct(F.lit(-1).alias("pos"), F.lit("").alias("shingle")))
    every = own
    for k in sorted(sizes):
        every = F.concat(every, F.coalesce(_shingles(F.col("words"), F.col("n_words"), k), F.slice(own, 1, 0)))
    marked = vocabulary.union(docs.sparkSession.range(1).select(F.lit("").alias("shingle")))
    hits = plain.select("doc", "n_words", F.inline(every)).join(_bounded(marked, vocabulary_bytes), "shingle")
    hits = shared.written(hits.select("doc", "n_words", "pos", "shingle"), "hits")
    found = hits.where("pos >= 0")

    rarity = found.groupBy("shingle").agg(F.count("*").alias("n_docs"))
    # windows start where a whole window is left; each takes the shingles inside it
    ranked = parts.join(_bounded(rarity, vocabulary_bytes), "shingle", "left")
    starts = F.sequence(F.greatest(F.lit(0), F.col("pos") - (F.col("len") - F.col("k"))), F.least(F.col("pos"), F.col("n") - F.col("len")))
    windows = (
        ranked.where(F.col("n") >= F.col("len")).withColumn("wstart", F.explode(starts))
        .groupBy("item", "of", "wstart", "len", "k")
        .agg(
            F.min(F.struct(F.coalesce("n_docs", F.lit(0)).alias("n_docs"), "shingle", (F.col("pos") - F.col("wstart")).alias("offset"))).alias("rarest"),
            F.sort_array(F.collect_list(F.struct((F.col("pos") - F.col("wstart")).alias("at"), "shingle"))).alias("shingles"),  # at most window_words
        )
        .where("rarest.n_docs > 0")
    )
    windows = shared.written(windows, "windows")
    strings = F.aggregate("shingles", F.lit(0), lambda a, x: a + F.octet_length(x["shingle"]) + ROW_BYTES)
    window_bytes = windows.agg(F.sum((strings + ROW_BYTES).cast("long"))).first()[0] or 0
    prefixes = windows.select("item", "wstart", "len", "shingles", F.col("rarest.shingle").alias("shingle"), F.col("rarest.offset").alias("offset"))
    candidates = found.join(_bounded(prefixes, window_bytes), "shingle").withColumn("start", F.col("pos") - F.col("offset")).where((F.col("start") >= 0) & (F.col("start") + F.col("len") <= F.col("n_words")))
    # one candidate for each place, whatever items it belongs to
    places = candidates.select("doc", "start", "len", "shingles", "item").groupBy("doc", "start", "len", "shingles").agg(F.collect_set("item").alias("items"))
    wanted = places.select("doc", "start", "len", "items", F.size("shingles").alias("need"), F.inline("shingles")).withColumn("pos", F.col("start") + F.col("at"))
    met = wanted.join(found.select("doc", "pos", "shingle").distinct(), ["doc", "pos", "shingle"])
    verified = met.groupBy("doc", "start", "len", "need", "items").agg(F.count("*").alias("got")).where("got = need")
    return hits.where("pos < 0").select("doc", "n_words"), verified.select("doc", "start", "len", "items")


def contamination(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", window_words: int = 10, shingle_words: int = 3
) -> DataFrame:
    """key, n_words, n_hit (words inside any place of a window), items (sorted array of item ids as strings), spans (array of start and end words)."""
    with shared.scratch(docs.sparkSession):
        counts, places = occurrences(docs, benchmark, key, text, item_key, item_text, window_words, shingle_words)
        places = shared.written(places, "places")
        spans = places.groupBy("doc", "start").agg(F.max(F.col("start") + F.col("len")).alias("end"))
        before = F.max("end").over(Window.partitionBy("doc").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
        covered = spans.withColumn("new", F.col("end") - F.greatest("start", F.coalesce(before, F.lit(0)))).groupBy("doc").agg(
            F.sum(F.greatest(F.col("new"), F.lit(0))).alias("n_hit"), F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans")
        )
        items = places.select("doc", F.explode("items").alias("item")).distinct().groupBy("doc").agg(F.sort_array(F.collect_list("item")).alias("items"))
        # a hit document is one row here
        found = shared.written(covered.join(items, "doc", "left"), "contaminated", outlive=True)
        counts = shared.written(counts, "word-counts", outlive=True)
    empty = F.array().cast("array<string>")
    return counts.join(found, "doc", "left").select(
        F.col("doc.key").alias(key), F.col("n_words").cast("long").alias("n_words"), F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", empty).alias("items"), "spans"
    )


def clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without any benchmark window, with all their columns."""
    with shared.scratch(docs.sparkSession):
        _, places = occurrences(docs, benchmark, key, text, "item_id", "text", 10, 3)
        leaked = shared.written(places.select(F.col("doc").alias("_leaked")).distinct(), "leaked", outlive=True)
    return docs.join(leaked, _doc(key, text) == leaked["_leaked"], "left_anti")
