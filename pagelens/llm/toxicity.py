"""Toxicity by a convolutional text classifier, trained in numpy.

A word's vector is the sum of two hashed embeddings, of the word and of its first bytes, so that unseen endings of a known stem still count.
Filters of several widths slide over a text's words; each filter's maximum over the whole text goes through a linear layer. Training is by
Adagrad on the logistic loss; as pooling takes maxima, gradients touch few words of a text. The first coordinate of each embedding starts at the
smoothed log-odds of its words in toxic texts.

Thresholds are calibrated by language on rows that the network didn't see. The language is guessed from the text's own function words, so that a score
depends on the text alone; the logit is shifted by the language's threshold, and 0.5 is the limit for all.

Every labelled row counts, with its whole text. The log-odds come from all training rows. These are dealt into shards of bounded size; each trains a network from
that common start, and the mean of the networks is the model. Thresholds come from counts over all the rows kept for them. The driver takes sums of fixed
size only. Scoring covers every whole text.

Defined cases: a null or empty text gets the score of a text without words; repeated rows get the same score; without labels of both kinds all scores
are the smoothed share of toxic labels; a key with both labels counts as toxic; equal scores give equal predictions; a very long text is scored whole;
an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import copy
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import groups, shared
from . import text as X

WORD_BUCKETS, STEM_BUCKETS, STEM_BYTES = 1 << 18, 1 << 17, 4
WIDTH, FILTERS, SPANS = 8, 8, (1, 2, 3)
#: Texts of the common share of toxic ones that each word counts as having been in beside its own.
PRIOR = 10
#: Function words by which a text's language is guessed.
FUNCTION_WORDS = {
    "en": "the and of to is that with for was are",
    "de": "der die und das den ein von mit zu im",
    "fr": "le la les et des est une dans pour que",
    "es": "el la los las y que una del por con",
}
LANGUAGES = (*FUNCTION_WORDS, "other")


def _word_hash(word: str) -> int:
    data = np.frombuffer(word.encode(), np.uint8)
    return int(X.Hasher(data, lower=True)(np.array([0]), np.array([len(data)]))[0])


@dataclass
class Features:
    """Word and stem buckets of all words of some texts, and the texts' bounds."""

    word: np.ndarray
    stem: np.ndarray
    bounds: np.ndarray
    language: np.ndarray


def features(texts: X.Texts) -> Features:
    hasher = X.Hasher(texts.data, lower=True)
    w = X.words(texts, X.ALNUM, True, hasher)
    stems = hasher(w.starts, np.minimum(w.ends, w.starts + STEM_BYTES))
    votes = np.stack([X.per_text(np.isin(w.hashes, np.array([_word_hash(x) for x in words.split()], np.uint64)), w.bounds) for words in FUNCTION_WORDS.values()], 1)
    language = np.where(votes.max(1, initial=0) > 0, votes.argmax(1), len(FUNCTION_WORDS))
    return Features((w.hashes % np.uint64(WORD_BUCKETS)).astype(np.int32), (stems % np.uint64(STEM_BUCKETS)).astype(np.int32), w.bounds, language)


class Network:
    def __init__(self, seed: int = 3):
        r = np.random.default_rng(seed)
        self.word = r.normal(0, 0.05, (WORD_BUCKETS, WIDTH)).astype(np.float32)
        self.stem = r.normal(0, 0.05, (STEM_BUCKETS, WIDTH)).astype(np.float32)
        self.filters = [r.normal(0, 0.3 / k, (k, WIDTH, FILTERS)).astype(np.float32) for k in SPANS]
        for f in self.filters:
            f[:, 0, : FILTERS // 2] = 0.5 / len(f)
        self.out = r.normal(0, 0.1, FILTERS * len(SPANS)).astype(np.float32)
        self.out.reshape(len(SPANS), FILTERS)[:, : FILTERS // 2] = 0.4
        self.bias = np.float32(-1.0)
        self.shift = np.zeros(len(LANGUAGES), np.float32)

    def pooled(self, word: np.ndarray, stem: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word vectors, and each filter's maximum over each text (at least 0)."""
        x = self.word[word] + self.stem[stem]
        n, texts = len(x), len(bounds) - 1
        top = np.zeros((texts, FILTERS * len(SPANS)), np.float32)
        counts = np.diff(bounds)
        for s, k in enumerate(SPANS):
            rows = np.flatnonzero(counts >= k)
            if not len(rows):
                continue
            y = x[: n - k + 1] @ self.filters[s][0]
            for j in range(1, k):
                y += x[j : n - k + 1 + j] @ self.filters[s][j]
            # a place that runs over its text's end counts for none
            for j in range(1, k):
                over = bounds[1:-1] - j
                y[over[(over >= 0) & (over < len(y))]] = -1e9
            at = bounds[:-1][rows]
            best = np.maximum.reduceat(y, at, axis=0)
            top[rows, s * FILTERS : (s + 1) * FILTERS] = np.maximum(best, 0)
        return x, top

    def logits(self, f: Features) -> np.ndarray:
        return self.pooled(f.word, f.stem, f.bounds)[1] @ self.out + self.bias


def _argmax(net: Network, x: np.ndarray, bounds: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each width: text, filter and first word of the places that hold the maxima above 0."""
    out = []
    for s, k in enumerate(SPANS):
        texts, filters, at = [], [], []
        for t in range(len(bounds) - 1):
            a, b = bounds[t], bounds[t + 1] - k + 1
            if b <= a:
                continue
            y = x[a:b] @ net.filters[s][0]
            for j in range(1, k):
                y += x[a + j : b + j] @ net.filters[s][j]
            i = y.argmax(0)
            live = np.flatnonzero(y[i, np.arange(FILTERS)] > 0)
            texts.append(np.full(len(live), t))
            filters.append(live)
            at.append(a + i[live])
        out.append(tuple(np.concatenate(c) if c else np.zeros(0, int) for c in (texts, filters, at)))
    return out


def _subset(f: Features, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    counts = np.diff(f.bounds)[rows]
    at = np.repeat(f.bounds[rows] - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
    return f.word[at], f.stem[at], np.concatenate([[0], np.cumsum(counts)])


def _features(rows: pa.RecordBatch | pa.Table) -> Features:
    """The features of labelled rows."""
    (word, bounds), (stem, _) = ((b"".join(x), np.cumsum([0, *map(len, x)]) // 4) for x in (rows.column(c).to_pylist() for c in ("word", "stem")))
    return Features(np.frombuffer(word, "<i4"), np.frombuffer(stem, "<i4"), bounds, rows.column("language").to_numpy())


def _pieces(batches: Iterator[pa.RecordBatch], limit: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """Labelled rows in pieces of at most `limit` bytes of text; a longer text is a piece of its own."""
    for batch in batches:
        ends, row = np.cumsum(batch.column("size").to_numpy()), 0
        while row < batch.num_rows:
            to = max(row + 1, int(np.searchsorted(ends, (ends[row - 1] if row else 0) + limit, "right")))
            yield batch.slice(row, to - row)
            row = to
    X.trim()


#: Parameters as rows of WIDTH: words, stems, then filters, output and bias; and ranges of rows that are summed together.
_REST = -(-(sum(SPANS) * WIDTH * FILTERS + FILTERS * len(SPANS) + 1) // WIDTH)
_ROWS, _PARTS, _TASKS = WORD_BUCKETS + STEM_BUCKETS + _REST, 256, 64
_PART_ROWS = -(-_ROWS // _PARTS)


def _flat(net: Network) -> np.ndarray:
    rest = np.concatenate([*[v.reshape(-1) for v in net.filters], net.out, [net.bias]]).astype(np.float32)
    return np.concatenate([net.word, net.stem, np.pad(rest, (0, _REST * WIDTH - len(rest))).reshape(-1, WIDTH)])


def _network(flat: np.ndarray) -> Network:
    net = Network.__new__(Network)
    net.word, net.stem, rest = (np.array(x, np.float32) for x in np.split(flat, [WORD_BUCKETS, WORD_BUCKETS + STEM_BUCKETS]))
    *filters, out, bias = np.split(rest.reshape(-1)[: sum(SPANS) * WIDTH * FILTERS + FILTERS * len(SPANS) + 1], np.cumsum([k * WIDTH * FILTERS for k in SPANS] + [FILTERS * len(SPANS)]))
    net.filters, net.out, net.bias = [v.reshape(k, WIDTH, FILTERS).copy() for v, k in zip(filters, SPANS, strict=True)], out.copy(), np.float32(bias[0])
    net.shift = np.zeros(len(LANGUAGES), np.float32)
    return net


_SPARSE = "part int, turn long, weight double, rows binary, amounts binary"


def _sparse(turn: int, weight: float, rows: np.ndarray, amounts: np.ndarray) -> pa.RecordBatch:
    """Amounts of some rows (ascending), a record for each range of rows."""
    cuts = np.searchsorted(rows, np.arange(_PARTS + 1) * _PART_ROWS)
    has = np.flatnonzero(np.diff(cuts))
    blobs = [pa.array([x[cuts[i] : cuts[i + 1]].astype(t).tobytes() for i in has], pa.binary()) for x, t in ((rows, "<i4"), (amounts, "<f4"))]
    return pa.RecordBatch.from_arrays([pa.array(has, pa.int32()), pa.array([turn] * len(has), pa.int64()), pa.array([weight] * len(has), pa.float64()), *blobs], names=["part", "turn", "weight", "rows", "amounts"])


def _summed(sparse: DataFrame, width: int, finish: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> list[tuple[int, np.ndarray]]:
    """For each range of rows its first row, and finish of the rows' weighted sums and weights, added up one record at a time in the order of turns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total, weights = None, np.zeros((0, width)), np.zeros(0)
        done = lambda: pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([finish(total, weights).astype("<f4").tobytes()], pa.binary())], names=["part", "sums"])
        for batch in batches:
            for i in range(batch.num_rows):
                p, _, weight, rows, amounts = (c[i].as_py() for c in batch.columns)
                if p != part:
                    if part is not None:
                        yield done()
                    part, total, weights = p, np.zeros((_PART_ROWS, width)), np.zeros(_PART_ROWS)
                at = np.frombuffer(rows, "<i4") - p * _PART_ROWS
                total[at] += weight * np.frombuffer(amounts, "<f4").reshape(-1, width)
                weights[at] += weight
        if part is not None:
            yield done()

    dealt = sparse.repartition(_TASKS, "part").sortWithinPartitions("part", "turn")
    return [(part * _PART_ROWS, np.frombuffer(sums, "<f4")) for part, sums in dealt.mapInArrow(run, "part int, sums binary").collect()]


def _start(rows: DataFrame, good: int, bad: int) -> Network:
    """The network before training: log-odds of all words and stems over all the rows, of which so many have each label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((WORD_BUCKETS + STEM_BUCKETS, 2))
        for piece in _pieces(batches):
            f, y = _features(piece), piece.column("y").to_numpy()
            own, n = X.owner(f.bounds), len(y)
            for ids, first in ((f.word, 0), (f.stem, WORD_BUCKETS)):
                seen = np.unique(ids.astype(np.int64) * n + own)
                np.add.at(counts, (first + seen // n, y[seen % n]), 1)
        seen = np.flatnonzero(counts.any(1))
        if len(seen):
            yield _sparse(0, 1.0, seen, counts[seen])

    def odds(total: np.ndarray, _: np.ndarray) -> np.ndarray:
        share = PRIOR * np.array([good, bad]) / (good + bad)  # a rare word is no sign by its few texts alone
        ratio = np.log((total[:, 1] + share[1]) / (bad + share[1])) - np.log((total[:, 0] + share[0]) / (good + share[0]))
        return np.where(total.sum(1) > 1, np.clip(ratio, -3, 3), 0)

    net, first = Network(), np.zeros(_PARTS * _PART_ROWS, np.float32)
    for at, values in _summed(rows.mapInArrow(run, _SPARSE), 2, odds):
        first[at : at + len(values)] = values
    net.word[:, 0], net.stem[:, 0] = first[:WORD_BUCKETS], first[WORD_BUCKETS : WORD_BUCKETS + STEM_BUCKETS]
    net.bias = np.float32(np.log((bad + 1) / (good + 1)))
    return net


def fit(net: Network, f: Features, y: np.ndarray, weight: np.ndarray, epochs: int = 4, batch: int = 64, rate: float = 0.08, seed: int = 3) -> None:
    """Trains the network on labels y; weight: of a row without and one with the label."""
    r = np.random.default_rng(seed)
    state = {k: np.full_like(v, 0.1) for k, v in (("word", net.word), ("stem", net.stem), ("out", net.out))}
    filter_state, bias_state = [np.full_like(v, 0.1) for v in net.filters], 0.1
    for _ in range(epochs):
        for rows in np.array_split(r.permutation(len(y)), max(1, len(y) // batch)):
            word, stem, bounds = _subset(f, rows)
            x, top = net.pooled(word, stem, bounds)
            p = 1 / (1 + np.exp(-(top @ net.out + net.bias)))
            g = ((p - y[rows]) * weight[y[rows]] / len(rows)).astype(np.float32)
            out_grad, dx = top.T @ g, np.zeros_like(x)
            filter_grads = [np.zeros_like(v) for v in net.filters]
            for s, (texts, filters, at) in enumerate(_argmax(net, x, bounds)):
                d = g[texts] * net.out[s * FILTERS + filters]
                for j in range(SPANS[s]):
                    np.add.at(filter_grads[s][j].T, filters, d[:, None] * x[at + j])
                    np.add.at(dx, at + j, d[:, None] * net.filters[s][j][:, filters].T)
            state["out"] += out_grad**2
            net.out -= rate * out_grad / np.sqrt(state["out"])
            bias_state += float(g.sum()) ** 2
            net.bias -= np.float32(rate * g.sum() / np.sqrt(bias_state))
            for v, grad, st in zip(net.filters, filter_grads, filter_state, strict=True):
                st += grad**2
                v -= rate * grad / np.sqrt(st)
            moved = np.flatnonzero(np.abs(dx).sum(1))
            for table, ids, st in ((net.word, word, state["word"]), (net.stem, stem, state["stem"])):
                u, inverse = np.unique(ids[moved], return_inverse=True)
                grad = np.zeros((len(u), WIDTH), np.float32)
                np.add.at(grad, inverse, dx[moved])
                st[u] += grad**2
                table[u] -= rate * grad / np.sqrt(st[u])


def _trained(rows: DataFrame, start: Network, weight: np.ndarray, shards: int) -> Network:
    """The mean of networks that were trained from one start on a shard of the rows each; a word's vector is the mean of those that moved it."""
    sent = rows.sparkSession.sparkContext.broadcast(start.__dict__)  # of fixed size

    def work(t: pa.Table) -> pa.Table:
        t = t.take(np.lexsort([t.column(c).to_numpy() for c in ("th", "at")]))
        own, before = Network.__new__(Network), Network.__new__(Network)
        before.__dict__ = sent.value
        own.__dict__ = copy.deepcopy(sent.value)
        fit(own, _features(t), t.column("y").to_numpy(), weight)
        moved = _flat(own) - _flat(before)
        some = np.flatnonzero(moved.any(1))
        X.trim()
        return pa.Table.from_batches([_sparse(t.column("shard")[0].as_py(), float(t.num_rows), some, moved[some])])

    dealt = rows.withColumn("shard", F.pmod("at", F.lit(shards).cast("long")))
    flat = _flat(start)
    for at, mean in _summed(groups.each(dealt, "shard", work, _SPARSE, shards, True), WIDTH, lambda total, weights: total / np.maximum(weights, 1)[:, None]):
        flat[at : at + _PART_ROWS] += mean.reshape(-1, WIDTH)[: _ROWS - at]
    sent.destroy()
    return _network(flat)


#: Logits are counted in so many steps to one, up to this size.
_STEPS, _MOST = 64, 32


def _calibrate(net: Network, rows: DataFrame) -> None:
    """Sets the thresholds by language to the best over all the rows, from counts by step of the logit."""
    sent = rows.sparkSession.sparkContext.broadcast(net.__dict__)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Network.__new__(Network)
        own.__dict__ = sent.value
        for piece in _pieces(batches):
            f = _features(piece)
            step = np.floor(_STEPS * (own.logits(f) + _MOST)).clip(0, 2 * _MOST * _STEPS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([piece.column("language"), piece.column("y"), pa.array(step)], names=["language", "y", "step"])

    counts = np.zeros((len(LANGUAGES), 2, 2 * _MOST * _STEPS), np.int64)
    for language, y, step, n in rows.mapInArrow(run, "language int, y int, step int").groupBy("language", "y", "step").count().collect():
        counts[language, y, step] = n
    sent.destroy()
    whole = _threshold(counts.sum(0))
    for i in range(len(LANGUAGES)):
        net.shift[i] = _threshold(counts[i]) if counts[i].sum(1).min() >= 20 else whole


def _threshold(counts: np.ndarray) -> float:
    """The logit with the best F1, from the rows without and with the label by step; halfway between neighbours."""
    hits, rows = (np.cumsum(x[::-1]) for x in (counts[1], counts.sum(0)))
    if not 0 < hits[-1] < rows[-1]:
        return 0.0
    steps = np.flatnonzero(counts.sum(0)[::-1])  # from the highest
    i = int((2 * hits[steps] / (rows[steps] + hits[-1])).argmax())
    low, next_ = (2 * _MOST * _STEPS - 1 - int(steps[x]) for x in (i, min(i + 1, len(steps) - 1)))
    return (low + (next_ + 1 if next_ < low else low)) / 2 / _STEPS - _MOST


_LABELLED = "at long, th long, y int, calibrates boolean, size long, language int, word binary, stem binary"


def _once(batches: Iterator[pa.RecordBatch], most: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """The rows without most repeats of key and text hash (the last two columns), so that copies of one row don't all go through a shuffle."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        new = []
        for pair in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            new.append(pair not in seen)
            seen.add(pair)
        if len(seen) > most:
            seen.clear()
        yield batch.filter(pa.array(new, pa.bool_()))


def _labelled(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, seed: int) -> DataFrame:
    """The features of every labelled text; a repeated row counts once."""
    known = labels.where(F.col(label).isNotNull()).groupBy(F.col(key).alias("_k")).agg((F.max(F.col(label).cast("int")) != 0).cast("int").alias("_y"))
    hashed = docs.select(F.col(key).alias("_k"), F.col(text).alias("_t"), F.xxhash64(F.col(key)).alias("_h"), F.xxhash64(F.col(text)).alias("_th"))
    some = groups.filtered(hashed, "_h", groups.key_filter(known.select(F.xxhash64("_k"))), True).mapInArrow(_once, hashed.schema)
    texts = some.join(known.hint("merge"), "_k").groupBy("_k", "_th").agg(F.min("_t").alias("_t"), F.min("_y").alias("_y"))  # where the join has put them
    at = lambda salt: F.xxhash64("_k", "_th", F.lit(salt))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in X.chunked(batch.column(4)):
                f, n = features(group), len(group)
                to = (4 * f.bounds).tolist()
                blobs = [pa.array([raw[a:b] for a, b in zip(to, to[1:], strict=False)], pa.binary()) for raw in (f.word.tobytes(), f.stem.tobytes())]
                own = [batch.column(i).slice(group.first, n) for i in range(4)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(np.diff(group.bounds)), pa.array(f.language.astype(np.int32)), *blobs], names=["at", "th", "y", "calibrates", "size", "language", "word", "stem"])

    return texts.select(at(seed), "_th", "_y", F.pmod(at(seed + 1), F.lit(4)) == 0, "_t").mapInArrow(run, _LABELLED)


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", max_rows: int = 6000, max_bytes: int = 48 << 20, seed: int = 5
) -> Network:
    """A network from all labelled rows. A quarter of them, drawn by a hash, sets the thresholds; the others are dealt by a hash into as many shards
    as max_rows rows and max_bytes bytes of text a shard ask for, on average. Every text is taken whole."""
    spark = docs.sparkSession
    with shared.scratch(spark):
        rows = shared.written(_labelled(docs, labels, key, text, label, seed), "toxic-rows")
        total = {(r["y"], r["calibrates"]): (r["n"], r["size"]) for r in rows.groupBy("y", "calibrates").agg(F.count("*").alias("n"), F.sum("size").alias("size")).collect()}
        counted = lambda y, *parts: np.sum([total.get((y, c), (0, 0)) for c in parts], axis=0)
        (good, size), (bad, more) = counted(0, False), counted(1, False)
        if not good or not bad:
            net = Network()
            net.out[:] = 0
            net.bias = np.float32(np.log((counted(1, False, True)[0] + 1) / (counted(0, False, True)[0] + 1)))
            return net
        used = rows.where("NOT calibrates")
        shards = int(max(1, -(-(good + bad) // max_rows), -(-(size + more) // max_bytes)))
        net = _trained(used, _start(used, int(good), int(bad)), (good + bad) / (2 * np.array([good, bad])), shards)
        _calibrate(net, rows.where("calibrates"))
        return net


def score(docs: DataFrame, net: Network, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, language (guessed from the text), score for each row."""
    model = docs.sparkSession.sparkContext.broadcast(net.__dict__)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Network.__new__(Network)
        own.__dict__ = model.value
        for batch in batches:
            for group in X.chunked(batch.column(1), 1 << 19):
                f = features(group)
                z = own.logits(f).astype(np.float64) - own.shift[f.language]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(group.first, len(group)), pa.array([LANGUAGES[i] for i in f.language]), pa.array(1 / (1 + np.exp(-np.clip(z, -50, 50))))], names=["key", "language", "score"])

    return docs.select(key, text).mapInArrow(run, f"key {docs.schema[key].dataType.simpleString()}, language string, score double").withColumnRenamed("key", key)
