"""Quality rules as a short-circuit cascade.

Each rule rejects texts by counts over the whole text. A bounded sample gives every rule's cost (CPU seconds) and
selectivity (share rejected); the cascade runs the rules in the order of rejection per cost, and texts that an earlier rule
rejected are not looked at by later ones once dropping them saves work. A text is kept if no rule rejects it, so the order
changes the cost and the reported first failure, never the verdict.

Defined cases: a null or empty text has no words and is rejected by `few_words`; repeated rows are judged alike, each on its
own; ties between rules keep the order of RULES; a very long text is judged whole; an empty table gives an empty result; other columns pass through
untouched, whatever their names.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text as X

_SYMBOLS = X.byte_class(lambda b: b in b"#*$%&|<>")
_LETTERS = X.byte_class(lambda b: b >= 0x80 or chr(b).isalpha())
#: Rows compacted away before it pays to rebuild the word arrays.
_COMPACT_SHARE = 0.25


class Measures:
    """Counts of a group of texts, each computed when first asked for."""

    def __init__(self, texts: X.Texts):
        self.texts, self._got = texts, {}

    def __len__(self) -> int:
        return len(self.texts)

    def _once(self, name: str, make: Callable):
        if name not in self._got:
            self._got[name] = make()
        return self._got[name]

    @property
    def hasher(self) -> X.Hasher:
        return self._once("hasher", lambda: X.Hasher(self.texts.data))

    @property
    def words(self) -> X.Words:
        return self._once("words", lambda: X.words(self.texts, X.NOT_SPACE, False, self.hasher))

    @property
    def n_words(self) -> np.ndarray:
        return self._once("n_words", lambda: self.words.counts)

    @property
    def word_chars(self) -> np.ndarray:
        """Code points in words: bytes in words that begin a code point."""
        return self._once("word_chars", lambda: X.per_text(X.NOT_SPACE[self.texts.data] & ((self.texts.data & 0xC0) != 0x80), self.texts.bounds))

    @property
    def n_symbols(self) -> np.ndarray:
        return self._once("n_symbols", lambda: X.per_text(_SYMBOLS[self.texts.data], self.texts.bounds))

    @property
    def n_exclaims(self) -> np.ndarray:
        return self._once("n_exclaims", lambda: X.per_text((self.texts.data == 0x21) | (self.texts.data == 0x3F), self.texts.bounds))

    @property
    def n_letter_words(self) -> np.ndarray:
        def make():
            sums = np.concatenate([[0], np.cumsum(_LETTERS[self.texts.data])])
            return X.per_text(sums[self.words.ends] > sums[self.words.starts], self.words.bounds)

        return self._once("n_letter_words", make)

    def _lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Lines with a word, and those of them that equal an earlier line of their text."""
        starts, ends, own = lines(self.texts)
        has = np.searchsorted(self.words.starts, ends) > np.searchsorted(self.words.starts, starts)
        starts, ends, own = starts[has], ends[has], own[has]
        keys = self.hasher(starts, ends) ^ X.mix(own.astype(np.uint64) + np.uint64(1))
        _, first = np.unique(keys, return_index=True)
        n = np.bincount(own, minlength=len(self))
        return n, n - np.bincount(own[first], minlength=len(self))

    def _count_lines(self) -> None:
        if "n_lines" not in self._got:
            self._got["n_lines"], self._got["n_dup_lines"] = self._lines()

    @property
    def n_lines(self) -> np.ndarray:
        self._count_lines()
        return self._got["n_lines"]

    @property
    def n_dup_lines(self) -> np.ndarray:
        self._count_lines()
        return self._got["n_dup_lines"]

    @property
    def n_repeat_words(self) -> np.ndarray:
        def make(k: int = 5):
            keys, bounds = X.shingles(self.words.hashes, self.words.bounds, k, whole=False)
            own = X.owner(bounds)
            twice = np.flatnonzero(X.repeated(keys ^ X.mix(own.astype(np.uint64) + np.uint64(1))))
            first = self.words.bounds[own[twice]] + twice - bounds[own[twice]]
            step = np.zeros(len(self.words.hashes) + 1, np.int64)
            np.add.at(step, first, 1)
            np.add.at(step, first + k, -1)
            return X.per_text(np.cumsum(step[:-1]) > 0, self.words.bounds)

        return self._once("n_repeat_words", make)

    def take(self, keep: np.ndarray) -> Measures:
        """The measures of some of the texts; what is known of each text as a whole is carried over."""
        sizes = np.diff(self.texts.bounds)
        new = Measures(X.Texts(self.texts.data[np.repeat(keep, sizes)], np.concatenate([[0], np.cumsum(sizes[keep])]), 0))
        for name in ("n_words", "word_chars", "n_symbols", "n_exclaims", "n_letter_words", "n_lines", "n_dup_lines", "n_repeat_words"):
            if name in self._got:
                new._got[name] = self._got[name][keep]
        return new


def lines(texts: X.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends (without the line feed) and texts of all lines, empty ones included."""
    feeds = np.flatnonzero(texts.data == 10)
    own = np.searchsorted(texts.bounds, feeds, "right") - 1
    starts = np.concatenate([texts.bounds[:-1], feeds + 1])
    ends = np.concatenate([feeds, texts.bounds[1:]])
    order = np.argsort(np.concatenate([np.arange(len(texts)), own]), kind="stable")
    end_order = np.argsort(np.concatenate([own, np.arange(len(texts))]), kind="stable")
    return starts[order], ends[end_order], np.concatenate([np.arange(len(texts)), own])[order]


@dataclass(frozen=True)
class Rule:
    """rejects: from measures to a boolean for each text."""

    name: str
    rejects: Callable[[Measures], np.ndarray]


#: The first two are the base rules; the others' limits follow published practice for web text.
RULES = (
    Rule("few_words", lambda m: m.n_words < 10),
    Rule("repeated_windows", lambda m: 100 * m.n_repeat_words > 20 * m.n_words),
    Rule("symbols", lambda m: 10 * m.n_symbols > m.n_words),
    Rule("exclaims", lambda m: 10 * m.n_exclaims > 4 * m.n_words),
    Rule("word_length", lambda m: (m.word_chars < 2 * m.n_words) | (m.word_chars > 15 * m.n_words)),
    Rule("letter_words", lambda m: 10 * m.n_letter_words < 7 * m.n_words),
    Rule("dup_lines", lambda m: 2 * m.n_dup_lines > m.n_lines),
)


def estimate(texts: list[str], rules: tuple[Rule, ...] = RULES) -> list[dict]:
    """Of each rule alone over a sample: name, seconds, share rejected; in the order in which the cascade is to run them."""
    groups, found = list(X.chunked(pa.array(texts, pa.string()))), []
    for rule in rules:
        began, hit = time.process_time(), 0
        for group in groups:
            hit += int(rule.rejects(Measures(group)).sum())
        found.append({"name": rule.name, "seconds": max(time.process_time() - began, 1e-6), "rejected": hit / max(len(texts), 1)})
    return sorted(found, key=lambda x: -x["rejected"] / x["seconds"])


def cascade(texts: X.Texts, rules: list[Rule], measures: Measures | None = None) -> np.ndarray:
    """For each text the index of the first rule, in this order, that rejects it, or -1. What measures hold already is not counted again."""
    failed, rows, measures = np.full(len(texts), -1), np.arange(len(texts)), measures or Measures(texts)
    for i, rule in enumerate(rules):
        bad = rule.rejects(measures)
        failed[rows[bad & (failed[rows] < 0)]] = i
        gone = failed[rows] >= 0
        if np.diff(measures.texts.bounds)[gone].sum() > _COMPACT_SHARE * len(measures.texts.data):
            rows, measures = rows[~gone], measures.take(~gone)
        if not len(rows):
            break
    return failed


def plan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", sample_rows: int = 256, sample_bytes: int = 32 << 20, seed: int = 7) -> list[Rule]:
    """The rules in the cascade's order, from a sample of about sample_rows rows from all partitions, twice as many at most. Only the order depends on it.

    Texts beyond an even share of sample_bytes stay out of the sample, so that the driver holds no more than that."""
    share = min(1.0, sample_rows / max(docs.count(), 1))
    short = F.coalesce(F.octet_length(text), F.lit(0)) <= sample_bytes // (2 * sample_rows)
    sample = [r[0] for r in docs.select(text).sample(fraction=share, seed=seed).where(short).limit(2 * sample_rows).collect()]
    by = {r.name: r for r in rules}
    return [by[x["name"]] for x in estimate(sample, rules)]


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(docs: DataFrame, keys: tuple[str, ...] = ("doc_id",), text: str = "text", rules: tuple[Rule, ...] = RULES, counts: bool = True) -> DataFrame:
    """keys, the counts if asked for, kept boolean, failed_rule string (null if kept) for each row."""
    order = plan(docs, rules, text)
    names = [r.name for r in order]
    fields = [docs.schema[k] for k in keys] + [T.StructField(c, T.LongType()) for c in (_COUNTS if counts else ())]
    fields += [T.StructField("kept", T.BooleanType()), T.StructField("failed_rule", T.StringType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in X.chunked(batch.column(len(keys))):
                m = Measures(group)
                known = [pa.array(np.asarray(getattr(m, c), np.int64)) for c in _COUNTS] if counts else []
                failed = cascade(group, order, m)
                part = batch.slice(group.first, len(group))
                out = [part.column(i) for i in range(len(keys))]
                out += [*known, pa.array(failed < 0), pa.array([None if i < 0 else names[i] for i in failed], pa.string())]
                yield pa.RecordBatch.from_arrays(out, names=[f.name for f in fields])

    return docs.select(*keys, text).mapInArrow(run, T.StructType(fields))


def keep_good(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows whose text no rule rejects, with all their columns."""
    order, at = plan(docs, rules, text), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in X.chunked(batch.column(at)):
                yield batch.slice(group.first, len(group)).filter(pa.array(cascade(group, order) < 0))

    return docs.mapInArrow(run, docs.schema)
