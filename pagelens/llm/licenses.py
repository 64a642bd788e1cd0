"""License scans: fuzzy search for short notices.

A notice may be found with up to k character edits. Cut into k + 1 pieces, at least one piece stands unchanged in every such
place (pigeonhole), so exact search for the pieces finds all candidates. Only there, in a window of bounded size, the `regex` library's
bounded-error matching runs, verifies the edits and gives the span; of matches that overlap the one with fewest edits stays. Exact phrases are counted beside it on the same normalised text.

Normalised text: A-Z lower-cased, words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` joined by single spaces. Spans are word positions.

Defined cases: a null or empty text has no words, no label and score 0; repeated rows are scanned each; of equally good matches that overlap
the first stays; a very long text is scanned whole, in linear time; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from . import text as X

#: Phrases whose every place counts, and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Short notices by label, as they stand in file headers and page footers, normalised.
NOTICES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("gpl-2", "licensed under the gnu general public license version 2"),
    ("lgpl", "gnu lesser general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "creative commons attribution sharealike"),
    ("all-rights-reserved", "all rights reserved"),
)


@dataclass(frozen=True)
class Pattern:
    """pieces: (offset in the notice, bytes)."""

    label: str
    notice: bytes
    edits: int
    pieces: tuple[tuple[int, bytes], ...]
    fuzzy: str


def compile_notices(notices=NOTICES, chars_per_edit: int = 12) -> list[Pattern]:
    """One edit is allowed for each chars_per_edit characters. A version number at the end isn't edited away: it stands outside the fuzzy part."""
    out = []
    for label, notice in notices:
        stem = regex.sub(r"[0-9 ]*$", "", notice)
        tail = notice[len(stem) :]
        edits = len(stem) // chars_per_edit
        bounds = [len(stem) * i // (edits + 1) for i in range(edits + 2)]
        pieces = tuple((a, stem[a:b].encode()) for a, b in zip(bounds, bounds[1:], strict=False))
        fuzzy = f"(?b)(?<![^ ])(?:{regex.escape(stem)}){{e<={edits}}}{regex.escape(tail)}(?![^ ])"
        out.append(Pattern(label, notice.encode(), edits, pieces, fuzzy))
    return out


def normalised(texts: X.Texts) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All texts as normalised bytes, each ` word word ` and then a line feed; bounds in them; numbers of words."""
    starts, ends = X.runs(X.ALNUM[texts.data], texts.bounds)
    counts = np.diff(np.searchsorted(starts, texts.bounds))
    keep = X.ALNUM[texts.data]
    lowered = X._LOWER[texts.data[keep]]
    lengths = ends - starts
    own = np.repeat(np.arange(len(texts)), counts)
    # a space after each word; before the first of each text a space; after the last a line feed
    at = np.arange(len(lowered)) + np.repeat(np.arange(len(starts)) + 2 * own + 1, lengths)
    out = np.full(len(lowered) + len(starts) + 2 * len(texts), 0x20, np.uint8)
    out[at] = lowered
    sizes = np.bincount(own, weights=lengths + 1, minlength=len(texts)).astype(np.int64) + 2
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    out[bounds[1:] - 1] = 0x0A
    return out.tobytes(), bounds, counts


def find_all(data: bytes, what: bytes) -> list[int]:
    """All places, overlapping ones too."""
    out, at = [], data.find(what)
    while at >= 0:
        out.append(at)
        at = data.find(what, at + 1)
    return out


class Scanner:
    def __init__(self, patterns: list[Pattern], phrases: dict[str, str]):
        self.patterns, self.fuzzy = patterns, [regex.compile(p.fuzzy) for p in patterns]
        self.phrases = [(f" {p} ".encode(), label) for p, label in phrases.items()]

    def __call__(self, texts: X.Texts) -> list[tuple]:
        """For each text: n_words, base places [(first word, label)], matches [(label, first word, end word, edits, score)]."""
        data, bounds, counts = normalised(texts)
        base: dict[int, list] = {}
        spaces = np.concatenate([[0], np.cumsum(np.frombuffer(data, np.uint8) == 0x20)])
        for phrase, label in self.phrases:
            for at in find_all(data, phrase):
                row = int(np.searchsorted(bounds, at, "right")) - 1
                base.setdefault(row, []).append((int(spaces[at] - spaces[bounds[row]]), label))
        matches: dict[int, list] = {}
        for p, fuzzy in zip(self.patterns, self.fuzzy, strict=True):
            windows: set[tuple[int, int, int]] = set()
            for offset, piece in p.pieces:
                for at in find_all(data, piece):
                    row = int(np.searchsorted(bounds, at, "right")) - 1
                    # an edit may put in a character of four bytes; a match begins and ends with a word, so a window does too
                    lo, hi = max(at - offset - 4 * p.edits, int(bounds[row]) + 1), min(at - offset + len(p.notice) + 4 * p.edits, int(bounds[row + 1]) - 2)
                    lo, hi = data.find(b" ", lo - 1, at + 1) + 1, data.rfind(b" ", at, hi + 1)
                    if 0 < lo < hi:
                        windows.add((row, lo, hi))
            for row, a, b, edits in apart({(row, *m) for row, lo, hi in windows for m in places(fuzzy, data[lo:hi], lo, len(p.notice) - p.edits)}):
                first = int(spaces[a] - spaces[bounds[row]]) - 1
                last = int(spaces[b] - spaces[bounds[row]]) - 1
                matches.setdefault(row, []).append((p.label, first, last + 1, edits, 1 - edits / len(p.notice)))
        return [(int(counts[i]), sorted(base.get(i, [])), sorted(set(matches.get(i, [])))) for i in range(len(texts))]


def places(fuzzy: regex.Pattern, window: bytes, at: int, least: int) -> Iterator[tuple[int, int, int]]:
    """Start, end and edits of matches in a window at byte `at`: the best one, and those before and behind it in the same way."""
    text = window.decode()
    byte = (lambda i: at + i) if len(text) == len(window) else (lambda i: at + len(text[:i].encode()))
    todo = [(0, len(text))]
    while todo:
        a, b = todo.pop()
        m = fuzzy.search(text[a:b]) if b - a >= least else None
        if m:
            yield byte(a + m.start()), byte(a + m.end()), sum(m.fuzzy_counts)
            todo += [(a, a + m.start() - 1), (a + m.end() + 1, b)]


def apart(found: set[tuple[int, int, int, int]]) -> Iterator[tuple[int, int, int, int]]:
    """Of (text, start, end, edits), those that overlap no better one that is chosen; the earlier one counts as better where edits are equal."""
    taken: dict[int, list[tuple[int, int]]] = {}
    for row, a, b, edits in sorted(found, key=lambda m: (m[3], m[0], m[1], m[2])):
        own = taken.setdefault(row, [])
        i = bisect.bisect(own, (a, b))
        if (i == 0 or own[i - 1][1] < a) and (i == len(own) or b < own[i][0]):
            own.insert(i, (a, b))
            yield row, a, b, edits


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", notices=NOTICES, phrases=None) -> DataFrame:
    """key, n_words, base array<struct<word,label>>, matches array<struct<label,first_word,end_word,edits,score>>, score double.

    score: 1 with a phrase, else the best match's share of unedited characters, else 0."""
    patterns, phrases = compile_notices(notices), PHRASES if phrases is None else phrases
    schema_match = "array<struct<label:string,first_word:bigint,end_word:bigint,edits:bigint,score:double>>"
    schema = f"key {docs.schema[key].dataType.simpleString()}, n_words long, base array<struct<word:bigint,label:string>>, matches {schema_match}, score double"
    base_type = pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))
    match_type = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("edits", pa.int64()), ("score", pa.float64())]))
    names = ["key", "n_words", "base", "matches", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(patterns, phrases)
        for batch in batches:
            for group in X.chunked(batch.column(1)):
                found = scanner(group)
                score = [1.0 if b else max((m[4] for m in ms), default=0.0) for _, b, ms in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(group.first, len(group)),
                        pa.array([x[0] for x in found], pa.int64()),
                        pa.array([[{"word": w, "label": lab} for w, lab in x[1]] for x in found], base_type),
                        pa.array([[dict(zip(("label", "first_word", "end_word", "edits", "score"), m, strict=True)) for m in x[2]] for x in found], match_type),
                        pa.array(score, pa.float64()),
                    ],
                    names=names,
                )

    return docs.select(key, text).mapInArrow(run, schema).withColumnRenamed("key", key)
