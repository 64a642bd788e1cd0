"""Fill-in-the-middle transformation of texts for training.

Each text is decoded to a UTF-32 array of code points. Where a space follows a word a token ends, so one comparison of neighbouring
classes gives all token bounds; two chosen ranks among them cut the text into prefix, middle and suffix, which are sliced from
the array, re-encoded and joined in one of two orders behind marks. The draws come from a digest of seed and key, so a run repeated after lost
executors gives the same rows. `restored` rebuilds the text from output and form alone.

Tokens: `[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+`, from left to right.

Defined cases: a null or empty text has no token, is plain, and its output is empty; a text that holds a mark stays plain, so that restoring is
always exact; a null key draws as an empty one; rows with equal keys draw alike; an all-space text is one token; a very long text is cut whole;
an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text as X

#: Marks before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")


def bounds(codes: np.ndarray) -> np.ndarray:
    """0 and the ends of all tokens."""
    if not len(codes):
        return np.zeros(1, np.int64)
    space = (codes == 0x20) | (codes - np.uint32(9) < 5)  # below 9 it wraps to a large value
    return np.concatenate([[0], np.flatnonzero(space[1:] & ~space[:-1]) + 1, [len(codes)]])


def check(marks: tuple[str, str, str]) -> None:
    """Marks have to be found again wherever they were put: none may begin inside another one or at its end."""
    for i, a in enumerate(marks):
        for k, b in enumerate(marks):
            if not a or any(b.startswith(a[cut:]) for cut in range(i == k, len(a))) or (i != k and a in b):
                raise ValueError(f"marks {a!r} and {b!r} can't be told apart")


def draws(key: Column, seed: int) -> list[Column]:
    """Four numbers below 2**32 from the digest of `seed:key`."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def cut(text: str, draw: tuple[int, int, int, int], rate: int, spm: int, marks: tuple[str, str, str]) -> tuple:
    """n, form, prefix_chars, middle_chars, output."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    at = bounds(codes)
    n = len(at) - 1
    if not n or draw[2] % 100 >= rate or any(m in text for m in marks):
        return n, "plain", None, None, text
    lo, hi = (int(at[r]) for r in sorted((draw[0] % (n + 1), draw[1] % (n + 1))))
    prefix, middle, suffix = (codes[a:b].tobytes().decode("utf-32-le") for a, b in ((0, lo), (lo, hi), (hi, len(codes))))
    p, s, m = marks
    if draw[3] % 100 < spm:
        return n, "spm", lo, hi - lo, f"{s}{suffix}{p}{prefix}{m}{middle}"
    return n, "psm", lo, hi - lo, f"{p}{prefix}{s}{suffix}{m}{middle}"


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 42, rate: int = 50, spm: int = 80, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """key, n (tokens), form (plain, psm or spm), prefix_chars and middle_chars (code points, null where plain), output.

    rate: percent of texts that are cut; spm: percent of those in suffix-prefix-middle order."""
    check(marks)
    schema = T.StructType([
        T.StructField("key", docs.schema[key].dataType), T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType()),
    ])
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            drawn = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(2, 6)]
            for group in X.chunked(batch.column(1)):
                raw, ends = group.data.tobytes(), group.bounds
                rows = []
                for i in range(len(group)):
                    draw = tuple(int(d[group.first + i]) for d in drawn)
                    rows.append(cut(raw[ends[i] : ends[i + 1]].decode(), draw, rate, spm, marks))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(group.first, len(group)), *columns], names=schema.names)

    given = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), *(d.alias(f"h{i}") for i, d in enumerate(draws(F.col(key), seed))))
    return given.mapInArrow(run, schema).withColumnRenamed("key", key)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text before the transformation."""
    p, s, m = marks

    def pieces(first: str, second: str) -> tuple[Column, Column, Column]:
        body = F.substr(output, F.lit(len(first) + 1))
        a = F.substring_index(body, second, 1)
        rest = F.substr(body, F.length(a) + len(second) + 1)
        b = F.substring_index(rest, m, 1)
        return a, b, F.substr(rest, F.length(b) + len(m) + 1)

    prefix, suffix, middle = pieces(p, s)
    suffix_first, prefix_second, middle_last = pieces(s, p)
    return F.when(form == "psm", F.concat(prefix, middle, suffix)).when(form == "spm", F.concat(prefix_second, middle_last, suffix_first)).otherwise(output)
