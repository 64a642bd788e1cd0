"""Packing of token streams: concatenate and cut.

Pass one tokenises every text once and writes ids with each text's offset inside its partition. The partitions' totals give,
by a prefix sum, each partition's first token in one global stream; pass two cuts the stream into windows of fixed length. A
text that crosses a window's end leaves a boundary record in each window that it touches. Only the last window may be short.

Defined cases: a null or empty text is the end token alone; repeated rows are packed once each; an empty table gives no
piece; a text longer than a window fills several, and is encoded whole; rows stand in the order of their partitions, keys (repeated, null) play no
part in it; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared
from . import text as X

#: Texts of these characters only are split alike by both libraries, whatever their Unicode versions.
_COMMON = regex.compile(r"[\x09\x0A\x0D\x20-\x7E¡-¬®-ɏͰ-ͳΆΈ-ϿА-я‐-‧‰-⁞€]*+")
#: From this many characters without white space on the rank library's merging is slow.
LONG_RUN = 2000
_SPACE = regex.compile(r"\s")


def has_long_run(text: str) -> bool:
    """Whether LONG_RUN characters in a row are no white space. Each look goes to a space as far ahead as a shorter run may reach; a pattern would count at every word."""
    at = 0
    while len(text) - at >= LONG_RUN:
        space = text.rfind(" ", at, at + LONG_RUN)
        if space < 0:
            found = _SPACE.search(text, at, at + LONG_RUN)
            if not found:
                return True
            space = found.start()
        at = space + 1
    return False


class Encoder:
    """Ids of the `tokenizers` file. Ordinary texts go through the rank file of the same vocabulary, which takes a third of the
    time; texts with a special token's string, unusual characters or very long words go through `tokenizers` itself."""

    def __init__(self, json_path: str, rank_path: str | None):
        with open(json_path, encoding="utf-8") as f:
            self.special = [t["content"] for t in json.load(f)["added_tokens"]]
        self.json_path, self._exact, self.fast = json_path, None, None
        if rank_path:
            import public_tokenizers
            import tiktoken

            with open(rank_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @property
    def exact(self):
        """Loaded when a text first needs it."""
        if self._exact is None:
            from tokenizers import Tokenizer

            self._exact = Tokenizer.from_file(self.json_path)
        return self._exact

    def __call__(self, text: str) -> list[int]:
        if self.fast and _COMMON.fullmatch(text) and not any(s in text for s in self.special) and not has_long_run(text):
            return self.fast.encode_ordinary(text)
        return self.exact.encode(text, add_special_tokens=False).ids


_encoders = X._Local()


def encoder(*paths) -> Encoder:
    """One encoder for each Python worker."""
    if paths not in _encoders:
        _encoders[paths] = Encoder(*paths)
    return _encoders[paths]


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def tokenize(docs: DataFrame, key: str = "doc_id", text: str = "text", end_id: int = 0, paths: tuple[str, str | None] | None = None) -> DataFrame:
    """key, part int, first long (tokens of the partition before this text), n_tokens long, ids binary (little-endian uint32)."""
    paths = paths or default_paths()
    end = np.array([end_id], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, before = encoder(*paths), TaskContext.get().partitionId(), 0
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                rows = batch.slice(start, 256)
                ids = [np.concatenate([np.array(encode(t) if t else [], "<u4"), end]) for t in rows.column(1).to_pylist()]
                n = np.array([len(x) for x in ids], np.int64)
                first = before + np.cumsum(n) - n
                before += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(np.full(len(n), part, np.int32)), pa.array(first), pa.array(n), pa.array([x.tobytes() for x in ids], pa.binary())],
                    names=["key", "part", "first", "n_tokens", "ids"],
                )
            X.trim()

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"key {kind}, part int, first long, n_tokens long, ids binary")


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 1024, end_id: int = 0, paths=None, with_ids: bool = True) -> DataFrame:
    """One row for each piece of a text in a window: key, start and length (tokens of the text), doc_tokens, sequence_id and offset
    (the window, and the place in it), ids_crc32 (of the ids as little-endian uint32), and the ids if asked for."""
    tokens = shared.written(tokenize(docs, key, text, end_id, paths), "tokens")
    totals = tokens.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()  # one number for each partition
    bases, at = {}, 0
    for part, n in sorted(map(tuple, totals)):
        bases[part] = at
        at += n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                rows = batch.slice(lo, 512)
                n = rows.column(3).to_numpy()
                at = np.array([bases[p] for p in rows.column(1).to_pylist()], np.int64) + rows.column(2).to_numpy()
                pieces = (at + n - 1) // length - at // length + 1
                own = np.repeat(np.arange(len(n)), pieces)
                nth = np.arange(len(own)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                sequence = at[own] // length + nth
                start = np.maximum(sequence * length, at[own]) - at[own]
                stop = np.minimum((sequence + 1) * length, at[own] + n[own]) - at[own]
                ids = [memoryview(x) for x in rows.column(4).to_pylist()]
                cut = [ids[i][4 * a : 4 * b] for i, a, b in zip(own.tolist(), start.tolist(), stop.tolist(), strict=True)]
                out = [rows.column(0).take(pa.array(own)), pa.array(start), pa.array(stop - start), pa.array(n[own]), pa.array(sequence), pa.array(at[own] + start - sequence * length), pa.array([zlib.crc32(x) for x in cut], pa.int64())]
                names = ["key", "start", "length", "doc_tokens", "sequence_id", "offset", "ids_crc32"]
                if with_ids:
                    out.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in cut], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names=names)
            X.trim()

    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids_crc32 long" + ", ids array<int>" * with_ids
    return tokens.mapInArrow(run, schema).withColumnRenamed("key", key)
