"""Exports as CSV, JSON and JSON lines, and the append-only logs. Ids K4-K7, K9, K10, X26 of the survey.

Exports are written by the tasks, in the rows' order, and then put together by the file system; no row passes through the driver.
"""

from __future__ import annotations

import csv
import json
import os
import uuid

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text
from ..schemas import EXPORT, struct

BOM, LINE_END = "﻿", "\r\n"


def cell(field: T.StructField) -> Column:
    """A column as text of a CSV cell: null is empty, booleans are 1 and 0, timestamps are UTC dates, breakdowns `KEY+3; KEY-1`, other lists joined by commas."""
    c, kind = F.col(field.name), field.dataType
    if isinstance(kind, T.BooleanType):
        out = F.when(c, F.lit("1")).otherwise(F.lit("0"))
        return F.when(c.isNull(), F.lit("")).otherwise(out)
    if isinstance(kind, T.TimestampType):
        value = F.date_format(c, "yyyy-MM-dd")
    elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        value = text.breakdown_text(c)
    elif isinstance(kind, T.ArrayType):
        value = F.array_join(c, ",")
    else:
        value = c.cast("string")
    return F.coalesce(text.csv_cell(value, ";"), F.lit(""))


def csv_lines(rows: DataFrame, ddl: str = EXPORT) -> DataFrame:
    """K4: one column `line`: the rows' cells joined by semicolons."""
    return rows.select(F.concat_ws(";", *[cell(f) for f in struct(ddl)]).alias("line"))


class _Files:
    """A folder of part files beside the target, put together by the file system."""

    def __init__(self, spark, path: str):
        jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.Path, self.io = jvm.org.apache.hadoop.fs.Path, jvm.org.apache.commons.io.IOUtils
        self.spark, self.target = spark, self.Path(path)
        self.folder = f"{path}.parts-{uuid.uuid4().hex}"
        self.fs = self.target.getFileSystem(self.conf)

    def _put(self, name: str, data: bytes):
        at = self.Path(f"{self.folder}/{name}")
        out = self.fs.create(at, True)
        out.write(bytearray(data))
        out.close()
        return at

    def _copy(self, at, out, count: int) -> None:
        source = self.fs.open(at)
        try:
            self.io.copyLarge(source, out, 0, count)
        finally:
            source.close()

    def _rows(self, lines: DataFrame, name: str, separator: str) -> list:
        """Part files (path, bytes) of the rows in their order, written by the tasks, with `separator` behind each row."""
        lines.write.option("lineSep", separator).text(f"{self.folder}/{name}")
        parts = [s for s in self.fs.listStatus(self.Path(f"{self.folder}/{name}")) if s.getPath().getName().startswith("part-") and s.getLen()]
        return [(s.getPath(), s.getLen()) for s in sorted(parts, key=lambda s: s.getPath().getName())]

    def write(self, lines: DataFrame, separator: str, head: str = "", tail: str = "", empty: str = "") -> None:
        """The rows as one file. tail: takes the last separator's place; empty: the file without rows.

        Where the file system can, the parts are joined by their metadata alone; else their bytes are copied one behind the other, in small pieces."""
        try:
            pieces = self._rows(lines, "rows", separator)
            if not pieces and empty:
                head, tail = empty, ""
            if pieces and tail:
                last, n = pieces.pop()
                short = self.Path(f"{self.folder}/short")
                out = self.fs.create(short, True)
                self._copy(last, out, n - len(separator.encode()))
                out.write(bytearray(tail.encode()))
                out.close()
                pieces.append((short, n))
            self._join([self._put("head", head.encode())] * bool(head) + [p for p, _ in pieces])
        finally:
            self.fs.delete(self.Path(self.folder), True)

    def write_all(self, pieces: list) -> None:
        """Texts, and rows of one column (a line each), one behind the other."""
        try:
            found = []
            for i, piece in enumerate(pieces):
                found += [self._put(f"text{i}", piece.encode())] if isinstance(piece, str) else [at for at, _ in self._rows(piece, f"rows{i}", "\n")]
            self._join(found)
        finally:
            self.fs.delete(self.Path(self.folder), True)

    def _join(self, pieces: list) -> None:
        whole = self.Path(f"{self.folder}/whole")
        self.fs.create(whole, True).close()
        try:
            rest = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Path, len(pieces))
            for i, p in enumerate(pieces):
                rest[i] = p
            self.fs.concat(whole, rest)
        except (UnsupportedOperationException, Py4JJavaError):  # most file systems have no concat
            out = self.fs.create(whole, True)
            for p in pieces:
                self._copy(p, out, self.fs.getFileStatus(p).getLen())
            out.close()
        self.fs.delete(self.target, False)
        if not self.fs.rename(whole, self.target):
            raise OSError(f"can't write {self.target}")


def write_pieces(spark, path: str, pieces: list) -> None:
    """K8: a text file of texts and frames of lines in their order."""
    _Files(spark, path).write_all(pieces)


def write_csv(rows: DataFrame, path: str, ddl: str = EXPORT) -> None:
    """K4: a file with byte order mark, header, semicolons and CRLF."""
    header = ";".join(f.name for f in struct(ddl))
    _Files(rows.sparkSession, path).write(csv_lines(rows, ddl), LINE_END, BOM + header + LINE_END)


def json_rows(rows: DataFrame, ddl: str = EXPORT) -> DataFrame:
    """One column `value`: each row as JSON, keys in order, nulls kept, timestamps as UTC dates."""
    columns = [F.date_format(f.name, "yyyy-MM-dd").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name) for f in struct(ddl)]
    return rows.select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value"))


def indented(value: Column) -> Column:
    """JSON objects as entries of an array, indented by two spaces."""

    @F.pandas_udf("string")
    def entry(values: pd.Series) -> pd.Series:
        return values.map(lambda v: "\n".join("  " + x for x in json.dumps(json.loads(v), indent=2, ensure_ascii=False).split("\n")))

    return entry(value)


def write_json(rows: DataFrame, path: str, ddl: str = EXPORT) -> None:
    """K5: a JSON array, indented by two spaces."""
    entries = json_rows(rows, ddl).select(indented(F.col("value")).alias("value"))
    _Files(rows.sparkSession, path).write(entries, ",\n", "[\n", "\n]", "[]")


def label_lines(labelled: DataFrame) -> DataFrame:
    """K6: one column `value`: a label with its audit's features as JSON. Timestamps are epoch milliseconds; a label without audit has no features."""
    features = labelled.schema["features"].dataType
    millis = [F.unix_millis(F.col(f"features.{f.name}")).alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f"features.{f.name}").alias(f.name) for f in features]
    names = [F.col(c) for c in ("lead_id", "status", "channel", "notes", "created_at", "score")]
    whole = F.to_json(F.struct(*names, F.struct(*millis).alias("features")), {"ignoreNullFields": "false"})
    bare = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    return labelled.select(F.when(F.col("features").isNull(), F.concat(F.regexp_replace(bare, r"\}\z", ""), F.lit(',"features":{}}'))).otherwise(whole).alias("value"))


def write_jsonl(lines: DataFrame, path: str) -> None:
    """K6: one JSON object a line."""
    _Files(lines.sparkSession, path).write(lines, "\n")


def append_log(rows: DataFrame, path: str) -> int:
    """K7: rows at the end of a CSV log whose header is written with the file; instants in ISO form. Returns the number of rows."""
    columns = [F.date_format(f.name, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name).cast("string") for f in rows.schema]
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    new, n = not os.path.exists(path), 0
    with open(path, "a", encoding="utf-8", newline="") as f:
        out = csv.writer(f, lineterminator="\n")
        if new:
            out.writerow(rows.columns)
        for row in rows.select(*columns).toLocalIterator():
            out.writerow(["" if v is None else v for v in row])
            n += 1
    return n


def listing(candidates: DataFrame) -> DataFrame:
    """K9: one column `line`: candidates as tab-separated text."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("place_id", "name", "industry", "plz", "website") if c in candidates.columns]
    return candidates.select(F.concat_ws("\t", *cells).alias("line"))


def cached(answers: DataFrame, path: str, basis: list[str]) -> None:
    """Stored answers keyed by the hash of what was asked, added to a Parquet cache."""
    answers.withColumn("key", text.cache_key(*[F.col(b) for b in basis])).write.mode("append").parquet(path)
