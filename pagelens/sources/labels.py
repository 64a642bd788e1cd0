"""Outcome labels from CSV. Id S23 of the survey."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import js
from ..operators import joins
from . import lines

#: Fixed values.
STATUSES = ("INTERESSIERT", "GESCHLOSSEN", "NICHT_RELEVANT", "NO_ANSWER", "FOLLOWUP")
CHANNELS = ("MAIL", "CALL", "BESUCH")
COLUMNS = ("lead_id", "status", "channel", "notes")


def cells(line: Column) -> Column:
    """The cells of a line of CSV (array): quotes may stand anywhere in a cell, inside them commas are text and a doubled quote is one."""
    raw = F.regexp_extract_all(line, F.lit(r'((?:[^",]++|"(?:[^"]++|"")*+(?:"|\z))*+)(?:,|\z)'), F.lit(1))
    return F.transform(raw, lambda c: F.replace(F.regexp_replace(c, r'"((?:[^"]++|"")*+)(?:"|\z)', "$1"), F.lit('""'), F.lit('"')))


def checked_rows(spark: SparkSession, path: str) -> DataFrame:
    """File, row, lead_id, status, channel, notes, fault of every data line of CSV files with headers. fault: null, or what is wrong first.

    Rows count the lines that aren't empty, the header as 1. Columns are found by their names in each file's header. A file whose header lacks one has that as the fault of its
    first row, and none of its other rows."""
    parsed = lines.numbered(spark, path).withColumn("_cells", cells(F.col("line"))).drop("line")
    header = parsed.where("row = 1").select("file", F.transform("_cells", lambda c: F.lower(js.trim(c))).alias("_header"))
    lacking = F.filter(F.array(*[F.lit(c) for c in COLUMNS]), lambda c: ~F.array_contains("_header", c))
    heads = header.withColumn("_lacking", F.get(lacking, F.lit(0)))
    joined = parsed.join(joins.dimension(heads), "file").where((F.col("row") > 1) | F.col("_lacking").isNotNull()).where((F.col("row") == 1) | F.col("_lacking").isNull())
    cell = lambda n: F.coalesce(F.get("_cells", (F.array_position("_header", n) - 1).cast("int")), F.lit(""))
    trimmed = {n: F.when(F.col("row") > 1, js.trim(cell(n))) for n in COLUMNS[:3]}
    rows = joined.select("file", "row", "_lacking", *[v.alias(n) for n, v in trimmed.items()], F.when(F.col("row") > 1, cell("notes")).alias("notes"))
    fault = (
        F.when(F.col("_lacking").isNotNull(), F.concat(F.lit("header lacks the column "), "_lacking"))
        .when(F.col("lead_id") == "", F.lit("lead_id is missing"))
        .when(~F.col("status").isin(*STATUSES), F.concat(F.lit('invalid status "'), "status", F.lit('"')))
        .when((F.col("channel") != "") & ~F.col("channel").isin(*CHANNELS), F.concat(F.lit('invalid channel "'), "channel", F.lit('"')))
    )
    return rows.select("file", "row", *[F.nullif(F.col(c), F.lit("")).alias(c) for c in COLUMNS], fault.alias("fault"))


def read_labels(spark: SparkSession, path: str, created_at: int) -> DataFrame:
    """lead_id, status, channel, notes, created_at of CSV files. All is checked before any row is used: a fault is an error that names its file and row."""
    rows = checked_rows(spark, path)
    wrong = rows.where(F.col("fault").isNotNull()).orderBy("file", "row").limit(1).collect()
    if wrong:
        raise ValueError(f"row {wrong[0].row} of {wrong[0].file}: {wrong[0].fault}; statuses: {', '.join(STATUSES)}; channels: {', '.join(CHANNELS)}")
    return rows.select(*COLUMNS, F.lit(created_at).cast("long").alias("created_at"))
