"""Lines of text files with their numbers. Part of S23 of the survey.

Files are read in splits, in parallel. Each split's lines are counted first; prefix sums over a file's splits (one row for each split) give what stands before it, and a
line's place in its split gives the rest. Nothing is sorted and no file passes through one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import joins


def numbered(spark: SparkSession, path: str) -> DataFrame:
    """file, row (from 1), line of all lines that aren't empty; a line ends with LF or CR LF. path: a file, a folder or a pattern."""
    ends = spark.read.option("lineSep", "\n").text(path)
    lines = ends.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_split"), F.regexp_replace("value", r"\r\z", "").alias("line")).where("line <> ''")
    placed = lines.withColumn("_at", F.monotonically_increasing_id())  # splits stand one behind the other in a partition
    splits = placed.groupBy("file", "_split").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    w = Window.partitionBy("file").orderBy("_split")
    before = splits.withColumn("_before", F.sum("_n").over(w) - F.col("_n")).drop("_n")
    return placed.join(joins.dimension(before), ["file", "_split"]).select("file", (F.col("_before") + F.col("_at") - F.col("_first") + 1).alias("row"), "line")
