"""As-of joins, and answers from a cache that serves stale ones when a fetch fails. Id T2 of the survey.

A key's rows are split by time buckets: inside a bucket a window carries the newest entry on, and what was the newest before it comes from one row for each key and
bucket. So a key that a third of all rows share is spread over its buckets and never sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def newest_before(left: DataFrame, right: DataFrame, key: str, left_at: str, right_at: str, tie: str, bucket_seconds: int = 3600, name: str = "entry") -> DataFrame:
    """left with a struct of right's newest row of the same key at or before each row's time, or null; of equally new ones the one with the larger tie-break.

    Rows with a null key or time have none; repeated rows stay repeated."""
    bucket = lambda at: F.floor(F.unix_micros(F.col(at).cast("timestamp")) / (bucket_seconds * 1_000_000))
    entry = F.struct(*[F.col(c) for c in right.columns])
    row = F.struct(*[F.col(c) for c in left.columns])
    no = lambda df: F.lit(None).cast(df.schema.simpleString())
    known = right.where(F.col(key).isNotNull() & F.col(right_at).isNotNull())
    entries = known.select(F.col(key).alias("_key"), bucket(right_at).alias("_bucket"), F.col(right_at).alias("_at"), F.lit(0).alias("_side"), F.col(tie).alias("_tie"), no(left).alias("_row"), entry.alias("_entry"))
    asked = left.select(F.col(key).alias("_key"), bucket(left_at).alias("_bucket"), F.col(left_at).alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast(right.schema[tie].dataType).alias("_tie"), row.alias("_row"), no(right).alias("_entry"))
    able = F.col("_key").isNotNull() & F.col("_at").isNotNull()
    own = Window.partitionBy("_key", "_bucket").orderBy("_at", "_side", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    inside = entries.unionByName(asked.where(able)).withColumn("_found", F.last("_entry", ignorenulls=True).over(own)).where("_side = 1")
    # the newest entry before each bucket: over one row for each key and bucket
    last = entries.groupBy("_key", "_bucket").agg(F.max_by("_entry", F.struct("_at", "_tie")).alias("_last"))
    spans = last.unionByName(asked.where(able).select("_key", "_bucket").distinct().withColumn("_last", no(right))).groupBy("_key", "_bucket").agg(F.first("_last", ignorenulls=True).alias("_last"))
    before = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.select("_key", "_bucket", F.last("_last", ignorenulls=True).over(before).alias("_carried"))
    found = inside.join(carried, ["_key", "_bucket"], "left").select("_row.*", F.coalesce("_found", "_carried").alias(name))
    return found.unionByName(asked.where(~able).select("_row.*", no(right).alias(name)))


def answered(requests: DataFrame, entries: DataFrame, attempts: DataFrame, ttl_days: int) -> DataFrame:
    """Requests (request_id, key, at) with source, answer and age_days: a fresh cache entry, else the new answer of the attempt, else, where it failed or none was made, the newest stale entry.

    entries: key, created_at, answer (a null answer is an unreadable entry: no entry at all); attempts: request_id, answer, error, one for each request; source is `fresh`, `new`, `stale` or `failed`.
    age_days: whole days of the entry that was served."""
    cached = newest_before(requests, entries.where(F.col("answer").isNotNull()).select("key", "created_at", "answer"), "key", "at", "created_at", "answer", name="_entry")
    made = attempts.select("request_id", F.when(F.col("error").isNull(), F.col("answer")).alias("_new"))
    joined = cached.join(made, "request_id", "left")
    age = (F.unix_micros(F.col("at").cast("timestamp")) - F.unix_micros(F.col("_entry.created_at").cast("timestamp"))) / 86_400_000_000
    source = F.when(age < ttl_days, F.lit("fresh")).when(F.col("_new").isNotNull(), F.lit("new")).when(F.col("_entry").isNotNull(), F.lit("stale")).otherwise(F.lit("failed"))
    out = joined.withColumn("source", source)
    served = F.col("source").isin("fresh", "stale")
    answer = F.when(served, F.col("_entry.answer")).when(F.col("source") == "new", F.col("_new"))
    return out.withColumn("answer", answer).withColumn("age_days", F.when(served, F.floor(age))).select(*requests.columns, "source", "answer", "age_days")
