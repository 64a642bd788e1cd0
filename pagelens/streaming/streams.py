"""Streams of outcomes and audits. Ids T1, T3, T4 of the survey; additions to what the batch operators do."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.buckets import BucketedTable
from ..operators.upsert import VersionedTable


def upserting(audits: DataFrame, table: VersionedTable | BucketedTable, checkpoint: str, trigger: dict | None = None):
    """Every micro-batch is an upsert; a batch that is delivered twice gives the same table. A bucketed table rewrites the buckets that the batch touches only, and
    knows by number which batches of this checkpoint it has."""

    def apply(batch: DataFrame, number: int) -> None:
        if isinstance(table, BucketedTable):
            table.upsert(batch, batch=(checkpoint, number))
        elif batch.limit(1).count():
            table.upsert(batch)

    return audits.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def outcome_counts(outcomes: DataFrame, late: str = "1 hour", window: str = "1 day") -> DataFrame:
    """T4: outcomes by window and status of an append-only stream with created_at in milliseconds; later ones than `late` are left out."""
    at = outcomes.withColumn("at", F.timestamp_millis("created_at"))
    return at.withWatermark("at", late).groupBy(F.window("at", window), "status").agg(F.count("*").alias("count")).select(F.col("window.start").alias("start"), "status", "count")


def distinct_events(events: DataFrame, key: str, at: str, late: str = "1 hour") -> DataFrame:
    """Each key's first event within the watermark."""
    return events.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def sessions(events: DataFrame, user: str, at: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Sessions of a user: events closer than the gap."""
    return events.withWatermark(at, late).groupBy(F.session_window(at, gap).alias("s"), user).agg(F.count("*").alias("events")).select(user, F.col("s.start").alias("start"), F.col("s.end").alias("end"), "events")


def expiring(audits: DataFrame, at: str = "audited_at", days: int = 30) -> DataFrame:
    """When each audited place is due again."""
    return audits.select("place_id", (F.col(at) + F.make_dt_interval(F.lit(days))).alias("due"))
