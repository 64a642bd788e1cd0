"""Versioned tables: upserts and appends. Ids K1, K3, W6, T3 of the survey."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import dedupe


def merged(existing: DataFrame, new: DataFrame, key: str = "place_id", at: str = "audited_at") -> DataFrame:
    """K1: the table after an upsert: every key of the new rows has its newest new row, all others keep theirs."""
    fresh = dedupe.latest(new, key, at, key)
    return existing.join(fresh.select(key), key, "left_anti").select(*existing.columns).unionByName(fresh.select(*existing.columns))


class VersionedTable:
    """A Parquet table in numbered versions. A version is readable once its directory is complete, so readers never see half a run."""

    def __init__(self, spark, path: str, schema):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _fs(self):
        jvm = self.spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(self.path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at, jvm

    def versions(self) -> list[int]:
        fs, at, jvm = self._fs()
        if not fs.exists(at):
            return []
        found = []
        for s in fs.listStatus(at):
            name = s.getPath().getName()
            if name.startswith("v") and name[1:].isdigit() and fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")):
                found.append(int(name[1:]))
        return sorted(found)

    def read(self) -> DataFrame:
        have = self.versions()
        if not have:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/v{have[-1]}")

    def upsert(self, new: DataFrame, key: str = "place_id", at: str = "audited_at") -> int:
        """Writes the next version and returns its number."""
        n = (self.versions() or [0])[-1] + 1
        merged(self.read(), new, key, at).write.mode("overwrite").parquet(f"{self.path}/v{n}")
        return n


def append_outcomes(outcomes: DataFrame, path: str) -> None:
    """K3: outcomes at the end of the log, with ids that no other row has."""
    spark = outcomes.sparkSession
    rows = outcomes.withColumn("id", F.coalesce(F.col("id") if "id" in outcomes.columns else F.lit(None).cast("long"), F.abs(F.xxhash64("lead_id", "status", "created_at", F.expr("uuid()")))))
    rows.select("id", "lead_id", "status", "channel", "notes", "created_at").write.mode("append").parquet(path)
    spark.catalog.refreshByPath(path)
