"""A keyed table in hashed buckets: upserts that rewrite only the buckets they touch, and lookups that read only theirs. Ids K1, T3, S21 of the survey.

Each key has one bucket by its hash. A manifest names the directory of every bucket; an upsert writes new directories for the touched buckets and then puts the next
manifest in place, which fails if another writer was faster: it starts anew on what that one left. Readers keep the manifest they started with, so they never see
half an upsert, and a job that dies leaves directories that no manifest names (`vacuum` deletes them). Files are sorted by key, so that their statistics and
Bloom filters leave out row groups in lookups. The driver holds the manifest only: one entry for each bucket.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import dedupe

#: Keys up to which a lookup hands its keys to the scan as literals.
FEW_KEYS = 1000


class BucketedTable:
    """buckets: how many; so many that one bucket's rows are a task's work. It is fixed once the table exists."""

    def __init__(self, spark: SparkSession, path: str, schema: str | T.StructType, key: str = "place_id", buckets: int = 64):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        fs, at = self._fs(), self._path("manifests")
        names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n.removesuffix(".json").isdigit())

    def manifest(self, version: int | None = None) -> dict:
        """buckets: bucket -> directory below the table; applied: writer -> its last batch."""
        have = self.versions()
        if not have:
            return {"version": 0, "count": self.buckets, "buckets": {}, "applied": {}}
        jvm, stream = self.spark._jvm, self._fs().open(self._path("manifests", f"{version or have[-1]}.json"))
        try:
            return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, manifest: dict) -> bool:
        """Puts the manifest in place unless its version exists."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        staged, to = (self._fs().makeQualified(self._path("manifests", n)) for n in (f".{uuid.uuid4().hex}", f"{manifest['version']}.json"))
        out = self._fs().create(staged, True)
        out.write(bytearray(json.dumps(manifest), "utf-8"))
        out.close()
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(conf).rename(staged, to, none)
        except Py4JJavaError as e:
            self._fs().delete(staged, False)
            if "FileAlreadyExists" not in str(e.java_exception):
                raise
            return False
        return True

    def bucket(self, key: Column) -> Column:
        """A key's bucket; a null key has one too."""
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _read(self, manifest: dict, wanted: list[int] | None = None) -> DataFrame:
        paths = [f"{self.path}/{at}" for b, at in manifest["buckets"].items() if wanted is None or int(b) in wanted]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def read(self, version: int | None = None) -> DataFrame:
        return self._read(self.manifest(version))

    def upsert(self, new: DataFrame, at: str = "audited_at", batch: tuple[str, int] | None = None) -> int:
        """Each key of the new rows has its newest new row afterwards, all others keep theirs. Returns the version that holds them.

        batch: writer and number; a batch that was applied before changes nothing."""
        staged = f"staged/{uuid.uuid4().hex}"
        dedupe.latest(new.select(*self.schema.names), self.key, at, self.key).withColumn("_bucket", self.bucket(F.col(self.key))).write.parquet(f"{self.path}/{staged}")
        try:
            fresh = self.spark.read.schema(T.StructType([*self.schema, T.StructField("_bucket", T.IntegerType())])).parquet(f"{self.path}/{staged}")
            return self._merge(fresh, batch)
        finally:
            self._fs().delete(self._path(staged), True)

    def _merge(self, fresh: DataFrame, batch: tuple[str, int] | None) -> int:
        touched = sorted(r[0] for r in fresh.select("_bucket").distinct().collect())
        while True:
            manifest = self.manifest()
            if manifest["count"] != self.buckets:
                raise ValueError(f"the table has {manifest['count']} buckets")
            if not touched or (batch and manifest["applied"].get(batch[0], -1) >= batch[1]):
                return manifest["version"]
            old = self._read(manifest, touched).withColumn("_bucket", self.bucket(F.col(self.key)))
            keys = fresh.select(F.col("_bucket").alias("_of"), F.col(self.key).alias("_key"))
            kept = old.join(keys, (F.col("_bucket") == F.col("_of")) & F.col(self.key).eqNullSafe(F.col("_key")), "left_anti")
            to = f"data/{uuid.uuid4().hex}"
            dealt = kept.unionByName(fresh).repartition(len(touched), "_bucket").sortWithinPartitions("_bucket", self.key)
            dealt.write.option(f"parquet.bloom.filter.enabled#{self.key}", "true").partitionBy("_bucket").parquet(f"{self.path}/{to}")
            manifest["version"] += 1
            manifest["buckets"] |= {str(b): f"{to}/_bucket={b}" for b in touched}
            if batch:
                manifest["applied"][batch[0]] = batch[1]
            if self._commit(manifest):
                return manifest["version"]

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows of the keys (first column of `keys`); only their buckets are read, and of those, for few keys, only row groups that may hold them."""
        wanted = keys.select(F.col(keys.columns[0]).alias(self.key)).where(F.col(self.key).isNotNull()).distinct().withColumn("_bucket", self.bucket(F.col(self.key)))
        few = wanted.limit(FEW_KEYS + 1).collect()
        manifest = self.manifest()
        if len(few) <= FEW_KEYS:
            found = self._read(manifest, sorted({r["_bucket"] for r in few}))
            return found.where(F.col(self.key).isin(*[r[self.key] for r in few])) if few else found.limit(0)
        touched = sorted(r[0] for r in wanted.select("_bucket").distinct().collect())
        return self._read(manifest, touched).join(wanted.select(self.key), self.key, "left_semi")

    def vacuum(self, keep: int = 2) -> int:
        """Deletes old manifests but for the newest `keep`, and directories that no kept one names; returns how many. Not to be run beside a writer."""
        fs, versions = self._fs(), self.versions()
        named = {at.split("/_bucket")[0] for v in versions[-keep:] for at in self.manifest(v)["buckets"].values()}
        inside = {f"{at}" for v in versions[-keep:] for at in self.manifest(v)["buckets"].values()}
        gone = 0
        for v in versions[:-keep]:
            gone += fs.delete(self._path("manifests", f"{v}.json"), False)
        for s in fs.listStatus(self._path("data")) if fs.exists(self._path("data")) else []:
            to = f"data/{s.getPath().getName()}"
            if to not in named:
                gone += fs.delete(s.getPath(), True)
            else:
                gone += sum(fs.delete(p.getPath(), True) for p in fs.listStatus(s.getPath()) if p.isDirectory() and f"{to}/{p.getPath().getName()}" not in inside)
        return gone
