"""Tables written to the folder that driver and executors share, to cut lineage so that lost executors lose no work."""

from __future__ import annotations

import contextlib
import tempfile
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The shared folder: spark.checkpoint.dir of the session. Where it is unset, as in local tests, a new folder is set once."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        at = "file://" + tempfile.mkdtemp(prefix="pagelens-")
        spark.sparkContext.setCheckpointDir(at)
    return at


#: Open scopes by thread, innermost last: the paths of their tables. A plain dict, as functions sent to executors carry it.
_scopes: dict[int, list[list[str]]] = {}


def deleted(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Tables written inside are deleted at the end, also where it fails; what is to outlive it is written with outlive=True and belongs to the scope around it, if there is one.
    Frames that read deleted tables are void."""
    stack = _scopes.setdefault(threading.get_ident(), [])
    stack.append([])
    try:
        yield stack[-1]
    finally:
        for path in stack.pop():
            deleted(spark, path)
        if not stack:
            del _scopes[threading.get_ident()]


def written(df: DataFrame, name: str, compression: str = "zstd", outlive: bool = False) -> DataFrame:
    """The frame as a Parquet table in the shared folder, read back."""
    path = f"{folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    stack = _scopes.get(threading.get_ident(), [])
    scopes = stack[:-1] if outlive else stack
    if scopes:
        scopes[-1].append(path)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
