"""Tables between stages: written to the folder that driver and executors share, so that a lost executor loses no work and plans stay short."""

from __future__ import annotations

import contextlib
import tempfile
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; where it is unset, as in local tests, a new folder is set once."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        at = "file://" + tempfile.mkdtemp(prefix="pagelens-")
        spark.sparkContext.setCheckpointDir(at)
    return at


#: Open scopes by thread, innermost last: the paths of their tables.
_scopes: dict[int, list[list[str]]] = {}


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables written inside are deleted at the end, also where it fails. Frames that read them are void then."""
    stack = _scopes.setdefault(threading.get_ident(), [])
    stack.append([])
    try:
        yield
    finally:
        for path in stack.pop():
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        if not stack:
            del _scopes[threading.get_ident()]


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder, read back."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    for scope in _scopes.get(threading.get_ident(), [])[-1:]:
        scope.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
