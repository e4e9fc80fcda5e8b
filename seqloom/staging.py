"""Written intermediate tables in the folder all executors share.

A physical row order survives a lost executor only if it is on shared storage, so
operators that must read an order twice write it here instead of caching it.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from seqloom.sources import storage

_local_roots: dict[str, str] = {}
# Paths handed out inside the caller's own scope; each thread and task has its own.
_scope: ContextVar[list[str] | None] = ContextVar("seqloom_scope", default=None)


def shared_root(spark: SparkSession) -> str:
    """The cluster's `spark.checkpoint.dir`; a temporary folder only on a local master."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="seqloom-")
        atexit.register(shutil.rmtree, _local_roots[app], ignore_errors=True)
    return _local_roots[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A path nobody has written yet."""
    path = f"{shared_root(spark)}/seqloom-{label}-{uuid.uuid4().hex}"
    inside = _scope.get()
    if inside is not None:
        inside.append(path)
    return path


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Delete, on leaving, the intermediate tables written inside by the same caller.

    Results that still read them must be written before the end of the block.
    """
    paths: list[str] = []
    token = _scope.set(paths)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in paths:
            storage.delete(spark, path)


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write `df` once to shared storage and read it back."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
