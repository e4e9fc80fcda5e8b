"""`mapInArrow` whose functions find this package on every executor.

The package is zipped once per application and handed to Spark, which serves it to all Python workers,
also to those of executors that join later.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_shipped: set[str] = set()
#: Rows of an Arrow batch: with whole texts in them, Spark's default would fill a worker's memory.
BATCH_ROWS = 1000


def ship(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="seqloom-code-")  # the driver's own: Spark serves the file from there
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, "seqloom_code.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for inside, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(inside, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def map_arrow(df: DataFrame, run: Callable, schema: str | StructType) -> DataFrame:
    """`mapInArrow` over batches of `BATCH_ROWS`; the session keeps that setting, since Spark reads it when the frame runs."""
    ship(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return df.mapInArrow(run, schema)
