"""Typed tables on Parquet: open or create, and replace without touching what is read.

A table is a folder of versions and a manifest that says which is the newest. A writer adds a folder of its own and
then publishes it, so a failed or unfinished write is never seen and a table can be rewritten from a query over
itself; `update` repeats the rewrite on what another writer has published in between.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from seqloom.sources import manifest, storage

# Declared tables of the catalog (fixed names and types).
SERIES = T.StructType([T.StructField(n, T.StringType()) for n in ("accession_id", "title", "summary", "child_gsm_ids")])
SAMPLES = T.StructType(
    [
        T.StructField(n, T.StringType())
        for n in ("accession_id", "title", "summary", "species", "raw_link", "srx_id", "parent_gse_id")
    ]
)
# Target column of the sample table -> column of the fetched record.
SAMPLE_SCHEME = {
    "accession_id": ("accession", "string"),
    "title": ("title", "string"),
    "summary": ("summary", "string"),
    "species": ("taxon", "string"),
    "raw_link": ("ftplink", "string"),
    "srx_id": ("SRA", "string"),
    "parent_gse_id": ("parent_gse", "string"),
}


def _write(df: DataFrame, path: str) -> str:
    folder = f"v-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{folder}")
    return folder


def _newest(spark: SparkSession, path: str, schema: T.StructType) -> tuple[int, DataFrame]:
    version, live = manifest.latest(spark, path)
    if not live:
        return version, spark.createDataFrame([], schema)
    return version, spark.read.schema(schema).parquet(f"{path}/{live[0]['folder']}")


def open_or_create(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The newest version of the table; an empty first version when there is none."""
    if manifest.latest(spark, path)[0] < 0:
        folder = _write(spark.createDataFrame([], schema), path)
        if not manifest.publish(spark, path, 0, [{"folder": folder}]):  # someone else has created it
            storage.delete(spark, f"{path}/{folder}")
    return _newest(spark, path, schema)[1]


def replace(df: DataFrame, path: str) -> DataFrame:
    """Write `df` as the next version; earlier ones stay for whoever has opened them.

    Of two writers at one time the one that publishes later has the newest version. A version made from the
    table's own rows belongs in `update`.
    """
    spark = df.sparkSession
    folder = _write(df, path)
    manifest.commit(spark, path, lambda live: [{"folder": folder}])
    return spark.read.schema(df.schema).parquet(f"{path}/{folder}")


def update(spark: SparkSession, path: str, schema: T.StructType, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Replace the table by `change` of its newest version, as if writers came one after the other.

    If another version is published meanwhile, the change is made again on that one, so no writer's rows are lost.
    """
    while True:
        version, current = _newest(spark, path, schema)
        folder = _write(change(current), path)
        if manifest.publish(spark, path, version + 1, [{"folder": folder}]):
            return spark.read.schema(schema).parquet(f"{path}/{folder}")
        storage.delete(spark, f"{path}/{folder}")


def drop_old(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete all but the newest `keep` versions; call it when no open frame reads an older one."""
    gone, _ = manifest.forget(spark, path, keep)
    for entry in gone:
        storage.delete(spark, f"{path}/{entry['folder']}")
