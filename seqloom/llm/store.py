"""Intermediate tables in the shared folder, compressed, the shuffles behind them let go, and names of rows."""

from __future__ import annotations

import gc
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.operators.positions import with_pos
from seqloom.staging import new_path, scope, stage


def store(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to shared storage and read it back: lineage ends here."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, label: str, make: Callable[[], DataFrame]) -> DataFrame:
    """Write what `make` gives, then delete the intermediate tables that it wrote on the way."""
    path = new_path(spark, label)
    with scope(spark):
        made = make()
        made.write.option("compression", "zstd").parquet(path)
    release(spark)
    return spark.read.schema(made.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete shuffle files that no live frame refers to.

    The cleaner acts on what the driver's garbage collector has found, so this asks for a full collection there.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


ROW = "_row"
#: Bits of a row's name that hold its place in its file; those above hold the file's number.
_PLACE_BITS = 40
#: Files of a table up to which their names pass through the driver.
MOST_FILES = 10_000
_PASSED_THROUGH = ("Project", "Filter", "SubqueryAlias")


def _of_one_table(df: DataFrame) -> bool:
    """Whether `df` is a scan of files, each row at most once."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() in _PASSED_THROUGH:
        plan = plan.children().apply(0)
    return plan.nodeName() == "LogicalRelation"


def _numbered_files(placed: DataFrame) -> DataFrame:
    """(__file, __no), the files in order of their paths; sent to every executor only while there are few."""
    files = placed.select("__file").distinct()
    paths = sorted(r[0] for r in files.limit(MOST_FILES + 1).collect())
    if len(paths) <= MOST_FILES:
        return F.broadcast(placed.sparkSession.createDataFrame(list(enumerate(paths)), "__no long, __file string"))
    return stage(with_pos(stage(files, "files"), "__file", pos="__no"), "files")


def number_rows(df: DataFrame) -> DataFrame:
    """`df` with `_row`, a number of its own for every row, the same in every job however the scan is split.

    A row of a Parquet table is named by its file (the files in order of their paths) and its place in that
    file. Any other frame is written once with its numbers.
    """
    if _of_one_table(df) and "_metadata" not in (c.lower() for c in df.columns):
        try:
            placed = df.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__place"))
        except AnalysisException:  # no Parquet
            placed = None
        if placed is not None:
            named = F.shiftleft("__no", _PLACE_BITS) + F.col("__place")
            return placed.join(_numbered_files(placed), "__file").select(*[F.col(f"`{c}`") for c in df.columns], named.alias(ROW))
    return stage(df.withColumn(ROW, F.monotonically_increasing_id()), "numbered")


REST = "__rest"


def pack_rest(df: DataFrame, *kept: str) -> DataFrame:
    """The columns `kept` and one struct of all others, so that no name of theirs meets one of ours."""
    rest = [F.col(f"`{c}`") for c in df.columns if c not in kept] or [F.lit(0).alias("none")]
    return df.select(F.struct(*rest).alias(REST), *kept)


def rest_of(columns: list[str], kept: tuple[str, ...], made: dict[str, Column] | None = None) -> list[Column]:
    """Selects `columns` again from a packed frame; `made` gives new values of some."""
    made = made or {}
    return [made.get(c, F.col(c) if c in kept else F.col(REST).getField(c)).alias(c) for c in columns]
