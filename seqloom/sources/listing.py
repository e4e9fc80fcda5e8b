"""Recursive file listings as frames; file contents are never read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.functions.files import path_basename

# What counts as a dumped file.
DUMPED_EXTENSIONS = (".bam", ".fastq")


def file_listing(spark: SparkSession, root: str) -> DataFrame:
    """path, name and length of every file under `root`.

    Spark lists level by level: wherever a level has many folders, with a job on the executors.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return listed.select("path", path_basename(F.col("path")).alias("name"), "length")


def dumped_ids(listing: DataFrame, pattern: str, extensions: tuple[str, ...] = DUMPED_EXTENSIONS) -> DataFrame:
    """Ids (first group of `pattern` in the path) that have a file with such an extension in its name."""
    wanted = F.lit(False)
    for extension in extensions:
        wanted = wanted | F.col("name").contains(extension)
    found = F.regexp_extract("path", pattern, 1)
    return listing.filter(wanted).select(found.alias("id")).filter("id != ''").distinct()
