"""The nested accession store: three sections of JSON (or Parquet) records.

Older records name the id `id` and give the species of a series as one string; both
forms are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqloom.functions.accession import split_taxon
from seqloom.sources import storage


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


_CHILD = T.StructType(_strings("accession", "title"))
SERIES = T.StructType(
    [
        *_strings("runid", "title", "summary"),
        T.StructField("species", T.ArrayType(T.StringType())),
        *_strings("raw_link", "projna_id", "srp_id"),
        T.StructField("child_gsm_ids", T.ArrayType(_CHILD)),
    ]
)
SAMPLE = T.StructType(
    [
        *_strings("runid", "title", "summary", "species", "raw_link", "srx_id"),
        T.StructField("child_srr_ids", T.ArrayType(T.StringType())),
        *_strings("parent_gse_id"),
    ]
)
RUN_FILE = T.StructType(_strings("runid", "path", "size", "filetype", "lane_id", "readtype", "parent_gsm"))
SECTIONS = {"GSE": SERIES, "GSM": SAMPLE, "SRR": RUN_FILE}


def _stored(section: str) -> T.StructType:
    """What may be in a file: both id spellings, and species as raw text."""
    fields = [*_strings("id"), *SECTIONS[section].fields]
    return T.StructType([*_strings("species")] + [f for f in fields if f.name != "species"])


def _species(text):
    is_list = text.startswith("[")
    return F.when(is_list, F.from_json(F.when(is_list, text), "array<string>")).otherwise(split_taxon(text))


def read_store(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The sections GSE, GSM and SRR; a section that is absent is empty."""
    sections = {}
    for name, schema in SECTIONS.items():
        folder = f"{path}/{name}"
        if not storage.exists(spark, folder):
            sections[name] = spark.createDataFrame([], schema)
            continue
        raw = spark.read.schema(_stored(name)).json(folder, mode="FAILFAST")
        raw = raw.withColumn("runid", F.coalesce("runid", "id"))
        if name == "GSE":
            raw = raw.withColumn("species", _species(F.col("species")))
        sections[name] = raw.select(*schema.names)
    return sections


def write_store(sections: dict[str, DataFrame], path: str) -> None:
    """Write each section as JSON lines, nulls included so every record has all fields."""
    for name, df in sections.items():
        df.select(*SECTIONS[name].names).write.option("ignoreNullFields", False).json(f"{path}/{name}")
