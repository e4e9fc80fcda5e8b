"""Tab-separated run tables and sample lists.

A cell never holds a line end or a tab: they are written as backslash escapes, and null as
`\\N` while an empty text is a pair of quotes, so both come back as what they were.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqloom.sources import storage

_FORMAT = {
    "sep": "\t",
    "header": True,
    "quote": '"',
    "escape": '"',
    "nullValue": "\\N",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
# Escapes of a cell's text, the backslash's own first (fixed values).
_ESCAPES = (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"))


def _escaped(df: DataFrame) -> DataFrame:
    """String cells with the escapes; a null stays null and is written as `\\N`."""

    def cell(name: str) -> Column:
        text = F.col(name)
        for plain, mark in _ESCAPES:
            text = F.replace(text, F.lit(plain), F.lit(mark))
        return text.alias(name)

    strings = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.select(*[cell(c) if c in strings else F.col(c) for c in df.columns])


def _plain(df: DataFrame) -> DataFrame:
    """The escapes taken back, pairs of backslashes first of all."""

    def cell(name: str) -> Column:
        def piece(text: Column) -> Column:
            for plain, mark in _ESCAPES[1:]:
                text = F.replace(text, F.lit(mark), F.lit(plain))
            return text

        return F.array_join(F.transform(F.split(F.col(name), r"\\\\", -1), piece), "\\").alias(name)

    strings = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.select(*[cell(c) if c in strings else F.col(c) for c in df.columns])


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


# Declared columns (fixed names, spelled as in the stored files).
RUN_LIST = T.StructType(_strings("gsm_id", "sample_name"))
SAMPLE_LIST = T.StructType(_strings("SRR_ID", "sample_name"))
BRIDGE = T.StructType(_strings("SRR", "GSM", "GSE"))
RUN_TABLE = T.StructType(
    [
        *_strings("dumped_filepath", "dumped_filename", "cloud_filepath", "raw_filename", "sample_name"),
        *_strings("sample_id", "lane_id", "read_type", "run_id", "gsm_id", "gse_id", "egress", "filetype"),
        *_strings("spieces", "location"),
        T.StructField("replicate", T.IntegerType()),
    ]
)


class HeaderError(ValueError):
    """A file's header differs from the declared columns."""


def read_tsv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A TSV with a declared schema; an empty table when nothing is there yet."""
    if not storage.exists(spark, path):
        return spark.createDataFrame([], schema)
    return _plain(spark.read.options(**_FORMAT).schema(schema).csv(path))


def read_checked(spark: SparkSession, path: str, schema: T.StructType = SAMPLE_LIST) -> DataFrame:
    """A TSV whose header must equal the schema; a missing file is created as a template.

    The header is checked once here; `enforceSchema=false` makes every task check the
    header of the file it reads as well.
    """
    if not storage.exists(spark, path):
        spark.createDataFrame([], schema).coalesce(1).write.options(**_FORMAT).csv(path)
        raise FileNotFoundError(f"wrote an empty list with the expected header to {path}")
    try:
        found = spark.read.options(**_FORMAT).csv(path).columns
    except AnalysisException as error:
        raise HeaderError(str(error)) from error
    if found != schema.names:
        raise HeaderError(f"header must be {schema.names}, found {found}")
    return _plain(spark.read.options(**_FORMAT, enforceSchema=False).schema(schema).csv(path))


def write_tsv(df: DataFrame, path: str) -> None:
    _escaped(df).write.options(**_FORMAT).csv(path)
