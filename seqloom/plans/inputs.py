"""Inputs of the registered queries: the given tables, and tables derived from them.

Derived tables are built by row-local formulas (a SQL twin stands beside each), so they
grow with the data and keep every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.functions import files
from seqloom.operators.positions import with_pos
from seqloom.selectors import POS


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A table's rows over all cores where it has fewer files than cores, for what builds or parses long texts of each row."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def orders_in_order(spark: SparkSession, sf: str) -> DataFrame:
    """Orders whose key serves as `_pos` where only the order matters."""
    return table(spark, sf, "orders").withColumn(POS, F.col("o_orderkey"))


def orders_seq(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Orders as a sequence with dense positions."""
    orders = table(spark, sf, "orders")
    return with_pos(orders.select("o_orderkey", *columns), "o_orderkey")


ORDERS_SEQ = "orders_seq AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS _pos FROM orders)"


def events_in_order(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumn(POS, F.col("event_id"))


def labelled_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with their label, null for most of them; the id is the position."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return docs.join(table(spark, sf, "labels"), "doc_id", "left").withColumn(POS, F.col("doc_id"))


LABELLED = """labelled AS (
  SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic, d.doc_id AS _pos
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


# --- hierarchy: nation -> customer -> order -> lineitem as series -> sample -> run -> file


def series(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").selectExpr("concat('GSE', n_nationkey) AS gse_id", "n_name AS series_title")


def samples(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").selectExpr(
        "concat('GSM', c_custkey) AS gsm_id", "concat('GSE', c_nationkey) AS gse_id", "c_name AS sample_title"
    )


def runs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(
        "concat('SRR', o_orderkey) AS run_id", "concat('GSM', o_custkey) AS gsm_id", "o_orderstatus AS status"
    )


SERIES = "series AS (SELECT 'GSE' || n_nationkey AS gse_id, n_name AS series_title FROM nation)"
SAMPLES = """samples AS (SELECT 'GSM' || c_custkey AS gsm_id, 'GSE' || c_nationkey AS gse_id,
  c_name AS sample_title FROM customer)"""
RUNS = """runs AS (SELECT 'SRR' || o_orderkey AS run_id, 'GSM' || o_custkey AS gsm_id,
  o_orderstatus AS status FROM orders)"""

_FILE_PATH = """CASE WHEN l_linenumber % 5 = 0
  THEN 's3://b/SRR' || l_orderkey || '/x' || l_partkey || '.bam.1'
  ELSE 's3://b/SRR' || l_orderkey || '/x' || l_partkey || '_S1_L00' || (1 + l_suppkey % 8) || '_'
    || CASE l_partkey % 4 WHEN 0 THEN 'R1' WHEN 1 THEN 'R2' WHEN 2 THEN 'I1' ELSE 'R3' END
    || '_001.fastq.gz' END"""
_SIZE_TEXT = """CAST(l_quantity AS BIGINT) || CASE l_suppkey % 5 WHEN 0 THEN 'T' WHEN 1 THEN 'G'
  WHEN 2 THEN 'M' WHEN 3 THEN 'K' ELSE '' END"""


def run_files(spark: SparkSession, sf: str) -> DataFrame:
    """One file per lineitem row."""
    return table(spark, sf, "lineitem").selectExpr(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "concat('SRR', l_orderkey) AS run_id",
        f"{_FILE_PATH} AS path",
        f"{_SIZE_TEXT} AS size",
    )


RUN_FILES = f"""run_files AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  'SRR' || l_orderkey AS run_id, {_FILE_PATH} AS path, {_SIZE_TEXT} AS size FROM lineitem)"""
FILE_KIND = """CASE WHEN path LIKE '%.fastq%' OR path LIKE '%.fq%' THEN 'fastq'
  WHEN path LIKE '%.bam%' THEN 'bam' ELSE 'unknown' END"""
SIZE_GB = """CASE WHEN size LIKE '%T%' THEN CAST(replace(size, 'T', '') AS DOUBLE) * 1024
  WHEN size LIKE '%G%' THEN CAST(replace(size, 'G', '') AS DOUBLE)
  WHEN size LIKE '%M%' THEN CAST(replace(size, 'M', '') AS DOUBLE) / 1024
  WHEN size LIKE '%K%' THEN CAST(replace(size, 'K', '') AS DOUBLE) / 1048576 ELSE 0.0 END"""


# --- run table: each order is a run of one to five files, some rows broken on purpose ----

N_FILES = "(CASE WHEN o_orderkey % 29 = 0 THEN 5 ELSE 1 + o_orderkey % 4 END)"
_KIND = "CASE WHEN o_orderkey % 5 = 0 THEN 'bam' ELSE 'fastq' END"
_READ = "CASE j WHEN 0 THEN 'R1' WHEN 1 THEN 'R2' WHEN 2 THEN 'I1' WHEN 3 THEN 'I2' ELSE 'R3' END"
RUN_COLUMNS = {
    "_pos": "o_orderkey * 8 + j",
    "run_id": "'SRR' || o_orderkey",
    "gsm_id": "'GSM' || o_custkey",
    "gse_id": "'GSE' || (o_custkey % 25)",
    "sample_name": "CASE WHEN o_orderkey % 97 = 0 THEN 'other' ELSE 'sample' END || o_custkey",
    "filetype": _KIND,
    "lane_id": "CASE WHEN o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 THEN NULL ELSE 'L00' || (1 + o_orderkey % 8) END",
    "read_type": f"CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE {_READ} END",
    "cloud_filepath": f"""CASE WHEN o_orderkey % 5 = 0 THEN 's3://b/SRR' || o_orderkey || '/x' || j || '.bam.1'
      WHEN o_orderkey % 13 = 0 THEN 's3://b/SRR' || o_orderkey || '/x' || j || '.fastq.gz'
      ELSE 's3://b/SRR' || o_orderkey || '/x_S1_L001_' || {_READ} || '_001.fastq.gz' END""",
    "location": "CASE WHEN (o_orderkey + j) % 3 = 0 THEN 'gs' ELSE 's3' END",
    "egress": "CASE WHEN (o_custkey + j) % 3 = 0 THEN 'worldwide' ELSE '-' END",
}


def run_table(spark: SparkSession, sf: str) -> DataFrame:
    """The run table with file names and paths; missing parts show up as `None` in them."""
    orders = spread(table(spark, sf, "orders").select("o_orderkey", "o_custkey"))
    files_of = orders.selectExpr("o_orderkey", "o_custkey", f"explode(sequence(0L, {N_FILES} - 1)) AS j")
    rows = files_of.selectExpr(*[f"{sql} AS {name}" for name, sql in RUN_COLUMNS.items()])
    read = F.when(F.col("read_type") != "", F.col("read_type"))
    kind, sample = F.col("filetype"), F.col("gsm_id")
    filename = files.dumped_filename(sample, kind, F.lit("S1"), F.col("lane_id"), read)
    named = rows.withColumn("dumped_filename", filename)
    path = files.dumped_path(F.col("sample_name"), sample, kind, F.col("dumped_filename"))
    return named.withColumn("dumped_filepath", path)


_SQL_COLUMNS = ", ".join(f"{sql} AS {name}" for name, sql in RUN_COLUMNS.items())
RUN_TABLE = f"""spread AS (SELECT o_orderkey, o_custkey, unnest(range({N_FILES})) AS j FROM orders),
named AS (SELECT {_SQL_COLUMNS} FROM spread),
filed AS (SELECT *, CASE WHEN filetype = 'bam' THEN gsm_id || '.bam'
  ELSE gsm_id || '_S1_' || coalesce(lane_id, 'None') || '_'
    || coalesce(nullif(read_type, ''), 'None') || '_001.fastq.gz' END AS dumped_filename FROM named),
run_table AS (SELECT *, sample_name || '/0_dumped/' || gsm_id || '/'
  || CASE WHEN filetype = 'bam' THEN 'bams' ELSE 'fastqs' END || '/' || dumped_filename AS dumped_filepath
  FROM filed)"""


def finished_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Runs whose output is already there: the finished orders."""
    done = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")
    return done.selectExpr("concat('SRR', o_orderkey) AS run_id")


FINISHED = "finished AS (SELECT 'SRR' || o_orderkey AS run_id FROM orders WHERE o_orderstatus = 'F')"
