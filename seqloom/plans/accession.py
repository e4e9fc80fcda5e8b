"""Queries for the scalar functions on ids, paths, names and sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.functions import accession, files
from seqloom.operators import runtable
from seqloom.plans import inputs
from seqloom.plans.inputs import FILE_KIND, RUN_FILES, RUN_TABLE, SIZE_GB
from seqloom.plans.registry import query
from seqloom.selectors import POS

_ID = "l_orderkey, l_partkey, l_suppkey, l_linenumber"


def _files_with(spark: SparkSession, sf: str, **columns) -> DataFrame:
    df = inputs.run_files(spark, sf)
    return df.select(*_ID.split(", "), *[c.alias(n) for n, c in columns.items()])


_IDS = """ids AS (SELECT 'GSE' || n_nationkey AS id FROM nation UNION ALL SELECT 'GSM' || c_custkey FROM customer
  UNION ALL SELECT 'SRR' || o_orderkey FROM orders UNION ALL SELECT 'PRJ' || p_partkey FROM part)"""


@query(
    "accession_kind",
    f"""WITH {_IDS} SELECT id, CASE WHEN id LIKE 'GSE%' THEN 'GSE' WHEN id LIKE 'GSM%' THEN 'GSM'
    WHEN id LIKE 'SRR%' THEN 'SRR' ELSE 'none' END AS kind FROM ids""",
)
def accession_kind(spark: SparkSession, sf: str) -> DataFrame:
    ids = inputs.series(spark, sf).selectExpr("gse_id AS id")
    ids = ids.union(inputs.samples(spark, sf).selectExpr("gsm_id AS id"))
    ids = ids.union(inputs.runs(spark, sf).selectExpr("run_id AS id"))
    ids = ids.union(inputs.table(spark, sf, "part").selectExpr("concat('PRJ', p_partkey) AS id"))
    return ids.withColumn("kind", F.coalesce(accession.accession_kind(F.col("id")), F.lit("none")))


@query(
    "expand_accession_ranges",
    """SELECT c_custkey, 'GSM' || (c_custkey + n) AS id FROM customer, (VALUES (0), (1), (2), (9)) AS t(n)""",
)
def expand_accession_ranges(spark: SparkSession, sf: str) -> DataFrame:
    asked = inputs.table(spark, sf, "customer").selectExpr(
        "c_custkey", "concat('GSM', c_custkey, ':GSM', c_custkey + 2, ',GSM', c_custkey + 9) AS text"
    )
    return asked.select("c_custkey", F.explode(accession.expand_accession_ranges(F.col("text"))).alias("id"))


@query("path_basename", f"WITH {RUN_FILES} SELECT {_ID}, regexp_extract(path, '[^/]*$') AS name FROM run_files")
def path_basename(spark: SparkSession, sf: str) -> DataFrame:
    return _files_with(spark, sf, name=files.path_basename(F.col("path")))


@query("classify_filetype", f"WITH {RUN_FILES} SELECT {_ID}, {FILE_KIND} AS filetype FROM run_files")
def classify_filetype(spark: SparkSession, sf: str) -> DataFrame:
    return _files_with(spark, sf, filetype=files.classify_filetype(F.col("path")))


@query(
    "parse_filetype_name",
    f"""WITH {RUN_FILES} SELECT {_ID}, CASE WHEN l_partkey % 3 = 0 THEN 'Unknown'
    WHEN {FILE_KIND} = 'fastq' THEN 'Fastq' ELSE 'Bam' END AS filetype FROM run_files""",
)
def parse_filetype_name(spark: SparkSession, sf: str) -> DataFrame:
    kind = files.classify_filetype(F.col("path"))
    spelled = F.when(F.col("l_partkey") % 3 == 0, F.upper(kind)).when(F.col("l_partkey") % 3 == 1, F.initcap(kind))
    return _files_with(spark, sf, filetype=files.parse_filetype_name(spelled.otherwise(kind)))


@query(
    "parse_readtype_name",
    f"""WITH {RUN_FILES} SELECT {_ID}, CASE WHEN l_suppkey % 3 = 0 THEN 'Unknown' ELSE
    (CASE l_linenumber % 2 WHEN 0 THEN 'R' ELSE 'I' END) || (l_suppkey % 3) END AS read FROM run_files""",
)
def parse_readtype_name(spark: SparkSession, sf: str) -> DataFrame:
    letter = F.when(F.col("l_linenumber") % 2 == 0, "R").otherwise("I")
    digit = F.when(F.col("l_suppkey") % 3 == 0, F.lit(3)).otherwise(F.col("l_suppkey") % 3)
    return _files_with(spark, sf, read=files.parse_readtype_name(F.concat(letter, digit.cast("string"))))


@query(
    "parse_lane",
    f"""WITH {RUN_FILES} SELECT {_ID}, CASE WHEN {FILE_KIND} = 'fastq'
    THEN 'L00' || (1 + l_suppkey % 8) ELSE 'none' END AS lane FROM run_files""",
)
def parse_lane(spark: SparkSession, sf: str) -> DataFrame:
    path = F.col("path")
    lane = files.parse_lane(files.classify_filetype(path), files.path_basename(path))
    return _files_with(spark, sf, lane=F.coalesce(lane, F.lit("none")))


@query(
    "parse_read_type",
    f"""WITH {RUN_FILES} SELECT {_ID}, CASE WHEN {FILE_KIND} <> 'fastq' OR l_partkey % 4 = 3 THEN 'Unknown'
    ELSE ['R1', 'R2', 'I1'][1 + l_partkey % 4] END AS read FROM run_files""",
)
def parse_read_type(spark: SparkSession, sf: str) -> DataFrame:
    return _files_with(spark, sf, read=files.parse_read_type(F.col("path")))


@query(
    "parse_read_type_fallback",
    f"""WITH {RUN_FILES}, texts AS (SELECT *, CASE WHEN l_suppkey % 3 = 0 THEN 'a.I2.fastq'
        WHEN l_suppkey % 3 = 1 THEN 'a.R2.fastq' ELSE regexp_extract(path, '[^/]*$') END AS name FROM run_files)
    SELECT {_ID}, CASE WHEN {FILE_KIND} <> 'fastq' THEN 'none' WHEN regexp_matches(name, '_R.') THEN
      'R' || regexp_extract(name, '_R(.)', 1) WHEN regexp_matches(name, '\\.R.') THEN
      'R' || regexp_extract(name, '\\.R(.)', 1) WHEN regexp_matches(name, '_I.') THEN
      'I' || regexp_extract(name, '_I(.)', 1) WHEN regexp_matches(name, '\\.I.') THEN
      'I' || regexp_extract(name, '\\.I(.)', 1) ELSE 'none' END AS read FROM texts""",
)
def parse_read_type_fallback(spark: SparkSession, sf: str) -> DataFrame:
    path = F.col("path")
    name = F.when(F.col("l_suppkey") % 3 == 0, F.lit("a.I2.fastq")).when(
        F.col("l_suppkey") % 3 == 1, F.lit("a.R2.fastq")
    )
    read = files.parse_read_type_fallback(files.classify_filetype(path), name.otherwise(files.path_basename(path)))
    return _files_with(spark, sf, read=F.coalesce(read, F.lit("none")))


@query(
    "assign_read_by_group_size",
    f"""WITH {RUN_TABLE}, sized AS (SELECT *, count(*) OVER (PARTITION BY run_id) AS n,
        row_number() OVER (PARTITION BY run_id ORDER BY _pos) AS nth,
        regexp_extract(regexp_extract(cloud_filepath, '[^/]*$'), '_([RI].)', 1) AS named FROM run_table)
    SELECT run_id, _pos, CASE WHEN filetype <> 'fastq' THEN 'Unknown' WHEN n = 2 THEN 'R' || nth
      WHEN n IN (3, 4) AND named <> '' THEN named ELSE 'rejected' END AS read FROM sized""",
)
def assign_read_by_group_size(spark: SparkSession, sf: str) -> DataFrame:
    table = inputs.run_table(spark, sf).select("run_id", POS, "filetype", F.col("cloud_filepath").alias("path"))
    assigned = runtable.assign_reads(table)
    return assigned.select("run_id", POS, F.coalesce("read", F.lit("rejected")).alias("read"))


@query("parse_size_gb", f"WITH {RUN_FILES} SELECT {_ID}, {SIZE_GB} AS size_gb FROM run_files")
def parse_size_gb(spark: SparkSession, sf: str) -> DataFrame:
    return _files_with(spark, sf, size_gb=files.parse_size_gb(F.col("size")))


@query(
    "size_convert",
    f"""WITH {RUN_FILES} SELECT {_ID}, ({SIZE_GB}) / 1024 AS tb, ({SIZE_GB}) * 1024 AS mb, ({SIZE_GB}) * 1048576 AS kb
    FROM run_files""",
)
def size_convert(spark: SparkSession, sf: str) -> DataFrame:
    gb = files.parse_size_gb(F.col("size"))
    return _files_with(
        spark, sf, tb=files.size_in(gb, "TB"), mb=files.size_in(gb, "MB"), kb=files.size_in(gb, "KB")
    )


@query(
    "format_size",
    f"SELECT {_ID}, CAST(l_quantity AS VARCHAR) || 'G' AS size FROM lineitem",
)
def format_size(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.table(spark, sf, "lineitem").select(
        *_ID.split(", "), files.format_size(F.col("l_quantity")).alias("size")
    )


@query(
    "split_taxon",
    """SELECT c_custkey, unnest([c_mktsegment, c_name]) AS taxon FROM customer""",
)
def split_taxon(spark: SparkSession, sf: str) -> DataFrame:
    text = F.concat("c_mktsegment", F.lit("; "), "c_name")
    customers = inputs.table(spark, sf, "customer")
    return customers.select("c_custkey", F.explode(accession.split_taxon(text)).alias("taxon"))


@query(
    "parse_heading",
    """SELECT c_custkey, 'GSM' || c_custkey AS gsm, c_mktsegment AS species, 'SRR' || c_custkey AS srr
    FROM customer""",
)
def parse_heading(spark: SparkSession, sf: str) -> DataFrame:
    heading = F.expr("concat('GSM', c_custkey, ': x; ', c_mktsegment, '; n (SRR', c_custkey, ')')")
    return inputs.table(spark, sf, "customer").select(
        "c_custkey",
        accession.heading_sample(heading).alias("gsm"),
        accession.heading_species(heading).alias("species"),
        accession.heading_run(heading).alias("srr"),
    )


@query(
    "raw_filename",
    f"""WITH {RUN_TABLE} SELECT run_id, _pos, CASE WHEN filetype = 'fastq' AND read_type IN ('R1', 'R2', 'I1', 'I2')
      THEN run_id || '_' || list_position(['R1', 'R2', 'I1', 'I2'], read_type) || '.fastq.gz'
      ELSE regexp_extract(cloud_filepath, '[^/]*$') END AS raw_name FROM run_table""",
)
def raw_filename(spark: SparkSession, sf: str) -> DataFrame:
    name = files.raw_filename(F.col("run_id"), F.col("filetype"), F.col("read_type"), F.col("cloud_filepath"))
    return inputs.run_table(spark, sf).select("run_id", POS, name.alias("raw_name"))


@query("dumped_filename", f"WITH {RUN_TABLE} SELECT run_id, _pos, dumped_filename FROM run_table")
def dumped_filename(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.run_table(spark, sf).select("run_id", POS, "dumped_filename")


@query("dumped_path", f"WITH {RUN_TABLE} SELECT run_id, _pos, dumped_filepath FROM run_table")
def dumped_path(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.run_table(spark, sf).select("run_id", POS, "dumped_filepath")


@query(
    "stage_path",
    f"""WITH {RUN_TABLE} SELECT run_id, _pos, '/p/resources/' || dumped_filepath AS dumped_file,
      '/p/resources/' || gse_id || '/1_count' AS count,
      '/p/resources/' || gse_id || '/1_count/' || gsm_id || '/out' AS counted,
      '/p/resources/' || gse_id || '/2_seurat/' || gsm_id AS seurat,
      '/p/resources/' || gse_id || '/2_seurat/__integrated' AS integrated FROM run_table""",
)
def stage_path(spark: SparkSession, sf: str) -> DataFrame:
    series, sample, dumped = F.col("gse_id"), F.col("gsm_id"), F.col("dumped_filepath")
    paths = [files.stage_path(s, "/p", series, sample, dumped).alias(s) for s in files.STAGES]
    return inputs.run_table(spark, sf).select("run_id", POS, *paths)


@query(
    "series_link",
    f"""WITH {inputs.SERIES} SELECT gse_id, '{accession.SERIES_PAGE}' || gse_id AS link FROM series""",
)
def series_link(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.series(spark, sf).select("gse_id", accession.series_link(F.col("gse_id")).alias("link"))


@query(
    "child_label",
    f"""WITH {inputs.SAMPLES} SELECT gsm_id || '(' || sample_title || ')' AS label, gsm_id AS accession
    FROM samples""",
)
def child_label(spark: SparkSession, sf: str) -> DataFrame:
    label = accession.child_label(F.col("gsm_id"), F.col("sample_title"))
    labels = inputs.samples(spark, sf).select(label.alias("label"))
    return labels.withColumn("accession", accession.label_accession(F.col("label")))
