"""Queries for the checks, repairs and work plan of the run table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.operators import runtable
from seqloom.plans import inputs
from seqloom.plans.inputs import FINISHED, RUN_TABLE
from seqloom.plans.registry import query
from seqloom.selectors import POS


@query(
    "has_error",
    f"""WITH {RUN_TABLE} SELECT run_id, bool_or(dumped_filepath LIKE '%None%') AS has_error
    FROM run_table GROUP BY run_id""",
)
def has_error(spark: SparkSession, sf: str) -> DataFrame:
    return runtable.has_error(inputs.run_table(spark, sf), "run_id")


@query(
    "error_samples",
    f"WITH {RUN_TABLE} SELECT DISTINCT gsm_id FROM run_table WHERE dumped_filepath LIKE '%None%'",
)
def error_samples(spark: SparkSession, sf: str) -> DataFrame:
    return runtable.error_samples(inputs.run_table(spark, sf))


@query(
    "conflicting_sample_name",
    f"""WITH {RUN_TABLE} SELECT gsm_id, count(DISTINCT sample_name) AS names FROM run_table
    GROUP BY gsm_id HAVING count(DISTINCT sample_name) > 1""",
)
def conflicting_sample_name(spark: SparkSession, sf: str) -> DataFrame:
    return runtable.conflicting_sample_names(inputs.run_table(spark, sf))


@query(
    "reject_conflicting",
    f"""WITH {RUN_TABLE}, {FINISHED}, split AS (SELECT r.*, f.run_id IS NOT NULL AS stored FROM run_table r
        LEFT JOIN finished f USING (run_id)),
      known AS (SELECT gsm_id, arg_min(sample_name, _pos) AS name FROM split WHERE stored GROUP BY gsm_id)
    SELECT _pos, coalesce(name <> sample_name, false) AS rejected FROM split LEFT JOIN known USING (gsm_id)
    WHERE NOT stored""",
)
def reject_conflicting(spark: SparkSession, sf: str) -> DataFrame:
    table = inputs.run_table(spark, sf).select("run_id", "gsm_id", "sample_name", POS)
    finished = inputs.finished_runs(spark, sf)
    stored, incoming = table.join(finished, "run_id", "left_semi"), table.join(finished, "run_id", "left_anti")
    return runtable.mark_conflicting(stored, incoming, name="rejected").select(POS, "rejected")


_LANES = f"""{RUN_TABLE}, runs AS (SELECT gsm_id, run_id, min(_pos) AS seen,
    bool_or(lane_id IS NULL) AS broken FROM run_table WHERE filetype = 'fastq' GROUP BY gsm_id, run_id),
  used AS (SELECT gsm_id, count(DISTINCT lane_id) AS used FROM run_table GROUP BY gsm_id),
  fixes AS (SELECT run_id, 'L' || lpad(CAST(used + row_number() OVER (PARTITION BY gsm_id ORDER BY seen)
    AS VARCHAR), 3, '0') AS lane FROM runs JOIN used USING (gsm_id) WHERE broken),
  laned AS (SELECT r.* EXCLUDE (lane_id), coalesce(f.lane, r.lane_id) AS lane_id
    FROM run_table r LEFT JOIN fixes f USING (run_id))"""


@query("repair_lane", f"WITH {_LANES} SELECT run_id, _pos, coalesce(lane_id, 'none') AS lane_id FROM laned")
def repair_lane(spark: SparkSession, sf: str) -> DataFrame:
    fixed = runtable.repair_lanes(inputs.run_table(spark, sf))
    return fixed.select("run_id", POS, F.coalesce("lane_id", F.lit("none")).alias("lane_id"))


@query(
    "repair_lane_clashes",
    f"""WITH {_LANES} SELECT r.run_id, r._pos, f.lane IS NOT NULL AND EXISTS (
      SELECT 1 FROM run_table u WHERE u.gsm_id = r.gsm_id AND u.lane_id = f.lane) AS clash
    FROM run_table r LEFT JOIN fixes f USING (run_id)""",
)
def repair_lane_clashes(spark: SparkSession, sf: str) -> DataFrame:
    """Rows whose new lane their sample uses out of sequence."""
    return runtable.repair_lanes(inputs.run_table(spark, sf)).select("run_id", POS, "clash")


@query(
    "repair_lane_free",
    f"""WITH {RUN_TABLE}, runs AS (SELECT gsm_id, run_id, min(_pos) AS seen, bool_or(lane_id IS NULL) AS broken
      FROM run_table WHERE filetype = 'fastq' GROUP BY gsm_id, run_id),
    used AS (SELECT gsm_id, coalesce(list(DISTINCT CAST(substr(lane_id, 2) AS BIGINT)) FILTER (lane_id IS NOT NULL), []) AS used
      FROM run_table GROUP BY gsm_id),
    fixes AS (SELECT run_id, used, row_number() OVER (PARTITION BY gsm_id ORDER BY seen) AS k,
      count(*) OVER (PARTITION BY gsm_id) AS n FROM runs JOIN used USING (gsm_id) WHERE broken),
    freed AS (SELECT run_id, 'L' || lpad(CAST([x FOR x IN range(1, len(used) + n + 1) IF NOT list_contains(used, x)][k]
      AS VARCHAR), 3, '0') AS lane FROM fixes)
    SELECT run_id, _pos, coalesce(lane, lane_id, 'none') AS lane_id, false AS clash FROM run_table LEFT JOIN freed USING (run_id)""",
)
def repair_lane_free(spark: SparkSession, sf: str) -> DataFrame:
    fixed = runtable.repair_lanes(inputs.run_table(spark, sf), free=True)
    return fixed.select("run_id", POS, F.coalesce("lane_id", F.lit("none")).alias("lane_id"), "clash")


_READS = """facts AS (SELECT run_id, bool_or(NOT regexp_matches(read_type, '^[RI][12]')) AS bad, count(*) AS n
    FROM {0} WHERE filetype = 'fastq' GROUP BY run_id),
  typed AS (SELECT t.* EXCLUDE (read_type), CASE WHEN filetype = 'fastq' AND bad AND n = 2
      THEN ['R1', 'R2'][nth] WHEN filetype = 'fastq' AND bad AND n = 3 THEN ['R1', 'R2', 'I1'][nth]
      ELSE read_type END AS read_type, bad, n FROM
    (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY _pos) AS nth FROM {0}) t
    LEFT JOIN facts USING (run_id))"""


@query(
    "repair_read_type",
    f"""WITH {RUN_TABLE}, {_READS.format("run_table")} SELECT run_id, _pos, read_type,
      coalesce(filetype = 'fastq' AND bad AND n = 1, false) AS unpaired FROM typed""",
)
def repair_read_type(spark: SparkSession, sf: str) -> DataFrame:
    fixed = runtable.repair_read_types(inputs.run_table(spark, sf), index_pos=2)
    return fixed.select("run_id", POS, "read_type", "unpaired")


_REBUILT = f"""{_LANES}, {_READS.format("laned")}, rebuilt AS (SELECT * EXCLUDE (dumped_filename, dumped_filepath),
    CASE WHEN filetype = 'fastq' THEN gsm_id || '_S1_' || coalesce(lane_id, 'None') || '_' || read_type
      || '_001.fastq.gz' ELSE dumped_filename END AS dumped_filename FROM typed)"""


def _repaired(spark: SparkSession, sf: str) -> DataFrame:
    laned = runtable.repair_lanes(inputs.run_table(spark, sf))
    return runtable.rebuild_names(runtable.repair_read_types(laned, index_pos=2))


@query(
    "rebuild_names",
    f"""WITH {_REBUILT} SELECT run_id, _pos, sample_name || '/0_dumped/' || gsm_id || '/'
      || CASE WHEN filetype = 'bam' THEN 'bams' ELSE 'fastqs' END || '/' || dumped_filename AS dumped_filepath
    FROM rebuilt""",
)
def rebuild_names(spark: SparkSession, sf: str) -> DataFrame:
    return _repaired(spark, sf).select("run_id", POS, "dumped_filepath")


@query(
    "required_children",
    """SELECT c_custkey FROM customer WHERE NOT regexp_matches(c_name, '[5-9]')""",
)
def required_children(spark: SparkSession, sf: str) -> DataFrame:
    """Every digit from 5 to 9 in a customer's name stands for one run."""
    samples = inputs.table(spark, sf, "customer").selectExpr(
        "c_custkey", "regexp_extract_all(c_name, '[5-9]', 0) AS child_srr_ids"
    )
    return runtable.required_children(samples).select("c_custkey")


_STEPS = f"""{_REBUILT}, {FINISHED}, pending AS (SELECT * FROM rebuilt WHERE run_id NOT IN (SELECT run_id FROM finished)),
  cut AS (SELECT run_id, ntile(8) OVER (ORDER BY seen) - 1 AS worker FROM
    (SELECT run_id, min(_pos) AS seen FROM pending GROUP BY run_id)),
  steps AS (SELECT CAST(worker AS BIGINT) AS worker, run_id, _pos,
    CASE WHEN filetype = 'bam' THEN 'fetch' ELSE 'dump' END AS action, cloud_filepath AS source,
    CASE WHEN filetype = 'bam' THEN regexp_extract(cloud_filepath, '[^/]*$')
      ELSE run_id || '_' || list_position(['R1', 'R2', 'I1', 'I2'], read_type) || '.fastq.gz' END AS raw_name,
    CASE WHEN filetype = 'bam' THEN run_id || '.bam' ELSE dumped_filename END AS target_name,
    filetype = 'bam' OR read_type IN ('R1', 'R2', 'I1', 'I2') AS known
    FROM pending JOIN cut USING (run_id))"""


@query(
    "work_steps",
    f"""WITH {_STEPS} SELECT worker, run_id, _pos, CASE WHEN known THEN action ELSE 'rejected' END AS action
    FROM steps""",
)
def work_steps(spark: SparkSession, sf: str) -> DataFrame:
    steps = runtable.work_steps(_repaired(spark, sf), inputs.finished_runs(spark, sf), "run_id", 8)
    return steps.select("worker", "run_id", POS, F.when(F.col("known"), F.col("action")).otherwise("rejected").alias("action"))


@query(
    "work_manifest",
    f"""WITH {_STEPS}, seen AS (SELECT run_id, min(_pos) AS first FROM pending GROUP BY run_id),
      placed AS (SELECT s.*, (dense_rank() OVER (PARTITION BY worker ORDER BY first) - 1) // 1000 AS part
        FROM steps s JOIN seen USING (run_id) WHERE known)
    SELECT worker, part, string_agg(action || ' ' || source || ' ' || raw_name || ' ' || target_name, chr(10)
      ORDER BY _pos) AS script FROM placed GROUP BY worker, part""",
)
def work_manifest(spark: SparkSession, sf: str) -> DataFrame:
    steps = runtable.work_steps(_repaired(spark, sf), inputs.finished_runs(spark, sf), "run_id", 8)
    return runtable.work_manifest(steps, part_rows=1000)


@query(
    "count_steps",
    f"""WITH {RUN_TABLE}, kinds AS (SELECT gsm_id, arg_min(CASE WHEN gsm_id LIKE '%7' THEN 'sra' ELSE filetype END, _pos)
        AS filetype FROM run_table GROUP BY gsm_id),
      samples AS (SELECT 'GSM' || c_custkey AS gsm_id, c_custkey, c_nationkey FROM customer),
      found AS (SELECT s.*, filetype, coalesce(filetype IN ('fastq', 'bam'), false) AS known
        FROM samples s LEFT JOIN kinds USING (gsm_id)),
      cut AS (SELECT gsm_id, CAST(ntile(6) OVER (ORDER BY c_custkey) - 1 AS BIGINT) AS worker FROM found WHERE known)
    SELECT gsm_id, coalesce(filetype, 'none') AS filetype, known, coalesce(worker, -1) AS worker,
      CASE WHEN n_regionkey = 0 THEN 'none' ELSE '/ref/' || n_name END AS path
    FROM found LEFT JOIN cut USING (gsm_id) JOIN nation ON c_nationkey = n_nationkey""",
)
def count_steps(spark: SparkSession, sf: str) -> DataFrame:
    """Some samples have no run, and some runs are of a kind that cannot be counted."""
    samples = inputs.table(spark, sf, "customer").selectExpr(
        "concat('GSM', c_custkey) AS gsm_id", "c_nationkey AS species", f"c_custkey AS {POS}"
    )
    kind = F.when(F.col("gsm_id").endswith("7"), "sra").otherwise(F.col("filetype")).alias("filetype")
    runs = inputs.run_table(spark, sf).select("gsm_id", kind, POS)
    genomes = inputs.table(spark, sf, "nation").filter("n_regionkey <> 0")
    genomes = genomes.selectExpr("n_nationkey AS species", "concat('/ref/', n_name) AS path")
    steps = runtable.count_steps(samples, runs, genomes, 6)
    known = lambda name, value: F.coalesce(name, F.lit(value)).alias(name)
    return steps.select("gsm_id", known("filetype", "none"), "known", known("worker", -1), known("path", "none"))
