"""Checks and repairs of the run table, and the plan of pending work.

The table has one row per file: run_id, gsm_id, gse_id, sample_name, cloud_filepath,
filetype, lane_id, read_type, dumped_filename, dumped_filepath and `_pos`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.functions import files
from seqloom.operators.aggregates import join_strings
from seqloom.operators.positions import balanced_split, running_total, with_pos
from seqloom.selectors import POS, Names, as_names
from seqloom.staging import stage


class RunTableError(ValueError):
    """A strict check of the run table failed."""


def _broken_path() -> Column:
    return F.coalesce(F.col("dumped_filepath").contains("None"), F.lit(False))


def has_error(table: DataFrame, id_column: str, name: str = "has_error") -> DataFrame:
    """Per run or sample: does any of its rows have a path with `None` in it?

    Only run (SRR) and sample (GSM) ids are valid; any other id is an error by itself.
    """
    key = F.col(id_column)
    valid = F.coalesce(key.startswith("SRR") | key.startswith("GSM"), F.lit(False))
    return table.groupBy(id_column).agg(F.bool_or(_broken_path() | ~valid).alias(name))


def error_samples(table: DataFrame, strict: bool = False) -> DataFrame:
    """Distinct samples with a broken path; raises when strict and there are any."""
    broken = table.filter(_broken_path()).select("gsm_id").distinct()
    if strict and not broken.isEmpty():
        raise RunTableError("run table has rows without lane or read type")
    return broken


def conflicting_sample_names(table: DataFrame) -> DataFrame:
    """Samples that carry more than one name."""
    names = table.groupBy("gsm_id").agg(F.count_distinct("sample_name").alias("names"))
    return names.filter(F.col("names") > 1)


def mark_conflicting(stored: DataFrame, incoming: DataFrame, name: str = "conflict") -> DataFrame:
    """New rows, flagged where their sample is stored under another name (to be rejected)."""
    known = stored.groupBy("gsm_id").agg(F.min_by("sample_name", POS).alias("__stored"))
    checked = incoming.join(known, "gsm_id", "left")
    clash = F.coalesce(F.col("__stored") != F.col("sample_name"), F.lit(False))
    return checked.withColumn(name, clash).drop("__stored")


def required_children(samples: DataFrame, children: str = "child_srr_ids") -> DataFrame:
    """Samples without any run."""
    return samples.filter(F.coalesce(F.size(children), F.lit(0)) <= 0)


def repair_lanes(table: DataFrame, free: bool = False, name: str = "clash") -> DataFrame:
    """Give fastq runs without a lane the next lane number of their sample.

    The k-th such run of a sample, by first appearance, gets the number of distinct lanes
    the sample already has plus k; `clash` marks its rows where the sample already uses that lane (out of
    sequence). With `free` it gets the k-th number that the sample does not use, so that no two runs share one.
    Runs are numbered, not files, so the numbered frame is one row per broken run; a run belongs to the sample of its
    first file. Broken runs, used lanes and new ones, which are read several times, are written once.
    """
    good = F.col("lane_id").startswith("L")
    fastq = table.filter(F.col("filetype") == "fastq")
    runs = fastq.groupBy("run_id").agg(
        F.min_by("gsm_id", POS).alias("gsm_id"), F.min_by("lane_id", POS).alias("__lane"), F.min(POS).alias(POS)
    )
    broken = runs.filter(~F.coalesce(F.col("__lane").startswith("L"), F.lit(False)))
    broken = stage(broken.select("run_id", "gsm_id", F.col(POS).alias("__seen")), "broken")
    numbered = with_pos(broken, "__seen", "gsm_id", pos="__k")
    lanes = stage(table.filter(good).select("gsm_id", "lane_id").distinct(), "lanes")
    if free:
        placed = _kth_free(numbered, lanes).select("run_id", "gsm_id", F.col("__free").alias("__number"))
    else:
        used = table.groupBy("gsm_id").agg(F.count_distinct(F.when(good, F.col("lane_id"))).alias("__used"))
        placed = numbered.join(used, "gsm_id").select("run_id", "gsm_id", (F.col("__used") + F.col("__k") + 1).alias("__number"))
    named = placed.select("run_id", "gsm_id", F.format_string("L%03d", F.col("__number")).alias("__new"))
    taken = lanes.select("gsm_id", F.col("lane_id").alias("__new"), F.lit(True).alias("__taken"))
    fixes = named.join(taken, ["gsm_id", "__new"], "left").select("run_id", "__new", F.coalesce("__taken", F.lit(False)).alias("__taken"))
    fixes = stage(fixes, "fixes")
    fixed = table.join(fixes, "run_id", "left").withColumn("lane_id", F.coalesce("__new", "lane_id"))
    return fixed.withColumn(name, F.coalesce("__taken", F.lit(False))).drop("__new", "__taken")


def _kth_free(numbered: DataFrame, lanes: DataFrame) -> DataFrame:
    """For the k-th broken run of a sample (k from 0) the k-th lane number from 1 on that the sample does not use.

    Below the i-th used number u (i from 0) there are u - 1 - i free ones. So the k-th free number is k + 1 and
    as many more as there are used numbers with at most k free ones below: one running count over both kinds of
    rows in the order of those ranks, which no sample takes through one task.
    """
    number = F.regexp_extract("lane_id", r"^L0*(\d{1,9})$", 1)
    used = lanes.select("gsm_id", F.when(number != "", number).cast("long").alias("__u")).filter("__u > 0").distinct()
    ranked = with_pos(used, "__u", "gsm_id", pos="__i").select(
        "gsm_id", F.lit(None).cast("string").alias("run_id"), (F.col("__u") - 1 - F.col("__i")).alias("__below"),
        F.lit(1).alias("__is_used"), F.col("__i").alias("__tie"),
    )
    runs = numbered.select("gsm_id", "run_id", F.col("__k").alias("__below"), F.lit(0).alias("__is_used"), F.lit(0).cast("long").alias("__tie"))
    both = stage(ranked.unionByName(runs).withColumn("__after", 1 - F.col("__is_used")), "ranks")
    counted = running_total(both, ["__below", "__after", "__tie"], F.col("__is_used"), "gsm_id", "__before")
    return counted.filter("__is_used = 0").withColumn("__free", F.col("__below") + 1 + F.col("__before"))


def repair_read_types(table: DataFrame, index_pos: int = 0, name: str = "unpaired") -> DataFrame:
    """Rewrite unusable read types of fastq runs by file order; `unpaired` marks single-file runs.

    Two files become R1, R2. Three become R1, R2 and I1, the index read being file number
    `index_pos` (0, 1 or 2). The first and last position of such a run tell its files
    apart, so nothing is sorted and large runs, which are never rewritten, form no group.
    """
    bad = ~F.coalesce(F.regexp_like(F.col("read_type"), F.lit("^[RI][12]")), F.lit(False))
    is_fastq = F.col("filetype") == "fastq"
    facts = (
        table.filter(is_fastq)
        .groupBy("run_id")
        .agg(
            F.bool_or(bad).alias("__bad"),
            F.count(F.lit(1)).alias("__files"),
            F.min(POS).alias("__first"),
            F.max(POS).alias("__last"),
        )
        .filter("__bad AND __files <= 3")
    )
    three = ["R1", "R2"]
    three.insert(index_pos, "I1")
    place = F.when(F.col(POS) == F.col("__first"), 0).when(F.col(POS) == F.col("__last"), 2).otherwise(1)
    read = F.when(F.col("__files") == 2, F.when(place == 0, F.lit("R1")).otherwise(F.lit("R2"))).when(
        F.col("__files") == 3, F.get(F.array(*[F.lit(t) for t in three]), place)
    )
    joined = table.join(facts.drop("__bad"), "run_id", "left")
    fixed = joined.withColumn("read_type", F.coalesce(F.when(is_fastq, read), F.col("read_type")))
    single = F.coalesce(is_fastq & (F.col("__files") == 1), F.lit(False))
    return fixed.withColumn(name, single).drop("__files", "__first", "__last")


def assign_reads(table: DataFrame) -> DataFrame:
    """Read type of each file by the number of files in its run; null is a reject.

    fastq: two files are R1, R2 in order; three or four take the read named in the file
    name; any other count, or a name without a read, is rejected. Non-fastq runs get
    Unknown. A run is fastq when its first file is. A file without a run id is a reject.
    """
    facts = table.groupBy("run_id").agg(
        F.min_by("filetype", POS).alias("__type"), F.count(F.lit(1)).alias("__files"), F.min(POS).alias("__first")
    )
    name = files.path_basename(F.col("path"))
    named = F.coalesce(*[F.nullif(F.regexp_extract(name, p, 1), F.lit("")) for p in ("_(R.)", "_(I.)")])
    read = (
        F.when(F.col("__type") != "fastq", F.lit("Unknown"))
        .when(F.col("__files") == 2, F.when(F.col(POS) == F.col("__first"), "R1").otherwise("R2"))
        .when(F.col("__files").between(3, 4), named)
    )
    return table.join(facts.filter("run_id IS NOT NULL"), "run_id", "left").withColumn("read", read).drop("__type", "__files", "__first")


def rebuild_names(table: DataFrame) -> DataFrame:
    """Recompute file name and path of the fastq rows from the repaired columns."""
    is_fastq = F.col("filetype") == "fastq"
    filename = files.dumped_filename(
        F.col("gsm_id"), F.col("filetype"), F.lit("S1"), F.col("lane_id"), F.col("read_type")
    )
    named = table.withColumn("dumped_filename", F.when(is_fastq, filename).otherwise(F.col("dumped_filename")))
    path = files.dumped_path(F.col("sample_name"), F.col("gsm_id"), F.col("filetype"), F.col("dumped_filename"))
    return named.withColumn("dumped_filepath", F.when(is_fastq, path).otherwise(F.col("dumped_filepath")))


def work_steps(table: DataFrame, finished: DataFrame, key: Names, workers: int) -> DataFrame:
    """One step per file of the pending runs, with the worker that will run it.

    Pending runs are ordered by first file and cut into `workers` balanced contiguous
    groups. `known` is false for rejects (unknown kind or read type). The pending rows are
    written once, since runs and files are both taken from them, and so are the runs, which are read several times.
    """
    keys = as_names(key)
    kind, run, read = F.col("filetype"), F.col("run_id"), F.col("read_type")
    known = (kind == "bam") | ((kind == "fastq") & read.isin(*files.READ_TYPES))
    pending = stage(
        table.join(finished.select(*keys), keys, "left_anti").select(
            "run_id",
            POS,
            F.when(kind == "bam", F.lit("fetch")).otherwise(F.lit("dump")).alias("action"),
            F.col("cloud_filepath").alias("source"),
            files.raw_filename(run, kind, read, F.col("cloud_filepath")).alias("raw_name"),
            F.when(kind == "bam", F.concat(run, F.lit(".bam"))).otherwise(F.col("dumped_filename")).alias("target_name"),
            F.coalesce(known, F.lit(False)).alias("known"),
        ),
        "pending",
    )
    runs = stage(pending.groupBy("run_id").agg(F.min(POS).alias("__seen")), "runs")
    cut = balanced_split(with_pos(runs, "__seen"), workers, name="worker")
    return pending.join(cut.select("run_id", "worker", F.col(POS).alias("run_pos")), "run_id")


def work_manifest(steps: DataFrame, part_rows: int = 100_000) -> DataFrame:
    """The ordered text of each worker, one line per known step; long texts come in parts of whole runs.

    A run's few lines are joined first and written, since parts are measured and then cut. Runs are numbered already, so
    nothing is numbered again. `part_rows` bounds the runs of a part.
    """
    line = F.concat_ws(" ", "action", "source", "raw_name", "target_name")
    lines = steps.filter("known").select("run_id", "worker", "run_pos", F.col(POS).alias("file_pos"), line.alias("line"))
    text = F.expr("listagg(line, '\n') WITHIN GROUP (ORDER BY file_pos)")
    # steps come dealt by run_id, as a key it spares the lines another exchange
    per_run = lines.groupBy("run_id", "worker", F.col("run_pos").alias(POS)).agg(text.alias("text"))
    per_run = stage(per_run.drop("run_id"), "run-lines")
    return join_strings(per_run, "text", "\n", "worker", part_rows, name="script")


def count_steps(samples: DataFrame, runs: DataFrame, genomes: DataFrame, workers: int) -> DataFrame:
    """One counting step per pending sample: file kind of its first run, reference path, worker.

    `samples` has gsm_id, species and `_pos`; `runs` has gsm_id, filetype and `_pos`;
    `genomes` has species and path. A sample without runs or with an unknown kind is a
    reject: `known` is false, and it has no worker and no position among the steps.
    """
    kinds = runs.groupBy("gsm_id").agg(F.min_by("filetype", POS).alias("filetype"))
    found = samples.join(kinds, "gsm_id", "left")
    known = F.coalesce(F.col("filetype").isin("fastq", "bam"), F.lit(False))
    marked = found.withColumn("known", known)
    numbered = with_pos(marked.filter("known").withColumnRenamed(POS, "__seen"), "__seen")
    cut = balanced_split(numbered, workers, name="worker").drop("__seen")
    none = {POS: F.lit(None).cast("long"), "worker": F.lit(None).cast("long")}
    rejects = marked.filter("NOT known").drop(POS).withColumns(none)
    return cut.unionByName(rejects).join(genomes, "species", "left")
