"""Catalog joins, scalar functions and run-table rules on small literal records."""

import os

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from seqloom.functions import accession, files
from seqloom.operators import aggregates as agg
from seqloom.operators import catalog, runtable
from seqloom.plans import catalog as plans
from seqloom.sources import storage


def column(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {kind}")
    return [r.out for r in df.orderBy("i").select(fn(F.col("v")).alias("out")).collect()]


def test_accessions(spark):
    assert column(spark, ["GSE1", "GSM1", "SRR1", "X", None], accession.accession_kind) == [
        "GSE", "GSM", "SRR", None, None,
    ]
    got = column(spark, ["GSM1:GSM3,GSM9", "GSM4", "GSM5:GSM5", "GSM7:GSM6"], accession.expand_accession_ranges)
    assert got == [["GSM1", "GSM2", "GSM3", "GSM9"], ["GSM4"], ["GSM5"], []]
    assert column(spark, ["Homo sapiens; Mus musculus", "A"], accession.split_taxon) == [
        ["Homo sapiens", "Mus musculus"],
        ["A"],
    ]
    heading = ["GSM5: a b; Homo sapiens; RNA-Seq (SRR77)"]
    assert column(spark, heading, accession.heading_sample) == ["GSM5"]
    assert column(spark, heading, accession.heading_species) == ["Homosapiens"]
    assert column(spark, heading, accession.heading_run) == ["SRR77"]
    assert column(spark, ["GSM1(a (b))"], accession.label_accession) == ["GSM1"]


STORED = [  # names of stored files: basename, kind, lane, read
    ("s3://x/SRR1/190726_BBB_snRNA_H3.bam.1", "bam", None, "Unknown"),
    ("s3://x/SRR2/Sample-17-ACGACATT_S28_L003_I1_001.fastq.gz.1", "fastq", "L003", "I1"),
    ("s3://x/SRR2/Sample-17-ACGACATT_S28_L003_R1_001.fastq.gz.1", "fastq", "L003", "R1"),
    ("s3://x/SRR3/Sample101_S15_L001_R3_001.fastq.1", "fastq", "L001", "Unknown"),
]


def test_stored_file_names(spark):
    paths = [row[0] for row in STORED]
    name = files.path_basename
    assert column(spark, paths, files.classify_filetype) == [row[1] for row in STORED]
    assert column(spark, paths, lambda p: files.parse_lane(files.classify_filetype(p), name(p))) == [
        row[2] for row in STORED
    ]
    assert column(spark, paths, files.parse_read_type) == [row[3] for row in STORED]


def test_sizes(spark):
    got = column(spark, ["1.5T", "17.4G", "512M", "1048576K", "12", "0.5", "xG"], files.parse_size_gb)
    assert got == [1536.0, 17.4, 0.5, 1.0, 0.0, 0.0, None]
    assert column(spark, [1024**3], files.bytes_to_gb, "long") == [1.0]
    assert column(spark, [2.0], lambda c: files.size_in(c, "KB"), "double") == [2.0 * 1024**2]
    assert column(spark, [1.8], files.format_size, "double") == ["1.8G"]


def test_read_fallback(spark):
    names = ["a_R2.fastq", "a.R1.fq", "a_I1.fastq", "a.I2.fastq", "a.fastq", "xRy_I2.fastq"]
    got = column(spark, names, lambda n: files.parse_read_type_fallback(F.lit("fastq"), n))
    assert got == ["R2", "R1", "I1", "I2", None, "I2"]


def test_names(spark):
    def dumped(kind, lane, **kw):
        return lambda c: files.dumped_filename(c, F.lit(kind), F.lit("S1"), F.lit(lane), F.lit("R1"), **kw)

    assert column(spark, ["GSM1"], dumped("fastq", "L001")) == ["GSM1_S1_L001_R1_001.fastq.gz"]
    assert column(spark, ["GSM1"], dumped("fastq", None)) == ["GSM1_S1_None_R1_001.fastq.gz"]
    assert column(spark, ["GSM1"], dumped("Fastq", None, suffix="", missing="Null")) == ["GSM1_S1_Null_R1.fastq.gz"]
    assert column(spark, ["GSM1"], dumped("bam", None)) == ["GSM1.bam"]
    assert column(spark, ["GSM1"], dumped("sra", None)) == ["GSM1.unknown"]
    path = lambda kind: lambda c: files.dumped_path(F.lit("n"), c, F.lit(kind), F.lit("f"))
    assert column(spark, ["GSM1"], path("bam")) == ["n/0_dumped/GSM1/bams/f"]
    assert column(spark, ["GSM1"], path("sra")) == [None]


def test_missing_records_raise_when_strict(spark):
    wanted = spark.createDataFrame([("GSM1",), ("GSM2",)], "gsm_id STRING")
    records = spark.createDataFrame([("GSM1", "t")], "gsm_id STRING, title STRING")
    resolved = catalog.resolve_required(wanted, records, "gsm_id")
    assert {r.gsm_id: r.found for r in resolved.collect()} == {"GSM1": True, "GSM2": False}
    with pytest.raises(catalog.MissingRecordError):
        catalog.resolve_required(wanted, records, "gsm_id", strict=True)
    with pytest.raises(Exception, match="no reference"):
        catalog.reference_dim(wanted, records, "gsm_id", "title", strict=True).collect()


def test_listed_ids_and_explode(spark):
    df = spark.createDataFrame([("a,b",)], "opt STRING")
    assert [r.id for r in catalog.listed_ids(df, "opt").collect()] == ["a", "b"]
    nested = spark.createDataFrame([("g", ["x", "y"])], "g STRING, kids ARRAY<STRING>")
    assert [r.kid for r in catalog.explode_children(nested, "kids", "kid").collect()] == ["x", "y"]
    assert catalog.children_of(nested, "g", "g").count() == 1


def test_location_pick_first_not_lowest(spark):
    rows = [
        (0, "r1", "fastq", "s3", "-"), (1, "r1", "fastq", "gs", "worldwide"), (2, "r1", "fastq", "s3", "-"),
        (3, "r2", "bam", "s3", "-"), (4, "r2", "bam", "gs", "worldwide"), (5, "r3", "bam", "s3", "-"),
    ]
    df = spark.createDataFrame(rows, "_pos LONG, run_id STRING, filetype STRING, location STRING, egress STRING")
    got = {r["_pos"]: r.picked for r in agg.location_pick(df).collect()}
    assert got == {0: "s3", 2: "s3", 4: "gs", 5: None}


COLUMNS = "_pos LONG, run_id STRING, gsm_id STRING, filetype STRING, lane_id STRING, read_type STRING"


def test_repair_lanes_counts_on(spark):
    rows = [
        (0, "r1", "g", "fastq", None, "R1"), (1, "r1", "g", "fastq", None, "R2"), (2, "r2", "g", "fastq", "L001", "R1"),
        (3, "r3", "g", "fastq", "x", "R1"), (4, "r4", "h", "fastq", None, "R1"), (5, "r5", "h", "bam", None, ""),
    ]
    fixed = runtable.repair_lanes(spark.createDataFrame(rows, COLUMNS))
    got = {r["_pos"]: r.lane_id for r in fixed.collect()}
    assert got == {0: "L002", 1: "L002", 2: "L001", 3: "L003", 4: "L001", 5: None}


def test_repair_lanes_gives_a_run_one_lane(spark):
    rows = [(0, "r1", "g", "fastq", None, "R1"), (1, "r1", "h", "fastq", None, "R2"), (2, "r2", "g", "fastq", "L001", "")]
    fixed = runtable.repair_lanes(spark.createDataFrame(rows, COLUMNS))
    assert {r["_pos"]: r.lane_id for r in fixed.collect()} == {0: "L002", 1: "L002", 2: "L001"}


@pytest.mark.parametrize(("index_pos", "three"), [(0, "I1 R1 R2"), (1, "R1 I1 R2"), (2, "R1 R2 I1")])
def test_repair_read_types(spark, index_pos, three):
    rows = [(0, "one", "g", "fastq", "L1", "")]
    rows += [(1 + i, "two", "g", "fastq", "L1", t) for i, t in enumerate(["R1", None])]
    rows += [(3 + i, "three", "g", "fastq", "L1", "R3") for i in range(3)]
    rows += [(6 + i, "four", "g", "fastq", "L1", "") for i in range(4)]
    rows += [(10 + i, "fine", "g", "fastq", "L1", t) for i, t in enumerate(["R2", "R1"])]
    fixed = runtable.repair_read_types(spark.createDataFrame(rows, COLUMNS), index_pos)
    got = {}
    for r in fixed.orderBy("_pos").collect():
        got.setdefault(r.run_id, []).append(r.read_type)
    assert got["two"] == ["R1", "R2"]
    assert got["three"] == three.split()
    assert got["four"] == [""] * 4 and got["fine"] == ["R2", "R1"]
    assert [r.run_id for r in fixed.filter("unpaired").collect()] == ["one"]


def test_error_checks(spark):
    rows = [("SRR1", "GSM1", "a/None"), ("SRR1", "GSM1", "ok"), ("X1", "GSM2", "ok")]
    df = spark.createDataFrame(rows, "run_id STRING, gsm_id STRING, dumped_filepath STRING")
    got = {r.run_id: r.has_error for r in runtable.has_error(df, "run_id").collect()}
    assert got == {"SRR1": True, "X1": True}
    with pytest.raises(runtable.RunTableError):
        runtable.error_samples(df, strict=True)


def test_required_children(spark):
    df = spark.createDataFrame([("a", ["x"]), ("b", []), ("c", None)], "id STRING, child_srr_ids ARRAY<STRING>")
    assert sorted(r.id for r in runtable.required_children(df).collect()) == ["b", "c"]


def test_free_lanes_fill_the_gaps_of_a_sample(spark):
    """Used 1, 2, 5 out of sequence, and a sample without any; the given rule marks its clash."""
    rows = [("g", f"r{i}", lane) for i, lane in enumerate(["L001", None, "L005", None, "L002", None, "x7", None])]
    rows += [("h", f"q{i}", None) for i in range(3)]
    table = spark.createDataFrame([(i, *r, "fastq") for i, r in enumerate(rows)], "_pos LONG, gsm_id STRING, run_id STRING, lane_id STRING, filetype STRING")
    free = {r.run_id: r.lane_id for r in runtable.repair_lanes(table, free=True).filter("NOT clash").collect()}
    assert free == {
        "r0": "L001", "r1": "L003", "r2": "L005", "r3": "L004", "r4": "L002", "r5": "L006", "r6": "L007", "r7": "L008",
        "q0": "L001", "q1": "L002", "q2": "L003",
    }
    given = {r.run_id: (r.lane_id, r.clash) for r in runtable.repair_lanes(table).collect()}
    assert given["r1"] == ("L004", False) and given["r3"] == ("L005", True) and given["r0"] == ("L001", False)


def test_result_files_need_no_folder_of_their_own(spark, tmp_path, monkeypatch):
    """Few folders however many ids; null ids have no file, and other file systems get Spark's writer."""
    monkeypatch.setattr(plans, "FOLDERS", 4)
    ids = spark.createDataFrame([(i % 40,) for i in range(90)] + [(None,)], "k LONG")
    roots = iter([str(tmp_path / "disk"), str(tmp_path / "none"), str(tmp_path / "other")])
    monkeypatch.setattr(plans, "new_path", lambda *_: next(roots))
    want = sorted(str(i) for i in range(40))
    assert sorted(r.k for r in plans._written(spark, ids, "k", "x").collect()) == want
    assert len([d for d in os.listdir(tmp_path / "disk")]) <= 4
    assert sum(len([f for f in names if not f.startswith(".")]) for _, _, names in os.walk(tmp_path / "disk")) == 40
    assert plans._written(spark, ids.limit(0), "k", "x").count() == 0
    monkeypatch.setattr(storage, "local_path", lambda *_: None)
    assert sorted(r.k for r in plans._written(spark, ids, "k", "x").collect()) == want


RUN_ROWS = [
    (8 * i + j, f"SRR{i}", f"GSM{i % 5}", "s", "fastq", None if i % 2 else f"L00{i % 7 + 1}", ("R1", "R2")[j], f"s3://b/{i}_{j}.fastq.gz", "x.fastq.gz", "x")
    for i in range(60) for j in range(2)
]
RUN_SCHEMA = """_pos LONG, run_id STRING, gsm_id STRING, sample_name STRING, filetype STRING, lane_id STRING, read_type STRING,
    cloud_filepath STRING, dumped_filename STRING, dumped_filepath STRING"""


@pytest.mark.parametrize("free", [False, True])
def test_lanes_are_repaired_from_what_is_read_once(spark, tmp_path, free):
    """What is numbered is not taken from the table again by every read."""
    spark.createDataFrame(RUN_ROWS, RUN_SCHEMA).write.parquet(str(tmp_path / "t"))
    fixed = runtable.repair_lanes(spark.read.parquet(str(tmp_path / "t")), free)
    assert fixed.where("lane_id IS NULL").isEmpty() and fixed.count() == len(RUN_ROWS)
    assert plan_of(fixed).count(str(tmp_path)) == 1


def test_steps_and_scripts_are_taken_from_what_is_written_once(spark):
    table = spark.createDataFrame(RUN_ROWS, RUN_SCHEMA)
    finished = spark.createDataFrame([("SRR0",), ("SRR59",)], "run_id STRING")
    steps = runtable.work_steps(table, finished, "run_id", 4)
    assert plan_of(steps).count("/seqloom-pending") == 1
    scripts = runtable.work_manifest(steps, part_rows=10)
    assert "/seqloom-pending" not in plan_of(scripts)
    rows = scripts.collect()
    assert {(r.worker, r.part) for r in rows} == {(w, p) for w in range(4) for p in range(2)}
    lines = sum((r.script.split("\n") for r in sorted(rows, key=lambda r: (r.worker, r.part))), [])
    assert [line.split()[1] for line in lines] == [r[7] for r in RUN_ROWS if r[1] not in ("SRR0", "SRR59")]
