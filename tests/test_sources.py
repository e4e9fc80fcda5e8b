"""Sources and sinks: drift, headers, malformed input, versions."""

import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from seqloom.sources import documents, listing, manifest, markup, nested, storage, tables, tsv
from seqloom.staging import new_path, scope, shared_root, stage


def test_shared_root_follows_the_session(spark):
    assert shared_root(spark) == shared_root(spark)
    assert new_path(spark, "a") != new_path(spark, "a")


def test_scope_deletes_what_was_staged_inside(spark):
    outside = new_path(spark, "kept")
    spark.range(1).write.parquet(outside)
    with scope(spark):
        inside = stage(spark.range(3)).inputFiles()[0]
        assert storage.exists(spark, inside)
    assert storage.exists(spark, outside) and not storage.exists(spark, inside)


def test_range_and_split(spark):
    assert [r.value for r in documents.sequence_of(spark, 3, "id * id").collect()] == [0, 1, 4]
    df = spark.createDataFrame([("a||b||",)], "t STRING")
    assert [(r["_pos"], r.value) for r in documents.from_string(df, "t", "||").collect()] == [(0, "a"), (1, "b"), (2, "")]


def test_json_array_round_trip_and_malformed(spark):
    df = spark.createDataFrame([('["a",null,"c"]',)], "t STRING")
    values = documents.from_json_array(df, "t", "STRING")
    assert [r.value for r in values.orderBy("_pos").collect()] == ["a", None, "c"]
    assert json.loads(documents.to_json_array(values, "value").first().json) == ["a", None, "c"]
    bad = spark.createDataFrame([("[1, 2",)], "t STRING")
    with pytest.raises(Exception, match="MALFORMED"):
        documents.from_json_array(bad, "t", "INT").collect()


def test_json_array_parts(spark):
    seq = spark.range(5).select(F.col("id").alias("_pos"))
    got = documents.to_json_array(seq, "_pos", part_rows=2).orderBy("part").collect()
    assert [r.json for r in got] == ["[0,1]", "[2,3]", "[4]"]


def test_json_documents_keep_nulls(spark):
    df = spark.createDataFrame([("r", 0, None), ("r", 1, "x")], "run STRING, _pos LONG, lane STRING")
    doc = json.loads(documents.json_documents(df, "run", ["lane"]).first().json)
    assert doc == {"run": "r", "items": [{"lane": None}, {"lane": "x"}]}


def test_table_versions(spark):
    path = new_path(spark, "t")
    assert tables.open_or_create(spark, path, tables.SERIES).count() == 0
    row = spark.createDataFrame([("GSE1", "t", "s", "GSM1")], tables.SERIES)
    for _ in range(3):
        current = tables.open_or_create(spark, path, tables.SERIES)
        tables.replace(current.unionByName(row), path)
    assert tables.open_or_create(spark, path, tables.SERIES).count() == 3
    older = spark.read.schema(tables.SERIES).parquet(f"{path}/{manifest.entries(spark, path, 1)[0]['folder']}")
    assert older.count() == 1  # an earlier version stays for who has opened it
    row.write.parquet(f"{path}/v-never-published")  # a writer that went away
    assert tables.open_or_create(spark, path, tables.SERIES).count() == 3
    tables.drop_old(spark, path, keep=1)
    assert tables.open_or_create(spark, path, tables.SERIES).count() == 3
    assert len(manifest.versions(spark, path)) == 1 and len(storage.names(spark, path)) == 3


def test_two_writers_give_one_of_the_serial_results(spark):
    path = new_path(spark, "t")
    tables.open_or_create(spark, path, tables.SERIES)
    rows = [spark.createDataFrame([(f"GSE{i}", "t", "s", "GSM1")], tables.SERIES) for i in range(4)]
    change = lambda row: tables.update(spark, path, tables.SERIES, lambda now: now.unionByName(row))
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(change, rows))
    assert sorted(r[0] for r in tables.open_or_create(spark, path, tables.SERIES).collect()) == [f"GSE{i}" for i in range(4)]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda row: tables.replace(row, path), rows))
    assert tables.open_or_create(spark, path, tables.SERIES).count() == 1


@pytest.mark.parametrize("name", ["_link", "_rename"])
def test_a_name_is_put_once(spark, monkeypatch, name):
    monkeypatch.setattr(storage, "_link", getattr(storage, name))
    path = f"{new_path(spark, 'put')}/a.json"
    assert storage.put_if_absent(spark, path, "first ä") and not storage.put_if_absent(spark, path, "second")
    assert storage.read_text(spark, path) == "first ä"
    assert storage.names(spark, path.rpartition("/")[0]) == ["a.json"]


def test_one_of_many_puts_wins(spark):
    path = f"{new_path(spark, 'put')}/a.json"
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: storage.put_if_absent(spark, path, str(i)), range(16)))
    assert sum(won) == 1 and storage.read_text(spark, path) == str(won.index(True))


def test_tsv_missing_and_header(spark):
    assert tsv.read_tsv(spark, new_path(spark, "none"), tsv.RUN_LIST).columns == ["gsm_id", "sample_name"]
    path = new_path(spark, "list")
    with pytest.raises(FileNotFoundError):
        tsv.read_checked(spark, path)
    assert tsv.read_checked(spark, path).count() == 0
    other = new_path(spark, "list")
    tsv.write_tsv(spark.createDataFrame([("a", "b")], "id STRING, sample_name STRING"), other)
    with pytest.raises(tsv.HeaderError):
        tsv.read_checked(spark, other)


def test_tsv_keeps_awkward_text(spark):
    path = new_path(spark, "text")
    rows = [("GSM1", 'say "hi"'), ("GSM2", "tab\there"), ("GSM3", None), ("GSM4", ""), ("GSM5", "a\nb\r\\n\\"), ("GSM6", " x ")]
    tsv.write_tsv(spark.createDataFrame(rows, tsv.RUN_LIST), path)
    got = [tuple(r) for r in tsv.read_tsv(spark, path, tsv.RUN_LIST).orderBy("gsm_id").collect()]
    assert got == rows


def test_store_absent_and_drift(spark):
    assert {k: v.count() for k, v in nested.read_store(spark, new_path(spark, "no")).items()} == {
        "GSE": 0, "GSM": 0, "SRR": 0,
    }
    path = new_path(spark, "store")
    old = [json.dumps({"id": "GSE1", "species": "Homo sapiens; Mus musculus", "child_gsm_ids": []})]
    new = [json.dumps({"runid": "GSE2", "species": ["Homo sapiens"]})]
    spark.createDataFrame([(t,) for t in old + new], "value STRING").write.text(f"{path}/GSE")
    got = {r.runid: r.species for r in nested.read_store(spark, path)["GSE"].collect()}
    assert got == {"GSE1": ["Homo sapiens", "Mus musculus"], "GSE2": ["Homo sapiens"]}


RUN_XML = """<RUN_SET><RUN><Pool><Member sample_name="GSM1" organism="Homo sapiens"/></Pool><SRAFiles>
<SRAFile supertype="Original" size="1073741824"><Alternatives url="s3://b/x_S1_L001_R1_001.fastq.gz"/></SRAFile>
<SRAFile supertype="Primary ETL" size="5"><Alternatives url="z"/></SRAFile>
<SRAFile supertype="Original" size="2"/></SRAFiles></RUN></RUN_SET>"""


def test_run_xml(spark):
    df = spark.createDataFrame([("SRR1", RUN_XML)], "run_id STRING, xml STRING")
    got = markup.run_files_from_xml(df, "xml").orderBy("place").collect()
    assert [(r.filetype, r.read_type, r.size_gb) for r in got][0] == ("fastq", "R1", 1.0)
    assert [(r.place, r.path) for r in got] == [(0, "s3://b/x_S1_L001_R1_001.fastq.gz"), (2, "")]
    assert all(r.found for r in got)


def test_run_xml_takes_the_first_run_and_member_and_marks_rejects(spark):
    second = '<Member sample_name="GSM2" organism="b"/></Pool>'
    many = RUN_XML.replace("</Pool>", second).replace("</RUN_SET>", "<RUN><Pool/></RUN></RUN_SET>")
    none = '<RUN_SET><RUN><Pool><Member sample_name="GSM3" organism="c"/></Pool></RUN></RUN_SET>'
    df = spark.createDataFrame([("1", many), ("2", none), ("3", "<RUN_SET><RUN>"), ("4", None)], "run_id STRING, xml STRING")
    rows = markup.run_files_from_xml(df, "xml").collect()
    assert {(r.run_id, r.gsm_id, r.found) for r in rows} == {
        ("1", "GSM1", True), ("2", "GSM3", False), ("3", None, False), ("4", None, False),
    }
    with pytest.raises(Exception, match="MALFORMED"):
        markup.run_files_from_xml(df, "xml", strict=True).collect()


def test_html_tables_have_their_own_headers(spark):
    one = "<table><tr><th>A</th></tr><tr><td>1</td></tr></table>"
    two = "<table><tr><th>B</th><th>C</th></tr><tr><td>2</td><td>3</td></tr></table>"
    df = spark.createDataFrame([(1, one + two), (2, "<p>none</p>"), (3, None)], "id INT, h STRING")
    got = {(r.id, r["table"]): r.cells for r in markup.table_rows_from_html(df, "h").collect()}
    assert got == {(1, 0): {"A": "1"}, (1, 1): {"B": "2", "C": "3"}, (2, None): None, (3, None): None}


def test_malformed_headings_are_rejects(spark):
    texts = [("GSM1: t; Mus musculus; x (SRR2)",), ("GSM1: only",), ("",), (None,)]
    got = markup.heading_fields(spark.createDataFrame(texts, "heading STRING")).collect()
    assert [(r.gsm_id, r.species, r.run_id) for r in got] == [("GSM1", "Musmusculus", "SRR2")] + [(None, None, None)] * 3


def test_html_table_skips_short_rows(spark):
    html = """<h1>GSM1: t; Mus musculus; x (SRR2)</h1><TABLE><tr><th class="a">Name</th><th>Size</th></tr>
      <tr><td>f1</td><td> <b>1G</b> </td></tr><tr><td>only</td></tr></TABLE>"""
    df = markup.heading_fields(markup.table_rows_from_html(spark.createDataFrame([(html,)], "h STRING"), "h"))
    row = df.first()
    assert df.count() == 1
    assert row.cells == {"Name": "f1", "Size": "1G"}
    assert (row.gsm_id, row.species, row.run_id) == ("GSM1", "Musmusculus", "SRR2")


def test_listing_tests_the_last_part_only(spark):
    root = new_path(spark, "files")
    one = spark.createDataFrame([("x",)], "value STRING")
    one.coalesce(1).write.option("compression", "none").text(f"{root}/GSM1.fastq/raw")
    one.coalesce(1).write.json(f"{root}/GSM2/raw")
    files = listing.file_listing(spark, root)
    assert {r.name.rsplit(".", 1)[-1] for r in files.collect()} == {"txt", "json"}
    found = listing.dumped_ids(files, "/(GSM[0-9]+)", extensions=(".json", ".fastq"))
    assert [r.id for r in found.collect()] == ["GSM2"]


def test_html_elements_inside_one_of_the_same_name(spark):
    deep = "<table><tr><th>C</th></tr><tr><td>3</td></tr></table>"
    inner = f"<TABLE class='x'><tr><th>B</th></tr><tr><td>2{deep}</td></tr><tr><td>2b</td></tr></TABLE>"
    outer = f"<table><tr><th>A</th><th>D</th></tr><tr><td>1 {inner}<b>!</b></td><td>4</td></tr><tr><td>5</td><td>6</td></tr></table>"
    rows = [(1, outer), (2, f"</table>{deep}"), (3, "<table><tr><th>A</th></tr><tr><td>open</td></tr>"), (4, "<tablet>no</tablet>"), (5, "")]
    df = spark.createDataFrame(rows, "id INT, h STRING")
    got = sorted((r.id, r["table"], r["row"], r.cells) for r in markup.table_rows_from_html(df, "h").collect() if r.cells)
    assert got == [
        (1, 0, 1, {"A": "1 !", "D": "4"}), (1, 0, 2, {"A": "5", "D": "6"}), (1, 1, 1, {"B": "2"}), (1, 1, 2, {"B": "2b"}),
        (1, 2, 1, {"C": "3"}), (2, 0, 1, {"C": "3"}), (3, 0, 1, {"A": "open"}),
    ]
    lists = "<ul><li>a<ol><li>b</li><li>c<ul><li>d</li></ul></li></ol></li><li>e</li></ul><ul><li>f</li></ul>"
    items = markup.list_rows_from_html(spark.createDataFrame([(lists,)], "h STRING"), "h").orderBy("row").collect()
    assert [r.text for r in items] == ["a", "e", "b", "c", "d", "f"]
