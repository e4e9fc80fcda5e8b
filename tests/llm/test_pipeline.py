"""The pipeline's stages take effect and keep the columns; every operator has its query."""

import re
import struct
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import duckdb
from public_tokenizers import path as tokenizer_path
from test_dedup import linked, removed, shingles
from tokenizers import Tokenizer

import __spark_entry__ as entry_point
from seqloom.llm import mixing, quality
from seqloom.llm.queries import QUERIES
from seqloom.llm.store import store


def test_every_operator_is_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry_point.queries())


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, counts, ids = docs.columns, [docs.count()], None
    for name, stage in corpus_pipeline.STAGES:
        docs = store(stage(spark, docs, sf), "stage")
        counts.append(docs.count())
        if name != "packing":
            assert docs.columns == columns
        if name == "near duplicates":
            ids = {r.doc_id for r in docs.select("doc_id").collect()}
        if name == "substring dedup":
            assert {r.doc_id for r in docs.select("doc_id").collect()} == ids
            assert docs.where("n_chars <> length(text)").isEmpty()
    assert counts[0] > counts[1] > counts[2] == counts[3]
    sizes = docs.groupBy("sequence_id").sum("length").collect()
    assert max(r[1] for r in sizes) <= 2048


def by_sql(frame, sql, tmp_path, name):
    """A query's SQL twin on a stage's own input."""
    path = str(tmp_path / name)
    frame.write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    result = con.sql(sql)
    return [dict(zip(result.columns, row, strict=True)) for row in result.fetchall()]


def test_every_stage_against_plain_python(spark, sf, tmp_path):
    """On all documents with copies, edits, nulls, empty and repeated rows added."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    some = docs.limit(40).selectExpr("doc_id + 100000 AS doc_id", "concat(text, ' and') AS text", "lang", "source", "n_chars")
    odd = spark.createDataFrame([(200000, None, None, None, None), (200001, "", "", "", 0), (200001, "", "", "", 0)], docs.schema)
    docs = store(docs.unionByName(some).unionByName(odd), "documents")

    def run(name, frame):
        return store(dict(corpus_pipeline.STAGES)[name](spark, frame, sf), name.replace(" ", "-"))

    kept = {r["doc_id"] for r in by_sql(docs, quality.SQL, tmp_path, "one") if r["kept"]}
    good = run("quality rules", docs)
    assert Counter(r.doc_id for r in good.collect()) == Counter(r.doc_id for r in docs.collect() if r.doc_id in kept)

    rows = sorted(good.select("doc_id", "text").collect())
    roots = linked([shingles(r.text) for r in rows])
    one = run("near duplicates", good)
    assert sorted(r.doc_id for r in one.collect()) == [rows[i].doc_id for i in range(len(rows)) if roots[i] == i]

    rows = sorted(one.select("doc_id", "text").collect())
    units = [r.text.encode().split() for r in rows]
    want = {}
    for r, words, gone in zip(rows, units, removed(units, 35), strict=True):
        left = b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode()
        want[r.doc_id] = left if any(gone) else r.text
    cut = run("substring dedup", one)
    assert {r.doc_id: (r.text, r.n_chars) for r in cut.collect()} == {i: (t, len(t)) for i, t in want.items()}
    assert any(t != r.text for r, t in zip(rows, want.values(), strict=True))

    copies = {r["doc_id"]: r["taken"] // r["size"] for r in by_sql(cut, mixing.SQL, tmp_path, "four") if r["size"]}
    mixed = run("mixing", cut)
    assert mixed.columns == columns
    assert Counter(r.doc_id for r in mixed.collect() if r.doc_id in copies) == {i: n for i, n in copies.items() if n}

    tokenizer = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    pieces = Counter()
    for r in mixed.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0]
        for i in range(0, len(ids), 2048):
            part = ids[i : i + 2048]
            pieces[(r.doc_id, i // 2048, i, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part)))] += 1
    packed = run("packing", mixed).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == pieces
    ends = defaultdict(list)
    for r in packed:
        ends[r.sequence_id].append((r.offset, r.offset + r.length))
    for spans in ends.values():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] <= 2048 and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_an_empty_table_passes_every_stage(spark, sf):
    docs = store(spark.read.parquet(f"{sf}/documents.parquet").limit(0), "documents")
    for name, stage in corpus_pipeline.STAGES:
        docs = store(stage(spark, docs, sf), "stage")
        assert docs.count() == 0, name
