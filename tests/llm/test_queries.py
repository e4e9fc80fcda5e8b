"""The registered queries themselves on a small table: columns, rows, and the texts behind their digests."""

import hashlib
import importlib
import os
import subprocess
import sys

import pytest
from llm_corpus import docs, nothing, rows  # noqa: F401

from seqloom.llm.queries import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="module")
def tables(spark, rows, tmp_path_factory):
    """The awkward corpus as `documents`, with labels, pages and a few vectors beside it."""
    folder = str(tmp_path_factory.mktemp("sf"))
    full = [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]
    spark.createDataFrame(full, "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(i % 2 == 0), 0) for i in range(0, len(rows), 2)], "doc_id LONG, quality INT, toxic INT").write.parquet(f"{folder}/labels.parquet")
    pages = [(0, "https://www.example.com/en/x?a", "<article><p>Text</p></article>"), (1, None, None), (2, "no scheme", "")]
    spark.createDataFrame(pages, "page_id LONG, url STRING, html STRING").write.parquet(f"{folder}/pages.parquet")
    vectors = [(i, [((i * 7 + j) % 11) / 10 for j in range(64)]) for i in range(40)] + [(99, None)]
    spark.createDataFrame(vectors, "vec_id LONG, embedding ARRAY<FLOAT>").write.parquet(f"{folder}/embeddings.parquet")
    return folder


COLUMNS = {
    "op1_mixing_sources": "doc_id size source_size target taken",
    "op2_substring_dedup": "doc_id n_words n_removed kept_sha256",
    "op3_ngram_jaccard_join": "doc_id n_shingles component_id",
    "op4_lm_scoring": "doc_id n_words target_loss background_loss score",
    "op5_document_fingerprints": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op6_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op7_url_filters": "page_id host path rule verdict",
    "op8_suffix_array_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op9_best_fit_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op10_license_scans": "doc_id license",
    "op11_infill": "doc_id n form prefix_chars middle_chars output_sha256 restored_sha256",
    "op12_centroid_clustering": "vec_id cluster distance cluster_inertia inertia centroid_sha256",
    "op13_html_extraction": "page_id url text n_chars",
}


def test_every_operator_is_here():
    assert set(COLUMNS) == set(QUERIES)


@pytest.mark.parametrize("name", COLUMNS)
def test_query_gives_its_columns_for_every_row(spark, tables, rows, name):
    got = QUERIES[name].run(spark, tables)
    assert set(COLUMNS[name].split()) <= set(got.columns)
    found = got.collect()
    if name.startswith(("op7", "op13")):
        assert sorted(r.page_id for r in found) == [0, 1, 2]
    elif name.startswith("op12"):
        assert sorted(r.vec_id for r in found) == list(range(40))
    else:
        ids = [r.doc_id for r in found if not name.startswith("op9") or r.piece == 0]
        assert sorted(ids) == list(range(len(rows)))
    if name.startswith(("op2_", "op8_")):
        for r in found:
            text = rows[r.doc_id][1] or ""
            whole = " ".join(text.split()) if name.startswith("op2_") and not r.n_removed and text.isascii() else text
            if not r.n_removed and (text.isascii() or name.startswith("op8_")):
                assert r.kept_sha256 == hashlib.sha256(whole.encode()).hexdigest()


def test_entry_without_the_tokenizers_or_the_subpackage():
    """Whatever of the subpackage cannot be imported, the other queries are there."""
    code = (
        "import sys; sys.modules[{!r}] = None; import __spark_entry__ as e; names = set(e.queries());"
        " assert len(names) > 150 and not any(n.startswith('op') and n[2].isdigit() for n in names) and 'pipeline' not in names"
    )
    for gone in ("public_tokenizers", "corpus_pipeline", "seqloom.llm", "seqloom.llm.queries"):
        subprocess.run([sys.executable, "-c", code.format(gone)], cwd=ROOT, check=True, timeout=120)
    assert importlib.import_module("__spark_entry__").queries().keys() >= set(QUERIES)
