"""Fill-in-middle: SQL twin, a plain-Python version, exact round trips, awkward texts."""

import hashlib
import re

import oracle
import pytest
from conftest import plan_of
from llm_corpus import docs, nothing, rows  # noqa: F401
from pyspark.sql import functions as F

from seqloom.llm import infill
from seqloom.llm.queries import QUERIES


def expected(doc_id, text, cut=100, suffix_first=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    name = "" if doc_id is None else str(doc_id)
    digest = hashlib.sha256(f"7:{name}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= cut:
        return len(units), "plain", text, None, None
    if h[3] % 100 < suffix_first:
        return len(units), "spm", f"<S>{suffix}<P>{prefix}<M>{middle}", len(prefix), len(middle)
    return len(units), "psm", f"<P>{prefix}<S>{suffix}<M>{middle}", len(prefix), len(middle)


def test_matches_sql(spark, sf):
    result = QUERIES["op11_infill"].run(spark, sf)
    assert "Python" not in plan_of(result) and "MapIn" not in plan_of(result)
    assert oracle.differences(result, oracle.connect(sf), QUERIES["op11_infill"].sql) == []
    assert {r.form for r in result.select("form").distinct().collect()} >= {"psm", "spm"}


AWKWARD = [
    None, "", "\n", "\n\n\n", "a", "a\n", "\na", "a\r\nb c\x85d\n", "has <P> in it\nx", "<S>", "a\n<M>\nb", "<\nP>\n<P\n>", "x<S\ny>",
    "$1 \\1 {2}\n$0\n\\E\\Q", "\U0001f600\n\U0001f600\U0001f600\nä́", "<" * 50 + "\n" + ">" * 50, "no end " * 50_000,
    "line\n" * 30_000, "\n" * 20_000, "\x00\n\x00", "same\nsame\n", "same\nsame\n",
]


@pytest.mark.parametrize(("cut", "suffix_first"), [(100, 50), (60, 0), (100, 100)])
def test_equals_plain_python_and_gives_the_text_back(spark, cut, suffix_first):
    texts = [(i % 40 if i % 11 else None, t) for i, t in enumerate(AWKWARD * 4)]
    docs = spark.createDataFrame(texts, "doc_id LONG, text STRING").repartition(3)
    made = infill.infill(docs, cut=cut, suffix_first=suffix_first).withColumn("back", infill.restored(F.col("_output"), F.col("_form")))
    got = made.select("__rest.doc_id", "text", "_n", "_form", "_output", "_prefix_chars", "_middle_chars", "back").collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r["_n"], r["_form"], r["_output"], r["_prefix_chars"], r["_middle_chars"]) == expected(
            r["doc_id"], r["text"], cut, suffix_first
        )
        assert r["back"] == r["text"]


def test_keeps_other_columns_and_handles_empty_tables(docs, nothing):
    made = infill.infill(docs)
    row = made.where("__rest.doc_id = 5").select("__rest.*").first()
    assert (row["_row"], row["_kept"], row["marks"]) == (50, "5", [5])
    assert infill.infill(nothing).collect() == []
