"""Mixing, quality rules and fingerprints: SQL twins, rules on small data, and plans without Python."""

import hashlib
import math
from collections import Counter

import oracle
import pytest
import xxhash
from conftest import plan_of
from llm_corpus import docs, nothing, rows  # noqa: F401
from pyspark.sql import functions as F

from seqloom.llm import fingerprints, mixing, quality
from seqloom.llm.queries import QUERIES

NATIVE = ["op1_mixing_sources", "op6_quality_rules"]


@pytest.mark.parametrize("name", NATIVE)
def test_matches_sql(spark, sf, name):
    result = QUERIES[name].run(spark, sf)
    assert "Python" not in plan_of(result) and "MapIn" not in plan_of(result)
    assert oracle.differences(result, oracle.connect(sf), QUERIES[name].sql) == []


def test_targets_are_shared_again_until_none_is_above_its_cap(spark):
    sizes = [("a", 10, 5), ("b", 1000, 2), ("c", 500, 1), ("d", 0, 5), (None, 90, 2)]
    got = mixing.source_targets(spark.createDataFrame(sizes, "source STRING, source_size LONG, weight LONG"))
    target = {r.source: r.target for r in got.collect()}
    want, free, left = {}, {s: w for s, _, w in sizes}, 1600.0
    cap = {s: 3.0 * n for s, n, _ in sizes}
    while True:
        share = left / sum(free.values())
        over = [s for s in free if cap[s] <= share * free[s]]
        if not over:
            break
        for s in over:
            want[s] = cap[s]
            left -= cap[s]
            del free[s]
    want |= {s: share * w for s, w in free.items()}
    assert target == pytest.approx(want)


def test_mix_keeps_columns_and_repeats_rows(spark, docs):
    mixed, taken = mixing.mix(docs), mixing.with_copies(docs)
    assert mixed.columns == docs.columns
    copies = {r.doc_id: r["_copies"] for r in taken.collect()}
    assert Counter(r.doc_id for r in mixed.collect()) == {d: n for d, n in copies.items() if n}
    assert max(copies.values()) <= 3
    again = {r.doc_id: r["_copies"] for r in mixing.with_copies(docs.repartition(7)).collect()}
    assert again == copies
    row = mixed.where("doc_id = 16").first()
    assert row is None or (row["_row"], row["_size"], row.marks) == (160, "x", [16])


def test_mix_of_nothing(nothing):
    assert mixing.mix(nothing).collect() == []


def counts(text):
    words = (text or "").encode().split()
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return (
        len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)), len(covered),
    )


def test_quality_counts(spark, docs, rows):
    more = [(100, "a b c a b c a b c"), (101, "x\n\nx\r\nx \nx"), (102, "#*$ %&| <> a\x0bb\x0cc"), (103, "a a a a")]
    extra = spark.createDataFrame(more, "doc_id LONG, text STRING")
    all_docs = docs.select("doc_id", "text").unionByName(extra)
    got = {r["_key"]: r for r in quality.judge(all_docs, F.col("doc_id")).collect()}
    for doc_id, text in [(r[0], r[1]) for r in rows] + more:
        assert tuple(got[doc_id][c] for c in quality.COUNTS) == counts(text), (doc_id, text)
        n, repeat = counts(text)[0], counts(text)[4]
        assert got[doc_id].base_failed == (n < 50 or 100 * repeat > 50 * n)
        assert not (got[doc_id].base_failed and got[doc_id].kept)


def test_quality_verdicts(spark):
    plain = "the cat sat on the mat and the dog was at the door of the house in which it had " * 1
    good = " ".join(f"{plain} w{i}a x{i}b y{i}c" for i in range(1))
    good = good + " " + " ".join(f"the thing{i} of a place{i * 3}" for i in range(20))
    cases = {
        "good": good,
        "symbols": " ".join(w + "#$%" for w in good.split()),
        "shouting": good.upper(),
        "no stop words": " ".join(f"lorem{i} ipsum{i}" for i in range(60)),
        "lines": "\n".join([good] + ["menu"] * 30 + ["item"] * 30),
    }
    frame = spark.createDataFrame(list(cases.items()), "name STRING, text STRING")
    kept = {r["_key"]: r.kept for r in quality.judge(frame, F.col("name")).collect()}
    assert kept == {"good": True, "symbols": False, "shouting": False, "no stop words": False, "lines": False}


def test_quality_keeps_columns(docs, nothing):
    good = quality.keep_good(docs)
    assert good.columns == docs.columns and good.where("text IS NULL").isEmpty()
    assert all(r["_row"] == r.doc_id * 10 for r in good.collect())
    assert quality.keep_good(nothing).collect() == []


def test_fingerprints(docs, rows, nothing):
    frame = fingerprints.fingerprint_with_edits(docs)
    got = {r.doc_id: r for r in frame.collect()}
    texts = [r[1] or "" for r in rows]
    for i, text in enumerate(texts):
        following, half = texts[(i + 1) % len(texts)], len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for other in range(i):
            if Counter(texts[other].encode().split()) == Counter(text.encode().split()):
                assert got[i].fingerprint == got[other].fingerprint
    assert got[0].near_next == 1.0 and got[7].near_next == 1.0 and got[6].fingerprint == ""
    assert got[5].near_next == 0.0
    assert fingerprints.fingerprint_with_edits(nothing).collect() == []


def test_fingerprints_exchange_texts_once(docs):
    """What the result reads holds no texts any more, so none are sent a second time."""
    told = fingerprints.fingerprint_with_edits(docs)
    assert told.count() == docs.count()
    read = set(told.inputFiles())
    assert read and not read & set(docs.inputFiles())


def test_fingerprint_likeness_estimates_generalised_jaccard(spark):
    a, b = Counter({"x": 8, "y": 4, "z": 1}), Counter({"x": 2, "y": 4, "w": 3})
    true = (2 + 4) / (8 + 4 + 1 + 3)
    rows = [(n, f"{w}{t}") for t in range(200) for n, c in ((f"a{t}", a), (f"b{t}", b)) for w in c.elements()]
    signed = fingerprints.signatures(spark.createDataFrame(rows, "doc STRING, word STRING"), ["doc"]).collect()
    prints = {r.doc: r.fingerprint for r in signed}
    size = fingerprints.HEX
    same = [
        prints[f"a{t}"][k : k + size] == prints[f"b{t}"][k : k + size]
        for t in range(200)
        for k in range(0, size * fingerprints.SAMPLES, size)
    ]
    assert abs(sum(same) / len(same) - true) < 0.02


def test_fingerprints_have_no_python(spark, sf):
    result = QUERIES["op5_document_fingerprints"].run(spark, sf)
    assert "Python" not in plan_of(result) and "MapIn" not in plan_of(result)


def _hash(seed, *parts):
    """Spark's xxhash64: every value hashed with the one before as seed."""
    for kind, value in parts:
        raw = value.encode() if kind == "string" else value.to_bytes(8 if kind == "long" else 4, "little", signed=True)
        seed = xxhash.xxh64(raw, seed=seed).intdigest()
    return seed


def _signature(text):
    """Consistent weighted sampling term by term, in plain Python."""
    terms = Counter(_hash(42, ("string", w.decode())) for w in (text or "").encode().split())
    if not terms:
        return ""
    out = ""
    for k in range(fingerprints.SAMPLES):
        best = None
        for term, n in terms.items():
            signed = term - (1 << 64) if term >> 63 else term
            uniform = lambda h, i: ((h >> 21 * i) % (1 << 21) + 0.5) / (1 << 21)
            one, two = (_hash(42, ("long", signed), ("int", 2 * k + i)) for i in (0, 1))
            r = -math.log(uniform(one, 0) * uniform(one, 1))
            c = -math.log(uniform(one, 2) * uniform(two, 0))
            beta = uniform(two, 1)
            t = math.floor(math.log(n) / r + beta)
            value = math.log(c) - r * (t - beta + 1.0)
            level = math.floor((max(min(value, 100.0), -400.0) + 400.0) * (1 << 29))
            name = _hash(42, ("long", signed), ("long", t)) % (1 << 24)
            best = min(best or (level, name), (level, name))
        out += f"{best[1]:06x}"
    return out


def _alike(a, b):
    if not a or not b:
        return 1.0 if a == b else 0.0
    return sum(a[i : i + 6] == b[i : i + 6] for i in range(0, len(a), 6)) / fingerprints.SAMPLES


def test_fingerprints_against_plain_python(spark):
    """Signatures and both likenesses, with ids that are far apart, equal or null."""
    texts = ["a b c d e f", "a b c d e f g", "a a a b", "b a a a", "", None, "ä ß\tx\x0by", "w " * 300 + "v", "one", "a b c d x f"]
    ids = [5, 7, 2**62, -(2**62), 7, None, None, 0, 100, 101]
    frame = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id LONG, text STRING")
    tie = {r.text: r.h for r in frame.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    order = sorted(zip(ids, texts, strict=True), key=lambda r: (r[0] is not None, r[0] or 0, tie[r[1]]))
    want = Counter()
    for (i, text), (_, following) in zip(order, order[1:] + order[:1], strict=True):
        text, following, half = text or "", following or "", len(text or "") // 2
        edited = text[: len(text) - half] + following[:half]
        mine, other = _signature(text), _signature(edited)
        want[(i, len(text), mine, other, _alike(mine, other), _alike(mine, _signature(following)))] += 1
    got = fingerprints.fingerprint_with_edits(frame).collect()
    assert Counter((r.doc_id, r.n_chars, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in got) == want


@pytest.mark.parametrize("kind", ["outlier", "equal ids", "null ids", "text ids"])
def test_cells_of_neighbours_are_small_however_ids_are_spread(spark, kind):
    n = 20_000
    frame = spark.range(n).select(F.concat(F.lit("text "), "id").alias("text"), "id")
    doc_id = {
        "outlier": F.when(F.col("id") == 0, F.lit(2**62)).otherwise(F.col("id")),
        "equal ids": F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")),
        "null ids": F.when(F.col("id") % 3 > 0, F.col("id")),
        "text ids": F.concat(F.lit("documents/part/"), F.col("id").cast("string")),
    }[kind]
    rows = fingerprints.with_following(frame.select(doc_id.alias("doc_id"), "text"))
    found = rows.agg(F.max("_no"), F.count("*"), F.count_distinct("_next_text")).first()
    assert found[0] <= 2 * fingerprints.CELL_ROWS and found[1] == found[2] == n


def test_the_pipelines_quality_filter_counts_once(docs):
    """The filter holds one verdict, however many rules read a count."""
    plan = quality.keep_good(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("xxhash64(") <= 4 and plan.count("split(") <= 3, plan
