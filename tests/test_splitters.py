"""Buckets that follow an order: bounded on any spread of keys, the same order for every type, nothing written."""

import datetime as dt
import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from seqloom.operators import positions as at
from seqloom.operators import splitters as sp

N, ROWS = 20_000, 500


def spread(name):
    rng = random.Random(3)
    if name == "one outlier":
        return [*range(N), 2**62]
    if name == "outliers on both sides":
        return [-(2**63), *range(N), 2**63 - 1]
    if name == "cubes":
        return [k**3 for k in range(N)]
    if name == "clusters":
        return sorted({c * 10**12 + rng.randrange(10**4) for c in rng.sample(range(10**6), 40) for _ in range(500)})
    if name == "powers":
        return sorted({int(2 ** rng.uniform(0, 62)) for _ in range(N)})
    return list(range(N))


@pytest.mark.parametrize("name", ["even", "one outlier", "outliers on both sides", "cubes", "clusters", "powers"])
def test_no_bucket_holds_more_than_twice_its_rows(spark, name):
    keys = spread(name)
    df = spark.createDataFrame([(k,) for k in keys], "k LONG")
    for text in (False, True):
        frame = df.withColumn("t", F.concat(F.lit("some/common/prefix/"), F.lpad(F.hex("k"), 16, "0"))) if text else df
        order = ["t", "k"] if text else ["k"]
        rows = at._bucketed(frame, [], order, ROWS).select(*order, "__bucket").collect()
        sizes = Counter(r["__bucket"] for r in rows)
        assert max(sizes.values()) <= 2 * ROWS
        assert len(sizes) <= 8 * len(keys) / ROWS
        rows.sort(key=lambda r: tuple(r[c] for c in order))
        buckets = [r["__bucket"] for r in rows]
        assert buckets == sorted(buckets)


def test_groups_with_equal_keys_need_no_splitters(spark):
    df = spark.range(N).select((F.col("id") % 3).alias("k"), (F.col("id") / 3).cast("long").alias("g"))
    numbered = at.with_pos(df, "k", "g", bucket_rows=ROWS).where("_pos <> k").count()
    assert numbered == 0


def test_a_hot_group_is_split_beside_many_small_ones(spark):
    df = spark.range(N).select(F.when(F.col("id") < 6000, -1).otherwise(F.col("id")).alias("g"), (F.col("id") % 7001).alias("k"))
    placed = at._bucketed(df, ["g"], ["k"], ROWS)
    assert placed.groupBy("g", "__bucket").count().agg(F.max("count")).first()[0] <= 2 * ROWS


def test_a_leading_integer_spares_the_bytes_of_all_columns(spark, monkeypatch):
    monkeypatch.setattr(at, "binary_key", lambda *_: pytest.fail("all columns as bytes"))
    df = spark.range(N).select(F.expr("id div 4").alias("k"), (3 - F.col("id") % 4).alias("j"), (F.col("id") % 3).alias("g"))
    assert at._bucketed(df, [], ["k", "j"], ROWS).groupBy("__bucket").count().agg(F.max("count")).first()[0] <= 2 * ROWS
    got = {(r.k, r.j): r["_pos"] for r in at.with_pos(df, ["k", "j"], bucket_rows=ROWS).collect()}
    assert got == {(i // 4, i % 4): i for i in range(N)}
    by_group = at.with_pos(df, ["k", "j"], "g", bucket_rows=ROWS).collect()
    places = Counter()
    for r in sorted(by_group, key=lambda r: (r.k, r.j)):
        assert r["_pos"] == places[r.g]
        places[r.g] += 1


@pytest.mark.parametrize("leading", ["CAST(NULL AS LONG)", "7L", "CASE WHEN id < 3000 THEN 7L WHEN id < 6000 THEN NULL ELSE id END"])
def test_a_leading_integer_that_repeats_too_often_is_not_enough(spark, leading):
    df = spark.range(N).selectExpr(f"{leading} AS k", "id * 7919 % 20011 AS j")
    placed = at._bucketed(df, [], ["k", "j"], ROWS)
    assert placed.groupBy("__bucket").count().agg(F.max("count")).first()[0] <= 2 * ROWS
    rows = df.collect()
    got = {(r.k, r.j): r["_pos"] for r in at.with_pos(df, ["k", "j"], bucket_rows=ROWS).collect()}
    want = sorted(rows, key=lambda r: (r.k is not None, r.k or 0, r.j))
    assert got == {(r.k, r.j): i for i, r in enumerate(want)}


def test_too_irregular_keys_take_the_sort(spark, monkeypatch):
    monkeypatch.setattr(sp, "MOST_PIECES", 2)
    keys = spread("clusters")
    random.Random(1).shuffle(keys)
    df = spark.createDataFrame([(k,) for k in keys], "k LONG")
    assert at._bucketed(df, [], ["k"], 50) is None
    got = {r.k: r["_pos"] for r in at.with_pos(df, "k", bucket_rows=50).collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}


DAY, HOUR = dt.date(1969, 12, 30), dt.datetime(1901, 1, 1, 3)
ORDERED = {
    "INT": [None, -(2**31), -5, -1, 0, 1, 7, 2**31 - 1],
    "BOOLEAN": [None, False, True],
    "DATE": [None, dt.date(1, 1, 1), *[DAY + dt.timedelta(i) for i in range(5)], dt.date(9999, 12, 31)],
    "TIMESTAMP": [None, *[HOUR + dt.timedelta(i * 9999, microseconds=i) for i in range(7)]],
    "DECIMAL(18,4)": [None, *[Decimal(x) for x in ("-99999999999999.9999", "-1", "-0.0001", "0", "0.0001", "2", "99999999999999.9999")]],
    "STRING": [None, "", "\0", "\0\0", "\0\1", "\0a", "\1", "a", "a\0", "a\0b", "aa", "ab", "b" * 30, "b" * 30 + "c", "ä", "\U0001f600"],
    "BINARY": [None, *[bytearray(b) for b in (b"", b"\0", b"\0\0", b"\0\1", b"\x7f", b"\x80", b"\xff", b"\xff\0")]],
    "DOUBLE": [None, float("-inf"), -1.7e308, -3.5, -1.0000000000000002, -1.0, -2.2250738585072014e-308, -5e-324, 0.0, 5e-324,
               2.2250738585072009e-308, 2.2250738585072014e-308, 0.1, 0.5, 1.0, 1.0000000000000002, 3.5, 1.7e308, float("inf"), float("nan")],
    "FLOAT": [None, float("-inf"), -2.5, -1e-45, 0.0, 1e-45, 0.125, 3.0, float("inf"), float("nan")],
}


@pytest.mark.parametrize("kind", ORDERED)
def test_bytes_sort_as_the_column(spark, kind):
    values = ORDERED[kind]
    rows = [(v, i) for i, v in enumerate(values)]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, f"v {kind}, i INT")
    keyed = [bytes(r.b) for r in df.select("i", sp.binary_key(df, ["v"]).alias("b")).orderBy("i").collect()]
    assert keyed == sorted(set(keyed)) and len(keyed) == len(values)
    # whatever follows a value changes nothing of its order
    pairs = df.crossJoin(df.select(F.col("v").alias("w"), F.col("i").alias("j")))
    both = [bytes(r.b) for r in pairs.select("i", "j", sp.binary_key(pairs, ["v", "w"]).alias("b")).orderBy("i", "j").collect()]
    assert both == sorted(set(both)) and len(both) == len(values) ** 2


def test_the_zeros_are_equal(spark):
    df = spark.sql("SELECT stack(2, -0.0D, 0.0D) AS v")
    assert df.select(sp.binary_key(df, ["v"]).alias("b")).distinct().count() == 1


def test_any_order_writes_nothing(spark, monkeypatch):
    monkeypatch.setattr(at, "stage", lambda *_: pytest.fail("written"))
    rng = random.Random(5)
    rows = [(rng.choice(["x", "y", None]), rng.uniform(-1, 1), i) for i in range(5000)]
    df = spark.createDataFrame(rows, "s STRING, d DOUBLE, i LONG")
    got = at.with_pos(df, ["s", "d", "i"], bucket_rows=100).collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2]))
    assert {r.i: r["_pos"] for r in got} == {r[2]: i for i, r in enumerate(want)}


def test_nested_orders_take_the_sort(spark):
    df = spark.createDataFrame([([2, 1], 0), ([1], 1), ([1, 5], 2)], "v ARRAY<INT>, i INT")
    assert {r.i: r["_pos"] for r in at.with_pos(df, "v").collect()} == {1: 0, 2: 1, 0: 2}
