"""Numbering and positional edits against plain Python lists."""

import random

import pytest
from conftest import in_order
from pyspark.sql import functions as F

from seqloom.operators import aggregates, bags, sequence
from seqloom.operators import positions as at

VALUES = [7, 3, 3, 9, 1, 3, 8]


def number(df, **kwargs):
    return {(r.g, r.k): r["_pos"] for r in at.with_pos(df, by="g", **kwargs).collect()}


@pytest.fixture(scope="module")
def skewed(spark):
    """One group with a third of the rows, a null group, many small groups; keys in random order."""
    rows = [("hot" if i % 3 == 0 else None if i % 3 == 1 and i % 2 else f"g{i % 50}", i) for i in range(20_000)]
    random.Random(7).shuffle(rows)
    return spark.createDataFrame(rows, "g STRING, k LONG")


def expected(rows):
    seen, out = {}, {}
    for g, k in sorted(rows, key=lambda r: r[1]):
        out[(g, k)] = seen.get(g, 0)
        seen[g] = out[(g, k)] + 1
    return out


def test_large_groups_match_plain_window(skewed):
    want = expected([(r.g, r.k) for r in skewed.collect()])
    assert number(skewed, order="k") == want
    assert number(skewed, order="k", bucket_rows=10) == want


def test_large_groups_by_any_order(spark, skewed):
    text = skewed.withColumn("t", F.lpad(F.col("k").cast("string"), 6, "0"))
    assert number(text, order=["t", "k"], bucket_rows=10) == expected([(r.g, r.k) for r in skewed.collect()])


def test_input_already_partitioned_by_group(skewed):
    again = skewed.repartition("g")
    plan = at.with_pos(again, "k", "g", bucket_rows=10)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(g" in plan and "__bucket" in plan
    assert number(again, order="k", bucket_rows=10) == expected([(r.g, r.k) for r in skewed.collect()])


@pytest.mark.parametrize("bucket_rows", [1, 50, 1 << 20])
def test_buckets_by_value_of_uneven_keys(spark, bucket_rows):
    keys = [k * k * k for k in range(400)] + [2**62, -(2**62)]
    random.Random(1).shuffle(keys)
    rows = at.with_pos(spark.createDataFrame([(k,) for k in keys], "k LONG"), "k", bucket_rows=bucket_rows).collect()
    assert {r.k: r["_pos"] for r in rows} == {k: i for i, k in enumerate(sorted(keys))}


def test_positional_operators_close_gaps_first(seq):
    kept = sequence.where(seq(range(10)), "v % 3 = 0")  # 0, 3, 6, 9
    assert in_order(at.reverse(kept)) == [9, 6, 3, 0]
    assert [r.v for r in at.element_at(kept, 1).collect()] == [3]
    assert [r.v for r in at.element_at(kept, -1).collect()] == [9]
    assert in_order(at.insert_at(kept, 1, seq([7]))) == [0, 7, 3, 6, 9]
    assert in_order(bags.append(kept, seq([5]))) == [0, 3, 6, 9, 5]
    assert in_order(at.remove_at(kept, -1)) == [0, 3, 6]
    assert at.index_of(kept, "v", 6).first()["index"] == 2
    assert sorted(r.chunk for r in at.balanced_split(kept, 2).collect()) == [0, 0, 1, 1]


def test_parts_are_bounded_in_bytes(spark, monkeypatch):
    monkeypatch.setattr(at, "PART_BYTES", 100)
    rows = spark.createDataFrame([(i, "x" * (60 if i < 3 else 1)) for i in range(6)], "_pos LONG, t STRING")
    parts = at.ordered_parts(rows, None, 100, F.octet_length("t")).orderBy("_pos").collect()
    assert [r.part for r in parts] == [0, 0, 1, 1, 1, 1]


def test_parts_of_a_whole_frame_do_not_trust_positions(spark):
    rows = spark.createDataFrame([(0, "a"), (100_000, "b"), (200_000, "c")], "_pos LONG, t STRING")
    assert [r.joined for r in aggregates.join_strings(rows, "t", ",").collect()] == ["a,b,c"]


@pytest.mark.parametrize("keys", [[5, 1, 9, 2], [10**15, 1, 7], [None, 4, 2], [-3, 0, -9]])
def test_global_positions(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k LONG")
    want = {k: i for i, k in enumerate(sorted(keys, key=lambda k: (k is not None, k)))}
    assert {r.k: r["_pos"] for r in at.with_pos(df, "k").collect()} == want


def test_global_positions_many_buckets(spark):
    df = spark.range(30_000).select((F.col("id") * 7 % 30_011).alias("k"))
    rows = at.with_pos(df, "k").orderBy("_pos").collect()
    assert [r["_pos"] for r in rows] == list(range(30_000))
    assert [r.k for r in rows] == sorted(r.k for r in rows)


def test_empty(spark):
    empty = spark.createDataFrame([], "k LONG, g LONG")
    assert at.with_pos(empty, "k").collect() == []
    assert at.with_pos(empty, "k", "g").collect() == []


@pytest.mark.parametrize("index", [0, 3, 7, 8, 9, 99, -1, -3, -7, -8, -9, -50])
def test_insert_at(spark, seq, index):
    want = list(VALUES)
    for value in (100, 200, 300):
        want.insert(index, value)
    assert in_order(at.insert_at(seq(VALUES), index, seq([100, 200, 300]))) == want


@pytest.mark.parametrize("index", [0, 3, 6, -1, -7])
def test_remove_at(seq, index):
    want = list(VALUES)
    want.pop(index)
    assert in_order(at.remove_at(seq(VALUES), index)) == want


def test_remove_at_out_of_range(seq):
    for index in (7, -8):
        assert in_order(at.remove_at(seq(VALUES), index)) == VALUES
        with pytest.raises(IndexError):
            at.remove_at(seq(VALUES), index, strict=True)


@pytest.mark.parametrize(("start", "end"), [(0, 2), (2, 2), (3, None), (5, 99), (4, 1), (-3, 1)])
def test_remove_range_includes_both_ends(seq, start, end):
    last = len(VALUES) - 1 if end is None else end
    want = [v for i, v in enumerate(VALUES) if not start <= i <= last]
    assert in_order(at.remove_range(seq(VALUES), start, end)) == want


def test_reverse(seq):
    assert in_order(at.reverse(seq(VALUES))) == VALUES[::-1]


@pytest.mark.parametrize("index", [0, 6, 7, -1, -7, -8])
def test_element_at(seq, index):
    got = [r.v for r in at.element_at(seq(VALUES), index).collect()]
    assert got == ([VALUES[index]] if -len(VALUES) <= index < len(VALUES) else [])


def value(df):
    return df.first()["index"]


def test_index_of(seq):
    df = seq(VALUES)
    assert value(at.index_of(df, "v", 3)) == 1
    assert value(at.index_of(df, "v", 3, last=True)) == 5
    assert value(at.index_of(df, "v", 3, start=2)) == 2
    assert value(at.index_of(df, "v", 3, start=3, end=5)) == -1
    assert value(at.index_of(df, "v", 42)) == -1
    assert value(at.index_of_on(df, lambda r: r["v"] > 7)) == 6


def test_last_index_of_counts_from_the_back(seq):
    df = seq(VALUES)
    assert value(at.last_index_of(df, "v", 3)) == 1
    assert value(at.last_index_of(df, "v", 3, start=2)) == VALUES[::-1].index(3, 2)
    assert value(at.last_index_of(df, "v", 3, start=2, end=4)) == -1
    assert value(at.last_index_of(df, "v", 42)) == -1


def split_sizes(n, k):
    """Sizes by the rule: each chunk takes the ceiling of what is left."""
    sizes = []
    while k:
        size = -(-n // k)
        sizes.append(size)
        n, k = n - size, k - 1
    return [s for s in sizes if s]


def test_balanced_split(seq):
    for n in (1, 2, 11, 12, 23):
        for k in (1, 3, 4, 11):
            counts = at.balanced_split(seq(range(n)), k).groupBy("chunk").count().orderBy("chunk").collect()
            assert [r["count"] for r in counts] == split_sizes(n, k), (n, k)


@pytest.mark.parametrize(("n", "k", "want"), [(10, 3, [4, 4, 2]), (10, 20, [1] * 10), (9, 3, [3, 3, 3])])
def test_fixed_chunks(seq, n, k, want):
    counts = at.fixed_chunks(seq(range(n)), k).groupBy("chunk").count().orderBy("chunk").collect()
    assert [r["count"] for r in counts] == want


def test_sizes_of_spread_groups(spark, monkeypatch):
    monkeypatch.setattr(at, "POSITIONS_PER_BUCKET", 10)
    rows = [("a", i) for i in range(35)] + [(None, i) for i in range(4)]
    df = spark.createDataFrame(rows, "g STRING, _pos LONG")
    flipped = at.reverse(df, by="g").collect()
    assert sorted((str(r.g), r["_pos"]) for r in flipped) == sorted((str(g), p) for g, p in rows)
    last = {r.g: r["_pos"] for r in at.element_at(df, -1, by="g").collect()}
    assert last == {"a": 34, None: 3}


def test_compact_closes_gaps(spark):
    df = spark.createDataFrame([(4, "a"), (90, "b"), (7, "c")], "_pos LONG, v STRING")
    assert in_order(at.compact(df)) == ["a", "c", "b"]


def test_ordered_parts_of_large_group(spark):
    df = spark.range(100).select(F.col("id").alias("_pos"), (F.col("id") % 2).alias("g"))
    parts = at.ordered_parts(df, "g", 20).groupBy("g", "part").count().collect()
    assert sorted((r.g, r.part, r["count"]) for r in parts) == [
        (g, p, n) for g in (0, 1) for p, n in ((0, 20), (1, 20), (2, 10))
    ]
