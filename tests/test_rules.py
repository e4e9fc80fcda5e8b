"""Nulls, ties, empty input and other rules, on literal data."""

import pytest
from conftest import in_order
from pyspark.sql import functions as F

from seqloom.operators import aggregates as agg
from seqloom.operators import bags, keyed, ordering, sequence
from seqloom.operators import positions as at


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0][-1]


def test_where_keeps_null_and_remove_on_ignores_it(spark, seq):
    df = seq([True, False, None], "boolean")
    assert [r.v for r in sequence.where(df, "v").orderBy("_pos").collect()] == [True, None]
    assert [r.v for r in sequence.remove_on(df, "v").orderBy("_pos").collect()] == [False, None]


def test_all_any_with_nulls_and_empty(seq):
    df = seq([True, None], "boolean")
    assert one(agg.all_of(df, "v")) is True
    assert one(agg.any_of(seq([None, None], "boolean"), "v")) is False
    empty = seq([], "boolean")
    assert one(agg.all_of(empty, "v")) is True
    assert one(agg.any_of(empty, "v")) is False
    assert one(agg.contains(empty, "v", True)) is False


def test_null_equals_null(seq):
    df = seq([1, None, None])
    assert one(agg.count_of(df, "v", None)) == 2
    assert one(agg.contains(df, "v", None)) is True
    assert one(at.index_of(df, "v", None)) == 1


def test_empty_aggregates(seq):
    empty = seq([])
    assert one(agg.sum_of(empty, "v")) == 0
    assert one(agg.average(empty, "v")) is None
    assert one(agg.max_of(empty, "v")) is None
    assert one(agg.first_on(empty, "v", "v > 0")) is None
    assert agg.first(empty).collect() == []
    for call in (agg.average, agg.max_of, agg.min_of):
        with pytest.raises(agg.EmptySequenceError):
            call(empty, "v", strict=True)
    with pytest.raises(agg.EmptySequenceError):
        agg.first(empty, strict=True)


def test_aggregates_skip_nulls(seq):
    df = seq([1, None, 4])
    assert one(agg.sum_of(df, "v")) == 5
    assert one(agg.average(df, "v")) == 2.5
    assert one(agg.min_of(df, lambda r: -r["v"])) == -4


def test_first_last_keep_null_elements(seq):
    df = seq([None, 2, None])
    assert agg.first(df).first().v is None
    assert agg.last(df).first().v is None
    assert one(agg.first_on(df, "v", "v IS NOT NULL")) == 2
    assert one(agg.last_on(df, "v", "v = 9")) is None


def test_sort_ties(spark):
    rows = [(0, "a", 1), (1, "b", 0), (2, "c", 1), (3, "d", 0)]
    df = spark.createDataFrame(rows, "_pos LONG, v STRING, k INT")
    assert "".join(r.v for r in ordering.order_by(df, "k").collect()) == "bdac"
    assert "".join(r.v for r in ordering.order_by_descending(df, "k").collect()) == "cadb"


def test_strings_sort_by_code_point(seq):
    df = seq(["b", "B", "é", "a"], "string")
    assert [r.v for r in ordering.order_by(df, "v").collect()] == ["B", "a", "b", "é"]


def test_join_strings_separator_only_between(seq):
    df = seq(["x", "y", "z"], "string")
    assert one(agg.join_strings(df, "v", "', ")) == "x', y', z"
    parts = agg.join_strings(df, "v", "-", part_rows=2).orderBy("part").collect()
    assert [r.joined for r in parts] == ["x-y", "z"]


def test_join_strings_backslash_separator(seq):
    assert one(agg.join_strings(seq(["x", "y"], "string"), "v", "\\")) == "x\\y"


def test_except_bag_removes_first_occurrences(spark, seq):
    df = seq([1, 2, 1, None, 1, None])
    removed = spark.createDataFrame([(1,), (1,), (None,)], "v INT")
    kept = bags.except_bag(df, "v", removed).orderBy("_pos").collect()
    assert [(r["_pos"], r.v) for r in kept] == [(1, 2), (4, 1), (5, None)]


def test_except_bag_strict(spark, seq):
    removed = spark.createDataFrame([(1,), (1,)], "v INT")
    with pytest.raises(bags.MissingValueError):
        bags.except_bag(seq([1, 2]), "v", removed, strict=True)


def test_remove_value(seq):
    kept = bags.remove_value(seq([3, 1, 3]), "v", 3)
    assert in_order(at.compact(kept)) == [1, 3]
    with pytest.raises(bags.MissingValueError):
        bags.remove_value(seq([3]), "v", 4)


def test_dictionary_first_write_wins_and_ignores_null_key(spark):
    rows = [(0, "a", 1), (1, None, 2), (2, "a", 3), (3, "b", None)]
    df = spark.createDataFrame(rows, "_pos LONG, k STRING, x INT")
    pairs = keyed.dictionary(df, "k", "x")
    assert {r.key: r.value for r in pairs.collect()} == {"a": 1, "b": None}
    assert one(keyed.count_key_of(pairs, "a")) == 1
    assert one(keyed.count_value_of(pairs, None)) == 1
    assert one(keyed.pair_index_of_on(pairs, "key IS NOT NULL")) == 0  # b has no value
    assert {r.key for r in keyed.remove_key(pairs, "key", "a").collect()} == {"b"}
    with pytest.raises(KeyError):
        keyed.remove_key(pairs, "key", "zz", strict=True)


def test_pair_insert_may_repeat_a_key(spark):
    pairs = spark.createDataFrame([("a", 1, 0), ("b", 2, 1)], "key STRING, value INT, _pos LONG")
    put = keyed.pair_insert_at(pairs, 1, "a", 9).orderBy("_pos").collect()
    assert [(r.key, r.value) for r in put] == [("a", 1), ("a", 9), ("b", 2)]


def test_upserts(spark):
    old = spark.createDataFrame([("a", 1, 0), ("b", 2, 1)], "k STRING, x INT, _pos LONG")
    new = spark.createDataFrame([("b", 3, 0), ("c", 4, 1), ("c", 5, 2), (None, 6, 3)], "k STRING, x INT, _pos LONG")
    first = {r.k: r.x for r in keyed.upsert_first_wins(old, new, "k").collect()}
    assert first == {"a": 1, "b": 2, "c": 4}
    last = {r.k: r.x for r in keyed.upsert_last_wins(old, new, "k").collect()}
    assert last == {"a": 1, "b": 3, "c": 5, None: 6}
    twice = spark.createDataFrame([("a", 1, 0), ("a", 2, 1), (None, 3, 2)], "k STRING, x INT, _pos LONG")
    assert {r.k: r.x for r in keyed.upsert_last_wins(twice, new, "k").collect()} == {"a": 2, "b": 3, "c": 5, None: 6}


def test_search_many_takes_the_first_row(spark):
    table = spark.createDataFrame([(1, "a", 10), (0, "a", 20), (2, "b", 30)], "_pos LONG, id STRING, x INT")
    ids = spark.createDataFrame([("a",), ("c",)], "id STRING")
    got = {r.id: (r.x, r.found) for r in sequence.search_many(table, "id", ids).collect()}
    assert got == {"a": (20, True), "c": (None, False)}


def test_maps_by_group_in_parts(spark):
    rows = [(i, "g", f"k{i % 5}", i) for i in range(10)]
    df = spark.createDataFrame(rows, "_pos LONG, g STRING, k STRING, x INT")
    whole = keyed.maps_by_group(df, "g", "k", "x").collect()
    assert [r["map"] for r in whole] == [{f"k{i}": i for i in range(5)}]
    parts = keyed.maps_by_group(df, "g", "k", "x", part_rows=2).orderBy("part").collect()
    assert [len(r["map"]) for r in parts] == [2, 2, 1]


def test_value_not_none(spark):
    good = spark.createDataFrame([("a", 1)], "key STRING, value INT")
    assert one(keyed.value_not_none(good)) == 1
    with pytest.raises(Exception, match="value is None"):
        keyed.value_not_none(good.withColumn("value", F.lit(None).cast("int"))).collect()


def test_search(seq):
    df = seq([5, 7])
    assert sequence.search(df, "v", 7)["_pos"] == 1
    assert sequence.exists(df, "v", 5) and not sequence.exists(df, "v", 6)
    with pytest.raises(KeyError):
        sequence.search(df, "v", 6)


def test_project_unknown_column(seq):
    with pytest.raises(Exception, match="nope"):
        sequence.project(seq([1]), ["nope"])


def test_pipe_if(seq):
    some = sequence.pipe_if(seq([1, 2]), F.max("v") > 1, lambda d: d.filter("v > 1"), lambda d: d.limit(0))
    assert [r.v for r in some.collect()] == [2]


def test_parallelize(seq):
    assert sequence.parallelize(seq(range(10)), 3).rdd.getNumPartitions() == 3


def test_for_each_if_routes_nulls(spark, seq):
    values, nulls = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)
    sequence.for_each_if(seq([1, None, 5]), "v", lambda v: values.add(v), lambda: nulls.add(1))
    assert (values.value, nulls.value) == (6, 1)


def test_selector_may_be_a_pandas_udf(seq):
    @F.pandas_udf("long")
    def squared(v):
        return v * v

    got = sequence.select(seq([2, 3]), squared=lambda r: squared(r["v"])).collect()
    assert [r.squared for r in got] == [4, 9]
