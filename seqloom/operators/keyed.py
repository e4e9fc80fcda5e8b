"""Ordered dictionaries as frames: columns key, value, `_pos`, each key once.

The first write of a key wins and null keys are ignored, unless the name says otherwise.
Key and value may be any columns; the dictionary views use the names `key` and `value`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.operators.positions import dense, first_by_key, keep_last_by_key, ordered_parts, with_gaps
from seqloom.selectors import POS, Names, Selector, as_names, grouped, if_true, same, total


def dictionary(df: DataFrame, key: str, value: str, order: str = POS) -> DataFrame:
    """Build a dictionary from a frame of writes in `order`."""
    pairs = df.select(F.col(key).alias("key"), F.col(value).alias("value"), F.col(order).alias(POS))
    return first_by_key(pairs.filter(F.col("key").isNotNull()), "key")


def absent_rows(stored: DataFrame, incoming: DataFrame, key: Names, order: Names = POS) -> DataFrame:
    """The incoming rows a first-write-wins merge would add: first per key, key not stored.

    Only the key columns of the stored table are read.
    """
    keys = as_names(key)
    fresh = first_by_key(incoming.dropna(subset=keys), keys, order)
    return with_gaps(fresh.join(stored.select(*keys), keys, "left_anti"))


def upsert_first_wins(stored: DataFrame, incoming: DataFrame, key: Names) -> DataFrame:
    """Add the incoming rows whose key is new; `stored` has unique keys and is not rewritten.

    New rows follow the stored ones in `_pos`, with the gaps that known keys leave.
    """
    added = absent_rows(stored, incoming, key)
    return with_gaps(stored.unionByName(added.withColumn(POS, F.col(POS) + next_pos(stored))))


def upsert_last_wins(stored: DataFrame, incoming: DataFrame, key: Names) -> DataFrame:
    """Concatenate and keep the last row of each key, the stored table's own repeats included.

    Null is a key like any other here.
    """
    moved = incoming.withColumn(POS, F.col(POS) + next_pos(stored))
    return keep_last_by_key(stored.unionByName(moved), key)


def next_pos(df: DataFrame):
    """The position after the last one in use, as a scalar subquery."""
    return df.agg(F.coalesce(F.max(POS) + 1, F.lit(0))).scalar()


def remove_key(df: DataFrame, key: str, value: object, strict: bool = False) -> DataFrame:
    hit = F.col(key).eqNullSafe(F.lit(value))
    if strict and df.filter(hit).isEmpty():
        raise KeyError(value)
    return with_gaps(df.filter(~hit))


def remove_keys(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Drop every pair whose key is listed."""
    return with_gaps(df.join(keys, keys.columns, "left_anti"))


def lookup_value(
    df: DataFrame, key: str, pairs: DataFrame, name: str = "value", pair_key: str = "key", pair_value: str = "value"
) -> DataFrame:
    """`dictionary[key]` for every row: the value, or null when the key is absent."""
    side = pairs.select(F.col(pair_key).alias(key), F.col(pair_value).alias(name))
    return df.join(side, key, "left")


def dict_keys(pairs: DataFrame) -> DataFrame:
    return pairs.select("key")


def dict_values(pairs: DataFrame) -> DataFrame:
    return pairs.select("value")


def dict_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.struct("key", "value").alias("pair"))


def count_key_of(pairs: DataFrame, key: object, name: str = "count") -> DataFrame:
    return grouped(pairs, None, F.count_if(same(F.col("key"), key)).alias(name))


def count_value_of(pairs: DataFrame, value: object, name: str = "count") -> DataFrame:
    return grouped(pairs, None, F.count_if(same(F.col("value"), value)).alias(name))


def pair_index_of_on(pairs: DataFrame, predicate: Selector, name: str = "index") -> DataFrame:
    """Position of the last pair that matches; pairs with a null value are skipped."""
    pairs = dense(pairs)
    hit = if_true(pairs, predicate) & F.col("value").isNotNull()
    return pairs.agg(F.coalesce(F.max(F.when(hit, F.col(POS))), F.lit(-1)).alias(name))


def pair_insert_at(pairs: DataFrame, index: int, key: object, value: object) -> DataFrame:
    """Insert one pair at `index`; a repeated key is allowed."""
    pairs = dense(pairs)
    size = total(pairs)
    at = F.least(F.lit(index), size) if index >= 0 else F.greatest(F.lit(0), size + index)
    types = {f.name: f.dataType for f in pairs.schema.fields}
    one = pairs.sparkSession.range(1).select(
        F.lit(key).cast(types["key"]).alias("key"), F.lit(value).cast(types["value"]).alias("value"), at.alias(POS)
    )
    shifted = pairs.withColumn(POS, F.col(POS) + F.when(F.col(POS) >= at, 1).otherwise(0))
    return shifted.select("key", "value", POS).unionByName(one)


def maps_by_group(df: DataFrame, by: Names, key: str, value: str, part_rows: int = 100_000) -> DataFrame:
    """One map per group from its pairs, first write of a key wins.

    A group past the bounds of `ordered_parts` gets several maps with disjoint keys.
    """
    groups = as_names(by)
    pairs = first_by_key(df.dropna(subset=[key]), [*groups, key])
    size = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in (key, value)), F.lit(0))
    parts = ordered_parts(pairs, groups, part_rows, size)
    entries = F.array_sort(F.collect_list(F.struct(POS, F.col(key).alias("key"), F.col(value).alias("value"))))
    as_map = F.map_from_entries(F.transform(entries, lambda e: F.struct(e["key"], e["value"])))
    return parts.groupBy(*groups, "part").agg(as_map.alias("map"))


def value_not_none(df: DataFrame, value: str = "value") -> DataFrame:
    """Fail the job when a value is null."""
    return df.withColumn(value, F.coalesce(F.col(value), F.raise_error(F.lit("value is None"))))
