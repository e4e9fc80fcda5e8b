"""Sequences and records as JSON text, and sequences from delimited text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.operators.positions import ordered_parts
from seqloom.selectors import POS, Names, Selector, as_column, as_names


def sequence_of(spark: SparkSession, n: int, value: str = "id", name: str = "value") -> DataFrame:
    """n generated elements; `value` is an expression of the index `id`."""
    return spark.range(n).select(F.col("id").alias(POS), F.expr(value).alias(name))


def sequences_of(df: DataFrame, length: str, value: str, name: str = "value") -> DataFrame:
    """A generated sequence per row, `length` elements each; `value` is an expression of `_pos`."""
    numbers = F.sequence(F.lit(0).cast("long"), F.greatest(F.col(length), F.lit(1)).cast("long") - 1)
    spread = df.filter(F.col(length) > 0).withColumn(POS, F.explode(numbers)).drop(length)
    return spread.withColumn(name, F.expr(value))


def from_json_array(df: DataFrame, column: str, element: str, name: str = "value") -> DataFrame:
    """One row per element of a JSON array text; malformed text fails the job."""
    others = [c for c in df.columns if c != column]
    parsed = F.from_json(F.col(column), f"array<{element}>", {"mode": "FAILFAST"})
    return df.select(*others, F.posexplode(parsed).alias(POS, name))


def from_string(df: DataFrame, column: str, sep: str, name: str = "value") -> DataFrame:
    """One row per piece of a delimited text; the delimiter is literal, empty pieces stay."""
    others = [c for c in df.columns if c != column]
    pieces = F.split(F.col(column), "\\Q" + sep + "\\E", -1)
    return df.select(*others, F.posexplode(pieces).alias(POS, name))


def to_json_array(
    df: DataFrame, value: Selector, by: Names = None, part_rows: int = 100_000, name: str = "json"
) -> DataFrame:
    """The selected values as JSON array text in order, nulls kept.

    A group past the bounds of `ordered_parts` comes as several arrays in order (`part`);
    `write.json` is the form for a whole table.
    """
    groups = as_names(by)
    values = df.withColumn("__value", as_column(df, value))
    parts = ordered_parts(values, groups, part_rows, F.octet_length(F.to_json(F.struct("__value"))))
    items = F.array_sort(F.collect_list(F.struct(POS, "__value")))
    return parts.groupBy(*groups, "part").agg(F.to_json(F.transform(items, lambda e: e["__value"])).alias(name))


def json_documents(
    df: DataFrame, key: Names, fields: list[str], children: str = "items", part_rows: int = 100_000, name: str = "json"
) -> DataFrame:
    """One nested JSON document per key: the key columns and its child records in order.

    A key whose children pass the bounds of `ordered_parts` gives one document per part.
    """
    keys = as_names(key)
    parts = ordered_parts(df, keys, part_rows, F.octet_length(F.to_json(F.struct(*fields))))
    items = F.array_sort(F.collect_list(F.struct(POS, F.struct(*fields).alias("record"))))
    grouped = parts.groupBy(*keys, "part").agg(F.transform(items, lambda e: e["record"]).alias(children))
    document = F.to_json(F.struct(*keys, children), {"ignoreNullFields": "false"})
    return grouped.select(*keys, "part", document.alias(name))
