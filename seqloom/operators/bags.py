"""Bag operators on sequences: append and remove by value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.operators.positions import dense, occurrence, with_gaps
from seqloom.selectors import POS, join_on_keys, total


class MissingValueError(ValueError):
    """A value to remove does not occur in the sequence."""


def append(df: DataFrame, other: DataFrame) -> DataFrame:
    """Add the elements of `other` after the last element; duplicates stay."""
    df, other = dense(df), dense(other)
    return df.unionByName(other.withColumn(POS, F.col(POS) + total(df)))


def except_bag(
    df: DataFrame,
    column: str,
    removed: DataFrame,
    strict: bool = False,
) -> DataFrame:
    """Remove the first occurrence of a value once per row of `removed` that lists it.

    Equal values are numbered in order and the first m of them drop, m being the number of
    rows of `removed` for that value; the survivors are renumbered when next asked for by
    position. `removed` is reduced to one row per value before the join.
    """
    budget = removed.groupBy(F.col(column)).agg(F.count(F.lit(1)).alias("__drop"))
    if strict:
        have = df.groupBy(column).agg(F.count(F.lit(1)).alias("__have"))
        short = join_on_keys(budget, have, [column], "left").filter(
            F.coalesce(F.col("__have"), F.lit(0)) < F.col("__drop")
        )
        if not short.isEmpty():
            raise MissingValueError(column)
    numbered = occurrence(df, column, "__nth")
    matched = join_on_keys(numbered, budget, [column], "left")
    kept = matched.filter(F.col("__nth") >= F.coalesce(F.col("__drop"), F.lit(0)))
    return with_gaps(kept.drop("__nth", "__drop"))


def remove_value(df: DataFrame, column: str, value: object, strict: bool = True) -> DataFrame:
    """Remove the first element equal to `value`."""
    at = df.filter(F.col(column).eqNullSafe(F.lit(value))).agg(F.min(POS).alias("at"))
    if strict and at.first()["at"] is None:
        raise MissingValueError(value)
    return with_gaps(df.filter(~F.col(POS).eqNullSafe(at.scalar())))
