"""Aggregates of a sequence, whole or per group (`by`).

All reduce on the map side first, so a hot group costs one row per task in the shuffle.
Null inputs are skipped; an empty input gives 0 / true / false / null as documented.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.operators.positions import first_by_key, keep_last_by_key, ordered_parts, with_gaps
from seqloom.selectors import (
    POS,
    Names,
    Selector,
    as_column,
    as_names,
    grouped,
    if_true,
    same,
    unless_false,
)


class EmptySequenceError(ValueError):
    """A strict aggregate was asked of a sequence with no elements."""


def _strict(result: DataFrame, name: str, strict: bool) -> DataFrame:
    if strict and result.filter(F.col(name).isNotNull()).isEmpty():
        raise EmptySequenceError(name)
    return result


def length(df: DataFrame, by: Names = None, name: str = "length") -> DataFrame:
    return grouped(df, by, F.count(F.lit(1)).alias(name))


def count_of(df: DataFrame, column: str, value: object, by: Names = None, name: str = "count") -> DataFrame:
    """Number of elements equal to `value`; null equals null."""
    return grouped(df, by, F.count_if(same(F.col(column), value)).alias(name))


def count_of_on(df: DataFrame, predicate: Selector, by: Names = None, name: str = "count") -> DataFrame:
    return grouped(df, by, F.count_if(if_true(df, predicate)).alias(name))


def contains(df: DataFrame, column: str, value: object, by: Names = None, name: str = "contains") -> DataFrame:
    hit = F.bool_or(same(F.col(column), value))
    return grouped(df, by, F.coalesce(hit, F.lit(False)).alias(name))


def contains_any(df: DataFrame, column: str, value: object) -> bool:
    """Whole-frame `contains` that stops at the first match."""
    return not df.filter(same(F.col(column), value)).isEmpty()


def all_of(df: DataFrame, predicate: Selector, by: Names = None, name: str = "all_of") -> DataFrame:
    """True unless some element gives false; null counts as true, and so does no element."""
    return grouped(df, by, F.coalesce(F.bool_and(unless_false(df, predicate)), F.lit(True)).alias(name))


def any_of(df: DataFrame, predicate: Selector, by: Names = None, name: str = "any_of") -> DataFrame:
    return grouped(df, by, F.coalesce(F.bool_or(if_true(df, predicate)), F.lit(False)).alias(name))


def sum_of(df: DataFrame, selector: Selector, by: Names = None, name: str = "sum") -> DataFrame:
    """Sum of the selected numbers, 0 when there are none."""
    return grouped(df, by, F.coalesce(F.sum(as_column(df, selector)), F.lit(0)).alias(name))


def average(
    df: DataFrame, selector: Selector, by: Names = None, name: str = "average", strict: bool = False
) -> DataFrame:
    return _strict(grouped(df, by, F.avg(as_column(df, selector)).alias(name)), name, strict)


def max_of(df: DataFrame, selector: Selector, by: Names = None, name: str = "max", strict: bool = False) -> DataFrame:
    """The largest selected value (not the element it came from)."""
    return _strict(grouped(df, by, F.max(as_column(df, selector)).alias(name)), name, strict)


def min_of(df: DataFrame, selector: Selector, by: Names = None, name: str = "min", strict: bool = False) -> DataFrame:
    return _strict(grouped(df, by, F.min(as_column(df, selector)).alias(name)), name, strict)


def first(df: DataFrame, by: Names = None, strict: bool = False) -> DataFrame:
    """The first element (row), of the frame or of each group."""
    found = first_by_key(df, by) if as_names(by) else df.orderBy(POS).limit(1)
    if strict and found.isEmpty():
        raise EmptySequenceError("first")
    return found


def last(df: DataFrame, by: Names = None, strict: bool = False) -> DataFrame:
    found = keep_last_by_key(df, by) if as_names(by) else df.orderBy(F.col(POS).desc()).limit(1)
    if strict and found.isEmpty():
        raise EmptySequenceError("last")
    return found


def first_on(
    df: DataFrame, value: Selector, predicate: Selector, by: Names = None, name: str = "first"
) -> DataFrame:
    """The value of the first element that satisfies the predicate; null when none does."""
    return grouped(df, by, _pick(F.min_by, df, value, predicate).alias(name))


def last_on(df: DataFrame, value: Selector, predicate: Selector, by: Names = None, name: str = "last") -> DataFrame:
    return grouped(df, by, _pick(F.max_by, df, value, predicate).alias(name))


def _pick(choose, df: DataFrame, value: Selector, predicate: Selector) -> Column:
    return choose(as_column(df, value), F.when(if_true(df, predicate), F.col(POS)))


def join_strings(
    df: DataFrame,
    value: Selector,
    sep: str = "",
    by: Names = None,
    part_rows: int = 100_000,
    name: str = "joined",
) -> DataFrame:
    """Concatenate values in order, the separator only between items.

    One row per group while it keeps within `part_rows` rows and the byte bound of
    `ordered_parts`. A larger group comes as consecutive parts, since no single row can
    hold it; joining the parts with `sep` gives the whole text. Nulls are skipped.
    """
    texts = df.withColumn("__text", as_column(df, value).cast("string"))
    parts = ordered_parts(texts, by, part_rows, F.octet_length("__text") + len(sep.encode()))
    quoted = sep.replace("\\", "\\\\").replace("'", "\\'")
    text = F.expr(f"listagg(__text, '{quoted}') WITHIN GROUP (ORDER BY {POS})")
    return parts.groupBy(*as_names(by), "part").agg(text.alias(name))


def collect_children(
    df: DataFrame, parent: Names, child: str, sep: str = ",", part_rows: int = 100_000, name: str = "children"
) -> DataFrame:
    """Children ids of each parent, comma-joined in order (large families in parts)."""
    return join_strings(df, child, sep, parent, part_rows, name)


def expand_children(df: DataFrame, children: str, sep: str = ",", name: str = "child") -> DataFrame:
    """Inverse of `collect_children`: one row per child with its place in the list."""
    others = [c for c in df.columns if c != children]
    pattern = "\\Q" + sep + "\\E"
    return df.select(*others, F.posexplode(F.split(children, pattern, -1)).alias("place", name))


def unique(df: DataFrame, columns: Names) -> DataFrame:
    """Distinct values; order is undefined."""
    return df.select(*as_names(columns)).distinct()


def next_lane(df: DataFrame, sample: Names, lane: str, name: str = "next_lane") -> DataFrame:
    """`L` and the number after the count of distinct lanes already used in the sample."""
    used = F.count_distinct(F.col(lane)) + 1
    return df.groupBy(*as_names(sample)).agg(F.concat(F.lit("L"), _three_digits(used)).alias(name))


def _three_digits(number: Column) -> Column:
    return F.format_string("%03d", number)


def location_pick(
    df: DataFrame,
    run: str = "run_id",
    filetype: str = "filetype",
    location: str = "location",
    egress: str = "egress",
    free: str = "worldwide",
    name: str = "picked",
) -> DataFrame:
    """Keep each run's rows at one location, named in `picked`.

    A run whose first file is fastq uses its first location, any other run its first
    location with free egress. A run without one is a reject: its rows stay, with a null.
    """
    choice = df.groupBy(run).agg(
        F.min_by(filetype, POS).alias("__type"),
        F.min_by(location, POS).alias("__first"),
        F.min_by(F.col(location), F.when(F.col(egress) == free, F.col(POS))).alias("__free"),
    )
    picked = F.when(F.col("__type") == "fastq", F.col("__first")).otherwise(F.col("__free"))
    joined = df.join(choice.filter(F.col(run).isNotNull()).select(run, picked.alias(name)), run, "left")
    return with_gaps(joined.filter(F.coalesce(F.col(location) == F.col(name), F.col(name).isNull())))
