"""How callers name columns and predicates, and the null rules that go with them.

A selector is a SQL expression string, a Column, or a function from the frame to a
Column. All of these stay inside Catalyst; `batched` makes one of a Python function on Arrow arrays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POS = "_pos"

Selector = str | Column | Callable[[DataFrame], Column]
Names = str | Iterable[str] | None


def as_column(df: DataFrame, selector: Selector) -> Column:
    if isinstance(selector, str):
        return F.expr(selector)
    if isinstance(selector, Column):
        return selector
    return selector(df)


def batched(function: Callable, returns: str, *inputs: Selector) -> Selector:
    """A selector in vectorised Python, for what no column expression says.

    `function` gets one Arrow array for each of `inputs` and gives one of the declared type `returns` and the
    same length; Spark calls it on batches of rows in Python workers. Any operator takes the result; all other
    forms of a selector stay in the JVM.
    """
    udf = F.arrow_udf(function, returns)
    return lambda df: udf(*[as_column(df, column) for column in inputs])


def as_names(names: Names) -> list[str]:
    if names is None:
        return []
    return [names] if isinstance(names, str) else list(names)


def unless_false(df: DataFrame, predicate: Selector) -> Column:
    """Only an explicit false counts as no: a null keeps the row."""
    return F.coalesce(as_column(df, predicate), F.lit(True))


def if_true(df: DataFrame, predicate: Selector) -> Column:
    """Only an explicit true counts as yes: a null does not match."""
    return F.coalesce(as_column(df, predicate), F.lit(False))


def same(column: Column, value: object) -> Column:
    """Equality under which null equals null."""
    return column.eqNullSafe(value if isinstance(value, Column) else F.lit(value))


def grouped(df: DataFrame, by: Names, *aggregates: Column) -> DataFrame:
    """Aggregate the whole frame, or each group when `by` is given."""
    keys = as_names(by)
    return df.groupBy(*keys).agg(*aggregates) if keys else df.agg(*aggregates)


def total(df: DataFrame) -> Column:
    """Row count as an uncorrelated scalar subquery, evaluated once per query."""
    return df.agg(F.count(F.lit(1))).scalar()


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join under which null keys match; the right side's key columns are dropped."""
    hidden = {k: f"__right_{k}" for k in keys}
    renamed = right.withColumnsRenamed(hidden)
    condition = None
    for key, other in hidden.items():
        term = left[key].eqNullSafe(renamed[other])
        condition = term if condition is None else condition & term
    joined = left.join(renamed, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*hidden.values())
