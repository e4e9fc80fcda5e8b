"""Row-by-row operators of a sequence: map, filter, look up, route."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Row
from pyspark.sql import functions as F

from seqloom.operators.positions import dense, first_by_key, with_gaps
from seqloom.selectors import POS, Names, Selector, as_column, as_names, if_true, unless_false


def select(df: DataFrame, **outputs: Selector) -> DataFrame:
    """Map each element; the position is kept so the result is still a sequence."""
    kept = [POS] if POS in df.columns else []
    return df.select(*kept, *[as_column(df, s).alias(n) for n, s in outputs.items()])


def set_indexed(df: DataFrame, column: str, fn: Callable[[Column, Column], Column]) -> DataFrame:
    """Replace a column by a function of its value and the element's position."""
    return dense(df).withColumn(column, fn(F.col(column), F.col(POS)))


def where(df: DataFrame, predicate: Selector) -> DataFrame:
    """Drop the elements for which the predicate is false; a null predicate keeps the element."""
    return with_gaps(df.filter(unless_false(df, predicate)))


def remove_on(df: DataFrame, predicate: Selector) -> DataFrame:
    """Drop the elements for which the predicate is true."""
    return with_gaps(df.filter(~if_true(df, predicate)))


def not_none(df: DataFrame, *columns: str) -> DataFrame:
    """Drop elements in which any of the given columns is null."""
    return with_gaps(df.dropna(subset=list(columns)))


def project(df: DataFrame, columns: Names) -> DataFrame:
    """Pick columns of a typed table by name; an unknown name is an analysis error."""
    return df.select(*as_names(columns))


def search(df: DataFrame, column: str, value: object) -> Row:
    """The first row whose id equals `value`; KeyError when there is none."""
    found = df.filter(F.col(column) == F.lit(value)).head(1)
    if not found:
        raise KeyError(value)
    return found[0]


def exists(df: DataFrame, column: str, value: object) -> bool:
    return not df.filter(F.col(column) == F.lit(value)).isEmpty()


def search_many(df: DataFrame, column: str, ids: DataFrame, name: str = "found") -> DataFrame:
    """`exists`/`search` for a whole frame of ids: each id with its first row, or nulls and false.

    First is by `_pos` where the table has one; any one row of a repeated id is taken else.
    """
    key = ids.columns[0]
    records = df.withColumnRenamed(column, key)
    once = first_by_key(records, key) if POS in df.columns else records.dropDuplicates([key])
    hits = once.withColumn(name, F.lit(True))
    return ids.join(hits, key, "left").withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def rename_to_scheme(df: DataFrame, scheme: dict[str, tuple[str, str]]) -> DataFrame:
    """Project to a declared table: target name -> (source column, type)."""
    return df.select(*[F.col(src).cast(kind).alias(dst) for dst, (src, kind) in scheme.items()])


def for_each(df: DataFrame, fn: Callable[[Row], object]) -> None:
    """Run a Python side effect per element, partition by partition; order is not promised."""

    def run(rows):
        for row in rows:
            fn(row)

    df.foreachPartition(run)


def for_each_if(
    df: DataFrame,
    column: str,
    on_value: Callable[[object], object],
    on_none: Callable[[], object] | None = None,
) -> None:
    """Run one side effect for non-null values and another for nulls (or the first for both)."""

    def run(rows):
        for row in rows:
            if row[0] is None and on_none is not None:
                on_none()
            else:
                on_value(row[0])

    df.select(column).foreachPartition(run)


def split_on_null(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """The non-null elements and the null elements, as two frames."""
    return with_gaps(df.filter(F.col(column).isNotNull())), with_gaps(df.filter(F.col(column).isNull()))


def pipe(df: DataFrame, *steps: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply steps in order."""
    for step in steps:
        df = df.transform(step)
    return df


def pipe_if(
    df: DataFrame,
    condition: Column,
    then: Callable[[DataFrame], DataFrame],
    otherwise: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Test one aggregate of the frame, then apply the chosen step."""
    return df.transform(then if df.agg(condition).first()[0] else otherwise)


def parallelize(df: DataFrame, workers: int) -> DataFrame:
    """Spread the following steps over `workers` partitions."""
    return df.repartition(workers)
