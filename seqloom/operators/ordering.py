"""Stable sorts and heads."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqloom.selectors import POS, Names, Selector, as_column, as_names


def order_by(df: DataFrame, selector: Selector) -> DataFrame:
    """Stable ascending sort: ties keep their order."""
    return df.orderBy(as_column(df, selector), F.col(POS))


def order_by_descending(df: DataFrame, selector: Selector) -> DataFrame:
    """The reverse of the stable ascending sort, so ties come out in reverse order."""
    return df.orderBy(as_column(df, selector).desc(), F.col(POS).desc())


def head(df: DataFrame, n: int = 1, by: Names = None) -> DataFrame:
    """The first n elements, of the frame or of each group."""
    keys = as_names(by)
    if not keys:
        return df.orderBy(POS).limit(n)
    window = Window.partitionBy(*keys).orderBy(POS)
    return df.withColumn("__rank", F.row_number().over(window)).filter(F.col("__rank") <= n).drop("__rank")
