"""The queries of this subpackage, kept apart from the library's own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from seqloom.plans.registry import Query, Run

QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, run, sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
