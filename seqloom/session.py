"""Session settings. Any session works; `tune` adds the adaptive ones to it."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Skewed partitions are split even where that costs one more shuffle: without it, a join
# followed by an aggregate on the same key would keep a hot key in one task.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
DEFAULTS = {
    **ADAPTIVE,
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def tune(spark: SparkSession) -> SparkSession:
    """Give a session made elsewhere the adaptive settings the joins rely on."""
    for key, value in ADAPTIVE.items():
        spark.conf.set(key, value)
    return spark


def session(master: str | None = None, app: str = "seqloom", **conf: str) -> SparkSession:
    """A session with the defaults above; `conf` keys use `__` in place of dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(cpus: int | None = None, **conf: str) -> SparkSession:
    """Single-machine session for tests and the benchmark."""
    cpus = cpus or os.cpu_count() or 8
    conf.setdefault("spark__sql__shuffle__partitions", str(cpus))
    conf.setdefault("spark__driver__memory", "8g")
    return session(master=f"local[{cpus}]", **conf)
