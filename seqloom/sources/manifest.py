"""What a folder of tables holds, as numbered manifests: each number is published once, by one writer.

A writer first writes its data under names of its own, then publishes the list of all live entries as the
next number. Readers follow the newest manifest, so data is seen whole or not at all and nothing that is read is ever
replaced. A writer that finds its number taken has lost: it looks at what the winner left and tries again.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import SparkSession

from seqloom.sources import storage

FOLDER = "_manifest"  # Spark's readers skip names with an underscore

Entries = list[dict]


def versions(spark: SparkSession, path: str) -> list[int]:
    return [int(n.removesuffix(".json")) for n in storage.names(spark, f"{path}/{FOLDER}") if n.endswith(".json")]


def _file(path: str, version: int) -> str:
    return f"{path}/{FOLDER}/{version:012d}.json"


def entries(spark: SparkSession, path: str, version: int) -> Entries:
    return json.loads(storage.read_text(spark, _file(path, version)))


def latest(spark: SparkSession, path: str) -> tuple[int, Entries]:
    """The newest version and its entries; (-1, none) before the first."""
    known = versions(spark, path)
    return (max(known), entries(spark, path, max(known))) if known else (-1, [])


def publish(spark: SparkSession, path: str, version: int, live: Entries) -> bool:
    """Make `live` the given version, unless another writer has done so."""
    return storage.put_if_absent(spark, _file(path, version), json.dumps(live))


def commit(spark: SparkSession, path: str, change: Callable[[Entries], Entries]) -> int:
    """Publish what `change` makes of the newest entries, again for as long as other writers come first."""
    while True:
        version, live = latest(spark, path)
        if publish(spark, path, version + 1, change(live)):
            return version + 1


def forget(spark: SparkSession, path: str, keep: int) -> tuple[Entries, Entries]:
    """Delete all but the newest `keep` manifests; (entries that only those listed, entries that are still listed)."""
    known = sorted(versions(spark, path))
    old, kept = known[:-keep], known[-keep:]
    gone = [e for v in old for e in entries(spark, path, v)]
    live = [e for v in kept for e in entries(spark, path, v)]
    for version in old:
        storage.delete(spark, _file(path, version))
    return [e for e in gone if e not in live], live
