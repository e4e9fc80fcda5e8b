"""Connected components of a link table by alternating large and small stars.

Every step is one minimum per node, written to shared storage, and one join back, whose hot side Spark can
then split: a node with very many links spreads over tasks, and the lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.llm.store import store


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to the least of the node and its neighbours."""
    both = edges.select("a", "b").union(edges.select("b", "a")).toDF("u", "v")
    least = store(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the least of them; `a > b` in every row."""
    least = store(edges.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def _only_stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one root only, and no root hangs on another node."""
    if not edges.groupBy("a").agg(F.count("*").alias("roots")).where("roots > 1").isEmpty():
        return False
    return edges.join(edges.select(F.col("a").alias("b")), "b", "left_semi").isEmpty()


def components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """(node, root) over rows (a, b): with `rounds` None the least node reachable, for all but the roots.

    A given number of rounds may stop early; nodes that then share a root are connected all the same.
    """
    edges = store(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "links"
    )
    done = 0
    while rounds is None or done < rounds:
        edges = store(_small_star(_large_star(edges).distinct()).distinct(), "links")
        done += 1
        if rounds is None and _only_stars(edges):
            break
    stars = edges if rounds is None else edges.groupBy("a").agg(F.min("b").alias("b"))
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
