"""Mixing sources to target weights: repeat or thin each source's documents towards a target size.

Sizes are word counts. A source's repetition rate is target / size; every document is taken
floor(rate) times, and once more when a coin seeded by its own id and text falls below the
fraction. A coin is a point on a circle; where on it a source's window of that fraction starts is
chosen among `STARTS` places as the one whose taken words come nearest to the target, since a few
very long documents would else decide that. Whatever the start, each document's extra copy has the
probability of the fraction. Nothing here depends on row order or partitioning, so reruns agree.

Defined results: a null text has size 0; a null source is a source of its own; rows equal in id
and text share one coin; a source without words has target 0 and is never taken; an empty table
gives an empty result; columns that the operator does not name are passed through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.llm.store import pack_rest, rest_of
from seqloom.llm.words import bound, word_count
from seqloom.staging import stage

KEPT = ("doc_id", "source", "text")
CYCLE = (5, 2, 1)
MOST = 3
#: Places on the circle of coins at which a source's window may start.
STARTS = 32


def cyclic_weights(sizes: DataFrame, cycle: tuple[int, ...] = CYCLE) -> DataFrame:
    """Add `weight` to one row per source: the cycle's weights, dealt by code point, null last.

    One row per source meets in one task here, however many documents there are.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    at = F.pmod(rank, F.lit(len(cycle)))
    return sizes.withColumn("weight", F.get(F.array(*map(F.lit, cycle)), at).cast("long"))


def source_targets(weighted: DataFrame, most: int = MOST) -> DataFrame:
    """Add `target` to (source, source_size, weight): shares of the total, at most `most` times a size.

    What a capped source leaves over is shared again by weight until none is above its cap. In order
    of cap per weight the capped sources come first, so the level all others share follows from
    running sums: a source is capped when its cap per weight is at or below the level that is left.
    """
    cap = F.col("source_size") * most
    before = Window.orderBy("_ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy("_ratio", F.col("source").asc_nulls_last()).rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0))).cast(
        "double"
    ) / F.sum("weight").over(onward).cast("double")
    ranked = weighted.withColumn("_cap", cap).withColumn("_ratio", cap.cast("double") / F.col("weight").cast("double"))
    ranked = ranked.withColumn("_level", level).withColumn("_capped", F.col("_ratio") <= F.col("_level"))
    # the level falls from one uncapped source to the next, so the first one's is the largest
    shared = F.max(F.when(~F.col("_capped"), F.col("_level"))).over(everything)
    target = F.when(F.col("_capped"), F.col("_cap").cast("double")).otherwise(shared * F.col("weight").cast("double"))
    return ranked.withColumn("target", target).drop("_cap", "_ratio", "_level", "_capped")


def coin(seed: str, doc_id: Column, text: Column) -> Column:
    """A fair number in [0, 1) from 52 bits of a hash of seed, id and text."""
    key = F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long").cast("double") / float(1 << 52)


def extra_copy(toss: Column, fraction: Column, start: Column) -> Column:
    """1 if the coin lies in the window of `fraction` that `start` turns to 0, else 0."""
    turned = toss + start.cast("double") / float(STARTS)
    return (turned - F.floor(turned) < fraction).cast("long")


def source_rates(packed: DataFrame, weights, seed: str, most: int) -> DataFrame:
    """One row per source: `_source`, `_source_size`, `_target`, `_whole`, `_fraction` and `_start`; stored."""
    sizes = packed.groupBy("source").agg(F.coalesce(F.sum(word_count(F.col("text"))), F.lit(0)).alias("source_size"))
    rate = F.when(
        F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size").cast("double"), F.lit(float(most)))
    ).otherwise(F.lit(0.0))
    rates = source_targets(weights(sizes), most).withColumn("_rate", rate)
    plan = stage(
        rates.select(
            F.col("source").alias("_source"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target"),
            F.floor("_rate").alias("_whole"), (F.col("_rate") - F.floor("_rate")).alias("_fraction"),
        ),
        "mix",
    )
    tossed = packed.select(
        "source", word_count(F.col("text")).alias("_size"), coin(seed, F.col("doc_id"), F.col("text")).alias("_coin")
    ).join(plan.select("_source", "_fraction"), F.col("source").eqNullSafe(F.col("_source")))
    each = [F.sum(F.col("_size") * extra_copy(F.col("_coin"), F.col("_fraction"), F.lit(j))) for j in range(STARTS)]
    sums = tossed.groupBy("source").agg(F.array(*each).alias("_sums"))
    off = F.transform("_sums", lambda x: F.abs(F.col("_source_size") * F.col("_whole") + x - F.col("_target")))
    joined = plan.join(sums, F.col("source").eqNullSafe(F.col("_source")))
    start = bound(off, lambda o: F.array_position(o, F.array_min(o)) - 1)
    return stage(joined.withColumn("_start", start).drop("source", "_sums"), "mix")


def with_copies(docs: DataFrame, weights=cyclic_weights, seed: str = "mix:", most: int = MOST) -> DataFrame:
    """Every document with `_size`, `_source_size`, `_target` and `_copies` (times it is taken).

    Beside these it has doc_id, source, text and a struct of all other columns. `weights` turns the frame
    (source, source_size) into one with a `weight` column. The frame of sources is written to shared storage;
    its size is then known, and Spark broadcasts it or sorts and splits hot sources as that size demands.
    """
    packed = pack_rest(docs, *KEPT)
    plan = source_rates(packed, weights, seed, most)
    extra = extra_copy(coin(seed, F.col("doc_id"), F.col("text")), F.col("_fraction"), F.col("_start"))
    return (
        packed.withColumn("_size", word_count(F.col("text")))
        .join(plan, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("_copies", F.col("_whole") + extra)
        .drop("_source", "_whole", "_fraction", "_start")
    )


def mix(docs: DataFrame, weights=cyclic_weights, seed: str = "mix:", most: int = MOST) -> DataFrame:
    """The mixed documents themselves: each row as often as it is taken, in its own columns."""
    taken = with_copies(docs, weights, seed, most).where(F.col("_copies") > 0)
    copies = F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))
    return taken.withColumn("_copy", copies).select(*rest_of(docs.columns, KEPT))


SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents
), s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, ([5, 2, 1])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::BIGINT AS weight FROM s
), r AS (SELECT *, (3 * source_size)::DOUBLE / weight::DOUBLE AS ratio FROM w),
l AS (
  SELECT *, ((sum(source_size) OVER ()) - coalesce(sum(3 * source_size) OVER (
             ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / (sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE
           AS level
  FROM r
), g AS (
  SELECT source, source_size,
         CASE WHEN ratio <= level THEN (3 * source_size)::DOUBLE
              ELSE (max(CASE WHEN ratio > level THEN level END) OVER ()) * weight::DOUBLE END AS target
  FROM l
), c AS (
  SELECT doc_id, d.source, size, source_size, target,
         CASE WHEN source_size > 0 THEN least(target / source_size::DOUBLE, 3.0::DOUBLE) ELSE 0.0::DOUBLE END AS rate,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(t)), 1, 13))::BIGINT::DOUBLE
           / 4503599627370496.0::DOUBLE AS coin
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
), tried AS (
  SELECT source, j, abs(any_value(source_size) * floor(any_value(rate)) + sum(CASE WHEN
           coin + j / 32.0::DOUBLE - floor(coin + j / 32.0::DOUBLE) < rate - floor(rate) THEN size ELSE 0 END)
           - any_value(target)) AS off
  FROM c, range(32) AS r(j) GROUP BY source, j
), best AS (SELECT source, arg_min(j, (off, j)) AS j FROM tried GROUP BY source)
SELECT doc_id, size, source_size, target, (size * (floor(rate) + CASE WHEN
         coin + j / 32.0::DOUBLE - floor(coin + j / 32.0::DOUBLE) < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c JOIN best ON c.source IS NOT DISTINCT FROM best.source
"""
