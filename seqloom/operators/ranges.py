"""Ids asked for in ranges, met with records without expanding any range.

Ranges are merged into disjoint intervals by a running sum of their starts and ends, so their length and
their overlaps cost nothing. Records then meet intervals by an equi-join on buckets of numbers that hold a bounded
number of intervals each, with the one that reaches in from an earlier bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.operators.positions import running_total, with_gaps, with_pos
from seqloom.operators.splitters import IrregularKeysError, Splitters, splitters
from seqloom.selectors import POS
from seqloom.staging import stage

#: Intervals that one bucket is meant to hold.
BUCKET_INTERVALS = 64
#: Intervals up to which their table is sent to every executor; a larger one is shuffled.
MOST_SENT = 1 << 16


def number_of(column: Column, prefix: str) -> Column:
    """The number of an id; null for an id of another kind."""
    digits = F.regexp_extract(column, rf"^\Q{prefix}\E(\d{{1,18}})$", 1)
    return F.when(digits != "", digits).cast("long")


def asked_ranges(df: DataFrame, column: str, prefix: str = "GSM") -> DataFrame:
    """(low, high) for every id or range `low:high` of a comma-separated column; empty ranges and other ids drop out."""
    ends = F.split("__item", ":")
    items = df.select(F.explode(F.split(F.col(column), ",")).alias("__item"))
    ranges = items.select(
        number_of(F.trim(ends[0]), prefix).alias("low"), number_of(F.trim(F.element_at(ends, -1)), prefix).alias("high")
    )
    return ranges.filter("low <= high")


def disjoint(ranges: DataFrame) -> DataFrame:
    """The fewest intervals (low, high) with the same numbers: overlapping and adjacent ranges are one.

    A start adds one and the number after an end takes one away; an interval begins where the sum leaves zero
    and ends where it comes back, so begins and ends take turns.
    """
    steps = ranges.select(F.col("low").alias("at"), F.lit(1).alias("step")).unionByName(
        ranges.select((F.col("high") + 1).alias("at"), F.lit(-1).alias("step"))
    )
    steps = stage(steps.groupBy("at").agg(F.sum("step").alias("step")).filter("step <> 0"), "steps")
    open_before = running_total(steps, "at", F.col("step"), name="open")
    turns = stage(open_before.filter("open = 0 OR open + step = 0").select("at"), "turns")
    pairs = with_pos(turns, "at").withColumn("pair", F.expr(f"{POS} div 2"))
    return pairs.groupBy("pair").agg(F.min("at").alias("low"), (F.max("at") - 1).alias("high")).drop("pair")


def _buckets(intervals: DataFrame) -> Splitters:
    rows = BUCKET_INTERVALS
    while True:
        try:
            return splitters(intervals, F.col("low"), True, [], rows)
        except IrregularKeysError:
            rows *= 4


def in_intervals(df: DataFrame, number: Column, intervals: DataFrame) -> DataFrame:
    """The rows whose number lies in one of the disjoint intervals; a null number lies in none."""
    spark = df.sparkSession
    intervals = stage(intervals, "intervals")
    found = _buckets(intervals)
    own = F.sort_array(F.collect_list(F.struct("low", "high")))
    lists = found.apply(intervals, F.col("low"), "__bucket").groupBy("__bucket").agg(own.alias("own"))
    every = spark.range(found.first[-1]).select(F.col("id").alias("__bucket")).join(lists, "__bucket", "left")
    # one row a bucket: the last interval that starts before it may reach into it
    earlier = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    reaching = F.last(F.element_at("own", -1), ignorenulls=True).over(earlier)
    spans = F.concat(F.coalesce("own", F.array()), F.when(reaching.isNotNull(), F.array(reaching)).otherwise(F.array()))
    table = every.select("__bucket", spans.alias("__spans")).filter(F.size("__spans") > 0)
    if intervals.count() <= MOST_SENT:
        table = F.broadcast(table)
    met = found.apply(df.withColumn("__number", number), F.col("__number"), "__bucket").join(table, "__bucket")
    inside = F.exists("__spans", lambda s: (s["low"] <= F.col("__number")) & (F.col("__number") <= s["high"]))
    return with_gaps(met.filter(inside).select(*df.columns))


def range_members(records: DataFrame, key: str, asked: DataFrame, column: str, prefix: str = "GSM") -> DataFrame:
    """The records whose id is among the comma-separated ids and ranges of `asked`, each once, whatever asks for it."""
    return in_intervals(records, number_of(F.col(key), prefix), disjoint(asked_ranges(asked, column, prefix)))
