"""Recompression in Spark rounds: one dictionary a round names all runs or pairs of the whole corpus.

Symbols are rows (text, place, name). A round finds each text's runs or pairs with windows over the text, numbers the
different (name, size) or (name, partner) of the corpus, and joins the numbers back as the next names. Which of two
neighbours goes left is one bit of a hash of its name and the round, so equal names choose alike everywhere.

The symbols serve like those of `recompression`, whose names are hashes in place of numbers; every round moves all
symbols twice, once to their text and once to their name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.llm.recompression import ROUNDS
from seqloom.llm.store import release, store
from seqloom.llm.words import word_array
from seqloom.operators.positions import with_pos

_SPANS = ("_row", "n", "start", "end", "low", "high")


def _in_text(value: Column) -> Column:
    """`value` over the symbols of one text in their order."""
    return value.over(Window.partitionBy("_row").orderBy("start"))


def _named(symbols: DataFrame, *parts: str) -> DataFrame:
    """`symbols` with `name`, the number of their parts among all different parts of the corpus."""
    symbols = store(symbols, "symbols")
    numbers = with_pos(store(symbols.select(*parts).distinct(), "parts"), parts, pos="name")
    named = symbols.join(store(numbers, "names"), list(parts)).select(*_SPANS, "name")
    return named


def _low_before() -> Column:
    """Where the neighbour's deciding span starts; a text's edge lies outside of every window."""
    return F.coalesce(_in_text(F.lag("low")), F.lit(-1))


def _high_after() -> Column:
    return F.coalesce(_in_text(F.lead("high")), F.col("n") + 1)


def _runs(symbols: DataFrame) -> DataFrame:
    """One row for each maximal run of one name; knowing a run's ends takes both neighbours."""
    first = F.coalesce(_in_text(F.lag("name")) != F.col("name"), F.lit(True)).cast("int")
    marked = symbols.withColumns({"first": first, "below": _low_before(), "above": _high_after()})
    numbered = marked.withColumn("run", _in_text(F.sum("first")))
    return numbered.groupBy("_row", "run").agg(
        F.min("n").alias("n"), F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("below", "start").alias("low"),
        F.max_by("above", "start").alias("high"), F.min("name").alias("one"), F.count("*").alias("other"),
    )


def _pairs(symbols: DataFrame, round_: int) -> DataFrame:
    """One row for each left name followed by a right name, and for each that stays single."""
    right = F.shiftrightunsigned(F.xxhash64("name", F.lit(round_)), 63) == 1
    sided = symbols.withColumn("right", right)
    opens = ~F.col("right") & F.coalesce(_in_text(F.lead("right")), F.lit(False))
    after = {f"next_{c}": _in_text(F.lead(c)) for c in ("end", "high", "name")}
    marked = sided.withColumns({"opens": opens, "below": _low_before(), "above": _high_after(), **after})
    closed = F.coalesce(_in_text(F.lag("opens")), F.lit(False))
    kept = marked.withColumn("closed", closed).where("NOT closed")
    low = F.when(~F.col("opens") & F.col("right"), F.col("below")).otherwise(F.col("low"))
    high = F.when(F.col("opens"), F.col("next_high")).when(F.col("right"), F.col("high")).otherwise(F.col("above"))
    return kept.select(
        "_row", "n", "start", F.when(F.col("opens"), F.col("next_end")).otherwise(F.col("end")).alias("end"),
        low.alias("low"), high.alias("high"), F.col("name").alias("one"),
        F.when(F.col("opens"), F.col("next_name")).otherwise(F.lit(-1)).alias("other"),
    )


def global_symbols(texts: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(_row, symbols): every text's symbols after all rounds, in order; positions are word numbers in the text."""
    words = texts.select("_row", word_array(F.col("text")).alias("words"))
    each = words.select("_row", F.size("words").alias("n"), F.posexplode("words").alias("start", "word"))
    end = F.col("start") + 1
    symbols = _named(each.select("_row", "n", "start", end.alias("end"), F.col("start").alias("low"), end.alias("high"), "word"), "word")
    symbols = _named(_runs(symbols), "one", "other")
    for round_ in range(rounds):
        symbols = _named(_pairs(symbols, round_), "one", "other")
        release(texts.sparkSession)
    fields = F.struct("start", "end", "low", "high", "name")
    return symbols.groupBy("_row").agg(F.sort_array(F.collect_list(fields)).alias("symbols"))
