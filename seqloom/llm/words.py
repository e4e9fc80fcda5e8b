"""Words are runs of anything but the six ASCII spaces, in every operator here."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def word_array(text: Column) -> Column:
    """The words of a text, in order; none for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP))


def word_count(text: Column) -> Column:
    """The number of words as a long, without building them; 0 for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, GAP))).cast("long")


def bound(value: Column, use) -> Column:
    """`use(value)` with the value computed once per row: a lambda variable is never inlined again."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
