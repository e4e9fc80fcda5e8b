"""Many positional edits in one pass.

A script of edits is composed on the driver into a table of runs: consecutive rows of the sequence, or of an
inserted batch, that land side by side, forwards or backwards. An edit cuts at most two runs, so the table grows with
the script and not with the data. Every row then meets its run once, by an equi-join on buckets of positions; a scan
and a shift, whatever the number of edits.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.operators.positions import dense
from seqloom.selectors import POS

#: Rows of the table of runs that are sent to every executor; a longer table is shuffled.
MOST_SENT = 1 << 16


@dataclass(frozen=True)
class Insert:
    """Insert the rows of `batch` one after the other, each at `index` (as `positions.insert_at`)."""

    index: int
    batch: DataFrame


@dataclass(frozen=True)
class Append:
    batch: DataFrame


@dataclass(frozen=True)
class RemoveAt:
    """Drop the row at `index`; negative counts from the end; out of range changes nothing, or raises when strict."""

    index: int
    strict: bool = False


@dataclass(frozen=True)
class RemoveRange:
    """Drop positions start..end, both included; `end` defaults to the last position."""

    start: int = 0
    end: int | None = None


@dataclass(frozen=True)
class Reverse:
    pass


Edit = Insert | Append | RemoveAt | RemoveRange | Reverse


@dataclass(frozen=True)
class Run:
    """`length` rows of a source from `start` on; backwards, they land last row first."""

    source: int
    start: int
    length: int
    backwards: bool = False

    def cut(self, at: int) -> tuple[Run, Run]:
        """The first `at` rows as they land, and the rest."""
        rest = self.length - at
        if self.backwards:
            return Run(self.source, self.start + rest, at, True), Run(self.source, self.start, rest, True)
        return Run(self.source, self.start, at), Run(self.source, self.start + at, rest)

    def turned(self) -> Run:
        return Run(self.source, self.start, self.length, not self.backwards)


class Runs:
    """The sequence as it stands after some edits."""

    def __init__(self, length: int):
        self.runs = [Run(0, 0, length)] if length else []
        self.length = length

    def _cut_at(self, position: int) -> int:
        """Make a run begin at `position`; its place in the table."""
        ends = list(accumulate(r.length for r in self.runs))
        place = bisect_right(ends, position)
        before = ends[place - 1] if place else 0
        if place < len(self.runs) and before < position:
            self.runs[place : place + 1] = self.runs[place].cut(position - before)
            place += 1
        return place

    def insert(self, index: int, source: int, count: int) -> None:
        """Row by row at `index`: later rows land before earlier ones, but in order where the index is clamped."""
        if index >= 0:
            at, clamped = min(index, self.length), min(max(index - self.length, 0), count)
            new = [Run(source, 0, clamped), Run(source, clamped, count - clamped, True)]
        else:
            at, clamped = max(0, self.length + index), min(max(-index - self.length, 0), count)
            new = [Run(source, clamped, count - clamped), Run(source, 0, clamped, True)]
        place = self._cut_at(at)
        self.runs[place:place] = [r for r in new if r.length]
        self.length += count

    def append(self, source: int, count: int) -> None:
        if count:
            self.runs.append(Run(source, 0, count))
        self.length += count

    def remove(self, first: int, last: int) -> None:
        """Drop the positions first..last as far as they exist."""
        first, last = max(first, 0), min(last, self.length - 1)
        if first <= last:
            low = self._cut_at(first)
            del self.runs[low : self._cut_at(last + 1)]
            self.length -= last - first + 1

    def reverse(self) -> None:
        self.runs = [r.turned() for r in reversed(self.runs)]


def composed(length: int, edits: list[Edit], sizes: list[int]) -> Runs:
    """The table of runs after all edits; source 0 is the sequence, each batch the next number."""
    runs, source = Runs(length), 0
    for edit in edits:
        if isinstance(edit, (Insert, Append)):
            source += 1
            if isinstance(edit, Insert):
                runs.insert(edit.index, source, sizes[source - 1])
            else:
                runs.append(source, sizes[source - 1])
        elif isinstance(edit, RemoveAt):
            at = edit.index if edit.index >= 0 else runs.length + edit.index
            if edit.strict and not 0 <= at < runs.length:
                raise IndexError(edit.index)
            runs.remove(at, at)
        elif isinstance(edit, RemoveRange):
            runs.remove(edit.start, runs.length - 1 if edit.end is None else edit.end)
        else:
            runs.reverse()
    return runs


def edit_script(df: DataFrame, edits: list[Edit]) -> DataFrame:
    """The sequence after all edits, one after the other, each on what the ones before it left.

    `df` and the batches have the same columns. One job counts each source (no column is read); the result is one
    scan of each.
    """
    df = dense(df)
    batches = [dense(e.batch) for e in edits if isinstance(e, (Insert, Append))]
    runs = composed(df.count(), edits, [b.count() for b in batches])
    starts = [0, *accumulate(r.length for r in runs.runs)]
    made = None
    for number, source in enumerate([df, *batches]):
        own = [(r, to) for r, to in zip(runs.runs, starts, strict=False) if r.source == number]
        moved = _moved(source, own)
        made = moved if made is None else made.unionByName(moved)
    return made


def _moved(df: DataFrame, runs: list[tuple[Run, int]]) -> DataFrame:
    """The rows of one source that are in a run, at their new positions."""
    if not runs:
        return df.limit(0)
    top = max(r.start + r.length for r, _ in runs)
    width = max(1, -(-top // (2 * len(runs))))
    table = _run_table(df.sparkSession, runs, width)
    if 3 * len(runs) <= MOST_SENT:
        table = F.broadcast(table)
    met = df.withColumn("__at", F.expr(f"`{POS}` div {width}L")).join(table, "__at")
    away = F.col(POS) - F.col("__from")
    place = F.col("__to") + F.when(F.col("__back"), F.col("__n") - 1 - away).otherwise(away)
    return met.where((away >= 0) & (away < F.col("__n"))).withColumn(POS, place).select(*df.columns)


def _run_table(spark: SparkSession, runs: list[tuple[Run, int]], width: int) -> DataFrame:
    """Each run once for every bucket of positions that it touches: at most three rows a run on the whole."""
    rows = [(r.start, r.length, r.backwards, to) for r, to in runs]
    table = spark.createDataFrame(rows, "__from long, __n long, __back boolean, __to long")
    first, last = F.expr(f"__from div {width}L"), F.expr(f"(__from + __n - 1) div {width}L")
    return table.withColumn("__at", F.explode(F.sequence(first, last)))
