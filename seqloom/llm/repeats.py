"""Finding and removing windows of text that occur more than once in a corpus.

A window is `size` consecutive units (words or bytes) of one text. Every window has an *anchor* that
its content alone decides, so equal windows have equal anchors at equal distances. Consecutive windows
with one anchor occurrence form a *range*. The job is then:

1. Every range becomes a row (anchor name, hash of all units in the range). Names that occur once are
   dropped: their windows are unique.
2. Ranges that are equal as a whole prove all their windows repeated. Only where one name has several
   different ranges are single windows looked at, one representative for each different range.
3. `Kind.repeated` says which of those windows occur more than once.
4. Units under a repeated window are removed.

Rows per name are counted by partial aggregates and met by joins whose hot side Spark can split; a
document's marks return to it by its row number. Nothing is compared pair by pair.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from seqloom.llm import tokens as T
from seqloom.llm.shipping import map_arrow
from seqloom.llm.store import REST, number_rows, pack_rest, release, settled, store


@dataclass
class Ranges:
    """Consecutive windows [first, last] that share an anchor occurrence; `alike` if all are one content."""

    name: np.ndarray
    first: np.ndarray
    last: np.ndarray
    alike: np.ndarray

    def per_text(self, offsets: np.ndarray) -> np.ndarray:
        """Each text's range of ranges."""
        return np.searchsorted(self.first, offsets)


class Kind(ABC):
    """What a unit is, how windows get anchors, and how single windows are compared."""

    size: int
    #: Bytes of text that are worked on at once.
    block: int = T.BLOCK_BYTES
    #: Spark type of what a range hands on for the comparison of its windows.
    content: str

    @abstractmethod
    def units(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(a hash for each unit, offsets of the texts)."""

    @abstractmethod
    def ranges(self, units: np.ndarray, offsets: np.ndarray, part: pa.RecordBatch) -> Ranges:
        """All windows of all texts of a block, in order, each in exactly one range."""

    def prepared(self, texts: DataFrame) -> DataFrame:
        """(_row, text) with whatever else `ranges` needs of a row."""
        return texts

    @abstractmethod
    def contents(self, data, units, folded, first, last) -> pa.Array:
        """What the windows of each range are compared by."""

    @abstractmethod
    def repeated(self, open_ranges: DataFrame) -> DataFrame:
        """(_row, start, end): units under windows that occur more than once.

        `open_ranges` has (_row, name, start, weight, windows, variants, content).

        Only answers for ranges of weight 1 are needed; weight 2 stands for a range known to occur again.
        """

    @abstractmethod
    def keep(self, text: bytes, kept: np.ndarray) -> bytes | str:
        """The text of the units that stay."""


def window_starts(offsets: np.ndarray, size: int) -> np.ndarray:
    """The start of every window that lies in one text."""
    return T.ragged(offsets[:-1], np.maximum(np.diff(offsets) - size + 1, 0))


def _ranges_of(kind: Kind, part: pa.RecordBatch):
    data, at = T.texts(part.column("text"))
    units, offsets = kind.units(data, at)
    found = kind.ranges(units, offsets, part)
    return data, units, offsets, found


def occurrences(docs: DataFrame, kind: Kind) -> DataFrame:
    """(name, range_hash, weight, _row, no): one row per range of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.blocks(batch, "text", kind.block):
                _, units, offsets, r = _ranges_of(kind, part)
                folded = T.fold(units)
                whole = T.span_hash(folded, r.first, np.where(r.alike, r.first, r.last) + kind.size)
                per_text = r.per_text(offsets)
                text = T.owners(per_text)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r.name.view(np.int64)), pa.array(whole.view(np.int64)),
                     pa.array(np.where(r.alike, r.last - r.first + 1, 1).astype(np.int32)),
                     part.column("_row").take(pa.array(text)),
                     pa.array((np.arange(len(text)) - per_text[text]).astype(np.int32))],
                    ["name", "range_hash", "weight", "_row", "no"],
                )

    return map_arrow(docs, run, "name long, range_hash long, weight int, _row long, no int")


def range_marks(found: DataFrame) -> DataFrame:
    """(_row, marks): for each text the ranges that are repeated as a whole or must be looked at.

    Counts by name are stored before they are joined: Spark splits a hot side only where
    nothing stands between a join and its exchange.
    """
    counted = found.groupBy("name").agg(F.sum("weight").alias("n")).where("n > 1").select("name")
    names = store(counted, "names")
    release(names.sparkSession)
    shared = store(found.join(names, "name", "left_semi"), "ranges")
    release(shared.sparkSession)
    variants = shared.groupBy("name", "range_hash").agg(
        F.sum("weight").alias("n"), F.min(F.struct("_row", "no")).alias("first")
    )
    several = store(variants.groupBy("name").agg(F.count("*").alias("variants")), "several")
    known = variants.join(several, "name").where("n > 1 OR variants > 1")
    open_weight = (
        F.when(F.col("variants") == 1, 0)
        .when(F.col("n") == 1, 1)
        .when(F.col("first") == F.struct("_row", "no"), 2)
        .otherwise(0)
    )
    marked = shared.drop("weight").join(known, ["name", "range_hash"]).select(
        "_row", "no", (F.col("n") > 1).alias("whole"), open_weight.alias("open"), "variants"
    )
    return marked.where("whole OR open > 0").groupBy("_row").agg(
        F.collect_list(F.struct("no", "whole", "open", "variants")).alias("marks")
    )


def _covered(n: int, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of n units lie in any of the spans."""
    step = np.bincount(first, minlength=n + 1).astype(np.int64) - np.bincount(end, minlength=n + 1)
    return np.cumsum(step[:n]) > 0


def _spans(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, offsets) of the maximal true spans of each text, in the text's own positions."""
    before = np.zeros(len(mask), bool)
    before[1:] = mask[:-1]
    before[offsets[:-1][offsets[:-1] < len(mask)]] = False
    after = np.zeros(len(mask), bool)
    after[:-1] = mask[1:]
    closing = offsets[1:][(offsets[1:] > 0)] - 1
    after[closing] = False
    start, end = np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1
    per_text = np.searchsorted(start, offsets)
    base = offsets[:-1][T.owners(per_text)]
    return start - base, end - base, per_text


def _first_pass(docs: DataFrame, marks: DataFrame, kind: Kind) -> DataFrame:
    """(_row, _starts, _ends, _pending, _open) of texts with marks: spans known to go, ranges whose windows are still open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.blocks(batch, "text", kind.block):
                data, units, offsets, r = _ranges_of(kind, part)
                marks = part.column("marks")
                per_text = r.per_text(offsets)
                count = np.array([0 if x is None else x for x in _lengths(marks)], np.int64)
                flat = marks.flatten()
                text = np.repeat(np.arange(len(count)), count)
                at = per_text[text] + flat.field("no").to_numpy(zero_copy_only=False)
                whole = flat.field("whole").to_numpy(zero_copy_only=False).astype(bool)
                weight = flat.field("open").to_numpy(zero_copy_only=False)
                gone = _covered(len(units), r.first[at[whole]], r.last[at[whole]] + kind.size)
                looked = weight > 0
                # an open range that is gone as a whole needs no answer, but others may need its windows
                inside = np.concatenate([[0], np.cumsum(~gone)])
                left = inside[r.last[at] + kind.size] - inside[r.first[at]] > 0
                o = at[looked]
                starts, ends, per_span = _spans(gone, offsets)
                per_open = np.concatenate([[0], np.cumsum(np.bincount(text[looked], minlength=len(count)))])
                pending = np.bincount(text, looked & left & (weight == 1), len(count)) > 0
                variants = flat.field("variants").to_numpy(zero_copy_only=False)[looked]
                opened = pa.StructArray.from_arrays(
                    [pa.array(r.name[o].view(np.int64)), pa.array((r.first[o] - offsets[text[looked]]).astype(np.int32)),
                     pa.array(np.where(left[looked], weight[looked], 2).astype(np.int32)),
                     pa.array((r.last[o] - r.first[o] + 1).astype(np.int32)), pa.array(variants.astype(np.int64)),
                     kind.contents(data, units, T.fold(units), r.first[o], r.last[o])],
                    ["name", "start", "weight", "windows", "variants", "content"],
                )
                order = np.argsort(text[looked], kind="stable")
                yield pa.RecordBatch.from_arrays(
                    [part.column("_row"), T.list_array(starts, per_span, pa.int32()), T.list_array(ends, per_span, pa.int32()),
                     pa.array(pending), pa.ListArray.from_arrays(pa.array(per_open.astype(np.int32)), opened.take(pa.array(order)))],
                    ["_row", "_starts", "_ends", "_pending", "_open"],
                )

    opened = f"struct<name:bigint,start:int,weight:int,windows:int,variants:bigint,content:{kind.content}>"
    made = f"_row long, _starts array<int>, _ends array<int>, _pending boolean, _open array<{opened}>"
    # marks and spans grow with the corpus, and compressed files hide how much: neither is broadcast
    return map_arrow(docs.join(marks.hint("merge"), "_row"), run, made)


def _lengths(lists: pa.Array):
    import pyarrow.compute as pc

    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)


def _second_pass(frame: DataFrame, columns: list[str], kind: Kind, kept_type: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.blocks(batch, "text", kind.block):
                data, at = T.texts(part.column("text"))
                _, offsets = kind.units(data, at)
                n = np.diff(offsets)

                def spans(starts, ends, n=n, part=part, offsets=offsets):
                    base = np.repeat(offsets[:-1], _lengths(part.column(starts)))
                    both = (part.column(c).flatten().to_numpy(zero_copy_only=False) for c in (starts, ends))
                    return [x.astype(np.int64) + base for x in both]

                (s1, e1), (s2, e2) = spans("_starts", "_ends"), spans("_more_starts", "_more_ends")
                gone = _covered(int(offsets[-1]), np.concatenate([s1, s2]), np.concatenate([e1, e2]))
                _, _, per_span = _spans(gone, offsets)
                total = np.concatenate([[0], np.cumsum(gone)])
                removed = total[offsets[1:]] - total[offsets[:-1]]
                raw = data.tobytes()
                kept = [
                    kind.keep(raw[a:b], ~gone[u:v])
                    for a, b, u, v in zip(at[:-1].tolist(), at[1:].tolist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in columns]
                    + [pa.array(n.astype(np.int64)), pa.array(removed.astype(np.int64)),
                       pa.array(np.diff(per_span).astype(np.int64)),
                       pa.array(kept, pa.binary() if kept_type == "binary" else pa.string())],
                    [*columns, "_n_units", "_n_removed", "_n_spans", "_kept"],
                )

    made = S.StructType.fromDDL(f"_n_units long, _n_removed long, _n_spans long, _kept {kept_type}")
    return map_arrow(frame, run, S.StructType([*[frame.schema[c] for c in columns], *made.fields]))


def remove_repeats(docs: DataFrame, kind: Kind, kept_type: str) -> DataFrame:
    """(`__rest`, text, `_n_units`, `_n_removed`, `_n_spans`, `_kept`) of every row of `docs`.

    The struct holds all columns but the text. `docs` should be a stored Parquet table: it is read several times, and
    rows are told apart by their file and place in it (`number_rows`). Only what is known of a row is stored on the
    way, never a second copy of its text.
    """
    numbered = number_rows(pack_rest(docs, "text"))
    spans = settled(docs.sparkSession, "spans", lambda: _removed_spans(numbered.select("_row", "text"), kind))
    return _second_pass(numbered.join(spans.hint("merge"), "_row", "left"), [REST, "text"], kind, kept_type)


def _removed_spans(texts: DataFrame, kind: Kind) -> DataFrame:
    """(_row, _starts, _ends, _more_starts, _more_ends) of every text that loses anything."""
    texts = kind.prepared(texts)
    marks = store(range_marks(occurrences(texts, kind)), "marks")
    release(texts.sparkSession)
    first = store(_first_pass(texts, marks, kind), "first")
    release(texts.sparkSession)
    opened = first.where(F.size("_open") > 0).select("_row", F.inline("_open"))
    more = kind.repeated(opened).groupBy("_row").agg(F.collect_list(F.struct("start", "end")).alias("_more"))
    none = F.array().cast("array<int>")
    known = ["_row", "_starts", "_ends"]
    done = first.where("NOT _pending").select(*known, none.alias("_more_starts"), none.alias("_more_ends"))
    rest = first.where("_pending").join(more, "_row", "left").select(
        *known,
        F.coalesce(F.col("_more")["start"], none).alias("_more_starts"),
        F.coalesce(F.col("_more")["end"], none).alias("_more_ends"),
    )
    return done.unionByName(rest).where((F.size("_starts") > 0) | (F.size("_more_starts") > 0))
