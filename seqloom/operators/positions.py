"""Dense 0-based positions, and edits expressed as arithmetic on them.

Frames have no order, so a sequence carries a `_pos` column. Numbering never sends a
whole sequence, or a whole large group, through one task: rows are cut into bounded
buckets that follow the order, counted per bucket, and numbered inside their bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.operators.splitters import BUCKET_ROWS, INTEGRAL, IrregularKeysError, binary_key, splitters
from seqloom.selectors import POS, Names, Selector, as_names, grouped, if_true, join_on_keys, same, total
from seqloom.staging import stage

# A collected cell is closed after this many bytes.
PART_BYTES = 64 << 20
# Positions per bucket when group facts are attached to rows that are already numbered.
POSITIONS_PER_BUCKET = 1 << 17

_BUCKET, _FACT, _TAG, _RANK, _WEIGHT = "__bucket", "__fact", "__tag", "__rank", "__weight"


def with_pos(
    df: DataFrame,
    order: Names,
    by: Names = None,
    pos: str = POS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Add the 0-based position of each row in `order`, over the frame or inside each group.

    `order` must be unique within the frame (or group); add a tie-break column otherwise; nulls come first.
    Rows are cut into buckets that rise with the order and are numbered inside (group, bucket), which holds at
    most 2 x `bucket_rows` rows however the keys are spread: one group holding a third of the rows is spread like
    any other. An integer column is cut by its values, also as the first of several if few rows share one of them; other
    columns by bytes that sort as they do. Only an order
    without such a form (nested types, wide decimals), or keys too irregular for literal splitters,
    takes a range sort, written once.
    """
    keys, columns = as_names(by), as_names(order)
    bucketed = _bucketed(df, keys, columns, bucket_rows)
    return _number_by_sort(df, keys, columns, pos) if bucketed is None else _number_in_buckets(bucketed, keys, columns, pos)


def with_gaps(df: DataFrame) -> DataFrame:
    """Note on `_pos` that rows were taken out, so that positional operators renumber first."""
    return df.withMetadata(POS, {"gaps": True}) if POS in df.columns else df


def dense(df: DataFrame, by: Names = None) -> DataFrame:
    """The sequence with positions 0, 1, 2, ...: renumbered only where an operator has noted gaps."""
    return compact(df, by) if df.schema[POS].metadata.get("gaps") else df


def compact(df: DataFrame, by: Names = None) -> DataFrame:
    """Close the gaps that filters and merges leave in `_pos`."""
    old = df.withColumn("__old", F.col(POS)).drop(POS)
    return with_pos(old, "__old", by).drop("__old").select(*df.columns)


def _bucketed(df: DataFrame, by: list[str], order: list[str], bucket_rows: int) -> DataFrame | None:
    """Each row's bucket, which rises with the order; None where literal splitters cannot tell.

    The key is read now, by `splitters`; the bounds are then literals, so every execution agrees. Of several columns the
    first one alone serves if it is an integer and no value of it is in too many rows: it costs far less than bytes of all.
    """
    first = F.col(f"`{order[0]}`")
    if isinstance(df.schema[order[0]].dataType, INTEGRAL):
        try:
            found = splitters(df, first, True, by, bucket_rows, ties=len(order) > 1)
        except IrregularKeysError:
            found = None
        if found is not None or len(order) == 1:
            return None if found is None else found.apply(df, first, _BUCKET)
    key = binary_key(df, order)
    if key is None:
        return None
    try:
        return splitters(df, key, False, by, bucket_rows).apply(df, key, _BUCKET)
    except IrregularKeysError:
        return None


def _number_in_buckets(
    df: DataFrame, by: list[str], order: list[str], pos: str, weight: Column | None = None
) -> DataFrame:
    """Number rows inside (group, bucket) and add the rows of the buckets before; or add up `weight` instead."""
    weighted = df if weight is None else df.withColumn(_WEIGHT, weight.cast("long"))
    amount = F.count(F.lit(1)) if weight is None else F.sum(_WEIGHT)
    counts = weighted.groupBy(*by, _BUCKET).agg(amount.alias("__n"))
    earlier = Window.partitionBy(*by).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*by, _BUCKET, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias(_FACT))
    ranked = _with_bucket_fact(weighted, starts, by, order, rank=True, weight=None if weight is None else _WEIGHT)
    return ranked.withColumn(pos, F.col(_FACT) + F.col(_RANK)).drop(_BUCKET, _FACT, _RANK, _WEIGHT)


def _with_bucket_fact(
    df: DataFrame, facts: DataFrame, by: list[str], order: list[str], rank: bool = False, weight: str | None = None
) -> DataFrame:
    """Attach the fact of its (group, bucket) to every row, and the rows (or weight) before it in the bucket.

    The fact arrives as one marker row that sorts ahead of the bucket's data rows, so one
    shuffle and one sort do the work of a join, and null group keys match. With groups the
    shuffle is asked for by name: input already partitioned by group would otherwise be
    left so, with a large group in one task. `df` is read twice (facts, rows), so it must
    give the same rows each time.
    """
    rows = df.withColumns({_FACT: F.lit(None).cast("long"), _TAG: F.lit(1)})
    both = rows.unionByName(facts.withColumn(_TAG, F.lit(0)), allowMissingColumns=True)
    if by:
        both = both.repartition(*by, _BUCKET)
    window = Window.partitionBy(*by, _BUCKET).orderBy(_TAG, *order)
    running = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    columns = {"__fact_of_bucket": F.first(_FACT).over(running)}
    if rank:
        before = window.rowsBetween(Window.unboundedPreceding, -1)
        ahead = F.row_number().over(window).cast("long") - 2 if weight is None else F.sum(weight).over(before)
        columns[_RANK] = F.coalesce(ahead, F.lit(0))
    return (
        both.withColumns(columns)
        .filter(F.col(_TAG) == 1)
        .withColumn(_FACT, F.col("__fact_of_bucket"))
        .drop(_TAG, "__fact_of_bucket")
    )


def running_total(
    df: DataFrame, order: Names, amount: Column, by: Names = None, name: str = "before", bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """Add the sum of `amount` (a whole number) over the rows before each row in `order`, which must be unique."""
    keys, columns = as_names(by), as_names(order)
    bucketed = _bucketed(df, keys, columns, bucket_rows)
    if bucketed is None:
        ordered = with_pos(df, columns, keys, "__place", bucket_rows)
        return running_total(ordered, "__place", amount, keys, name, bucket_rows).drop("__place")
    return _number_in_buckets(bucketed, keys, columns, name, amount)


def _number_by_sort(df: DataFrame, by: list[str], order: list[str], pos: str) -> DataFrame:
    """Any order: range-partition and sort, write the partition and row numbers, add offsets.

    The sorted rows are written because range bounds are sampled anew by each execution;
    the file holds the one order that both the counts and the result must agree on.
    """
    keys = [*by, *order]
    ordered = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn(_BUCKET, F.spark_partition_id().cast("long"))
        .withColumn("__row", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    staged = stage(ordered, "sorted")
    if by:
        return _number_in_buckets(staged, by, ["__row"], pos).drop("__row")
    earlier = Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    counts = staged.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("__n"))
    starts = counts.select(_BUCKET, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias(_FACT))
    # One row per sort partition, so never more rows than spark.sql.shuffle.partitions.
    return (
        staged.join(F.broadcast(starts), _BUCKET)
        .withColumn(pos, F.col(_FACT) + F.col("__row"))
        .drop(_BUCKET, _FACT, "__row")
    )


def with_size(df: DataFrame, by: Names, name: str) -> DataFrame:
    """Attach the row count of the frame, or of each row's group, to numbered rows.

    Groups are spread over buckets of positions, so a large group stays spread.
    """
    keys = as_names(by)
    if not keys:
        return df.withColumn(name, total(df))
    bucketed = df.withColumn(_BUCKET, F.expr(f"`{POS}` div {POSITIONS_PER_BUCKET}L"))
    counts = bucketed.groupBy(*keys, _BUCKET).agg(F.count(F.lit(1)).alias("__n"))
    sizes = counts.select(*keys, _BUCKET, F.sum("__n").over(Window.partitionBy(*keys)).alias(_FACT))
    return _with_bucket_fact(bucketed, sizes, keys, [POS]).withColumnRenamed(_FACT, name).drop(_BUCKET)


def ordered_parts(
    df: DataFrame, by: Names, part_rows: int, size: Column | None = None, name: str = "part", bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """Number bounded runs of consecutive rows, so that a group of any size can be collected.

    A row counts as one unit for every `PART_BYTES / part_rows` bytes of `size` it begins,
    one at least, and `part_rows` units close a part: no part holds more rows or, but for
    its last row, more bytes. Parts rise from 0 in order; a group within both is part 0
    alone. Units are summed per group first (now, one job), and only groups past one part are numbered.
    """
    keys = as_names(by)
    each = max(1, PART_BYTES // part_rows)
    units = F.lit(1) if size is None else F.greatest(F.lit(1), F.ceil(F.coalesce(size, F.lit(0)) / each))
    sizes = grouped(df.withColumn(_WEIGHT, units), keys, F.sum(_WEIGHT).alias("__units")).where(F.col("__units") > part_rows)
    if sizes.isEmpty():  # every group is one part: nothing to number
        return df.withColumn(name, F.lit(0).cast("long"))
    if keys:
        large, small = join_on_keys(df, sizes, keys, "left_semi"), join_on_keys(df, sizes, keys, "left_anti")
    else:
        large, small = df, df.limit(0)
    cumulated = _number_in_buckets(_bucketed(large, keys, [POS], bucket_rows), keys, [POS], "__before", units)
    parts = cumulated.withColumn(name, F.expr(f"__before div {part_rows}L")).drop("__before")
    return parts.unionByName(small.withColumn(name, F.lit(0).cast("long")))


# --- reading by position -------------------------------------------------------------


def element_at(df: DataFrame, index: int, by: Names = None) -> DataFrame:
    """The row at `index`; no row when out of range; negative counts from the end."""
    df = dense(df, by)
    if index >= 0:
        return df.filter(F.col(POS) == index)
    sized = with_size(df, by, "__size")
    return sized.filter(F.col(POS) == F.col("__size") + index).drop("__size")


def index_of(
    df: DataFrame,
    column: str,
    value: object,
    start: int = 0,
    end: int | None = None,
    by: Names = None,
    last: bool = False,
    name: str = "index",
) -> DataFrame:
    """Position of the first (or last) row equal to `value` in [start, end); -1 if absent."""
    df = dense(df, by)
    hit = same(F.col(column), value) & (F.col(POS) >= start)
    if end is not None:
        hit = hit & (F.col(POS) < end)
    pick = F.max if last else F.min
    return grouped(df, by, F.coalesce(pick(F.when(hit, F.col(POS))), F.lit(-1)).cast("long").alias(name))


def index_of_on(df: DataFrame, predicate: Selector, by: Names = None, name: str = "index") -> DataFrame:
    """Position of the last row that satisfies the predicate; -1 if none does."""
    df = dense(df, by)
    hit = if_true(df, predicate)
    return grouped(df, by, F.coalesce(F.max(F.when(hit, F.col(POS))), F.lit(-1)).cast("long").alias(name))


def last_index_of(
    df: DataFrame,
    column: str,
    value: object,
    start: int = 0,
    end: int | None = None,
    by: Names = None,
    name: str = "index",
) -> DataFrame:
    """Offset from the back of the last row equal to `value`; -1 if absent.

    `start` and `end` count from the back, as the result does.
    """
    df = dense(df, by)
    keys, equal = as_names(by), same(F.col(column), value)
    if start == 0 and end is None:
        back = F.count(F.lit(1)) - 1 - F.max(F.when(equal, F.col(POS)))
        return grouped(df, keys, F.coalesce(back, F.lit(-1)).cast("long").alias(name))
    sized = with_size(df, keys, "__size")
    offset = F.col("__size") - 1 - F.col(POS)
    hit = equal & (offset >= start)
    if end is not None:
        hit = hit & (offset < end)
    return grouped(sized, keys, F.coalesce(F.min(F.when(hit, offset)), F.lit(-1)).cast("long").alias(name))


# --- edits ---------------------------------------------------------------------------


def insert_at(df: DataFrame, index: int, batch: DataFrame) -> DataFrame:
    """Insert the rows of `batch` one after the other, each at `index`.

    The rows end up side by side. Inside the sequence each lands before the one inserted
    earlier, so they come out reversed; counted from the end they keep their order. Where
    the index lies outside, rows are clamped to the edge until the sequence is long enough.
    """
    df, batch = dense(df), dense(batch)
    size, added, nth = total(df), total(batch), F.col(POS)
    reversed_place = added - 1 - nth
    if index >= 0:
        start, clamped = F.least(F.lit(index), size), F.greatest(F.lit(index) - size, F.lit(0))
        place = F.when(nth < clamped, nth).otherwise(clamped + reversed_place)
    else:
        start, clamped = F.greatest(F.lit(0), size + index), F.greatest(F.lit(-index) - size, F.lit(0))
        place = F.when(nth < clamped, reversed_place).otherwise(nth - clamped)
    shifted = df.withColumn(POS, F.col(POS) + F.when(F.col(POS) >= start, added).otherwise(F.lit(0)))
    return shifted.unionByName(batch.withColumn(POS, start + place))


def remove_at(df: DataFrame, index: int, strict: bool = False) -> DataFrame:
    """Drop the row at `index` (negative counts from the end); later rows move up.

    An index out of range changes nothing, or raises when strict.
    """
    df = dense(df)
    if strict and element_at(df, index).isEmpty():
        raise IndexError(index)
    at = F.lit(index) if index >= 0 else total(df) + index
    kept = df.filter(F.col(POS) != at)
    in_range = (F.col(POS) > at) & (at >= 0)
    return kept.withColumn(POS, F.col(POS) - F.when(in_range, 1).otherwise(0))


def remove_range(df: DataFrame, start: int = 0, end: int | None = None) -> DataFrame:
    """Drop positions start..end, both included; `end` defaults to the last position."""
    df, start = dense(df), max(start, 0)
    if end is None:
        return df.filter(F.col(POS) < start)
    width = max(end - start + 1, 0)
    kept = df.filter(~F.col(POS).between(start, end))
    return kept.withColumn(POS, F.col(POS) - F.when(F.col(POS) > end, width).otherwise(0))


def reverse(df: DataFrame, by: Names = None) -> DataFrame:
    """Reverse the sequence by renumbering; a sequence without gaps is not sorted."""
    df = dense(df, by)
    if not as_names(by):
        return df.withColumn(POS, total(df) - 1 - F.col(POS))
    return with_size(df, by, "__size").withColumn(POS, F.col("__size") - 1 - F.col(POS)).drop("__size")


# --- cutting work --------------------------------------------------------------------


def balanced_split(df: DataFrame, k: int, by: Names = None, name: str = "chunk") -> DataFrame:
    """Cut the sequence into k contiguous chunks whose sizes differ by at most one.

    Same numbers as `ntile(k) - 1`, without bringing the sequence to one task.
    """
    sized = with_size(dense(df, by), by, "__size").withColumns(
        {"__q": F.expr(f"__size div {k}L"), "__big": F.expr(f"(__size % {k}L) * (__size div {k}L + 1)")}
    )
    chunk = F.expr(
        f"""CASE WHEN {POS} < __big THEN {POS} div (__q + 1)
            ELSE __size % {k}L + ({POS} - __big) div greatest(__q, 1L) END"""
    )
    return sized.withColumn(name, chunk).drop("__size", "__q", "__big")


def fixed_chunks(df: DataFrame, k: int, by: Names = None, name: str = "chunk") -> DataFrame:
    """Cut into chunks of ceil(n / k) rows; the last takes the rest."""
    sized = with_size(dense(df, by), by, "__size")
    chunk = F.expr(f"{POS} div ((__size + least({k}L, __size) - 1) div least({k}L, __size))")
    return sized.withColumn(name, chunk).drop("__size")


def replicate_index(df: DataFrame, sample: Names, order: Names, name: str = "replicate") -> DataFrame:
    """0-based index of each row inside its sample."""
    return with_pos(df, order, sample, pos=name)


def tag_of(index: Column) -> Column:
    """`S1`, `S2`, ... for replicate indexes 0, 1, ..."""
    return F.concat(F.lit("S"), (index + 1).cast("string"))


def first_by_key(df: DataFrame, key: Names, order: Names = POS) -> DataFrame:
    """Keep each key's earliest row. A map-side group limit keeps hot keys small."""
    window = Window.partitionBy(*as_names(key)).orderBy(*as_names(order))
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK).transform(with_gaps)


def keep_last_by_key(df: DataFrame, key: Names, order: Names = POS) -> DataFrame:
    """Keep each key's latest row."""
    window = Window.partitionBy(*as_names(key)).orderBy(*[F.col(c).desc() for c in as_names(order)])
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK).transform(with_gaps)


def occurrence(df: DataFrame, column: str, name: str) -> DataFrame:
    """0-based count of equal values earlier in the sequence."""
    return with_pos(df, POS, column, pos=name)
