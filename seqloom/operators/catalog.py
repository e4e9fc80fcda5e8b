"""Joins of the catalog: series -> sample -> run -> file, and lookups beside it.

Every join is a plain equi-join without broadcast hints: Spark broadcasts a side only
when its size is known to be small and otherwise shuffles, splitting skewed partitions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.functions.accession import accession_kind
from seqloom.operators.positions import with_gaps
from seqloom.selectors import POS, Names, as_names


class MissingRecordError(LookupError):
    """A strict lookup found ids with no record."""


def explode_children(df: DataFrame, children: str, child: str) -> DataFrame:
    """One row per child of each record's nested list."""
    return df.withColumn(child, F.explode(children)).drop(children)


def expand_hierarchy(
    series: DataFrame,
    samples: DataFrame,
    runs: DataFrame,
    files: DataFrame | None = None,
    series_id: str = "gse_id",
    sample_id: str = "gsm_id",
    run_id: str = "run_id",
) -> DataFrame:
    """Follow parent ids down: series to samples to runs (to files); ids without a record drop out."""
    found = series.join(samples, series_id).join(runs, sample_id)
    return found if files is None else found.join(files, run_id)


def join_parent(children: DataFrame, parents: DataFrame, key: Names, name: str = "found") -> DataFrame:
    """Each child with its parent's columns; `found` is false where the parent is missing."""
    known = parents.withColumn(name, F.lit(True))
    joined = children.join(known, as_names(key), "left")
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def resolve_required(
    wanted: DataFrame, records: DataFrame, key: Names, name: str = "found", strict: bool = False
) -> DataFrame:
    """Each wanted id with its record; `found` is false where it has none (an error when strict)."""
    resolved = join_parent(wanted, records, key, name)
    if strict and not resolved.filter(~F.col(name)).isEmpty():
        raise MissingRecordError(as_names(key))
    return resolved


def bridge_ids(ids: DataFrame, bridge: DataFrame, columns: tuple[str, ...] = ("SRR", "GSM", "GSE")) -> DataFrame:
    """All bridge rows of each id, whichever of the three columns it names.

    The bridge is listed under each of its ids and met by an inner join, either side of which
    Spark can split or broadcast; ids that meet nothing come from an anti join, with nulls.
    `kind` is null for ids of no known kind.
    """
    key = ids.columns[0]
    listed = bridge.select(*columns, F.explode(F.array(*columns)).alias(key))
    tagged = ids.withColumn("kind", F.when(accession_kind(F.col(key)).isin(*columns), accession_kind(F.col(key))))
    known = tagged.filter("kind IS NOT NULL")
    met = known.join(listed, key).select(key, "kind", *columns)
    nothing = [F.lit(None).cast(bridge.schema[c].dataType).alias(c) for c in columns]
    missed = known.join(listed.select(key), key, "left_anti").unionByName(tagged.filter("kind IS NULL"))
    return met.unionByName(missed.select(key, "kind", *nothing))


def lookup_by_id_kind(ids: DataFrame, sections: dict[str, DataFrame], name: str = "found") -> DataFrame:
    """Find each id in the section its prefix names; `kind` is null for ids of no known kind.

    Every section has the same columns, the id first.
    """
    key = ids.columns[0]
    tables = [
        table.withColumnRenamed(table.columns[0], key).withColumn("kind", F.lit(kind))
        for kind, table in sections.items()
    ]
    records = reduce(DataFrame.unionByName, tables)
    tagged = ids.withColumn("kind", accession_kind(F.col(key)))
    return join_parent(tagged, records, [key, "kind"], name)


def reference_dim(
    df: DataFrame, dim: DataFrame, key: Names, value: str, strict: bool = False
) -> DataFrame:
    """Attach a dimension value; null when missing, or a failed job when strict."""
    joined = df.join(dim, as_names(key), "left")
    if not strict:
        return joined
    return joined.withColumn(value, F.coalesce(F.col(value), F.raise_error(F.lit(f"no reference for {key}"))))


def semi_members(df: DataFrame, members: DataFrame, key: Names) -> DataFrame:
    """Rows whose id is listed."""
    keys = as_names(key)
    return with_gaps(df.join(members.select(*keys), keys, "left_semi"))


def listed_ids(df: DataFrame, column: str, name: str = "id") -> DataFrame:
    """Ids of a comma-separated option column, one per row."""
    return df.select(F.explode(F.split(F.col(column), ",")).alias(name))


def listed_ranges(df: DataFrame, column: str, prefix: str = "GSM", chunk: int = 10_000, name: str = "id") -> DataFrame:
    """One row per id of the comma-separated ids and ranges, in `chunk`s, so that no array holds a whole range."""
    others = [c for c in df.columns if c != column]
    number = lambda item: F.replace(item, F.lit(prefix), F.lit("")).cast("long")
    items = df.select(*others, F.explode(F.split(F.col(column), ",")).alias("__item"))
    ends = F.split("__item", ":")
    ranges = items.filter(F.col("__item").contains(":")).select(
        *others, number(ends[0]).alias("__low"), number(F.element_at(ends, -1)).alias("__high")
    )
    steps = ranges.filter("__low <= __high").withColumn(
        "__from", F.explode(F.sequence(F.col("__low"), F.col("__high"), F.lit(chunk).cast("long")))
    )
    last = F.least(F.col("__from") + chunk - 1, F.col("__high"))
    numbers = steps.select(*others, F.explode(F.sequence(F.col("__from"), last)).alias("__n"))
    single = items.filter(~F.col("__item").contains(":")).select(*others, F.col("__item").alias(name))
    return single.unionByName(numbers.select(*others, F.concat(F.lit(prefix), F.col("__n").cast("string")).alias(name)))


def new_only(df: DataFrame, known: DataFrame, key: Names) -> DataFrame:
    """Rows whose id is not known yet."""
    keys = as_names(key)
    return with_gaps(df.join(known.select(*keys), keys, "left_anti"))


def nested_membership(
    df: DataFrame, key: str, children: str, members: DataFrame, child_key: str = "accession", name: str = "targets"
) -> DataFrame:
    """Keep the nested child records whose id is listed, in their order; none left gives [].

    The children are exploded and semi-joined, then collected into their own row again,
    so no list grows beyond the one it came from.
    """
    exploded = df.select(key, F.posexplode(children).alias("__place", "__child"))
    wanted = members.select(F.col(members.columns[0]).alias("__id"))
    kept = exploded.join(wanted, exploded["__child"][child_key] == wanted["__id"], "left_semi")
    lists = kept.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("__place", "__child"))).alias("__kept"))
    joined = df.join(lists, key, "left")
    targets = F.transform(F.coalesce(F.col("__kept"), F.array()), lambda e: e["__child"])
    return joined.withColumn(name, targets).drop("__kept")


def children_of(df: DataFrame, parent: str, value: object) -> DataFrame:
    """Samples of one series."""
    return with_gaps(df.filter(F.col(parent) == F.lit(value)))


def children_of_many(df: DataFrame, parent: str, parents: DataFrame) -> DataFrame:
    """Samples of each listed series."""
    return with_gaps(df.join(parents.select(F.col(parents.columns[0]).alias(parent)), parent, "left_semi"))


def replace_children(
    table: DataFrame, removed: DataFrame, posted: DataFrame, key: Names
) -> DataFrame:
    """Take the removed children out of the table and add the posted set, behind them if both have positions."""
    keys = as_names(key)
    kept = table.join(removed.select(*keys), keys, "left_anti")
    if POS in table.columns and POS in posted.columns:
        posted = posted.withColumn(POS, F.col(POS) + table.agg(F.coalesce(F.max(POS) + 1, F.lit(0))).scalar())
    return with_gaps(kept.unionByName(posted))


# --- pending work --------------------------------------------------------------------


def pending_dump(expected: DataFrame, present: DataFrame, key: Names) -> DataFrame:
    """Rows whose expected output is not in the listing."""
    return new_only(expected, present, key)


def pending_count(
    samples: DataFrame, present: DataFrame, finished: DataFrame, started: DataFrame, key: Names, name: str = "restart"
) -> DataFrame:
    """Samples with data but no finished result; `restart` marks those with a partial one."""
    keys = as_names(key)
    waiting = with_gaps(samples.join(present.select(*keys), keys, "left_semi").join(finished.select(*keys), keys, "left_anti"))
    partial = started.select(*keys).distinct().withColumn(name, F.lit(True))
    return waiting.join(partial, keys, "left").withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def pending_samples(df: DataFrame, finished: DataFrame, sample: Names) -> DataFrame:
    """Distinct samples that have no result."""
    keys = as_names(sample)
    return df.select(*keys).distinct().join(finished.select(*keys), keys, "left_anti")


def any_empty(children: DataFrame, present: DataFrame, group: Names, key: Names, name: str = "any_empty") -> DataFrame:
    """Per series: does any of its samples have no file?"""
    keys = as_names(key)
    have = present.select(*keys).distinct().withColumn("__have", F.lit(True))
    flagged = children.join(have, keys, "left")
    return flagged.groupBy(*as_names(group)).agg(F.bool_or(F.col("__have").isNull()).alias(name))


def pending_by_group(
    children: DataFrame, present: DataFrame, group: Names, key: Names, empty: str = "any_empty", pending: str = "pending"
) -> DataFrame:
    """Per series: does any sample lack its file, and how many do. One join and one aggregate."""
    keys = as_names(key)
    have = present.select(*keys).distinct().withColumn("__have", F.lit(True))
    missing = F.col("__have").isNull()
    return children.join(have, keys, "left").groupBy(*as_names(group)).agg(
        F.bool_or(missing).alias(empty), F.count_if(missing).alias(pending)
    )
