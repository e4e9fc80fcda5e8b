"""Accession ids and labels, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three id prefixes, the record page of a series.
KINDS = ("GSE", "GSM", "SRR")
SERIES_PAGE = "https://www.ncbi.nlm.nih.gov/geo/query/acc.cgi?acc="


def accession_kind(accession: Column) -> Column:
    """GSE, GSM or SRR by prefix; null for anything else."""
    kind = F.lit(None).cast("string")
    for prefix in KINDS:
        kind = F.when(accession.startswith(prefix), F.lit(prefix)).otherwise(kind)
    return kind


def expand_accession_ranges(text: Column, prefix: str = "GSM") -> Column:
    """`GSM1:GSM3,GSM9` -> [GSM1, GSM2, GSM3, GSM9]; both ends belong to the range.

    The whole list is one value; `catalog.listed_ranges` gives a row per id for ranges of any length.
    """

    def number(item: Column) -> Column:
        return F.replace(item, F.lit(prefix), F.lit("")).cast("long")

    def expand(item: Column) -> Column:
        ends = F.split(item, ":")
        low, high = number(ends[0]), number(F.element_at(ends, -1))
        ids = F.transform(F.sequence(low, F.greatest(low, high)), lambda n: F.concat(F.lit(prefix), n.cast("string")))
        empty = F.array().cast("array<string>")
        return F.when(~item.contains(":"), F.array(item)).when(low > high, empty).otherwise(ids)

    return F.flatten(F.transform(F.split(text, ","), expand))


def split_taxon(text: Column) -> Column:
    """`A; B` -> [A, B]."""
    return F.split(text, "; ")


# `sample: title; species; protocol (run)`
HEADING = r"^([^:;]+):[^;]*;([^;]+);[^;(]*\(([^;()]+)\)"


def _heading_part(heading: Column, group: int) -> Column:
    """One named part of a well-formed heading; null for any other text."""
    return F.nullif(F.regexp_extract(heading, HEADING, group), F.lit(""))


def heading_sample(heading: Column) -> Column:
    return _heading_part(heading, 1)


def heading_species(heading: Column) -> Column:
    """The species without spaces."""
    return F.replace(_heading_part(heading, 2), F.lit(" "), F.lit(""))


def heading_run(heading: Column) -> Column:
    return _heading_part(heading, 3)


def series_link(accession: Column) -> Column:
    return F.concat(F.lit(SERIES_PAGE), accession)


def child_label(accession: Column, title: Column) -> Column:
    """`accession(title)`."""
    return F.concat(accession, F.lit("("), title, F.lit(")"))


def label_accession(label: Column) -> Column:
    """Back from a label to the id."""
    return F.split_part(label, F.lit("("), F.lit(1))
