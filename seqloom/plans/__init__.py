"""The registered queries, grouped by the part of the library they exercise."""

from seqloom.plans import accession, catalog, collection, edits, io, positional, runtable
from seqloom.plans.registry import QUERIES

__all__ = ["QUERIES", "accession", "catalog", "collection", "edits", "io", "positional", "runtable"]
