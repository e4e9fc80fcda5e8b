"""Run descriptions from XML and HTML text columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.functions import accession, files

# The part of a run document that is read (attributes carry an underscore).
RUN_DOCUMENT = (
    "RUN ARRAY<STRUCT<"
    "Pool: STRUCT<Member: ARRAY<STRUCT<_sample_name: STRING, _organism: STRING>>>, "
    "SRAFiles: STRUCT<SRAFile: ARRAY<STRUCT<_supertype: STRING, _size: BIGINT, "
    "Alternatives: ARRAY<STRUCT<_url: STRING>>>>>>>"
)


def run_files_from_xml(df: DataFrame, column: str, strict: bool = False) -> DataFrame:
    """One row per original file of each document's first run, classified by its path.

    Sample and organism are those of the first pool member. A document without original
    files, or one that is no XML, gives one row whose `found` is false (a failed job for
    malformed text when strict).
    """
    others = [c for c in df.columns if c != column]
    mode = "FAILFAST" if strict else "PERMISSIVE"
    run = F.get(F.from_xml(F.col(column), RUN_DOCUMENT, {"mode": mode})["RUN"], F.lit(0))
    parsed = df.select(*others, run.alias("__run"))
    member = F.get(F.col("__run.Pool.Member"), F.lit(0))
    numbered = F.transform(F.col("__run.SRAFiles.SRAFile"), lambda f, i: F.struct(i.alias("place"), f.alias("file")))
    originals = F.filter(numbered, lambda f: f["file"]["_supertype"] == "Original")
    exploded = parsed.select(
        *others,
        member["_sample_name"].alias("gsm_id"),
        member["_organism"].alias("organism"),
        F.explode_outer(originals).alias("__one"),
    )
    found = F.col("__one").isNotNull()
    path = F.coalesce(F.get(F.col("__one.file.Alternatives._url"), F.lit(0)), F.lit(""))
    kind = files.classify_filetype(path)
    read = F.when(kind == "fastq", files.parse_read_type(path)).otherwise(F.lit("Unknown"))
    return exploded.select(
        *others,
        "gsm_id",
        "organism",
        F.col("__one.place").alias("place"),
        F.when(found, path).alias("path"),
        F.when(found, kind).alias("filetype"),
        files.bytes_to_gb(F.col("__one.file._size")).alias("size_gb"),
        F.when(found, read).alias("read_type"),
        found.alias("found"),
    )


def _elements(text: Column, tag: str) -> Column:
    """Inner markup of every `tag` element, none of which lies in another.

    Possessive steps from one `<` to the next: no backtracking, and no recursion on long text.
    """
    pattern = rf"(?i)<{tag}(?:\s[^>]*+)?+>([^<]*+(?:<(?!/{tag}>)[^<]*+)*+)</{tag}>"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def _own_markup(html: Column, *tags: str) -> Column:
    """What is in each element of these names, in order of opening, without the elements of these names inside it.

    The page is cut before every such tag; one fold over the cuts, with a stack of the elements that are open, says
    whose each piece is. So elements may lie in one another to any depth; one that is never closed
    ends with the page, and a closing tag too many is passed over.
    """
    cuts = F.split(html, rf"(?i)(?=</?(?:{'|'.join(tags)})[\s/>])", -1)

    def owned(pieces: Column) -> Column:
        none = F.array().cast("array<int>")
        start = F.struct(none.alias("open"), F.lit(0).alias("next"), none.alias("owners"))

        def step(state: Column, piece: Column) -> Column:
            opens, closes = piece.rlike(r"^<\w"), piece.startswith("</")
            within = (
                F.when(opens, F.array_append(state["open"], state["next"]))
                .when(closes & (F.size(state["open"]) > 0), F.slice(state["open"], 1, F.size(state["open"]) - 1))
                .otherwise(state["open"])
            )
            return F.struct(within.alias("open"), (state["next"] + opens.cast("int")).alias("next"), state["owners"].alias("owners"))

        def note(state: Column, piece: Column) -> Column:
            after = step(state, piece)
            return _bound(
                after,
                lambda now: F.struct(
                    now["open"].alias("open"),
                    now["next"].alias("next"),
                    F.array_append(now["owners"], F.coalesce(F.try_element_at(now["open"], F.lit(-1)), F.lit(-1))).alias("owners"),
                ),
            )

        def gathered(found: Column) -> Column:
            numbered = F.arrays_zip(found["owners"].alias("owner"), pieces.alias("piece"))
            mine = lambda n: F.filter(numbered, lambda p: p["owner"] == n)
            numbers = F.when(found["next"] > 0, F.sequence(F.lit(0), found["next"] - 1)).otherwise(none)
            return F.transform(numbers, lambda n: F.array_join(F.transform(mine(n), lambda p: p["piece"]), ""))

        # the first piece opens nothing unless it begins with such a tag, as every later one does
        first = F.when(pieces[0].rlike(rf"(?i)^<(?:{'|'.join(tags)})[\s/>]"), pieces).otherwise(F.concat(F.array(F.lit("")), F.slice(pieces, 2, F.size(pieces))))
        return _bound(F.aggregate(first, start, note), gathered)

    return F.when(html.isNotNull(), _bound(cuts, owned))


def _text(markup: Column) -> Column:
    """Markup without tags, trimmed."""
    return F.trim(F.regexp_replace(markup, "<[^>]*>", ""))


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` evaluated once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def table_rows_from_html(df: DataFrame, column: str) -> DataFrame:
    """Body rows of every table of a page as (table, row, name -> cell), with the page's heading.

    Tables are numbered as they open; one inside a cell of another is a table of its own, and its text no part of that
    cell. Each table's names come from its own header cells; rows with another number of cells are skipped. A page without such a row gives one row whose `cells` is null. A page is taken
    apart in one expression, so no part of its text is searched per row.
    """
    others = [c for c in df.columns if c != column]
    html = F.col(column)
    heading = _text(F.get(_elements(html, "h1"), F.lit(0)))

    def rows_of(table: Column, place: Column) -> Column:
        names = F.transform(_elements(table, "th"), _text)
        cells = F.transform(_elements(table, "tr"), lambda r: F.transform(_elements(r, "td"), _text))
        parts = F.struct(names.alias("names"), cells.alias("rows"))

        def full(part: Column) -> Column:
            numbered = F.transform(part["rows"], lambda r, i: F.struct(i.alias("row"), r.alias("cells")))
            fit = F.filter(
                numbered, lambda r: (F.size(r["cells"]) == F.size(part["names"])) & (F.size(part["names"]) > 0)
            )
            return F.transform(
                fit,
                lambda r: F.struct(
                    place.alias("table"), r["row"].alias("row"), F.map_from_arrays(part["names"], r["cells"]).alias("cells")
                ),
            )

        return _bound(parts, full)

    found = F.flatten(F.transform(_own_markup(html, "table"), rows_of))
    page = df.select(*others, heading.alias("heading"), F.explode_outer(found).alias("__one"))
    return page.select(*others, "heading", *[F.col(f"__one.{c}").alias(c) for c in ("table", "row", "cells")])


def list_rows_from_html(df: DataFrame, column: str) -> DataFrame:
    """List items of a page: the address they link to, their own text, and the page's heading.

    Lists come as they open, each with its items in order; a list inside an item is a list of its own, and its
    text no part of that item. A page without lists gives no row.
    """
    others = [c for c in df.columns if c != column]
    html = F.col(column)
    heading = _text(F.get(_elements(html, "h1"), F.lit(0)))

    def items(page: Column) -> Column:
        return F.transform(
            page["items"],
            lambda item, i: F.struct(
                page["heading"],
                i.alias("row"),
                F.regexp_extract(item, r'<a href="([^"]*)"', 1).alias("link"),
                _text(item).alias("text"),
            ),
        )

    items_of = F.flatten(F.transform(_own_markup(html, "ul", "ol"), lambda own: _elements(own, "li")))
    page = F.struct(heading.alias("heading"), items_of.alias("items"))
    return df.select(*others, F.inline(_bound(page, items)).alias("heading", "row", "link", "text"))


def heading_fields(df: DataFrame, column: str = "heading") -> DataFrame:
    """Sample, species and run named in the heading."""
    heading = F.col(column)
    return df.withColumns(
        {
            "gsm_id": accession.heading_sample(heading),
            "species": accession.heading_species(heading),
            "run_id": accession.heading_run(heading),
        }
    )
