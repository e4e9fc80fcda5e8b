"""Fill-in-middle texts by a counted-quantifier regex, without any Python worker.

A text is cut into lines (its units), each with its line end. `regexp_count` gives their number n; two draws
of a hash of the document's id choose a <= b among 0..n; one pattern per row, with the possessive groups
unit{a} and unit{b-a}, captures prefix, middle and suffix in one match, whose replacement is the output. Possessive
groups never give a line back, so a match takes time in proportion to the text.

    plain  the text        psm  <P>prefix<S>suffix<M>middle        spm  <S>suffix<P>prefix<M>middle

A text that holds a marker stays plain; in every other output each marker stands once, so `restored` finds the
parts again by splitting at the markers.

Defined results: a null text is an empty one; an empty text has no lines and stays plain; a null id draws as an
empty one; rows with one id draw alike, each for its own number of lines; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.llm.store import pack_rest

UNIT = r"(?:[^\n]*+\n|[^\n]++)"
MARKER = "<[PSM]>"
#: Shares in percent: documents that are cut at all, and cut ones whose suffix comes first.
CUT, SUFFIX_FIRST = 100, 50


def draws(key: Column, seed: int) -> list[Column]:
    """Four numbers below 2^32 from the hash of the seed and a document's id."""
    text = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(text, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def pattern(first: Column, second: Column) -> Column:
    """One row's pattern: so many units are the prefix, so many the middle, anything left the suffix."""
    return F.concat(
        F.lit(rf"(?s)\A({UNIT}{{"), first.cast("string"), F.lit(rf"}}+)({UNIT}{{"), second.cast("string"), F.lit(r"}+)(.*+)\z")
    )


def restored(output: Column, form: Column) -> Column:
    """The exact text behind an output."""
    part = F.split(output, MARKER, -1)
    whole = F.when(form == "psm", F.concat(part[1], part[3], part[2])).otherwise(F.concat(part[2], part[3], part[1]))
    return F.when(form == "plain", output).otherwise(whole)


def infill(docs: DataFrame, key: str = "doc_id", seed: int = 7, cut: int = CUT, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """(__rest, text, _n, _form, _output, _prefix_chars, _middle_chars) for every row of `docs`.

    `__rest` is a struct of the row's other columns; the two lengths are code points, null where the text is plain.
    """
    packed = pack_rest(docs, "text").withColumn("text", F.coalesce("text", F.lit("")))
    counted = packed.select(
        "*",
        F.regexp_count("text", F.lit(UNIT)).cast("long").alias("_n"),
        F.array(*draws(F.col("__rest").getField(key), seed)).alias("__draw"),
    )
    units = F.col("_n") + 1
    one, other = F.col("__draw")[0] % units, F.col("__draw")[1] % units
    plain = (F.col("text") == "") | F.col("text").rlike(MARKER) | (F.col("__draw")[2] % 100 >= cut)
    formed = counted.select(
        "*",
        F.least(one, other).alias("__a"),
        F.greatest(one, other).alias("__b"),
        F.when(plain, "plain").when(F.col("__draw")[3] % 100 < suffix_first, "spm").otherwise("psm").alias("_form"),
    )
    order = F.when(F.col("_form") == "psm", "<P>$1<S>$3<M>$2").otherwise("<S>$3<P>$1<M>$2")
    cut_text = F.regexp_replace("text", pattern(F.col("__a"), F.col("__b") - F.col("__a")), order)
    written = formed.select(
        "__rest", "text", "_n", "_form", F.when(F.col("_form") == "plain", F.col("text")).otherwise(cut_text).alias("_output")
    )
    part = F.when(F.col("_form") != "plain", F.split("_output", MARKER, -1))
    prefix = F.when(F.col("_form") == "psm", part[1]).otherwise(part[2])
    return written.select(
        "*", F.length(prefix).cast("long").alias("_prefix_chars"), F.length(part[3]).cast("long").alias("_middle_chars")
    )


SQL = """
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS u,
         sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), drawn AS (
  SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS x, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS y,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR ('0x' || h[17:24])::BIGINT % 100 >= 100 THEN 'plain'
              WHEN ('0x' || h[25:32])::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM units
), parts AS (
  SELECT *, array_to_string(u[1:least(x, y)], '') AS prefix,
         array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS middle,
         array_to_string(u[greatest(x, y) + 1:], '') AS suffix
  FROM drawn
)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
