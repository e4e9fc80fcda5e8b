"""Quality rules: a table of thresholds compiled into one Spark projection.

Every measure and every rule is a Catalyst expression over one row; there is no user function and
no shuffle, so a hot source or a group of copies costs nothing extra.

Defined results: a null text counts as empty (no words, base fails, not kept); a ratio over nothing
is 0; equal rows get equal verdicts; an empty table gives an empty result; other columns, also ones
named like a measure, are left alone by `judge`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.llm.words import bound, word_array

#: Common function words of the corpus's four languages (fixed values).
STOP_WORDS = (
    "the of and to in that is was for with on be at by this from are or an as it he his have not but which you"
    " der die und das den von zu mit sich des auf ist im dem nicht ein eine als auch es an er aus bei oder einer"
    " le la les et de du en un une que est dans pour qui sur par au avec il ne pas se plus ou ce"
    " el los las y a por con para del al lo como no su sus una si entre cuando muy sin"
).split()


@dataclass(frozen=True)
class Rule:
    """Keep a text only when `low <= measure <= high`; null bounds do not bind."""

    measure: str
    low: float | None = None
    high: float | None = None


#: Production thresholds. The first two are the base rules that the contract of the query fixes.
BASE = (Rule("n_words", low=50), Rule("repeat_share", high=0.5))
RULES = (
    Rule("mean_word_length", low=3.0, high=10.0),
    Rule("symbols_per_word", high=0.1),
    Rule("stop_word_share", low=0.06),
    Rule("capital_share", high=0.5),
    Rule("dup_line_share", high=0.4),
)


def _repeat_words(words: Column) -> Column:
    """Words inside a three-word window that occurs at least twice in the text.

    Windows are 64-bit hashes. Sorted with their positions, a repeated window stands beside its
    equal; each repeated position then covers up to three words not covered by the one before.
    """

    def covered(at: Column) -> Column:
        step = F.transform(at, lambda p, j: F.least(F.lit(3), F.coalesce(p - F.get(at, j - 1), F.lit(3))))
        return F.aggregate(step, F.lit(0), lambda total, x: total + x)

    def positions(ranked: Column) -> Column:
        beside = F.transform(
            ranked,
            lambda x, j: F.when(
                (F.get(ranked, j - 1)["h"] == x["h"]) | (F.get(ranked, j + 1)["h"] == x["h"]), x["i"]
            ),
        )
        return F.sort_array(F.filter(beside, lambda p: p.isNotNull()))

    def count(hashes: Column) -> Column:
        ranked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        found = bound(bound(ranked, positions), covered)
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(found)

    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )
    return F.when(F.size(words) < 3, F.lit(0)).otherwise(bound(hashes, count))


def measures(text: Column, stop_words: list[str] = STOP_WORDS) -> dict[str, Column]:
    """The counts that rules are made of, in one struct-free set of expressions per text."""
    text = F.coalesce(text, F.lit(""))
    stops = list(stop_words)

    def of_words(words: Column) -> Column:
        plain = lambda w: F.rtrim(F.lower(w), F.lit(".,;:!?"))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            _repeat_words(words).cast("long").alias("n_repeat_words"),
            F.size(F.filter(words, lambda w: plain(w).isin(stops))).cast("long").alias("n_stop_words"),
        )

    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    dup = bound(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"),
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    ))
    return {
        "words": bound(word_array(text), of_words),
        "lines": dup,
        "n_symbols": F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long"),
        "n_capitals": F.length(F.regexp_replace(text, r"[^A-Z]+", "")).cast("long"),
        "n_letters": F.length(F.regexp_replace(text, r"[^A-Za-z]+", "")).cast("long"),
    }


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part.cast("double") / whole.cast("double")).otherwise(F.lit(0.0))


RATIOS = {
    "mean_word_length": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "stop_word_share": ("n_stop_words", "n_words"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "capital_share": ("n_capitals", "n_letters"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
}
#: Counts that `measures` gives together, in structs.
PARTS = {"words": ("n_words", "word_chars", "n_repeat_words", "n_stop_words"), "lines": ("n_lines", "n_dup_lines")}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(docs: DataFrame, key: Column, stop_words: list[str] = STOP_WORDS) -> DataFrame:
    """(key, counts): one row per document with every count a rule can use."""
    m = measures(F.col("text"), stop_words)
    found = docs.select(key.alias("_key"), *[c.alias(f"_{n}") for n, c in m.items()])
    return found.select(
        "_key",
        *[F.col(f"_{part}.{n}") for part, names in PARTS.items() for n in names],
        *[F.col(f"_{n}").alias(n) for n in ("n_symbols", "n_capitals", "n_letters")],
    )


def passes(rules: tuple[Rule, ...], count: Callable[[str], Column] = F.col) -> Column:
    """The conjunction of a threshold table over the columns of `measure`, or over what `count` gives for their names."""
    verdict = F.lit(True)
    for rule in rules:
        value = _share(*map(count, RATIOS[rule.measure])) if rule.measure in RATIOS else count(rule.measure)
        if rule.low is not None:
            verdict = verdict & (value >= F.lit(rule.low))
        if rule.high is not None:
            verdict = verdict & (value <= F.lit(rule.high))
    return verdict


def judge(
    docs: DataFrame, key: Column, base: tuple[Rule, ...] = BASE, rules: tuple[Rule, ...] = RULES,
    stop_words: list[str] = STOP_WORDS,
) -> DataFrame:
    """(key, counts, base_failed, kept) for every row of `docs`; `key` is any expression on it."""
    marked = measure(docs, key, stop_words).withColumn("base_failed", ~passes(base))
    return marked.withColumn("kept", ~F.col("base_failed") & passes(rules))


def keep_good(docs: DataFrame, base: tuple[Rule, ...] = BASE, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows that pass, with their own columns.

    The verdict is one expression over one struct of counts: a filter repeats whatever a projection below it computes,
    so rules over plain columns would count every text once for each rule.
    """
    counted = measures(F.col("text"), STOP_WORDS)

    def verdict(found: Column) -> Column:
        def count(name: str) -> Column:
            part = next((p for p, names in PARTS.items() if name in names), None)
            return found[name] if part is None else found[part][name]

        return passes(base, count) & passes(rules, count)

    return docs.where(bound(F.struct(*[c.alias(n) for n, c in counted.items()]), verdict))


def _sql_list(values) -> str:
    return ", ".join("'" + v + "'" for v in values)


SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), g AS (
  SELECT k, unnest(range(1, len(w) - 1)) AS i, w FROM d WHERE len(w) >= 3
), f AS (SELECT k, i, count(*) OVER (PARTITION BY k, w[i], w[i + 1], w[i + 2]) AS n FROM g),
r AS (
  SELECT k, count(DISTINCT p) AS n FROM (SELECT k, unnest([i, i + 1, i + 2]) AS p FROM f WHERE n > 1) GROUP BY k
), n AS (SELECT k, unnest(string_split(t, chr(10))) AS line FROM d),
l AS (
  SELECT k, count(*) AS lines, count(*) - count(DISTINCT line) AS dups FROM n
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY k
), m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         coalesce(l.dups, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
         coalesce(l.lines, 0)::BIGINT AS n_lines,
         length(regexp_replace(t, '[^A-Z]+', '', 'g'))::BIGINT AS n_capitals,
         length(regexp_replace(t, '[^A-Za-z]+', '', 'g'))::BIGINT AS n_letters,
         len(list_filter(w, lambda x: rtrim(lower(x), '.,;:!?') IN ({_sql_list(STOP_WORDS)})))::BIGINT AS n_stop_words
  FROM d LEFT JOIN l USING (k) LEFT JOIN r USING (k)
), b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed
       AND word_chars::DOUBLE / n_words::DOUBLE BETWEEN 3.0 AND 10.0
       AND n_symbols::DOUBLE / n_words::DOUBLE <= 0.1
       AND n_stop_words::DOUBLE / n_words::DOUBLE >= 0.06
       AND (n_letters = 0 OR n_capitals::DOUBLE / n_letters::DOUBLE <= 0.5)
       AND n_dup_lines::DOUBLE / n_lines::DOUBLE <= 0.4 AS kept
FROM b
"""
