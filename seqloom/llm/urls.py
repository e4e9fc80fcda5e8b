"""URL filters: host and path rules first, then naive Bayes over segmented host and path words.

Concatenated names are split by a unigram Viterbi whose word shares come from the text of all pages. A word has at
most `LONGEST_WORD` letters: longer runs of letters in the markup are no words and count in no share. A
multinomial naive Bayes then weighs the words of host and path; its training pages are all pages, labelled
by a short table of words that unwanted sites use, so the words that stand beside them are learned too.

All counts stay Spark tables and a word needs the same number of occurrences at every size. Each distinct name
is split once, against the words among its own substrings; each distinct host and path is scored once, by a join
of its words with their weights, and meets its pages by host and path.

Defined results: a null url, or one without `://`, has an empty host and path, fits no rule and is allowed
(there is nothing to score); equal urls get equal verdicts; ties of equally long rules go to the first one
given; an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.llm.shipping import map_arrow
from seqloom.llm.store import number_rows, settled, store

#: Occurrences that a word of the markup needs, at any size.
LEAST = 2
#: Letters of the longest word that a name may hold.
LONGEST_WORD = 24
#: Corpora of running text hold no single letters worth a name's part, but for the few real words.
SINGLE = ("a", "i", "y", "o", "e")
#: Words of unwanted sites (a labelling table, fixed values).
UNWANTED = (
    "casino poker bets betting bet jackpot slots lottery gambling win pills pharma viagra cialis drugs cheap"
    " adult sex porn xxx nude escort dating cams spam scam phishing malware warez torrent crack keygen"
    " ads adserver track tracker tracking banner popup clickbait farm free payday loans replica"
).split()
#: Of these, words that mark a page as unwanted on their own.
MARKING = frozenset(
    "casino poker bets betting jackpot slots lottery gambling pills viagra cialis adult sex porn xxx nude escort cams"
    " spam scam phishing malware warez keygen ads adserver clickbait payday replica".split()
)
SEED_SHARE = 2e-5
SEED_COUNT = 3
#: Words of smoothing that each class gets, spread as in all pages.
SMOOTHING = 20.0
#: Substrings that a Python worker hands on at once.
SUBSTRINGS = 100_000


@dataclass(frozen=True)
class UrlRule:
    """`site` is a host, `/` and a path prefix; it fits that host and its subdomains."""

    verdict: str
    site: str


RULES = (
    UrlRule("allow", "com/"),
    UrlRule("block", "example.com/en/"),
    UrlRule("allow", "www.example.com/en/"),
    UrlRule("block", "net/es/"),
    UrlRule("block", "net/fr/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path, as the module docstring's rules read them."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def matching_rule(host: Column, path: Column, rules: tuple[UrlRule, ...]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, as one expression; null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.site)):  # the last one wrapped on is asked first
        site, slash, rest = rule.site.partition("/")
        fits = ((host == site) | host.endswith("." + site)) & path.startswith(slash + rest)
        name = F.when(fits, F.lit(rule.site)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


class Segmenter:
    """Splits a name into its likeliest words; an unknown word costs more with every letter."""

    def __init__(self, shares: dict[str, float], total: int):
        self.cost = {w: -math.log(p) for w, p in shares.items()}
        self.unknown = math.log(max(total, 1)) + 1.0

    def _word(self, word: str) -> float:
        known = self.cost.get(word)
        return self.unknown + 2.3 * len(word) if known is None else known

    def split(self, name: str) -> tuple[str, ...]:
        best, cut = [0.0], [0]
        for end in range(1, len(name) + 1):
            options = [(best[a] + self._word(name[a:end]), a) for a in range(max(0, end - LONGEST_WORD), end)]
            cost, a = min(options)
            best.append(cost)
            cut.append(a)
        words, end = [], len(name)
        while end:
            words.append(name[cut[end] : end])
            end = cut[end]
        return tuple(reversed(words))


_NAME = re.compile(r"[^\W\d_]+|\d+")


def url_names(host: str, path: str) -> list[tuple[str, str]]:
    """(mark, name) of the host's labels and of the path; numbers are one name."""
    return [
        (mark, "0" if run[0].isdigit() else run)
        for mark, text in (("", host), ("/", path))
        for run in _NAME.findall(text.lower())
    ]


def word_counts(texts: DataFrame, column: str) -> tuple[DataFrame, int]:
    """(word, n) of all of the markup's text, and how many words there are."""
    plain = F.regexp_replace(F.coalesce(F.col(column), F.lit("")), r"(?s)<script.*?</script>|<style.*?</style>|<[^>]*>", " ")
    words = texts.select(F.explode(F.split(F.lower(plain), r"[^\p{L}]+")).alias("word"))
    short = words.where((F.length("word") > 0) & (F.length("word") <= LONGEST_WORD))
    counts = store(short.groupBy("word").agg(F.count("*").alias("n")), "words")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    usable = (F.col("n") >= LEAST) & ((F.length("word") > 1) | F.col("word").isin(*SINGLE))
    return counts.where(usable), total


def _substrings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_row, word): each name's different substrings that could be words."""
    rows: list[int] = []
    words: list[str] = []
    for batch in batches:
        for row, name in zip(batch.column("_row").to_pylist(), batch.column("name").to_pylist(), strict=True):
            seen: set[str] = set()
            for a in range(len(name)):
                for b in range(a + 1, min(a + LONGEST_WORD, len(name)) + 1):
                    word = name[a:b]
                    if word not in seen and (b > a + 1 or word in SINGLE):
                        seen.add(word)
                        rows.append(row)
                        words.append(word)
                if len(rows) >= SUBSTRINGS:
                    yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(words, pa.string())], ["_row", "word"])
                    rows, words = [], []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(words, pa.string())], ["_row", "word"])
            rows, words = [], []


def segmented(names: DataFrame, counts: DataFrame, total: int) -> DataFrame:
    """(name, words) of every name of a stored table, by the words that occur in it; stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name, known in zip(batch.column("name").to_pylist(), batch.column("known").to_pylist(), strict=True):
                shares = {k["word"]: k["n"] / total for k in known or ()}
                for w in UNWANTED:
                    if w in name:
                        shares[w] = max(shares.get(w, 0.0), SEED_SHARE)
                out.append(Segmenter(shares, total).split(name))
            yield pa.RecordBatch.from_arrays([batch.column("name"), pa.array(out, pa.list_(pa.string()))], ["name", "words"])

    numbered = number_rows(names)
    met = map_arrow(numbered, _substrings, "_row long, word string").join(counts, "word")
    known = met.groupBy("_row").agg(F.collect_list(F.struct("word", "n")).alias("known"))
    return store(
        map_arrow(numbered.join(known, "_row", "left").select("name", "known"), run, "name string, words array<string>"),
        "splits",
    )


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [
            (row, mark, name)
            for row, host, path in zip(*(batch.column(c).to_pylist() for c in ("_row", "host", "path")), strict=True)
            for mark, name in url_names(host, path)
        ]
        row, mark, name = zip(*parts, strict=True) if parts else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(row, pa.int64()), pa.array(mark, pa.string()), pa.array(name, pa.string())], ["_row", "mark", "name"]
        )


def words_of_urls(urls: DataFrame, counts: DataFrame, total: int) -> DataFrame:
    """(_row, word, n): the segmented words of every host and path, those of the path marked; stored."""
    parts = store(map_arrow(urls.select("_row", "host", "path"), _names, "_row long, mark string, name string"), "names")
    splits = segmented(store(parts.select("name").distinct(), "distinct"), counts, total)
    each = parts.join(splits, "name").select("_row", "mark", F.explode("words").alias("word"))
    return store(each.groupBy("_row", F.concat("mark", "word").alias("word")).agg(F.count("*").alias("n")), "url-words")


def bayes(urls: DataFrame, words: DataFrame) -> tuple[DataFrame, float]:
    """(word, weight), and the prior: log odds of unwanted to other pages, counted over all pages.

    Both classes are smoothed towards the words of all pages, so that a word's rarity alone says nothing.
    """
    marking = sorted(MARKING) + sorted("/" + w for w in MARKING)
    marked = store(words.where(F.col("word").isin(*marking)).select("_row").distinct(), "marked")
    told = urls.select("_row", "pages").join(marked.withColumn("bad", F.lit(True)), "_row", "left")
    told = store(told.select("_row", "pages", F.when(F.col("bad"), F.col("pages")).otherwise(F.lit(0)).alias("bad")), "told")
    of_pages = told.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("bad", "pages")]).first()
    seen = words.join(told, "_row").select("word", (F.col("n") * F.col("pages")).alias("n"), (F.col("n") * F.col("bad")).alias("bad"))
    seeds = [(w, SEED_COUNT, SEED_COUNT) for w in sorted(MARKING)]
    seen = seen.unionByName(urls.sparkSession.createDataFrame(seeds, "word string, n long, bad long"))
    sums = store(seen.groupBy("word").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), "bayes")
    every, block, vocabulary = sums.agg(F.sum("n"), F.sum("bad"), F.count("*")).first()
    base = F.lit(SMOOTHING) * (F.col("n") + 1) / F.lit(float(every + vocabulary))
    weight = F.ln((F.col("bad") + base) / F.lit(block + SMOOTHING)) - F.ln(
        (F.col("n") - F.col("bad") + base) / F.lit(every - block + SMOOTHING)
    )
    prior = math.log((of_pages["bad"] + 1) / (of_pages["pages"] - of_pages["bad"] + 1))
    return store(sums.select("word", weight.alias("weight")), "weights"), prior


def url_odds(pages: DataFrame, markup: str) -> DataFrame:
    """(host, path, log_odds) of every different host and path that is not empty."""
    counts, total = word_counts(pages, markup)
    host, path = host_and_path(F.col("url"))
    parsed = pages.select(host.alias("host"), path.alias("path"))
    urls = number_rows(store(parsed.groupBy("host", "path").agg(F.count("*").alias("pages")), "urls"))
    words = words_of_urls(urls, counts, total)
    weights, prior = bayes(urls, words)
    each = words.join(weights, "word").select("_row", "word", (F.col("n") * F.col("weight")).alias("x"))
    # in the words' order: a sum of doubles depends on it
    summed = F.aggregate(F.sort_array(F.collect_list(F.struct("word", "x"))), F.lit(0.0), lambda s, e: s + e["x"])
    odds = each.groupBy("_row").agg(summed.alias("x"))
    return urls.where("host <> '' OR path <> ''").join(odds, "_row", "left").select(
        "host", "path", (F.lit(prior) + F.coalesce("x", F.lit(0.0))).alias("log_odds")
    )


def judge_urls(pages: DataFrame, rules: tuple[UrlRule, ...] = RULES, markup: str = "html") -> DataFrame:
    """(page_id, host, path, rule, verdict, log_odds) of every page."""
    odds = settled(pages.sparkSession, "odds", lambda: url_odds(pages, markup))
    host, path = host_and_path(F.col("url"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    scored = parsed.join(odds, ["host", "path"], "left")
    learned = F.when(F.col("log_odds") > 0, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, learned).alias("verdict"), "log_odds")
