"""Document fingerprints by consistent weighted sampling, in built-in functions only.

A text's terms are its words, weighted by their counts. For each of `SAMPLES` samples every term draws two
Gamma(2, 1) numbers and a uniform one from hashes of itself, and the term with the least sampled value wins
together with its quantised weight. Two texts' winners agree with the probability of their generalised
Jaccard similarity: the sum of least weights over the sum of greatest weights.

The least value and the winner's name travel as one long, so a sample is a plain `min` that Spark computes
inside its generated code, partially before any exchange. Terms of a row are counted and reduced in the
task that holds the row; only signatures leave it.

Defined results: a null or empty text has no terms, an empty fingerprint and n_chars 0; two texts without
terms are alike (1.0), one with and one without are not (0.0); rows with equal ids come in order of their
texts' hashes, null ids before all others; a single row follows itself; an empty table gives an empty
result; only the id and the text are read. Ids may be of any type that has an order by bytes (`binary_key`).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.llm.store import release, store
from seqloom.llm.words import word_array
from seqloom.operators.positions import with_pos
from seqloom.operators.splitters import IrregularKeysError, binary_key, splitters

SAMPLES = 32
#: Bits of the winner's name in a sample; chance agreement is one in 2^24.
NAME_BITS = 24
HEX = NAME_BITS // 4
#: Rows that a cell of neighbours by id should hold; it may come to twice as many.
CELL_ROWS = 32


def _uniform(hashed: Column, slice_: int) -> Column:
    """21 of a hash's bits as a number strictly between 0 and 1."""
    bits = F.shiftrightunsigned(hashed, 21 * slice_).bitwiseAND(F.lit((1 << 21) - 1))
    return (bits.cast("double") + 0.5) * (1.0 / (1 << 21))


def sample(term: Column, log_weight: Column, k: int) -> Column:
    """One term's draw for sample k: its value in the high bits, its name and quantised weight in the low."""
    one, two = F.xxhash64(term, F.lit(2 * k)), F.xxhash64(term, F.lit(2 * k + 1))
    r = -F.ln(_uniform(one, 0) * _uniform(one, 1))
    c = -F.ln(_uniform(one, 2) * _uniform(two, 0))
    beta = _uniform(two, 1)
    t = F.floor(log_weight / r + beta)
    log_value = F.ln(c) - r * (t - beta + 1.0)
    level = F.floor((F.greatest(F.least(log_value, F.lit(100.0)), F.lit(-400.0)) + 400.0) * float(1 << 29))
    name = F.xxhash64(term, t).bitwiseAND(F.lit((1 << NAME_BITS) - 1))
    return F.shiftleft(level.cast("long"), NAME_BITS).bitwiseOR(name)


def signatures(words: DataFrame, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """(keys, fingerprint) from rows (keys, word); without an exchange if rows of a key lie together."""
    counted = words.groupBy(*keys, F.xxhash64("word").alias("term")).agg(F.count("*").alias("n"))
    weighted = counted.select(*keys, "term", F.ln(F.col("n").cast("double")).alias("weight"))
    least = weighted.groupBy(*keys).agg(*[F.min(sample(F.col("term"), F.col("weight"), k)).alias(f"s{k}") for k in range(samples)])
    mask = F.lit((1 << NAME_BITS) - 1)
    parts = [F.lpad(F.lower(F.hex(F.col(f"s{k}").bitwiseAND(mask))), HEX, "0") for k in range(samples)]
    return least.select(*keys, F.concat(*parts).alias("fingerprint"))


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """The share of samples in which two fingerprints agree."""
    same = [
        (F.substring(a, 1 + HEX * k, HEX) == F.substring(b, 1 + HEX * k, HEX)).cast("int") for k in range(samples)
    ]
    both = reduce(lambda x, y: x + y, same) / float(samples)
    return F.when((a == "") & (b == ""), 1.0).when((a == "") | (b == ""), 0.0).otherwise(both)


def with_cells(docs: DataFrame, order: list[str], cell_rows: int = CELL_ROWS) -> DataFrame:
    """Add `_cell`, a bucket of a few rows that rises with the order, however the ids are spread."""
    key = binary_key(docs, order)
    if key is None:
        raise TypeError(f"{order[0]} is of a type that has no order by bytes")
    while True:
        try:
            return splitters(docs, key, False, [], cell_rows).apply(docs, key, "_cell")
        except IrregularKeysError:  # fewer splitters do for larger cells
            cell_rows *= 4


def with_following(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, text, `_cell`, `_no`, `_next_cell`, `_next_no`, `_next_text`): each with the next by key.

    Rows of one key follow each other by their texts' hashes, so that they too are spread over cells. One exchange by
    cell puts neighbours together; only each cell's first text is sent to the cell before.
    """
    narrow = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias(text))
    placed = with_cells(narrow.withColumn("_tie", F.xxhash64(text)), [key, "_tie"]).drop("_tie")
    order = Window.partitionBy("_cell").orderBy(F.col(key).asc_nulls_first(), F.xxhash64(text))
    here = placed.withColumn("_no", F.row_number().over(order)).withColumn("_after", F.lead(text).over(order))
    cells = _following_cells(placed)
    firsts = here.where("_no = 1").select(F.col("_cell").alias("_next_cell"), F.col(text).alias("_first"))
    edge = cells.join(firsts, "_next_cell")
    last = F.col("_after").isNull()
    return here.join(edge, "_cell", "left").select(
        key, text, "_cell", "_no",
        F.when(last, F.col("_next_cell")).otherwise(F.col("_cell")).alias("_next_cell"),
        F.when(last, F.lit(1)).otherwise(F.col("_no") + 1).alias("_next_no"),
        F.coalesce("_after", "_first").alias("_next_text"),
    )


def _following_cells(placed: DataFrame) -> DataFrame:
    """(_cell, _next_cell) for every cell that has rows; the first follows the last."""
    cells = store(with_pos(store(placed.select("_cell").distinct(), "cells"), "_cell", pos="_place"), "cells")
    following = cells.select(F.col("_cell").alias("_next_cell"), F.col("_place").alias("_before"))
    before = F.col("_place") + 1
    wrapped = cells.select("_cell", F.when(before < cells.count(), before).otherwise(F.lit(0)).alias("_before"))
    return wrapped.join(following, "_before").select("_cell", "_next_cell")


def fingerprint_with_edits(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every text and of its edit by the next text, with their likenesses.

    Fingerprints and what else is told of a text are written by one job, whose parts read one exchange of the texts.
    """
    rows = with_following(docs)
    n = F.length("text")
    edited = F.concat(F.expr("left(text, length(text) - int(floor(length(text) / 2)))"),
                      F.expr("left(_next_text, int(floor(length(text) / 2)))"))
    both = F.array(
        F.struct(F.lit(0).alias("which"), word_array(F.col("text")).alias("words")),
        F.struct(F.lit(1).alias("which"), word_array(edited).alias("words")),
    )
    words = rows.select("_cell", "_no", F.inline(both)).select("_cell", "_no", "which", F.explode("words").alias("word"))
    about = ("doc_id", "_cell", "_no", "_next_cell", "_next_no", "n_chars", "edited_sha256")
    told = rows.withColumn("n_chars", n.cast("long")).withColumn("edited_sha256", F.sha2(edited, 256)).select(*about)
    signed = signatures(words, ["_cell", "_no", "which"], samples)
    found = store(signed.unionByName(told, allowMissingColumns=True), "fingerprints")
    release(docs.sparkSession)
    told = found.where("which IS NULL").select(*about)
    own = found.where("which = 0").select("_cell", "_no", "fingerprint")
    of_edit = found.where("which = 1").select("_cell", "_no", F.col("fingerprint").alias("edited_fingerprint"))
    of_next = found.where("which = 0").select(
        F.col("_cell").alias("_next_cell"), F.col("_no").alias("_next_no"), F.col("fingerprint").alias("next_fingerprint")
    )
    joined = told.join(own, ["_cell", "_no"], "left").join(of_edit, ["_cell", "_no"], "left").join(
        of_next, ["_next_cell", "_next_no"], "left"
    )
    prints = ("fingerprint", "edited_fingerprint", "next_fingerprint")
    full = joined.select("doc_id", "n_chars", "edited_sha256", *[F.coalesce(c, F.lit("")).alias(c) for c in prints])
    return full.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), samples).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint"), samples).alias("near_next"),
    )
