"""Substring dedup: remove every word under a long word sequence that occurs more than once.

Recompression names the texts' words, runs and pairs; a window of words takes as its anchor the longest
symbol that the window's own words decide (least hash among equals). Equal windows hold equal symbols,
so a symbol that occurs once rules all its windows out, and shared symbols lead to the ranges that
`repeats` compares. A window that decides no symbol (long runs of one word, text edges) is its own
anchor, named by all its words.

Defined results: null and empty texts, and texts shorter than a window, lose nothing; exact copies of a
text of at least one window lose all of their words; kept words are joined by one space; windows are judged on the
input, not on what is left; equal rows get equal results; an empty table gives an empty result; all other
columns travel in one struct.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.llm import tokens as T
from seqloom.llm.global_rounds import global_symbols
from seqloom.llm.recompression import ROUNDS, GivenSymbols, range_minimum, recompress
from seqloom.llm.repeats import Kind, Ranges, remove_repeats, window_starts
from seqloom.llm.store import store

WINDOW = 35


class Words(Kind):
    content = "array<bigint>"

    def __init__(self, size: int = WINDOW, rounds: int = ROUNDS, in_rounds: bool = False):
        self.size, self.rounds, self.in_rounds = size, rounds, in_rounds

    def prepared(self, texts):
        if not self.in_rounds:
            return texts
        return store(texts.join(global_symbols(texts, self.rounds), "_row", "left"), "symbols")

    def units(self, data, at):
        starts, ends, of_text = T.words(data, at)
        return T.word_hashes(data, starts, ends), of_text

    def ranges(self, units, offsets, part):
        window = window_starts(offsets, self.size)
        given = self.in_rounds and GivenSymbols(part.column("symbols"), offsets)
        symbols = given or recompress(units, offsets, self.rounds)
        first = np.searchsorted(symbols.low, window, "left")
        last = np.searchsorted(symbols.high, window + self.size, "right")
        held = last > first
        # the longest symbol, then the least name, then the leftmost: one number, so that a minimum finds it
        n = len(symbols.name)
        order = np.lexsort((symbols.name, symbols.start - symbols.end))
        step = np.ones(n, np.int64)
        step[1:] = (symbols.name[order][1:] != symbols.name[order][:-1]) | (
            (symbols.end - symbols.start)[order][1:] != (symbols.end - symbols.start)[order][:-1]
        )
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(step)
        anchor = np.full(len(window), -1, np.int64)
        anchor[held] = range_minimum(rank * n + np.arange(n), first[held], last[held]) % max(n, 1)
        name = np.empty(len(window), np.uint64)
        name[held] = symbols.name[anchor[held]]
        alone = ~held
        folded = T.fold(units)
        name[alone] = T.mix(T.span_hash(folded, window[alone], window[alone] + self.size) + np.uint64(1))
        new = np.ones(len(window), bool)
        new[1:] = (window[1:] != window[:-1] + 1) | (anchor[1:] != anchor[:-1]) | (alone[1:] & (name[1:] != name[:-1]))
        at = np.flatnonzero(new)
        end = np.append(at[1:], len(window)) - 1
        return Ranges(name[at], window[at], window[end], alone[at])

    def contents(self, data, units, folded, first, last):
        count = last - first + 1
        start = T.ragged(first, count)
        hashes = T.span_hash(folded, start, start + self.size).view(np.int64)
        return T.list_array(hashes, np.concatenate([[0], np.cumsum(count)]), pa.int64())

    def repeated(self, open_ranges: DataFrame) -> DataFrame:
        windows = open_ranges.select(
            "_row", "name", "start", "weight", F.posexplode("content").alias("place", "hash")
        ).select("_row", "name", "hash", "weight", (F.col("start") + F.col("place")).alias("start"))
        twice = windows.groupBy("name", "hash").agg(F.sum("weight").alias("n")).where("n > 1").select("name", "hash")
        return windows.where("weight = 1").join(twice, ["name", "hash"]).select(
            "_row", "start", (F.col("start") + self.size).alias("end")
        )

    def keep(self, text, kept):
        return b" ".join(compress(text.split(), kept.tolist())).decode("utf-8")


def dedup_substrings(docs: DataFrame, size: int = WINDOW, in_rounds: bool = False) -> DataFrame:
    """Every row as (`__rest`, text, `_n_units` (words), `_n_removed`, `_n_spans`, `_kept`: the text that stays).

    With `in_rounds` Spark rounds name all runs and pairs by dictionaries of the whole corpus (`global_rounds`), at
    many times the cost; otherwise every task names them by hashes, which agree everywhere. The result is the same.
    """
    return remove_repeats(docs, Words(size, in_rounds=in_rounds), "string")
