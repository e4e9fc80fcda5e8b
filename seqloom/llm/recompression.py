"""Recompression of word sequences: equal substrings get equal interior symbols, wherever they stand.

Runs of one word are named first; then each round names pairs. A symbol's name decides, by one bit of
a hash, whether it stands left or right in a pair of that round, and a pair's name is a hash of its
two names. So every name is the same everywhere without a dictionary to agree on. Beside its own span
each symbol carries the span of words that decided it; a window of words that holds that whole span
holds the symbol too, in whatever document the window occurs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from seqloom.llm import tokens as T

ROUNDS = 5


def _neighbours(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    left = np.zeros(len(text), bool)
    left[1:] = text[1:] == text[:-1]
    right = np.zeros(len(text), bool)
    right[:-1] = left[1:]
    return left, right


class Symbols:
    """One round's symbols over many texts: names, spans and deciding spans, all in word positions."""

    def __init__(self, hashes: np.ndarray, offsets: np.ndarray):
        n = len(hashes)
        self.offsets = offsets
        self.name, self.text = T.mix(hashes), T.owners(offsets)
        self.start, self.end = np.arange(n), np.arange(1, n + 1)
        self.low, self.high = self.start.copy(), self.end.copy()

    def _low_before(self, i: np.ndarray, left: np.ndarray) -> np.ndarray:
        """Where the neighbour's deciding span starts; the text's edge lies outside of every window."""
        return np.where(left[i], self.low[np.maximum(i - 1, 0)], self.offsets[self.text[i]] - 1)

    def _high_after(self, j: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.where(right[j], self.high[np.minimum(j + 1, len(self.high) - 1)], self.offsets[self.text[j] + 1] + 1)

    def _replace(self, i, j, name, low, high) -> None:
        self.start, self.end, self.text = self.start[i], self.end[j], self.text[i]
        self.name, self.low, self.high = name, low, high

    def name_runs(self) -> None:
        """One symbol for each maximal run of one name; knowing a run's ends takes both neighbours."""
        left, right = _neighbours(self.text)
        same = left.copy()
        same[1:] &= self.name[1:] == self.name[:-1]
        i = np.flatnonzero(~same)
        j = np.append(i[1:], len(same)) - 1
        size = (j - i + 1).astype(np.uint64)
        name = np.where(size > 1, T.mix(self.name[i] ^ T.mix(size + np.uint64(7919))), self.name[i])
        self._replace(i, j, name, self._low_before(i, left), self._high_after(j, right))

    def name_pairs(self, round_: int) -> None:
        """One symbol for each left name followed by a right name; what stays single had no partner."""
        left, right = _neighbours(self.text)
        goes_right = (T.mix(self.name + np.uint64(round_ + 1)) >> np.uint64(63)).astype(bool)
        opens = np.zeros(len(self.name), bool)
        opens[:-1] = right[:-1] & ~goes_right[:-1] & goes_right[1:]
        closes = np.zeros(len(self.name), bool)
        closes[1:] = opens[:-1]
        i = np.flatnonzero(~closes)
        pair = opens[i]
        j = i + pair
        joined = T.mix(self.name[i] * np.uint64(0x9E3779B97F4A7C15) + T.mix(self.name[j]))
        low = np.where(~pair & goes_right[i], self._low_before(i, left), self.low[i])
        high = np.where(~pair & ~goes_right[i], self._high_after(j, right), self.high[j])
        self._replace(i, j, np.where(pair, joined, self.name[i]), low, high)


class GivenSymbols:
    """Symbols named elsewhere, a list of (start, end, low, high, name) for each text; places count from its first word."""

    def __init__(self, lists: pa.Array, offsets: np.ndarray):
        count = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        base = np.repeat(offsets[:-1], count)
        flat = lists.flatten()
        of = lambda name: flat.field(name).to_numpy(zero_copy_only=False).astype(np.int64)
        self.start, self.end, self.low, self.high = (of(c) + base for c in ("start", "end", "low", "high"))
        self.name = of("name").view(np.uint64)


def recompress(hashes: np.ndarray, offsets: np.ndarray, rounds: int = ROUNDS) -> Symbols:
    symbols = Symbols(hashes, offsets)
    if len(hashes):
        symbols.name_runs()
        for r in range(rounds):
            symbols.name_pairs(r)
    return symbols


def range_minimum(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """min(values[first:last]) for every non-empty range, by a sparse table."""
    level = np.floor(np.log2(last - first)).astype(np.int64)
    table = [values]
    for k in range(int(level.max()) if len(level) else 0):
        longer = table[-1].copy()
        step = 1 << k
        longer[:-step] = np.minimum(table[-1][:-step], table[-1][step:])
        table.append(longer)
    out = np.empty(len(first), values.dtype)
    for k in np.unique(level).tolist():
        at = level == k
        out[at] = np.minimum(table[k][first[at]], table[k][last[at] - (1 << k)])
    return out
