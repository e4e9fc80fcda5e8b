"""Suffix-array dedup: remove every byte under a long byte string that occurs more than once.

A window's anchor is the position of its least 48-byte hash (leftmost among equals), so on ordinary text
one range holds some 75 windows. Where different ranges share an anchor, the suffixes at their window
starts are sorted: the deep-shallow way, a multikey quicksort over eight bytes at a time down to a shallow
depth, then a blind trie for each group that still shares its prefix. Neighbours that agree in a whole
window are repeats.

Anchors with very many different ranges are dealt over several tasks by range content; the tasks' sorted
windows then meet once more as counted fingerprints, dealt by their own value, so no anchor needs to fit one task.

Defined results: texts are UTF-8 bytes, a null text is empty; texts shorter than a window lose nothing; exact copies of a
text of at least one window lose all; strings are judged on the input, overlaps count; equal rows get
equal results; an empty table gives an empty result; all other columns travel in one struct.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.llm import tokens as T
from seqloom.llm.repeats import Kind, Ranges, remove_repeats, window_starts
from seqloom.llm.shipping import map_arrow
from seqloom.llm.store import store

WINDOW = 200
ANCHOR = 48
SHALLOW = 64
#: Ranges of one anchor that one task sorts together, and about how many of all anchors it sorts at once.
TOGETHER = 1024


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """min(values[i:i + width]) for every i where that fits."""
    out, have = values, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[: len(values) - width + 1], out[width - have :][: len(values) - width + 1])


def _lcp(a: bytes, b: bytes) -> int:
    differ = int.from_bytes(a) ^ int.from_bytes(b)
    return len(a) - (differ.bit_length() + 7) // 8


def blind_trie(strings: list[bytes]) -> list[list[int]]:
    """Classes of equal strings, in byte order; the strings have one length.

    Inner nodes hold a depth and a child per byte found there. A string goes down by those bytes alone,
    is compared once with the leaf it reaches, and then splits the path where the two part.
    """
    root: tuple | list | None = None  # a leaf is the list of its members, an inner node (depth, children)
    for i, s in enumerate(strings):
        if root is None:
            root = [i]
            continue
        node = root
        while isinstance(node, tuple):
            children = node[1]
            node = children.get(s[node[0]]) or next(iter(children.values()))
        t = strings[node[0]]
        if s == t:
            node.append(i)
            continue
        depth = _lcp(s, t)
        parent, node = None, root
        while isinstance(node, tuple) and node[0] < depth:
            parent, node = node, node[1][s[node[0]]]
        if isinstance(node, tuple) and node[0] == depth:
            node[1][s[depth]] = [i]
            continue
        split = (depth, {s[depth]: [i], t[depth]: node})
        if parent is None:
            root = split
        else:
            parent[1][s[parent[0]]] = split
    classes, todo = [], [root]
    while todo:
        node = todo.pop()
        if isinstance(node, tuple):
            todo += [node[1][b] for b in sorted(node[1], reverse=True)]
        elif node is not None:
            classes.append(node)
    return classes


def deep_shallow(text: np.ndarray, starts: np.ndarray, group: np.ndarray, depth: int, shallow: int = SHALLOW) -> np.ndarray:
    """Ranks of the strings text[start:start + depth] by (group, bytes); equal strings share a rank."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    eight = np.zeros(len(text), np.uint64)
    for k in range(8):
        eight = (eight << np.uint64(8)) | padded[k : k + len(text)].astype(np.uint64)
    by_group = np.argsort(group, kind="stable")
    head = np.ones(len(group), bool)
    head[1:] = group[by_group][1:] != group[by_group][:-1]
    rank = np.empty(len(group), np.int64)
    rank[by_group] = np.maximum.accumulate(np.where(head, np.arange(len(group)), 0))
    active = np.arange(len(starts))
    reach = 0
    while reach < min(shallow, depth) and len(active):
        key = eight[starts[active] + reach]
        if depth - reach < 8:
            key = key >> np.uint64(8 * (8 - (depth - reach)))
        order = np.lexsort((key, rank[active]))
        active, key = active[order], key[order]
        old = rank[active]
        opens = np.ones(len(active), bool)
        opens[1:] = old[1:] != old[:-1]
        parts = opens.copy()
        parts[1:] |= key[1:] != key[:-1]
        at = np.arange(len(active))
        group_head = np.maximum.accumulate(np.where(opens, at, 0))
        part_head = np.maximum.accumulate(np.where(parts, at, 0))
        rank[active] = old + part_head - group_head
        size = np.bincount(np.cumsum(parts) - 1)
        active = active[np.repeat(size, size) > 1]
        reach += 8
    if reach < depth and len(active):
        raw = text.tobytes()
        edges = np.flatnonzero(np.append(True, rank[active][1:] != rank[active][:-1]))
        for a, b in zip(edges.tolist(), np.append(edges[1:], len(active)).tolist(), strict=True):
            members = active[a:b].tolist()
            base, done = int(rank[members[0]]), 0
            equal: dict[bytes, list[int]] = {}
            for m, s in zip(members, starts[active[a:b]].tolist(), strict=True):
                equal.setdefault(raw[s + reach : s + depth], []).append(m)
            if len(equal) == 1:
                continue
            distinct = list(equal)
            for leaf in blind_trie(distinct):
                same = equal[distinct[leaf[0]]]
                for m in same:
                    rank[m] = base + done
                done += len(same)
    return rank


class Bytes(Kind):
    content = "binary"
    block = 1 << 20

    def __init__(self, size: int = WINDOW, anchor: int = ANCHOR):
        self.size, self.anchor = size, min(anchor, size)

    def units(self, data, at):
        return T.byte_values(data), at

    def ranges(self, units, offsets, part):
        window = window_starts(offsets, self.size)
        if not len(window):
            empty = np.zeros(0, np.int64)
            return Ranges(np.zeros(0, np.uint64), empty, empty, np.zeros(0, bool))
        at = np.arange(len(units) - self.anchor + 1)
        hashes = T.span_hash(T.fold(units), at, at + self.anchor)
        # the high half of the hash, then the position: a minimum finds the leftmost least one
        least = sliding_minimum((hashes & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64), self.size - self.anchor + 1)
        anchor = (least[window] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        new = np.ones(len(window), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(window)) - 1
        return Ranges(hashes[anchor[first]], window[first], window[last], np.zeros(len(first), bool))

    def contents(self, data, units, folded, first, last):
        length = last - first + self.size
        offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
        raw = np.ascontiguousarray(data[T.ragged(first, length)])
        return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])

    def _sorted(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Runs of repeated windows, and where an anchor is dealt over tasks its windows' counts."""
        data, at = T.texts(rows.column("content"))
        count = np.diff(at) - self.size + 1
        start = T.ragged(at[:-1], count)
        owner = np.repeat(np.arange(len(count)), count)
        name = rows.column("name").to_numpy()
        weight = rows.column("weight").to_numpy().astype(np.int64)[owner]
        dealt = (rows.column("deal").to_numpy() > 1)[owner]
        _, group = np.unique(name, return_inverse=True)
        rank = deep_shallow(data, start, group[owner], self.size)
        total = np.bincount(rank, weight, len(rank)).astype(np.int64)[rank] if len(rank) else weight
        place = (start - at[owner] + rows.column("start").to_numpy()[owner]).astype(np.int64)
        row = rows.column("_row").to_numpy()[owner]
        twice = (total > 1) & (weight == 1)
        before = np.zeros(len(twice), bool)
        before[1:] = twice[:-1] & (owner[1:] == owner[:-1])
        after = np.zeros(len(twice), bool)
        after[:-1] = twice[1:] & (owner[1:] == owner[:-1])
        opens, closes = np.flatnonzero(twice & ~before), np.flatnonzero(twice & ~after)
        yield _answers(row[opens], place[opens], place[closes] + self.size)
        leads = np.zeros(len(rank), bool)
        leads[np.unique(rank, return_index=True)[1]] = True
        tell = np.flatnonzero(dealt & leads)
        if len(tell):
            prints = T.span_hash(T.fold(T.byte_values(data)), start[tell], start[tell] + self.size)
            shares = rows.column("deal").to_numpy()[owner[tell]].astype(np.uint64)
            yield _packed(name[owner[tell]], (prints % shares).astype(np.int32), prints.view(np.int64), total[tell],
                          np.where(total[tell] == 1, row[tell], -1), place[tell])

    def repeated(self, open_ranges: DataFrame) -> DataFrame:
        deal = F.ceil(F.col("variants") / TOGETHER)
        dealt = open_ranges.select(
            "_row", "name", "start", "weight", "content", deal.cast("int").alias("deal"),
            F.pmod(F.xxhash64("content"), deal).cast("int").alias("share"),
        )
        spread = dealt.repartition("name", "share").sortWithinPartitions("name", "share")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[pa.RecordBatch] = []
            last, rows = None, 0
            for batch in batches:
                if not batch.num_rows:
                    continue
                name, share = batch.column("name").to_numpy(), batch.column("share").to_numpy()
                edge = np.flatnonzero((name[1:] != name[:-1]) | (share[1:] != share[:-1])) + 1
                cuts = [0, *edge.tolist(), batch.num_rows]
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    if rows >= TOGETHER and last != (name[a], share[a]):
                        yield from self._sorted(_join(held))
                        held, rows = [], 0
                    held.append(batch.slice(a, b - a))
                    last, rows = (name[a], share[a]), rows + b - a
            if held:
                yield from self._sorted(_join(held))

        answers = store(map_arrow(spread, run, _ANSWER), "suffixes")
        told = answers.where("name IS NOT NULL").select("name", "block", "prints", "counts", "rows", "starts")
        meeting = told.repartition("name", "block").sortWithinPartitions("name", "block")
        met = map_arrow(meeting, self._meet, "_row long, start int, end int")
        return answers.where("name IS NULL").select("_row", "start", "end").unionByName(met)

    def _meet(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Windows that one task saw once and another task saw too, as runs; a block of an anchor lies together."""
        held: list[pa.RecordBatch] = []
        last = None

        def answer() -> pa.RecordBatch:
            part = _join(held)
            prints, counts, rows, starts = (
                part.column(c).flatten().to_numpy().astype(np.int64) for c in ("prints", "counts", "rows", "starts")
            )
            _, which = np.unique(prints, return_inverse=True)
            again = (np.bincount(which, counts)[which] > 1) & (rows >= 0)
            order = np.lexsort((starts[again], rows[again]))
            row, start = rows[again][order], starts[again][order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)
            opens = np.flatnonzero(new)
            closes = np.append(opens[1:], len(row))[: len(opens)] - 1
            ends = (start[closes] + self.size).astype(np.int32)
            return pa.RecordBatch.from_arrays([pa.array(row[opens]), pa.array(start[opens].astype(np.int32)), pa.array(ends)],
                                              ["_row", "start", "end"])

        for batch in batches:
            for i in range(batch.num_rows):
                key = (batch.column("name")[i].as_py(), batch.column("block")[i].as_py())
                if held and key != last:
                    yield answer()
                    held = []
                held.append(batch.slice(i, 1))
                last = key
        if held:
            yield answer()

    def keep(self, text, kept):
        return np.frombuffer(text, np.uint8)[kept].tobytes()


_ANSWER = (
    "_row long, start int, end int, name long, block int, prints array<long>, counts array<long>, rows array<long>,"
    " starts array<int>"
)
_NAMES = [part.split()[0] for part in _ANSWER.split(", ")]
_LISTS = (pa.int64(), pa.int64(), pa.int64(), pa.int32())


def _answers(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    """Runs of windows known to be repeated."""
    n = len(row)
    known = [pa.array(row), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))]
    none = [pa.nulls(n, kind) for kind in (pa.int64(), pa.int32(), *map(pa.list_, _LISTS))]
    return pa.RecordBatch.from_arrays(known + none, _NAMES)


def _packed(name, block, prints, counts, rows, starts) -> pa.RecordBatch:
    """One row per anchor and block of fingerprints: its windows' fingerprints, counts, rows and starts."""
    order = np.lexsort((block, name))
    name, block = name[order], block[order]
    new = np.ones(len(name), bool)
    new[1:] = (name[1:] != name[:-1]) | (block[1:] != block[:-1])
    at = np.flatnonzero(new)
    offsets = np.append(at, len(name))
    n = len(at)
    lists = [T.list_array(v[order], offsets, kind) for v, kind in zip((prints, counts, rows, starts), _LISTS, strict=True)]
    none = [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32())]
    return pa.RecordBatch.from_arrays([*none, pa.array(name[at]), pa.array(block[at]), *lists], _NAMES)


def _join(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0] if len(parts) > 1 else parts[0]


def dedup_bytes(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """Every row as (`__rest`, text, `_n_units` (bytes), `_n_removed`, `_n_spans`, `_kept`: the bytes that stay)."""
    return remove_repeats(docs, Bytes(size), "binary")
