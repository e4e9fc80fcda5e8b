"""Best-fit packing of tokenised documents into sequences by a grouping genetic algorithm.

Documents become token pieces of at most `capacity`. Pieces are dealt by hash into shards of a few
thousand; every shard is packed by several islands. An island breeds packings: crossover injects
whole well-filled bins of one parent into another, drops the bins that now hold a piece twice, and
best-fits the displaced pieces. After each epoch every island receives its neighbour's best packing
(elite migration, one Spark join on the shard), and in the end each shard keeps its best island.

Nothing but piece lengths enters the search. A shard is one row of a few thousand entries whatever
the number of documents, so a hot source or a large group of copies does not matter.

Defined results: a null or empty text is the closing id alone; a document's pieces are numbered from
0 and only the last may be shorter than the capacity; repeated rows are packed as often as they
occur; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import random
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqloom.llm import tokens as T
from seqloom.llm.shipping import map_arrow
from seqloom.staging import stage

CAPACITY = 2048
CLOSING_ID = 0
SHARD_PIECES = 4096
ISLANDS = 2
EPOCHS = 2
POPULATION = 3
GENERATIONS = 4
#: Distinct parts whose ids a Python worker remembers before it starts afresh, and those in its table of late ones.
REMEMBERED, LATELY = 1_000_000, 1 << 17
#: New parts that one call of the tokenizer encodes.
TOGETHER = 64
#: Bytes of text that are encoded at once.
GATHERED_BYTES = 8 << 20


_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_CLOSING = np.isin(np.arange(256), np.frombuffer(b".,;:!?", np.uint8))


class Encoder:
    """Ids of whole texts, encoding each distinct part of a word once.

    The tokenizer drops white space and ASCII case before anything else and always cuts between letters
    and closing punctuation, so a text's ids are its parts' ids in a row. A word that is not plain ASCII
    letters with closing punctuation is a part of its own, as it stands. Parts are told apart by their bytes;
    hashes only bring the equal parts of a block together.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self):
        none = np.zeros(0, np.int64)
        #: Two sorted tables (hashes, slots) of what is known: a large one and what was learnt lately.
        self.tables = [(np.zeros(0, np.uint64), none), (np.zeros(0, np.uint64), none)]
        self.odd: dict[bytes, int] = {}  # parts whose hash is another part's
        self.pool = np.zeros(0, np.uint32)
        self.start, self.length = none, none
        self.text = np.zeros(0, np.uint8)
        self.text_start, self.text_length = none, none

    def _learn(self, new: list[bytes]) -> np.ndarray:
        """Slots of new parts. Some are encoded in one call, with blanks between; a token is the part's that it starts in."""
        words = [w.decode("utf-8", "replace") for w in new]
        begin = np.cumsum([0, *[len(w) + 1 for w in words]])[:-1]
        lines = [" ".join(words[i : i + TOGETHER]) for i in range(0, len(words), TOGETHER)]
        found = self.tokenizer.encode_batch(lines, add_special_tokens=False)
        ids = [e.ids for e in found]
        count = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.uint32, int(count.sum()))
        at = np.fromiter((o[0] for e in found for o in e.offsets), np.int64, len(flat)) + np.repeat(begin[::TOGETHER], count)
        length = np.bincount(np.searchsorted(begin, at, "right") - 1, minlength=len(new))
        size = np.fromiter(map(len, new), np.int64, len(new))
        slots = len(self.start) + np.arange(len(new))
        self.start = np.concatenate([self.start, len(self.pool) + np.cumsum(length) - length])
        self.length = np.concatenate([self.length, length])
        self.pool = np.concatenate([self.pool, flat])
        self.text_start = np.concatenate([self.text_start, len(self.text) + np.cumsum(size) - size])
        self.text_length = np.concatenate([self.text_length, size])
        self.text = np.concatenate([self.text, np.frombuffer(b"".join(new), np.uint8)])
        return slots

    def _remember(self, keys: np.ndarray, slots: np.ndarray) -> None:
        def merged(table, more):
            key, slot = (np.concatenate([a, b]) for a, b in zip(table, more, strict=True))
            order = np.argsort(key)
            return key[order], slot[order]

        self.tables[1] = merged(self.tables[1], (keys, slots))
        if len(self.tables[1][0]) > LATELY:
            self.tables = [merged(*self.tables), (np.zeros(0, np.uint64), np.zeros(0, np.int64))]

    def _slots(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Slots of parts that differ from one another; new ones are learnt."""
        slots = np.full(len(keys), -1, np.int64)
        for known, slot in self.tables:
            if len(known):
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                slots = np.where(known[at] == keys, slot[at], slots)
        seen = np.flatnonzero(slots >= 0)
        same = T.same_bytes(data, starts[seen], ends[seen], self.text, self.text_start[slots[seen]])
        same &= self.text_length[slots[seen]] == ends[seen] - starts[seen]
        raw = data.tobytes() if len(seen) < len(keys) or not same.all() else b""
        for i in seen[~same].tolist():
            part = raw[starts[i] : ends[i]]
            if part not in self.odd:
                self.odd[part] = int(self._learn([part])[0])
            slots[i] = self.odd[part]
        new = np.flatnonzero(slots < 0)
        if len(new):
            slots[new] = self._learn([raw[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist(), strict=True)])
            _, once = np.unique(keys[new], return_index=True)  # of parts with one hash, one is found by it
            self._remember(keys[new][once], slots[new][once])
        return slots

    @staticmethod
    def _parts(data: np.ndarray, at: np.ndarray):
        """(bytes, starts, ends, offsets): words cut into letters and closing punctuation where that is all they are."""
        starts, ends, of_text = T.words(data, at)
        place_type = np.int32 if len(data) < 1 << 31 else np.int64
        other = np.zeros(len(data) + 1, place_type)
        np.cumsum(~_LETTER[data], out=other[1:])
        body = np.arange(1, len(data) + 1, dtype=place_type)
        body[_CLOSING[data]] = 0
        np.maximum.accumulate(body, out=body)
        stem = body[ends - 1] if len(ends) else ends
        plain = (stem > starts) & (other[np.maximum(stem, starts)] == other[starts])
        cut = np.where(plain, stem, ends)
        tail = cut < ends
        folded = data.copy()
        inside = np.zeros(len(data) + 1, np.int8)
        inside[starts[plain]] += 1
        inside[cut[plain]] -= 1
        lowered = (np.cumsum(inside[:-1], dtype=np.int8) > 0) & (data < 97)
        folded[lowered] += np.uint8(32)
        count = 1 + tail.astype(np.int64)
        place = np.cumsum(count) - count
        first, last = np.empty(int(count.sum()), np.int64), np.empty(int(count.sum()), np.int64)
        first[place], last[place] = starts, cut
        first[place[tail] + 1], last[place[tail] + 1] = cut[tail], ends[tail]
        return folded, first, last, np.append(place, len(first))[of_text]

    @staticmethod
    def _firsts(which: np.ndarray, n: int) -> np.ndarray:
        """Where each of n numbers stands first."""
        first = np.empty(n, np.int64)
        first[which[::-1]] = np.arange(len(which))[::-1]
        return first

    def encode(self, data: np.ndarray, at: np.ndarray, closing: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of the texts, each followed by the closing id."""
        data, starts, ends, of_text = self._parts(data, at)
        which, distinct = pd.factorize(T.word_hashes(data, starts, ends))
        first = self._firsts(which, len(distinct))
        size = ends - starts
        if (size != size[first[which]]).any() or not T.same_bytes(data, starts, ends, data, starts[first[which]]).all():
            raw = data.tobytes()
            words = np.array([raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], object)
            distinct = distinct[which]
            which, _ = pd.factorize(words)
            first = self._firsts(which, int(which.max()) + 1)
            distinct = distinct[first]
        if len(self.start) > REMEMBERED:
            self._forget()
        slots = self._slots(data, starts[first], ends[first], distinct)
        slot = slots[which]
        n_texts = len(at) - 1
        length = np.ones(len(starts) + n_texts, np.int64)
        source = np.full(len(length), len(self.pool), np.int64)  # the closing id stands behind the pool
        place = np.arange(len(starts)) + T.owners(of_text)
        length[place], source[place] = self.length[slot], self.start[slot]
        ids = np.concatenate([self.pool, np.array([closing], np.uint32)])[T.ragged(source, length)]
        entry = of_text + np.arange(n_texts + 1)
        return ids, np.concatenate([[0], np.cumsum(length)])[entry]


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """One encoder per Python worker, which Spark uses for task after task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, closing: int = CLOSING_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the token pieces of every row's whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for batch in T.gathered(batches, "text", GATHERED_BYTES):
            for part in T.blocks(batch, "text", GATHERED_BYTES):
                ids, at = encoder.encode(*T.texts(part.column("text")), closing)
                size = np.diff(at)
                count = -(-size // capacity)
                row = np.repeat(np.arange(len(size)), count)
                piece = T.ragged(np.zeros(len(count), np.int64), count)
                start = piece * capacity
                length = np.minimum(size[row] - start, capacity)
                first = at[row] + start
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(first.tolist(), (first + length).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start),
                     pa.array(length), pa.array(crc, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(
        docs.select("doc_id", "text"), run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    )


class _Open:
    """Bins by free space, for best-fit."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.bins: list[list[int]] = []
        self.free: list[int] = []
        self.order: list[tuple[int, int]] = []

    def add(self, items: list[int], lengths: list[int]) -> None:
        self.bins.append(items)
        self.free.append(self.capacity - sum(lengths[i] for i in items))
        insort(self.order, (self.free[-1], len(self.bins) - 1))

    def put(self, item: int, length: int) -> None:
        """Into the fullest bin that still has room, else into a new one."""
        at = bisect_left(self.order, (length, -1))
        if at == len(self.order):
            self.bins.append([item])
            self.free.append(self.capacity - length)
            insort(self.order, (self.free[-1], len(self.bins) - 1))
            return
        _, b = self.order.pop(at)
        self.bins[b].append(item)
        self.free[b] -= length
        insort(self.order, (self.free[b], b))


def _best_fit(seed_bins, items, lengths, capacity) -> list[list[int]]:
    state = _Open(capacity)
    for b in seed_bins:
        state.add(list(b), lengths)
    for i in items:
        state.put(i, lengths[i])
    return state.bins


def _fitness(bins, lengths, capacity) -> float:
    """Mean squared fill: fewer and fuller bins score higher."""
    return sum((sum(lengths[i] for i in b) / capacity) ** 2 for b in bins) / max(1, len(bins))


def crossover(host, donor, lengths, capacity, rng: random.Random, full: float = 0.995):
    """Inject the donor's well-filled bins, drop host bins that share a piece, best-fit what they held."""
    good = [b for b in donor if sum(lengths[i] for i in b) >= full * capacity]
    injected = rng.sample(good, (len(good) + 1) // 2) if good else []
    taken = {i for b in injected for i in b}
    kept = [b for b in host if not any(i in taken for i in b)]
    displaced = [i for b in host if any(i in taken for i in b) for i in b if i not in taken]
    # the emptiest bins are opened too, so that their pieces can fill others
    kept.sort(key=lambda b: -sum(lengths[i] for i in b))
    keep = max(0, len(kept) - max(1, len(kept) // 50))
    displaced += [i for b in kept[keep:] for i in b]
    displaced.sort(key=lambda i: -lengths[i])
    return _best_fit(injected + kept[:keep], displaced, lengths, capacity)


def evolve(lengths: list[int], capacity: int, seeds: list[list[int]], rng: random.Random,
           population: int = POPULATION, generations: int = GENERATIONS) -> list[int]:
    """The best packing found, as the bin of each piece; `seeds` are packings to start from."""
    least = -(-sum(lengths) // capacity)
    down = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    people = [_best_fit([], down, lengths, capacity)]
    for labels in seeds:
        groups: dict[int, list[int]] = {}
        for i, b in enumerate(labels):
            groups.setdefault(b, []).append(i)
        people.append(list(groups.values()))
    while len(people) < population and min(map(len, people)) > least:
        loose = sorted(range(len(lengths)), key=lambda i: -lengths[i] * rng.uniform(0.9, 1.1))
        people.append(_best_fit([], loose, lengths, capacity))
    rank = lambda bins: (len(bins), -_fitness(bins, lengths, capacity))
    people.sort(key=rank)
    for _ in range(generations):
        if len(people[0]) <= least:
            break
        children = [crossover(people[rng.randrange(len(people))], people[rng.randrange(len(people))], lengths, capacity, rng)
                    for _ in range(population)]
        people = sorted(people + children, key=rank)[:population]
    label = [0] * len(lengths)
    for b, items in enumerate(people[0]):
        for i in items:
            label[i] = b
    return label


def _epoch(frame: DataFrame, capacity: int, epoch: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                rng = random.Random(f"{row['shard']}:{row['island']}:{epoch}")
                seeds = [x for x in (row["elite"], row["migrant"]) if x]
                best = evolve(row["lengths"], capacity, seeds, rng)
                made = {"shard": row["shard"], "island": row["island"], "lengths": row["lengths"], "elite": best,
                        "n_bins": max(best) + 1}
                yield pa.RecordBatch.from_pylist([made], schema=_EVOLVED)

    return map_arrow(frame, run, "shard long, island int, lengths array<int>, elite array<int>, n_bins int")


_EVOLVED = pa.schema([("shard", pa.int64()), ("island", pa.int32()), ("lengths", pa.list_(pa.int32())),
                      ("elite", pa.list_(pa.int32())), ("n_bins", pa.int32())])


def pack(cut: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES, islands: int = ISLANDS,
         epochs: int = EPOCHS) -> DataFrame:
    """Add `sequence_id` and `offset` to pieces; `cut` should be stored, its rows are counted first."""
    columns = cut.columns
    shards = max(1, -(-cut.count() // shard_pieces))
    # dealt by row, not by content: rows that repeat spread like any others
    dealt = cut.select(F.monotonically_increasing_id().alias("at"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("r"))
    grouped = stage(
        dealt.groupBy(F.pmod(F.xxhash64("at"), F.lit(shards)).alias("shard")).agg(
            F.sort_array(F.collect_list(F.struct("at", "r"))).alias("rows")
        ),
        "shards",
    )
    lengths = F.transform("rows", lambda x: x["r"]["length"].cast("int")).alias("lengths")
    none = F.lit(None).cast("array<int>")
    state = grouped.select(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), lengths
    ).withColumns({"elite": none, "migrant": none})
    for epoch in range(epochs):
        state = state.repartition(max(1, shards * islands // 4), "shard", "island")
        evolved = stage(_epoch(state, capacity, epoch), "islands")
        moved = evolved.select(
            "shard", F.pmod(F.col("island") + 1, F.lit(islands)).cast("int").alias("island"), F.col("elite").alias("migrant")
        )
        state = evolved.drop("n_bins").join(moved, ["shard", "island"])
    best = evolved.groupBy("shard").agg(F.min_by("elite", F.struct("n_bins", "island")).alias("elite"))
    placed = grouped.join(best, "shard").select("shard", F.explode(F.arrays_zip("rows", "elite")).alias("z"))
    flat = placed.select("shard", F.col("z.elite").alias("bin"), F.col("z.rows.at").alias("at"), F.col("z.rows.r").alias("r"))
    before = Window.partitionBy("shard", "bin").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    return flat.select(
        *[F.col("r").getField(c).alias(c) for c in columns],
        (F.col("shard") * F.lit(1 << 24) + F.col("bin")).alias("sequence_id"),
        F.coalesce(F.sum(F.col("r.length")).over(before), F.lit(0)).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: its place in its document and in its sequence."""
    return pack(stage(pieces(docs, tokenizer, capacity), "pieces"), capacity)
