"""N-gram Jaccard join with adaptive multi-match prefixes.

A text's set holds its distinct five-word shingles; two texts link when their sets' Jaccard similarity
reaches the threshold. All sets are read in one global order, rare shingles first. If two sets are
similar, their first n - ceil(t n) + k shingles have at least k in common; every text picks its own k by
the candidates that its prefix shingles would bring, and a pair must match as often as the smaller k, and as
often as the two sizes ask for.

Equal sets become one node before any comparison. Similar groups are then joined up in rounds: of every
prefix shingle's list each node is compared with a few hubs only, and lists whose nodes are all connected
drop out. A last round compares what is left of the lists without any such choice, so that no link that
would join two components is missed, while nodes already connected are never paired again. It pairs by the part
of the prefixes that the two sizes ask for. Bitmaps of the sets' cells then rule out pairs that cannot have enough in common;
the last round counts the matches of what is left over the whole prefixes. Only then texts meet.

Lists and nodes grow with the corpus, so they are never broadcast to what they meet, however small they happen to be: plans are
alike at every size.

The order needs frequencies only as a hint: they come from the shingles that some task meets in several sets, of
which a fixed number, those with the most hits, is collected and broadcast. All others come first, by their hashes.

Defined results: a text without words (or null) has an empty set, links with nothing and is its own
component; fewer than five words are one shingle; equal sets always link; rows with one id are one
document with several texts (their component's least id is the same); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.llm import tokens as T
from seqloom.llm.components import components
from seqloom.llm.shipping import map_arrow
from seqloom.llm.store import REST, number_rows, pack_rest, release, rest_of, settled, store

SHINGLE = 5
#: Threshold as a fraction, so that comparisons are exact.
NUMERATOR, DENOMINATOR = 75, 100
#: Frequent shingles whose hits order the sets: a fixed number whatever the corpus.
COMMON = 1 << 18
#: Shingles that a task gathers before it looks which of them came again.
GATHERED = 1 << 22
MOST_MATCHES = 4
HUB_ROUNDS = 1
#: Hubs of a list, and hubs that a node is compared with, in one round.
HUBS = 4
#: What verifying one candidate costs, in prefix rows.
VERIFY_COST = 8.0
#: Hits from which a shingle counts as shared without asking.
SURE = 4096
#: Cells of a set's bitmap.
CELLS = 1024
#: Tasks that a shingle with as many hits is dealt over.
SALTS = 64
#: Sets that a task remembers, to take copies once.
REMEMBERED = 1 << 20


def shingle_sets(data: np.ndarray, at: np.ndarray, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): each text's distinct shingles, sorted."""
    starts, ends, of_text = T.words(data := T.lower_ascii(data), at)
    folded = T.fold(T.word_hashes(data, starts, ends))
    n = np.diff(of_text)
    count = np.where(n == 0, 0, np.maximum(n - width + 1, 1))
    first = T.ragged(of_text[:-1], count)
    hashes = T.span_hash(folded, first, np.minimum(first + width, np.repeat(of_text[1:], count)))
    edges = np.concatenate([[0], np.cumsum(count)]).tolist()
    sets = [np.unique(hashes[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    return np.concatenate(sets) if sets else hashes, offsets


def set_names(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """64-bit names of sorted sets, as signed numbers; an empty set's means nothing."""
    return T.span_hash(T.fold(values), offsets[:-1], offsets[1:]).view(np.int64)


@dataclass(frozen=True)
class Common:
    """The most frequent shingles, sorted, and how often they were seen together: a hint for the order and for k."""

    shingles: np.ndarray
    counts: np.ndarray

    def seen(self, values: np.ndarray) -> np.ndarray:
        """The count of each value, 0 for those that are not among them."""
        if not len(self.shingles):
            return np.zeros(len(values), np.int64)
        at = np.minimum(np.searchsorted(self.shingles, values), len(self.shingles) - 1)
        return np.where(self.shingles[at] == values, self.counts[at], 0)


class _Unseen:
    """Tells the first copy of each set that a task meets."""

    def __init__(self):
        self.seen: set[int] = set()

    def __call__(self, nodes: np.ndarray, n: np.ndarray) -> np.ndarray:
        if len(self.seen) > REMEMBERED:
            self.seen.clear()
        return np.array([x not in self.seen and not self.seen.add(x) for x in nodes.tolist()], bool) & (n > 0)


def sketches(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """For each set a bitmap of the cells that its shingles fall into, as longs."""
    held = np.zeros((len(offsets) - 1, CELLS), bool)
    held[T.owners(offsets), (values >> np.uint64(32)).astype(np.int64) % CELLS] = True
    longs = np.packbits(held, axis=1, bitorder="little").view(np.int64)
    return T.list_array(longs.ravel(), np.arange(len(offsets)) * (CELLS // 64), pa.int64())


def possible(pairs: DataFrame, described_rows: DataFrame) -> DataFrame:
    """The pairs whose bitmaps leave room for enough common shingles.

    A cell that only one of two sets has holds a shingle that the other lacks. So a set has at most as many common
    shingles as it has shingles, less such cells of its own.
    """
    known = described_rows.where("sketch IS NOT NULL").select("node", "n", "sketch")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    known = store(known.join(ends, "node", "left_semi").groupBy("node").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch")), "sketches")
    of = {side: known.select(*[F.col(c).alias(f"{side}_{c}") for c in known.columns]) for side in "ab"}
    both = pairs.join(of["a"], F.col("a") == F.col("a_node")).join(of["b"], F.col("b") == F.col("b_node"))

    def alone(x: str, y: str) -> Column:
        return sum((F.bit_count(F.col(x)[i].bitwiseAND(F.bitwise_not(F.col(y)[i]))) for i in range(CELLS // 64)), F.lit(0))

    room = F.least(F.col("a_n") - alone("a_sketch", "b_sketch"), F.col("b_n") - alone("b_sketch", "a_sketch"))
    return both.where(room >= _overlap("a_n", "b_n")).select("a", "b")


def described(docs: DataFrame) -> DataFrame:
    """One stored table of (_row, doc_id, n, node) for every text, with a sketch of each set once a task, and of
    (shingle, hits) for what a task meets in several sets."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["_row", "doc_id", "n", "node", "sketch", "shingle", "hits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_type, unseen, gathered, held = None, _Unseen(), [], 0

        def met_again():
            shingle, hits = np.unique(np.concatenate(gathered), return_counts=True)
            shingle, hits = shingle[hits > 1], hits[hits > 1]
            none = pa.nulls(len(shingle), pa.int64())
            return pa.RecordBatch.from_arrays(
                [none, pa.nulls(len(shingle), id_type), none, none, pa.nulls(len(shingle), pa.list_(pa.int64())),
                 pa.array(shingle.view(np.int64)), pa.array(hits.astype(np.int64))],
                names,
            )

        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for part in T.blocks(batch, "text"):
                values, offsets = shingle_sets(*T.texts(part.column("text")))
                n, node = np.diff(offsets), set_names(values, offsets)
                new = unseen(node, n)
                gathered.append(values[T.ragged(offsets[:-1][new], n[new])])
                held += len(gathered[-1])
                none = pa.nulls(len(n), pa.int64())
                once = np.where(new, np.cumsum(new) - 1, 0)
                edges = np.concatenate([[0], np.cumsum(n[new])])
                drawn = sketches(gathered[-1], edges).take(pa.array(once, mask=~new))
                yield pa.RecordBatch.from_arrays(
                    [part.column("_row"), part.column("doc_id"), pa.array(n), pa.array(node, mask=n == 0), drawn, none, none], names
                )
                if held > GATHERED:
                    yield met_again()
                    gathered, held = [], 0
        if held:
            yield met_again()

    return store(
        map_arrow(docs.select("_row", "doc_id", "text"), run,
                  f"_row long, doc_id {kind}, n long, node long, sketch array<bigint>, shingle long, hits long"),
        "sets",
    )


def common_shingles(rows: DataFrame) -> Common:
    """The `COMMON` shingles with the most hits: a fixed number whatever the corpus."""
    sums = rows.where("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("hits").alias("hits"))
    top = sums.orderBy(F.desc("hits"), "shingle").limit(COMMON).toArrow()
    shingles = top.column("shingle").to_numpy().view(np.uint64)
    order = np.argsort(shingles)
    return Common(shingles[order], top.column("hits").to_numpy()[order])


def ordered_prefixes(values: np.ndarray, offsets: np.ndarray, common: Common):
    """(prefix shingles in the global order, length and matches asked for of each set, hits of the shingles).

    Matches are chosen by estimated cost: each prefix shingle costs a row, and each of its hits may become a
    candidate, of which k matches make one.
    """
    seen = common.seen(values)
    level = np.minimum(255, 4 * np.log2(seen + 1.0)).astype(np.uint64)
    key = (level << np.uint64(56)) | (values >> np.uint64(8))
    edges = offsets.tolist()
    order = [a + np.argsort(key[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    order = np.concatenate(order) if order else np.zeros(0, np.int64)
    brought = np.concatenate([[0.0], np.cumsum(seen[order], dtype=float)])
    n, start = np.diff(offsets), offsets[:-1]
    least = -(-NUMERATOR * n // DENOMINATOR)
    cost = np.full((MOST_MATCHES, len(n)), np.inf)
    for k in range(1, MOST_MATCHES + 1):
        length = np.minimum(n - least + k, n)
        hit = brought[start + length] - brought[start]
        cost[k - 1] = np.where(k <= least, length + VERIFY_COST * hit / k, np.inf)
    matches = np.argmin(cost, axis=0) + 1
    length = np.where(n == 0, 0, n - least + matches)
    taken = T.ragged(start, length)
    return key[order][taken], length, matches, seen[order][taken]


def prefixes(docs: DataFrame, common: Common) -> DataFrame:
    """(token, node, n, k, place, sure): the prefix shingles of every set, in the global order.

    A task emits a set once, however many copies it meets. `sure` marks shingles with so many hits that nothing
    needs to ask whether another set holds them.
    """
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unseen = _Unseen()
        for batch in batches:
            for part in T.blocks(batch, "text"):
                values, offsets = shingle_sets(*T.texts(part.column("text")))
                n, node = np.diff(offsets), set_names(values, offsets)
                rows = np.flatnonzero(unseen(node, n))
                values, offsets = values[T.ragged(offsets[rows], n[rows])], np.concatenate([[0], np.cumsum(n[rows])])
                n, node = n[rows], node[rows]
                tokens, length, matches, seen = ordered_prefixes(values, offsets, shared.value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens.view(np.int64)), pa.array(np.repeat(node, length)),
                     pa.array(np.repeat(n, length).astype(np.int32)), pa.array(np.repeat(matches, length).astype(np.int8)),
                     pa.array(T.ragged(np.zeros(len(n), np.int64), length).astype(np.int32)), pa.array(seen > SURE)],
                    ["token", "node", "n", "k", "place", "sure"],
                )

    return map_arrow(docs.select("text"), run, "token long, node long, n int, k byte, place int, sure boolean")


def shared_prefixes(docs: DataFrame, common: Common) -> DataFrame:
    """(token, node, salt, n, k, place, held, rank) of every prefix shingle that more than one set holds.

    One exchange brings a shingle's rows together, and the least and the greatest set tell whether there are two. Shingles
    with many hits need not be asked about: they are dealt over `SALTS` tasks by their sets. Their salts start at 1, all
    others' are 0.
    """
    bits = F.shiftleft(F.col("n").cast("long"), 32) + F.shiftleft(F.col("place").cast("long"), 4)
    rest = bits + F.shiftleft(F.col("k").cast("long"), 1) + F.col("sure").cast("long")
    salt = F.when(F.col("sure"), F.pmod(F.xxhash64("node"), F.lit(SALTS)) + 1).otherwise(F.lit(0)).cast("int")
    found = prefixes(docs, common).select("token", "node", rest.alias("rest"), salt.alias("salt")).repartition("token", "salt")
    ends = Window.partitionBy("token", "salt")
    found = found.withColumns({"low": F.min("node").over(ends), "high": F.max("node").over(ends)})
    packed = F.col("rest")
    held = found.where((F.col("low") < F.col("high")) | (packed.bitwiseAND(1) == 1)).select("token", "salt", "node", "rest").distinct()
    rows = held.select(
        "token", "node", "salt", F.shiftright(packed, 32).cast("int").alias("n"), F.shiftright(packed, 1).bitwiseAND(7).cast("byte").alias("k"),
        F.shiftright(packed, 4).bitwiseAND((1 << 28) - 1).cast("int").alias("place"),
    )
    rows = store(rows, "prefixes")
    release(docs.sparkSession)
    # an edit's own shingles are in no other set: the more of its prefix a set shares, the fewer edits it has
    length = F.col("n") - F.ceil(F.col("n") * NUMERATOR / DENOMINATOR) + F.col("k")
    ranks = rows.groupBy("node", "n", "k").agg(F.count("*").alias("held"))
    ranks = ranks.select("node", "held", (-F.floor(16 * F.col("held") / length)).cast("int").alias("rank"))
    return rows.join(store(ranks, "ranks"), "node")


def similar_size(a: str, b: str):
    return (F.col(a) * DENOMINATOR >= F.col(b) * NUMERATOR) & (F.col(b) * DENOMINATOR >= F.col(a) * NUMERATOR)


def enough_matches(n_a: str, k_a: str, n_b: str, k_b: str, matches: Column):
    """Whether two sets can still be similar, given how many of their prefix shingles are common.

    Common shingles are either in both prefixes or behind the one that ends first, so their number
    is at most the matches plus what that set has left: n - prefix = ceil(t n) - k. Similar sets
    of these sizes need ceil(t / (1 + t) (n_a + n_b)).
    """
    left = [F.ceil(F.col(n) * NUMERATOR / DENOMINATOR) - F.col(k) for n, k in ((n_a, k_a), (n_b, k_b))]
    needed = F.ceil((F.col(n_a) + F.col(n_b)) * NUMERATOR / (NUMERATOR + DENOMINATOR) - 1e-9)
    return (matches >= F.least(k_a, k_b)) & (matches + F.greatest(*left) >= needed)


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose sets reach the threshold, by their whole texts."""
    ends = store(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "ends")
    texts = texts.join(ends, "node", "left_semi")
    left = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
    both = left.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for half in T.blocks(batch, "ta"):
                for part in T.blocks(half, "tb"):
                    x, at_x = shingle_sets(*T.texts(part.column("ta")))
                    y, at_y = shingle_sets(*T.texts(part.column("tb")))
                    spans = zip(at_x[:-1].tolist(), at_x[1:].tolist(), at_y[:-1].tolist(), at_y[1:].tolist(), strict=True)
                    same = np.array([len(np.intersect1d(x[a:b], y[c:d], assume_unique=True)) for a, b, c, d in spans], np.int64)
                    total = np.diff(at_x) + np.diff(at_y) - same
                    yield part.select(["a", "b"]).filter(pa.array(DENOMINATOR * same >= NUMERATOR * total))

    return map_arrow(both.select("a", "b", "ta", "tb"), run, "a long, b long")


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return rows.withColumn("label", F.col("node"))
    return rows.join(labels, "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root")


def _hub_pairs(rows: DataFrame, round_: int) -> DataFrame:
    """For each node some hubs of other labels: of its lists' hubs those met most often.

    Every other hub is drawn from the nodes with the least `rank`: the middle of a group of edited copies is
    similar to all of them, while two copies need not be to one another. Lists of shingles with many hits (`salt` above 0)
    are summed up in every task first; any other list is short.
    """

    def hub(i: int):
        first = (F.col("rank") if i % 2 == 0 else F.lit(0)).cast("int")
        order = F.struct(first.alias("r"), F.xxhash64(F.col("node"), F.lit(HUBS * round_ + i)).alias("x"))
        return F.min(F.struct(order.alias("h"), "node", "n", "k", "label"))

    told = {"low": F.min("label"), "high": F.max("label"), "hubs": F.array(*[hub(i) for i in range(HUBS)])}
    held = ("token", "node", "n", "k", "label")
    # most lists have two or three rows, fewer than hubs: their rows travel, once, instead of hubs found in every task
    whole = Window.partitionBy("token")
    ends = {c: told[c].over(whole) for c in ("low", "high")}
    found = F.array(*[hub(i).over(whole) for i in range(HUBS)])
    short = rows.where("salt = 0").withColumns(ends).where("low < high").withColumn("hubs", found).select(*held, "hubs")
    long_ = rows.where("salt > 0")
    lists = long_.groupBy("token").agg(*[x.alias(c) for c, x in told.items()])
    lists = store(lists.where("low < high").select("token", "hubs"), "lists")
    met = short.unionByName(long_.join(lists.hint("merge"), "token").select(*held, "hubs")).select(
        "node", "n", "k", "label", F.explode(F.array_distinct(F.transform("hubs", lambda h: h.dropFields("h")))).alias("hub")
    )
    met = met.select(
        "node", "n", "k", "label", F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n"),
        F.col("hub.k").alias("hub_k"), F.col("hub.label").alias("hub_label"),
    )
    other = met.where((F.col("label") != F.col("hub_label")) & similar_size("n", "hub_n"))
    long = lambda c: F.col(c).cast("long")
    sizes = F.shiftleft(long("n"), 34) + F.shiftleft(long("k"), 31) + F.shiftleft(long("hub_n"), 3) + long("hub_k")
    counted = other.groupBy("node", "hub").agg(F.count("*").alias("matches"), F.first(sizes).alias("sizes"))
    packed = F.col("sizes")
    counted = counted.select(
        "node", "hub", "matches", F.shiftright(packed, 34).alias("n"), F.shiftright(packed, 31).bitwiseAND(7).alias("k"),
        F.shiftright(packed, 3).bitwiseAND((1 << 28) - 1).alias("hub_n"), packed.bitwiseAND(7).alias("hub_k"),
    ).where(enough_matches("n", "k", "hub_n", "hub_k", F.col("matches")))
    best = F.slice(F.sort_array(F.collect_list(F.struct("matches", "hub")), asc=False), 1, HUBS)
    chosen = counted.groupBy("node").agg(best.alias("hubs")).select("node", F.explode("hubs.hub").alias("hub"))
    return chosen.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def _overlap(n_a: str, n_b: str) -> Column:
    """Common shingles that similar sets of these sizes need."""
    return F.ceil((F.col(n_a) + F.col(n_b)) * NUMERATOR / (NUMERATOR + DENOMINATOR) - 1e-9)


def _remaining_pairs(rows: DataFrame, described_rows: DataFrame) -> DataFrame:
    """Every pair of different labels that shares enough prefix shingles.

    Sets that need `o` common shingles hold the first one of them among their first n - o + 1, and for the smaller
    set that is a seventh of it. So only the ends of lists that both places allow become pairs; what two
    heavily edited copies share lies behind their own shingles and makes none. In each list only nodes outside of its most
    frequent label are paired, with all of other labels. Bitmaps rule out what they can, and what is left is
    counted over its whole prefixes, each a list beside its pair: one row a pair, however much two sets share.
    """
    by_label = rows.groupBy("token", "label").agg(F.count("*").alias("c"))
    lists = by_label.groupBy("token").agg(
        F.count("*").alias("labels"), F.max_by("label", F.struct("c", "label")).alias("main")
    ).where("labels > 1").select("token", "main")
    there = store(rows.join(store(lists, "lists").hint("merge"), "token").select("token", "node", "n", "place", "label", "main"), "listed")
    smaller = there.where(F.col("place") < F.col("n") - F.ceil(F.col("n") * 2 * NUMERATOR / (NUMERATOR + DENOMINATOR) - 1e-9) + 1)
    smaller = smaller.select("token", *[F.col(c).alias(f"x_{c}") for c in ("node", "n", "place", "label", "main")])
    meets = (
        (F.col("x_label") != F.col("label"))
        & ((F.col("x_n") < F.col("n")) | ((F.col("x_n") == F.col("n")) & (F.col("x_node") < F.col("node"))))
        & (F.col("x_n") * DENOMINATOR >= F.col("n") * NUMERATOR)
        & (F.col("x_place") < F.col("x_n") - _overlap("x_n", "n") + 1)
        & (F.col("place") < F.col("n") - _overlap("x_n", "n") + 1)
    )
    pair = F.col("x_node").alias("a"), F.col("node").alias("b")
    one = smaller.where("x_label != x_main").join(there, "token").where(meets).select(*pair)
    other = smaller.where("x_label = x_main").join(there.where("label != main"), "token").where(meets).select(*pair)
    met = store(one.unionByName(other).distinct(), "met")
    pairs = store(possible(met, described_rows), "possible")
    release(rows.sparkSession)
    ends = store(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "ends")
    whole = rows.join(ends.hint("merge"), "node", "left_semi").groupBy("node").agg(
        F.collect_set("token").alias("tokens"), F.first("n").alias("n"), F.first("k").alias("k")
    )
    whole = store(whole, "whole-prefixes")
    of = {side: whole.select(*[F.col(c).alias(f"{side}_{c}") for c in whole.columns]).hint("merge") for side in "ab"}
    both = pairs.join(of["a"], F.col("a") == F.col("a_node")).join(of["b"], F.col("b") == F.col("b_node"))
    counted = both.withColumn("matches", F.size(F.array_intersect("a_tokens", "b_tokens")))
    return counted.where(enough_matches("a_n", "a_k", "b_n", "b_k", F.col("matches"))).select("a", "b")


def near_duplicates(docs: DataFrame, hub_rounds: int = HUB_ROUNDS) -> DataFrame:
    """(_row, doc_id, n_shingles, component_id) for every row of `docs`, a stored table; `_row` is `number_rows`' name."""
    return _grouped(number_rows(docs.select("doc_id", "text")), hub_rounds)


def _grouped(numbered: DataFrame, hub_rounds: int = HUB_ROUNDS) -> DataFrame:
    described_rows = described(numbered)
    texts_of = described_rows.where("_row IS NOT NULL").select("_row", "doc_id", "n", "node")
    named = settled(numbered.sparkSession, "named", lambda: _components(numbered, described_rows, hub_rounds))
    return texts_of.join(named, "node", "left").select(
        "_row", "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def _components(numbered: DataFrame, described_rows: DataFrame, hub_rounds: int) -> DataFrame:
    """(node, component_id) of every set that is not empty."""
    spark = numbered.sparkSession
    texts_of = described_rows.where("_row IS NOT NULL")
    common = common_shingles(described_rows)
    rows = settled(spark, "ranked", lambda: shared_prefixes(numbered, common))

    one = texts_of.where("node IS NOT NULL").groupBy("node").agg(F.min("_row").alias("_row"))
    needed = one.join(rows.select("node").distinct(), "node", "left_semi")
    texts = store(numbered.select("_row", "text").join(needed.hint("merge"), "_row").select("node", "text"), "texts")
    release(spark)

    links, labels = None, None
    for round_ in range(hub_rounds + 1):
        known = _labelled(rows, labels)
        if round_ < hub_rounds:
            pairs = settled(spark, "pairs", partial(_hub_pairs, known, round_))
            pairs = settled(spark, "possible", partial(possible, pairs, texts_of))
        else:
            pairs = settled(spark, "pairs", partial(_remaining_pairs, known, texts_of))
        found = settled(spark, "verified", partial(verified, pairs, texts))
        links = found if links is None else links.unionByName(found)
        labels = components(links, 1 if round_ < hub_rounds - 1 else None)
        release(spark)

    nodes = texts_of.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least"))
    rooted = _labelled(nodes, labels)
    least = store(rooted.groupBy("label").agg(F.min("least").alias("component_id")), "least")
    return rooted.join(least, "label").select("node", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of a stored table without all but one of each group: least id, then first row.

    Only row numbers are compared and sent back; a text moves once, to meet its verdict.
    """
    packed = number_rows(pack_rest(docs, "text"))
    found = _grouped(packed.select("_row", F.col(REST).getField("doc_id").alias("doc_id"), "text"))
    grouped = found.where("n_shingles > 0")
    lead = grouped.groupBy("component_id").agg(F.min(F.struct("doc_id", "_row")).alias("lead")).select("lead._row")
    alone = found.where("n_shingles = 0").select("_row")
    kept = store(lead.unionByName(alone), "kept")
    release(docs.sparkSession)
    return packed.join(kept.hint("merge"), "_row", "left_semi").select(*rest_of(docs.columns, ("text",)))
