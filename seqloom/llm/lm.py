"""Cross-entropy difference: how much better a target model predicts a text than a background model.

Both models are interpolated word bigram models over one vocabulary: words and bigrams that the background
holds at least twice, at any size. Other words are the unknown word, and other bigrams leave their mass to the
unigram part. Rows are taken in blocks of bounded bytes. Every block asks for totals of its own sorted names, cut by range
into parts: of its words, of its bigrams, and of the kept bigrams behind each word. A part sums what all blocks ask and
answers each by place, so no name travels back. A word's answer holds its number in the vocabulary; bigrams are named by two
such numbers, exactly. Sorted numbers travel as compressed differences, far smaller than rows of a table.

Defined results: a null text or one without words has n_words 0 and null losses and score; equal
texts get equal scores; without target words (or an empty table) the target model is uniform; columns
other than the key and the text are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.llm import tokens as T
from seqloom.llm.shipping import map_arrow, ship
from seqloom.llm.store import number_rows, release, settled, store

#: Occurrences in the background that a word and a bigram need, at any size.
LEAST = 2
INTERPOLATION = 0.7
#: Distinct keys a task merges before it hands them on.
TASK_KEYS = 2_000_000
#: Blocks hold texts of like size: (bytes up to which, bits of their rows' places); longer texts are blocks of their own.
TIERS = ((1 << 12, 11), (1 << 15, 8), (1 << 18, 5))
#: Bytes of text for each part of the names, and bits of the number of parts at least.
PART_BYTES, LEAST_PART_BITS = 1 << 25, 4
#: Numbers that stand for the unknown word and the start of a text; known words follow.
UNKNOWN, START, SPECIAL = 0, 1, 2
#: Rows of a block: one per scored text, and one of all its words in order.
DOC, CODES = 0, 1
BIGRAMS, FOLLOWED = 0, 1
BACKGROUND, TARGET, SCORED = 1, 2, 4
_CLOSING = np.isin(np.arange(256), np.frombuffer(b".,;:!?", np.uint8))


def lm_words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets) of lower-cased words without closing punctuation."""
    data = T.lower_ascii(data)
    starts, ends, of_text = T.words(data, at)
    for _ in range(2):
        ends = ends - (_CLOSING[data[ends - 1]] & (ends - starts > 1)) if len(ends) else ends
    return T.word_hashes(data, starts, ends), of_text


def merged_counts(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, with the sum of its counts."""
    key, which = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(which, np.concatenate(counts), len(key)).astype(np.int64)


def pack(x: np.ndarray) -> bytes:
    """Numbers of 0 and more: how many, the bytes each takes, then all lowest bytes, all second bytes and so on, compressed."""
    x = np.ascontiguousarray(x).astype("<u8", copy=False)
    width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    planes = x.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    return len(x).to_bytes(8, "little") + bytes([width]) + pa.compress(planes, "zstd", asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    n, width = int.from_bytes(data[:8], "little"), data[8]
    planes = np.frombuffer(pa.decompress(data[9:], n * width, "zstd", asbytes=True), np.uint8).reshape(width, n)
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").reshape(-1)


def pack_sorted(x: np.ndarray, base: int = 0) -> bytes:
    """Ascending numbers from `base` on, by their differences."""
    return pack(np.diff(x.astype(np.uint64, copy=False), prepend=np.uint64(base)))


def unpack_sorted(data: bytes, base: int = 0) -> np.ndarray:
    x = unpack(data)
    if len(x):
        x[0] += np.uint64(base)
    return np.cumsum(x, dtype=np.uint64)


@dataclass(frozen=True)
class Parts:
    """Names of `width` bits, cut into parts by their first `bits` bits."""

    width: int
    bits: int

    def base(self, part: int) -> int:
        return part << (self.width - self.bits)

    def cut(self, names: np.ndarray) -> list[tuple[int, int, int]]:
        """(part, start, end) of the parts that sorted names lie in."""
        part = (names >> np.uint64(self.width - self.bits)).astype(np.int64)
        found, start = np.unique(part, return_index=True)
        return list(zip(found.tolist(), start.tolist(), np.append(start, len(names))[1:].tolist(), strict=True))


_ODD = 0x9E3779B97F4A7C15


def scrambled(x: np.ndarray, width: int) -> np.ndarray:
    """Numbers of `width` bits one to one onto such numbers, so that every part gets its share of a frequent word's bigrams."""
    for _ in range(2):
        x = (x * np.uint64(_ODD)) & np.uint64((1 << width) - 1)
        x = x ^ (x >> np.uint64((width + 1) // 2))
    return x


def unscrambled(x: np.ndarray, width: int) -> np.ndarray:
    for _ in range(2):
        x = x ^ (x >> np.uint64((width + 1) // 2))
        x = (x * np.uint64(pow(_ODD, -1, 1 << width))) & np.uint64((1 << width) - 1)
    return x


def histories(ids: np.ndarray, of_text: np.ndarray) -> np.ndarray:
    before = np.empty(len(ids), np.int64)
    before[1:] = ids[:-1]
    before[of_text[:-1][np.diff(of_text) > 0]] = START
    return before


def _blocks(frame: DataFrame, no: int, role: int, id_type: str) -> DataFrame:
    """(block, doc_id, text, role) of one corpus; all rows of a block have one role."""
    doc_id = F.col("doc_id") if role & SCORED else F.lit(None).cast(id_type)
    rows = number_rows(frame.select("doc_id", "text") if role & SCORED else frame.select("text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    block = F.shiftleft("_row", 4) + len(TIERS)
    for tier, (most, bits) in reversed(list(enumerate(TIERS))):
        block = F.when(size <= most, F.shiftleft(F.shiftright("_row", bits), 4) + tier).otherwise(block)
    return rows.select((block + no * (len(TIERS) + 1)).alias("block"), doc_id.alias("doc_id"), "text", F.lit(role).alias("role"))


def _rows(columns: dict[str, list | pa.Array], like: pa.Schema) -> pa.Table:
    """A table of `like`; columns that are not given are null."""
    n = len(next(iter(columns.values())))
    made = {c: x if isinstance(x, pa.Array) else pa.array(x, like.field(c).type) for c, x in columns.items()}
    return pa.table([made[c] if c in made else pa.nulls(n, like.field(c).type) for c in like.names], schema=like)


_PACKED = "names binary, x binary, y binary"
REQUESTS = f"block long, role int, at int, {_PACKED}"
WORD_ANSWERS = f"block long, at int, {_PACKED}, n long, held_b long, held_t long"
BIGRAM_ANSWERS = f"{REQUESTS}, what int"
FOLLOWED_ANSWERS = f"block long, at int, {_PACKED}, what int"
BLOCKS = f"block long, role int, kind int, at int, doc_id {{}}, n long, texts long, {_PACKED}, numbers binary, counts binary, lengths binary"
_TYPES = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def _arrow(schema: str, **types: pa.DataType) -> pa.Schema:
    fields = [x.strip().split(" ") for x in schema.split(",")]
    return pa.schema([(name, types.get(name) or _TYPES[kind]) for name, kind in fields])


def _requests(block: int, role: int, parts: Parts, names: np.ndarray, x: np.ndarray, y: np.ndarray | None = None) -> dict[str, list]:
    """Sorted names and what the block adds to them, a row for each part."""
    cut = parts.cut(names)
    return {
        "block": [block] * len(cut), "role": [role] * len(cut), "at": [p for p, _, _ in cut],
        "names": [pack_sorted(names[a:b], parts.base(p)) for p, a, b in cut],
        "x": [pack(x[a:b]) for _, a, b in cut],
        "y": [None if y is None else pack(y[a:b]) for _, a, b in cut],
    }


def _listed(texts: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(a block's different words, the place there of each word in order, how often each occurs, the texts' ranges of words)."""
    hashes, of_text = lm_words(*T.texts(texts.column("text")))
    return *np.unique(hashes, return_inverse=True, return_counts=True), of_text


def _block_of(texts: pa.Table) -> tuple[int, int]:
    return texts.column("block")[0].as_py(), texts.column("role")[0].as_py()


def _word_requests(texts: pa.Table, parts: Parts) -> pa.Table:
    words, _, counts, _ = _listed(texts)
    return _rows(_requests(*_block_of(texts), parts, words, counts), _arrow(REQUESTS))


def _asked(rows: pa.Table, parts: Parts) -> tuple[list[dict], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A part's requests: (rows, sorted different names, which of them each row's are, the rows' ends, the roles of all)."""
    asked = rows.to_pylist()
    base = parts.base(asked[0]["at"])
    names = [unpack_sorted(r["names"], base) for r in asked]
    ends = np.cumsum([0, *map(len, names)])
    key, which = np.unique(np.concatenate(names), return_inverse=True)
    return asked, key, which, ends, np.repeat([r["role"] for r in asked], np.diff(ends))


def _total(which: np.ndarray, x: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(which, x, size).astype(np.int64)


def _counts(asked: list[dict], which: np.ndarray, roles: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(which names the background holds often enough, their counts there and in the target; else 0)."""
    given = np.concatenate([unpack(r["x"]) for r in asked]).astype(np.int64)
    b, t = (_total(which, given * ((roles & r) > 0), size) for r in (BACKGROUND, TARGET))
    kept = b >= LEAST
    return kept, np.where(kept, b, 0), np.where(kept, t, 0)


def _counted_words(rows: pa.Table, parts: Parts) -> pa.Table:
    """Answers: how many kept words of the part are not behind this one, and its counts (b as x, t as y) if it is kept."""
    asked, key, which, ends, roles = _asked(rows, parts)
    kept, b, t = _counts(asked, which, roles, len(key))
    rank = np.cumsum(kept)
    out = {"block": [r["block"] for r in asked], "at": [r["at"] for r in asked], "names": [], "x": [], "y": []}
    for a, e in zip(ends[:-1], ends[1:], strict=True):
        at = which[a:e]
        for c, x in (("names", pack_sorted(rank[at])), ("x", pack(b[at])), ("y", pack(t[at]))):
            out[c].append(x)
    for c, x in (("n", kept), ("held_b", b), ("held_t", t)):  # told once
        out[c] = [int(x.sum()), *[0] * (len(asked) - 1)]
    return _rows(out, _arrow(WORD_ANSWERS))


def _counted_bigrams(rows: pa.Table, vocabulary: Vocabulary) -> pa.Table:
    """Answers to scored blocks: counts of kept bigrams (b as x, t as y); and, as requests, the sums of these by history."""
    asked, key, which, ends, roles = _asked(rows, vocabulary.bigrams)
    kept, b, t = _counts(asked, which, roles, len(key))
    out = {c: [] for c in ("block", "role", "at", "x", "y")}
    for r, a, e in zip(asked, ends[:-1], ends[1:], strict=True):
        if r["role"] & SCORED:
            at = which[a:e]
            for c, x in zip(out, (r["block"], r["role"], r["at"], pack(b[at]), pack(t[at])), strict=True):
                out[c].append(x)
    history, behind = np.unique(vocabulary.history(key[kept]), return_inverse=True)
    sums = _requests(0, 0, vocabulary.words, history, *(_total(behind, x[kept], len(history)) for x in (b, t)))
    made = ((out, BIGRAMS), (sums, FOLLOWED))
    return pa.concat_tables([_rows(x | {"what": [what] * len(x["at"])}, _arrow(BIGRAM_ANSWERS)) for x, what in made])


def _followed(rows: pa.Table, parts: Parts) -> pa.Table:
    """Answers to scored blocks: the counts of all kept bigrams behind a word, in the background (x) and the target (y)."""
    asked, key, which, ends, _ = _asked(rows, parts)
    x, y = (_total(which, _joined([unpack(r[c]) for r in asked]), len(key)) for c in ("x", "y"))
    out = {c: [] for c in ("block", "at", "x", "y")}
    for r, a, e in zip(asked, ends[:-1], ends[1:], strict=True):
        if r["role"] & SCORED:
            for c, v in zip(out, (r["block"], r["at"], pack(x[which[a:e]]), pack(y[which[a:e]])), strict=True):
                out[c].append(v)
    return _rows(out | {"what": [FOLLOWED] * len(out["at"])}, _arrow(FOLLOWED_ANSWERS))


@dataclass(frozen=True)
class Vocabulary:
    """How known words are numbered: by part and by rank within it, behind the special numbers."""

    rank_bits: int
    part_bits: int

    @property
    def words(self) -> Parts:
        size = (1 << (self.rank_bits + self.part_bits)) + SPECIAL
        return Parts((size - 1).bit_length(), self.part_bits)

    @property
    def bigrams(self) -> Parts:
        if 2 * self.words.width > 64:
            raise OverflowError("two numbers of words must fit 64 bits: the vocabulary is too large")
        return Parts(2 * self.words.width, self.part_bits)

    def numbers(self, part: int, rank: np.ndarray) -> np.ndarray:
        return (np.uint64(part << self.rank_bits) | (rank - np.uint64(1))) + np.uint64(SPECIAL)

    def names(self, history: np.ndarray, word: np.ndarray) -> np.ndarray:
        return scrambled((history << np.uint64(self.words.width)) | word, self.bigrams.width)

    def history(self, names: np.ndarray) -> np.ndarray:
        return unscrambled(names, self.bigrams.width) >> np.uint64(self.words.width)


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)


def _coded(texts: pa.Table, answers: pa.Table, vocabulary: Vocabulary) -> pa.Table:
    """A block's scored texts, and its words in order as places in the list of its numbers, the commonest first."""
    _, which, counts, of_text = _listed(texts)
    got = sorted(answers.to_pylist(), key=lambda r: r["at"])
    b, t = (_joined([unpack(r[c]) for r in got]) for c in ("x", "y"))
    known = b > 0
    ids = np.where(known, np.cumsum(known) - 1 + SPECIAL, UNKNOWN)[which]
    numbers = [vocabulary.numbers(r["at"], unpack_sorted(r["names"])) for r in got]
    numbers = np.concatenate([np.array([UNKNOWN, START], np.uint64), *numbers])[np.concatenate([[True] * SPECIAL, known])]
    times = np.concatenate([[int(counts[~known].sum()), 0], counts[known]])
    place = np.empty(len(times), np.int64)
    place[_order(times)] = np.arange(len(times))
    (block, role), lengths = _block_of(texts), np.diff(of_text)
    schema = _arrow(BLOCKS.format("any"), doc_id=texts.schema.field("doc_id").type)
    b, t = (np.concatenate([np.zeros(SPECIAL, np.int64), x[known]]) * bool(role & SCORED) for x in (b, t))
    code = {"block": [block], "role": [role], "kind": [CODES], "n": [len(which)], "texts": [int((lengths > 0).sum())],
            "names": [pack(place[ids])], "x": [pack(b)], "y": [pack(t)], "numbers": [pack_sorted(numbers)], "counts": [pack(times)],
            "lengths": [pack(lengths)]}
    n = len(lengths) if role & SCORED else 0
    docs = {"block": [block] * n, "role": [role] * n, "kind": [DOC] * n, "at": list(range(n))}
    return pa.concat_tables([_rows(code, schema), _rows(docs | {"doc_id": texts.column("doc_id").combine_chunks()[:n]}, schema)])


def _order(times: np.ndarray) -> np.ndarray:
    return np.argsort(-times.astype(np.int64), kind="stable")


@dataclass
class Block:
    """A block's words as places in `numbers`, which begin with the unknown word and the start."""

    ids: np.ndarray
    before: np.ndarray
    of_text: np.ndarray
    numbers: np.ndarray

    def bigrams(self, vocabulary: Vocabulary) -> np.ndarray:
        return vocabulary.names(self.numbers[self.before], self.numbers[self.ids])


def _block(code: dict) -> Block:
    ids = _order(unpack(code["counts"]))[unpack(code["names"]).astype(np.int64)]
    of_text = np.concatenate([[0], np.cumsum(unpack(code["lengths"]).astype(np.int64))])
    return Block(ids, histories(ids, of_text) if len(ids) else ids, of_text, unpack_sorted(code["numbers"]))


def _bigram_requests(code: dict, vocabulary: Vocabulary) -> dict[str, list]:
    names, counts = np.unique(_block(code).bigrams(vocabulary), return_counts=True)
    return _requests(code["block"], code["role"], vocabulary.bigrams, names, counts)


def _followed_requests(code: dict, vocabulary: Vocabulary) -> dict[str, list]:
    numbers = unpack_sorted(code["numbers"])
    none = np.zeros(len(numbers), np.int64)
    return _requests(code["block"], code["role"], vocabulary.words, numbers, none, none)


@dataclass
class Whole:
    """What the models hold besides their tables; the target is first, the background second."""

    totals: tuple[int, int]
    vocabulary: int
    #: Counts of the unknown word and of starts.
    unknown: tuple[int, int]
    starts: tuple[int, int]


def _losses(mine: Block, code: dict, answers: pa.Table, vocabulary: Vocabulary, whole: Whole) -> tuple[np.ndarray, np.ndarray]:
    """Each word's loss under both models."""
    _, which = np.unique(mine.bigrams(vocabulary), return_inverse=True)
    got = sorted(answers.to_pylist(), key=lambda r: r["at"])
    out = []
    for m, c in enumerate(("y", "x")):
        n = unpack(code[c]).astype(np.int64)
        n[UNKNOWN], n[START] = whole.unknown[m], whole.starts[m]
        followed, held = (_joined([unpack(r[c]) for r in got if r["what"] == what]) for what in (FOLLOWED, BIGRAMS))
        unigram = (n + 1.0) / (whole.totals[m] + whole.vocabulary + 1)
        share = INTERPOLATION / np.maximum(n, 1) * (n > 0)
        backoff = np.maximum(1.0 - share * followed, 1e-6)
        out.append(-np.log(backoff[mine.before] * unigram[mine.ids] + share[mine.before] * held[which]))
    return out[0], out[1]


def _scores(block: pa.Table, answers: pa.Table, vocabulary: Vocabulary, whole: Whole) -> pa.Table:
    docs = block.filter(pc.equal(block.column("kind"), DOC)).sort_by("at")
    code = block.drop_columns("doc_id").filter(pc.equal(block.column("kind"), CODES)).to_pylist()[0]
    mine = _block(code)
    n = np.diff(mine.of_text)
    both = _losses(mine, code, answers, vocabulary, whole)
    row = T.owners(mine.of_text)
    t, b = (np.bincount(row, x, len(n)) / np.maximum(n, 1) for x in both)
    empty = n == 0
    return pa.table(
        [docs.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(t, mask=empty), pa.array(b, mask=empty),
         pa.array(t - b, mask=empty)],
        names=["doc_id", "n_words", "target_loss", "background_loss", "score"],
    )


def _asking(blocks: DataFrame, roles: int, requests: Callable[[dict], dict[str, list]]) -> DataFrame:
    """What every block of these roles asks for, one block after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from _rows(requests(batch.slice(i, 1).to_pylist()[0]), _arrow(REQUESTS)).to_batches()

    codes = blocks.where((F.col("kind") == CODES) & (F.col("role").bitwiseAND(roles) > 0))
    return map_arrow(codes.select("block", "role", "names", "numbers", "counts", "lengths"), run, REQUESTS)


def _scored(docs: DataFrame, target: DataFrame, background: DataFrame | None) -> DataFrame:
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    texts = _blocks(docs, 0, SCORED | (BACKGROUND if background is None else 0), kind).unionByName(_blocks(target, 1, TARGET, kind))
    if background is not None:
        texts = texts.unionByName(_blocks(background, 2, BACKGROUND, kind))
    zero = F.lit(0)
    frames = [docs, target] if background is None else [docs, target, background]
    size = sum(f.agg(F.coalesce(F.sum(F.octet_length("text")), zero)).first()[0] for f in frames)
    bits = max(LEAST_PART_BITS, (size // PART_BYTES).bit_length())
    hashes = Parts(64, bits)
    release(spark)  # what the caller's last job left; Spark holds on to a job's shuffles for a moment after its end, so this comes late

    ship(spark)
    asked = texts.groupBy("block").applyInArrow(lambda block: _word_requests(block, hashes), REQUESTS)
    words = store(asked.groupBy("at").applyInArrow(lambda rows: _counted_words(rows, hashes), WORD_ANSWERS), "words")
    held = words.agg(F.coalesce(F.max("n"), zero), *[F.coalesce(F.sum(c), zero) for c in ("n", "held_t", "held_b")]).first()
    release(spark)
    vocabulary = Vocabulary(max(1, int(held[0]).bit_length()), bits)
    given = words.select("block", "at", "names", "x", "y").groupBy("block")
    coded = texts.groupBy("block").cogroup(given).applyInArrow(lambda block, got: _coded(block, got, vocabulary), BLOCKS.format(kind))
    blocks = store(coded, "blocks")
    sums = [F.coalesce(F.sum(F.when(F.col("role").bitwiseAND(role) > 0, F.col(c))), zero) for c in ("n", "texts") for role in (TARGET, BACKGROUND)]
    t, b, t_starts, b_starts = blocks.where(F.col("kind") == CODES).agg(*[x.alias(f"s{i}") for i, x in enumerate(sums)]).first()
    release(spark)
    whole = Whole((t, b), held[1], (t - held[2], b - held[3]), (t_starts, b_starts))

    asked = _asking(blocks, BACKGROUND | TARGET | SCORED, lambda code: _bigram_requests(code, vocabulary))
    bigrams = store(asked.groupBy("at").applyInArrow(lambda rows: _counted_bigrams(rows, vocabulary), BIGRAM_ANSWERS), "bigrams")
    release(spark)
    by_history = bigrams.where(F.col("what") == FOLLOWED).drop("what")
    asked = by_history.unionByName(_asking(blocks, SCORED, lambda code: _followed_requests(code, vocabulary)))
    numbers = vocabulary.words
    followed = store(asked.groupBy("at").applyInArrow(lambda rows: _followed(rows, numbers), FOLLOWED_ANSWERS), "followed")
    release(spark)

    mine = blocks.where(F.col("role").bitwiseAND(SCORED) > 0).drop("role", "n", "texts")
    given = bigrams.where(F.col("what") == BIGRAMS).drop("role").unionByName(followed)
    return mine.groupBy("block").cogroup(given.groupBy("block")).applyInArrow(
        lambda block, got: _scores(block, got, vocabulary, whole),
        f"doc_id {kind}, n_words long, target_loss double, background_loss double, score double",
    )


def labelled_target(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The texts labelled good and not toxic, stored: the corpus others are to resemble.

    Labels grow with the corpus, so they are never broadcast, however small they happen to be.
    """
    good = labels.where("quality = 1 AND coalesce(toxic, 0) = 0").select("doc_id").hint("merge")
    target = store(docs.select("doc_id", "text").join(good, "doc_id", "left_semi").select("text"), "target")
    release(docs.sparkSession)
    return target


def cross_entropy_difference(docs: DataFrame, target: DataFrame, background: DataFrame | None = None) -> DataFrame:
    """(doc_id, n_words, target_loss, background_loss, score) in nats a word; low scores are like the target.

    Every frame is read several times and should be stored.
    """
    return settled(docs.sparkSession, "scores", lambda: _scored(docs, target, background))
