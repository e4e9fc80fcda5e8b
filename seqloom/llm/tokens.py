"""Whole batches of texts as flat byte arrays: words, word hashes, ragged gathers.

Helpers for the operators that run inside `mapInArrow`. They see only the texts of one Arrow batch,
cut into blocks of bounded bytes at row boundaries (a longer text is a block of its own).
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 4 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_TABLE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C13  # odd, 3 mod 8
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept and grown per process."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        full = np.full(size, base, np.uint64)
        full[0] = 1
        have = _powers[base] = np.multiply.accumulate(full, dtype=np.uint64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def fold(values: np.ndarray) -> np.ndarray:
    """Prefix sums from which `span_hash` takes the hash of any span of `values`."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(_BASE, len(values)), out=out[1:])
    return out


def span_hash(folded: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of values[start:end], equal for equal spans wherever they stand."""
    return mix((folded[end] - folded[start]) * powers(_INVERSE, len(folded))[start])


def byte_values(data: np.ndarray) -> np.ndarray:
    return _TABLE[data]


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[at[0] : at[-1]]
    return data, at - at[0]


def blocks(batch: pa.RecordBatch, column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with about `limit` bytes of text in all."""
    _, at = texts(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(at, at[start] + limit, "right")) - 1)
        yield batch.slice(start, end - start)
        start = end


def gathered(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Consecutive batches put together until they hold `limit` bytes of text."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += int(texts(batch.column(column))[1][-1])
        if size >= limit:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, offsets): the words' byte spans, and each text's range of words."""
    inside = ~_SPACE[data]
    edges = at[(at > 0) & (at < len(data))]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    before[edges] = False
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, at)


#: Words from this many bytes on are hashed one by one.
LONG_WORD = 512
_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _eights(data: np.ndarray) -> np.ndarray:
    """At every place of `data` the number that its next eight bytes make (zeros behind the end)."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans: eight bytes at a time are mixed in, so no pattern of bytes cancels out."""
    size = ends - starts
    out = mix(size.astype(np.uint64) + np.uint64(_BASE))
    eights = _eights(data)
    left = np.flatnonzero(size < LONG_WORD)
    done = 0
    while len(left):
        part = eights[starts[left] + done] & _LOW_BYTES[np.minimum(size[left] - done, 8)]
        out[left] = mix((out[left] ^ part) * np.uint64(_BASE))
        done += 8
        left = left[size[left] > done]
    long = np.flatnonzero(size >= LONG_WORD)
    if len(long):
        raw = data.tobytes()
        spans = zip(starts[long].tolist(), ends[long].tolist(), strict=True)
        out[long] = [int.from_bytes(blake2b(raw[a:b], digest_size=8).digest(), "little") for a, b in spans]
    return out


def same_bytes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Which spans of `data` hold the same bytes as the spans of their sizes in `other`, from its places `others` on."""
    size, mine, theirs = ends - starts, _eights(data), _eights(other)
    out = np.ones(len(starts), bool)
    left, done = np.arange(len(starts)), 0
    while len(left):
        behind = others[left] + done
        low = _LOW_BYTES[np.minimum(size[left] - done, 8)]
        out[left] &= ((mine[starts[left] + done] ^ theirs[np.minimum(behind, len(other))]) & low) == 0
        done += 8
        left = left[size[left] > done]
    return out


def owners(offsets: np.ndarray) -> np.ndarray:
    """For ranges given by offsets, the range each element belongs to."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenated indices start, start+1, ... of every (start, length)."""
    total = int(lengths.sum())
    first = np.cumsum(lengths) - lengths
    return np.repeat(starts - first, lengths) + np.arange(total)


def list_array(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))
