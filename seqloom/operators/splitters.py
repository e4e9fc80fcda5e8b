"""Bucket numbers that rise with an order key and hold a bounded number of rows each.

The key space is a list of pieces between literal splitters, each cut evenly into cells. Rows are counted per cell;
only overfull cells get splitters of their own, from a sample of their keys, until no cell is overfull. So regular
keys need one piece whatever their number, and splitters grow with what is irregular, not with the data.

A key is one integer column, or else `binary_key`: bytes that sort as the columns do. In both cases a
bucket is a plain expression, the same in every execution, and nothing is written.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows that one bucket is meant to hold; it may come to twice as many.
BUCKET_ROWS = 1 << 20
# Splitters that a plan may hold; keys more irregular than that are for a range sort.
MOST_PIECES = 1024
# Sampled keys for each bucket that is wanted, and in all at a time.
SAMPLED, MOST_SAMPLED = 32, 1 << 15
# Pieces that one overfull cell is cut into at a time.
FAN = 32
ROUNDS = 16
WORD = 7

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_KEY, _GROUP, _PIECE = "__key", "__group", "__piece"
_LAST = 1 << 63


class IrregularKeysError(RuntimeError):
    """The keys need more splitters than a plan should hold."""


@dataclass(frozen=True)
class Piece:
    """The keys from `start` up to the next piece's, in even cells of `width` words; `skip` bytes are common to all."""

    start: int | bytes
    cells: int = 1
    base: int = 0
    width: int = 1
    skip: int = 0


def _word(key: bytes, skip: int) -> int:
    return int.from_bytes(key[skip : skip + WORD].ljust(WORD, b"\0"), "big")


def _piece(start: int | bytes, stop: int | bytes, cells: int) -> Piece:
    """A piece with up to so many cells; `stop` is the next piece's start, or the largest key."""
    if isinstance(start, int):
        base, span, skip = start, max(stop - start, 1), 0
    else:
        skip = next((i for i, (a, b) in enumerate(zip(start, stop, strict=False)) if a != b), min(len(start), len(stop)))
        base = _word(start, skip)
        span = _word(stop, skip) - base + 1
    if cells <= 1 or span <= 1 or span >= 1 << 62:
        return Piece(start)
    width = -(-span // cells)
    return Piece(start, -(-span // width), base, width, skip)


def _cell_start(piece: Piece, cell: int) -> int | bytes:
    word = piece.base + cell * piece.width
    if cell == 0:
        return piece.start
    return word if isinstance(piece.start, int) else piece.start[: piece.skip] + word.to_bytes(WORD, "big")


class Splitters:
    """A rising function from keys to bucket numbers, as literals."""

    def __init__(self, pieces: list[Piece], top: int | bytes):
        self.pieces, self.top = pieces, top
        self.first = [0]
        for piece in pieces:
            self.first.append(self.first[-1] + piece.cells)

    def apply(self, df: DataFrame, key: Column, name: str) -> DataFrame:
        """`df` with the bucket of `key`; a null key's is before all others."""
        if len(self.pieces) == 1 and self.pieces[0].cells == 1:
            return df.withColumn(name, F.when(key.isNull(), F.lit(-1)).otherwise(F.lit(0)).cast("long"))

        def pick(low: int, high: int) -> Column:
            if high - low == 1:
                return F.lit(low)
            half = (low + high) // 2
            return F.when(key < F.lit(self.pieces[half].start), pick(low, half)).otherwise(pick(half, high))

        def of(values: list[int], kind: str = "bigint") -> Column:
            listed = F.expr(f"array({', '.join(f'CAST({v} AS {kind})' for v in values)})")
            return F.get(listed, F.col(_PIECE))

        word = key.cast("long")
        if isinstance(self.top, bytes):
            part = F.substring(key, of([p.skip + 1 for p in self.pieces], "int"), F.lit(WORD))
            word = F.conv(F.hex(F.rpad(part, F.lit(WORD), F.lit(b"\0"))), 16, 10).cast("long")
        cells = of([p.cells for p in self.pieces])
        away = F.greatest(word - of([p.base for p in self.pieces]), F.lit(0))
        cell = F.least(cells - 1, F.call_function("div", away, of([p.width for p in self.pieces])))
        bucket = of(self.first[:-1]) + F.when(cells == 1, F.lit(0).cast("long")).otherwise(cell)
        placed = df.withColumn(_PIECE, F.when(key.isNotNull(), pick(0, len(self.pieces))))
        return placed.withColumn(name, F.coalesce(bucket, F.lit(-1).cast("long"))).drop(_PIECE)

    def range_of(self, bucket: int) -> tuple[int, int, int | bytes, int | bytes]:
        """(piece, cell, first key of the bucket, first key after it)."""
        at = bisect_right(self.first, bucket) - 1
        piece, cell = self.pieces[at], bucket - self.first[at]
        end = self.pieces[at + 1].start if at + 1 < len(self.pieces) else self.top
        return at, cell, _cell_start(piece, cell), end if cell == piece.cells - 1 else _cell_start(piece, cell + 1)

    def split(self, wanted: dict[int, list]) -> Splitters:
        """New splitters inside some buckets: (number of cells, sorted splitters) for each."""
        made: list[Piece] = []
        for at, piece in enumerate(self.pieces):
            stop = self.pieces[at + 1].start if at + 1 < len(self.pieces) else self.top
            starts = [(piece.start, 0)]  # (key, cells of the old piece before it)
            inner: dict = {}
            for bucket in (b for b in wanted if self.first[at] <= b < self.first[at + 1]):
                _, cell, low, high = self.range_of(bucket)
                cells, edges = wanted[bucket]
                edges = [low, *[e for e in edges if low < e < high]]
                for edge in edges:
                    inner[edge] = max(1, -(-cells // len(edges)))
                if cell < piece.cells - 1:
                    starts.append((high, cell + 1))
                starts.append((low, cell))
            cuts = dict(starts)
            keys = sorted({*cuts, *inner})
            for i, key in enumerate(keys):
                end = keys[i + 1] if i + 1 < len(keys) else stop
                if key in inner:
                    made.append(_piece(key, end, inner[key]))
                else:
                    after = min((c for k, c in starts if k > key), default=piece.cells)
                    made.append(_piece(key, end, after - cuts[key]))
        return Splitters(made, self.top)


def binary_key(df: DataFrame, columns: list[str]) -> Column | None:
    """Bytes whose order is that of the columns, nulls first; None where a type has no such form."""
    parts = [_encoded(F.col(f"`{c}`"), df.schema[c].dataType) for c in columns]
    if any(p is None for p in parts):
        return None
    return F.concat(*parts)


def _encoded(column: Column, kind: T.DataType) -> Column | None:
    if isinstance(kind, T.BooleanType):
        column, kind = column.cast("int"), T.IntegerType()
    elif isinstance(kind, T.DateType):
        column, kind = F.unix_date(column), T.IntegerType()
    elif isinstance(kind, T.TimestampType):
        column, kind = F.unix_micros(column), T.LongType()
    elif isinstance(kind, T.DecimalType) and kind.precision <= 18:
        column, kind = (column * F.lit(Decimal(10**kind.scale))).cast("long"), T.LongType()
    if isinstance(kind, INTEGRAL):
        shifted = column.cast("long").bitwiseXOR(F.lit(-_LAST))
        value = F.unhex(F.lpad(F.hex(shifted), 16, "0"))
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        value = F.unhex(_ordered_double(column.cast("double")))
    elif isinstance(kind, T.StringType) and kind == T.StringType():
        zero = F.lit("\0")
        value = F.concat(F.replace(column, zero, F.lit("\0\1")), F.lit("\0\0")).cast("binary")
    elif isinstance(kind, T.BinaryType):
        value = F.concat(F.hex(column), F.lit("\0")).cast("binary")
    else:
        return None
    return F.when(column.isNull(), F.lit(b"\0")).otherwise(F.concat(F.lit(b"\1"), value))


def _ordered_double(x: Column) -> Column:
    """18 hex digits that rise with a double: sign, exponent, mantissa; NaN after infinity, the two zeros equal."""
    text = F.format_string("%a", F.abs(x))
    exponent = F.regexp_extract(text, r"p(-?\d+)$", 1).cast("int") + 1100
    normal = F.regexp_extract(text, r"^0x(\d)\.", 1)
    mantissa = F.rpad(F.regexp_extract(text, r"\.([0-9a-f]+)p", 1), 13, "0")
    digits = F.concat(F.lpad(F.hex(exponent), 3, "0"), normal, mantissa)
    size = F.when(F.abs(x) == float("inf"), F.lit("F" * 17)).otherwise(F.upper(digits))
    below = F.translate(size, "0123456789ABCDEF", "FEDCBA9876543210")
    signed = F.when(x == 0, F.lit("8" + "0" * 17)).when(x < 0, F.concat(F.lit("0"), below)).otherwise(F.concat(F.lit("8"), size))
    return F.when(F.isnan(x), F.lit("F" * 18)).otherwise(signed)


def splitters(
    keys: DataFrame, key: Column, integral: bool, by: list[str], bucket_rows: int = BUCKET_ROWS, ties: bool = False
) -> Splitters | None:
    """Splitters under which no (group, bucket) holds more than twice `bucket_rows` rows, if groups have unique keys.

    With `ties` keys may repeat: None where equal keys, or nulls, are too many for one bucket.

    One job reads the key's ends and count. Only beyond two buckets' rows others sample it and count the cells,
    again for as long as a cell is overfull; the driver sees splitters and overfull cells, no more than
    `MOST_PIECES` of them. `IrregularKeysError` means that they would not do.
    """
    group = F.xxhash64(*by) if by else F.lit(0).cast("long")
    every = keys.select(key.alias(_KEY), group.alias(_GROUP))
    rows = every.where(F.col(_KEY).isNotNull())
    low, high, n, with_nulls = every.agg(F.min(_KEY), F.max(_KEY), F.count(_KEY), F.count(F.lit(1))).first()
    if ties and with_nulls - n > 2 * bucket_rows:
        return None
    if n == 0:
        return Splitters([Piece(0 if integral else b"")], 0 if integral else b"")
    plain = (lambda k: int(k)) if integral else (lambda k: bytes(k))
    low, top = plain(low), plain(high) + 1 if integral else plain(high)
    found = Splitters([Piece(low)], top)
    if n <= 2 * bucket_rows:
        return found
    found = _refined(found, rows.withColumn("__bucket", F.lit(0).cast("long")), [(0, None, n)], plain, bucket_rows)
    over = F.col("n") > 2 * bucket_rows
    for _ in range(ROUNDS):
        placed = found.apply(rows, F.col(_KEY), "__bucket")
        counts = placed.groupBy("__bucket").agg(F.count(F.lit(1)).alias("n")).where(over)
        full = [(r["__bucket"], None, r["n"]) for r in counts.limit(MOST_PIECES + 1).collect()]
        if by and full:
            listed = keys.sparkSession.createDataFrame([b[:1] for b in full], "__bucket long")
            counts = placed.join(F.broadcast(listed), "__bucket").groupBy("__bucket", _GROUP).agg(F.count(F.lit(1)).alias("n"))
            full = [tuple(r) for r in counts.where(over).limit(MOST_PIECES + 1).collect()]
        if not full:
            break
        if len(full) + len(found.pieces) > MOST_PIECES:
            raise IrregularKeysError(len(full))
        finer = _refined(found, placed, full, plain, bucket_rows)
        if finer.pieces == found.pieces:
            return None if ties else found  # equal keys: nothing is left to split
        found = finer
    else:
        return None if ties else found
    return found


def _refined(found: Splitters, placed: DataFrame, full: list[tuple], plain, bucket_rows: int) -> Splitters:
    """Cut the overfull cells at quantiles of their sampled keys, and evenly between those."""
    asked = [min(FAN, -(-n // bucket_rows)) for _, _, n in full]
    room = min(1.0, MOST_SAMPLED / (SAMPLED * sum(asked)))
    shares = [min(1.0, room * SAMPLED * fan / n) for fan, (_, _, n) in zip(asked, full, strict=True)]
    listed = [(b, g, s) for (b, g, _), s in zip(full, shares, strict=True)]
    some = placed.sparkSession.createDataFrame(listed, f"__bucket long, {_GROUP} long, share double")
    on = ["__bucket"] if full[0][1] is None else ["__bucket", _GROUP]
    drawn = placed.join(F.broadcast(some.select(*on, "share")), on).where(F.rand() < F.col("share"))
    sample: dict[int, list] = {}
    for bucket, key in drawn.select("__bucket", _KEY).collect():
        sample.setdefault(bucket, []).append(plain(key))
    wanted: dict[int, list] = {}
    for (bucket, _, n), fan in zip(full, asked, strict=True):
        keys = sorted(sample.get(bucket, []))
        edges = sorted({keys[i * len(keys) // fan] for i in range(fan)}) if keys else []
        cells, others = wanted.get(bucket, (0, []))
        wanted[bucket] = (max(cells, -(-n // bucket_rows)), sorted({*others, *edges}))
    return found.split(wanted)

