"""What the operators of this folder share: reading tables, text constants, and words of Arrow batches as numpy arrays."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.session import cut_lineage, prepare_session

# White space between words, everywhere in this folder: space, tab, line feed, vertical tab, form feed, return.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"

# Bytes of text that one numpy step works on; a longer document is a step of its own.
BLOCK_BYTES = 1 << 21


def start(spark: SparkSession) -> SparkSession:
    """Session settings of the library, and functions of this folder sent to executors by value.

    Executors need numpy and pyarrow, but not this repository on their path.
    """
    cloudpickle.register_pickle_by_value(sys.modules["adlake.llm"])
    return prepare_session(spark)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return start(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, even if ``body`` uses it inside other lambdas."""
    return F.transform(F.array(value), body)[0]


def row_count_partitions(rows: int, per_partition: int, least: int = 1) -> int:
    """Number of parts so that none is expected to hold more than ``per_partition`` rows."""
    return max(least, -(-rows // per_partition))


def slices(
    batch: pa.RecordBatch, column: str, limit: int = BLOCK_BYTES, most_rows: int = 4096
) -> Iterator[pa.RecordBatch]:
    """Cut ``batch`` into runs of at most ``most_rows`` rows with at most ``limit`` bytes of text, one row at least."""
    _, offsets = flat_bytes(batch.column(column))
    row, rows = 0, batch.num_rows
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), row + most_rows, rows)
        yield batch.slice(row, end - row)
        row = end


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, one after another, and where each row starts. NULL counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, kept for the longest block so far."""

    def __init__(self):
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up, self.down = (
                np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)]))
                for b in (BASE, INVERSE)
            )
        return self.up, self.down


def byte_codes() -> np.ndarray:
    """A random 64-bit number for each byte value."""
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


class Rolling:
    """Hash of any byte range of a block from prefix sums; equal strings have equal hashes wherever they stand."""

    def __init__(self, data: np.ndarray, powers: Powers, codes: np.ndarray):
        n = len(data) + 1
        up, self.down = powers.upto(n)
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(codes[data] * up[: n - 1], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts])


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data | 32, data)


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in a block, and per row the number of the first word (one more entry than rows)."""
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    change = inside.copy()
    change[1:] &= ~inside[:-1]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    change[begins] = inside[begins]
    starts = np.flatnonzero(change)
    change = inside.copy()
    change[:-1] &= ~inside[1:]
    lasts = offsets[1:][offsets[1:] > 0] - 1
    change[lasts] = inside[lasts]
    ends = np.flatnonzero(change) + 1
    return starts, ends, np.searchsorted(starts, offsets, "left")


def byte_grams(
    data: np.ndarray, offsets: np.ndarray, sizes: tuple[int, ...], powers: Powers, codes: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the byte n-grams inside words, and the byte where each starts.

    A word has a blank on either side, also at the ends of a row, so its first and last letters make grams of their own.
    Places count in the bytes of the rows with two blanks added to each: byte p of row r is at p + 2 r + 1.
    """
    rows = len(offsets) - 1
    padded = np.full(len(data) + 2 * rows, 32, np.uint8)
    row_of = np.repeat(np.arange(rows), np.diff(offsets))
    padded[np.arange(len(data)) + 2 * row_of + 1] = np.where((data >= 9) & (data <= 13), 32, data)
    blank = padded == 32
    before = np.concatenate([[0], np.cumsum(blank)])
    hashes, places = [], []
    rolling = Rolling(padded, powers, codes)
    for n in sizes:
        at = np.arange(max(0, len(padded) - n + 1))
        at = at[before[at + n - 1] - before[at + 1] == 0]  # no blank but at its ends
        hashes.append(rolling(at, at + n))
        places.append(at)
    return np.concatenate(hashes), np.concatenate(places)


class IdFilter:
    """A Bloom filter of ids, at most ``most`` bits: rows that it lets through may be wanted, all others are not.

    It spares the shuffle of texts that a join would drop. Where ids outgrow it, more rows shuffle; results are the same.
    """

    WIDTH = 32768  # bits of one of Spark's bitmaps

    def __init__(self, ids: DataFrame, column: str, most: int = 1 << 28, hashed: bool = False):
        """``hashed`` says that the column holds 64-bit hashes, which are used as they are."""
        spark, self.rows, self.hashed = ids.sparkSession, ids.count(), hashed
        self.size = min(most, max(self.WIDTH, 1 << (16 * max(1, self.rows) - 1).bit_length()))
        slots = ids.select(F.explode(F.array(*self.slots(F.col(column)))).alias("s")).select((F.col("s") + 1).alias("s"))
        parts = slots.groupBy(F.bitmap_bucket_number("s").alias("part")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("bits")
        )
        bits = np.zeros(self.size // 8, np.uint8)
        for row in parts.toLocalIterator():
            bits[(row.part - 1) * self.WIDTH // 8 : row.part * self.WIDTH // 8] = np.frombuffer(row.bits, np.uint8)
        self.shared = spark.sparkContext.broadcast(bits)

    def slots(self, key: Column) -> list[Column]:
        h = key if self.hashed else F.xxhash64(key)
        return [h.bitwiseAND(F.lit(self.size - 1)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(self.size - 1))]

    def may_hold(self, key: Column) -> Column:
        return bit_probe(self.shared)(*self.slots(key))


MOST_BITS, LEAST_BITS = 1 << 28, 32768  # of the filter of :func:`marked`; the least is one of Spark's bitmaps


def marked(rows: DataFrame, key: str, ids: DataFrame, name: str) -> DataFrame:
    """``rows`` with a boolean column ``name``: whether ``key`` may be among ``ids`` (one column); all others are surely not.

    A one-hash Bloom filter of at most 32 MB that is looked up by broadcast joins in the plan itself, so a task that goes on to read
    texts in Python has one worker, not one more for each filter.
    """
    size = min(MOST_BITS, max(LEAST_BITS, 1 << (32 * max(1, ids.count()) - 1).bit_length()))

    def slot(column: str) -> Column:
        return F.xxhash64(column).bitwiseAND(F.lit(size - 1)) + 1

    slots = ids.select(slot(ids.columns[0]).alias("_s"))
    maps = cut_lineage(
        slots.groupBy(F.bitmap_bucket_number("_s").alias("_part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_s")).alias("_bits"))
    )
    place = F.bitmap_bit_position(slot(key))
    byte = F.conv(F.hex(F.substring("_bits", (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.call_function("shiftright", byte, place.bitwiseAND(F.lit(7)).cast("int")).bitwiseAND(F.lit(1)) == 1
    met = rows.join(F.broadcast(maps), F.bitmap_bucket_number(slot(key)) == F.col("_part"), "left")
    return met.select(*rows.columns, F.coalesce(hit, F.lit(False)).alias(name))


def bit_probe(shared):
    """Whether both slots of a row are set in the broadcast bitmap."""

    @F.pandas_udf("boolean")
    def probe(a: pd.Series, b: pd.Series) -> pd.Series:
        bits = shared.value
        hits = [(bits[x >> 3] >> (x & 7)) & 1 for x in (a.to_numpy(), b.to_numpy())]
        return pd.Series((hits[0] & hits[1]).astype(bool))

    return probe
