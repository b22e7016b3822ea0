"""Exact deduplication in two passes over a Bloom filter.

Pass one counts, for every text hash, its slots of a Bloom filter; a slot stays set if two rows or more hit it. Pass two
tests every row against the set slots: a row with a free slot is certainly unique and passes straight through, only the
others shuffle by their hash, where groups are formed exactly.

The filter has at most ``MAX_SLOTS`` bits, which bounds what is broadcast. Larger tables are cut into slices of the hash
space with a filter each, so the share of rows that shuffle without need stays the same at every size.

Defined cases: NULL counts as the empty text, and all texts without a word are equal; rows that repeat both doc_id and
text are one document listed twice (both count in ``group_size`` and carry the same verdict, :func:`keep` leaves one);
extra columns are kept as they are; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.llm.common import SPACE_CLASS, bit_probe
from adlake.session import cut_lineage

SLOTS_PER_ROW = 16
MAX_SLOTS = 1 << 28
BITMAP_BITS = 32768  # of Spark's bitmap functions


def text_hash(text: Column) -> Column:
    """SHA-256 of the text without white space."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE_CLASS}+", ""), 256))


def bloom_hash(sha: Column) -> Column:
    return F.xxhash64(sha)


def slots(h: Column, mask: int) -> list[Column]:
    """Two slots from separate halves of a 64-bit hash."""
    return [h.bitwiseAND(F.lit(mask)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(mask))]


class RepeatFilter:
    """Which hashes may occur twice: one bounded bitmap for each slice of the hash space."""

    def __init__(self, spark: SparkSession, hashes: DataFrame, rows: int, max_slots: int = MAX_SLOTS):
        wanted = max(1, rows) * SLOTS_PER_ROW
        self.slices = -(-wanted // max_slots)
        self.size = min(max_slots, max(BITMAP_BITS, 1 << (wanted - 1).bit_length()))
        self.maps = [spark.sparkContext.broadcast(self._bitmap(hashes.where(self.slice() == i)))
                     for i in range(self.slices)]

    def slice(self) -> Column:
        return F.pmod(F.shiftright("_h", 7), F.lit(self.slices))

    def _bitmap(self, hashes: DataFrame) -> np.ndarray:
        """Bits of the slots that two rows or more hit; counts are combined before the shuffle."""
        hit = hashes.select(F.explode(F.array(*slots(F.col("_h"), self.size - 1))).alias("slot"))
        twice = hit.groupBy("slot").count().where("count > 1").select(F.col("slot") + 1)  # bitmap numbers start at 1
        parts = twice.toDF("slot").groupBy(F.bitmap_bucket_number("slot").alias("part"))
        bits = np.zeros(self.size // 8, np.uint8)
        width = BITMAP_BITS // 8
        for row in parts.agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).toLocalIterator():
            bits[(row.part - 1) * width : row.part * width] = np.frombuffer(row.bits, np.uint8)
        return bits

    def may_repeat(self) -> Column:
        """Whether the row with hash ``_h`` may have an equal."""
        tests = []
        for i, shared in enumerate(self.maps):
            test = bit_probe(shared)(*slots(F.col("_h"), self.size - 1))
            tests.append(test if self.slices == 1 else (self.slice() == i) & test)
        return reduce(lambda x, y: x | y, tests)


def hash_table(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, hash of the text, its length in code points), written once because both passes read it."""
    sha = docs.select(F.col(key).alias("doc_id"), text_hash(F.col(text)).alias("_sha"),
                      F.length(F.coalesce(F.col(text), F.lit(""))).alias("_chars"))
    return cut_lineage(sha.withColumn("_h", bloom_hash(F.col("_sha"))))


def groups(table: DataFrame, repeats: RepeatFilter) -> tuple[DataFrame, DataFrame]:
    """Rows that are certainly unique, and the others with their group's row that stays and its size."""
    marked = table.withColumn("_may", repeats.may_repeat())
    suspects = marked.where("_may").drop("_may")
    best = suspects.groupBy("_sha").agg(
        F.max(F.struct("_chars", (-F.col("doc_id")).alias("minus"))).alias("_best"), F.count("*").alias("group_size")
    )
    # Written, so that both sides of the join are shuffled anew and a hot hash can be split.
    best = cut_lineage(best)
    joined = suspects.join(best.withColumnRenamed("_sha", "_of"), F.col("_sha") == F.col("_of"))
    return marked.where(~F.col("_may")), joined.withColumn("keep_id", -F.col("_best.minus")).drop("_of", "_best")


def deduplicate(docs: DataFrame, text: str = "text", key: str = "doc_id", max_slots: int = MAX_SLOTS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    table = hash_table(docs, text, key)
    unique, repeated = groups(table, RepeatFilter(docs.sparkSession, table, table.count(), max_slots))
    sha = F.lower(F.hex("_sha")).alias("text_sha256")
    alone = unique.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                          F.lit(True).alias("kept"), sha)
    return alone.unionByName(
        repeated.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), sha)
    )


def keep(docs: DataFrame, text: str = "text", key: str = "doc_id", max_slots: int = MAX_SLOTS) -> DataFrame:
    """``docs`` without the copies. Texts of certainly unique rows never shuffle."""
    table = hash_table(docs, text, key)
    repeats = RepeatFilter(docs.sparkSession, table, table.count(), max_slots)
    _, repeated = groups(table, repeats)
    stays = repeated.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).select("doc_id", "_sha").distinct()
    marked = docs.withColumn("_s", text_hash(F.col(text))).withColumn("_h", bloom_hash(F.col("_s")))
    marked = marked.withColumn("_may", repeats.may_repeat())
    suspects = marked.where("_may").dropDuplicates([key, "_s"])
    same = (F.col("_s") == F.col("_sha")) & suspects[key].eqNullSafe(stays["doc_id"])
    left = suspects.join(stays, same, "left_semi")
    return marked.where(~F.col("_may")).select(*docs.columns).unionByName(left.select(*docs.columns))


ORACLE = rf"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS chars,
    sha256(regexp_replace(coalesce(text, ''), '{SPACE_CLASS}+', '', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  doc_id = first_value(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id)
"""
