"""How filters interact: what each of several filters removes in every order of applying them.

Documents become a sparse matrix of documents by words. Every block of texts is encoded with a dictionary of its own
first, so that only its distinct words shuffle; the words of all blocks are numbered globally, each block gets the numbers of
its words back and turns into a shard of compressed sparse rows (row starts, global columns, counts). A row's sum is its
number of words, and the number of its non-zero entries that of its distinct words, which decide filters A and B. The other
filters are flags of a text (C, D) or compare texts by SHA-256 over the whole table (E).

Flags are then counted per part and set of failed filters, at most 2^5 rows a part. All orders and steps, and the Shapley
shares, follow from these counts, so the 120 orders never touch a document.

Defined cases: a NULL text is the empty text, which has no words, fails A and neither B nor C, and equals other empty
texts; a NULL source is the part ''; a NULL id has no label, equals no smaller id and is no smaller id itself; a row that repeats an id
counts again, and does not fail E for itself; of several labels of one id, any 1 counts; very long texts are a block of their
own; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake.llm.common import flat_bytes, slices, words_of
from adlake.session import cut_lineage

FILTERS = "ABCDE"
LEAST_WORDS = 200  # A
LEAST_DISTINCT = 50  # B: per cent of the words
MOST_CAPITALS = 2  # C: per cent of the code points
MARKS = "#$%&*|"  # D
BLOCK = 1 << 25  # bytes of text in a block
STEP = 1 << 22  # of them in a numpy step
BUCKET_ROWS = 1 << 15  # words of blocks that are numbered together


# --- the sparse matrix


def encode_blocks(docs: DataFrame) -> DataFrame:
    """Blocks of documents: ids, parts, flags and digests of their texts, and their rows over the words of the block.

    ``docs`` has doc_id, part and text. Arrays of numbers are kept as bytes, which neither Parquet nor a shuffle takes apart.
    """
    key = docs.schema["doc_id"].dataType.simpleString()
    marks = np.isin(np.arange(256), list(MARKS.encode()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for whole in gathered(batches):
            for batch in slices(whole, "text", BLOCK, BLOCK):
                tokens, lengths, flags, shas = [], [], [], []
                for step in slices(batch, "text", STEP, STEP):
                    data, offsets = flat_bytes(step.column("text"))
                    capitals, points, marked = (
                        per_row(hit, offsets) for hit in ((data >= 65) & (data <= 90), (data & 0xC0) != 0x80, marks[data])
                    )
                    flags.append(4 * (100 * capitals > MOST_CAPITALS * points) + 8 * (marked > 0))
                    shas += [hashlib.sha256(data[a:b]).digest() for a, b in zip(offsets[:-1], offsets[1:])]
                    words, rows = tokens_of(data, offsets)
                    tokens.append(words)
                    lengths.append(rows)
                words, indptr, columns, counts = encoded_rows(tokens, lengths)
                lists = [batch.column("doc_id"), batch.column("part"), pa.array(shas, pa.binary()), words]
                wrapped = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists]
                packed = [pa.array([pack(x)], pa.binary()) for x in (np.concatenate(flags), indptr, columns, counts)]
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *wrapped, *packed], names)
                number += 1

    names = ["block", "doc_id", "part", "sha", "words", "flags", "indptr", "columns", "counts"]
    schema = (f"block bigint, doc_id array<{key}>, part array<string>, sha array<binary>, words array<binary>, "
              "flags binary, indptr binary, columns binary, counts binary")  # fmt: skip
    return docs.select("doc_id", "part", "text").mapInArrow(run, schema)


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about a block; what is held is one block and the batch after it."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column("text").nbytes
        if size >= BLOCK:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def per_row(hit: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of bytes with ``hit`` in every row."""
    upto = np.concatenate([np.zeros(1, np.int64), np.cumsum(hit, dtype=np.int64)])
    return upto[offsets[1:]] - upto[offsets[:-1]]


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All words of some rows, one after another, and their number per row."""
    starts, ends, first = words_of(data, offsets)
    letters = data[~((data == 32) | ((data >= 9) & (data <= 13)))]  # words without what lies between them
    places = np.concatenate([np.zeros(1, np.int64), np.cumsum(ends - starts)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(letters)]), np.diff(first)


def encoded_rows(tokens: list[pa.Array], lengths: list[np.ndarray]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words of a block, and its compressed sparse rows over them: row starts, columns, counts."""
    coded = pa.concat_arrays(tokens).dictionary_encode()
    words, codes = coded.dictionary, coded.indices.to_numpy()
    width, sizes, columns, counts, done = max(1, len(words)), [np.zeros(1, np.int64)], [], [], 0
    for length in lengths:
        start, done = done, done + int(length.sum())
        cells = np.repeat(np.arange(len(length)), length) * width + codes[start:done]
        cells.sort()
        fresh = np.flatnonzero(np.concatenate([np.ones(min(1, len(cells)), bool), cells[1:] != cells[:-1]]))
        row, column = np.divmod(cells[fresh], width)
        sizes.append(np.bincount(row, minlength=len(length)))
        columns.append(column)
        counts.append(np.diff(np.append(fresh, len(cells))))
    return words, np.cumsum(np.concatenate(sizes)), np.concatenate(columns), np.concatenate(counts)


def pack(numbers: np.ndarray) -> bytes:
    """Whole numbers below 2^31 as compressed differences, in planes of bytes of equal weight."""
    steps = np.diff(numbers, prepend=0).astype(np.int32)
    return pa.compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True) + len(steps).to_bytes(8, "little")


def unpack(body: bytes) -> np.ndarray:
    size = int.from_bytes(body[-8:], "little")
    planes = np.frombuffer(pa.decompress(body[:-8], 4 * size, "zstd"), np.uint8).reshape(4, size)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.int32).ravel())


def numbered(blocks: DataFrame) -> DataFrame:
    """(block, place, word, id): the global number of every word of every block.

    Words are dealt by hash to buckets of bounded size and numbered in their order there. A word has one row in a block at most, so
    no word is a large part of a bucket.
    """
    rows = blocks.select(F.sum(F.size("words"))).first()[0] or 0
    words = blocks.select("block", F.posexplode("words").alias("place", "word"))
    placed = words.withColumn("_bucket", F.pmod(F.xxhash64("word"), F.lit(max(1, -(-rows // BUCKET_ROWS)))))
    rank = F.dense_rank().over(Window.partitionBy("_bucket").orderBy("word")).cast("bigint")
    return placed.select("block", "place", "word", (F.shiftleft("_bucket", 32) + rank - 1).alias("id"))


def dictionary(blocks: DataFrame) -> DataFrame:
    """(word, id): every distinct word once."""
    return numbered(blocks).select("word", "id").distinct()


SHARD_LISTS = ("doc_id", "part", "sha")
SHARD_NUMBERS = ("flags", "indptr", "columns", "counts")


def shard_of(block: pa.Table, terms: pa.Table) -> dict:
    """One block as a shard: its lists and numbers, with global numbers of words in ``columns``."""
    shard = {c: block.column(c).chunk(0).flatten() for c in SHARD_LISTS}
    shard |= {c: unpack(block.column(c)[0].as_py()) for c in SHARD_NUMBERS}
    ids = np.empty(terms.num_rows, np.int64)
    ids[terms.column("place").to_numpy()] = terms.column("id").to_numpy()
    return shard | {"columns": ids[shard["columns"]]}


def with_terms(blocks: DataFrame, act, schema: str) -> DataFrame:
    """Every block with the numbers of its words. Both are bounded by the bytes of a block."""
    terms = numbered(blocks).select("block", "place", "id")
    return blocks.drop("words").groupBy("block").cogroup(terms.groupBy("block")).applyInArrow(act, schema)


def term_matrix(blocks: DataFrame) -> DataFrame:
    """Shards in compressed sparse rows: block, doc_id, row starts, global columns, counts."""
    key = blocks.schema["doc_id"].dataType.elementType.simpleString()

    def act(block: pa.Table, terms: pa.Table) -> pa.Table:
        shard = shard_of(block, terms)
        lists = {"doc_id": shard["doc_id"]} | {c: pa.array(shard[c]) for c in ("indptr", "columns", "counts")}
        return pa.table({"block": block.column("block")} | {c: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for c, x in lists.items()})

    return with_terms(blocks, act, f"block bigint, doc_id array<{key}>, indptr array<bigint>, columns array<bigint>, counts array<bigint>")


def judged(blocks: DataFrame) -> DataFrame:
    """(doc_id, part, failed, sha) from the shards; ``failed`` has a bit for each filter A to D that the document fails."""
    key = blocks.schema["doc_id"].dataType.elementType.simpleString()

    def act(block: pa.Table, terms: pa.Table) -> pa.Table:
        shard = shard_of(block, terms)
        words, distinct = row_sums(shard["indptr"], shard["counts"]), row_sums(shard["indptr"], shard["counts"] != 0)
        failed = shard["flags"] | (words < LEAST_WORDS) | 2 * (100 * distinct < LEAST_DISTINCT * words)
        return pa.table({"doc_id": shard["doc_id"], "part": shard["part"], "failed": failed.astype(np.int32), "sha": shard["sha"]})

    return with_terms(blocks, act, f"doc_id {key}, part string, failed int, sha binary")


def row_sums(indptr: np.ndarray, values: np.ndarray) -> np.ndarray:
    upto = np.concatenate([np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)])
    return upto[indptr[1:]] - upto[indptr[:-1]]


# --- flags, orders and counts


def failures(docs: DataFrame) -> DataFrame:
    """(doc_id, part, failed) of every document; bit i of ``failed`` stands for the filter FILTERS[i]. ``docs`` has doc_id, part and text."""
    found = cut_lineage(judged(cut_lineage(encode_blocks(docs))))
    least = found.groupBy("sha").agg(F.min("doc_id").alias("_least"), F.count("*").alias("_n")).where("_n > 1")
    least = least.select(F.col("sha").alias("_sha"), "_least")
    joined = found.join(least, F.col("sha") == F.col("_sha"), "left")
    repeats = F.coalesce(F.col("doc_id") > F.col("_least"), F.lit(False))
    return joined.select("doc_id", "part", F.col("failed").bitwiseOR(F.when(repeats, 1 << FILTERS.index("E")).otherwise(0)).alias("failed"))


def interactions(flagged: DataFrame, filters: str, marks: list[str]) -> DataFrame:
    """Counts for every part, order and step from flagged documents.

    ``flagged`` has part, failed (a bit per letter of ``filters``) and boolean columns ``marks``; every mark m gives a count m_lost of
    marked documents among the removed.
    """
    masks = 1 << len(filters)
    counted = flagged.groupBy("part", "failed").agg(F.count("*").alias("n"), *[F.count_if(F.col(m)).alias(m) for m in marks])
    one = counted.groupBy("part").agg(F.collect_list(F.struct("failed", "n", *marks)).alias("_c"))  # a row per set of filters, at most 2^5
    orders = F.array(*[F.lit("".join(p)) for p in permutations(filters)])
    steps = one.select("part", "_c", F.explode(orders).alias("filter_order")).select(
        "part", "_c", "filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(filters)))).alias("step")
    )
    bit = {letter: 1 << i for i, letter in enumerate(filters)}
    bits = F.create_map(*[F.lit(x) for pair in bit.items() for x in pair])
    earlier = F.slice(F.split("filter_order", ""), 1, F.col("step") - 1)
    ready = steps.withColumns({
        "_own": F.element_at(bits, F.substring(F.col("filter_order"), F.col("step"), F.lit(1))),
        "_before": F.aggregate(earlier, F.lit(0), lambda m, c: m.bitwiseOR(F.element_at(bits, c))),
    })

    def total(condition, value=lambda c: c["n"]) -> Column:
        picked = F.filter("_c", condition)
        return F.aggregate(picked, F.lit(0).cast("bigint"), lambda s, c: s + value(c))

    def fails(c: Column) -> Column:
        return c["failed"].bitwiseAND(F.col("_own")) != 0

    def gone(c: Column) -> Column:
        return c["failed"].bitwiseAND(F.col("_before")) != 0

    def share(c: Column) -> Column:
        """Orders in which the filter is the first of those that the document fails."""
        shares = F.array(F.lit(0), *[F.lit(factorial(len(filters)) // k) for k in range(1, len(filters) + 1)])
        return c["n"] * F.get(shares, F.bit_count(c["failed"].bitwiseAND(F.lit(masks - 1))))

    return ready.select(
        "part", "filter_order", "step",
        total(lambda c: ~fails(c) & ~gone(c)).alias("kept"),
        total(lambda c: fails(c) & ~gone(c)).alias("removed"),
        total(lambda c: fails(c) & gone(c)).alias("redundant"),
        total(lambda c: c["failed"] == F.col("_own")).alias("unique_fails"),
        *[total(lambda c: fails(c) & ~gone(c), lambda c, m=m: c[m]).alias(f"{m}_lost") for m in marks],
        total(fails, share).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Interactions of the five filters per source. ``docs``: doc_id, source, text; ``labels``: doc_id, quality, toxic."""
    flagged = failures(docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), "text"))
    marks = labels.groupBy(F.col("doc_id").alias("_id")).agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    marked = flagged.join(marks, F.col("doc_id") == F.col("_id"), "left")
    return interactions(marked, FILTERS, ["good", "toxic"])


ORACLE = rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
f AS (SELECT part, doc_id, len(words) < {LEAST_WORDS} AS a,
    100 * len(list_distinct(words)) < {LEAST_DISTINCT} * len(words) AS b,
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {MOST_CAPITALS} * length(t) AS c,
    regexp_matches(t, '[#$%&*|]') AS d, coalesce(doc_id > least, false) AS e FROM w),
l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS failed, count(*) AS n,
    count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
p AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM x a, x b, x c, x d, x e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
s AS (SELECT filter_order, step, bits[step] AS own, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INT) AS before FROM p, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
r AS (SELECT part, filter_order, step, own,
    CAST(sum(n) FILTER (WHERE failed & own = 0 AND failed & before = 0) AS BIGINT) AS kept,
    CAST(sum(n) FILTER (WHERE failed & own > 0 AND failed & before = 0) AS BIGINT) AS removed,
    CAST(sum(n) FILTER (WHERE failed & own > 0 AND failed & before > 0) AS BIGINT) AS redundant,
    CAST(sum(n) FILTER (WHERE failed = own) AS BIGINT) AS unique_fails,
    CAST(sum(good) FILTER (WHERE failed & own > 0 AND failed & before = 0) AS BIGINT) AS good_lost,
    CAST(sum(toxic) FILTER (WHERE failed & own > 0 AND failed & before = 0) AS BIGINT) AS toxic_lost
  FROM m, s GROUP BY ALL),
h AS (SELECT part, own, CAST(sum(removed) AS BIGINT) AS shapley FROM r GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, coalesce(kept, 0) AS kept, coalesce(removed, 0) AS removed,
  coalesce(redundant, 0) AS redundant, coalesce(unique_fails, 0) AS unique_fails, coalesce(good_lost, 0) AS good_lost,
  coalesce(toxic_lost, 0) AS toxic_lost, coalesce(shapley, 0) AS shapley FROM r JOIN h USING (part, own)
"""
