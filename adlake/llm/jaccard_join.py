"""N-gram Jaccard join of documents: filtering under several global token orders, exact verification, components.

Two sets of word shingles with a Jaccard similarity of at least t share a token among the first n - ceil(t n) + 1 of
either, in any order of all tokens. Orders put frequent tokens last (by a counting sketch over all documents, of bounded
size) and differ in the hash that ranks tokens of equal frequency. Candidates come from an index of the prefixes under the
first order, thinned by size and place of the shared token and by parity signatures. Prefixes under the further orders are
only formed when both texts are at hand, beside the full sets, so they spare no work.

Large groups of copies must not become pairs. Equal sets are one group by their 128-bit hash. Next, every document is
compared with one other that has the same least token, under each of four hashes, and then with the one in the middle of all
documents with the token, by parity signatures; verified links give first components.
The index then only yields pairs of different components, which loses no component: a pair inside one is connected
already. One document of each component stands for it under a token at first; then all pairs of what is still apart.

Every filter is lossless, so results are exact up to 64-bit token hashes. Texts shuffle only if a Bloom filter of
candidate ids lets them through, and pairs are verified in a stream, whatever the size of a hub.

Defined cases: texts without words have an empty set and link with nothing; fewer words than a shingle make one token;
NULL ids have no component but get a row; rows that repeat an id are one document; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.llm.common import Powers, Rolling, byte_codes, flat_bytes, lower_ascii, marked, mix, row_count_partitions, slices, words_of
from adlake.llm.components import components
from adlake.session import cut_lineage, drop_table

SHINGLE = 5
ORDERS = 3
LEAST = 4  # hashes whose least tokens propose first pairs
TEXT_BYTES = 1 << 18  # bytes of text of a numpy step; arrays over its bytes take many times that
BATCH_BYTES = 1 << 22  # of rows that Spark sends a Python worker at a time
SIMILAR = (75, 100)
COUNTERS = 1 << 22  # most counters of the sketch
PART = 1 << 16  # counters per row of the sketch
FAN_IN = 64  # partial sketches merged by one task
ENTRIES = 1 << 17  # of the index that a worker collects before it deals them to buckets
BUCKET = 1 << 17  # entries of a bucket, as expected
WIDTHS = (1024, 4096, 16384)  # bits of parity signatures, for sets of up to as many tokens
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                        0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


@dataclass
class Sets:
    """Distinct tokens of some texts: sorted hashes one text after another, and where each text starts."""

    tokens: np.ndarray
    firsts: np.ndarray

    def sizes(self) -> np.ndarray:
        return np.diff(self.firsts)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.firsts) - 1), self.sizes())


def sets_of(texts: pa.Array, powers: Powers, codes: np.ndarray, shingle: int = SHINGLE) -> Sets:
    data, offsets = flat_bytes(texts)
    data = lower_ascii(data)
    starts, ends, first = words_of(data, offsets)
    hashes, words = Rolling(data, powers, codes)(starts, ends), np.diff(first)
    rows = len(words)
    tokens = np.where(words >= shingle, words - shingle + 1, np.minimum(words, 1))
    row = np.repeat(np.arange(rows), tokens)
    at = np.arange(len(row)) - np.repeat(np.cumsum(tokens) - tokens, tokens) + first[:-1][row]
    width = np.minimum(words, shingle)[row]
    made = width.astype(np.uint64)
    for k in range(shingle):
        inside = k < width
        made[inside] += mix(hashes[at[inside] + k] + np.uint64(k)) * MULTIPLIERS[k % len(MULTIPLIERS)]
    made = mix(made)
    order = np.lexsort((made, row))
    made, row = made[order], row[order]
    fresh = np.ones(len(made), bool)
    fresh[1:] = (made[1:] != made[:-1]) | (row[1:] != row[:-1])
    return Sets(made[fresh], np.searchsorted(row[fresh], np.arange(rows + 1)))


def order_hash(tokens: np.ndarray, order: int) -> np.ndarray:
    return mix(tokens ^ np.uint64(int(MULTIPLIERS[order % len(MULTIPLIERS)]) * (order + 1) % (1 << 64)))


def as_long(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


# --- pass one: sizes, set hashes, signatures, and the sketch of token frequencies


def parity_bits(sets: Sets) -> pa.Array:
    """Per text, the parity of tokens in each of some slots, more for larger sets. Two sets differ in at least as many
    tokens as bits. Widths divide each other, so a wider signature folds to a narrower one."""
    widths = np.select([sets.sizes() <= w for w in WIDTHS[:-1]], WIDTHS[:-1], WIDTHS[-1])
    begins = np.concatenate([[0], np.cumsum(widths)])
    row = sets.rows()
    slot = (sets.tokens >> np.uint64(20)) % widths[row].astype(np.uint64)
    odd = np.bincount(begins[row] + slot.astype(np.int64), minlength=begins[-1]) & 1
    words = np.packbits(odd.astype(np.uint8)).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(begins // 64, pa.int32()), pa.array(words))


def profile(docs: DataFrame, counters: int, shingle: int) -> DataFrame:
    """Rows of documents (doc_id, n, k1, k2, bits) and, per task, rows of sketch parts (part, counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, codes, seen = Powers(), byte_codes(), np.zeros(-(-counters // PART) * PART, np.uint32)
        for whole in batches:
            for batch in slices(whole, "text", TEXT_BYTES):
                sets = sets_of(batch.column("text"), powers, codes, shingle)
                np.add.at(seen, order_hash(sets.tokens, 7) % np.uint64(counters), np.uint32(1))  # in place: no array of all counters
                sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(order_hash(sets.tokens, k))]) for k in (8, 9)]
                keys = [s[sets.firsts[1:]] - s[sets.firsts[:-1]] for s in sums]
                rows = batch.num_rows
                nothing = [pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())]
                columns = [batch.column("doc_id"), pa.array(sets.sizes()), *map(as_long, keys), parity_bits(sets), *nothing]
                yield pa.RecordBatch.from_arrays(columns, names)
        for part, counts in enumerate(seen.reshape(-1, PART)):
            if counts.any():
                void = [pa.nulls(1, t) for t in (key, pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))]
                columns = [*void, pa.array([part], pa.int32()), pa.array([narrowed(counts)], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "n", "k1", "k2", "bits", "part", "counts"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    key = {"string": pa.string(), "int": pa.int32()}.get(kind, pa.int64())
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n bigint, k1 bigint, k2 bigint, bits array<bigint>, part int, counts binary"
    )


def narrowed(counts: np.ndarray) -> bytes:
    """Counters of a part in the fewest bytes each that hold the largest."""
    kind = next(k for k in (np.uint8, np.uint16, np.uint32) if counts.max() <= np.iinfo(k).max)
    return counts.astype(kind).tobytes()


def widened(counts: bytes) -> np.ndarray:
    return np.frombuffer(counts, f"u{len(counts) // PART}")


def merged_sketch(parts: DataFrame, counters: int) -> np.ndarray:
    """Frequency class of each counter: 0 up to what chance adds to the mean, then one more for each doubling beyond it.

    Partial sketches are summed part by part, ``FAN_IN`` of them in a task at a time; the result is bounded.
    """

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(PART, np.uint64)
        for x in table.column("counts"):
            total += widened(x.as_py())
        return pa.table([table.column("part")[:1], pa.array([narrowed(np.minimum(total, 0xFFFFFFFF))], pa.binary())], names=["part", "counts"])

    table = parts
    while (most := table.groupBy("part").count().agg(F.max("count")).first()[0] or 0) > 1:
        lots = table.withColumn("lot", F.pmod(F.monotonically_increasing_id(), F.lit(-(-most // FAN_IN))))
        table = cut_lineage(lots.groupBy("part", "lot").applyInArrow(add, "part int, counts binary"))
    counts = np.zeros((-(-counters // PART), PART), np.uint32)
    for row in table.toLocalIterator():
        counts[row.part] = widened(row.counts)
    counts = counts.reshape(-1)[:counters]
    mean = counts.mean()
    above = (counts - mean) / (4 * np.sqrt(mean) + 4)
    return np.ceil(np.log2(np.maximum(above, 1))).astype(np.uint8)


# --- prefixes

ENTRY = ("token", "salt", "doc_id", "n", "place")  # columns of the index


def ranked(sets: Sets, classes: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the tokens in order (frequency class, hash), text by text, and the classes of the tokens."""
    token_class = classes[order_hash(sets.tokens, 7) % np.uint64(len(classes))]
    return np.lexsort((order_hash(sets.tokens, order), token_class, sets.rows())), token_class


def prefix_sizes(sizes: np.ndarray) -> np.ndarray:
    part, whole = SIMILAR
    return np.where(sizes > 0, sizes - -(-part * sizes // whole) + 1, 0)


def index_entries(docs: DataFrame, shared, shingle: int, buckets: int) -> DataFrame:
    """(bucket, token, salt, doc_id, n, place): lists of the prefix tokens of all documents under the first order.

    Tokens above the usual frequency are salted by document, so that one of them is many groups. A bucket holds all entries of its
    tokens and salts. Lists of a bucket take less to shuffle and to sort than a row for each entry.
    """

    def dealt(held: list[tuple]) -> pa.RecordBatch:
        token, salt, n, place = (np.concatenate([h[i] for h in held]) for i in range(4))
        bucket = mix(token + salt.astype(np.uint64) * MULTIPLIERS[0]) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        found, firsts = np.unique(bucket[order], return_index=True)
        ends = pa.array(np.append(firsts, len(order)).astype(np.int32))
        docs = pa.concat_arrays([h[4] for h in held]).take(pa.array(order))
        lists = [as_long(token[order]), pa.array(salt[order]), docs, pa.array(n[order]), pa.array(place[order])]
        columns = [pa.array(found.astype(np.int32)), *(pa.ListArray.from_arrays(ends, x) for x in lists)]
        return pa.RecordBatch.from_arrays(columns, ["bucket", *ENTRY])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, codes, classes, held = Powers(), byte_codes(), shared.value, []
        for whole in batches:
            for batch in slices(whole, "text", TEXT_BYTES):
                sets = sets_of(batch.column("text"), powers, codes, shingle)
                order, token_class = ranked(sets, classes, 0)
                row = sets.rows()
                place = np.arange(len(row)) - sets.firsts[:-1][row]
                used = place < prefix_sizes(sets.sizes())[row]
                picked, row = order[used], row[used]
                spread = np.minimum(token_class[picked], 15).astype(np.uint64)
                salt = mix(row.astype(np.uint64) + np.uint64(1)) % (np.uint64(1) << spread) + (spread > 0)
                held.append((sets.tokens[picked], salt.astype(np.int32), sets.sizes()[row].astype(np.int32),
                             place[used].astype(np.int32), batch.column("doc_id").take(pa.array(row))))
                if sum(len(h[0]) for h in held) >= ENTRIES:
                    yield dealt(held)
                    held = []
        if held:
            yield dealt(held)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"bucket int, token array<bigint>, salt array<int>, doc_id array<{kind}>, n array<int>, place array<int>"
    )


def heads(docs: DataFrame, shared, shingle: int) -> DataFrame:
    """(doc_id, h1, h2, ...): the prefix tokens of every document under each further order, 32 bits of each."""
    names = [f"h{k}" for k in range(1, ORDERS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, codes, classes = Powers(), byte_codes(), shared.value
        for whole in batches:
            for batch in slices(whole, "text", TEXT_BYTES):
                sets = sets_of(batch.column("text"), powers, codes, shingle)
                used, row = prefix_sizes(sets.sizes()), sets.rows()
                ends = pa.array(np.concatenate([[0], np.cumsum(used)]), pa.int32())
                lists = []
                for number in range(1, ORDERS):
                    order, _ = ranked(sets, classes, number)
                    picked = order[np.arange(len(row)) - sets.firsts[:-1][row] < used[row]]
                    lists.append(pa.ListArray.from_arrays(ends, pa.array(sets.tokens[picked].astype(np.uint32).view(np.int32))))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *lists], ["doc_id", *names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    made = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{h} array<int>" for h in names))
    return made.dropDuplicates(["doc_id"])


def shared_entries(packed: DataFrame) -> DataFrame:
    """Rows of the entries whose token another document has too. Salted tokens, frequent by the sketch, stay without a look."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_groups(batches, ["bucket"]):
            flat = {k: batch.column(k).flatten() for k in ENTRY}
            token, salt = flat["token"].to_numpy(), flat["salt"].to_numpy()
            order = np.lexsort((salt, token))
            token, salt = token[order], salt[order]
            same = (token[1:] == token[:-1]) & (salt[1:] == salt[:-1])
            keep = salt > 0
            keep[1:] |= same
            keep[:-1] |= same
            picked = pa.array(order[keep])
            yield pa.RecordBatch.from_arrays([flat[k].take(picked) for k in ENTRY], list(ENTRY))

    kind = packed.schema["doc_id"].dataType.elementType.simpleString()
    ordered = packed.repartition("bucket").sortWithinPartitions("bucket")
    return ordered.mapInArrow(run, f"token bigint, salt int, doc_id {kind}, n int, place int")


def least_tokens(docs: DataFrame, shingle: int) -> DataFrame:
    """(order, token, doc_id): the token of every document with the least hash, under several hashes.

    Frequency plays no part here: near copies rarely share their rarest tokens, but any one token with even odds.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, codes = Powers(), byte_codes()
        for whole in batches:
            for batch in slices(whole, "text", TEXT_BYTES):
                sets = sets_of(batch.column("text"), powers, codes, shingle)
                full = np.flatnonzero(sets.sizes())
                for number in range(LEAST if len(full) else 0):
                    least = np.minimum.reduceat(order_hash(sets.tokens, 20 + number), sets.firsts[full])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(full), number, np.int32)), as_long(least), batch.column("doc_id").take(pa.array(full))],
                        ["order", "token", "doc_id"],
                    )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"order int, token bigint, doc_id {kind}")


# --- pairs


def close_enough(pairs: DataFrame, info: DataFrame) -> DataFrame:
    """Drop pairs whose sizes or parity signatures rule a link out: a link differs in at most a share of both sizes."""
    part, whole = SIMILAR
    sides = [info.select(*[F.col(c).alias(f"_{s}{c}") for c in ("doc_id", "n", "bits")]) for s in "ab"]
    known = pairs.join(sides[0], F.col("a") == F.col("_adoc_id")).join(sides[1], F.col("b") == F.col("_bdoc_id"))
    width = F.least(F.size("_abits"), F.size("_bbits"))

    def folded(bits: str) -> Column:
        def word(i: Column) -> Column:
            at = F.sequence(i, F.size(bits) - 1, width)
            return F.aggregate(at, F.lit(0).cast("bigint"), lambda x, k: x.bitwiseXOR(F.get(bits, k)))

        return F.when(F.size(bits) == width, F.col(bits)).otherwise(F.transform(F.sequence(F.lit(0), width - 1), word))

    apart = F.aggregate(
        F.zip_with(folded("_abits"), folded("_bbits"), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x
    )
    sizes = F.col("_an") + F.col("_bn")
    fits = (F.least("_an", "_bn") * whole >= F.greatest("_an", "_bn") * part) & (apart * (whole + part) <= sizes * (whole - part))
    return known.where(fits).select("a", "b")


def verified(docs: DataFrame, pairs: DataFrame, shared, shingle: int) -> DataFrame:
    """The pairs that link. Both texts stand in a row; sets are made anew, which is less to shuffle than the sets."""
    part, whole_part = SIMILAR
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    texts = marked(docs, "doc_id", cut_lineage(ids), "_asked").where("_asked").select("doc_id", "text")
    left, right = (texts.select(F.col("doc_id").alias(f"_{s}"), F.col("text").alias(f"text_{s}")) for s in "ab")
    both = pairs.join(right, F.col("b") == F.col("_b")).drop("_b").join(left, F.col("a") == F.col("_a")).drop("_a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, codes, classes = Powers(), byte_codes(), shared.value
        for whole in batches:
            for half in slices(whole, "text_a", TEXT_BYTES):
                for batch in slices(half, "text_b", TEXT_BYTES):
                    sides = [sets_of(batch.column(c), powers, codes, shingle) for c in ("text_a", "text_b")]
                    sizes, rows = [s.sizes() for s in sides], batch.num_rows
                    candidate = np.ones(rows, bool)
                    for number in range(1, ORDERS):
                        heads = []
                        for s in sides:
                            order, _ = ranked(s, classes, number)
                            row = s.rows()
                            head = np.arange(len(row)) - s.firsts[:-1][row] < prefix_sizes(s.sizes())[row]
                            heads.append((s.tokens[order[head]], row[head]))
                        candidate &= common(heads, rows) > 0
                    left = [(s.tokens, s.rows()) for s in sides]
                    inside = common([(tokens[candidate[row]], row[candidate[row]]) for tokens, row in left], rows)
                    linked = (inside * whole_part >= part * (sizes[0] + sizes[1] - inside)) & (inside > 0)
                    yield batch.select(["a", "b"]).filter(pa.array(linked))

    return both.mapInArrow(run, pairs.schema)


def common(sides: list[tuple[np.ndarray, np.ndarray]], rows: int) -> np.ndarray:
    """Per row, the number of tokens that both sides have; either side is distinct within a row."""
    tokens, row = (np.concatenate([s[i] for s in sides]) for i in (0, 1))
    order = np.lexsort((tokens, row))
    tokens, row = tokens[order], row[order]
    return np.bincount(row[1:][(tokens[1:] == tokens[:-1]) & (row[1:] == row[:-1])], minlength=rows)


def stars(table: DataFrame, keys: list[str]) -> DataFrame:
    """(a, b): every document of a group with the group's smallest one."""
    least = cut_lineage(table.groupBy(*keys).agg(F.min("doc_id").alias("a"), F.count("*").alias("_n")).where("_n > 1").drop("_n"))
    renamed = least.withColumnsRenamed({k: f"_{k}" for k in keys})
    met = [F.col(k) == F.col(f"_{k}") for k in keys]
    return table.join(renamed, met).where("a < doc_id").select("a", F.col("doc_id").alias("b")).distinct()


BLOCK = 1024  # documents of a token that one pairing step holds
CROWD = 64  # documents of a token from which on its rows carry what rules pairs out


def across(entries: DataFrame, known: DataFrame, info: DataFrame, texts: DataFrame, shared, shingle: int, one_each: bool) -> DataFrame:
    """(a, b): pairs of different components that pass the filters of all orders and may overlap enough by size, place and parity.

    The first order's index brings rows together. Rows of tokens with ``CROWD`` rows or more carry their prefixes under the further
    orders and their parity signatures, so that a pair that a filter drops is never a row there; fewer rows have less than
    ``CROWD`` pairs each, which are looked up and meet the further orders in :func:`verified`. The results are the same.

    ``one_each`` takes one document of each component for a token, a first look that connects most of what belongs
    together; without it, all pairs are looked at. A token with many documents is cut into blocks, and each task pairs two blocks.
    """
    part, whole = SIMILAR
    own = entries.join(known.select(F.col("id").alias("_id"), "component"), F.col("doc_id") == F.col("_id"), "left")
    placed = own.select("token", "doc_id", "n", "place", F.coalesce("component", "doc_id").alias("c"))
    if one_each:
        first = F.min(F.struct("doc_id", "n", "place")).alias("_r")
        placed = placed.groupBy("token", "c").agg(first).select("token", "_r.doc_id", "_r.n", "_r.place", "c")
    placed = cut_lineage(placed)
    mixed = placed.groupBy("token").agg(F.min("c").alias("_lo"), F.max("c").alias("_hi"), F.count("*").alias("_n")).where("_lo < _hi")
    mixed = cut_lineage(mixed.select(F.col("token").alias("_t"), "_n", F.ceil(F.col("_n") / BLOCK).cast("int").alias("_blocks")))
    rows = placed.join(mixed, F.col("token") == F.col("_t")).drop("_t")
    rows = cut_lineage(rows.withColumn("_block", F.pmod(F.xxhash64("doc_id"), F.col("_blocks")).cast("int")))
    drop_table(placed)
    drop_table(mixed)
    pairs = close_enough(paired(rows.where(F.col("_n") < CROWD)), info)
    crowd = rows.where(F.col("_n") >= CROWD)
    if not crowd.isEmpty():
        ids = cut_lineage(crowd.select("doc_id").distinct())
        asked, read = (marked(rows, "doc_id", ids, "_asked").where("_asked") for rows in (info, texts))
        sides = asked.select(F.col("doc_id").alias("_id"), "bits").join(
            heads(read, shared, shingle).withColumnRenamed("doc_id", "_h"), F.col("_id") == F.col("_h")
        )
        pairs = pairs.unionByName(paired(crowd.join(sides, F.col("doc_id") == F.col("_id"))))
    pairs = cut_lineage(pairs.distinct())
    drop_table(rows)
    return pairs


def paired(rows: DataFrame) -> DataFrame:
    """(a, b) of rows with the same token. A task pairs two blocks of it."""
    part, whole = SIMILAR
    cells = F.transform(
        F.sequence(F.lit(0), F.col("_blocks") - 1),
        lambda i: F.struct(F.least(i, F.col("_block")).alias("i"), F.greatest(i, F.col("_block")).alias("j")),
    )
    further = ["bits", *[f"h{k}" for k in range(1, ORDERS)]] if "bits" in rows.columns else []
    dealt = rows.withColumn("_cell", F.explode(cells))
    dealt = dealt.select("token", "doc_id", "n", "place", "c", "_block", "_cell.i", "_cell.j", *further)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_groups(batches, ["token", "i", "j"]):
            yield from pairs_within(batch, part, whole)

    kind = rows.schema["doc_id"].dataType.simpleString()
    ordered = dealt.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
    return ordered.mapInArrow(run, f"a {kind}, b {kind}").distinct()


def edges_of(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """Where groups of equal keys begin in sorted rows, and the end."""
    if not batch.num_rows:
        return np.zeros(1, np.int64)
    new = np.zeros(batch.num_rows - 1, bool)
    for k in keys:
        column = batch.column(k).to_numpy()
        new |= column[1:] != column[:-1]
    return np.concatenate([[0], np.flatnonzero(new) + 1, [batch.num_rows]])


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """The same rows, cut between groups only. A group is at most two blocks, so what is held over is bounded."""
    held = None
    for batch in batches:
        rows = batch if held is None else pa.concat_batches([held, batch])
        last = edges_of(rows, keys)
        cut = int(last[-2]) if len(last) > 1 else 0
        if cut:
            yield rows.slice(0, cut)
        held = rows.slice(cut)
    if held is not None:
        yield held


def medoid(bits: pa.Array) -> int:
    """The row whose parity signature differs least from all others, the first of equals."""
    offsets, words = np.asarray(bits.offsets), np.asarray(bits.values).view(np.uint64)
    width = int(np.diff(offsets).min())
    folded = np.stack([np.bitwise_xor.reduce(words[a:b].reshape(-1, width)) for a, b in zip(offsets[:-1], offsets[1:])])
    return int(np.argmin([np.bitwise_count(folded ^ row).sum(dtype=np.int64) for row in folded]))


def central_pairs(least: DataFrame, known: DataFrame, info: DataFrame) -> DataFrame:
    """(a, b): of documents with the same least token, those of other components with the one in their middle.

    Copies with edits of their own are often too far from one another, but near the text they were made from. The number of pairs
    is that of the rows at most. A token with many documents is cut into blocks with a middle each.
    """
    keys = ["order", "token"]
    own = least.join(known.select(F.col("id").alias("_id"), "component"), F.col("doc_id") == F.col("_id"), "left")
    placed = cut_lineage(own.select(*keys, "doc_id", F.coalesce("component", "doc_id").alias("c")))
    mixed = placed.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.min("c").alias("_lo"), F.max("c").alias("_hi"), F.count("*").alias("_m"))
    mixed = cut_lineage(mixed.where("_lo < _hi AND _m > 2").select("_order", "_token", F.ceil(F.col("_m") / BLOCK).cast("int").alias("_blocks")))
    rows = placed.join(mixed, (F.col("order") == F.col("_order")) & (F.col("token") == F.col("_token")))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("_blocks")).cast("int")).select(*keys, "block", "doc_id", "c")
    rows = rows.join(info.select(F.col("doc_id").alias("_id"), "bits"), F.col("doc_id") == F.col("_id")).drop("_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_groups(batches, [*keys, "block"]):
            edges = edges_of(batch, [*keys, "block"])
            for start, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
                group = batch.slice(start, end - start)
                doc, c = (group.column(k).to_numpy(zero_copy_only=False) for k in ("doc_id", "c"))
                middle = medoid(group.column("bits"))
                others = doc[c != c[middle]]
                centre = np.full(len(others), doc[middle], doc.dtype)
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(others, centre)), pa.array(np.maximum(others, centre))], ["a", "b"])

    kind = least.schema["doc_id"].dataType.simpleString()
    ordered = rows.repartition(*keys, "block").sortWithinPartitions(*keys, "block", "doc_id")
    return ordered.mapInArrow(run, f"a {kind}, b {kind}").distinct()


PAIRS_AT_ONCE = 1 << 18
WORDS_AT_ONCE = 1 << 20  # words of signatures that one step compares
TOKENS_AT_ONCE = 1 << 20  # tokens of prefixes that one step compares
SKETCH = 4096  # bits of the sketch of a prefix


def lists_of(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column, and where each row starts."""
    return np.asarray(column.values).view(kind), np.asarray(column.offsets).astype(np.int64)


def rows_of(values: np.ndarray, offsets: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of the rows ``at``, one row after another, and the number in ``at`` that each is of."""
    sizes = offsets[at + 1] - offsets[at]
    row = np.repeat(np.arange(len(at)), sizes)
    return values[np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + offsets[at][row]], row


class FurtherOrders:
    """Whether the prefixes of two rows meet under each further order: sketches first, then the tokens themselves."""

    def __init__(self, columns: list[pa.Array]):
        self.lists = [lists_of(c, np.uint32) for c in columns]
        self.sketches = []
        for values, offsets in self.lists:
            tokens, row = rows_of(values, offsets, np.arange(len(offsets) - 1))
            bits = np.zeros((len(offsets) - 1, SKETCH // 64), np.uint64)
            np.bitwise_or.at(bits, (row, tokens % SKETCH >> 6), np.uint64(1) << (tokens & 63).astype(np.uint64))
            self.sketches.append(bits)

    def may_meet(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        ok, step = np.ones(len(x), bool), WORDS_AT_ONCE * 64 // SKETCH
        for at in range(0, len(x), step):
            cut = slice(at, at + step)
            for bits in self.sketches:
                ok[cut] &= (bits[x[cut]] & bits[y[cut]]).any(1)
        return ok

    def meet(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        ok = np.ones(len(x), bool)
        for values, offsets in self.lists:
            sizes = np.diff(offsets)
            total = np.cumsum(sizes[x] + sizes[y])
            at = 0
            while at < len(x):
                before = total[at - 1] if at else 0
                end = max(at + 1, int(np.searchsorted(total, before + TOKENS_AT_ONCE, "right")))
                ok[at:end] &= common([rows_of(values, offsets, side[at:end]) for side in (x, y)], end - at) > 0
                at = end
        return ok


class Signatures:
    """Parity signatures of rows, folded to each narrower width."""

    def __init__(self, column: pa.Array):
        values, offsets = lists_of(column, np.uint64)
        self.width = np.diff(offsets)
        self.folded, self.line = {}, {}
        for width in np.unique(self.width).tolist():
            fit = np.flatnonzero(self.width >= width)
            rows = [np.bitwise_xor.reduce(values[offsets[r] : offsets[r + 1]].reshape(-1, width)) for r in fit]
            self.folded[width], self.line[width] = np.stack(rows), np.cumsum(self.width >= width) - 1

    def apart(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Bits in which two rows differ, at the narrower width: no more than the tokens that one of them has alone."""
        width, out = np.minimum(self.width[x], self.width[y]), np.zeros(len(x), np.int64)
        for w, folded in self.folded.items():
            which, line = np.flatnonzero(width == w), self.line[w]
            for at in range(0, len(which), WORDS_AT_ONCE // w):
                some = which[at : at + WORDS_AT_ONCE // w]
                out[some] = np.bitwise_count(folded[line[x[some]]] ^ folded[line[y[some]]]).sum(1, dtype=np.int64)
        return out


def pairs_within(batch: pa.RecordBatch, part: int, whole: int) -> Iterator[pa.RecordBatch]:
    """Pairs of rows of a group, of different components and from its two blocks, that no filter rules out."""
    names = ("doc_id", "n", "place", "c", "_block", "i", "j")
    doc, n, place, c, block, i, j = (batch.column(k).to_numpy(zero_copy_only=False) for k in names)
    carried = "bits" in batch.schema.names
    if carried:
        orders = FurtherOrders([batch.column(f"h{k}") for k in range(1, ORDERS)])
        signatures = Signatures(batch.column("bits"))
    edges = edges_of(batch, ["token", "i", "j"])
    later = np.repeat(edges[1:], np.diff(edges)) - np.arange(batch.num_rows) - 1
    upto = np.concatenate([[0], np.cumsum(later)])
    row = 0
    while row < batch.num_rows:
        end = max(row + 1, int(np.searchsorted(upto, upto[row] + PAIRS_AT_ONCE, "right")) - 1)
        x = np.repeat(np.arange(row, end), later[row:end])
        y = x + 1 + np.arange(len(x)) - (upto[x] - upto[row])
        least, most = np.minimum(n[x], n[y]).astype(np.int64), np.maximum(n[x], n[y]).astype(np.int64)
        shared = np.minimum(place[x], place[y]) + np.minimum(n[x] - place[x], n[y] - place[y])
        ok = (c[x] != c[y]) & (least * whole >= most * part) & (shared * (whole + part) >= part * (least + most))
        ok &= (i[x] == j[x]) | (block[x] != block[y])
        x, y = x[ok], y[ok]
        if carried:
            ok = orders.may_meet(x, y)
            x, y = x[ok], y[ok]
            ok = signatures.apart(x, y) * (whole + part) <= (n[x].astype(np.int64) + n[y]) * (whole - part)
            x, y = x[ok], y[ok]
            ok = orders.meet(x, y)
            x, y = x[ok], y[ok]
        a, b = doc[x], doc[y]
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])
        row = end


def without_copies(docs: DataFrame, named: DataFrame, equal: DataFrame) -> DataFrame:
    """``docs`` less documents whose set equals that of a smaller id, without a shuffle of texts; a few may stay.

    A Bloom filter of copies drops rows; a second one, of the ids that the first takes for copies by mistake, brings those back.
    """
    copies = equal.select(F.col("b").alias("_id")).distinct()
    mistaken = marked(named, "doc_id", copies, "_copy").where("_copy").join(copies, F.col("doc_id") == F.col("_id"), "left_anti")
    back = cut_lineage(mistaken.select("doc_id"))
    tested = marked(marked(docs, "doc_id", copies, "_copy"), "doc_id", back, "_back")
    return tested.where("NOT _copy OR _back").drop("_copy", "_back")


def counter_number(rows: int, most: int = COUNTERS) -> int:
    """Counters of the sketch: about 64 for a document, a power of two, at most ``most``."""
    return min(most, max(PART, 1 << (64 * max(1, rows) - 1).bit_length()))


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Rows go to Python in batches of ``BATCH_BYTES``, not of a number of rows, whose texts and lists can take any memory."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def link(docs: DataFrame, shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n) of every row, and (id, component) of every document with a link. All steps run here, so none is left to run later."""
    with small_batches(docs.sparkSession):
        return linked(docs, shingle)


def linked(docs: DataFrame, shingle: int) -> tuple[DataFrame, DataFrame]:
    spark = docs.sparkSession
    counters = counter_number(docs.count())
    both = cut_lineage(profile(docs, counters, shingle))
    shared = spark.sparkContext.broadcast(merged_sketch(both.where("part IS NOT NULL").select("part", "counts"), counters))
    found = both.where("part IS NULL").drop("part", "counts")
    info = cut_lineage(found.select("doc_id", "n"))
    named = cut_lineage(found.where("doc_id IS NOT NULL AND n > 0").dropDuplicates(["doc_id"]))
    drop_table(both)
    equal = cut_lineage(stars(named.select("doc_id", "n", "k1", "k2"), ["n", "k1", "k2"]))
    single = without_copies(docs.where("doc_id IS NOT NULL").select("doc_id", "text"), named, equal)
    least = cut_lineage(least_tokens(single, shingle))
    near = cut_lineage(close_enough(stars(least, ["order", "token"]).join(equal, ["a", "b"], "left_anti"), named))
    first = equal.unionByName(verified(docs, near, shared, shingle))
    known = cut_lineage(components(first))
    middle = cut_lineage(close_enough(central_pairs(least, known, named).join(near, ["a", "b"], "left_anti"), named))
    if not middle.isEmpty():
        known = connected(known, verified(docs, middle, shared, shingle))
    drop_table(least)
    prefixes = int(named.agg(F.sum(F.ceil(F.col("n") * (SIMILAR[1] - SIMILAR[0]) / SIMILAR[1]) + 1)).first()[0] or 0)
    buckets = row_count_partitions(prefixes, BUCKET)
    entries = cut_lineage(shared_entries(index_entries(single, shared, shingle, buckets)))
    looked = across(entries, known, named, single, shared, shingle, one_each=True)
    known = connected(known, verified(docs, looked, shared, shingle))
    rest = across(entries, known, named, single, shared, shingle, one_each=False)
    drop_table(entries)
    rest = cut_lineage(rest.join(looked, ["a", "b"], "left_anti"))
    return info, known if rest.isEmpty() else connected(known, verified(docs, rest, shared, shingle))


def connected(known: DataFrame, links: DataFrame) -> DataFrame:
    stems = known.select(F.col("component").alias("a"), F.col("id").alias("b")).where("a < b")
    return cut_lineage(components(stems.unionByName(links)))


def join(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    info, known = link(docs, shingle)
    out = info.join(known.select(F.col("id").alias("_id"), "component"), F.col("doc_id") == F.col("_id"), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def keep(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` less every document that is not the smallest id of its component."""
    _, known = link(docs, shingle)
    gone = cut_lineage(known.where("id != component").select(F.col("id").alias("_id")))
    suspects = marked(docs, "doc_id", gone, "_gone")
    looked = suspects.where("_gone").join(gone, F.col("doc_id") == F.col("_id"), "left_anti")
    return suspects.where("NOT _gone").unionByName(looked).select(*docs.columns)
