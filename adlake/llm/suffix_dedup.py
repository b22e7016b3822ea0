"""Removal of byte strings that occur earlier, by suffix sorting of the places where such strings can be.

A string of ``SPAN`` bytes is owned by the least hashed ``GRAM``-byte piece in it, which depends on its bytes alone, so
equal strings have equal owners. Runs of string starts with one owner are the unit of work: a run and its context (the
bytes its strings cover). Owners that occur once cannot repeat anything and go. Runs whose whole context occurred before
are removed without a look at their bytes. What is left, the first runs of owners with several contexts, is partitioned by
owner into shards; each shard is suffix sorted (see ``suffix_sort``), and equal strings stand side by side with a common
prefix of ``SPAN`` or more; all but the earliest are marked. Owners whose contexts exceed a shard are not sorted: their
strings meet by hashes, in any number of tasks.

No step holds a document group: owners are counted with a combine before the shuffle, contexts of one owner are distinct,
and a shard is sorted in pieces of whole owners of bounded size. Texts shuffle once, and only of documents that lose bytes.

Defined cases: NULL counts as empty; documents shorter than ``SPAN`` bytes stay whole; rows with a NULL id stay whole;
rows that repeat an id are one document (a string is not earlier than its own repetition); extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import IdFilter, Powers, Rolling, byte_codes, flat_bytes, mix, slices
from adlake.llm.suffix_sort import repeated_strings
from adlake.session import cut_lineage

SPAN = 100
GRAM = 32
TEXT_BYTES = 1 << 19  # bytes of text of a numpy step; a dozen arrays of eight bytes for each of them are made
PLACE_BITS = 28
LONGEST = 1 << 27  # a longer text is looked at in pieces that overlap
SHARD_BYTES = 1 << 20  # contexts sorted at a time; owners with more are not sorted, see ``repeats_of_hot_owners``


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours, by doubling."""
    done = 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    return np.minimum(values[: len(values) - (width - done)], values[width - done :]) if width > done else values


def runs_of(data: np.ndarray, offsets: np.ndarray, powers: Powers, codes: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, start, strings, owner key, context hash) of the runs of a block; starts count from the block's begin."""
    strings_at = len(data) - SPAN + 1
    if strings_at <= 0:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    rolling = Rolling(data, powers, codes)
    at = np.arange(len(data) - GRAM + 1)
    grams = rolling(at, at + GRAM)
    low = np.uint64((1 << PLACE_BITS) - 1)
    owner = (sliding_least((grams & ~low) | at.astype(np.uint64), SPAN - GRAM + 1) & low).astype(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:strings_at]
    valid = np.arange(strings_at) + SPAN <= offsets[1:][row]
    begins = valid.copy()
    begins[1:] &= ~valid[:-1] | (owner[1:] != owner[:-1]) | (row[1:] != row[:-1])
    starts = np.flatnonzero(begins)
    # A run ends where the next begins or strings of its row end.
    ends = np.minimum(np.append(starts[1:], len(data)), offsets[1:][row[starts]] - SPAN + 1) if len(starts) else starts
    return row[starts], starts, ends - starts, grams[owner[starts]], mix(rolling(starts, ends + SPAN - 1) ^ np.uint64(SPAN))


def pieces_of(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(bytes, offsets, place of the first byte in its text); several pieces only for a very long text of its own."""
    data, offsets = flat_bytes(batch.column("text"))
    if len(data) <= LONGEST:
        yield data, offsets, 0
        return
    for at in range(0, len(data) - SPAN + 1, LONGEST):
        part = data[at : at + LONGEST + SPAN - 1]
        yield part, np.array([0, len(part)]), at


def owner_counts(docs: DataFrame) -> DataFrame:
    """(key) of owners with two runs or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, codes = Powers(), byte_codes()
        for whole in batches:
            for batch in slices(whole, "text", TEXT_BYTES):
                for data, offsets, _ in pieces_of(batch):
                    key, n = np.unique(runs_of(data, offsets, powers, codes)[3], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], ["key", "n"])

    counts = docs.select("text").mapInArrow(run, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    return counts.where("n > 1").select("key")


def emit_runs(docs: DataFrame, owners: IdFilter, contexts: bool) -> DataFrame:
    """(doc_id, start, strings, key, hash[, context]) of the runs whose owner may be in ``owners``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared, size = owners.shared, owners.size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, codes, bits, mask = Powers(), byte_codes(), shared.value, np.uint64(size - 1)
        for whole in batches:
            for batch in slices(whole, "text", TEXT_BYTES):
                for data, offsets, base in pieces_of(batch):
                    row, start, strings, key, context = runs_of(data, offsets, powers, codes)
                    slots = [(k & mask).astype(np.int64) for k in (key, key >> np.uint64(32))]
                    hits = [(bits[s >> 3] >> (s & 7)) & 1 for s in slots]
                    at = np.flatnonzero(hits[0] & hits[1])
                    row, start, strings = row[at], start[at], strings[at]
                    columns = [batch.column("doc_id").take(pa.array(row)), pa.array(start - offsets[:-1][row] + base),
                               pa.array(strings), pa.array(key[at].view(np.int64)), pa.array(context[at].view(np.int64))]
                    names = ["doc_id", "start", "strings", "key", "hash"]
                    if contexts:
                        text = data.tobytes()
                        ends = start + strings + SPAN - 1
                        columns.append(pa.array([text[a:b] for a, b in zip(start.tolist(), ends.tolist(), strict=True)], pa.binary()))
                        names.append("context")
                    yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"doc_id {kind}, start bigint, strings bigint, key bigint, hash bigint"
    return docs.select("doc_id", "text").mapInArrow(run, schema + (", context binary" if contexts else ""))


def marked_runs(contexts: DataFrame) -> DataFrame:
    """(doc_id, begin, end) of the bytes in strings that occur earlier, from the first runs of owners."""
    kind = contexts.schema["doc_id"].dataType.simpleString()

    def flush(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).sort_by([("doc_id", "ascending"), ("start", "ascending")]).combine_chunks()
        data, offsets = flat_bytes(table.column("context").chunk(0).cast(pa.large_binary()).view(pa.large_string()))
        start = table.column("start").to_numpy()
        # Contexts are in order of their place in the corpus, so of equal strings the one first in the shard is earliest.
        hit = repeated_strings(data, offsets, SPAN)
        row = np.searchsorted(offsets, hit, "right") - 1
        first = np.ones(len(hit), bool)
        first[1:] = (hit[1:] != hit[:-1] + 1) | (row[1:] != row[:-1])
        begins = np.flatnonzero(first)
        ends = np.append(begins[1:], len(hit)) - 1 if len(hit) else begins
        place = hit - offsets[:-1][row] + start[row]
        doc = table.column("doc_id").combine_chunks().take(pa.array(row[begins]))
        doc = doc.chunk(0) if isinstance(doc, pa.ChunkedArray) else doc
        return pa.RecordBatch.from_arrays([doc, pa.array(place[begins]), pa.array(place[ends] + SPAN)], ["doc_id", "begin", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            key = batch.column("key").to_numpy()
            edges = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if a == b:
                    continue
                if size >= SHARD_BYTES and key[a] != last:
                    yield flush(held)
                    held, size = [], 0
                part = batch.slice(a, b - a)
                held.append(part)
                size += part.column("context").nbytes
                last = key[a]
        if held:
            yield flush(held)

    rows = contexts.select("doc_id", "start", "key", "context").repartition("key").sortWithinPartitions("key")
    return rows.mapInArrow(run, f"doc_id {kind}, begin bigint, end bigint")


def hot_strings(contexts: DataFrame) -> DataFrame:
    """(doc_id, start, key, h1, h2) of every string in ``contexts``; the hashes differ in their byte codes."""
    kind = contexts.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, codes = Powers(), byte_codes()
        others = mix(codes)
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                data, offsets = flat_bytes(batch.column("context").cast(pa.large_binary()).view(pa.large_string()))
                strings = np.diff(offsets) - SPAN + 1
                row = np.repeat(np.arange(len(strings)), strings)
                inside = np.arange(len(row)) - np.repeat(np.cumsum(strings) - strings, strings)
                begin = offsets[:-1][row] + inside
                hashes = [Rolling(data, powers, c)(begin, begin + SPAN) for c in (codes, others)]
                start = batch.column("start").to_numpy()[row] + inside
                taken = [batch.column(c).take(pa.array(row)) for c in ("doc_id", "key")]
                yield pa.RecordBatch.from_arrays(
                    [taken[0], pa.array(start), taken[1], *[pa.array(h.view(np.int64)) for h in hashes]],
                    ["doc_id", "start", "key", "h1", "h2"],
                )

    return contexts.select("doc_id", "start", "key", "context").mapInArrow(
        run, f"doc_id {kind}, start bigint, key bigint, h1 bigint, h2 bigint"
    )


def repeats_of_hot_owners(contexts: DataFrame) -> DataFrame:
    """(doc_id, begin, end) of the strings that occur earlier, for owners with too many contexts to sort in one task.

    Equal strings meet by owner and two 64-bit hashes, wherever they are: hashes are counted with a combine, only strings
    whose first hash may repeat go on, and the earliest of equal strings is a minimum with a combine. No task holds an owner.
    """
    strings = hot_strings(contexts)
    twice = IdFilter(cut_lineage(strings.groupBy("h1").count().where("count > 1").select("h1")), "h1", hashed=True)
    left = cut_lineage(strings.where(twice.may_hold(F.col("h1"))))
    keys = ["key", "h1", "h2"]
    first = left.groupBy(*keys).agg(F.min(F.struct("doc_id", "start")).alias("f"), F.count("*").alias("_n")).where("_n > 1")
    first = cut_lineage(first.select(*[F.col(k).alias(f"_{k}") for k in keys], "f"))
    met = left.join(first, [F.col(k) == F.col(f"_{k}") for k in keys]).where("doc_id != f.doc_id OR start != f.start")
    return met.select("doc_id", F.col("start").alias("begin"), (F.col("start") + SPAN).alias("end"))


def spans(docs: DataFrame) -> DataFrame:
    """(doc_id, begin, end) of repeated bytes; spans of a document may overlap."""
    known = docs.where("doc_id IS NOT NULL").select("doc_id", "text")
    owners = IdFilter(cut_lineage(owner_counts(known)), "key", hashed=True)
    runs = cut_lineage(emit_runs(known, owners, contexts=False))
    first = runs.groupBy("key", "hash").agg(F.min(F.struct("doc_id", "start")).alias("f"), F.max("strings").alias("strings"))
    first = cut_lineage(first.select(F.col("key").alias("_k"), F.col("hash").alias("_h"), "f", F.col("strings").alias("_n")))
    met = runs.join(first, (F.col("key") == F.col("_k")) & (F.col("hash") == F.col("_h")))
    later = met.where("doc_id != f.doc_id OR start != f.start").select(
        "doc_id", F.col("start").alias("begin"), (F.col("start") + F.col("strings") + SPAN - 1).alias("end")
    )
    size = F.sum(F.col("_n") + SPAN - 1)
    several = first.groupBy("_k").agg(F.count("*").alias("_c"), size.alias("_size")).where("_c > 1")
    several = cut_lineage(several.select(F.col("_k").alias("key"), (F.col("_size") > SHARD_BYTES).alias("hot")))
    asked = first.join(several, F.col("_k") == F.col("key")).select(F.col("f.doc_id").alias("_d"), F.col("f.start").alias("_s"), "hot")
    asked = cut_lineage(asked)

    def contexts(hot: bool) -> DataFrame:
        found = emit_runs(known, IdFilter(several.where(F.col("hot") == hot), "key", hashed=True), contexts=True)
        wanted = asked.where(F.col("hot") == hot).drop("hot")
        met = found.join(wanted, (F.col("doc_id") == F.col("_d")) & (F.col("start") == F.col("_s")))
        return met.dropDuplicates(["doc_id", "start"])

    marked = later.unionByName(marked_runs(contexts(False)))
    if several.where("hot").isEmpty():
        return marked
    return marked.unionByName(repeats_of_hot_owners(cut_lineage(contexts(True))))


def deduplicate(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    per_doc = spans(docs).groupBy("doc_id").agg(F.sort_array(F.collect_set(F.struct("begin", "end"))).alias("spans"))
    per_doc = cut_lineage(per_doc.withColumnRenamed("doc_id", "_d"))
    loses = IdFilter(per_doc, "_d").may_hold(F.col("doc_id"))
    marked = docs.select("doc_id", "text").withColumn("_loses", F.coalesce(loses, F.lit(False)))
    cut = marked.where("_loses").join(per_doc, F.col("doc_id") == F.col("_d"), "left").select("doc_id", "text", "spans")
    whole = marked.where("NOT _loses").select("doc_id", "text", F.lit(None).cast(per_doc.schema["spans"].dataType).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for batch in slices(whole_batch, "text"):
                out = []
                for text, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                    data, kept, removed, count, end = (text or "").encode(), hashlib.sha256(), 0, 0, 0
                    for s in found or ():
                        if s["begin"] > end or (count == 0):
                            kept.update(data[end : s["begin"]])
                            removed, count, end = removed + s["end"] - s["begin"], count + 1, s["end"]
                        elif s["end"] > end:
                            removed, end = removed + s["end"] - end, s["end"]
                    kept.update(data[end:])
                    out.append((len(data), removed, count, kept.hexdigest()))
                columns = [batch.column("doc_id"), *[pa.array(list(c)) for c in zip(*out, strict=True)]]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return cut.unionByName(whole).mapInArrow(run, schema)
