"""Best-fit packing of tokenised documents into sequences by minimum bin slack.

A sequence starts with the longest piece left. A bitset subset-sum over the lengths still available, with their counts,
finds the fullest combination that fits beside it; the combination is taken as often as the counts allow and removed.
This works on the counts of pieces per length, at most ``capacity`` numbers whatever the corpus, and ends after at most a
few steps per length. Spark counts the lengths, and ranks the pieces of each length (in salted groups, since one length
may hold a third of all rows); a piece's rank says which combination and place is its own.

Tokens: a text is normalised and split into chunks as the vocabulary prescribes; the tokenizer's ids of each chunk are
remembered per worker. Texts with the tokenizer's own control strings, or with separators that Python and the tokenizer
class differently, are encoded whole. Both ways give the ids of the whole text.

Defined cases: NULL and empty texts hold the closing id alone; repeated rows are packed each; extra columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator, Mapping
from itertools import groupby

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlake.llm.common import row_count_partitions, slices
from adlake.session import cut_lineage

CAPACITY = 4096
END_ID = 1
VOCABULARY = "word_bpe_49k.json"
SALTS = 64  # least number of rank groups of a length
ROWS_PER_SALT = 1_000_000
REMEMBERED = 600_000  # chunks a worker remembers before it starts afresh

ODD_SPACE = "\x1c\x1d\x1e\x1f"  # white space to Python only
# The vocabulary's own splitter, on normalised text.
CHUNK = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
# Scripts whose characters are normal as they stand, never compose and have one small letter, in Python and in the tokenizer:
# Latin less the dotted capital I, Cyrillic less its combining marks, kana, Chinese characters and Korean syllables.
PLAIN = [(0x0, 0x12F), (0x131, 0x17F), (0x400, 0x482), (0x48A, 0x52F), (0x3041, 0x3096), (0x30A1, 0x30FA), (0x4E00, 0x9FEF), (0xAC00, 0xD7A3)]
NOT_PLAIN = re.compile("[^" + "".join(f"{chr(a)}-{chr(b)}" for a, b in PLAIN) + "]")


def plain_chunk() -> re.Pattern[str]:
    """``CHUNK`` for texts of ``PLAIN`` characters, with letters and numbers spelled out for Python's own, faster expressions."""
    kinds = {"L": "", "N": ""}
    for a, b in PLAIN:
        for kind, run in groupby(range(a, b + 1), lambda c: unicodedata.category(chr(c))[0]):
            if kind in kinds:
                places = list(run)
                kinds[kind] += f"{chr(places[0])}-{chr(places[-1])}"
    return re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[{L}]+|[{N}]|[^\s{L}{N}]+".format(**kinds))


PLAIN_CHUNK = plain_chunk()
ASCII_CHUNK = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")  # of small letters


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it prints, else one from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return {b: 256 + n for n, b in enumerate(others)}


class ChunkIds(dict):
    """Ids of a chunk of normalised text as little-endian 32-bit numbers."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.letters = Tokenizer.from_file(path), byte_letters()

    @staticmethod
    def pack(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, chunk: str) -> bytes:
        if len(self) > REMEMBERED:
            self.clear()
        letters = chunk if chunk.isascii() and chunk.isprintable() else chunk.encode().decode("latin-1").translate(self.letters)
        got = self[chunk] = self.pack([t.id for t in self.tokenizer.model.tokenize(letters)])
        return got

    def whole(self, text: str) -> bytes:
        return self.pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def text(self, text: str) -> bytes:
        if "<|" in text or any(c in text for c in ODD_SPACE):
            return self.whole(text)
        return b"".join(map(self.__getitem__, self.chunks(text)))

    def chunks(self, text: str) -> list[str]:
        if text.isascii():
            return ASCII_CHUNK.findall(text.lower())
        if NOT_PLAIN.search(text):
            return CHUNK.findall(self.tokenizer.normalizer.normalize_str(text))
        return PLAIN_CHUNK.findall(text.lower())


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every document."""
    path, closing = path or vocabulary_path(), np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = ChunkIds(path)
        for whole in batches:
            for batch in slices(whole, "text"):
                out = []
                for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                    ids = known.text(text or "") + closing
                    for number, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at : at + 4 * capacity]
                        out.append((doc, number, at // 4, len(part) // 4, zlib.crc32(part)))
                columns = [list(c) for c in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    key = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    kinds = [pa.string() if key == "string" else pa.int32() if key == "int" else pa.int64(), pa.int32(), *[pa.int64()] * 3]
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {key}, piece int, start bigint, length bigint, ids_crc32 bigint"
    )


def fullest(room: int, counts: Mapping[int, int]) -> list[int]:
    """Lengths, each at most as often as counted, with the largest sum up to ``room``: bit s of ``reach`` says that s can be made."""
    reach, mask, trail = 1, (1 << (room + 1)) - 1, []
    for length in sorted((n for n in counts if n <= room), reverse=True):
        for _ in range(min(counts[length], room // length)):
            wider = (reach | reach << length) & mask
            if wider == reach:
                break
            trail.append((length, reach))
            reach = wider
            if reach >> room & 1:
                break
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, []
    for length, before in reversed(trail):
        if total >= length and not before >> total & 1:
            chosen.append(length)
            total -= length
    return chosen


def plan(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """(lengths of a sequence, longest first; how many such sequences)"""
    left = {n: c for n, c in counts.items() if c > 0}
    sequences = []
    while left:
        longest = max(left)
        rest = dict(left)
        rest[longest] -= 1
        chosen = [longest, *fullest(capacity - longest, rest)]
        need = {n: chosen.count(n) for n in chosen}
        times = min(left[n] // c for n, c in need.items())
        for n, c in need.items():
            left[n] -= times * c
            if not left[n]:
                del left[n]
        sequences.append((chosen, times))
    return sequences


def places(sequences: list[tuple[list[int], int]]) -> dict[str, np.ndarray]:
    """For each length in each kind of sequence: the ranks it takes, the first sequence, and where its pieces stand."""
    rows, used, sequence = [], {}, 0
    for chosen, times in sequences:
        offset = 0
        for length in dict.fromkeys(chosen):
            each = chosen.count(length)
            rows.append((length, used.get(length, 0), sequence, each, offset))
            used[length] = used.get(length, 0) + times * each
            offset += each * length
        sequence += times
    rows.sort()
    names = ("length", "rank", "sequence", "each", "offset")
    return {n: np.array([r[i] for r in rows], np.int64) for i, n in enumerate(names)}


def assign(table: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``table`` of pieces with sequence_id and offset."""
    # At most one row per length.
    counts = {r.length: r["n"] for r in table.groupBy("length").agg(F.count("*").alias("n")).collect()}
    shared = table.sparkSession.sparkContext.broadcast(places(plan(counts, capacity)))
    salts = row_count_partitions(sum(counts.values()), ROWS_PER_SALT, SALTS)
    salted = table.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    sizes = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("length").alias("_l"), F.col("_salt").alias("_s"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    inside = F.row_number().over(Window.partitionBy("length", "_salt").orderBy("doc_id", "piece")) - 1
    ranked = salted.withColumn("_inside", inside).join(starts, (F.col("length") == F.col("_l")) & (F.col("_salt") == F.col("_s")))
    ranked = ranked.select(*table.columns, (F.col("_start") + F.col("_inside")).alias("_rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = shared.value
        keys = at["length"] << 44 | at["rank"]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "_rank"))
            row = np.searchsorted(keys, length << 44 | rank, "right") - 1
            turn = rank - at["rank"][row]
            sequence = at["sequence"][row] + turn // at["each"][row]
            offset = at["offset"][row] + turn % at["each"][row] * length
            columns = [*batch.columns[:-1], pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "sequence_id", "offset"])

    schema = ", ".join(f"{n} {t}" for n, t in table.dtypes)
    return ranked.mapInArrow(run, f"{schema}, sequence_id bigint, offset bigint")


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return assign(cut_lineage(pieces(docs, capacity, path, end_id)), capacity)
