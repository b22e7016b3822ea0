"""Exact, fuzzy-line, byte-string and Jaccard deduplication against brute force."""

import hashlib
import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from adlake.llm import exact_dedup, jaccard_join, line_dedup, suffix_dedup
from adlake.llm.common import marked
from adlake.llm.components import components
from adlake.session import intermediate_folder

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(draw, words, size=400):
    return " ".join(f"{draw.choice('abcdefg')}{draw.randrange(size)}" for _ in range(words))


@pytest.fixture(scope="module")
def corpus():
    """Exact and near copies, a hot group of each, a common passage, short and odd texts, repeated rows."""
    draw = random.Random(5)
    passage, base = prose(draw, 60), prose(draw, 120)
    texts = [None, "", " \n ", "one", "One", "one  ", "two words", "two\twords", "a b c d e", "A B C D E", "ä ö ü ß é"]
    texts += [prose(draw, draw.randint(3, 90)) for _ in range(40)]
    texts += [prose(draw, 50) + " " + passage + "\n" + prose(draw, 50) for _ in range(30)]
    texts += [base] * 40 + [base + " "] * 3
    for _ in range(60):
        words = base.split()
        for _ in range(draw.randint(1, 3)):
            words[draw.randrange(len(words))] = f"edit{draw.randrange(10**6)}"
        texts.append(" ".join(words))
    chain = base.split()
    for i in range(12):  # each is near the one before, far from the first
        chain[i * 9 % len(chain)] = f"chain{i}"
        texts.append(" ".join(chain))
    texts += [prose(draw, 4000), "z" * 1000, "z" * 1000 + "y", passage + "\n" + passage]
    draw.shuffle(texts)
    return list(enumerate(texts, 10)) + [(10, texts[0])]


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def test_components_of_chains_and_stars(spark):
    chain = [(i + 1, i) for i in range(0, 40)] + [(100, i) for i in range(101, 300)] + [(500, 501), (7, 7), (501, 500)]
    draw = random.Random(1)
    draw.shuffle(chain)
    got = dict(components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 300)} | {500: 500, 501: 500}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("per_row, max_slots", [(exact_dedup.SLOTS_PER_ROW, exact_dedup.MAX_SLOTS), (600, exact_dedup.BITMAP_BITS)])
def test_exact_groups(docs, corpus, per_row, max_slots, monkeypatch):
    """With one filter, and with one for each of several slices."""
    monkeypatch.setattr(exact_dedup, "SLOTS_PER_ROW", per_row)
    table = docs(corpus)
    groups = {}
    for i, text in corpus:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", "", text or ""), []).append((-len(text or ""), i))
    got = exact_dedup.deduplicate(table, max_slots=max_slots).collect()
    assert len(got) == len(corpus)
    texts = dict(corpus)
    for r in got:
        bare = re.sub(r"[\x20\x09-\x0D]+", "", texts[r.doc_id] or "")
        best = min(groups[bare])[1]
        assert (r.keep_id, r.group_size, r.kept) == (best, len(groups[bare]), r.doc_id == best)
        assert r.text_sha256 == hashlib.sha256(bare.encode()).hexdigest()
    kept = exact_dedup.keep(table, max_slots=max_slots)
    assert kept.columns == table.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(min(g)[1] for g in groups.values())


def test_exact_empty_and_null_ids(docs):
    assert exact_dedup.deduplicate(docs([]).limit(0)).count() == 0
    got = exact_dedup.deduplicate(docs([(None, "a"), (None, "b"), (1, "b c")])).collect()
    assert sorted(r.group_size for r in got) == [1, 1, 1]
    assert exact_dedup.keep(docs([(None, "a"), (None, "a"), (1, "b")])).count() == 2


def brute_jaccard(corpus):
    sets = {}
    for i, text in corpus:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}
    parent = {i: i for i in sets}
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            inside = len(sets[a] & sets[b])
            if inside and 100 * inside >= 75 * len(sets[a] | sets[b]):
                x, y = find(parent, a), find(parent, b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(parent, i)) for i in sets}


@pytest.mark.parametrize("block, crowd", [(jaccard_join.BLOCK, jaccard_join.CROWD), (8, 2)])
def test_jaccard_components(docs, corpus, block, crowd, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "CROWD", crowd)  # at 2, every row carries its further prefixes and its signature
    want = brute_jaccard(corpus)
    table = docs(corpus)
    got = jaccard_join.join(table).collect()
    assert len(got) == len(corpus)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    kept = jaccard_join.keep(table)
    assert kept.columns == table.columns
    assert {r.doc_id for r in kept.collect()} == {c for _, c in want.values()}


def test_jaccard_without_links_or_rows(docs):
    assert jaccard_join.join(docs([]).limit(0)).count() == 0
    got = jaccard_join.join(docs([(1, "a b"), (2, "c d"), (3, None), (None, "a b")])).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == ["(1, 1, 1)", "(2, 1, 2)", "(3, 0, 3)", "(None, 1, None)"]


def python_steps(rows):
    plan = rows._jdf.queryExecution().executedPlan().toString()
    return sum(plan.count(x) for x in ("MapInArrow", "ArrowEvalPython", "BatchEvalPython"))


def test_jaccard_reads_texts_with_one_worker_a_task(docs, corpus):
    """Every further Python step above a scan is a further worker of each task that is running."""
    table = docs(corpus).select("doc_id", "text")
    named = table.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    equal = named.where("doc_id % 3 = 1").select(F.lit(0).alias("a"), F.col("doc_id").alias("b"))
    single = jaccard_join.without_copies(table.where("doc_id IS NOT NULL"), named, equal)
    want = {d for d, *_ in corpus if d is not None and d % 3 != 1}
    assert want <= {r.doc_id for r in single.collect()}
    assert len(want) <= single.select("doc_id").distinct().count() <= len(want) + len(corpus) // 10
    assert python_steps(jaccard_join.least_tokens(single, 5)) == 1


@pytest.mark.parametrize("buckets, at_once", [(1, 1 << 17), (7, 40)])
def test_jaccard_index_in_buckets(spark, docs, corpus, buckets, at_once, monkeypatch):
    """The index shuffles lists, far fewer rows than entries, and keeps every token that two documents have."""
    monkeypatch.setattr(jaccard_join, "ENTRIES", at_once)
    table = docs([r for r in corpus if r[0] is not None]).dropDuplicates(["doc_id"]).coalesce(1)
    shared = spark.sparkContext.broadcast(np.zeros(jaccard_join.PART, np.uint8))
    packed = jaccard_join.index_entries(table, shared, 5, buckets)
    flat = [(t, d, n, p) for r in packed.collect() for t, d, n, p in zip(r.token, r.doc_id, r.n, r.place)]
    assert len(flat) == len(set(flat)) > (100 if buckets == 1 else 2) * packed.count()
    times = Counter(t for t, *_ in flat)
    kept = jaccard_join.shared_entries(packed).collect()
    assert sorted((r.token, r.doc_id, r.n, r.place) for r in kept) == sorted(x for x in flat if times[x[0]] > 1)


def test_jaccard_counts_and_tables_are_small(spark, docs, corpus):
    """Counters take as many bytes as the largest needs, and tables of counters and of the index go once they are used."""
    for most, width in ((255, 1), (256, 2), (1 << 16, 4)):
        counts = np.zeros(jaccard_join.PART, np.uint64)
        counts[5] = most
        assert len(jaccard_join.narrowed(counts)) == width * jaccard_join.PART
        assert (jaccard_join.widened(jaccard_join.narrowed(counts)) == counts).all()
    folder = Path(intermediate_folder(spark).removeprefix("file:"))
    before = set(folder.iterdir()) if folder.exists() else set()
    jaccard_join.link(docs(corpus[:60]).select("doc_id", "text"))
    for left in set(folder.iterdir()) - before:
        names = spark.read.parquet(str(left)).columns
        assert not {"_block", "place"} & set(names) and not {"bits", "counts"} <= set(names)


def test_marked_ids(spark):
    rows = spark.range(2000).selectExpr("if(id % 100 = 7, NULL, id) AS doc_id", "id AS x")
    ids = spark.range(0, 2000, 10).toDF("_id")
    got = marked(rows, "doc_id", ids, "hit")
    assert got.columns == ["doc_id", "x", "hit"]
    hits = {r.x for r in got.where("hit AND doc_id IS NOT NULL").collect()}
    assert got.count() == 2000 and set(range(0, 2000, 10)) <= hits and len(hits) < 300
    assert marked(rows, "doc_id", ids.limit(0), "hit").where("hit OR hit IS NULL").count() == 0


def test_jaccard_prefixes_meet_in_bounded_steps(monkeypatch):
    lists = [pa.array([[1, 2], [2, 3], [4], [], [1, 4]], pa.list_(pa.int32()))]
    x, y = np.array([0, 0, 1, 2, 3, 0]), np.array([1, 2, 2, 4, 4, 4])
    most = []
    plain = jaccard_join.common
    monkeypatch.setattr(jaccard_join, "TOKENS_AT_ONCE", 4)
    monkeypatch.setattr(jaccard_join, "common", lambda sides, rows: most.append(sum(len(s[0]) for s in sides)) or plain(sides, rows))
    assert jaccard_join.FurtherOrders(lists).meet(x, y).tolist() == [True, False, False, True, False, True]
    assert max(most) <= 4


def brute_spans(corpus, span):
    seen, out = {}, {}
    for i, text in sorted(dict(corpus).items()):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - span + 1):
            if seen.setdefault(data[k : k + span], (i, k)) != (i, k):
                gone[k : k + span] = b"\1" * span
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and not (k and gone[k - 1]))
        out[i] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("shard", [suffix_dedup.SHARD_BYTES, 2000])
def test_repeated_bytes(docs, corpus, shard, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", shard)
    draw = random.Random(2)
    more = [(2000 + i, "".join(draw.choices("ab", k=draw.choice([99, 100, 101, 400])))) for i in range(30)]
    more += [(3000, "é" * 60), (3001, "é" * 300), (3002, "ab" * 200), (3003, "x" + "ab" * 200)]
    table = docs(corpus + more)
    got = suffix_dedup.deduplicate(table).collect()
    assert len(got) == len(corpus + more)
    assert {r.doc_id: tuple(r)[1:] for r in got} == brute_spans(corpus + more, suffix_dedup.SPAN)


def test_repeated_bytes_in_long_texts_and_no_rows(docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "LONGEST", 1000)
    draw = random.Random(4)
    half = "".join(draw.choices("abcdefgh", k=1900))
    rows = [(1, half + "|" + half), (2, half[300:]), (None, half)]
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.deduplicate(docs(rows)).collect()}
    want = brute_spans(rows[:2], suffix_dedup.SPAN)
    assert {k: v for k, v in got.items() if k} == want and got[None][:3] == (1900, 0, 0)
    assert suffix_dedup.deduplicate(docs([]).limit(0)).count() == 0


def shingles(line):
    return {line[k : k + 8] for k in range(len(line) - 7)} if len(line) >= 8 else {line}


def test_lines_match_brute_force(docs):
    draw = random.Random(8)
    base = [prose(draw, draw.choice([1, 3, 8, 14, 30, 80])) for _ in range(60)]
    texts = [None, "", "\n \n", "x", "x\nx"]
    for _ in range(60):
        lines = draw.choices(base, k=draw.randint(1, 5))
        if draw.random() < 0.5:
            line = list(lines[-1])
            line[draw.randrange(len(line))] = draw.choice("xyz")
            lines[-1] = "".join(line)
        texts.append("\n".join(lines))
    texts.append(prose(draw, 9000))
    first, places = {}, []
    for i, text in enumerate(texts):
        for k, line in enumerate((text or "").split("\n")):
            if line := line.strip(" \t\n\x0b\x0c\r"):
                first.setdefault(line, (i, k))
                places.append((i, k, line))
    lines = list(first)
    sets, parent = [shingles(x) for x in lines], {i: i for i in range(len(lines))}
    for a in range(len(lines)):
        for b in range(a):
            inside = len(sets[a] & sets[b])
            if inside and 100 * inside >= 80 * len(sets[a] | sets[b]):
                x, y = find(parent, a), find(parent, b)
                parent[max(x, y)] = min(x, y)
    stays = {}
    for n, line in enumerate(lines):
        stays[find(parent, n)] = min(stays.get(find(parent, n), first[line]), first[line])
    number = {x: n for n, x in enumerate(lines)}
    want = {(i, k) for i, k, x in places if stays[find(parent, number[x])] != (i, k)}
    table = docs(list(enumerate(texts)) + [(5, texts[5])])
    got = line_dedup.deduplicate(table)
    removed = {(r.doc_id, k) for r in got.collect() for k in r.removed}
    assert not removed - want
    assert len(want & removed) >= 0.95 * len(want)
    cut = {r.doc_id: r.text for r in line_dedup.apply(table, got).collect()}
    for i, text in enumerate(texts):
        kept = [x for k, x in enumerate((text or "").split("\n")) if (i, k) not in removed]
        assert cut[i] == (None if text is None else "\n".join(kept))
    assert line_dedup.deduplicate(table.limit(0)).count() == 0


def similar_lines(a, b):
    x, y = shingles(a), shingles(b)
    return 100 * len(x & y) >= 80 * len(x | y)


@pytest.mark.parametrize("block", [1024, 16])
def test_lines_of_one_template(docs, block, monkeypatch):
    """All similar lines with a bucket in common are one group, also where they are strangers to the ends of the bucket."""
    monkeypatch.setattr(line_dedup, "BLOCK", block, raising=False)
    draw, texts = random.Random(11), []
    form = "Dear {}, thank you for the order of our garden furniture; it leaves the house today."
    for _ in range(200):
        line = form.format("".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=7)))
        at = draw.randrange(30, 70)
        texts += [line, line[:at] + draw.choice("0123456789") + line[at + 1 :]]
    table, buckets = docs(list(enumerate(texts))), {}
    for r in line_dedup.bucket_entries(line_dedup.lines_of(table).withColumn("id", F.col("doc_id"))).collect():
        buckets.setdefault(r.key, set()).add(r.id)
    parent = {i: i for i in range(len(texts))}
    for a, b in {(a, b) for group in buckets.values() for a in group for b in group if a < b}:
        if similar_lines(texts[a], texts[b]):
            x, y = find(parent, a), find(parent, b)
            parent[max(x, y)] = min(x, y)
    want = {i for i in parent if find(parent, i) != i}
    assert len(want) > 150
    gone = {r.doc_id for r in line_dedup.deduplicate(table).collect() if r.n_removed}
    assert gone == want, (len(gone), len(want))


def test_long_lines_of_any_letters(docs):
    """Near copies of long lines without blanks, an "e" or letters beyond ASCII."""
    draw, texts = random.Random(12), ["-" * 130, "-" * 150]
    for letters in ("0123456789,", "0123456789\t", "ACGT", "ABCDEFGHIJKLMNOP", "abcdfghij/0123456789"):
        line = "X" + "".join(draw.choices(letters, k=400)) + "X"
        texts += [line, line[:200] + "#" + line[201:]]
    gone = {r.doc_id for r in line_dedup.deduplicate(docs(list(enumerate(texts)))).collect() if r.n_removed}
    assert gone == set(range(1, len(texts), 2))


def test_repeated_bytes_of_one_hot_owner(docs, monkeypatch):
    """A phrase with other words around it in all texts: no task may sort more than a shard and one owner within it."""
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 3000)
    real = suffix_dedup.repeated_strings

    def bounded(data, offsets, span):
        assert len(data) <= 2 * 3000, "a shard beyond its bound"
        return real(data, offsets, span)

    monkeypatch.setattr(suffix_dedup, "repeated_strings", bounded)
    draw, phrase = random.Random(13), "This text is under the licence of nobody: "
    around = [prose(draw, 25) for _ in range(20)]
    rows = [(i, draw.choice(around) + phrase + draw.choice(around)) for i in range(60)]
    rows += [(100 + i, prose(draw, 25) + phrase + prose(draw, 25)) for i in range(200)]
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.deduplicate(docs(rows)).collect()}
    assert got == brute_spans(rows, suffix_dedup.SPAN)


def test_shingles_are_characters_not_halves_of_them(docs):
    line = "abc\U0001F600defgh\U0001F601ij\u00e9k"
    want = {line[i : i + 8] for i in range(len(line) - 7)}
    rows = docs([(1, line), (2, "short"), (3, "abcdefgh"), (4, "abcdefgh" * 3)]).select("doc_id", line_dedup.shingles(F.col("text")).alias("s"))
    got = {r.doc_id: r.s for r in rows.collect()}
    assert [len(got[k]) for k in (1, 2, 3, 4)] == [len(want), 1, 1, 8]
    assert got[3][0] in got[4] and min(map(min, got.values())) >= 0


def test_least_hashes_of_long_lines(docs, monkeypatch):
    """Sorting the low hashes only gives the keys of sorting all of them, also where a bin has no low hash."""
    draw = random.Random(4)
    lines = ["".join(draw.choice("abcde ") for _ in range(n)) for n in (3, 30, 100, 300, 900, 3000)] + ["ab" * 2000]
    table = docs(list(enumerate(lines)))

    def keys(low):
        monkeypatch.setattr(line_dedup, "LOW", low)
        return table.select("doc_id", line_dedup.band_keys(line_dedup.shingles(F.col("text"))).alias("k")).orderBy("doc_id").collect()

    assert keys(1) == keys(8) == keys(1 << 20)
