"""Mixing, packing, the pipeline, and the registered queries with SQL."""

import random
import zlib

import pytest
from check_oracle import compare, connect

from adlake.llm import mixing, packing
from adlake.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def brute_targets(sizes):
    """Share out by weight again and again until no source is above twice its size."""
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + ([None] if None in sizes else [])
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    target, open_, left = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        level = left / sum(weight[n] for n in open_)
        over = {n for n in open_ if level * weight[n] > 2 * sizes[n]}
        if not over:
            return target | {n: level * weight[n] for n in open_}
        for n in over:
            target[n] = 2.0 * sizes[n]
            left -= target[n]
        open_ -= over
    return target


def test_mix_meets_targets(docs):
    draw = random.Random(6)
    rows = [(i, "w " * draw.choice([1, 5, 5, 40, 300]), f"s{draw.randrange(7)}") for i in range(400)]
    rows += [(1000 + i, "a b c d", "hot") for i in range(500)] + [(2000, None, "s1"), (2001, "", None), (2002, " x y ", None)]
    rows += [(2003, None, "nothing"), (3, rows[3][1], rows[3][2])]
    got = mixing.mix(docs(rows)).collect()
    assert len(got) == len(rows)
    sizes, longest = {}, {}
    for _, text, source in rows:
        n = len((text or "").split())
        sizes[source] = sizes.get(source, 0) + n
    source_of, taken = {r[0]: r[2] for r in rows}, {}
    want = brute_targets(sizes)
    for r in got:
        s = source_of[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert r.taken == r.copies * r.size <= 2 * r.size
        taken[s] = taken.get(s, 0) + r.taken
        if r.size:
            longest[s] = min(longest.get(s, r.size), r.size)
    for s, n in taken.items():
        assert abs(n - want[s]) <= max(0.02 * want[s], 40), (s, n, want[s], longest.get(s))
    assert sorted(map(tuple, mixing.mix(docs(rows)).collect())) == sorted(map(tuple, got))


def test_mix_rows_and_no_rows(docs):
    table = docs([(1, "a b", "x"), (2, "a b c", "x"), (3, "d", "y"), (4, None, "z")])
    kept = mixing.keep(table)
    assert kept.columns == table.columns
    copies = {r.doc_id: r.copies for r in mixing.mix(table).collect()}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, n in copies.items() for _ in range(n))
    assert mixing.mix(table.limit(0)).count() == 0


def texts_for_tokens():
    draw = random.Random(9)
    odd = [None, "", "Don't STOP 123 ½ x<|endoftext|>y", "a\x1cb", "İstanbul ΣΑΣ ǅ ﬁ", "e\u0301 \u0301a", "日本語 😀 हिन्दी", "a\u0085b\u00a0c"]
    return odd + [" ".join(draw.choices(["the", "Größe", "x9y", "!!", "niño's"], k=draw.randint(0, 900))) for _ in range(120)] + ["word " * 9000]


def encoded(texts):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(packing.vocabulary_path())
    return [[*own.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]


def check_packing(got, ids, capacity):
    pieces = {}
    for r in got:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length <= capacity
        assert zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part)) == r.ids_crc32
        pieces.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
    for doc, rows in pieces.items():
        assert sorted(set(rows)) == [(k, k * capacity, min(capacity, len(ids[doc]) - k * capacity)) for k in range(-(-len(ids[doc]) // capacity))]
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for rows in bins.values():
        end = 0
        for offset, length in sorted(rows):
            assert offset == end
            end += length
        assert end <= capacity
    return len(bins)


def first_fit(lengths, capacity):
    """Bins that first-fit of falling lengths takes."""
    room = []
    for n in sorted(lengths, reverse=True):
        fits = next((k for k, r in enumerate(room) if r >= n), None)
        if fits is None:
            room.append(capacity - n)
        else:
            room[fits] -= n
    return len(room)


def test_plain_scripts_split_as_the_vocabulary_says():
    """Every character of the scripts that take the short way, alone and among letters, numbers and quotes."""
    known = packing.ChunkIds(packing.vocabulary_path())
    for first, last in packing.PLAIN:
        for c in map(chr, range(first, last + 1)):
            text = f"{c} a{c}9{c}'s{c}{c}\u00e9A"
            if c not in packing.ODD_SPACE:
                assert not packing.NOT_PLAIN.search(text)
                assert known.chunks(text) == packing.CHUNK.findall(known.tokenizer.normalizer.normalize_str(text)), hex(ord(c))
    for text in ("\u0130I", "\u03a3\u03a3 a\u03a3", "e\u0301E", "\u1100\u1161\u11a8", "\u0181'S", "x\u3000\u00a0\u0085Y"):
        assert known.text(text) == known.whole(text), text


def test_packing_round_trip(docs):
    texts = texts_for_tokens()
    rows = list(enumerate(texts)) + [(3, texts[3])]
    got = packing.pack(docs(rows)).collect()
    ids = dict(enumerate(encoded(texts)))
    assert {r.doc_id for r in got} == set(ids)
    bins = check_packing(got, ids, packing.CAPACITY)
    assert bins <= first_fit([r.length for r in got], packing.CAPACITY) + 1
    assert packing.pack(docs([]).limit(0)).count() == 0


def test_plan_fills_bins():
    draw = random.Random(10)
    for _ in range(30):
        lengths = [draw.randint(1, 40) for _ in range(draw.randint(0, 200))]
        counts = {n: lengths.count(n) for n in lengths}
        plan = packing.plan(counts, 40)
        used = sorted(n for chosen, times in plan for n in chosen * times)
        assert used == sorted(lengths) and all(sum(chosen) <= 40 for chosen, _ in plan)
        assert sum(times for _, times in plan) <= first_fit(lengths, 40)


def test_fullest_is_optimal():
    draw = random.Random(12)
    for _ in range(200):
        counts = {draw.randint(1, 30): draw.randint(1, 3) for _ in range(draw.randint(1, 6))}
        room, sums = draw.randint(1, 60), {0}
        for n, c in counts.items():
            sums = {s + k * n for s in sums for k in range(c + 1) if s + k * n <= room}
        chosen = packing.fullest(room, counts)
        assert sum(chosen) == max(sums) and all(chosen.count(n) <= counts[n] for n in chosen)


def test_pipeline_stages(spark):
    import corpus_pipeline as pipeline

    from adlake.llm import exact_dedup, jaccard_join, quality_rules

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert 4 <= len(pipeline.STAGES) <= 5
    tables = [docs]
    for _, stage in pipeline.STAGES:
        tables.append(stage(spark, tables[-1], SF).cache())
    ids = [sorted(r.doc_id for r in t.select("doc_id").collect()) for t in tables]
    assert all(t.columns == docs.columns for t in tables[:-1])
    assert ids[1] == sorted(r.doc_id for r in quality_rules.judge(docs).where("kept").collect())
    assert ids[2] == sorted(r.doc_id for r in exact_dedup.deduplicate(tables[1]).where("kept").collect())
    assert ids[3] == sorted({r.component_id for r in jaccard_join.join(tables[2]).collect()})
    copies = {r.doc_id: r.copies for r in mixing.mix(tables[3]).collect()}
    assert ids[4] == sorted(i for i, n in copies.items() for _ in range(n))
    mixed = {r.doc_id: r.text for r in tables[4].collect()}
    packed = tables[5].collect()
    tokens = dict(zip(mixed, encoded(mixed.values()), strict=True))
    check_packing(packed, tokens, packing.CAPACITY)
    assert len(packed) == sum(-(-len(tokens[i]) // packing.CAPACITY) for i in ids[4])
    assert sorted(map(tuple, pipeline.run(spark, SF).collect())) == sorted(map(tuple, packed))
    for t in tables[1:]:
        t.unpersist()


@pytest.mark.parametrize("name", list(ORACLES))
def test_queries_with_sql(spark, name):
    con = connect(SF)
    verdict, note = compare(QUERIES[name](spark, SF), con, ORACLES[name])
    con.close()
    assert verdict == "OK", note
