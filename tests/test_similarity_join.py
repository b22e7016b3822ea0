"""Similarity joins with a bound against all pairs."""

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from adlake.operators import similarity_join as sj


@pytest.fixture(scope="module")
def profiles():
    """Skewed tokens: one that everyone has, some common, many rare; a heavy entity; families of near copies; negative scores."""
    draw, rows = random.Random(3), {}
    for e in range(60):
        rows[e, 0] = draw.uniform(0.1, 3)
        for _ in range(draw.randint(1, 25)):
            rows[e, draw.choice([draw.randrange(8), draw.randrange(400)])] = draw.choice([1, 2, 5]) * draw.uniform(0.5, 1.5)
    for t in range(400):
        rows[60, t] = draw.uniform(0, 1)
    for e in range(61, 75):
        for (o, t), v in list(rows.items()):
            if o == 5:
                rows[e, t] = v * draw.uniform(0.8, 1.2)
        rows[e, 1000 + e] = draw.uniform(0, 2)
    rows[75, 7] = -3.0
    rows[75, 3] = 2.0
    rows[76, 9999] = 1.0
    rows[77, 9999] = 4.0
    return [(e, t, v) for (e, t), v in rows.items()]


def cosines(profiles):
    vectors = defaultdict(dict)
    for e, t, v in profiles:
        vectors[e][t] = v
    norm = {e: math.sqrt(sum(v * v for v in x.values())) for e, x in vectors.items()}
    out = {}
    for a in vectors:
        for b in vectors:
            both = vectors[a].keys() & vectors[b].keys()
            if a != b and both and norm[a] and norm[b]:
                out[a, b] = sum(vectors[a][t] * vectors[b][t] for t in both) / (norm[a] * norm[b])
    return out


def frame(spark, profiles):
    return spark.createDataFrame([*profiles, (None, 3, 1.0), (3, None, 9.0), (500, 4, 0.0)], "e long, t long, s double").repartition(5)


@pytest.mark.parametrize("threshold, heavy", [(0.9, sj.HEAVY), (0.5, 3), (0.05, 7)])
def test_cosine_at_least(spark, profiles, threshold, heavy):
    want = {p: c for p, c in cosines(profiles).items() if p[0] < p[1] and c >= threshold}
    got = {(r.a, r.b): r.cosine for r in sj.cosine_at_least(frame(spark, profiles), "e", "t", "s", threshold, heavy).collect()}
    assert got.keys() == want.keys() and len(want) > 50
    assert all(got[p] == pytest.approx(want[p], abs=1e-9) for p in want)


def test_bounds_drop_pairs_before_they_are_compared(spark, profiles):
    """A higher threshold indexes fewer tokens and forms fewer pairs; a token that everyone has is hardly indexed."""
    index = sj.weighted_index(frame(spark, profiles), "e", "t", "s")
    sizes = [index.where(F.col("upto") >= t).count() for t in (0.0, 0.5, 0.9)]
    assert sizes[0] == index.count() and sizes[0] > 1.5 * sizes[2] and sizes[1] >= sizes[2]
    at = {t: index.where((F.col("token") == 0) & (F.col("upto") >= t)).count() for t in (0.0, 0.9)}
    assert at[0.9] < 0.2 * at[0.0]


@pytest.mark.parametrize("start, heavy", [(0.6, sj.HEAVY), (0.99, 4)])
def test_nearest_k(spark, profiles, start, heavy):
    by_entity = defaultdict(list)
    for (a, b), c in cosines(profiles).items():
        if c > 0:
            by_entity[a].append((-round(c, 9), b))
    got = defaultdict(dict)
    for r in sj.nearest_k(frame(spark, profiles), "e", 4, "t", "s", start, heavy).collect():
        got[r.a][r.rank] = (-round(r.cosine, 9), r.b)
    assert got.keys() == by_entity.keys()
    for a, best in by_entity.items():
        assert [got[a][i] for i in sorted(got[a])] == sorted(best)[:4]


def sets_of(spark, profiles):
    return frame(spark, profiles).select("e", "t").unionByName(frame(spark, profiles[:50]).select("e", "t"))


def set_pairs(profiles):
    sets = defaultdict(set)
    for e, t, _ in [*profiles, (500, 4, 0.0)]:
        sets[e].add(t)
    return {(a, b): (len(sets[a] & sets[b]), len(sets[a]), len(sets[b])) for a in sets for b in sets if a < b and sets[a] & sets[b]}


@pytest.mark.parametrize("threshold, heavy", [(1.0, 5), (0.7, sj.HEAVY), (0.2, 3)])
def test_overlap_and_jaccard_at_least(spark, profiles, threshold, heavy):
    pairs = set_pairs(profiles)
    overlap = {p: s / min(x, y) for p, (s, x, y) in pairs.items()}
    got = {(r.a, r.b): r.overlap for r in sj.overlap_at_least(sets_of(spark, profiles), "e", "t", threshold, heavy).collect()}
    assert got == pytest.approx({p: v for p, v in overlap.items() if v >= threshold})
    jaccard = {p: s / (x + y - s) for p, (s, x, y) in pairs.items()}
    got = {(r.a, r.b): r.jaccard for r in sj.jaccard_at_least(sets_of(spark, profiles), "e", "t", threshold, heavy).collect()}
    assert got == pytest.approx({p: v for p, v in jaccard.items() if v >= threshold})


@pytest.mark.parametrize("carried", [1, 6, 64])
def test_sets_that_travel_and_sets_that_do_not(spark, profiles, monkeypatch, carried):
    """The same pairs, whichever sets are carried; banded MinHash has no false pairs either way."""
    monkeypatch.setattr(sj, "CARRIED", carried)
    pairs = set_pairs(profiles)
    jaccard = {p: s / (x + y - s) for p, (s, x, y) in pairs.items()}
    want = {p: v for p, v in jaccard.items() if v >= 0.4}
    got = [(r.a, r.b, r.jaccard) for r in sj.jaccard_at_least(sets_of(spark, profiles), "e", "t", 0.4, 3).collect()]
    assert {(a, b): v for a, b, v in got} == pytest.approx(want) and len(got) == len(want)
    got = {(r.a, r.b): r.jaccard for r in sj.banded_minhash(sets_of(spark, profiles), "e", "t", 0.4, 24, 1, heavy=5).collect()}
    assert len(got) >= 0.95 * len(want) and got == pytest.approx({p: want[p] for p in got})


def test_candidates_are_not_shuffled(spark, monkeypatch):
    """300 sets of two tokens, one of them common to all: 44,850 pairs meet, none is near, and none leaves the tasks."""
    monkeypatch.setattr(sj, "shared_counts", lambda *_: pytest.fail("pairs were formed before they were compared"))
    sets = spark.createDataFrame([(e, t) for e in range(300) for t in (0, e + 1)], "e long, t long")
    assert sj.jaccard_at_least(sets, "e", "t", 0.3).count() == 44850  # 1 / 3
    assert sj.jaccard_at_least(sets, "e", "t", 0.4).count() == 0
    assert sj.overlap_at_least(sets, "e", "t", 0.6).count() == 0
    assert sj.banded_minhash(sets, "e", "t", 0.4).count() == 0


def test_banded_minhash_recall(spark):
    """Pairs at or above the threshold are found as often as the bands promise; nothing below it is returned."""
    draw, rows = random.Random(6), []
    for e in range(0, 400, 2):
        base = [draw.randrange(10**9) for _ in range(40)]
        rows += [(e, t) for t in base] + [(e + 1, t) for t in base[draw.randint(4, 12):]]
    sets = spark.createDataFrame(rows, "e long, t long")
    want = {(r.a, r.b): r.jaccard for r in sj.jaccard_at_least(sets, "e", "t", 0.7).collect()}
    for hash_with in ("xxhash64", "md5"):
        got = {(r.a, r.b): r.jaccard for r in sj.banded_minhash(sets, "e", "t", 0.7, 16, 3, hash_with=hash_with, heavy=5).collect()}
        assert got.items() <= want.items()
        assert len(got) >= 0.95 * len(want) > 100  # 1 - (1 - 0.7³)^16 = 0.999


def test_empty_and_wrong_thresholds(spark):
    nothing = spark.createDataFrame([], "e long, t long, s double")
    assert sj.cosine_at_least(nothing, "e", "t", "s", 0.5).count() == 0
    assert sj.nearest_k(nothing, "e", 3, "t", "s").count() == 0
    assert sj.overlap_at_least(nothing, "e", "t", 0.5).count() == 0
    assert sj.banded_minhash(nothing, "e", "t", 0.5).count() == 0
    for wrong in (lambda: sj.cosine_at_least(nothing, "e", "t", "s", 0.0), lambda: sj.overlap_at_least(nothing, "e", "t", 1.5), lambda: sj.jaccard_at_least(nothing, "e", "t", 0.0)):
        with pytest.raises(ValueError):
            wrong()
