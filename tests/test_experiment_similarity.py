import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from adlake.operators import entity_similarity as es
from adlake.operators import experiment
from adlake.session import cut_lineage, drop_table


@pytest.fixture(scope="module")
def report(spark):
    rng = random.Random(5)
    data = [
        (rng.choice(["ctl", "48", "49", "other"]), rng.choice(["A", "A", "A", "B"]), rng.choice(["x", "y", None]), f"s{rng.randint(0, 40)}",
         rng.randint(1, 50), rng.choice([None, rng.randint(0, 60)]), rng.random() * 10)
        for _ in range(2000)
    ]
    return spark.createDataFrame(
        data, "exp_bucket string, acc string, geo string, seg string, bid_requests long, multiplied_bid_requests long, unr double"
    ).cache()


FEATURES = ["acc", "geo", "seg"]
CAPS = [1.0, 1.0005, 1.2, 1.6, 2.0]


def test_paired_rates_equal_join_of_arms(report):
    arms = experiment.prepare_experiment(report, FEATURES, "ctl", ["48", "49"])
    c = arms.where("is_control").select(*FEATURES, F.col("rate").alias("c"))
    e = arms.where("not is_control").select(*FEATURES, F.col("rate").alias("e"), "net_requests")
    joined = {tuple(r[:3]): (r["c"], r["e"], r["net_requests"]) for r in c.join(e, FEATURES).collect()}
    paired = experiment.paired_rates(report, FEATURES, "ctl", ["48", "49"]).collect()
    assert {tuple(r[:3]) for r in paired} == set(joined) and joined
    for r in paired:
        assert (r["control_rate"], r["explore_rate"], r["explore_requests"]) == pytest.approx(joined[tuple(r[:3])])


def test_cap_sweep_equals_one_cap_at_a_time(report, monkeypatch):
    paired = experiment.paired_rates(report, FEATURES, "ctl", ["48", "49"])
    scored = experiment.uplift_dataset(paired, FEATURES)
    for size in (2, 10_000):
        monkeypatch.setattr("adlake.operators.running.RANGE_ROWS", size)
        thresholds = experiment.cap_thresholds(scored, "acc", CAPS, 3.0)
        got = {(r["acc"], r["cap"]): r for r in experiment.evaluate_caps(paired, thresholds, "acc", CAPS, 3.0).collect()}
        rows = paired.collect()
        want = {}
        for acc in ("A", "B"):
            mine = [(r["explore_rate"] - r["control_rate"], r["explore_requests"], r) for r in rows if r["acc"] == acc]
            total = sum(w for _, w, _ in mine)
            for cap in CAPS:
                if cap - 1 < 1e-3:
                    continue
                inside = [y for y, _, _ in mine if sum(w for s, w, _ in mine if s >= y) / total <= (cap - 1) / 2]
                if inside:
                    want[(acc, cap)] = sum(r["control_requests"] + r["explore_requests"] for y, _, r in mine if y >= min(inside))
        assert {k: r["total_br_treated"] for k, r in got.items()} == want


def test_premium_segments_hot_equals_plain(report, rows, monkeypatch):
    scored = experiment.uplift_dataset(experiment.paired_rates(report, FEATURES, "ctl", ["48", "49"]), FEATURES)
    plain = experiment.premium_segments(scored, "acc", ["acc"], ["geo", "seg"], 0.3)
    plain = rows(plain)
    monkeypatch.setattr("adlake.operators.running.RANGE_ROWS", 3)
    assert plain == rows(experiment.premium_segments(scored, "acc", ["acc"], ["geo", "seg"], 0.3))


def test_uplift_ratio_zero_control(spark, rows):
    df = spark.createDataFrame(
        [("f", "ctl", 2.0), ("f", "48", 3.0), ("f", "49", 1.0), ("g", "48", 3.0), ("h", "ctl", 0.0), ("h", "48", 1.0), ("i", "ctl", 4.0)],
        "f string, b string, m double",
    )
    out = rows(experiment.uplift_ratio(df, ["f"], "b", "ctl", ["48", "49"], "m"))
    assert out == [("f", 1.0), ("g", 0.0), ("h", 0.0), ("i", -1.0)]


@pytest.fixture(scope="module")
def sets(spark):
    """One token in every set, one entity with all tokens, two identical sets."""
    rng = random.Random(9)
    data = {f"e{i:02d}": {"all"} | {f"t{rng.randint(0, 30)}" for _ in range(6)} for i in range(25)}
    data["big"] = {"all"} | {f"t{i}" for i in range(31)}
    data["e01"] = set(data["e00"])
    df = spark.createDataFrame([(e, t) for e, ts in data.items() for t in ts], "e string, t string")
    return data, df.cache()


def test_pairs_in_blocks_equal_brute_force(sets):
    data, df = sets
    for blocks in ({}, {"entities_per_block": 4, "tokens_per_block": 5}):
        got = {(r["a"], r["b"]): r["jaccard"] for r in es.jaccard_pairs(df, "e", "t", **blocks).collect()}
        want = {(a, b): len(data[a] & data[b]) / len(data[a] | data[b]) for a, b in itertools.combinations(sorted(data), 2)}
        assert got == pytest.approx(want)
    overlap = {(r["a"], r["b"]): r["overlap"] for r in es.overlap_pairs(df, "e", "t", entities_per_block=7).collect()}
    assert len(overlap) == len(data) ** 2
    assert overlap[("big", "e03")] == overlap[("e03", "big")] == 1.0 and overlap[("e05", "e05")] == 1.0


def test_cosine_blocks_with_negative_values(spark):
    vectors = [(e, t, float((e * 7 + t * 3) % 5 - 2)) for e in range(9) for t in range(12) if (e + t) % 3]
    df = spark.createDataFrame(vectors, "e int, t int, v double")
    value = {(e, t): v for e, t, v in vectors}
    got = {(r["a"], r["b"]): r["product"] for r in es.pair_products(df.where("v <> 0"), "e", "t", "v", 2, 3).collect()}
    for (a, b), p in got.items():
        assert p == pytest.approx(sum(value.get((a, t), 0) * value.get((b, t), 0) for t in range(12)))


def test_rows_go_only_to_blocks_with_their_token(spark):
    """Ten groups without a token in common, ids interleaved: a row goes to the blocks of its group only, not to all."""
    rows = [(e, (e % 10) * 100 + t, 1.0) for e in range(200) for t in range(e % 7, 12)]
    df = spark.createDataFrame(rows, "entity int, token int, value double")
    blocks = es._in_blocks(df, es.norm(), 10, 10**6)
    assert blocks.select("block").distinct().count() == 20
    assert es._copies(df, blocks).count() <= 3 * len(rows)


def test_rows_travel_in_packs_and_pairs_stay(spark):
    """Rows that go the same way are one row of the shuffle, a pair leaves one task only, and the caller's rows are read no more."""
    rows = [(e, t, 1.5 * (e % 7 - 3)) for e in range(60) for t in range(e % 5, 90) if e % 7 != 3]
    df = spark.createDataFrame(rows, "entity int, token int, value double")
    written = cut_lineage(df)
    products = es.weighted_products(written, "entity", "token", "value", es.norm(), entities_per_block=20)
    drop_table(written)
    of = {(e, t): v for e, t, v in rows}
    ids = sorted({e for e, _, _ in rows})
    want = {(a, b): sum(of[a, t] * of[b, t] for t in range(max(a % 5, b % 5), 90)) for a in ids for b in ids if a <= b}
    assert {(r.a, r.b): r["product"] for r in products.collect()} == want
    plan = products._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "hashpartitioning(a#" not in plan
    blocks = es._in_blocks(df, es.norm(), 20, 10**6)
    copies = es._copies(df.coalesce(1), blocks).coalesce(1)
    pairs = copies.select("first_block", "second_block", "parts").distinct()
    met = es._met(copies, blocks, pairs)
    assert met.where("data IS NOT NULL").count() == 9 and met.where("number IS NOT NULL").isEmpty()


def test_packs_hold_the_same_numbers():
    for value in ([1.0, 2.0, 255.0], [-1.0, 0.5, 3.0], [0.1, 1e300, float("inf")], [float("nan"), 1.0, 2.0], [70000.0, -5.0, 2.0**40]):
        number, place, value = np.array([3, 3, 2**40]), np.array([0, 70000, 5]), np.array(value)
        got = es._unpacked(es._packed((np.array([3, 2**40 - 3]), np.array([2, 1]), place, value)))
        assert all(np.array_equal(a, b, equal_nan=True) and a.dtype == b.dtype for a, b in zip(got, (number, place, value), strict=True))


def test_tokens_of_large_blocks_are_dealt(spark):
    """Products, bounds and best partners are the same when the tokens of two blocks fall to several tasks."""
    draw = random.Random(4)
    vectors = [(f"e{e:02d}", t, float(draw.randint(-1, 6))) for e in range(30) for t in {draw.randrange(60) for _ in range(15)}]
    vectors = [v for v in vectors if v[2]]
    df = spark.createDataFrame(vectors, "e string, t int, v double")
    of = {}
    for e, t, v in vectors:
        of.setdefault(e, {})[t] = v
    want = {(a, b): sum(of[a][t] * of[b][t] for t in of[a].keys() & of[b].keys()) for a in of for b in of if a <= b and of[a].keys() & of[b].keys()}
    norm = {e: sum(v * v for v in x.values()) ** 0.5 for e, x in of.items()}
    near = {(a, b): p for (a, b), p in want.items() if a < b and p >= 0.3 * norm[a] * norm[b]}
    for blocks in ({"rows_per_block": 20}, {"entities_per_block": 7}, {"entities_per_block": 7, "tokens_per_block": 3, "rows_per_block": 10}):
        got = {(r.a, r.b): r["product"] for r in es.pair_products(df, "e", "t", "v", **blocks).collect()}
        assert got == want
        bounded = es.weighted_products(df, "e", "t", "v", es.norm("value"), least=0.3, **blocks).where("a < b AND product >= 0.3 * weight_a * weight_b")
        assert {(r.a, r.b): r["product"] for r in bounded.collect()} == near
        asked = spark.createDataFrame(list(near) + [("e00", "nobody")], "a string, b string")
        assert {(r.a, r.b): r["product"] for r in es.products_of(asked, df, "e", "t", "v", **blocks).collect()} == near


def test_minhash_recall_and_copies(sets):
    data, df = sets
    near = es.minhash_pairs(df, "e", "t", tables=10)
    got = {(r["a"], r["b"]): r for r in es.with_exact_jaccard(near, df, "e", "t").collect()}
    assert len(got) == near.count()  # no pair twice
    assert got[("e00", "e01")]["estimate"] == 1.0 and got[("e00", "e01")]["jaccard"] == 1.0
    exact = {(a, b): len(data[a] & data[b]) / len(data[a] | data[b]) for a, b in itertools.combinations(sorted(data), 2)}
    for pair, r in got.items():
        assert r["jaccard"] == pytest.approx(exact[pair])
    close = [p for p, j in exact.items() if j >= 0.3]
    assert sum(p in got for p in close) / len(close) >= 0.9


def test_stability_needs_both_days(spark, rows):
    df = spark.createDataFrame(
        [("d1", "x", "a"), ("d1", "x", "b"), ("d2", "x", "b"), ("d2", "x", "c"), ("d3", "x", "z"), ("d1", "y", "a"), ("d3", "y", "a")],
        "d string, e string, segment string",
    )
    daily = es.daily_stability(df, ["e"], "d")
    assert rows(daily) == [("x", "d2", pytest.approx(1 / 3)), ("x", "d3", 0.0)]
    matrix = es.stability_matrix(daily, ["e"], "d", ["d2", "d3"]).first()
    assert tuple(matrix) == ("x", pytest.approx(1 / 3), 0.0, pytest.approx(1 / 6))


def test_sampled_matrix_is_symmetric(sets):
    _, df = sets
    pairs = es.overlap_pairs(df, "e", "t")
    got = {(r["a"], r["b"]): r["overlap"] for r in es.sampled_matrix(pairs, "overlap", 5, seed=2).collect()}
    ids = {a for a, _ in got}
    assert len(ids) == 5 and len(got) == 25
    assert all(got[(a, b)] == got[(b, a)] for a, b in got) and all(got[(a, a)] == 1.0 for a in ids)
