"""Many small ranges must give the sums of one."""

import random

import pytest
from pyspark.sql import functions as F

from adlake.operators import running


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one key, a NULL key, ties in score."""
    rng = random.Random(1)
    data = [("hot" if i % 3 == 0 else rng.choice(["a", "b", None]), i, float(rng.randint(0, 9)), float(rng.randint(1, 5))) for i in range(600)]
    return spark.createDataFrame(data, "k string, id long, score double, w double").cache()


def test_running_sums_hot_equals_plain(skewed, rows):
    args = (skewed, ["k"], [F.desc("score"), F.asc("id")], {"cum": "w"})
    plain = rows(running.running_sums(*args))
    assert plain == rows(running.running_sums(*args, range_rows=10))
    total = {}
    for k, i, s, w in sorted(skewed.collect(), key=lambda r: (str(r[0]), -r[2], r[1])):
        total[k] = total.get(k, 0.0) + w
        assert (k, i, s, w, total[k]) in plain


def test_global_running_sums(skewed, rows):
    one = skewed.withColumn("one", F.lit(1))
    for hot in (10, 10_000):
        out = running.running_sums(one, [], [F.asc("id")], {"n": "one"}, range_rows=hot)
        assert all(r["n"] == r["id"] + 1 for r in out.collect())


def test_cumulative_share_ties_and_hot(spark, skewed, rows):
    tiny = spark.createDataFrame([("x", 5.0, 1.0), ("x", 5.0, 2.0), ("x", 1.0, 3.0)], "k string, s double, w double")
    for hot in (1, 1000):
        out = running.cumulative_share(tiny, ["k"], "s", "w", range_rows=hot)
        assert sorted(r["percentile"] for r in out.collect()) == [0.5, 0.5, 1.0]
    plain = running.cumulative_share(skewed, ["k"], "score", "w").withColumn("percentile", F.round("percentile", 9))
    split = running.cumulative_share(skewed, ["k"], "score", "w", range_rows=5).withColumn("percentile", F.round("percentile", 9))
    assert rows(plain) == rows(split.select(*plain.columns))


@pytest.mark.parametrize("hot", [3, 1_000_000])
def test_exact_percentiles(spark, skewed, hot):
    import numpy as np

    out = {
        r["k"]: r
        for r in running.exact_percentiles(skewed, ["k"], "w", {"p10": 0.1, "p50": 0.5, "p97": 0.97}, range_rows=hot).collect()
    }
    data = {}
    for r in skewed.collect():
        data.setdefault(r["k"], []).append(r["w"])
    assert set(out) == set(data)
    for k, values in data.items():
        for name, p in (("p10", 10), ("p50", 50), ("p97", 97)):
            assert out[k][name] == pytest.approx(np.percentile(values, p))
        assert out[k]["n"] == len(values)
    index = running.exact_percentiles(skewed, [], "id", {"p99": 0.99}, "index", range_rows=hot).first()
    assert index["p99"] == 594


def test_group_totals_with_null_key(skewed):
    out = running.with_group_totals(skewed, ["k"], {"t": F.sum("w")})
    assert out.count() == 600
    assert out.where("k is null and t is null").count() == 0


def test_running_sums_with_nulls(spark):
    """As a window: NULL adds nothing, and a sum is NULL until the first value, however the rows are split."""
    data = [(i, v) for i, v in enumerate([None, 1.0, None, None, 2.0, None, 3.0, None])]
    df = spark.createDataFrame(data, "id long, v double")
    for size in (1, 3, 100):
        out = running.running_sums(df, [], [F.asc("id")], {"s": "v"}, range_rows=size).orderBy("id").collect()
        assert [r["s"] for r in out] == [None, 1.0, 1.0, 1.0, 3.0, 3.0, 6.0, 6.0]
