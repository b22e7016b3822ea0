import itertools
import math
import statistics

import pytest
from pyspark.sql import functions as F

from adlake.operators import timeseries as ts


def holt(v, a, b):
    if len(v) < 2:
        return v[0] if v else 0.0
    level, trend = v[0], v[1] - v[0]
    for x in v[1:]:
        before, level = level, a * x + (1 - a) * (level + trend)
        trend = b * (level - before) + (1 - b) * trend
    return level + trend


SERIES = [[], [3.0], [1.0, 2.0, 4.0, 5.0], [5.0, 5.0, 5.0], [9.0, 1.0, 7.0, 2.0, 8.0]]


def test_forecasts_equal_python(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(SERIES)], "i int, v array<double>")
    v = F.col("v")
    out = df.select(
        "i", ts.holt_forecast(v, 0.3, 0.1).alias("h"), ts.mean_forecast(v).alias("m"), ts.last_value_forecast(v).alias("l"),
        ts.decay_mean_forecast(v, 0.5).alias("d"), ts.linear_forecast(v).alias("t"), ts.adaptive_forecast(v, 0.3, 0.1).alias("a"),
    )
    got = {r["i"]: r for r in out.collect()}
    assert got[2]["h"] == pytest.approx(5.5811, abs=1e-4)
    assert got[2]["t"] == pytest.approx(6.5) and got[3]["t"] == pytest.approx(5.0)
    assert got[2]["a"] == got[2]["h"] and got[3]["a"] == 5.0 and got[4]["a"] == 8.0
    for i, s in enumerate(SERIES):
        r = got[i]
        assert r["h"] == pytest.approx(holt(s, 0.3, 0.1))
        assert r["m"] == pytest.approx(statistics.mean(s) if s else 0.0) and r["l"] == (s[-1] if s else 0.0)
        weights = [0.5 ** (len(s) - 1 - k) for k in range(len(s))]
        assert r["d"] == pytest.approx(sum(w * x for w, x in zip(weights, s)) / sum(weights) if s else 0.0)


def test_backtest_grid_equals_python(spark, monkeypatch):
    series = {"a": [1.0, 2.0, 4.0], "b": [3.0, 1.0, 2.0], "c": [5.0, None, 6.0], "gone": [1.0, 1.0, 1.0], "zero": [1.0, 1.0, 2.0]}
    actual = {"a": 5.0, "b": 2.0, "c": 4.0, "zero": 0.0}
    history = spark.createDataFrame([(k, [(str(i), x) for i, x in enumerate(v)]) for k, v in series.items()], "key string, series array<struct<date:string,x:double>>")
    actuals = spark.createDataFrame(list(actual.items()), "key string, x double")
    errors = ts.forecast_errors(history, actuals, "key", ["x"], ts.forecast_methods())
    for size in (1, 1000):
        monkeypatch.setattr("adlake.operators.running.RANGE_ROWS", size)
        scores = {r["method"]: r for r in ts.backtest(errors).collect()}
        assert len(scores) == 19
        for a, b in itertools.product(ts.HOLT_ALPHAS, ts.HOLT_BETAS):
            apes = [abs(holt([x for x in series[k] if x is not None], a, b) - actual[k]) / actual[k] for k in "abc"]
            r = scores[f"holt_a{a}_b{b}"]
            assert r["n"] == 3
            assert r["mape_pct"] == pytest.approx(100 * statistics.mean(apes))
            assert r["median_ape_pct"] == pytest.approx(100 * statistics.median(apes))
    grid = ts.holt_grid(ts.backtest(errors)).collect()
    assert sorted(r["alpha"] for r in grid) == sorted(ts.HOLT_ALPHAS)
    best = ts.best_per_family(ts.backtest(errors))
    assert {r["family"] for r in best.collect()} == {"holt", "decay", "baseline"}


def test_keyed_cosine_skips_zero_and_null(spark):
    a = spark.createDataFrame([("k1", 1.0), ("k2", 2.0), ("k3", 0.0), ("k4", None), ("k5", 9.0)], "key string, x double")
    b = spark.createDataFrame([("k1", 2.0), ("k2", 1.0), ("k3", 5.0), ("k4", 1.0)], "key string, x double")
    r = ts.keyed_cosine(a, b, "key", ["x"]).first()
    assert (r["cosine"], r["matched"]) == (pytest.approx(4 / 5), 2)
    none = ts.keyed_cosine(a.where("key = 'k3'"), b, "key", ["x"]).first()
    assert (none["cosine"], none["matched"]) == (0.0, 0)


def test_gaps_count_available_or_calendar_days(spark):
    df = spark.createDataFrame([("k", d, 1.0) for d in ("2024-01-01", "2024-01-02", "2024-01-05")], "key string, d string, x double").withColumn("d", F.to_date("d"))
    available = ts.period_pairs(df, "key", "d", ["x"], [1])
    assert available.count() == 2
    assert ts.period_pairs(df, "key", "d", ["x"], [1], calendar=True).count() == 1
    assert {r["gap"] for r in ts.period_pairs(df, "key", "d", ["x"], calendar=True).collect()} == {1, 3, 4}


def test_implied_decay_and_trend(spark):
    gaps = spark.createDataFrame([("m", g, 0.9**g, 1) for g in range(1, 6)] + [("one", 1, 0.5, 1)], "metric string, gap int, mean_cosine double, pairs int")
    out = {r["metric"]: r["decay_rate"] for r in ts.implied_decay(gaps).collect()}
    assert out["m"] == pytest.approx(0.9) and out["one"] is None
    series = spark.createDataFrame([("up", i, 0.1 * i) for i in range(5)] + [("flat", i, 0.5 + (i % 2) * 0.01) for i in range(5)], "metric string, i int, cosine double")
    trend = {r["metric"]: r for r in ts.series_trend(series, ["metric"], "i", "cosine").collect()}
    assert trend["up"]["verdict"] == "strong positive" and trend["up"]["slope"] == pytest.approx(0.1)
    assert trend["flat"]["verdict"] == "no clear trend"


def test_decay_uses_latest_date_in_one_plan(spark):
    df = spark.createDataFrame([("2024-01-01", 8.0), ("2024-01-03", 8.0)], "d string, x double").withColumn("d", F.to_date("d"))
    out = ts.temporal_decay(df, {"x": 0.5}, "d")
    assert sorted(r["x"] for r in out.collect()) == [2.0, 8.0]
    assert math.isclose(ts.temporal_decay(df, {"x": 0.5}, "d", "2024-01-04", "_y").agg(F.sum("x_y")).first()[0], 5.0)
