"""Dedupe, aggregation, rolling windows, enrichment and comparison on small tables with NULLs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from adlake.operators import aggregate, compare, dedupe, enrich, normalize
from adlake.operators.aggregate import Aggregation
from adlake.operators.enrich import Feature, FeatureJoin, FieldMapping
from adlake.operators.rolling import rolling_sums


def test_dedupe_modes(spark, rows):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 2), (2, "c", 1), (None, "d", 1), (None, "e", 0)], "k int, v string, t int")
    assert rows(dedupe.dedupe(df, ["k"], "keep_first", ["t"])) == [(None, "e", 0), (1, "a", 2), (2, "c", 1)]
    assert rows(dedupe.dedupe(df, ["k"], "drop_all")) == [(2, "c", 1)]
    assert dedupe.dedupe(df, ["k"], "none") is df
    assert rows(dedupe.repeated_keys(df, ["k"])) == [(None, 2), (1, 2)]
    with pytest.raises(ValueError):
        dedupe.dedupe(df, ["k"], "other")


def test_aggregates_keep_types_and_honour_conditions(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 4.0), ("b", None, 1.0)], "k string, n long, x double")
    out = aggregate.bucket_aggregate(
        df, ["k"],
        [Aggregation("n", "sum", "s"), Aggregation("*", "count", "c", "x > 2"), Aggregation("x", "count", "cx"),
         Aggregation("n", "last", "l", order_by="n"), Aggregation("n", "first", "f", "n > 1", order_by="n")],
    )
    assert dict(out.dtypes)["s"] == "bigint"
    assert {tuple(r) for r in out.collect()} == {("a", 3, 1, 2, 2, 2), ("b", 0, 0, 1, None, None)}
    for bad in (Aggregation("*", "sum", "s"), Aggregation("n", "first", "s"), Aggregation("n", "median", "s")):
        with pytest.raises(ValueError):
            bad.column(df)


def test_rolling_against_brute_force(spark):
    rng = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    data = [(i, rng.choice(["x", "x", None]), start + dt.timedelta(seconds=rng.randint(0, 4000)), rng.randint(0, 9) or None) for i in range(400)]
    df = spark.createDataFrame(data, "id int, k string, ts timestamp_ntz, v long")
    windows = {"a": 50, "b": 7}
    out = rolling_sums(df, ["k"], "ts", windows, ["v"])
    got = {r["id"]: (r["v_a"], r["v_b"]) for r in out.collect()}
    assert len(got) == 400 and dict(out.dtypes)["v_a"] == "bigint"
    for i, k, t, _ in data:
        want = tuple(
            sum(v or 0 for _, k2, t2, v in data if k2 == k and 1 <= (t - t2).total_seconds() <= n) for n in windows.values()
        )
        assert got[i] == want


def test_pivot_top_k_and_missing(spark, rows):
    df = spark.createDataFrame([("p1", 5.0), ("p2", 7.0), ("p3", 7.0), (None, 1.0)], "e string, v double")
    top = aggregate.top_entities(df, "e", "v", 2)
    assert [r["e"] for r in top.collect()] == ["p2", "p3"]
    assert rows(aggregate.map_rest_to_other(df, "e", top), "e") == [("other",), ("other",), ("p2",), ("p3",)]
    assert rows(aggregate.missing_values(df, "e", ["p1", "p9"])) == [("p9",)]
    wide = aggregate.pivot_wide(df, [], "e", ["p1", "zz"], {"v": (F.sum, F.col("v"))}, fill=0)
    assert tuple(wide.first()) == (5.0, 0.0)


def test_feature_mapping_and_report(spark, rows):
    df = spark.createDataFrame([("Ab", 1.0), (None, None)], "s string, x double")
    features = {"f": Feature(case="lowercase", allowed_values=("ab",)), "g": Feature(min_value=2.0)}
    out = enrich.map_features(df, [FieldMapping("s", "f"), FieldMapping("x", "g", "h")], features)
    assert rows(out) == [("ab", 2.0), ("others", None)]
    with pytest.raises(KeyError):
        enrich.map_features(df, [FieldMapping("s", "nope")], features)
    report = {r["feature"]: r for r in enrich.contract_report(df, {"s": Feature(regex="^A", nullable=False), "x": Feature()}).collect()}
    assert (report["s"]["null_pct"], report["s"]["passed"], report["x"]["passed"]) == (50.0, False, True)


def test_feature_join_null_keys(spark, rows):
    base = spark.createDataFrame([("a", 1), (None, 2), ("z", 3)], "k string, n int")
    features = spark.createDataFrame([("a", 10.0), (None, 20.0)], "fk string, v double")
    spec = FeatureJoin({"k": "fk"}, ["v"], {"v": "value"}, fill_na=0.0)
    assert rows(enrich.join_features(base, features, spec)) == [(None, 2, 20.0), ("a", 1, 10.0), ("z", 3, 0.0)]
    plain = FeatureJoin({"k": "fk"}, ["v"], null_safe=False)
    assert rows(enrich.join_features(base, features, plain)) == [(None, 2, None), ("a", 1, 10.0), ("z", 3, None)]


def test_thresholds_without_weight_and_constant_histogram(spark):
    empty = spark.createDataFrame([], "x double, w double")
    assert normalize.weighted_threshold(empty, "x", "w").first()[0] == 0.0
    assert normalize.histogram(empty, "x").count() == 0
    same = spark.createDataFrame([(5.0, 1.0), (5.0, 2.0), (None, 1.0)], "x double, w double")
    got = normalize.histogram(same, "x", 4, log=False).collect()
    assert [(r["bin"], r["bin_center"], r["count"], r["probability"]) for r in got] == [(0, 5.5, 2, 1.0)]


def test_sketch_equals_exact_on_small_groups(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("g"), (F.col("id") + 1).cast("double").alias("x"))
    exact = normalize.robust_stats(df, "x", ["g"], exact=True).orderBy("g").collect()
    assert exact == normalize.robust_stats(df, "x", ["g"], exact=False).orderBy("g").collect()


def test_compare_and_diff(spark, rows):
    new = spark.createDataFrame([("a", 1.0), (None, 2.0), ("c", 0.0)], "k string, v double")
    old = spark.createDataFrame([("a", 2.0), (None, 2.0), ("d", 1.0)], "k string, v double")
    inner = {r["k"]: r for r in compare.compare_outputs(new, old, ["k"], ["v"]).collect()}
    assert inner["a"]["diff_v"] == -1.0 and inner["a"]["pct_diff_v"] == 50.0 and inner[None]["pct_diff_v"] == 0.0
    outer = {r["k"]: r for r in compare.compare_outputs(new, old, ["k"], ["v"], "full_outer").collect()}
    assert outer["d"]["diff_v"] == -1.0 and outer["c"]["pct_diff_v"] == 0.0
    summary = compare.comparison_summary(compare.compare_outputs(new, old, ["k"], ["v"]), ["v"]).first()
    assert (summary["rows"], summary["exact_matches"], summary["max_abs_diff"]) == (2, 1, 1.0)
    assert rows(compare.only_in(new, old, ["k"]), "k") == [("c",)]
    assert rows(compare.snapshot_diff(old, new, ["k"])) == [("a", "modified"), ("c", "added"), ("d", "removed")]
    with pytest.raises(ValueError):
        compare.require_rows(new.where("false"), "new")
