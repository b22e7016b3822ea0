"""Mergeable states, row counts from footers, and the leaderboard."""

import random

import pytest
from pyspark.sql import functions as F

from adlake.operators import bids
from adlake.operators import entity_similarity as es
from adlake.operators import sketches as sk
from adlake.operators.normalize import quantile_buckets
from adlake.sources.tables import footer_rows

KEPT = [sk.State("q", "v", "quantiles"), sk.State("d", "u", "distinct"), sk.State("t", "u", "theta")]


@pytest.fixture(scope="module")
def rows(spark):
    """Seven days; users overlap between days, values are skewed, one group is hot; NULL and NaN values."""
    ids = spark.range(60000, numPartitions=6)
    return ids.select(
        F.expr("timestamp_ntz'2024-01-01 00:30:00' + make_interval(0, 0, 0, CAST(id % 7 AS INT), CAST(id % 24 AS INT), 0, 0)").alias("ts"),
        F.when(F.col("id") % 3 == 0, "b").when(F.col("id") % 50 == 1, None).otherwise("a").alias("g"),
        ((F.col("id") % 7) * 300 + F.xxhash64("id") % 2000).alias("u"),
        F.when(F.col("id") % 101 == 0, None).when(F.col("id") % 103 == 0, F.lit(float("nan"))).otherwise(F.exp(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10007)) / 1500)).alias("v"),
    )


def hourly(rows):
    return sk.states(rows.withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz")), ["hour", "g"], KEPT)


def test_hours_days_weeks(spark, rows):
    hours = hourly(rows)
    days = sk.roll_up(hours, ["g"], KEPT, "hour", "day")
    week = sk.roll_up(days, ["g"], KEPT)
    assert days.count() == 21 and week.count() == 3
    exact = {r.g: r for r in rows.groupBy("g").agg(F.count("*").alias("n"), F.countDistinct("u").alias("u")).collect()}
    for r in week.select("g", "rows", sk.distinct_estimate("d").alias("d"), sk.distinct_estimate("t", "theta").alias("t")).collect():
        assert r.rows == exact[r.g].n
        assert r.t == exact[r.g].u  # fewer than the theta state holds
        assert abs(r.d - exact[r.g].u) <= 0.03 * exact[r.g].u
    summed = days.groupBy("g").agg(F.sum(sk.distinct_estimate("t", "theta")).alias("s")).collect()
    assert {r.g: r.s > 1.1 * exact[r.g].u for r in summed}["b"]  # what adding daily counts would give


def test_bitmaps_count_exactly_beyond_a_theta_state(spark):
    """40,000 users of either sign over two days, some NULL: a theta state of 16,384 values would only estimate them."""
    ids = spark.range(60000, numPartitions=3)
    events = ids.select(
        F.expr("timestamp_ntz'2024-01-01 00:30:00' + make_interval(0, 0, 0, CAST(id % 2 AS INT), CAST(id % 5 AS INT), 0, 0)").alias("hour"),
        F.when(F.col("id") % 10 == 3, F.lit("gone")).otherwise("kept").alias("g"),
        F.when(F.col("id") % 10 != 3, (F.col("id") % 40000) * 977 - 10**7).alias("u"),
    )
    days = sk.roll_up_bitmaps(sk.bitmaps(events.withColumn("hour", F.date_trunc("hour", "hour").cast("timestamp_ntz")), ["hour", "g"], "u"), ["g"], "hour", "day")
    got = {(r.hour, r.g): (r.rows, r.users) for r in sk.bitmap_counts(days, ["hour", "g"], "users").collect()}
    want = events.groupBy(F.date_trunc("day", "hour").cast("timestamp_ntz").alias("d"), "g").agg(F.count("*").alias("n"), F.countDistinct("u").alias("u"))
    assert got == {(r.d, r.g): (r.n, r.u) for r in want.collect()}
    whole = sk.bitmap_counts(sk.roll_up_bitmaps(days, ["g"]), ["g"], "users").where("g = 'kept'").first()
    assert whole.users == 36000


def test_registered_rollup_counts_many_users(spark, tmp_path):
    """More users a week than a theta state holds."""
    from adlake.catalog import QUERIES

    ids = spark.range(40000, numPartitions=2)
    ids.select(F.lit("view").alias("event_type"), (F.col("id") % 30000).alias("user_id"), F.expr("timestamp_ntz'2024-01-02 03:04:05'").alias("ts"), F.lit(1.0).alias("value")).write.parquet(str(tmp_path / "events.parquet"))
    assert [(r.rows, r.users) for r in QUERIES["distinct_rollup"](spark, str(tmp_path)).collect()] == [(40000, 30000)]


def test_quantiles_of_seven_stored_days(spark, rows):
    days = sk.roll_up(hourly(rows), ["g"], KEPT, "hour", "day")
    stats = {r.g: r for r in sk.robust_stats_of(days, ["g"], "q").collect()}
    values = {}
    for r in rows.where("v IS NOT NULL AND NOT isnan(v)").select("g", "v").collect():
        values.setdefault(r.g, []).append(r.v)
    for g, mine in values.items():
        below = sum(v <= stats[g].median for v in mine) / len(mine)
        assert abs(below - 0.5) < 0.015
    positive = sk.thresholds_of(days, ["g"], "q", "v")
    found = {r.g: r for r in positive.collect()}
    for g, mine in values.items():
        for i in (1, 2):
            share = sum(v <= found[g][f"v_threshold_{i}"] for v in mine) / len(mine)
            assert abs(share - (i / 3) ** 3) < 0.015
    assert quantile_buckets(rows.where("g IS NOT NULL"), positive, "v", ["g"]).select("v_bin").distinct().count() == 3
    ranks = sk.roll_up(days, [], KEPT).select(sk.rank_of("q", F.lit(-1.0)).alias("lo"), sk.rank_of("q", F.lit(1e9)).alias("hi")).first()
    assert tuple(ranks) == (0.0, 1.0)


def test_intersections_of_days(spark, rows):
    days = sk.roll_up(hourly(rows), ["g"], KEPT, "hour", "day")
    pairs = days.select(F.col("hour").alias("bucket_a")).distinct().select("bucket_a", (F.col("bucket_a") + F.expr("INTERVAL 1 DAY")).alias("bucket_b"))
    users = {}
    for r in rows.select(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("d"), "g", "u").distinct().collect():
        users.setdefault((r.d, r.g), set()).add(r.u)
    got = sk.compared(days, "hour", ["g"], "t", pairs).collect()
    assert len(got) == 18
    for r in got:
        a, b = users[r.bucket_a, r.g], users[r.bucket_b, r.g]
        assert (r.both, r.only_a, r.only_b) == (len(a & b), len(a - b), len(b - a))


def test_streamed_states_unite_with_batch(spark, rows, tmp_path):
    rows.coalesce(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    kept = [sk.State("q", "v", "quantiles"), sk.State("d", "u", "distinct")]
    run = sk.stream_states(stream, ["g"], kept, "ts").writeStream.outputMode("complete").format("memory").queryName("streamed_states")
    run.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    week = sk.roll_up(spark.table("streamed_states"), ["g"], kept)
    want = {r.g: r.n for r in rows.groupBy("g").agg(F.countDistinct("u").alias("n")).collect()}
    for r in week.select("g", sk.distinct_estimate("d").alias("d"), sk.quantile("q", 0.5).alias("m")).collect():
        assert abs(r.d - want[r.g]) <= 0.03 * want[r.g] and r.m is not None


def test_empty_states_and_unknown_kinds(spark, rows):
    none = sk.states(rows.where("v IS NULL"), ["g"], [sk.State("q", "v", "quantiles"), sk.State("d", "v", "distinct")])
    for r in none.select(sk.quantile("q", 0.5).alias("m"), sk.distinct_estimate("d").alias("d")).collect():
        assert (r.m, r.d) == (None, 0)
    assert sk.states(rows.limit(0), ["g"], KEPT).count() == 0
    with pytest.raises(ValueError):
        sk.State("x", "v", "guess").first()


def test_rows_from_footers(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    rows.withColumn("day", F.col("ts").cast("date")).write.partitionBy("day").parquet(path)
    counted = footer_rows(spark, path)
    assert counted.first()["rows"] == 60000
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan
    by_day = footer_rows(spark, path, ["day"])
    assert {r.day: r.rows for r in by_day.collect()} == {r.day: r.n for r in rows.groupBy(F.col("ts").cast("date").alias("day")).agg(F.count("*").alias("n")).collect()}
    assert "PushedAggregation: [COUNT(*)]" in by_day._jdf.queryExecution().executedPlan().toString()
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def test_leaderboard_and_segments(spark):
    draw = random.Random(1)
    data = [(f"s{draw.randrange(30)}", draw.randrange(3), round(draw.random(), 2), 1) for _ in range(500)] + [("zero", 0, 0.5, 1), ("nil", 0, 0.5, 1)]
    board = bids.leaderboard(spark.createDataFrame(data, "s string, c int, p double, b int"), "s", "c", "p", "b").orderBy("rank").collect()
    want = {}
    for s, c, p, _ in data:
        got = want.setdefault(s, [0, 0.0])
        got[0] += c
        got[1] += p
    order = sorted(want, key=lambda s: (-want[s][0], round(want[s][1], 6), s))
    assert [r.s for r in board] == order and [r["rank"] for r in board] == list(range(1, len(order) + 1))
    assert {r.s: r.cost_per_conversion for r in board}["zero"] is None
    named = spark.createDataFrame([("iOS", None, 3)], "a string, b string, c int").select(bids.segment_id(F.col("a"), F.col("b"), F.col("c")).alias("s"))
    assert named.first().s == "iOS_3"


def test_equal_costs_in_another_order_tie(spark):
    """Summed as doubles, 0.1 + 0.2 + 0.3 is more than 0.3 + 0.2 + 0.1, so b would come before a."""
    costs = {"a": [0.1, 0.2, 0.3], "b": [0.3, 0.2, 0.1], "c": [1e300, 1.0], "d": [None], "e": [0.6, float("inf")]}
    data = [(s, 1 if i == 0 else 0, p, 1) for s, ps in costs.items() for i, p in enumerate(ps)]
    board = bids.leaderboard(spark.createDataFrame(data, "s string, c int, p double, b int").coalesce(1), "s", "c", "p", "b").orderBy("rank").collect()
    assert [(r.s, r.cost) for r in board] == [("d", None), ("a", 0.6), ("b", 0.6), ("c", 1e300), ("e", float("inf"))]


def test_stability_matrix_takes_all_days(spark):
    daily = spark.createDataFrame([("e", "2024-01-02", 0.5), ("e", "2024-01-03", 1.0), ("f", "2024-01-03", 0.0)], "e string, d string, similarity double")
    got = {r.e: r.asDict() for r in es.stability_matrix(daily, ["e"], "d").collect()}
    assert got["f"] == {"e": "f", "2024-01-02": -1.0, "2024-01-03": 0.0, "avg_stability": -0.5} and got["e"]["avg_stability"] == 0.75
