"""Bid-log statistics, best rounds and serving logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from adlake.catalog.registry import query, table, view
from adlake.operators import bids

_DECILES = ", ".join(f"round(quantile_cont(winner_price, {p / 100}), 6) AS p{p}" for p in range(10, 100, 10))


def _log(spark, sf_dir):
    return view(spark, sf_dir, "bid_log")


def _round(df, digits):
    return df.withColumns({c: F.round(c, digits) for c, t in df.dtypes if t == "double"})


@query("price_percentiles", f"SELECT {_DECILES} FROM bid_log", views=("bid_log",))
def _(spark, sf_dir):
    return _round(bids.price_percentiles(_log(spark, sf_dir), "winner_price"), 6)


@query("segment_percentiles", f"SELECT segment_id, {_DECILES} FROM bid_log GROUP BY 1", views=("bid_log",))
def _(spark, sf_dir):
    return _round(bids.price_percentiles(_log(spark, sf_dir), "winner_price", ["segment_id"]), 6)


@query(
    "conversion_rate",
    "SELECT segment_id, round(avg(is_conversion), 8) AS conversion_rate, count(*) AS rows FROM bid_log GROUP BY 1",
    views=("bid_log",),
)
def _(spark, sf_dir):
    return _round(bids.conversion_rate(_log(spark, sf_dir), "is_conversion", ["segment_id"]), 8)


@query(
    "best_round",
    """WITH r AS (SELECT segment_id, CAST(day(ts) AS INT) AS round, sum(is_conversion) AS conversions FROM bid_log GROUP BY 1, 2)
SELECT segment_id, arg_max(round, (conversions, -round)) AS best_round, CAST(max(conversions) AS BIGINT) AS conversions FROM r GROUP BY 1""",
    views=("bid_log",),
)
def _(spark, sf_dir):
    """Days stand in for rounds and segments for lineages."""
    rounds = _log(spark, sf_dir).groupBy("segment_id", F.dayofmonth("ts").alias("round")).agg(
        F.sum("is_conversion").alias("conversions")
    )
    return bids.best_round(rounds, "segment_id", "round", "conversions")


_LATENCY = """t AS (SELECT l_shipmode, b, l FROM (SELECT 'c' || CAST(l_suppkey % 4 AS VARCHAR) AS l_shipmode, CAST(pow(2, l_suppkey % 4) AS INTEGER) AS b,
  l_extendedprice / 100 AS l FROM lineitem) x),
k AS (SELECT l_shipmode AS config, b, avg(l) AS mean_latency, count(*) / (sum(l) / 1000) * max(b) AS throughput, count(*) AS calls,
  list_sort(list(l))[CAST(floor(0.99 * count(*)) AS BIGINT) + 1] AS p99_latency FROM t GROUP BY 1, 2)"""


def _timings(spark, sf_dir):
    group = F.col("l_suppkey") % 4
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("c"), group.cast("string")).alias("config"),
        F.pow(F.lit(2), group).cast("int").alias("b"),
        (F.col("l_extendedprice") / 100).alias("latency"),
    )


def _summary(spark, sf_dir):
    seconds = F.sum("latency") / 1000
    return bids.latency_summary(_timings(spark, sf_dir), ["config", "b"], "latency", "b", seconds)


@query(
    "latency_summary",
    f"""WITH {_LATENCY} SELECT config, b, round(mean_latency, 6) AS mean_latency, round(throughput, 6) AS throughput, calls,
  round(p99_latency, 6) AS p99_latency FROM k""",
)
def _(spark, sf_dir):
    return _round(_summary(spark, sf_dir), 6)


@query(
    "best_configuration",
    f"WITH {_LATENCY} SELECT round(mean_latency, 6) AS mean_latency, config, b FROM k ORDER BY k.mean_latency LIMIT 1",
)
def _(spark, sf_dir):
    return _round(bids.best_configuration(_summary(spark, sf_dir), ["config", "b"]), 6)


@query(
    "leaderboard",
    """WITH t AS (SELECT concat('user_', user_id) AS strategy, CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS conversions,
  sum(value) AS cost, count(*) AS bids FROM events GROUP BY 1)
SELECT strategy, conversions, round(cost, 6) AS cost, bids, round(cost / nullif(conversions, 0), 6) AS cost_per_conversion,
  row_number() OVER (ORDER BY conversions DESC, cost, strategy) AS rank FROM t""",
)
def _(spark, sf_dir):
    """Users stand in for strategies, purchases for conversions."""
    results = table(spark, sf_dir, "events").select(
        F.concat(F.lit("user_"), "user_id").alias("strategy"), (F.col("event_type") == "purchase").cast("int").alias("c"), "value", F.lit(1).alias("one")
    )
    return _round(bids.leaderboard(results, "strategy", "c", "value", "one"), 6)


@query(
    "segment_ids",
    "SELECT concat_ws('|', event_type, CAST(user_id AS VARCHAR), CAST(day(ts) AS VARCHAR)) AS segment_id, count(*) AS rows FROM events GROUP BY 1",
)
def _(spark, sf_dir):
    """Rows per segment of type, user and day."""
    parts = [F.col("event_type"), F.col("user_id"), F.dayofmonth("ts")]
    return table(spark, sf_dir, "events").groupBy(bids.segment_id(*parts, separator="|").alias("segment_id")).agg(F.count("*").alias("rows"))
