"""Dedupe, aggregation, rolling windows, pivots and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from adlake.catalog.registry import query, table, view
from adlake.functions import scalar
from adlake.operators import aggregate, dedupe
from adlake.operators import sketches as sk
from adlake.operators.aggregate import Aggregation
from adlake.operators.rolling import rolling_sums
from adlake.plans.jobs import EtlParams, Rolling, etl
from adlake.session import cut_lineage
from adlake.sources.ranges import TimeRange, lookback_hours, within

DIMS = ["rtb_id", "supply_name", "req_pub_app_store_id", "req_impression_type", "req_country", "req_os"]
WINDOWS = {"1h": 3600, "3h": 10800}
METRICS = ["hourly_win_price_sum", "hourly_win_count"]
DAYS = [f"2025-11-{d}" for d in range(20, 30)]
WIN_AGGREGATIONS = (
    Aggregation("auction_winner_price", "sum", "hourly_win_price_sum"),
    Aggregation("*", "count", "hourly_win_count"),
)

HOURLY = """hourly AS (SELECT date_trunc('hour', auction_timestamp) AS time_bucket, {dims},
  sum(coalesce(auction_winner_price, 0.0)) AS hourly_win_price_sum, count(*) AS hourly_win_count
FROM auction_logs WHERE is_tpd_winner {extra} GROUP BY ALL)"""

ROLLED = """SELECT time_bucket, {dims}, round(hourly_win_price_sum, 4) AS hourly_win_price_sum, hourly_win_count,
  round(coalesce(sum(hourly_win_price_sum) OVER (w RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND INTERVAL 1 SECOND PRECEDING), 0.0), 4)
    AS hourly_win_price_sum_1h,
  CAST(coalesce(sum(hourly_win_count) OVER (w RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND INTERVAL 1 SECOND PRECEDING), 0) AS BIGINT)
    AS hourly_win_count_1h,
  round(coalesce(sum(hourly_win_price_sum) OVER (w RANGE BETWEEN INTERVAL 3 HOUR PRECEDING AND INTERVAL 1 SECOND PRECEDING), 0.0), 4)
    AS hourly_win_price_sum_3h,
  CAST(coalesce(sum(hourly_win_count) OVER (w RANGE BETWEEN INTERVAL 3 HOUR PRECEDING AND INTERVAL 1 SECOND PRECEDING), 0) AS BIGINT)
    AS hourly_win_count_3h
FROM hourly WINDOW w AS (PARTITION BY {dims} ORDER BY time_bucket)"""


def rounded(df, digits=4):
    return df.withColumns({c: F.round(c, digits) for c, t in df.dtypes if t == "double"})


def hourly_wins(spark, sf_dir, dims, time_range=None, lookback=0):
    wins = view(spark, sf_dir, "auction_logs").where("is_tpd_winner")
    wins = within(wins, "auction_timestamp", time_range, lookback)
    return aggregate.bucket_aggregate(wins, dims, WIN_AGGREGATIONS, "auction_timestamp")


def _dims(*names):
    return ", ".join(names)


@query(
    "hourly_win_price",
    "WITH " + HOURLY.format(dims=_dims(*DIMS), extra="")
    + " SELECT * REPLACE (round(hourly_win_price_sum, 4) AS hourly_win_price_sum) FROM hourly",
    views=("auction_logs",),
)
def _(spark, sf_dir):
    return rounded(hourly_wins(spark, sf_dir, DIMS))


@query(
    "rolling_by_dims",
    "WITH " + HOURLY.format(dims=_dims(*DIMS), extra="") + " " + ROLLED.format(dims=_dims(*DIMS)),
    views=("auction_logs",),
)
def _(spark, sf_dir):
    hourly = hourly_wins(spark, sf_dir, DIMS)
    return rounded(rolling_sums(hourly, DIMS, "time_bucket", WINDOWS, METRICS, one_row_per_time=True))


FLAGSHIP_SQL = (
    "WITH "
    + HOURLY.format(
        dims=_dims("rtb_id", "req_pub_app_store_id"),
        extra="AND auction_timestamp >= TIMESTAMP '2024-01-04 21:00:00' AND auction_timestamp < TIMESTAMP '2024-01-26'",
    )
    + ", rolled AS ("
    + ROLLED.format(dims=_dims("rtb_id", "req_pub_app_store_id"))
    + ") SELECT *, strftime(time_bucket, '%Y-%m-%d') AS date, strftime(time_bucket, '%H') AS hour FROM rolled "
    "WHERE time_bucket >= TIMESTAMP '2024-01-05' AND time_bucket < TIMESTAMP '2024-01-26'"
)


@query("rolling_by_publisher", FLAGSHIP_SQL, views=("auction_logs",))
def flagship(spark, sf_dir):
    """Winners, deduplicated, by hour and publisher with rolling sums, the history trimmed off."""
    when = TimeRange("2024-01-05", "2024-01-25")
    params = EtlParams(
        group_by=["rtb_id", "req_pub_app_store_id"],
        time_column="auction_timestamp",
        aggregations=WIN_AGGREGATIONS,
        rolling_windows=[Rolling(name, seconds, METRICS) for name, seconds in WINDOWS.items()],
        dedupe_by=["event_id"],
        dedupe_order=["auction_timestamp"],
    )
    columns = ["event_id", "auction_timestamp", "rtb_id", "req_pub_app_store_id", "auction_winner_price"]
    wins = view(spark, sf_dir, "auction_logs").where("is_tpd_winner").select(*columns)
    wins = within(wins, "auction_timestamp", when, lookback_hours(list(WINDOWS.values())))
    return rounded(etl(wins, params, when))


@query(
    "rolling_events",
    """SELECT event_id, round(coalesce(sum(value) OVER (PARTITION BY event_type ORDER BY s RANGE BETWEEN 1800 PRECEDING AND 1 PRECEDING), 0.0), 4)
  AS value_30m FROM (SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events) t""",
)
def _(spark, sf_dir):
    """Rolling sums straight over events, several rows per second allowed."""
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    out = rolling_sums(rows, ["event_type"], "ts", {"30m": 1800}, ["value"])
    return out.select("event_id", F.round("value_30m", 4).alias("value_30m"))


_DOUBLED = "d AS (SELECT * FROM events UNION ALL SELECT * REPLACE (value + 1 AS value) FROM events WHERE event_id % 10 = 0)"


def _doubled(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.unionByName(events.where("event_id % 10 = 0").withColumn("value", F.col("value") + 1))


@query(
    "dedupe_keep_first",
    f"WITH {_DOUBLED} SELECT event_id, max(value) AS value, any_value(event_type) AS event_type FROM d GROUP BY event_id",
)
def _(spark, sf_dir):
    ranked = _doubled(spark, sf_dir).withColumn("rank", -F.col("value"))
    out = dedupe.keep_first(ranked.select("event_id", "event_type", "value", "rank"), ["event_id"], ["rank"])
    return out.select("event_id", "value", "event_type")


@query(
    "dedupe_drop_all",
    f"WITH {_DOUBLED} SELECT * FROM d WHERE event_id IN (SELECT event_id FROM d GROUP BY event_id HAVING count(*) = 1)",
)
def _(spark, sf_dir):
    return dedupe.drop_repeated(_doubled(spark, sf_dir), ["event_id"])


@query(
    "dedupe_none",
    "SELECT event_id, count(*) AS copies FROM (SELECT event_id FROM events UNION ALL SELECT event_id FROM events WHERE event_id % 10 = 0) t GROUP BY 1",
)
def _(spark, sf_dir):
    """Mode none leaves every copy."""
    left = dedupe.dedupe(_doubled(spark, sf_dir), ["event_id"], "none")
    return left.groupBy("event_id").agg(F.count("*").alias("copies"))


@query(
    "dedupe_report",
    f"WITH {_DOUBLED} SELECT event_id, count(*) AS copies FROM d GROUP BY event_id HAVING count(*) > 1",
)
def _(spark, sf_dir):
    return dedupe.repeated_keys(_doubled(spark, sf_dir), ["event_id"])


@query(
    "agg_all_functions",
    """SELECT date_trunc('day', auction_timestamp)::TIMESTAMP AS time_bucket, rtb_id,
  round(sum(coalesce(auction_winner_price, 0.0)), 4) AS total, count(*) AS n, count(*) FILTER (WHERE req_os = 'iOS') AS n_ios,
  round(sum(CASE WHEN req_os = 'iOS' THEN coalesce(auction_winner_price, 0.0) ELSE 0.0 END), 4) AS total_ios,
  round(avg(auction_winner_price), 6) AS mean, min(auction_winner_price) AS low, max(auction_winner_price) AS high,
  count(DISTINCT supply_name) AS supplies, count(DISTINCT CASE WHEN is_tpd_winner THEN req_country END) AS won_countries,
  arg_min(event_id, (auction_timestamp, event_id)) AS first_event, arg_max(event_id, (auction_timestamp, event_id)) AS last_event
FROM auction_logs GROUP BY ALL""",
    views=("auction_logs",),
)
def _(spark, sf_dir):
    price = "auction_winner_price"
    aggregations = [
        Aggregation(price, "sum", "total"),
        Aggregation("*", "count", "n"),
        Aggregation("*", "count", "n_ios", "req_os = 'iOS'"),
        Aggregation(price, "sum", "total_ios", "req_os = 'iOS'"),
        Aggregation(price, "avg", "mean"),
        Aggregation(price, "min", "low"),
        Aggregation(price, "max", "high"),
        Aggregation("supply_name", "count_distinct", "supplies"),
        Aggregation("req_country", "count_distinct", "won_countries", "is_tpd_winner"),
        Aggregation("event_id", "first", "first_event", order_by="auction_timestamp"),
        Aggregation("event_id", "last", "last_event", order_by="auction_timestamp"),
    ]
    out = aggregate.bucket_aggregate(
        view(spark, sf_dir, "auction_logs"), ["rtb_id"], aggregations, "auction_timestamp", "day"
    )
    return out.withColumns({"total": F.round("total", 4), "total_ios": F.round("total_ios", 4), "mean": F.round("mean", 6)})


@query(
    "output_groupings",
    """SELECT CASE WHEN grouping(rtb_id) = 0 AND grouping(req_os) = 0 THEN 'by_os' WHEN grouping(rtb_id) = 0 THEN 'by_rtb'
    ELSE 'by_country' END AS grouping_name, rtb_id, req_os, req_country, count(*) AS n,
  round(sum(coalesce(auction_winner_price, 0.0)), 4) AS total
FROM auction_logs GROUP BY GROUPING SETS ((rtb_id, req_os), (rtb_id), (req_country))""",
    views=("auction_logs",),
)
def _(spark, sf_dir):
    groupings = {"by_os": ["rtb_id", "req_os"], "by_rtb": ["rtb_id"], "by_country": ["req_country"]}
    aggregations = [Aggregation("*", "count", "n"), Aggregation("auction_winner_price", "sum", "total")]
    rows = view(spark, sf_dir, "auction_logs").select("rtb_id", "req_os", "req_country", "auction_winner_price")
    return rounded(aggregate.grouping_sets_aggregate(rows, groupings, aggregations))


@query(
    "rollup_hours_to_days",
    "WITH " + HOURLY.format(dims=_dims(*DIMS), extra="") + """ SELECT date_trunc('day', time_bucket)::TIMESTAMP AS time_bucket, rtb_id,
  round(sum(hourly_win_price_sum), 4) AS win_price, CAST(sum(hourly_win_count) AS BIGINT) AS wins FROM hourly GROUP BY ALL""",
    views=("auction_logs",),
)
def _(spark, sf_dir):
    hourly = hourly_wins(spark, sf_dir, DIMS)
    sums = [Aggregation("hourly_win_price_sum", "sum", "win_price"), Aggregation("hourly_win_count", "sum", "wins")]
    return rounded(aggregate.bucket_aggregate(hourly, ["rtb_id"], sums, "time_bucket", "day"))


@query(
    "training_groups",
    """SELECT CASE WHEN exp_bucket = '49' THEN 'project_v1_control' ELSE exp_bucket END AS bucket, rtb_account_id, geo, platform,
  CAST(sum(coalesce(bid_requests, 0)) AS BIGINT) AS bid_requests, CAST(sum(coalesce(multiplied_bid_requests, 0)) AS BIGINT) AS multiplied,
  round(sum(coalesce(unr, 0)), 4) AS unr FROM project_report
WHERE dt >= DATE '2025-11-21' AND dt < DATE '2025-11-28' AND rtb_account_id NOT IN ('acc_3') AND platform IN ('android', 'iOS')
  AND (exp_bucket = '48' OR (exp_bucket IN ('49', 'project_v1_control') AND bid_requests >= 100))
GROUP BY ALL HAVING sum(coalesce(bid_requests, 0)) > 5000""",
    views=("project_report",),
)
def _(spark, sf_dir):
    rows = view(spark, sf_dir, "project_report").where(
        "dt >= DATE '2025-11-21' AND dt < DATE '2025-11-28' AND rtb_account_id NOT IN ('acc_3') "
        "AND platform IN ('android', 'iOS') "
        "AND (exp_bucket = '48' OR (exp_bucket IN ('49', 'project_v1_control') AND bid_requests >= 100))"
    )
    bucket = F.when(F.col("exp_bucket") == "49", "project_v1_control").otherwise(F.col("exp_bucket")).alias("bucket")
    sums = rows.groupBy(bucket, "rtb_account_id", "geo", "platform").agg(
        F.sum(F.coalesce("bid_requests", F.lit(0))).alias("bid_requests"),
        F.sum(F.coalesce("multiplied_bid_requests", F.lit(0))).alias("multiplied"),
        F.sum(F.coalesce("unr", F.lit(0.0))).alias("unr"),
    )
    return rounded(sums.where("bid_requests > 5000"))


_DAILY = """daily AS (SELECT dt, rtb_id, sum(bid_requests) * 10 AS req, CASE WHEN sum(bid_requests) > 0
  THEN sum(unr) / sum(bid_requests) * 1e9 ELSE 0.0 END AS nr FROM project_report WHERE exp_bucket = 'project_v1_control' GROUP BY 1, 2)"""


def _control_daily(spark, sf_dir):
    control = view(spark, sf_dir, "project_report").where("exp_bucket = 'project_v1_control'")
    return aggregate.daily_metrics(control, "rtb_id", "dt", "bid_requests", "unr")


@query(
    "daily_metrics",
    f"WITH {_DAILY} SELECT dt, rtb_id, CAST(req AS BIGINT) AS total_requests_scaled, round(nr, 0) AS nr_per_billion FROM daily",
    views=("project_report",),
)
def _(spark, sf_dir):
    return _control_daily(spark, sf_dir).withColumn("nr_per_billion", F.round("nr_per_billion", 0))


@query(
    "pivot_trend",
    f"WITH {_DAILY} SELECT rtb_id, "
    + ", ".join(
        f"""CAST(coalesce(sum(req) FILTER (WHERE dt = DATE '{d}'), 0) AS BIGINT) AS "{d}_requests",
  round(coalesce(sum(nr) FILTER (WHERE dt = DATE '{d}'), 0), 0) AS "{d}_nr_per_billion\""""
        for d in DAYS
    )
    + " FROM daily GROUP BY rtb_id ORDER BY sum(req) DESC",
    views=("project_report",),
)
def _(spark, sf_dir):
    return rounded(aggregate.trend_table(_control_daily(spark, sf_dir), "rtb_id", "dt"), 0)


FEATURES = ["geo", "platform", "placement_type", "supply_name"]


@query(
    "token_counts",
    " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST({f} AS VARCHAR) AS token, count(*) AS count FROM project_report GROUP BY 2"
        for f in FEATURES
    ),
    views=("project_report",),
)
def _(spark, sf_dir):
    return aggregate.token_counts(view(spark, sf_dir, "project_report"), FEATURES)


@query(
    "distribution_shift",
    " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST({f} AS VARCHAR) AS token, "
        + ", ".join(f"""count(*) FILTER (WHERE dt = DATE '{d}') AS "{d}\"""" for d in DAYS)
        + " FROM project_report GROUP BY 2"
        for f in FEATURES
    ),
    views=("project_report",),
)
def _(spark, sf_dir):
    return aggregate.distribution_shift(view(spark, sf_dir, "project_report"), FEATURES, "dt")


_TOP = """top AS (SELECT pub_app_object_id, sum(unr) AS total FROM project_report WHERE exp_bucket = 'project_v1_control'
  GROUP BY 1 ORDER BY total DESC, pub_app_object_id LIMIT 4)"""


def _top(spark, sf_dir, rows):
    control = F.col("exp_bucket") == "project_v1_control"
    return aggregate.top_entities(rows, "pub_app_object_id", "unr", 4, control)


@query(
    "top_k_entities",
    f"WITH {_TOP} SELECT pub_app_object_id, round(total, 4) AS total FROM top",
    views=("project_report",),
)
def _(spark, sf_dir):
    return rounded(_top(spark, sf_dir, view(spark, sf_dir, "project_report")))


@query(
    "top_k_other",
    f"""WITH {_TOP} SELECT CASE WHEN pub_app_object_id IN (SELECT pub_app_object_id FROM top) THEN pub_app_object_id ELSE 'other' END
  AS pub_app_object_id, count(*) AS n, round(sum(unr), 4) AS unr FROM project_report GROUP BY 1""",
    views=("project_report",),
)
def _(spark, sf_dir):
    rows = view(spark, sf_dir, "project_report").select("pub_app_object_id", "exp_bucket", "unr")
    mapped = aggregate.map_rest_to_other(rows, "pub_app_object_id", _top(spark, sf_dir, rows))
    return rounded(mapped.groupBy("pub_app_object_id").agg(F.count("*").alias("n"), F.sum("unr").alias("unr")))


@query(
    "group_metrics",
    """SELECT placement_type, CAST(sum(bid_requests) AS BIGINT) AS total_requests, round(sum(unr), 4) AS total_revenue, count(*) AS count,
  round(sum(unr) / nullif(sum(bid_requests), 0), 8) AS revenue_per_request FROM project_report GROUP BY 1""",
    views=("project_report",),
)
def _(spark, sf_dir):
    out = aggregate.group_metrics(view(spark, sf_dir, "project_report"), "placement_type", "bid_requests", "unr")
    return out.withColumns(
        {"total_revenue": F.round("total_revenue", 4), "revenue_per_request": F.round("revenue_per_request", 8)}
    )


@query(
    "missing_buckets",
    """SELECT v AS exp_bucket FROM (VALUES ('project_v1_control'), ('48'), ('55'), ('60')) AS t(v)
WHERE v NOT IN (SELECT exp_bucket FROM project_report)""",
    views=("project_report",),
)
def _(spark, sf_dir):
    wanted = ["project_v1_control", "48", "55", "60"]
    return aggregate.missing_values(view(spark, sf_dir, "project_report"), "exp_bucket", wanted)


@query(
    "key_history",
    """SELECT key, len(s) AS days, s[1].d AS first_day, s[len(s)].d AS last_day, s[1].v AS first_requests, s[len(s)].v AS last_requests
FROM (SELECT key, list({'d': dt, 'v': v} ORDER BY dt) AS s FROM (SELECT concat_ws('||', rtb_id, geo) AS key, dt,
  CAST(sum(bid_requests) AS BIGINT) AS v FROM project_report GROUP BY 1, 2) t GROUP BY key) u""",
    views=("project_report",),
)
def _(spark, sf_dir):
    key = scalar.feature_key(["rtb_id", "geo"]).alias("key")
    daily = view(spark, sf_dir, "project_report").groupBy(key, "dt").agg(F.sum("bid_requests").alias("v"))
    s = F.col("series")
    return aggregate.history_per_key(daily, ["key"], "dt", ["v"]).select(
        "key",
        F.size(s).cast("bigint").alias("days"),
        s[0]["dt"].alias("first_day"),
        F.element_at(s, -1)["dt"].alias("last_day"),
        s[0]["v"].alias("first_requests"),
        F.element_at(s, -1)["v"].alias("last_requests"),
    )


@query(
    "entity_tokens",
    """SELECT DISTINCT rtb_id, concat_ws('||', geo, platform, coalesce(placement_type, '__NULL__')) AS token FROM project_report""",
    views=("project_report",),
)
def _(spark, sf_dir):
    rows = view(spark, sf_dir, "project_report")
    return aggregate.entity_tokens(rows, ["rtb_id"], scalar.feature_key(["geo", "platform", "placement_type"]))


@query(
    "totals_by_date",
    """SELECT dt, round(sum(unr), 4) AS unr, round(sum(unr * pow(0.9, DATE '2025-11-29' - dt)), 4) AS unr_decayed
FROM project_report GROUP BY dt""",
    views=("project_report",),
)
def _(spark, sf_dir):
    from adlake.operators.timeseries import temporal_decay

    rows = view(spark, sf_dir, "project_report").select("dt", "unr", F.col("unr").alias("unr_decayed"))
    return rounded(aggregate.totals_by(temporal_decay(rows, {"unr_decayed": 0.9}, "dt"), ["dt"], ["unr", "unr_decayed"]))


@query(
    "chunked_squares",
    """SELECT round(sum(s), 2) AS total, count(*) AS chunks FROM (SELECT event_id // 100 AS chunk, sum(value * value) AS s
FROM events GROUP BY 1) t""",
)
def _(spark, sf_dir):
    out = aggregate.chunked_sum_of_squares(table(spark, sf_dir, "events"), "event_id", "value")
    return rounded(out, 2)


# States that roll up ---------------------------------------------------------------------------

_KEPT = [sk.State("q", "value", "quantiles"), sk.State("d", "user_id", "distinct"), sk.State("t", "user_id", "theta")]


def _hourly_states(spark, sf_dir):
    """States per hour and event type, written as a table of states would be."""
    rows = table(spark, sf_dir, "events").withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    return cut_lineage(sk.states(rows, ["hour", "event_type"], _KEPT))


@query(
    "distinct_rollup",
    """SELECT date_trunc('week', ts) AS week, event_type, count(*) AS rows, count(DISTINCT user_id) AS users FROM events GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    """Users per week and event type, exactly, from hourly bitmaps by way of daily ones."""
    rows = table(spark, sf_dir, "events").withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    hours = cut_lineage(sk.bitmaps(rows, ["hour", "event_type"], "user_id"))
    days = cut_lineage(sk.roll_up_bitmaps(hours, ["event_type"], "hour", "day"))
    weeks = sk.roll_up_bitmaps(days, ["event_type"], "hour", "week")
    return sk.bitmap_counts(weeks, ["hour", "event_type"], "users").withColumnRenamed("hour", "week").select("week", "event_type", "rows", "users")


@query(
    "distinct_estimates",
    """SELECT CAST(ts AS DATE) AS day, event_type, TRUE AS within FROM events GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    """Whether the HyperLogLog estimate of users per day, united from hours, is within 3 % of the count."""
    days = sk.roll_up(_hourly_states(spark, sf_dir), ["event_type"], _KEPT, "hour", "day")
    counted = table(spark, sf_dir, "events").groupBy(F.col("ts").cast("date").alias("day"), F.col("event_type").alias("_type")).agg(F.countDistinct("user_id").alias("n"))
    both = days.select(F.col("hour").cast("date").alias("_day"), "event_type", sk.distinct_estimate("d").alias("e")).join(
        counted, (F.col("day") == F.col("_day")) & (F.col("event_type") == F.col("_type"))
    )
    return both.select("day", "event_type", (F.abs(F.col("e") - F.col("n")) <= 0.03 * F.col("n")).alias("within"))


@query(
    "users_of_two_days",
    """WITH u AS (SELECT DISTINCT CAST(ts AS DATE) AS day, event_type, user_id FROM events),
p AS (SELECT DISTINCT x.day AS bucket_a, y.day AS bucket_b, x.event_type FROM u x JOIN u y ON y.day = x.day + 1 AND y.event_type = x.event_type)
SELECT bucket_a, bucket_b, event_type, count(*) FILTER (WHERE a AND b) AS both, count(*) FILTER (WHERE a AND NOT b) AS only_a, count(*) FILTER (WHERE b AND NOT a) AS only_b
FROM (SELECT p.*, user_id, bool_or(u.day = bucket_a) AS a, bool_or(u.day = bucket_b) AS b FROM p JOIN u ON u.event_type = p.event_type AND u.day IN (bucket_a, bucket_b)
  GROUP BY ALL) t GROUP BY ALL""",
)
def _(spark, sf_dir):
    """Users of a day and the next: both, only the first, only the second, from theta states."""
    days = sk.roll_up(_hourly_states(spark, sf_dir), ["event_type"], _KEPT, "hour", "day").withColumn("day", F.col("hour").cast("date"))
    days = cut_lineage(days)
    pairs = days.select(F.col("day").alias("bucket_a")).distinct().withColumn("bucket_b", F.date_add("bucket_a", 1))
    return sk.compared(days, "day", ["event_type"], "t", pairs)


@query(
    "quantile_states",
    """SELECT event_type, rank, TRUE AS within FROM (SELECT DISTINCT event_type FROM events) e, (SELECT unnest([0.1e0, 0.25e0, 0.5e0, 0.75e0, 0.9e0]) AS rank) r""",
)
def _(spark, sf_dir):
    """Whether quantiles of all days, united from hourly states, have their rank in the rows up to 1.5 %."""
    ranks = [0.1, 0.25, 0.5, 0.75, 0.9]
    merged = sk.roll_up(_hourly_states(spark, sf_dir), ["event_type"], _KEPT)
    cells = F.array(*[F.struct(F.lit(r).alias("rank"), sk.quantile("q", r).alias("x")) for r in ranks])
    found = merged.select(F.col("event_type").alias("_type"), F.inline(cells))
    rows = table(spark, sf_dir, "events").select("event_type", "value")
    placed = rows.join(found, F.col("event_type") == F.col("_type")).groupBy("event_type", "rank").agg(
        (F.count_if(F.col("value") < F.col("x")) / F.count("*")).alias("below"), (F.count_if(F.col("value") <= F.col("x")) / F.count("*")).alias("upto")
    )
    within = (F.col("below") <= F.col("rank") + 0.015) & (F.col("upto") >= F.col("rank") - 0.015)
    return placed.select("event_type", "rank", within.alias("within"))
