"""Decay, similarity over time and forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from adlake.catalog.registry import query, table, view
from adlake.functions.scalar import ratio_or_zero
from adlake.operators import aggregate, timeseries as ts

KEYS = ["rtb_id", "geo", "platform", "placement_type", "supply_name"]
METRICS = ["requests", "revenue", "ratio"]
_KEY = "concat_ws('||', " + ", ".join(f"coalesce({k}, '__NULL__')" for k in KEYS) + ")"

_DAILY = f"""daily AS (SELECT key, dt, requests, revenue, CASE WHEN requests > 0 THEN revenue / requests ELSE 0.0 END AS ratio FROM
  (SELECT {_KEY} AS key, dt, sum(bid_requests - coalesce(multiplied_bid_requests, 0)) AS requests, sum(unr) AS revenue FROM project_report GROUP BY 1, 2) t)"""


def _net(rows):
    return rows.withColumns(
        {"requests": F.col("bid_requests") - F.coalesce("multiplied_bid_requests", F.lit(0)), "revenue": F.col("unr")}
    )


def daily(spark, sf_dir):
    sums = ts.keyed_daily(_net(view(spark, sf_dir, "project_report")), KEYS, "dt", ["requests", "revenue"])
    return sums.withColumn("ratio", ratio_or_zero("revenue", "requests"))


def _vector(rows):
    """Σ per key over all days, with the ratio of sums."""
    sums = rows.groupBy("key").agg(F.sum("requests").alias("requests"), F.sum("revenue").alias("revenue"))
    return sums.withColumn("ratio", ratio_or_zero("revenue", "requests"))


def _r6(df):
    return df.withColumns({c: F.round(c, 6) for c, t in df.dtypes if t == "double"})


def _cos(a, b, where="TRUE"):
    """SQL for cosine and matches of two columns over rows where both are non-zero."""
    both = f"{where} AND {a} <> 0 AND {b} <> 0"
    return (
        f"round(coalesce(sum({a} * {b}) FILTER (WHERE {both}) / (sqrt(sum({a} * {a}) FILTER (WHERE {both})) * "
        f"sqrt(sum({b} * {b}) FILTER (WHERE {both}))), 0.0), 6) AS cosine, count(*) FILTER (WHERE {both}) AS matched"
    )


def _per_metric(select: str, tail: str = "") -> str:
    """The same statement for each metric, ``{m}`` filled in."""
    return " UNION ALL ".join((select + tail).replace("{m}", m) for m in METRICS)


@query(
    "decay_in_place",
    """SELECT dt, rtb_id, round(sum(unr * pow(0.9, DATE '2025-11-29' - dt)), 4) AS unr,
  round(sum(bid_requests * pow(0.98, DATE '2025-11-29' - dt)), 4) AS bid_requests FROM project_report GROUP BY 1, 2""",
    views=("project_report",),
)
def _(spark, sf_dir):
    out = ts.temporal_decay(view(spark, sf_dir, "project_report"), {"unr": 0.9, "bid_requests": 0.98}, "dt")
    sums = out.groupBy("dt", "rtb_id").agg(F.sum("unr").alias("unr"), F.sum("bid_requests").alias("bid_requests"))
    return sums.withColumns({"unr": F.round("unr", 4), "bid_requests": F.round("bid_requests", 4)})


@query(
    "decay_new_columns",
    """SELECT rtb_id, round(sum(unr), 4) AS unr, round(sum(unr * pow(0.92, DATE '2025-12-01' - dt)), 4) AS unr_decayed
FROM project_report GROUP BY 1""",
    views=("project_report",),
)
def _(spark, sf_dir):
    out = ts.temporal_decay(view(spark, sf_dir, "project_report"), {"unr": 0.92}, "dt", "2025-12-01", "_decayed")
    sums = out.groupBy("rtb_id").agg(F.sum("unr").alias("unr"), F.sum("unr_decayed").alias("unr_decayed"))
    return sums.withColumns({"unr": F.round("unr", 4), "unr_decayed": F.round("unr_decayed", 4)})


@query(
    "decayed_ratio",
    """SELECT rtb_id, geo, round(sum(unr * pow(0.92, DATE '2025-11-29' - dt)), 4) AS unr,
  round(sum(bid_requests * pow(0.99, DATE '2025-11-29' - dt)), 4) AS bid_requests,
  round(sum(unr * pow(0.92, DATE '2025-11-29' - dt)) / sum(bid_requests * pow(0.99, DATE '2025-11-29' - dt)), 8) AS ratio
FROM project_report GROUP BY 1, 2""",
    views=("project_report",),
)
def _(spark, sf_dir):
    rows = view(spark, sf_dir, "project_report")
    out = ts.decayed_ratio(rows, ["rtb_id", "geo"], "dt", ("unr", 0.92), ("bid_requests", 0.99))
    return out.withColumns(
        {"unr": F.round("unr", 4), "bid_requests": F.round("bid_requests", 4), "ratio": F.round("ratio", 8)}
    )


_SPLIT = """train AS (SELECT *, CASE WHEN requests > 0 THEN revenue / requests ELSE 0.0 END AS ratio FROM
  (SELECT key, sum(requests) AS requests, sum(revenue) AS revenue FROM daily WHERE dt < DATE '2025-11-27' GROUP BY 1) t),
test AS (SELECT *, CASE WHEN requests > 0 THEN revenue / requests ELSE 0.0 END AS ratio FROM
  (SELECT key, sum(requests) AS requests, sum(revenue) AS revenue FROM daily WHERE dt >= DATE '2025-11-27' GROUP BY 1) t),
faded AS (SELECT *, CASE WHEN requests > 0 THEN revenue / requests ELSE 0.0 END AS ratio FROM
  (SELECT key, sum(requests) AS requests, sum(revenue * pow(0.92, DATE '2025-11-26' - dt)) AS revenue FROM daily
   WHERE dt < DATE '2025-11-27' GROUP BY 1) t)"""


def _split(spark, sf_dir):
    days = daily(spark, sf_dir).drop("ratio")
    before = days.where("dt < DATE '2025-11-27'")
    test = _vector(days.where("dt >= DATE '2025-11-27'"))
    return days, before, test


@query(
    "cosine_train_test",
    f"WITH {_DAILY}, {_SPLIT} "
    + _per_metric(f"SELECT '{{m}}' AS metric, {_cos('a.{m}', 'b.{m}')} FROM train a JOIN test b USING (key)"),
    views=("project_report",),
)
def _(spark, sf_dir):
    _, before, test = _split(spark, sf_dir)
    return _r6(ts.keyed_cosine(_vector(before), test, "key", METRICS))


@query(
    "decay_improvement",
    f"WITH {_DAILY}, {_SPLIT}, r AS ("
    + _per_metric(f"SELECT '{{m}}' AS metric, {_cos('a.{m}', 'b.{m}')} FROM train a JOIN test b USING (key)")
    + "), d AS ("
    + _per_metric(f"SELECT '{{m}}' AS metric, {_cos('a.{m}', 'b.{m}')} FROM faded a JOIN test b USING (key)")
    + """) SELECT r.metric, r.cosine AS raw_cosine, r.matched, d.cosine AS decayed_cosine,
  round((d.cosine - r.cosine) / r.cosine * 100, 2) AS improvement_pct FROM r JOIN d USING (metric)""",
    views=("project_report",),
)
def _(spark, sf_dir):
    _, before, test = _split(spark, sf_dir)
    faded = _vector(ts.temporal_decay(before, {"revenue": 0.92, "requests": 1.0}, "dt", "2025-11-26"))
    out = ts.decay_improvement(_vector(before), faded, test, "key", METRICS)
    return out.select(
        "metric", F.round("raw_cosine", 6).alias("raw_cosine"), "matched",
        F.round("decayed_cosine", 6).alias("decayed_cosine"), F.round("improvement_pct", 2).alias("improvement_pct"),
    )


_EACH = (
    f"WITH {_DAILY}, {_SPLIT}, each_day AS ("
    + _per_metric(f"SELECT dt, '{{m}}' AS metric, {_cos('a.{m}', 'b.{m}')} FROM daily a JOIN test b USING (key) "
                  "WHERE dt < DATE '2025-11-27' GROUP BY dt")
    + ")"
)


def _each(spark, sf_dir):
    days, before, test = _split(spark, sf_dir)
    return ts.each_period_vs(before.withColumn("ratio", ratio_or_zero("revenue", "requests")), test, "key", "dt", METRICS)


@query("each_day_vs_test", f"{_EACH} SELECT * FROM each_day", views=("project_report",))
def _(spark, sf_dir):
    return _r6(_each(spark, sf_dir))


@query(
    "similarity_trend",
    f"""{_EACH}, s AS (SELECT metric, dt - DATE '2025-11-20' AS i, cosine FROM each_day),
t AS (SELECT metric, regr_slope(cosine, i) AS slope, regr_intercept(cosine, i) AS intercept, corr(cosine, i) AS correlation,
  arg_min(cosine, i) AS first_value, arg_max(cosine, i) AS last_value FROM s GROUP BY metric)
SELECT metric, round(slope, 4) AS slope, round(intercept, 4) AS intercept, round(correlation, 3) AS correlation,
  round(first_value, 4) AS first_value, round(last_value, 4) AS last_value, round(last_value - first_value, 4) AS change,
  CASE WHEN correlation > 0.5 AND last_value > first_value THEN 'strong positive' WHEN correlation > 0 AND last_value > first_value
    THEN 'weak positive' WHEN correlation < -0.5 AND last_value < first_value THEN 'strong negative'
    WHEN abs(correlation) < 0.3 THEN 'no clear trend' ELSE 'negative' END AS verdict FROM t""",
    views=("project_report",),
)
def _(spark, sf_dir):
    series = _each(spark, sf_dir).withColumn("i", F.datediff("dt", F.lit("2025-11-20").cast("date")))
    series = series.withColumn("cosine", F.round("cosine", 6))
    out = ts.series_trend(series, ["metric"], "i", "cosine").drop("change_pct")
    digits = {c: 4 for c in ("slope", "intercept", "first_value", "last_value", "change")} | {"correlation": 3}
    return out.withColumns({c: F.round(c, d) for c, d in digits.items()})


_PAIRS = (
    f"WITH {_DAILY}, idx AS (SELECT dt, row_number() OVER (ORDER BY dt) AS i FROM (SELECT DISTINCT dt FROM daily) t), "
    "di AS (SELECT daily.*, i FROM daily JOIN idx USING (dt)), pairs AS ("
    + _per_metric(
        f"SELECT '{{m}}' AS metric, a.dt AS period_1, b.dt AS period_2, CAST(b.i - a.i AS INT) AS gap, {_cos('a.{m}', 'b.{m}')} "
        "FROM di a JOIN di b ON a.key = b.key AND a.i < b.i GROUP BY 2, 3, 4"
    )
    + ")"
)


def _pairs(spark, sf_dir, gaps=None):
    return _r6(ts.period_pairs(daily(spark, sf_dir), "key", "dt", METRICS, gaps))


@query(
    "consecutive_days",
    f"{_PAIRS} SELECT metric, period_1, period_2, cosine, matched FROM pairs WHERE gap = 1",
    views=("project_report",),
)
def _(spark, sf_dir):
    return _r6(ts.consecutive_similarity(daily(spark, sf_dir), "key", "dt", METRICS))


@query(
    "gap_similarity",
    f"{_PAIRS} SELECT metric, gap, round(avg(cosine), 5) AS mean_cosine, count(*) AS pairs FROM pairs WHERE gap <= 5 GROUP BY 1, 2",
    views=("project_report",),
)
def _(spark, sf_dir):
    out = ts.mean_by_gap(_pairs(spark, sf_dir, [1, 2, 3, 4, 5]))
    return out.withColumn("mean_cosine", F.round("mean_cosine", 5))


@query(
    "day_matrix",
    f"""{_PAIRS} SELECT metric, period_1, period_2, cosine FROM pairs UNION ALL SELECT metric, period_2, period_1, cosine FROM pairs
UNION ALL SELECT metric, dt, dt, 1.0 FROM idx, (SELECT DISTINCT metric FROM pairs) t""",
    views=("project_report",),
)
def _(spark, sf_dir):
    days = daily(spark, sf_dir)
    return _r6(ts.full_matrix(ts.period_pairs(days, "key", "dt", METRICS), days, "dt", METRICS))


@query(
    "implied_decay",
    f"""{_PAIRS}, g AS (SELECT metric, gap, avg(cosine) AS c FROM pairs WHERE gap <= 5 GROUP BY 1, 2)
SELECT metric, round(exp(regr_slope(ln(c), gap)), 4) AS decay_rate, count(*) AS points FROM g WHERE c > 0 GROUP BY 1""",
    views=("project_report",),
)
def _(spark, sf_dir):
    out = ts.implied_decay(ts.mean_by_gap(_pairs(spark, sf_dir, [1, 2, 3, 4, 5])))
    return out.withColumn("decay_rate", F.round("decay_rate", 4))


_HOURLY = """h AS (SELECT strftime(ts, '%Y-%m-%d %H') AS dh, concat_ws('||', CAST(user_id AS VARCHAR), event_type) AS key,
  sum(value) AS total FROM events GROUP BY 1, 2),
idx AS (SELECT dh, row_number() OVER (ORDER BY dh) AS i FROM (SELECT DISTINCT dh FROM h) t), hi AS (SELECT h.*, i FROM h JOIN idx USING (dh))"""
_HPAIRS = f"""WITH {_HOURLY}, hp AS (SELECT a.dh AS date_hour_1, b.dh AS date_hour_2, CAST(substr(a.dh, 12, 2) AS INT) AS hour_1,
  substr(a.dh, 12, 2) = '23' AND substr(b.dh, 12, 2) = '00' AS day_boundary, 'total' AS metric, {_cos('a.total', 'b.total')}
  FROM hi a JOIN hi b ON a.key = b.key AND b.i = a.i + 1 GROUP BY 1, 2)"""


def _hourly(spark, sf_dir):
    key = F.concat_ws("||", F.col("user_id").cast("string"), "event_type")
    rows = table(spark, sf_dir, "events").select(
        key.alias("key"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour_ts"), "value"
    )
    return rows.groupBy("key", "hour_ts").agg(F.sum("value").alias("total"))


def _hour_pairs(spark, sf_dir):
    return _r6(ts.hourly_pairs(_hourly(spark, sf_dir), "key", "hour_ts", ["total"]))


@query("hour_to_hour", f"{_HPAIRS} SELECT * FROM hp")
def _(spark, sf_dir):
    return _hour_pairs(spark, sf_dir)


@query(
    "stability_by_hour",
    f"""{_HPAIRS} SELECT metric, hour_1, round(avg(cosine), 4) AS mean_cosine, round(stddev_samp(cosine), 4) AS std_cosine, count(*) AS pairs
FROM hp GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    out = ts.stability_by_hour(_hour_pairs(spark, sf_dir))
    return out.withColumns({"mean_cosine": F.round("mean_cosine", 4), "std_cosine": F.round("std_cosine", 4)})


@query(
    "day_boundary_effect",
    f"""{_HPAIRS} SELECT metric, round(avg(cosine) FILTER (WHERE day_boundary), 4) AS boundary_mean,
  round(avg(cosine) FILTER (WHERE NOT day_boundary), 4) AS within_mean,
  round(avg(cosine) FILTER (WHERE day_boundary) - avg(cosine) FILTER (WHERE NOT day_boundary), 4) AS difference FROM hp GROUP BY 1""",
)
def _(spark, sf_dir):
    out = ts.boundary_effect(_hour_pairs(spark, sf_dir))
    return out.withColumns({c: F.round(c, 4) for c in ("boundary_mean", "within_mean", "difference")})


@query(
    "hourly_vs_daily",
    f"""WITH {_HOURLY}, p AS (SELECT b.i - a.i AS gap, a.dh, {_cos('a.total', 'b.total')} FROM hi a JOIN hi b ON a.key = b.key
  AND b.i - a.i IN (1, 24) GROUP BY 1, 2), g AS (SELECT gap, avg(cosine) AS c FROM p GROUP BY 1)
SELECT 'total' AS metric, round(max(c) FILTER (WHERE gap = 1), 4) AS sim_1h, round(max(c) FILTER (WHERE gap = 24), 4) AS sim_24h,
  round(max(c) FILTER (WHERE gap = 1) - max(c) FILTER (WHERE gap = 24), 4) AS "drop",
  round((max(c) FILTER (WHERE gap = 1) - max(c) FILTER (WHERE gap = 24)) / 23, 5) AS drop_per_hour FROM g""",
)
def _(spark, sf_dir):
    pairs = ts.period_pairs(_hourly(spark, sf_dir), "key", "hour_ts", ["total"], gaps=[1, 24])
    out = ts.hourly_vs_daily(ts.mean_by_gap(_r6(pairs)))
    return out.withColumns({c: F.round(c, 4) for c in ("sim_1h", "sim_24h", "drop")} | {"drop_per_hour": F.round("drop_per_hour", 5)})


# Forecasts -----------------------------------------------------------------------------------

# Both metrics are scaled by an irrational number, so that no result lies on a rounding tie, where engines differ.
_SERIES = f"""WITH {_DAILY}, {_SPLIT}, long AS (SELECT key, dt, 'requests' AS metric, requests * sqrt(2::DOUBLE) AS v FROM daily
  UNION ALL SELECT key, dt, 'revenue', revenue * sqrt(2::DOUBLE) FROM daily),
act AS (SELECT key, 'requests' AS metric, requests * sqrt(2::DOUBLE) AS actual FROM test
  UNION ALL SELECT key, 'revenue', revenue * sqrt(2::DOUBLE) FROM test),
pt AS (SELECT key, metric, v, row_number() OVER (PARTITION BY key, metric ORDER BY dt) AS i, count(*) OVER (PARTITION BY key, metric) AS n
  FROM long WHERE dt < DATE '2025-11-27')"""

def _history(spark, sf_dir):
    days, before, test = _split(spark, sf_dir)
    scaled = {m: F.col(m) * F.sqrt(F.lit(2.0)) for m in ("requests", "revenue")}
    history = aggregate.history_per_key(before.withColumns(scaled), ["key"], "dt", ["requests", "revenue"])
    return history, test.withColumns(scaled)


@query(
    "simple_forecasts",
    f"""{_SERIES} SELECT key, metric, round(avg(v), 4) AS mean, round(arg_max(v, i), 4) AS last_value,
  round(CASE WHEN count(*) = 1 THEN max(v) ELSE regr_intercept(v, i - 1) + regr_slope(v, i - 1) * count(*) END, 4) AS linear_trend,
  round(sum(v * pow(0.9, n - i)) / sum(pow(0.9, n - i)), 4) AS decay_mean FROM pt GROUP BY key, metric""",
    views=("project_report",),
)
def _(spark, sf_dir):
    history, _ = _history(spark, sf_dir)
    cells = []
    for m in ("requests", "revenue"):
        v = ts.known_values(F.col("series"), m)
        cells.append(
            F.struct(
                F.lit(m).alias("metric"),
                F.round(ts.mean_forecast(v), 4).alias("mean"),
                F.round(ts.last_value_forecast(v), 4).alias("last_value"),
                F.round(ts.linear_forecast(v), 4).alias("linear_trend"),
                F.round(ts.decay_mean_forecast(v, 0.9), 4).alias("decay_mean"),
            )
        )
    return history.select("key", F.explode(F.array(*cells)).alias("r")).select("key", "r.*")


_HOLT_REC = """, recur AS (SELECT key, metric, i, n, v AS level, lead_v - v AS trend FROM (SELECT *, lead(v) OVER (PARTITION BY key, metric ORDER BY i) AS lead_v
    FROM pt) q WHERE i = 1
  UNION ALL SELECT r.key, r.metric, p.i, p.n, {a} * p.v + (1 - {a}) * (r.level + r.trend),
    {b} * ({a} * p.v + (1 - {a}) * (r.level + r.trend) - r.level) + (1 - {b}) * r.trend
  FROM recur r JOIN pt p ON p.key = r.key AND p.metric = r.metric AND p.i = r.i + 1),
holt AS (SELECT key, metric, CASE WHEN n = 1 THEN level ELSE level + trend END AS holt FROM recur WHERE i = n)"""


@query(
    "holt_forecast",
    f"{_SERIES}{_HOLT_REC.format(a=0.3, b=0.1)} SELECT key, metric, round(holt, 4) AS holt FROM holt",
    views=("project_report",),
    recursive=True,
)
def _(spark, sf_dir):
    history, _ = _history(spark, sf_dir)
    cells = [
        F.struct(
            F.lit(m).alias("metric"),
            F.round(ts.holt_forecast(ts.known_values(F.col("series"), m), 0.3, 0.1), 4).alias("holt"),
        )
        for m in ("requests", "revenue")
    ]
    return history.select("key", F.explode(F.array(*cells)).alias("r")).select("key", "r.*")


@query(
    "adaptive_forecast",
    f"""{_SERIES}{_HOLT_REC.format(a=0.3, b=0.1)}, fit AS (SELECT key, metric, regr_r2(v, i) AS r2, arg_max(v, i) AS last, count(*) AS n, regr_syy(v, i) AS syy
  FROM pt GROUP BY 1, 2)
SELECT key, metric, round(CASE WHEN n > 1 AND syy > 0 AND r2 > 0.6 THEN holt ELSE last END, 4) AS adaptive FROM fit JOIN holt USING (key, metric)""",
    views=("project_report",),
    recursive=True,
)
def _(spark, sf_dir):
    """Holt for series that follow a line, else the last value."""
    history, _ = _history(spark, sf_dir)
    cells = [
        F.struct(
            F.lit(m).alias("metric"),
            F.round(ts.adaptive_forecast(ts.known_values(F.col("series"), m), 0.3, 0.1), 4).alias("adaptive"),
        )
        for m in ("requests", "revenue")
    ]
    return history.select("key", F.explode(F.array(*cells)).alias("r")).select("key", "r.*")


_PRED = """, pred AS (SELECT key, metric, 'mean' AS method, avg(v) AS p FROM pt GROUP BY 1, 2
  UNION ALL SELECT key, metric, 'last_value', arg_max(v, i) FROM pt GROUP BY 1, 2
  UNION ALL SELECT key, metric, 'linear_trend', CASE WHEN count(*) = 1 THEN max(v) ELSE regr_intercept(v, i - 1) + regr_slope(v, i - 1) * count(*) END
    FROM pt GROUP BY 1, 2
  UNION ALL SELECT key, metric, 'decay_' || CAST(r AS VARCHAR), sum(v * pow(r, n - i)) / sum(pow(r, n - i)) FROM pt,
    (VALUES (0.85::DOUBLE), (0.9::DOUBLE), (0.92::DOUBLE), (0.95::DOUBLE)) AS rates(r) GROUP BY 1, 2, r),
err AS (SELECT metric, method, abs(p - actual) / abs(actual) AS ape FROM pred JOIN act USING (key, metric) WHERE actual <> 0),
scores AS (SELECT metric, method, avg(ape) * 100 AS mape_pct, quantile_cont(ape, 0.5) * 100 AS median_ape_pct, count(*) AS n FROM err GROUP BY 1, 2)"""


def _scores(spark, sf_dir, methods):
    history, test = _history(spark, sf_dir)
    return ts.backtest(ts.forecast_errors(history, test, "key", ["requests", "revenue"], methods))


_GRID_ROWS = ", ".join(f"('{a}', '{b}')" for a in ts.HOLT_ALPHAS for b in ts.HOLT_BETAS)
_GRID = f"""{_PRED}, grid AS (SELECT x AS al, y AS be, x::DOUBLE AS a, y::DOUBLE AS b FROM (VALUES {_GRID_ROWS}) AS g(x, y)),
recur AS (SELECT key, metric, al, be, a, b, i, n, v AS level, lead_v - v AS trend FROM (SELECT *, lead(v) OVER (PARTITION BY key, metric ORDER BY i) AS lead_v
    FROM pt) q, grid WHERE i = 1
  UNION ALL SELECT r.key, r.metric, r.al, r.be, r.a, r.b, p.i, p.n, r.a * p.v + (1 - r.a) * (r.level + r.trend),
    r.b * (r.a * p.v + (1 - r.a) * (r.level + r.trend) - r.level) + (1 - r.b) * r.trend
  FROM recur r JOIN pt p ON p.key = r.key AND p.metric = r.metric AND p.i = r.i + 1),
herr AS (SELECT metric, al, be, abs(CASE WHEN n = 1 THEN level ELSE level + trend END - actual) / abs(actual) AS ape FROM recur JOIN act USING (key, metric)
  WHERE i = n AND actual <> 0),
every AS (SELECT * FROM scores UNION ALL SELECT metric, 'holt_a' || al || '_b' || be, avg(ape) * 100, quantile_cont(ape, 0.5) * 100, count(*) FROM herr GROUP BY ALL)"""


@query(
    "backtest_mape",
    f"""{_SERIES}{_GRID} SELECT metric, method, round(mape_pct, 4) AS mape_pct, round(median_ape_pct, 4) AS median_ape_pct, n FROM every""",
    views=("project_report",),
    recursive=True,
)
def _(spark, sf_dir):
    out = _scores(spark, sf_dir, ts.forecast_methods())
    return out.withColumns({"mape_pct": F.round("mape_pct", 4), "median_ape_pct": F.round("median_ape_pct", 4)})


@query(
    "backtest_grid",
    f"""{_SERIES}{_GRID} SELECT metric, method, round(mape_pct, 4) AS mape_pct, round(median_ape_pct, 4) AS median_ape_pct, n,
  CAST(row_number() OVER (PARTITION BY metric ORDER BY mape_pct, method) AS INTEGER) AS place FROM every""",
    views=("project_report",),
    recursive=True,
)
def _(spark, sf_dir):
    """All 19 methods, ranked."""
    out = ts.ranked_methods(_scores(spark, sf_dir, ts.forecast_methods()))
    return out.withColumns({"mape_pct": F.round("mape_pct", 4), "median_ape_pct": F.round("median_ape_pct", 4)})


@query(
    "best_methods",
    f"""{_SERIES}{_GRID}, b AS (SELECT metric, CASE WHEN method LIKE 'holt_%' THEN 'holt' WHEN method LIKE 'decay_%' THEN 'decay' ELSE 'baseline' END AS family,
  method, mape_pct FROM every)
SELECT metric, family, arg_min(method, mape_pct) AS method, round(min(mape_pct), 4) AS mape_pct FROM b GROUP BY 1, 2""",
    views=("project_report",),
    recursive=True,
)
def _(spark, sf_dir):
    out = ts.best_per_family(_scores(spark, sf_dir, ts.forecast_methods()))
    return out.withColumn("mape_pct", F.round("mape_pct", 4))


_BETA_CELLS = ", ".join(f"""round(avg(ape) FILTER (WHERE be = '{b}') * 100, 4) AS "beta_{b}\"""" for b in ts.HOLT_BETAS)


@query(
    "holt_grid",
    f"{_SERIES}{_GRID} SELECT metric, al::DOUBLE AS alpha, {_BETA_CELLS} FROM herr GROUP BY metric, al",
    views=("project_report",),
    recursive=True,
)
def _(spark, sf_dir):
    out = ts.holt_grid(_scores(spark, sf_dir, ts.forecast_methods(rates=())))
    return out.withColumns({f"beta_{b}": F.round(f"`beta_{b}`", 4) for b in ts.HOLT_BETAS})
