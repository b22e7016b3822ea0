"""Bins, thresholds, normalisation and histograms."""

from __future__ import annotations

from pyspark.sql import functions as F

from adlake.catalog.registry import query, table, view
from adlake.functions import binning
from adlake.operators import aggregate, normalize

_POSITIVE = "CASE WHEN l_linenumber <> 7 THEN l_extendedprice END"


@query(
    "bins_preset",
    """SELECT event_id, CASE WHEN auction_winner_price IS NULL OR auction_winner_price <= 0 THEN '##empty##'
    WHEN auction_winner_price <= 1 THEN '(0,1]' WHEN auction_winner_price <= 2 THEN '(1,2]' WHEN auction_winner_price <= 4 THEN '(2,4]'
    WHEN auction_winner_price <= 8 THEN '(4,8]' WHEN auction_winner_price <= 16 THEN '(8,16]' ELSE '>16' END AS price_bin,
  CASE WHEN auction_winner_price IS NULL OR auction_winner_price <= 0 THEN '##empty##'
    WHEN auction_winner_price <= 5 THEN '(0,5]' WHEN auction_winner_price <= 25 THEN '(5,25]' WHEN auction_winner_price <= 125 THEN '(25,125]'
    WHEN auction_winner_price <= 625 THEN '(125,625]' WHEN auction_winner_price <= 3125 THEN '(625,3125]' ELSE '>3125' END AS count_bin,
  CASE WHEN auction_winner_price IS NULL OR auction_winner_price <= 0 THEN '##empty##'
    WHEN auction_winner_price / 200 <= 0.001058551445165888 THEN '(0,0.001058551445165888]'
    WHEN auction_winner_price / 200 <= 0.00733071019413941 THEN '(0.001058551445165888,0.00733071019413941]'
    WHEN auction_winner_price / 200 <= 0.12203971999280194 THEN '(0.00733071019413941,0.12203971999280194]'
    ELSE '>0.12203971999280194' END AS variance_bin
FROM auction_logs""",
    views=("auction_logs",),
)
def _(spark, sf_dir):
    price = F.col("auction_winner_price")
    return view(spark, sf_dir, "auction_logs").select(
        "event_id",
        binning.price_bin(price).alias("price_bin"),
        binning.request_count_bin(price).alias("count_bin"),
        binning.price_variance_bin(price / 200).alias("variance_bin"),
    )


@query(
    "weighted_threshold",
    "SELECT round(sum(l_extendedprice * l_quantity) / sum(l_quantity), 4) AS threshold FROM lineitem",
)
def _(spark, sf_dir):
    one = normalize.weighted_threshold(table(spark, sf_dir, "lineitem"), "l_extendedprice", "l_quantity")
    return one.select(F.round("threshold", 4).alias("threshold"))


@query(
    "split_threshold",
    f"""SELECT CASE WHEN x IS NULL OR x <= 0 THEN '##empty##' WHEN x <= t THEN 'below_threshold' ELSE 'above_threshold' END AS x_bin,
  count(*) AS n FROM (SELECT {_POSITIVE} AS x FROM lineitem) a,
  (SELECT sum(l_extendedprice * l_quantity) / sum(l_quantity) AS t FROM lineitem) b GROUP BY 1""",
)
def _(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    threshold = normalize.weighted_threshold(items, "l_extendedprice", "l_quantity")
    rows = items.select(F.expr(_POSITIVE).alias("x"))
    return normalize.split_at_threshold(rows, "x", threshold).groupBy("x_bin").agg(F.count("*").alias("n"))


@query(
    "column_profile",
    f"""SELECT min(x) AS min_val, max(x) AS max_val, round(avg(x), 4) AS avg_val, round(stddev_samp(x), 4) AS stddev_val,
  count(*) FILTER (WHERE x > 0) AS positive_count, count(*) AS total_count FROM (SELECT {_POSITIVE} AS x FROM lineitem) t""",
)
def _(spark, sf_dir):
    out = aggregate.column_profile(table(spark, sf_dir, "lineitem").select(F.expr(_POSITIVE).alias("x")), "x")
    return out.withColumns({"avg_val": F.round("avg_val", 4), "stddev_val": F.round("stddev_val", 4)})


@query(
    "describe_target",
    """SELECT count(l_extendedprice) AS n, round(avg(l_extendedprice), 4) AS mean, round(stddev_samp(l_extendedprice), 4) AS std,
  min(l_extendedprice) AS low, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS q2,
  quantile_cont(l_extendedprice, 0.75) AS q3, max(l_extendedprice) AS high FROM lineitem""",
)
def _(spark, sf_dir):
    """Count, mean, deviation and exact quartiles of the target."""
    from adlake.operators.running import exact_percentiles

    rows = table(spark, sf_dir, "lineitem").select(F.col("l_extendedprice").alias("y"))
    basic = rows.agg(
        F.count("y").alias("n"), F.round(F.avg("y"), 4).alias("mean"), F.round(F.stddev("y"), 4).alias("std"),
        F.min("y").alias("low"), F.max("y").alias("high"),
    )
    quartiles = exact_percentiles(rows, [], "y", {"q1": 0.25, "q2": 0.5, "q3": 0.75}).select(F.struct("q1", "q2", "q3"))
    return basic.select("*", quartiles.scalar().alias("q")).select("n", "mean", "std", "low", "q.*", "high")


_ROBUST = f"""g AS (SELECT l_suppkey, ln(1 + x) AS y FROM (SELECT l_suppkey, {_POSITIVE} AS x FROM lineitem) t WHERE x > 0),
s AS (SELECT l_suppkey, count(*) AS n, quantile_disc(y, 0.25) AS q1, quantile_disc(y, 0.5) AS q2, quantile_disc(y, 0.75) AS q3
  FROM g GROUP BY l_suppkey)"""


@query(
    "robust_stats",
    f"""WITH {_ROBUST} SELECT l_suppkey, n AS x_norm_count, round(q2, 8) AS x_log_median,
  round(CASE WHEN q3 - q1 < 0.001 THEN 0.001 ELSE q3 - q1 END, 8) AS x_log_iqr FROM s""",
)
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", F.expr(_POSITIVE).alias("x"))
    stats = normalize.robust_stats(rows, "x", ["l_suppkey"], exact=True)
    return stats.withColumns({c: F.round(c, 8) for c in ("x_log_median", "x_log_iqr")})


@query(
    "robust_normalise",
    f"""WITH {_ROBUST} SELECT l_orderkey, l_linenumber, t.l_suppkey,
  round(CASE WHEN x IS NULL OR x <= 0 OR q2 IS NULL THEN 0.0 ELSE
    (ln(1 + x) - q2) / CASE WHEN q3 - q1 < 0.001 THEN 0.001 ELSE q3 - q1 END END, 6) AS x_normalized
FROM (SELECT l_orderkey, l_linenumber, l_suppkey, {_POSITIVE} AS x FROM lineitem) t LEFT JOIN s ON t.l_suppkey = s.l_suppkey""",
)
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", F.expr(_POSITIVE).alias("x")
    )
    stats = normalize.robust_stats(rows, "x", ["l_suppkey"], exact=True)
    out = normalize.robust_normalise(rows, stats, "x", ["l_suppkey"]).drop("x")
    return out.withColumn("x_normalized", F.round("x_normalized", 6))


@query(
    "robust_stats_sketch",
    f"""WITH {_ROBUST} SELECT l_suppkey, n AS x_norm_count, round(q2, 8) AS x_log_median,
  round(CASE WHEN q3 - q1 < 0.001 THEN 0.001 ELSE q3 - q1 END, 8) AS x_log_iqr FROM s""",
)
def _(spark, sf_dir):
    """The sketch form, for groups of any size; it is exact while a group is smaller than the sketch."""
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", F.expr(_POSITIVE).alias("x"))
    stats = normalize.robust_stats(rows, "x", ["l_suppkey"], exact=False)
    return stats.withColumns({c: F.round(c, 8) for c in ("x_log_median", "x_log_iqr")})


_CUBE = f"""s AS (SELECT l_suppkey, quantile_disc(x, 1.0 / 64) AS t1, quantile_disc(x, 8.0 / 64) AS t2, quantile_disc(x, 27.0 / 64) AS t3
  FROM (SELECT l_suppkey, {_POSITIVE} AS x FROM lineitem) t WHERE x > 0 GROUP BY l_suppkey)"""


@query(
    "quantile_thresholds",
    f"WITH {_CUBE} SELECT l_suppkey, t1 AS x_threshold_1, t2 AS x_threshold_2, t3 AS x_threshold_3 FROM s",
)
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", F.expr(_POSITIVE).alias("x"))
    return normalize.quantile_thresholds(rows, "x", ["l_suppkey"], n_buckets=4, exact=True)


@query(
    "quantile_buckets",
    f"""WITH {_CUBE} SELECT t.l_suppkey, CASE WHEN x IS NULL OR x <= 0 OR t1 IS NULL THEN 'bucket_1' WHEN x <= t1 THEN 'bucket_1'
  WHEN x <= t2 THEN 'bucket_2' WHEN x <= t3 THEN 'bucket_3' ELSE 'bucket_4' END AS x_bin, count(*) AS n
FROM (SELECT l_suppkey, {_POSITIVE} AS x FROM lineitem) t LEFT JOIN s ON t.l_suppkey = s.l_suppkey GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", F.expr(_POSITIVE).alias("x"))
    cuts = normalize.quantile_thresholds(rows, "x", ["l_suppkey"], n_buckets=4, exact=True)
    out = normalize.quantile_buckets(rows, cuts, "x", ["l_suppkey"], n_buckets=4)
    return out.groupBy("l_suppkey", "x_bin").agg(F.count("*").alias("n"))


@query(
    "fixed_bins",
    """SELECT event_id, CASE WHEN p IS NULL THEN 'unknown' WHEN p <= 0 THEN 'low' WHEN p <= 20 THEN 'mid' ELSE 'high' END AS level,
  CASE WHEN z IS NULL THEN 'unknown' WHEN z <= -2 THEN 'bucket_1' WHEN z <= -1.5 THEN 'bucket_2' WHEN z <= -1 THEN 'bucket_3'
    WHEN z <= -0.5 THEN 'bucket_4' WHEN z <= 0 THEN 'bucket_5' WHEN z <= 0.5 THEN 'bucket_6' WHEN z <= 1 THEN 'bucket_7'
    WHEN z <= 1.5 THEN 'bucket_8' WHEN z <= 2 THEN 'bucket_9' ELSE 'bucket_10' END AS even_bucket,
  CASE WHEN s IS NULL THEN 'unknown' WHEN s <= sqrt(0.25) THEN 'bucket_1' WHEN s <= sqrt(0.5) THEN 'bucket_2'
    WHEN s <= sqrt(0.75) THEN 'bucket_3' ELSE 'bucket_4' END AS share_bucket
FROM (SELECT event_id, auction_winner_price - 5 AS p, (auction_winner_price - 20) / 8 AS z, auction_winner_price / 100 AS s
  FROM auction_logs) t""",
    views=("auction_logs",),
)
def _(spark, sf_dir):
    price = F.col("auction_winner_price")
    return view(spark, sf_dir, "auction_logs").select(
        "event_id",
        binning.fixed_bins(price - 5, [0, 20], ["low", "mid", "high"]).alias("level"),
        binning.normalised_bin((price - 20) / 8, 10).alias("even_bucket"),
        binning.share_bin(price / 100, 4).alias("share_bucket"),
    )


@query(
    "histogram_log",
    f"""WITH v AS (SELECT log10(x) AS x FROM (SELECT {_POSITIVE} AS x FROM lineitem) t WHERE x > 0),
s AS (SELECT min(x) AS low, CASE WHEN max(x) = min(x) THEN 1.0 ELSE (max(x) - min(x)) / 50 END AS w, count(*) AS total FROM v),
b AS (SELECT CAST(least(greatest(floor((x - low) / w), 0), 49) AS INT) AS bin, low, w, total FROM v, s)
SELECT bin, round(pow(10, low + (bin + 0.5) * w), 4) AS bin_center, count(*) AS count, count(*) / max(total) AS probability
FROM b GROUP BY bin, low, w""",
)
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.expr(_POSITIVE).alias("x"))
    return normalize.histogram(rows, "x", 50).withColumn("bin_center", F.round("bin_center", 4))


@query(
    "histogram_linear",
    """WITH s AS (SELECT min(value) AS low, (max(value) - min(value)) / 20 AS w, count(*) AS total FROM events),
b AS (SELECT CAST(least(greatest(floor((value - low) / w), 0), 19) AS INT) AS bin, low, w, total FROM events, s)
SELECT bin, round(low + (bin + 0.5) * w, 6) AS bin_center, count(*) AS count, count(*) / max(total) AS probability
FROM b GROUP BY bin, low, w""",
)
def _(spark, sf_dir):
    out = normalize.histogram(table(spark, sf_dir, "events"), "value", 20, log=False)
    return out.withColumn("bin_center", F.round("bin_center", 6))


@query(
    "density_histograms",
    """WITH v AS (SELECT 'l_quantity' AS "column", l_quantity AS x FROM lineitem
  UNION ALL SELECT 'l_extendedprice', l_extendedprice FROM lineitem),
s AS (SELECT "column", min(x) AS low, (max(x) - min(x)) / 50 AS w, count(*) AS total FROM v GROUP BY 1),
b AS (SELECT "column", CAST(least(greatest(floor((x - low) / w), 0), 49) AS INT) AS bin, low, w, total FROM v JOIN s USING ("column"))
SELECT "column", bin, round(low + (bin + 0.5) * w, 4) AS bin_center, count(*) AS count,
  round(count(*) / (max(total) * w), 10) AS density FROM b GROUP BY "column", bin, low, w""",
)
def _(spark, sf_dir):
    out = normalize.density_histograms(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice"])
    return out.withColumns({"bin_center": F.round("bin_center", 4), "density": F.round("density", 10)})


@query(
    "line_series",
    """SELECT CAST(date_trunc('day', ts) AS DATE) AS day, round(avg(value), 6) AS mean_value, count(*) AS n FROM events
GROUP BY 1 ORDER BY 1""",
)
def _(spark, sf_dir):
    daily = table(spark, sf_dir, "events").groupBy(F.col("ts").cast("date").alias("day")).agg(
        F.round(F.avg("value"), 6).alias("mean_value"), F.count("*").alias("n")
    )
    return normalize.line_series(daily, "day", ["mean_value", "n"])
