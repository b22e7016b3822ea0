"""Joins and enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from adlake.catalog.aggregates import WIN_AGGREGATIONS, rounded
from adlake.catalog.registry import query, table, view
from adlake.functions.scalar import translate_code
from adlake.operators import aggregate, compare, enrich
from adlake.operators.enrich import FeatureJoin
from adlake.operators.running import attach
from adlake.plans.jobs import enrichment
from adlake.session import cut_lineage
from adlake.sources.ranges import TimeRange, within

_FEATURE_SQL = """f AS (SELECT strftime(auction_timestamp, '%Y-%m-%d') AS date, strftime(auction_timestamp, '%H') AS hour, {dim},
  round(sum(coalesce(auction_winner_price, 0.0)), 4) AS win_price, count(*) AS wins FROM auction_logs WHERE is_tpd_winner GROUP BY ALL)"""


def _features(logs, dim):
    wins = enrich.with_time_columns(logs.where("is_tpd_winner"), "auction_timestamp")
    return rounded(
        wins.groupBy("date", "hour", dim).agg(
            F.sum(F.coalesce("auction_winner_price", F.lit(0.0))).alias("win_price"), F.count("*").alias("wins")
        )
    )


@query(
    "enrich_one",
    "WITH " + _FEATURE_SQL.format(dim="supply_name") + """ SELECT event_id, a.supply_name, coalesce(f.win_price, 0.0) AS supply_win_price,
  coalesce(f.wins, 0) AS wins FROM auction_logs a LEFT JOIN f ON strftime(auction_timestamp, '%Y-%m-%d') = f.date
  AND strftime(auction_timestamp, '%H') = f.hour AND a.supply_name IS NOT DISTINCT FROM f.supply_name""",
    views=("auction_logs",),
)
def _(spark, sf_dir):
    """One feature table, keys matched with NULL equal to NULL."""
    logs = view(spark, sf_dir, "auction_logs")
    spec = FeatureJoin(
        keys={"date": "date", "hour": "hour", "supply_name": "supply_name"},
        columns=["win_price", "wins"],
        rename={"win_price": "supply_win_price"},
        fill_na=0,
    )
    base = enrich.with_time_columns(logs.select("event_id", "supply_name", "auction_timestamp"), "auction_timestamp")
    return enrich.join_features(base, _features(logs, "supply_name"), spec).select(
        "event_id", "supply_name", "supply_win_price", "wins"
    )


@query(
    "enrich_task",
    """WITH f AS (SELECT date_trunc('hour', auction_timestamp) AS b, strftime(auction_timestamp, '%Y-%m-%d') AS date,
  strftime(auction_timestamp, '%H') AS hour, rtb_id, round(sum(coalesce(auction_winner_price, 0.0)), 4) AS win_price
  FROM auction_logs WHERE is_tpd_winner GROUP BY ALL),
g AS (SELECT strftime(auction_timestamp, '%Y-%m-%d') AS date, strftime(auction_timestamp, '%H') AS hour, rtb_id, req_country, count(*) AS requests
  FROM auction_logs WHERE auction_timestamp >= TIMESTAMP '2024-01-08' AND auction_timestamp < TIMESTAMP '2024-01-12' GROUP BY ALL)
SELECT g.date, g.hour, g.rtb_id, g.req_country, requests, coalesce(win_price, -1.0) AS rtb_win_price FROM g LEFT JOIN f
ON g.date = f.date AND g.hour = f.hour AND g.rtb_id IS NOT DISTINCT FROM f.rtb_id
AND f.b >= TIMESTAMP '2024-01-08' AND f.b < TIMESTAMP '2024-01-12'""",
    views=("auction_logs",),
)
def _(spark, sf_dir):
    logs, when = view(spark, sf_dir, "auction_logs"), TimeRange("2024-01-08", "2024-01-11")
    wins = aggregate.bucket_aggregate(logs.where("is_tpd_winner"), ["rtb_id"], WIN_AGGREGATIONS, "auction_timestamp")
    features = rounded(enrich.partition_columns(wins))
    join = FeatureJoin(
        keys={"date": "date", "hour": "hour", "rtb_id": "rtb_id"},
        columns=["hourly_win_price_sum"],
        rename={"hourly_win_price_sum": "rtb_win_price"},
        fill_na=-1.0,
    )
    return enrichment(
        within(logs, "auction_timestamp", when),
        {"wins": features},
        "auction_timestamp",
        {"wins": join},
        group_by=["date", "hour", "rtb_id", "req_country"],
        aggregations=[aggregate.Aggregation("*", "count", "requests")],
        output_columns=["date", "hour", "rtb_id", "req_country", "requests", "rtb_win_price"],
        time_range=when,
        feature_time="time_bucket",
    )


_FIVE = {
    "country": "country",
    "impression": "req_impression_type",
    "os": "os",
    "supply": "supply_name",
    "publisher": "req_pub_app_store_id",
}


@query(
    "enrich_five",
    """WITH w AS (SELECT *, strftime(auction_timestamp, '%Y-%m-%d') AS date, strftime(auction_timestamp, '%H') AS hour,
  CASE req_country WHEN 'USA' THEN 'US' WHEN 'IND' THEN 'IN' WHEN 'BRA' THEN 'BR' ELSE req_country END AS country, lower(req_os) AS os
  FROM auction_logs), """
    + ", ".join(
        f"""f_{n} AS (SELECT date, hour, rtb_id, {c}, round(sum(coalesce(auction_winner_price, 0.0)), 4) AS p, count(*) AS n FROM w
  WHERE is_tpd_winner GROUP BY ALL)"""
        for n, c in _FIVE.items()
    )
    + " SELECT w.event_id, "
    + ", ".join(f"coalesce(f_{n}.p, 0.0) AS win_price_{n}, coalesce(f_{n}.n, 0) AS win_count_{n}" for n in _FIVE)
    + " FROM w "
    + " ".join(
        f"LEFT JOIN f_{n} ON w.date = f_{n}.date AND w.hour = f_{n}.hour AND w.rtb_id = f_{n}.rtb_id AND w.{c} = f_{n}.{c}"
        for n, c in _FIVE.items()
    ),
    views=("auction_logs",),
)
def _(spark, sf_dir):
    """Five dimensions with plain equality. Wins are summed once to the finest grain; the five feature tables roll that
    short table up before they are joined."""
    logs = enrich.with_time_columns(view(spark, sf_dir, "auction_logs"), "auction_timestamp").withColumns(
        {
            "country": translate_code("req_country", {"USA": "US", "IND": "IN", "BRA": "BR"}),
            "os": F.lower("req_os"),
        }
    )
    finest = cut_lineage(
        logs.where("is_tpd_winner")
        .groupBy("date", "hour", "rtb_id", *_FIVE.values())
        .agg(F.sum(F.coalesce("auction_winner_price", F.lit(0.0))).alias("p"), F.count("*").alias("n"))
    )
    joins = []
    for name, column in _FIVE.items():
        features = finest.groupBy("date", "hour", "rtb_id", column).agg(
            F.round(F.sum("p"), 4).alias("win_price"), F.sum("n").alias("win_count")
        )
        keys = {k: k for k in ("date", "hour", "rtb_id", column)}
        rename = {"win_price": f"win_price_{name}", "win_count": f"win_count_{name}"}
        joins.append((features, FeatureJoin(keys, list(rename), rename, fill_na=0, null_safe=False)))
    base = logs.select("event_id", "date", "hour", "rtb_id", *_FIVE.values())
    return enrich.join_many(base, joins).drop("date", "hour", "rtb_id", *_FIVE.values())


@query(
    "null_safe_join",
    """SELECT a.req_country, a.n AS requests, b.n AS wins FROM (SELECT req_country, count(*) AS n FROM auction_logs GROUP BY 1) a
JOIN (SELECT req_country, count(*) AS n FROM auction_logs WHERE is_tpd_winner GROUP BY 1) b
ON a.req_country IS NOT DISTINCT FROM b.req_country""",
    views=("auction_logs",),
)
def _(spark, sf_dir):
    logs = view(spark, sf_dir, "auction_logs")
    requests = logs.groupBy("req_country").agg(F.count("*").alias("requests"))
    wins = logs.where("is_tpd_winner").groupBy("req_country").agg(F.count("*").alias("wins"))
    return attach(requests, wins, ["req_country"])


@query(
    "anti_missing",
    """SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)""",
)
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return compare.only_in(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), orders, ["c_custkey"])


@query(
    "right_join_fill",
    """SELECT n_name, coalesce(c, 0) AS customers FROM (SELECT c_nationkey, count(*) AS c FROM customer WHERE c_acctbal > 9000 GROUP BY 1) t
RIGHT JOIN nation ON c_nationkey = n_nationkey""",
)
def _(spark, sf_dir):
    rich = table(spark, sf_dir, "customer").where("c_acctbal > 9000").groupBy("c_nationkey").agg(F.count("*").alias("c"))
    joined = rich.join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "right")
    return joined.select("n_name", F.coalesce("c", F.lit(0)).alias("customers"))


@query(
    "full_outer_merge",
    """SELECT coalesce(a.k, b.k) AS nationkey, coalesce(a.n, 0) AS suppliers, coalesce(b.n, 0) AS customers FROM
(SELECT s_nationkey AS k, count(*) AS n FROM supplier WHERE s_acctbal > 5000 GROUP BY 1) a FULL JOIN
(SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_acctbal > 9500 GROUP BY 1) b ON a.k = b.k""",
)
def _(spark, sf_dir):
    a = table(spark, sf_dir, "supplier").where("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("nationkey"))
    b = table(spark, sf_dir, "customer").where("c_acctbal > 9500").groupBy(F.col("c_nationkey").alias("nationkey"))
    merged = a.agg(F.count("*").alias("suppliers")).join(b.agg(F.count("*").alias("customers")), "nationkey", "outer")
    return merged.fillna(0, subset=["suppliers", "customers"])
