"""Scalar features, mappings and contracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from adlake.catalog.registry import query, table, view
from adlake.functions import scalar, vocab
from adlake.operators import enrich
from adlake.operators.enrich import Feature, FieldMapping

FEATURES = {
    "supply": Feature(case="uppercase", allowed_values=("CLICK", "PURCHASE", "VIEW"), fill_na="REST"),
    "os": Feature(case="lowercase"),
    "country": Feature(allowed_values=("USA", "IND")),
    "win_price": Feature(dtype="double", min_value=5.0, max_value=60.0, fill_na=0.0),
    "raw_price": Feature(dtype="double", min_value=5.0, max_value=60.0),
}


@query(
    "feature_mapping",
    """SELECT event_id,
  CASE WHEN upper(supply_name) IN ('CLICK', 'PURCHASE', 'VIEW') THEN upper(supply_name) ELSE 'REST' END AS supply,
  lower(req_os) AS os,
  CASE WHEN req_country IN ('USA', 'IND') THEN req_country ELSE 'others' END AS country,
  coalesce(CASE WHEN auction_winner_price < 5 THEN 5.0 WHEN auction_winner_price > 60 THEN 60.0
    ELSE auction_winner_price END, 0.0) AS win_price,
  CASE WHEN auction_winner_price < 5 THEN 5.0 WHEN auction_winner_price > 60 THEN 60.0
    ELSE auction_winner_price END AS clamped
FROM auction_logs""",
    views=("auction_logs",),
)
def _(spark, sf_dir):
    maps = [
        FieldMapping("event_id", "id", "event_id"),
        FieldMapping("supply_name", "supply"),
        FieldMapping("req_os", "os"),
        FieldMapping("req_country", "country"),
        FieldMapping("auction_winner_price", "win_price"),
        FieldMapping("auction_winner_price", "raw_price", "clamped"),
    ]
    return enrich.map_features(view(spark, sf_dir, "auction_logs"), maps, {**FEATURES, "id": Feature()})


@query(
    "contract_report",
    """SELECT 'req_country' AS feature, round(avg(CASE WHEN req_country IS NULL THEN 1.0 ELSE 0.0 END) * 100, 6) AS null_pct,
  count(*) FILTER (WHERE NOT regexp_matches(req_country, '^[A-Z]{2}A$')) AS bad_pattern, CAST(0 AS BIGINT) AS out_of_range,
  CAST(0 AS BIGINT) AS not_allowed, FALSE AS passed FROM auction_logs
UNION ALL SELECT 'auction_winner_price', round(avg(CASE WHEN auction_winner_price IS NULL THEN 1.0 ELSE 0.0 END) * 100, 6),
  CAST(0 AS BIGINT), count(*) FILTER (WHERE auction_winner_price < 0 OR auction_winner_price > 1000), CAST(0 AS BIGINT),
  count(*) FILTER (WHERE auction_winner_price < 0 OR auction_winner_price > 1000) = 0 FROM auction_logs
UNION ALL SELECT 'req_os', 0.0, CAST(0 AS BIGINT), CAST(0 AS BIGINT), count(*) FILTER (WHERE req_os <> 'iOS'), FALSE
FROM auction_logs""",
    views=("auction_logs",),
)
def _(spark, sf_dir):
    rules = {
        "req_country": Feature(regex="^[A-Z]{2}A$", max_null_percentage=5),
        "auction_winner_price": Feature(min_value=0.0, max_value=1000.0, max_null_percentage=10),
        "req_os": Feature(allowed_values=("iOS",), nullable=False),
    }
    report = enrich.contract_report(view(spark, sf_dir, "auction_logs"), rules)
    return report.withColumn("null_pct", F.round("null_pct", 6))


@query(
    "derived_columns",
    """SELECT event_id, value, value * 2 AS doubled, value * 2 + 1 AS next, CASE WHEN value * 2 > 50 THEN 'hi' ELSE 'lo' END
AS level FROM events""",
)
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "value")
    return enrich.derived_columns(
        rows, {"doubled": "value * 2", "next": "doubled + 1", "level": "CASE WHEN doubled > 50 THEN 'hi' ELSE 'lo' END"}
    )


@query(
    "clean_text_features",
    """SELECT event_id, coalesce(nullif(supply_name, ''), '##empty##') AS supply_empty,
  coalesce(nullif(supply_name, ''), 'others') AS supply_others,
  CASE WHEN lower(substr(req_country, 1, 2)) IN ('us', 'in', 'br', 'jp', 'id', 'ru', 'gb', 'fr', 'de', 'mx')
    THEN lower(substr(req_country, 1, 2)) ELSE 'others' END AS country,
  CASE WHEN req_country = 'USA' THEN 'US' ELSE 'OTHER' END AS us_flag,
  CASE WHEN req_impression_type = 'banner' THEN 'banner' WHEN req_impression_type = 'native' THEN 'native' ELSE 'playable'
    END AS impression,
  CASE WHEN supply_name LIKE '%ironsource%' THEN 'ironsource' WHEN supply_name LIKE '%admob%' THEN 'admob'
    WHEN supply_name LIKE '%max%' THEN 'max' ELSE 'others' END AS sdk_supply,
  CASE WHEN is_tpd_winner THEN '1' ELSE '0' END AS winner_flag,
  CASE WHEN auction_winner_price > 0 THEN 1 ELSE 0 END AS has_price,
  CAST(minute(auction_timestamp) AS INT) AS minute_of_hour, lpad(CAST(minute(auction_timestamp) AS VARCHAR), 2, '0') AS minute_text,
  CAST(dayofweek(auction_timestamp) AS INT) AS day_of_week, strftime(auction_timestamp, '%Y-%m-%d %H') AS date_hour,
  CASE WHEN auction_winner_price + 0.5 > 40 THEN 40.0 ELSE auction_winner_price + 0.5 END AS capped_price
FROM auction_logs""",
    views=("auction_logs",),
)
def _(spark, sf_dir):
    two = F.substring("req_country", 1, 2)
    return view(spark, sf_dir, "auction_logs").select(
        "event_id",
        scalar.empty_to("supply_name").alias("supply_empty"),
        scalar.empty_to("supply_name", vocab.OTHERS).alias("supply_others"),
        scalar.top_country(two).alias("country"),
        scalar.us_or(F.when(F.col("req_country") == "USA", "US"), "OTHER").alias("us_flag"),
        scalar.impression_type("req_impression_type").alias("impression"),
        scalar.sdk_supply("supply_name").alias("sdk_supply"),
        scalar.flag_text("is_tpd_winner").alias("winner_flag"),
        scalar.positive("auction_winner_price").alias("has_price"),
        scalar.minute_of_hour("auction_timestamp").alias("minute_of_hour"),
        scalar.minute_text("auction_timestamp").alias("minute_text"),
        scalar.day_of_week("auction_timestamp").alias("day_of_week"),
        scalar.date_hour("auction_timestamp").alias("date_hour"),
        scalar.offset_capped("auction_winner_price", 0.5, 40).alias("capped_price"),
    )


@query(
    "placement_features",
    """SELECT placement_type, CASE coalesce(nullif(placement_type, ''), '##empty##') WHEN 'rewarded' THEN 'video'
    WHEN 'mrec' THEN 'banner' ELSE coalesce(nullif(placement_type, ''), '##empty##') END AS ad_group,
  CASE WHEN placement_type IN ('banner', 'mrec') THEN 'banner' WHEN placement_type = 'native' THEN 'native' ELSE 'playable' END
    AS impression, coalesce(nullif(geo, ''), '##empty##') AS geo_clean, CASE WHEN geo = 'US' THEN 'US' ELSE 'Other' END AS country_group,
  count(*) AS n, CAST(sum(bid_requests - coalesce(multiplied_bid_requests, 0)) AS BIGINT) AS net
FROM project_report GROUP BY 1, 2, 3, 4, 5""",
    views=("project_report",),
)
def _(spark, sf_dir):
    return (
        view(spark, sf_dir, "project_report")
        .select(
            "placement_type",
            scalar.ad_type_group("placement_type").alias("ad_group"),
            scalar.impression_type("placement_type").alias("impression"),
            scalar.empty_to("geo").alias("geo_clean"),
            scalar.us_or("geo", "Other").alias("country_group"),
            scalar.net_requests("bid_requests", "multiplied_bid_requests").alias("net"),
        )
        .groupBy("placement_type", "ad_group", "impression", "geo_clean", "country_group")
        .agg(F.count("*").alias("n"), F.sum("net").alias("net"))
    )


@query(
    "device_features",
    """SELECT p_partkey, CASE WHEN lower(m) IN (MODELS) THEN lower(m) ELSE 'others' END AS model, CASE WHEN lower(p_name) IN ('apple', 'samsung', 'google', 'sony') THEN lower(p_name) ELSE 'others' END AS make,
  CASE WHEN v = '' OR v IS NULL THEN '-1' ELSE string_split_regex(v, '[. ]')[1] END AS major_version,
  CASE WHEN c <> 'US' OR a <> 'video' THEN 'all' WHEN price > 10 THEN 'high' WHEN price > 0 THEN 'low' ELSE 'unknown' END AS value_group,
  CASE p_type WHEN 'rewarded' THEN p_retailprice WHEN 'banner' THEN p_size * 1.0 ELSE 0.0 END AS unified
FROM (SELECT *, CASE p_partkey % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'IN' END AS c,
    CASE WHEN p_partkey % 2 = 0 THEN 'video' ELSE 'banner' END AS a,
    CASE WHEN p_partkey % 5 <> 0 THEN (p_partkey % 30) - 4 END AS price,
    CASE p_partkey % 4 WHEN 0 THEN concat(CAST(p_size AS VARCHAR), '.1.2') WHEN 1 THEN concat(CAST(p_size AS VARCHAR), ' beta')
      WHEN 2 THEN '' END AS v, concat('iPhone', CAST(10 + p_partkey % 8 AS VARCHAR), ',', CAST(1 + p_partkey % 6 AS VARCHAR)) AS m
  FROM part) t""".replace("MODELS", ", ".join(f"'{m}'" for m in vocab.TOP_MODELS)),
)
def _(spark, sf_dir):
    k = F.col("p_partkey")
    size = F.col("p_size").cast("string")
    parts = table(spark, sf_dir, "part").select(
        "*",
        F.when(k % 3 == 0, "US").when(k % 3 == 1, "IN").alias("c"),
        F.when(k % 2 == 0, "video").otherwise("banner").alias("a"),
        F.when(k % 5 != 0, (k % 30) - 4).alias("price"),
        F.when(k % 4 == 0, F.concat(size, F.lit(".1.2")))
        .when(k % 4 == 1, F.concat(size, F.lit(" beta")))
        .when(k % 4 == 2, "")
        .alias("v"),
        F.col("p_size").cast("double").alias("size_value"),
    )
    chosen = {"rewarded": "p_retailprice", "banner": "size_value", "native": "no_such_column"}
    return parts.select(
        "p_partkey",
        scalar.top_make("p_name").alias("make"),
        scalar.top_model(F.concat(F.lit("iPhone"), (10 + k % 8).cast("string"), F.lit(","), (1 + k % 6).cast("string"))).alias("model"),
        scalar.major_version("v").alias("major_version"),
        scalar.device_value_group("c", "a", "price").alias("value_group"),
        scalar.pick_by("p_type", chosen, parts.columns).alias("unified"),
    )


@query(
    "number_text",
    """SELECT l_orderkey, l_linenumber, printf('%.3f', l_extendedprice / 1000 + 0.000012) AS floor_text FROM lineitem""",
)
def _(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", scalar.fixed_decimals(F.col("l_extendedprice") / 1000 + 0.000012).alias("floor_text")
    )


@query(
    "hours_between",
    """SELECT l_orderkey, l_linenumber, (epoch(l_shipdate) - epoch(o_orderdate)) / 3600.0 AS hours,
  CASE WHEN l_shipdate <= o_orderdate THEN 'others' WHEN (epoch(l_shipdate) - epoch(o_orderdate)) / 3600.0 <= 24 THEN '(0,24]'
    WHEN (epoch(l_shipdate) - epoch(o_orderdate)) / 3600.0 <= 72 THEN '(24,72]'
    WHEN (epoch(l_shipdate) - epoch(o_orderdate)) / 3600.0 <= 168 THEN '(72,168]' ELSE '>168' END AS hours_bin
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def _(spark, sf_dir):
    from adlake.functions.binning import hour_gap_bin

    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    hours = scalar.hours_between(scalar.epoch_seconds("l_shipdate"), scalar.epoch_seconds("o_orderdate"))
    joined = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select("l_orderkey", "l_linenumber", hours.alias("hours"), hour_gap_bin(hours).alias("hours_bin"))


@query(
    "country_codes",
    """SELECT CASE req_country WHEN 'USA' THEN 'US' WHEN 'IND' THEN 'IN' ELSE req_country END AS country, count(*) AS n
FROM auction_logs GROUP BY 1""",
    views=("auction_logs",),
)
def _(spark, sf_dir):
    code = scalar.translate_code("req_country", {"USA": "US", "IND": "IN"})
    return view(spark, sf_dir, "auction_logs").groupBy(code.alias("country")).agg(F.count("*").alias("n"))


@query("decoded_payload", "SELECT event_id, CAST(props::JSON->>'k' AS BIGINT) AS k FROM events")
def _(spark, sf_dir):
    packed = table(spark, sf_dir, "events").select("event_id", F.base64(F.col("props").cast("binary")).alias("payload"))
    return packed.select("event_id", scalar.decoded_json("payload", "k bigint")["k"].alias("k"))


@query(
    "feature_keys",
    """SELECT concat_ws('||', coalesce(rtb_id, '__NULL__'), coalesce(placement_type, '__NULL__'), coalesce(geo, '__NULL__')) AS key,
  count(*) AS n, round(CASE WHEN sum(bid_requests) > 0 THEN sum(unr) / sum(bid_requests) ELSE 0.0 END, 8) AS rate
FROM project_report GROUP BY 1""",
    views=("project_report",),
)
def _(spark, sf_dir):
    key = scalar.feature_key(["rtb_id", "placement_type", "geo"])
    sums = view(spark, sf_dir, "project_report").groupBy(key.alias("key")).agg(
        F.count("*").alias("n"), F.sum("bid_requests").alias("req"), F.sum("unr").alias("rev")
    )
    return sums.select("key", "n", F.round(scalar.ratio_or_zero("rev", "req"), 8).alias("rate"))


@query(
    "time_buckets",
    """SELECT date_trunc('minute', ts) AS minute_bucket, date_trunc('hour', ts) AS hour_bucket,
  CAST(date_trunc('day', ts) AS TIMESTAMP) AS day_bucket, strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H') AS hour,
  count(*) AS n FROM events GROUP BY ALL""",
)
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        *[scalar.time_bucket("ts", g).alias(f"{g}_bucket") for g in ("minute", "hour", "day")],
        scalar.date_text("ts").alias("date"),
        scalar.hour_text("ts").alias("hour"),
    )
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))


@query(
    "token_hash_md5",
    """SELECT doc_id, CAST('0x' || substr(md5(lang), 1, 15) AS BIGINT) AS lang_token, CAST('0x' || substr(md5(source), 1, 15) AS BIGINT) AS source_token,
  n_chars AS length_token FROM documents""",
)
def _(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        scalar.token_id("lang", "string", "md5").alias("lang_token"),
        scalar.token_id("source", "string", "md5").alias("source_token"),
        scalar.token_id("n_chars", "bigint").alias("length_token"),
    )


@query("token_hash")
def _(spark, sf_dir):
    """Token numbers of text and of whole numbers; the hash has no DuckDB twin."""
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        scalar.token_id("lang", "string").alias("lang_token"),
        scalar.token_id("source", "string").alias("source_token"),
        scalar.token_id("n_chars", "bigint").alias("length_token"),
    )
