"""Query registry and the stand-in views that Spark and DuckDB share word for word."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from adlake.session import prepare_session

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Tables each view reads, and its text. The text must stay valid in both engines.
VIEW_TABLES = {
    "auction_logs": ("events",),
    "project_report": ("lineitem", "orders"),
    "embedding_store": ("embeddings",),
    "bid_log": ("events",),
    "training_rows": ("documents", "labels"),
}

VIEWS = {
    "auction_logs": """
SELECT CAST(event_id AS STRING) AS event_id, ts AS auction_timestamp,
  concat('rtb_', CAST(user_id % 5 AS STRING)) AS rtb_id,
  nullif(event_type, 'error') AS supply_name,
  concat('pub_', CAST(event_id % 4 AS STRING)) AS req_pub_app_store_id,
  CASE event_id % 3 WHEN 0 THEN 'banner' WHEN 1 THEN 'native' ELSE 'playable' END AS req_impression_type,
  CASE user_id % 4 WHEN 0 THEN 'USA' WHEN 1 THEN 'IND' WHEN 2 THEN 'BRA' END AS req_country,
  CASE WHEN event_id % 2 = 0 THEN 'iOS' ELSE 'android' END AS req_os,
  event_type IN ('purchase', 'click') AS is_tpd_winner,
  CASE WHEN event_id % 17 <> 0 THEN value END AS auction_winner_price
FROM events""",
    "project_report": """
SELECT DATE '2025-11-20' + CAST(l_orderkey % 10 AS INT) AS dt,
  CASE l_returnflag WHEN 'N' THEN 'project_v1_control' WHEN 'A' THEN '48' ELSE '49' END AS exp_bucket,
  concat('acc_', CAST(l_suppkey % 5 AS STRING)) AS rtb_account_id,
  concat('rtb_', CAST(l_suppkey % 10 AS STRING)) AS rtb_id,
  concat('pub_', CAST(l_partkey % 10 AS STRING)) AS pub_app_object_id,
  CASE l_linenumber % 4 WHEN 0 THEN 'mrec' WHEN 1 THEN 'banner' WHEN 2 THEN 'rewarded' END AS placement_type,
  CASE WHEN o_custkey % 2 = 0 THEN 'iOS' ELSE 'android' END AS platform,
  CASE l_partkey % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'IN' ELSE '' END AS geo,
  o_orderpriority AS supply_name,
  CAST(l_quantity AS BIGINT) * 10 AS bid_requests,
  CASE WHEN l_linenumber <> 7 THEN CAST(l_quantity AS BIGINT) END AS multiplied_bid_requests,
  l_extendedprice * (1 - l_discount) / 1000 AS unr
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "embedding_store": """
SELECT vec_id AS token_id, embedding, CAST(label + 1 AS DOUBLE) AS update_count FROM embeddings""",
    "bid_log": """
SELECT event_id, ts, concat_ws('_', CASE WHEN event_id % 2 = 0 THEN 'iOS' ELSE 'Android' END,
  CASE user_id % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'EU' ELSE 'APAC' END) AS segment_id,
  value AS winner_price, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS is_conversion FROM events""",
    "training_rows": """
SELECT d.doc_id, d.lang, d.source, CAST(d.n_chars AS DOUBLE) AS n_chars, l.quality AS label
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
}


def query(name: str, oracle: str | None = None, views: tuple[str, ...] = (), recursive: bool = False):
    """Register a query; ``views`` names the stand-in views its oracle text reads."""

    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare_session(spark), sf_dir)

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = with_views(oracle, *views, recursive=recursive)
        return fn

    return wrap


def with_views(sql: str, *views: str, recursive: bool = False) -> str:
    """Prefix ``sql`` with the named views as common table expressions."""
    if not views:
        return sql.strip()
    ctes = ",\n".join(f"{v} AS ({VIEWS[v].strip()})" for v in views)
    text = sql.strip()
    start = "WITH RECURSIVE" if recursive else "WITH"
    if text[:4].upper() == "WITH":
        return f"{start} {ctes},\n{text[4:].lstrip()}"
    return f"{start} {ctes}\n{text}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the stand-in views, as a lazy DataFrame."""
    sources = {t: table(spark, sf_dir, t) for t in VIEW_TABLES[name]}
    text = VIEWS[name]
    for source in sources:
        text = text.replace(f"FROM {source}", f"FROM {{{source}}}").replace(f"JOIN {source}", f"JOIN {{{source}}}")
    return spark.sql(text, **sources)
