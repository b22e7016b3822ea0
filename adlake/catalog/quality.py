"""Comparison of outputs and snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from adlake.catalog.registry import query, table
from adlake.operators import compare

KEYS, METRICS = ["day", "event_type"], ["total", "n"]

_BOTH = """nw AS (SELECT CAST(ts AS DATE) AS day, nullif(event_type, 'error') AS event_type, round(sum(value), 4) AS total, count(*) AS n
  FROM events GROUP BY 1, 2),
od AS (SELECT CAST(ts AS DATE) AS day, nullif(event_type, 'error') AS event_type, round(sum(CASE WHEN event_id % 400 = 0 THEN value + 1 ELSE value END), 4) AS total,
  count(*) AS n FROM events WHERE event_id % 97 <> 0 AND ts >= TIMESTAMP '2024-01-03' GROUP BY 1, 2),
cmp AS (SELECT nw.day, nw.event_type, nw.total AS new_total, od.total AS old_total, nw.total - od.total AS diff_total, nw.n AS new_n, od.n AS old_n, nw.n - od.n AS diff_n
  FROM nw JOIN od ON nw.day = od.day AND nw.event_type IS NOT DISTINCT FROM od.event_type)"""


def _outputs(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("date").alias("day"), F.nullif("event_type", F.lit("error")).alias("event_type"), "value", "ts"
    )
    value = F.when(F.col("event_id") % 400 == 0, F.col("value") + 1).otherwise(F.col("value"))
    old = events.where("event_id % 97 <> 0").where(F.col("ts") >= F.lit("2024-01-03").cast("timestamp_ntz"))
    total, n = F.round(F.sum("value"), 4).alias("total"), F.count("*").alias("n")
    return events.groupBy(*KEYS).agg(total, n), old.withColumn("value", value).groupBy(*KEYS).agg(total, n)


@query(
    "compare_outputs",
    f"""WITH {_BOTH} SELECT day, event_type, new_total, old_total, round(diff_total, 4) AS diff_total,
  round(CASE WHEN old_total <> 0 THEN abs(diff_total) / abs(old_total) * 100 WHEN new_total <> 0 THEN 100.0 ELSE 0.0 END, 6) AS pct_diff_total,
  new_n, old_n, diff_n, round(CASE WHEN old_n <> 0 THEN abs(diff_n) / abs(old_n) * 100 WHEN new_n <> 0 THEN 100.0 ELSE 0.0 END, 6) AS pct_diff_n FROM cmp""",
)
def _(spark, sf_dir):
    out = compare.compare_outputs(*_outputs(spark, sf_dir), KEYS, METRICS)
    return out.withColumns(
        {"diff_total": F.round("diff_total", 4), "pct_diff_total": F.round("pct_diff_total", 6), "pct_diff_n": F.round("pct_diff_n", 6)}
    )


def _summary_sql(m):
    return f"""SELECT '{m}' AS metric, count(*) AS rows, count(*) FILTER (WHERE old_{m} IS NULL) AS missing_old,
  count(*) FILTER (WHERE diff_{m} = 0) AS exact_matches, count(*) FILTER (WHERE abs(diff_{m}) <= 1e-6) AS near_matches,
  round(avg(diff_{m}), 4) AS avg_diff, round(CAST(max(abs(diff_{m})) AS DOUBLE), 4) AS max_abs_diff,
  round(avg(abs(diff_{m}) / abs(old_{m}) * 100), 4) AS avg_pct_diff FROM cmp"""


@query("comparison_summary", f"WITH {_BOTH} " + " UNION ALL ".join(_summary_sql(m) for m in METRICS))
def _(spark, sf_dir):
    out = compare.comparison_summary(compare.compare_outputs(*_outputs(spark, sf_dir), KEYS, METRICS), METRICS)
    return out.withColumns({c: F.round(c, 4) for c in ("avg_diff", "max_abs_diff", "avg_pct_diff")})


@query(
    "worst_mismatches",
    f"""WITH {_BOTH} SELECT day, event_type, round(diff_total, 4) AS diff_total FROM cmp WHERE abs(diff_total) > 1e-6
ORDER BY abs(diff_total) DESC, day, event_type LIMIT 20""",
)
def _(spark, sf_dir):
    compared = compare.compare_outputs(*_outputs(spark, sf_dir), KEYS, METRICS)
    worst = compare.worst_mismatches(compared, "total", KEYS, 20, compare.TOLERANCE)
    return worst.select("day", "event_type", F.round("diff_total", 4).alias("diff_total"))


@query(
    "only_in_new",
    f"""WITH {_BOTH} SELECT day, event_type, total, n FROM nw WHERE NOT EXISTS (SELECT 1 FROM od WHERE od.day = nw.day
AND od.event_type IS NOT DISTINCT FROM nw.event_type)""",
)
def _(spark, sf_dir):
    new, old = _outputs(spark, sf_dir)
    return compare.only_in(new, old, KEYS)


@query("shape_summary", "SELECT count(*) AS rows, CAST(11 AS BIGINT) AS columns FROM lineitem")
def _(spark, sf_dir):
    return compare.shape_summary(table(spark, sf_dir, "lineitem"))


_ROSTER = """b AS (SELECT c_custkey AS name, c_mktsegment AS version FROM customer WHERE c_custkey % 5 <> 0),
a AS (SELECT c_custkey AS name, CASE WHEN c_acctbal > 5000 THEN 'v2' ELSE c_mktsegment END AS version FROM customer WHERE c_custkey % 7 <> 0)"""


def _rosters(spark, sf_dir):
    rows = table(spark, sf_dir, "customer")
    before = rows.where("c_custkey % 5 <> 0").select(F.col("c_custkey").alias("name"), F.col("c_mktsegment").alias("version"))
    changed = F.when(F.col("c_acctbal") > 5000, "v2").otherwise(F.col("c_mktsegment")).alias("version")
    after = rows.where("c_custkey % 7 <> 0").select(F.col("c_custkey").alias("name"), changed)
    return before, after


@query(
    "roster_changes",
    f"""WITH {_ROSTER} SELECT coalesce(b.name, a.name) AS name, CASE WHEN a.name IS NULL THEN 'die' WHEN b.name IS NULL THEN 'born' ELSE 'age' END
AS action, b.version AS old_version, a.version AS new_version FROM b FULL JOIN a ON a.name = b.name""",
)
def _(spark, sf_dir):
    return compare.roster_changes(*_rosters(spark, sf_dir), "name", "version")


@query(
    "snapshot_diff",
    f"""WITH {_ROSTER} SELECT coalesce(b.name, a.name) AS name, CASE WHEN b.name IS NULL THEN 'added' WHEN a.name IS NULL THEN 'removed' ELSE 'modified' END
AS change FROM b FULL JOIN a ON a.name = b.name WHERE a.version IS DISTINCT FROM b.version OR a.name IS NULL OR b.name IS NULL""",
)
def _(spark, sf_dir):
    return compare.snapshot_diff(*_rosters(spark, sf_dir), ["name"])
