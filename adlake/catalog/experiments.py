"""Experiment uplift and traffic caps over the project report."""

from __future__ import annotations

from pyspark.sql import functions as F

from adlake.catalog.registry import query, view
from adlake.operators import experiment
from adlake.operators.running import cumulative_share, share_of_group

CONTROL, EXPLORE = "project_v1_control", ["48", "49"]
ACCOUNT = "rtb_account_id"
FEATURES = ["rtb_id", "geo", "platform", "placement_type", "supply_name", ACCOUNT]
CAPS = [1.0, 1.1, 1.2, 1.3, 1.4, 1.5, 1.6, 1.7, 1.8, 1.9, 2.0]
MULTIPLIER = 3.0
TRAIN = "dt < DATE '2025-11-27'"
TEST = "dt >= DATE '2025-11-27'"
_F = ", ".join(FEATURES)


def _pairs_sql(name: str, where: str) -> str:
    """Both arms per feature combination, in SQL."""
    return f"""arm_{name} AS (SELECT {_F}, exp_bucket = '{CONTROL}' AS is_control, sum(bid_requests) - coalesce(sum(multiplied_bid_requests), 0) AS br,
  sum(unr) AS rev FROM project_report WHERE {where} GROUP BY ALL HAVING sum(bid_requests) - coalesce(sum(multiplied_bid_requests), 0) > 0),
{name} AS (SELECT {_F}, c.br AS cbr, e.br AS ebr, c.rev * 1e9 / c.br AS crate, e.rev * 1e9 / e.br AS erate,
  e.rev * 1e9 / e.br - c.rev * 1e9 / c.br AS y
  FROM (SELECT * FROM arm_{name} WHERE is_control) c JOIN (SELECT * FROM arm_{name} WHERE NOT is_control) e USING ({_F}))"""


_TRAIN_SQL, _TEST_SQL = _pairs_sql("train", TRAIN), _pairs_sql("test", TEST)

# ties in score share the cumulative weight: RANGE frame
_CUM = f"""cum AS (SELECT *, sum(ebr) OVER (PARTITION BY {ACCOUNT} ORDER BY y DESC) / sum(ebr) OVER (PARTITION BY {ACCOUNT}) AS pct FROM train)"""
_CAPS_SQL = f"""caps AS (SELECT CAST(c AS DOUBLE) AS cap, (CAST(c AS DOUBLE) - 1.0) / {MULTIPLIER - 1} AS target FROM (VALUES {", ".join(f"({c})" for c in CAPS)}) AS t(c)
  WHERE CAST(c AS DOUBLE) - 1.0 >= 1e-3)"""
_THRESHOLDS = f"""thr AS (SELECT {ACCOUNT}, cap, min(y) AS threshold FROM cum JOIN caps ON pct <= target GROUP BY 1, 2)"""


def paired(spark, sf_dir, where):
    rows = view(spark, sf_dir, "project_report").where(where)
    return experiment.paired_rates(rows, FEATURES, CONTROL, EXPLORE)


def scored(spark, sf_dir):
    return experiment.uplift_dataset(paired(spark, sf_dir, TRAIN), FEATURES)


@query(
    "prepare_experiment",
    f"""SELECT rtb_id, geo, placement_type, exp_bucket = '{CONTROL}' AS is_control,
  CAST(sum(bid_requests) - coalesce(sum(multiplied_bid_requests), 0) AS BIGINT) AS net_requests, round(sum(unr), 4) AS revenue,
  round(sum(unr) * 1e9 / (sum(bid_requests) - coalesce(sum(multiplied_bid_requests), 0)), 0) AS rate
FROM project_report GROUP BY ALL HAVING sum(bid_requests) - coalesce(sum(multiplied_bid_requests), 0) > 0""",
    views=("project_report",),
)
def _(spark, sf_dir):
    out = experiment.prepare_experiment(
        view(spark, sf_dir, "project_report"), ["rtb_id", "geo", "placement_type"], CONTROL, EXPLORE
    )
    return out.withColumns({"revenue": F.round("revenue", 4), "rate": F.round("rate", 0)})


@query(
    "uplift_dataset",
    f"WITH {_TRAIN_SQL} SELECT {_F}, round(y, 0) AS y, CAST(ebr AS DOUBLE) AS weight FROM train",
    views=("project_report",),
)
def _(spark, sf_dir):
    return scored(spark, sf_dir).withColumn("y", F.round("y", 0))


@query(
    "uplift_ratio",
    f"""SELECT rtb_id, geo, round(CASE WHEN c IS NULL OR c = 0 THEN 0.0 ELSE (coalesce(e, 0) - c) / c END, 8) AS unr_uplift_ratio
FROM (SELECT rtb_id, geo, sum(unr) FILTER (WHERE exp_bucket = '{CONTROL}') AS c, sum(unr) FILTER (WHERE exp_bucket <> '{CONTROL}') AS e
  FROM project_report GROUP BY 1, 2) t""",
    views=("project_report",),
)
def _(spark, sf_dir):
    rows = view(spark, sf_dir, "project_report")
    out = experiment.uplift_ratio(rows, ["rtb_id", "geo"], "exp_bucket", CONTROL, EXPLORE, "unr")
    return out.withColumn("unr_uplift_ratio", F.round("unr_uplift_ratio", 8))


@query(
    "cap_targets",
    f"""WITH a AS (SELECT DISTINCT {ACCOUNT} FROM project_report), c AS (SELECT * FROM (VALUES ('acc_0', '1.4'), ('acc_1', '9'),
  ('acc_2', 'n/a'), ('acc_3', '0.2')) AS t({ACCOUNT}, cap)),
f AS (SELECT a.{ACCOUNT}, least(greatest(coalesce(TRY_CAST(cap AS DOUBLE), 1.0), 1.0), 3.0) AS cap FROM a LEFT JOIN c USING ({ACCOUNT}))
SELECT {ACCOUNT}, cap, (cap - 1.0) / {MULTIPLIER - 1} AS target_pct FROM f WHERE cap - 1.0 >= 1e-3""",
    views=("project_report",),
)
def _(spark, sf_dir):
    """Accounts of the report against a caps list read as text."""
    rows = [("acc_0", "1.4"), ("acc_1", "9"), ("acc_2", "n/a"), ("acc_3", "0.2")]
    caps = spark.createDataFrame(rows, f"{ACCOUNT} string, cap string")
    return experiment.account_caps(view(spark, sf_dir, "project_report"), caps, ACCOUNT, MULTIPLIER)


@query(
    "cumulative_share",
    f"WITH {_TRAIN_SQL}, {_CUM} SELECT {_F}, CAST(ebr AS DOUBLE) AS weight, round(pct, 8) AS percentile FROM cum",
    views=("project_report",),
)
def _(spark, sf_dir):
    out = cumulative_share(scored(spark, sf_dir), [ACCOUNT], "y", "weight")
    return out.withColumn("percentile", F.round("percentile", 8)).drop("y")


@query(
    "share_of_account",
    f"""SELECT {ACCOUNT}, rtb_id, geo, round(s / sum(s) OVER (PARTITION BY {ACCOUNT}), 8) AS share FROM
(SELECT {ACCOUNT}, rtb_id, geo, sum(unr) AS s FROM project_report GROUP BY 1, 2, 3) t""",
    views=("project_report",),
)
def _(spark, sf_dir):
    sums = view(spark, sf_dir, "project_report").groupBy(ACCOUNT, "rtb_id", "geo").agg(F.sum("unr").alias("s"))
    out = share_of_group(sums, [ACCOUNT], "s", "share")
    return out.select(ACCOUNT, "rtb_id", "geo", F.round("share", 8).alias("share"))


@query(
    "cap_thresholds",
    f"WITH {_TRAIN_SQL}, {_CUM}, {_CAPS_SQL}, {_THRESHOLDS} SELECT {ACCOUNT}, cap, round(threshold, 0) AS threshold FROM thr",
    views=("project_report",),
)
def _(spark, sf_dir):
    wide = experiment.cap_thresholds(scored(spark, sf_dir), ACCOUNT, CAPS, MULTIPLIER)
    long = experiment.long_thresholds(wide, ACCOUNT, CAPS)
    return long.withColumn("threshold", F.round("threshold", 0))


_SWEEP = f"""sweep AS (SELECT {ACCOUNT}, cap, sum(cbr + ebr) AS all_br, sum(crate * (cbr + ebr)) AS csum,
  sum(cbr + ebr) FILTER (WHERE y >= threshold) AS tbr, sum(y * (cbr + ebr)) FILTER (WHERE y >= threshold) AS gain
  FROM test JOIN thr USING ({ACCOUNT}) GROUP BY 1, 2)"""


def _sweep(spark, sf_dir):
    thresholds = experiment.cap_thresholds(scored(spark, sf_dir), ACCOUNT, CAPS, MULTIPLIER)
    return experiment.evaluate_caps(paired(spark, sf_dir, TEST), thresholds, ACCOUNT, CAPS, MULTIPLIER)


@query(
    "cap_sweep",
    f"""WITH {_TRAIN_SQL}, {_TEST_SQL}, {_CUM}, {_CAPS_SQL}, {_THRESHOLDS}, {_SWEEP}
SELECT {ACCOUNT}, cap, round(tbr / all_br * {MULTIPLIER - 1}, 8) AS qps_uplift,
  round(CASE WHEN csum > 0 THEN gain / csum ELSE 0.0 END, 8) AS unr_uplift, CAST(all_br AS BIGINT) AS total_br_all, CAST(tbr AS BIGINT) AS total_br_treated
FROM sweep WHERE tbr IS NOT NULL""",
    views=("project_report",),
)
def _(spark, sf_dir):
    """Every cap in one job: thresholds from the training days, uplift on the test days."""
    out = _sweep(spark, sf_dir)
    return out.withColumns({"qps_uplift": F.round("qps_uplift", 8), "unr_uplift": F.round("unr_uplift", 8)})


@query(
    "cap_curves",
    f"""WITH {_TRAIN_SQL}, {_TEST_SQL}, {_CUM}, {_CAPS_SQL}, {_THRESHOLDS}, {_SWEEP},
r AS (SELECT {ACCOUNT}, cap, CASE WHEN csum > 0 THEN gain / csum ELSE 0.0 END AS u FROM sweep WHERE tbr IS NOT NULL)
SELECT {ACCOUNT}, cap, round(u, 8) AS unr_uplift, 'ground_truth' AS source FROM r
UNION ALL SELECT DISTINCT {ACCOUNT}, 1.0, 0.0, 'ground_truth' FROM r
UNION ALL SELECT {ACCOUNT}, cap, round(u / 2, 8), 'model' FROM r UNION ALL SELECT DISTINCT {ACCOUNT}, 1.0, 0.0, 'model' FROM r""",
    views=("project_report",),
)
def _(spark, sf_dir):
    truth = _sweep(spark, sf_dir)
    model = truth.withColumn("unr_uplift", F.col("unr_uplift") / 2)
    curves = experiment.cap_curves({"ground_truth": truth, "model": model}, ACCOUNT)
    return curves.withColumn("unr_uplift", F.round("unr_uplift", 8))


@query(
    "premium_segments",
    f"""WITH {_TRAIN_SQL}, {_CUM} SELECT DISTINCT rtb_id, concat_ws('||', geo, platform, placement_type, supply_name) AS segment FROM cum
WHERE pct <= 0.4""",
    views=("project_report",),
)
def _(spark, sf_dir):
    segment = ["geo", "platform", "placement_type", "supply_name"]
    return experiment.premium_segments(scored(spark, sf_dir), ACCOUNT, ["rtb_id"], segment, 0.4)


@query(
    "premium_by_account_cap",
    f"""WITH {_TRAIN_SQL}, {_CUM}, c AS (SELECT * FROM (VALUES ('acc_0', 0.2), ('acc_1', 1.0), ('acc_4', 0.05)) AS t({ACCOUNT}, target))
SELECT DISTINCT {ACCOUNT}, rtb_id, concat_ws('||', geo, platform, placement_type, supply_name) AS segment FROM cum JOIN c USING ({ACCOUNT}) WHERE pct <= target""",
    views=("project_report",),
)
def _(spark, sf_dir):
    """Each account has a cap, and so a target share, of its own."""
    caps = spark.createDataFrame([("acc_0", "1.4"), ("acc_1", "9"), ("acc_4", "1.1")], f"{ACCOUNT} string, cap string")
    targets = experiment.account_caps(view(spark, sf_dir, "project_report"), caps, ACCOUNT, MULTIPLIER)
    segment = ["geo", "platform", "placement_type", "supply_name"]
    return experiment.premium_segments(scored(spark, sf_dir), ACCOUNT, [ACCOUNT, "rtb_id"], segment, targets)
