"""Control / explore experiments and traffic caps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.functions.scalar import ColumnLike, as_column, feature_key, ratio_or_zero
from adlake.operators.running import cumulative_share, score_shares
from adlake.session import cut_lineage

PER_BILLION = 1e9
MIN_INCREASE = 1e-3
CAP_RANGE = (1.0, 3.0)


def prepare_experiment(
    df: DataFrame,
    features: Sequence[str],
    control: str,
    explore: Sequence[str],
    bucket: str = "exp_bucket",
    requests: str = "bid_requests",
    multiplied: str | None = "multiplied_bid_requests",
    revenue: str = "unr",
) -> DataFrame:
    """Net requests, revenue and revenue per 1e9 net requests by (features, is_control).

    With ``multiplied`` given, net requests are derived and rows without net requests are dropped; without it
    ``requests`` already are net and a rate without requests is NULL.
    """
    rows = df.where(F.col(bucket).isin(control, *explore))
    sums = [F.sum(requests).alias("_req"), F.sum(revenue).alias("revenue")]
    if multiplied is not None:
        sums.append(F.coalesce(F.sum(multiplied), F.lit(0)).alias("_mult"))
    grouped = rows.groupBy(*features, (F.col(bucket) == control).alias("is_control")).agg(*sums)
    net = F.col("_req") if multiplied is None else F.col("_req") - F.col("_mult")
    out = grouped.select(*features, "is_control", net.alias("net_requests"), "revenue")
    if multiplied is not None:
        out = out.where(F.col("net_requests") > 0)
    return out.withColumn(
        "rate", F.try_divide(F.col("revenue") * F.lit(PER_BILLION), F.col("net_requests"))
    )


def paired_rates(
    df: DataFrame,
    features: Sequence[str],
    control: str,
    explore: Sequence[str],
    bucket: str = "exp_bucket",
    requests: str = "bid_requests",
    multiplied: str = "multiplied_bid_requests",
    revenue: str = "unr",
) -> DataFrame:
    """Both arms of every feature combination side by side: net requests and rates, for combinations with net requests
    in both arms.

    One conditional aggregation stands in for two aggregations and their inner join. As in that join, a NULL feature
    matches nothing, so such rows are dropped before the shuffle.
    """
    known = reduce(lambda a, b: a & b, [F.col(f).isNotNull() for f in features])
    arms = {"control": F.col(bucket) == control, "explore": F.col(bucket).isin(*explore)}
    sums = []
    for arm, test in arms.items():
        sums += [
            (
                F.sum(F.when(test, F.col(requests))) - F.coalesce(F.sum(F.when(test, F.col(multiplied))), F.lit(0))
            ).alias(f"{arm}_requests"),
            F.sum(F.when(test, F.col(revenue))).alias(f"{arm}_revenue"),
        ]
    both = df.where(known & F.col(bucket).isin(control, *explore)).groupBy(*features).agg(*sums)
    both = both.where((F.col("control_requests") > 0) & (F.col("explore_requests") > 0))
    for arm in arms:
        rate = F.col(f"{arm}_revenue") * F.lit(PER_BILLION) / F.col(f"{arm}_requests")
        both = both.withColumn(f"{arm}_rate", rate)
    return both


def uplift_dataset(paired: DataFrame, features: Sequence[str]) -> DataFrame:
    """(features, y, weight): explore rate minus control rate, weighted by explore requests."""
    return paired.select(
        *features,
        (F.col("explore_rate") - F.col("control_rate")).alias("y"),
        F.col("explore_requests").cast("double").alias("weight"),
    )


def uplift_ratio(
    df: DataFrame, features: Sequence[str], bucket: str, control: str, explore: Sequence[str], metric: str
) -> DataFrame:
    """(Σexplore − Σcontrol) / Σcontrol per feature combination; 0.0 where control is NULL or 0."""
    c = F.sum(F.when(F.col(bucket) == control, F.col(metric)))
    e = F.coalesce(F.sum(F.when(F.col(bucket).isin(*explore), F.col(metric))), F.lit(0))
    ratio = F.when(c.isNull() | (c == 0), F.lit(0.0)).otherwise(F.try_divide(e - c, c))
    rows = df.where(F.col(bucket).isin(control, *explore))
    return rows.groupBy(*features).agg(ratio.alias(f"{metric}_uplift_ratio"))


# Traffic caps --------------------------------------------------------------------------------


def cap_target(cap: ColumnLike, multiplier: float, divisor: float | None = None) -> Column:
    """Share of traffic to treat under a cap; NULL when the increase is too small to matter."""
    increase = as_column(cap) - F.lit(1.0)
    share = increase / F.lit(float(multiplier - 1 if divisor is None else divisor))
    return F.when(increase >= F.lit(MIN_INCREASE), share)


def account_caps(accounts: DataFrame, caps: DataFrame, account: str, multiplier: float) -> DataFrame:
    """Per-account caps from a text table: missing or unreadable caps are 1.0, the rest kept in [1, 3]."""
    low, high = CAP_RANGE
    read = caps.select(F.col(account), F.expr("try_cast(cap AS double)").alias("cap"))
    joined = accounts.select(account).distinct().join(read, account, "left")
    cap = F.coalesce("cap", F.lit(1.0))
    cap = F.when(cap > high, F.lit(high)).when(cap < low, F.lit(low)).otherwise(cap)
    targets = joined.select(account, cap.alias("cap"))
    return targets.withColumn("target_pct", cap_target("cap", multiplier)).where(F.col("target_pct").isNotNull())


def cap_thresholds(
    scored: DataFrame,
    account: str,
    caps: Sequence[float],
    multiplier: float,
    score: str = "y",
    weight: str = "weight",
) -> DataFrame:
    """Per account and cap (columns ``t0``, ``t1`` …): the lowest score whose cumulative share is within the target.

    All caps come out of one aggregation; nothing is repeated per cap.
    """
    shares = score_shares(scored, [account], score, weight)
    cells = []
    for i, cap in enumerate(caps):
        inside = F.col("percentile") <= cap_target(F.lit(float(cap)), multiplier)
        cells.append(F.min(F.when(inside, F.col(score))).alias(f"t{i}"))
    return shares.groupBy(account).agg(*cells)


def long_thresholds(thresholds: DataFrame, account: str, caps: Sequence[float]) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(float(c)).alias("cap"), F.col(f"t{i}").alias("threshold")) for i, c in enumerate(caps)])
    rows = thresholds.select(account, F.explode(cells).alias("r")).select(account, "r.*")
    return rows.where(F.col("threshold").isNotNull())


def evaluate_caps(
    paired: DataFrame, thresholds: DataFrame, account: str, caps: Sequence[float], multiplier: float
) -> DataFrame:
    """Traffic and revenue uplift of every cap: rows at or above the account's threshold are treated.

    Every cap is a set of conditional sums in one aggregation over ``paired`` (no row is repeated per cap). Accounts
    without a treated row do not show for that cap.
    """
    rows = paired.select(
        account,
        (F.col("control_requests") + F.col("explore_requests")).alias("br"),
        F.col("control_rate"),
        (F.col("explore_rate") - F.col("control_rate")).alias("uplift"),
    )
    joined = rows.join(thresholds, account)
    sums = [F.sum("br").alias("all_br"), F.sum(F.col("control_rate") * F.col("br")).alias("control_sum")]
    for i in range(len(caps)):
        treated = F.col("uplift") >= F.col(f"t{i}")
        sums += [
            F.sum(F.when(treated, F.col("br"))).alias(f"br{i}"),
            F.sum(F.when(treated, F.col("uplift") * F.col("br"))).alias(f"gain{i}"),
        ]
    wide = joined.groupBy(account).agg(*sums)
    cells = F.array(
        *[
            F.struct(
                F.lit(float(c)).alias("cap"), F.col(f"br{i}").alias("treated_br"), F.col(f"gain{i}").alias("gain")
            )
            for i, c in enumerate(caps)
        ]
    )
    long = wide.select(account, "all_br", "control_sum", F.explode(cells).alias("r")).where("r.treated_br is not null")
    return long.select(
        account,
        F.col("r.cap").alias("cap"),
        (ratio_or_zero(F.col("r.treated_br"), "all_br") * F.lit(float(multiplier - 1))).alias("qps_uplift"),
        ratio_or_zero(F.col("r.gain"), "control_sum").alias("unr_uplift"),
        F.col("all_br").alias("total_br_all"),
        F.col("r.treated_br").alias("total_br_treated"),
    )


def premium_segments(
    scored: DataFrame,
    account: str,
    entity: Sequence[str],
    segment: Sequence[str],
    targets: float | DataFrame,
    score: str = "y",
    weight: str = "weight",
) -> DataFrame:
    """Distinct (entity, segment) rows of the rows within the account's target share.

    ``targets`` is one share for all accounts or a frame (account, target_pct). Sets stay in long form: an entity with
    very many segments is spread over tasks.
    """
    ranked = cumulative_share(scored, [account], score, weight)
    if isinstance(targets, DataFrame):
        ranked = ranked.join(targets.select(account, "target_pct"), account)
        inside = ranked.where(F.col("percentile") <= F.col("target_pct"))
    else:
        inside = ranked.where(F.col("percentile") <= F.lit(float(targets)))
    return inside.select(*entity, feature_key(segment).alias("segment")).distinct()


def cap_curves(results: Mapping[str, DataFrame], account: str) -> DataFrame:
    """Uplift curves of several result sets, with a zero baseline at cap 1.0 for every account."""
    frames = []
    for source, frame in results.items():
        curve = cut_lineage(frame.select(account, "cap", "unr_uplift"))  # a few caps per account, read twice
        start = curve.select(account).distinct().select(account, F.lit(1.0).alias("cap"), F.lit(0.0).alias("unr_uplift"))
        frames.append(start.unionByName(curve).withColumn("source", F.lit(source)))
    return reduce(lambda a, b: a.unionByName(b), frames)
