"""Bid-log statistics, best rounds and serving logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.operators.running import attach, exact_percentiles, running_sums

DECILES = {f"p{p}": p / 100 for p in range(10, 100, 10)}


def price_percentiles(df: DataFrame, price: str, by: Sequence[str] = ()) -> DataFrame:
    """p10 … p90 with linear interpolation; one row of 0.0 for an empty log without groups."""
    found = exact_percentiles(df, by, price, DECILES).drop("n")
    return found if by else found.fillna(0.0)


def conversion_rate(df: DataFrame, conversion: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(conversion).alias("conversion_rate"), F.count("*").alias("rows"))


def best_round(results: DataFrame, lineage: str, round_column: str, score: str) -> DataFrame:
    """Best earlier round of each lineage; the earlier round wins a tie."""
    pick = F.max(F.struct(F.col(score).alias("s"), (-F.col(round_column)).alias("r")))
    best = results.groupBy(lineage).agg(pick.alias("_b"))
    return best.select(lineage, (-F.col("_b.r")).alias("best_round"), F.col("_b.s").alias(score))


def segment_id(*parts: Column, separator: str = "_") -> Column:
    """Dimensions as one name; a NULL part is left out."""
    return F.concat_ws(separator, *[p.cast("string") for p in parts])


def exact_sum(column: str) -> Column:
    """Σ as a double that does not depend on the order of the rows: values are added as decimals with 18 digits after the point.

    Values from 1e14 on, infinities and NaN are added as doubles, as is everything once the decimal sum overflows.
    """
    value = F.col(column).cast("double")
    exact = value.try_cast("decimal(32,18)")
    summed = F.try_sum(exact).cast("double") + F.coalesce(F.sum(F.when(exact.isNull(), value)), F.lit(0.0))
    return F.coalesce(summed, F.sum(value))


def leaderboard(results: DataFrame, strategy: str, conversions: str, cost: str, bids: str) -> DataFrame:
    """One row per strategy with its totals and rank: most conversions first, then the lower cost, then the name.

    Strategies are summed first; ranks are running counts over ranges of the sums, so their number may be large. Costs are summed exactly,
    so strategies with the same costs in another order tie and go by name.
    """
    totals = results.groupBy(strategy).agg(
        F.sum(conversions).cast("bigint").alias("conversions"), exact_sum(cost).alias("cost"), F.sum(bids).cast("bigint").alias("bids"),
        F.try_divide(exact_sum(cost), F.sum(conversions)).alias("cost_per_conversion"),
    )
    ranked = running_sums(totals.withColumn("_one", F.lit(1)), [], [F.desc("conversions"), F.asc("cost"), F.asc(strategy)], {"rank": "_one"})
    return ranked.drop("_one")


def latency_summary(timings: DataFrame, config: Sequence[str], latency: str, batch: str, elapsed: Column) -> DataFrame:
    """Mean, p99 (sorted[floor(0.99·n)]) and samples per second for every configuration."""
    means = timings.groupBy(*config).agg(
        F.avg(latency).alias("mean_latency"),
        (F.try_divide(F.count("*"), elapsed) * F.max(batch)).alias("throughput"),
        F.count("*").alias("calls"),
    )
    tail = exact_percentiles(timings, config, latency, {"p99_latency": 0.99}, method="index").drop("n")
    return attach(means, tail, list(config))


def best_configuration(summary: DataFrame, config: Sequence[str], by: str = "mean_latency") -> DataFrame:
    best = summary.agg(F.min(F.struct(by, *config)).alias("b"))
    return best.select("b.*")
