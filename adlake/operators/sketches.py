"""Mergeable states: quantiles and distinct counts that are kept per bucket and rolled up without the rows.

A state is a small binary per (bucket, group): KLL for quantiles, HyperLogLog for distinct counts, theta where sets are also intersected or
subtracted. Hourly states unite to daily and weekly ones, and days can be recombined in any range. All of it are aggregates that Spark
combines before the shuffle, in batch and in a stream alike. States are approximate with a bound; below it they are exact.
Distinct counts of whole numbers that must be exact at any size are kept as bitmaps (`bitmaps`), one per run of 32,768 numbers.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KLL_SIZE = 400  # a rank is off by about 0.7 % at most, with 99 % confidence; exact up to this many values
HLL_LOG = 14  # about 0.8 % standard error
THETA_LOG = 14  # exact up to 16,384 values, then about 0.8 %


@dataclass(frozen=True)
class State:
    """One kept state: ``kind`` is quantiles, distinct or theta; ``name`` the column of the state."""

    name: str
    column: str
    kind: str

    def first(self) -> Column:
        """The state of rows. NULL adds nothing; NaN is left out of quantiles."""
        c = F.col(self.column)
        if self.kind == "quantiles":
            value = c.cast("double")
            return F.kll_sketch_agg_double(F.when(~F.isnan(value), value), F.lit(KLL_SIZE)).alias(self.name)
        text = c.cast("string")  # one form for all types, so that states of different sources unite
        if self.kind == "distinct":
            return F.hll_sketch_agg(text, F.lit(HLL_LOG)).alias(self.name)
        if self.kind == "theta":
            return F.theta_sketch_agg(text, F.lit(THETA_LOG)).alias(self.name)
        raise ValueError(f"unknown state {self.kind!r}")

    def union(self) -> Column:
        """The state of states."""
        c = F.col(self.name)
        merged = {
            "quantiles": lambda: F.kll_merge_agg_double(c, F.lit(KLL_SIZE)), "distinct": lambda: F.hll_union_agg(c),
            "theta": lambda: F.theta_union_agg(c, F.lit(THETA_LOG)),
        }
        return merged[self.kind]().alias(self.name)


def states(df: DataFrame, by: Sequence[str], kept: Sequence[State]) -> DataFrame:
    """One row per group with ``rows`` and every state."""
    return df.groupBy(*by).agg(F.count("*").alias("rows"), *[s.first() for s in kept])


def roll_up(kept_states: DataFrame, by: Sequence[str], kept: Sequence[State], bucket: str | None = None, width: str = "day") -> DataFrame:
    """States of coarser groups; ``bucket`` names a time column that is cut to ``width`` first and stays a key."""
    rows = kept_states
    if bucket is not None:
        rows = rows.withColumn(bucket, F.date_trunc(width, bucket).cast("timestamp_ntz"))
    keys = [*([bucket] if bucket is not None else []), *[k for k in by if k != bucket]]
    return rows.groupBy(*keys).agg(F.sum("rows").alias("rows"), *[s.union() for s in kept])


def quantile(state: str | Column, rank: float) -> Column:
    """The value at ``rank``; NULL for a state without values."""
    c = F.col(state) if isinstance(state, str) else state
    return F.when(F.kll_sketch_get_n_double(c) > 0, F.kll_sketch_get_quantile_double(c, F.lit(float(rank))))


def rank_of(state: str | Column, value: Column) -> Column:
    """Share of values at or below ``value``; NULL for a state without values."""
    c = F.col(state) if isinstance(state, str) else state
    return F.when(F.kll_sketch_get_n_double(c) > 0, F.kll_sketch_get_rank_double(c, value))


def distinct_estimate(state: str | Column, kind: str = "distinct") -> Column:
    c = F.col(state) if isinstance(state, str) else state
    return F.hll_sketch_estimate(c) if kind == "distinct" else F.theta_sketch_estimate(c)


def bitmaps(df: DataFrame, by: Sequence[str], column: str) -> DataFrame:
    """(by…, slot, rows, bits): which values of an integer column occur, one bitmap per group and run of 32,768 numbers. NULL only counts as a row."""
    value = F.col(column).cast("bigint")
    keyed = df.select(*by, F.bitmap_bucket_number(value).alias("slot"), F.bitmap_bit_position(value).alias("_bit"))
    return keyed.groupBy(*by, "slot").agg(F.count("*").alias("rows"), F.bitmap_construct_agg("_bit").alias("bits"))


def roll_up_bitmaps(kept_bitmaps: DataFrame, by: Sequence[str], bucket: str | None = None, width: str = "day") -> DataFrame:
    """Bitmaps of coarser groups, like :func:`roll_up`."""
    rows = kept_bitmaps
    if bucket is not None:
        rows = rows.withColumn(bucket, F.date_trunc(width, bucket).cast("timestamp_ntz"))
    keys = [*([bucket] if bucket is not None else []), *[k for k in by if k != bucket]]
    return rows.groupBy(*keys, "slot").agg(F.sum("rows").alias("rows"), F.bitmap_or_agg("bits").alias("bits"))


def bitmap_counts(kept_bitmaps: DataFrame, by: Sequence[str], output: str = "distinct") -> DataFrame:
    """(by…, rows, output): the exact number of distinct values per group."""
    return kept_bitmaps.groupBy(*by).agg(F.sum("rows").alias("rows"), F.sum(F.bitmap_count("bits")).alias(output))


def robust_stats_of(kept_states: DataFrame, by: Sequence[str], state: str, spread: tuple[float, float] = (0.25, 0.75)) -> DataFrame:
    """(by…, median, iqr) from states, over any range of buckets."""
    merged = kept_states.groupBy(*by).agg(F.kll_merge_agg_double(state).alias("_s"))
    return merged.select(*by, quantile("_s", 0.5).alias("median"), (quantile("_s", spread[1]) - quantile("_s", spread[0])).alias("iqr"))


def thresholds_of(kept_states: DataFrame, by: Sequence[str], state: str, column: str, n_buckets: int = 3, skew: float = 3.0) -> DataFrame:
    """Bucket thresholds at (i/n)^skew from states of positive values, in the columns that ``quantile_buckets`` reads."""
    merged = kept_states.groupBy(*by).agg(F.kll_merge_agg_double(state).alias("_s"))
    cells = [quantile("_s", (i / n_buckets) ** skew).alias(f"{column}_threshold_{i}") for i in range(1, n_buckets)]
    return merged.select(*by, *cells)


def compared(kept_states: DataFrame, bucket: str, by: Sequence[str], state: str, pairs: DataFrame) -> DataFrame:
    """(bucket_a, bucket_b, by…, both, only_a, only_b) from theta states of two buckets, for given pairs of buckets.

    ``pairs`` has the columns bucket_a and bucket_b, whose types are that of ``bucket``.
    """
    a = kept_states.select(F.col(bucket).alias("bucket_a"), *by, F.col(state).alias("_a"))
    b = kept_states.select(F.col(bucket).alias("_bucket_b"), *[F.col(k).alias(f"_{k}") for k in by], F.col(state).alias("_b"))
    met = F.col("bucket_b") == F.col("_bucket_b")
    for k in by:
        met = met & F.col(k).eqNullSafe(F.col(f"_{k}"))
    both = pairs.join(a, "bucket_a").join(b, met)

    def count(state: Column) -> Column:
        return F.theta_sketch_estimate(state)

    return both.select(
        "bucket_a", "bucket_b", *by, count(F.theta_intersection("_a", "_b")).alias("both"),
        count(F.theta_difference("_a", "_b")).alias("only_a"), count(F.theta_difference("_b", "_a")).alias("only_b"),
    )


def stream_states(
    stream: DataFrame, by: Sequence[str], kept: Sequence[State], time_column: str, width: str = "1 hour", lateness: str = "1 hour"
) -> DataFrame:
    """States per (time bucket, group) over a stream: distinct counts and quantiles that the exact streaming form has no bounded state for.

    A bucket is final once the watermark has passed its end. Its states unite with those of the batch form.
    """
    timed = stream.withColumn("_ts", F.col(time_column).cast("timestamp")).withWatermark("_ts", lateness)
    out = timed.groupBy(F.window("_ts", width).alias("_w"), *by).agg(F.count("*").alias("rows"), *[s.first() for s in kept])
    return out.select(F.col("_w.start").cast("timestamp_ntz").alias("time_bucket"), *by, "rows", *[s.name for s in kept])

