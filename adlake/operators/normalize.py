"""Per-group thresholds, robust normalisation and histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.functions.binning import label_bins, numbered_labels
from adlake.operators.running import exact_percentiles

MIN_IQR = 0.001
APPROX_ACCURACY = 10_000


def weighted_threshold(df: DataFrame, column: str, weight: str) -> DataFrame:
    """Σ(x·w)/Σw as one row, 0 without weight."""
    total = F.sum(weight)
    mean = F.try_divide(F.coalesce(F.sum(F.col(column) * F.col(weight)), F.lit(0.0)), total)
    return df.agg(F.when(total > 0, mean).otherwise(F.lit(0.0)).alias("threshold"))


def split_at_threshold(df: DataFrame, column: str, threshold: float | DataFrame, output: str | None = None) -> DataFrame:
    """Below (inclusive) / above a threshold; NULL and non-positive values are empty."""
    bound = threshold.scalar() if isinstance(threshold, DataFrame) else F.lit(threshold)
    labels = ["below_threshold", "above_threshold"]
    return df.withColumn(output or f"{column}_bin", label_bins(column, [bound], labels))


def _quantiles(df: DataFrame, groups: Sequence[str], column: str, probs: Sequence[float], exact: bool) -> DataFrame:
    """Columns q0, q1 … and n. The approximate form keeps a bounded sketch per group."""
    if exact:
        return exact_percentiles(df, groups, column, {f"q{i}": p for i, p in enumerate(probs)}, method="lower")
    sketch = F.percentile_approx(column, list(probs), APPROX_ACCURACY)
    grouped = df.groupBy(*groups).agg(sketch.alias("_q"), F.count(column).alias("n"))
    return grouped.select(*groups, *[F.col("_q")[i].alias(f"q{i}") for i in range(len(probs))], "n")


def robust_stats(df: DataFrame, column: str, groups: Sequence[str], exact: bool = True) -> DataFrame:
    """Median and IQR of log1p(x) over positive x, by group. The IQR is at least 0.001."""
    logs = df.where(F.col(column) > 0).select(*groups, F.log1p(column).alias("_log"))
    q = _quantiles(logs, groups, "_log", [0.25, 0.5, 0.75], exact)
    iqr = F.col("q2") - F.col("q0")
    return q.select(
        *groups,
        F.col("n").alias(f"{column}_norm_count"),
        F.col("q1").alias(f"{column}_log_median"),
        F.when(iqr < MIN_IQR, F.lit(MIN_IQR)).otherwise(iqr).alias(f"{column}_log_iqr"),
    )


def robust_normalise(
    df: DataFrame, stats: DataFrame, column: str, groups: Sequence[str], output: str | None = None
) -> DataFrame:
    """(log1p(x) - median) / IQR of the row's group; 0.0 for NULL, non-positive x or a group without stats."""
    median, iqr = F.col(f"{column}_log_median"), F.col(f"{column}_log_iqr")
    value = F.col(column)
    scaled = F.when(value.isNull() | (value <= 0) | median.isNull(), F.lit(0.0)).otherwise(
        (F.log1p(value) - median) / iqr
    )
    joined = df.join(stats, list(groups), "left")
    return joined.select(*df.columns, scaled.alias(output or f"{column}_normalized"))


def quantile_thresholds(
    df: DataFrame, column: str, groups: Sequence[str], n_buckets: int = 3, skew: float = 3.0, exact: bool = True
) -> DataFrame:
    """Thresholds at (i/n)^skew over positive x, by group."""
    probs = [(i / n_buckets) ** skew for i in range(1, n_buckets)]
    q = _quantiles(df.where(F.col(column) > 0).select(*groups, column), groups, column, probs, exact)
    return q.select(*groups, *[F.col(f"q{i}").alias(f"{column}_threshold_{i + 1}") for i in range(len(probs))])


def quantile_buckets(
    df: DataFrame,
    thresholds: DataFrame,
    column: str,
    groups: Sequence[str],
    n_buckets: int = 3,
    output: str | None = None,
) -> DataFrame:
    """bucket_1 … bucket_n by the group's thresholds; NULL, non-positive x and unknown groups are bucket_1."""
    names = [f"{column}_threshold_{i}" for i in range(1, n_buckets)]
    labels = numbered_labels(n_buckets)
    bucket = F.when(F.col(names[0]).isNull(), F.lit(labels[0])).otherwise(
        label_bins(column, [F.col(n) for n in names], labels, unknown=labels[0])
    )
    joined = df.join(thresholds, list(groups), "left")
    return joined.select(*df.columns, bucket.alias(output or f"{column}_bin"))


def histogram(df: DataFrame, column: str, bins: int = 50, log: bool = True) -> DataFrame:
    """Equal-width bins over x or log10(x): centre, count, share. No rows if there is nothing to count."""
    x = F.col(column)
    rows = df.where(x > 0).select(F.log10(x).alias("x")) if log else df.where(x.isNotNull()).select(x.alias("x"))
    counts = _binned(rows, [], bins)
    middle = F.col("low") + (F.col("bin") + 0.5) * F.col("width")
    centre = F.pow(F.lit(10.0), middle) if log else middle
    return counts.select(
        "bin", centre.alias("bin_center"), "count", (F.col("count") / F.col("total")).alias("probability")
    )


def density_histograms(df: DataFrame, columns: Sequence[str], bins: int = 50) -> DataFrame:
    """Histograms of several columns as densities, count / (rows · width); one scan by unpivoting."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "column", "x")
    counts = _binned(long.where(F.col("x").isNotNull()), ["column"], bins)
    return counts.select(
        "column",
        "bin",
        (F.col("low") + (F.col("bin") + 0.5) * F.col("width")).alias("bin_center"),
        "count",
        (F.col("count") / (F.col("total") * F.col("width"))).alias("density"),
    )


def _binned(rows: DataFrame, keys: Sequence[str], bins: int) -> DataFrame:
    """Counts per bin of ``x`` within ``keys`` (a handful of column names at most).

    The extremes are a one-row subquery, or one row per column name joined back, so the rows are not shuffled: counts
    are combined before the only exchange.
    """
    span = rows.groupBy(*keys).agg(F.min("x").alias("low"), F.max("x").alias("high"), F.count("*").alias("total"))
    width = (F.col("high") - F.col("low")) / bins
    span = span.select(*keys, "low", "total", F.when(width == 0, F.lit(1.0)).otherwise(width).alias("width"))
    if keys:
        placed = rows.join(F.broadcast(span), list(keys))  # as many rows as there are histogram columns
    else:
        one = span.agg(F.first(F.struct("low", "width", "total"))).scalar()
        placed = rows.select("x", one.alias("_s")).select("x", "_s.*")
    index: Column = F.floor((F.col("x") - F.col("low")) / F.col("width")).cast("int")
    index = F.when(index >= bins, bins - 1).when(index < 0, 0).otherwise(index)
    return placed.groupBy(*keys, index.alias("bin"), "low", "width", "total").agg(F.count("*").alias("count"))


def line_series(df: DataFrame, x: str, ys: Sequence[str]) -> DataFrame:
    """(x, y…) in x order."""
    return df.select(x, *ys).orderBy(x)
