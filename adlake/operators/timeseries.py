"""Temporal decay, similarity between periods, and short-series forecasts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake.functions.scalar import date_hour, feature_key, ratio_or_zero
from adlake.operators.running import exact_percentiles, value_counts
from adlake.session import cut_lineage


# Decay ---------------------------------------------------------------------------------------


def decay_factor(date: str, rate: float, end: Column) -> Column:
    return F.pow(F.lit(float(rate)), F.datediff(end, F.col(date)))


def temporal_decay(
    df: DataFrame,
    rates: Mapping[str, float],
    date: str,
    end_date: str | None = None,
    suffix: str = "",
) -> DataFrame:
    """x · rate^(days before the end date) for each column of ``rates``, in place or under a suffix.

    Without an end date the latest date is used, as a one-value subquery of the same plan.
    """
    end = F.lit(end_date).cast("date") if end_date else df.agg(F.max(date).alias("end")).scalar()
    return df.withColumns({f"{c}{suffix}": F.col(c) * decay_factor(date, r, end) for c, r in rates.items()})


def decayed_ratio(
    df: DataFrame, keys: Sequence[str], date: str, numerator: tuple[str, float], denominator: tuple[str, float]
) -> DataFrame:
    """Ratio of decayed sums, each column with a rate of its own; 0.0 without denominator."""
    (top, top_rate), (bottom, bottom_rate) = numerator, denominator
    decayed = temporal_decay(df, {top: top_rate, bottom: bottom_rate}, date)
    sums = decayed.groupBy(*keys).agg(F.sum(top).alias(top), F.sum(bottom).alias(bottom))
    return sums.withColumn("ratio", ratio_or_zero(top, bottom))


# Cosine --------------------------------------------------------------------------------------


def _cosine_sums(a: str, b: str, name: str) -> list[Column]:
    """Sums over keys where both values are known and not zero."""
    x, y = F.col(a), F.col(b)
    both = (x != 0) & (y != 0)
    return [
        F.sum(F.when(both, x * y)).alias(f"_dot_{name}"),
        F.sum(F.when(both, x * x)).alias(f"_aa_{name}"),
        F.sum(F.when(both, y * y)).alias(f"_bb_{name}"),
        F.count_if(both).alias(f"_n_{name}"),
    ]


def _cosine_rows(sums: DataFrame, keep: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """One row per metric: cosine (0 if a norm is 0) and number of matched keys."""
    cells = []
    for m in metrics:
        norm = F.sqrt(F.col(f"_aa_{m}")) * F.sqrt(F.col(f"_bb_{m}"))
        cosine = F.when(norm > 0, F.try_divide(F.col(f"_dot_{m}"), norm)).otherwise(F.lit(0.0))
        cells.append(
            F.struct(F.lit(m).alias("metric"), cosine.alias("cosine"), F.col(f"_n_{m}").alias("matched"))
        )
    return sums.select(*keep, F.explode(F.array(*cells)).alias("_r")).select(*keep, "_r.*")


def keyed_cosine(a: DataFrame, b: DataFrame, key: str, metrics: Sequence[str]) -> DataFrame:
    """Cosine of two keyed vectors for every metric in one job."""
    left = a.select(key, *[F.col(m).alias(f"a_{m}") for m in metrics])
    right = b.select(key, *[F.col(m).alias(f"b_{m}") for m in metrics])
    sums = [c for m in metrics for c in _cosine_sums(f"a_{m}", f"b_{m}", m)]
    return _cosine_rows(left.join(right, key).agg(*sums), [], metrics)


def each_period_vs(
    daily: DataFrame, reference: DataFrame, key: str, period: str, metrics: Sequence[str]
) -> DataFrame:
    """Cosine of every period against one reference vector, all periods and metrics in one job."""
    right = reference.select(key, *[F.col(m).alias(f"b_{m}") for m in metrics])
    joined = daily.select(key, period, *[F.col(m).alias(f"a_{m}") for m in metrics]).join(right, key)
    sums = [c for m in metrics for c in _cosine_sums(f"a_{m}", f"b_{m}", m)]
    return _cosine_rows(joined.groupBy(period).agg(*sums), [period], metrics)


def keyed_daily(df: DataFrame, keys: Sequence[str], period: str, metrics: Sequence[str]) -> DataFrame:
    """Σ metrics per (feature key, period)."""
    rows = df.select(feature_key(keys).alias("key"), period, *metrics)
    return rows.groupBy("key", period).agg(*[F.sum(m).alias(m) for m in metrics])


def period_pairs(
    daily: DataFrame,
    key: str,
    period: str,
    metrics: Sequence[str],
    gaps: Sequence[int] | None = None,
    calendar: bool = False,
) -> DataFrame:
    """Cosine of every pair of periods ``gap`` apart (all pairs if no gaps are given), in one job.

    ``daily`` has one row per (key, period). With gaps, a row is repeated once per gap and joined on (key, period
    number), so the work grows with periods × gaps and a key with very many periods is spread over tasks. Gaps are
    counted in available periods, or in days with ``calendar``. The table is read three times, so it is written once.
    """
    daily = cut_lineage(daily.select(key, period, *metrics))
    if calendar:
        index = F.datediff(F.col(period), daily.agg(F.min(period)).scalar())
    else:
        # A table as long as the list of periods, which Spark broadcasts by its size; a NULL period has no number.
        known = daily.select(F.col(period).alias("_period")).where("_period IS NOT NULL").distinct()
        numbers = known.withColumn("_index", F.row_number().over(Window.orderBy("_period")))
        daily = daily.join(numbers, F.col(period) == F.col("_period"), "left")
        index = F.col("_index")
    left = daily.select(
        key, F.col(period).alias("period_1"), index.alias("i"), *[F.col(m).alias(f"a_{m}") for m in metrics]
    )
    right = daily.select(
        F.col(key).alias("_key"), F.col(period).alias("period_2"), index.alias("j"),
        *[F.col(m).alias(f"b_{m}") for m in metrics],
    )
    if gaps is not None:
        steps = F.array(*[F.lit(int(g)) for g in gaps])
        ahead = left.withColumn("gap", F.explode(steps))
        pairs = ahead.join(right, (F.col(key) == F.col("_key")) & (F.col("i") + F.col("gap") == F.col("j")))
    else:
        pairs = left.join(right, (F.col(key) == F.col("_key")) & (F.col("i") < F.col("j")))
        pairs = pairs.withColumn("gap", F.col("j") - F.col("i"))
    sums = [c for m in metrics for c in _cosine_sums(f"a_{m}", f"b_{m}", m)]
    keep = ["period_1", "period_2", "gap"]
    return _cosine_rows(pairs.groupBy(*keep).agg(*sums), keep, metrics)


def consecutive_similarity(daily: DataFrame, key: str, period: str, metrics: Sequence[str]) -> DataFrame:
    return period_pairs(daily, key, period, metrics, gaps=[1]).drop("gap")


def mean_by_gap(pairs: DataFrame) -> DataFrame:
    """Mean similarity per gap and metric."""
    return pairs.groupBy("metric", "gap").agg(F.avg("cosine").alias("mean_cosine"), F.count("*").alias("pairs"))


def full_matrix(pairs: DataFrame, daily: DataFrame, period: str, metrics: Sequence[str]) -> DataFrame:
    """Both triangles and a diagonal of 1.0."""
    p1, p2 = F.col("period_1"), F.col("period_2")
    sides = F.array(F.struct(p1.alias("x"), p2.alias("y")), F.struct(p2.alias("x"), p1.alias("y")))
    both = pairs.select("metric", F.explode(sides).alias("_p"), "cosine").select(
        "metric", F.col("_p.x").alias("period_1"), F.col("_p.y").alias("period_2"), "cosine"
    )
    days = daily.select(F.col(period).alias("period_1")).distinct()
    names = F.array(*[F.lit(m) for m in metrics])
    diagonal = days.select(
        F.explode(names).alias("metric"), "period_1", F.col("period_1").alias("period_2"), F.lit(1.0).alias("cosine")
    )
    return both.unionByName(diagonal)


def implied_decay(by_gap: DataFrame) -> DataFrame:
    """exp(slope of ln(similarity) over gap); NULL with fewer than two positive points."""
    positive = by_gap.where(F.col("mean_cosine") > 0)
    slope = F.regr_slope(F.log("mean_cosine"), F.col("gap"))
    return positive.groupBy("metric").agg(
        F.when(F.count("*") >= 2, F.exp(slope)).alias("decay_rate"), F.count("*").alias("points")
    )


def hourly_pairs(hourly: DataFrame, key: str, ts: str, metrics: Sequence[str]) -> DataFrame:
    """Consecutive available hours, with the first hour of the day and a flag for 23 -> 00."""
    rows = hourly.withColumn("_dh", date_hour(ts)).drop(ts)
    out = consecutive_similarity(rows, key, "_dh", metrics)
    h1 = F.substring("period_1", 12, 2).cast("int")
    h2 = F.substring("period_2", 12, 2).cast("int")
    return out.select(
        F.col("period_1").alias("date_hour_1"),
        F.col("period_2").alias("date_hour_2"),
        h1.alias("hour_1"),
        ((h1 == 23) & (h2 == 0)).alias("day_boundary"),
        "metric",
        "cosine",
        "matched",
    )


def stability_by_hour(hour_pairs: DataFrame) -> DataFrame:
    return hour_pairs.groupBy("metric", "hour_1").agg(
        F.avg("cosine").alias("mean_cosine"), F.stddev_samp("cosine").alias("std_cosine"), F.count("*").alias("pairs")
    )


def boundary_effect(hour_pairs: DataFrame) -> DataFrame:
    """Mean similarity across midnight and within the day, and their difference."""
    across = F.avg(F.when(F.col("day_boundary"), F.col("cosine")))
    within = F.avg(F.when(~F.col("day_boundary"), F.col("cosine")))
    return hour_pairs.groupBy("metric").agg(
        across.alias("boundary_mean"), within.alias("within_mean"), (across - within).alias("difference")
    )


def hourly_vs_daily(by_gap: DataFrame) -> DataFrame:
    """Similarity one hour apart, 24 hours apart, and the loss per hour between them."""
    one = F.max(F.when(F.col("gap") == 1, F.col("mean_cosine")))
    day = F.max(F.when(F.col("gap") == 24, F.col("mean_cosine")))
    return by_gap.groupBy("metric").agg(
        one.alias("sim_1h"), day.alias("sim_24h"), (one - day).alias("drop"), ((one - day) / 23).alias("drop_per_hour")
    )


def series_trend(series: DataFrame, keys: Sequence[str], index: str, value: str) -> DataFrame:
    """Slope, intercept, correlation with the index, first to last change, and a verdict."""
    first, last = F.min_by(value, index), F.max_by(value, index)
    stats = series.groupBy(*keys).agg(
        F.regr_slope(F.col(value), F.col(index)).alias("slope"),
        F.regr_intercept(F.col(value), F.col(index)).alias("intercept"),
        F.corr(value, index).alias("correlation"),
        first.alias("first_value"),
        last.alias("last_value"),
    )
    change, corr = F.col("change"), F.col("correlation")
    verdict = (
        F.when((corr > 0.5) & (change > 0), "strong positive")
        .when((corr > 0) & (change > 0), "weak positive")
        .when((corr < -0.5) & (change < 0), "strong negative")
        .when(F.abs(corr) < 0.3, "no clear trend")
        .otherwise("negative")
    )
    return (
        stats.withColumn("change", F.col("last_value") - F.col("first_value"))
        .withColumn("change_pct", ratio_or_zero(change * 100, "first_value"))
        .withColumn("verdict", verdict)
    )


def decay_improvement(
    raw: DataFrame, decayed: DataFrame, test: DataFrame, key: str, metrics: Sequence[str]
) -> DataFrame:
    """Cosine to the test vector without and with decay, and the change in percent."""
    plain = keyed_cosine(raw, test, key, metrics).select("metric", F.col("cosine").alias("raw_cosine"), "matched")
    faded = keyed_cosine(decayed, test, key, metrics).select("metric", F.col("cosine").alias("decayed_cosine"))
    gain = F.try_divide(F.col("decayed_cosine") - F.col("raw_cosine"), F.col("raw_cosine")) * 100
    return plain.join(faded, "metric").withColumn("improvement_pct", gain)


# Forecasts over one array per key ---------------------------------------------------------------
# An array holds one value per day, oldest first, so it is as long as the number of days.


def known_values(series: Column, field: str) -> Column:
    """Values of one field of a date-ordered array of structs, NULLs removed, as doubles."""
    values = F.transform(series, lambda s: s[field].cast("double"))
    return F.filter(values, lambda v: v.isNotNull())


def _by_length(values: Column, several: Column) -> Column:
    """0.0 for an empty array, the value for a single one, else ``several``.

    Spark may compute ``several`` ahead of the test, so it must not fail on short arrays.
    """
    n = F.size(values)
    return F.when(n == 0, F.lit(0.0)).when(n == 1, F.try_element_at(values, F.lit(1))).otherwise(several)


def holt_forecast(values: Column, alpha: float, beta: float) -> Column:
    """Holt's linear smoothing: level and trend start from the first two values."""
    first, second = F.try_element_at(values, F.lit(1)), F.try_element_at(values, F.lit(2))
    start = F.struct(first.alias("level"), (second - first).alias("trend"))

    def step(state: Column, x: Column) -> Column:
        level = F.lit(alpha) * x + F.lit(1 - alpha) * (state["level"] + state["trend"])
        trend = F.lit(beta) * (level - state["level"]) + F.lit(1 - beta) * state["trend"]
        return F.struct(level.alias("level"), trend.alias("trend"))

    rest = F.slice(values, 2, F.greatest(F.size(values) - 1, F.lit(0)))
    return _by_length(values, F.aggregate(rest, start, step, lambda s: s["level"] + s["trend"]))


def decay_mean_forecast(values: Column, rate: float) -> Column:
    """Mean with weight rate^(age): the sums fold as s·rate + x."""
    zero = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("w"))

    def step(state: Column, x: Column) -> Column:
        return F.struct(
            (state["s"] * F.lit(float(rate)) + x).alias("s"), (state["w"] * F.lit(float(rate)) + F.lit(1.0)).alias("w")
        )

    return _by_length(values, F.aggregate(values, zero, step, lambda s: F.try_divide(s["s"], s["w"])))


def last_value_forecast(values: Column) -> Column:
    return _by_length(values, F.try_element_at(values, F.lit(-1)))


def mean_forecast(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return _by_length(values, F.try_divide(total, F.size(values)))


def _line_sums(values: Column) -> Column:
    """Struct with Σy, Σty and Σyy over t = 0, 1 …"""
    zero = F.struct(F.lit(0.0).alias("t"), F.lit(0.0).alias("y"), F.lit(0.0).alias("ty"), F.lit(0.0).alias("yy"))
    return F.aggregate(
        values,
        zero,
        lambda s, y: F.struct(
            (s["t"] + 1.0).alias("t"),
            (s["y"] + y).alias("y"),
            (s["ty"] + s["t"] * y).alias("ty"),
            (s["yy"] + y * y).alias("yy"),
        ),
    )


def _line(sums: Column) -> tuple[Column, Column, Column, Column]:
    """n, Σ(t-t̄)², Σ(t-t̄)(y-ȳ), Σ(y-ȳ)²"""
    n = sums["t"]
    t_sum, tt = n * (n - 1) / 2, n * (n - 1) * (2 * n - 1) / 6
    return (
        n,
        tt - F.try_divide(t_sum * t_sum, n),
        sums["ty"] - F.try_divide(t_sum * sums["y"], n),
        sums["yy"] - F.try_divide(sums["y"] * sums["y"], n),
    )


def linear_forecast(values: Column) -> Column:
    """Least-squares line over the index, read one step past the end."""
    sums = _line_sums(values)
    n, var_t, cov, _ = _line(sums)
    mean = F.try_divide(sums["y"], n)
    slope = F.try_divide(cov, var_t)
    return _by_length(values, mean + slope * (n - (n - 1) / 2))


def adaptive_forecast(values: Column, alpha: float, beta: float, min_r2: float = 0.6) -> Column:
    """Holt where a line explains the series (R² above the bound), else the last value."""
    _, var_t, cov, var_y = _line(_line_sums(values))
    r2 = F.try_divide(cov * cov, var_t * var_y)
    trending = (F.size(values) > 1) & (r2 > min_r2)
    return F.when(trending, holt_forecast(values, alpha, beta)).otherwise(last_value_forecast(values))


HOLT_ALPHAS = (0.2, 0.3, 0.5, 0.7)
HOLT_BETAS = (0.1, 0.2, 0.3)
DECAY_RATES = (0.85, 0.90, 0.92, 0.95)


def forecast_methods(
    alphas: Sequence[float] = HOLT_ALPHAS,
    betas: Sequence[float] = HOLT_BETAS,
    rates: Sequence[float] = DECAY_RATES,
):
    """Name -> function of a value array; the parameter grid of the backtest."""
    methods = {"mean": mean_forecast, "last_value": last_value_forecast, "linear_trend": linear_forecast}
    for r in rates:
        methods[f"decay_{r}"] = lambda v, r=r: decay_mean_forecast(v, r)
    for a in alphas:
        for b in betas:
            methods[f"holt_a{a}_b{b}"] = lambda v, a=a, b=b: holt_forecast(v, a, b)
    return methods


def forecast_errors(
    history: DataFrame,
    actuals: DataFrame,
    key: str,
    metrics: Sequence[str],
    methods: Mapping,
    series: str = "series",
) -> DataFrame:
    """(key, metric, method, prediction, actual, ape): all methods are evaluated on the one row of a key, and only the
    short list of results is exploded. Actuals that are NULL, 0 or NaN are skipped."""
    right = actuals.select(key, *[F.col(m).cast("double").alias(f"_actual_{m}") for m in metrics])
    joined = history.join(right, key)
    prepared = joined.select(
        key, *[F.col(f"_actual_{m}") for m in metrics], *[known_values(F.col(series), m).alias(f"_v_{m}") for m in metrics]
    )
    cells = []
    for m in metrics:
        actual, values = F.col(f"_actual_{m}"), F.col(f"_v_{m}")
        results = F.array(
            *[
                F.struct(
                    F.lit(m).alias("metric"),
                    F.lit(name).alias("method"),
                    fn(values).alias("prediction"),
                    actual.alias("actual"),
                )
                for name, fn in methods.items()
            ]
        )
        usable = actual.isNotNull() & ~F.isnan(actual) & (actual != 0) & (F.size(values) > 0)
        cells.append(F.when(usable, results).otherwise(F.slice(results, 1, 0)))
    rows = prepared.select(key, F.explode(F.concat(*cells)).alias("_r")).select(key, "_r.*")
    return rows.withColumn("ape", F.try_divide(F.abs(F.col("prediction") - F.col("actual")), F.abs("actual")))


def backtest(errors: DataFrame) -> DataFrame:
    """MAPE and median APE in percent per (metric, method), both exact."""
    keys = ["metric", "method"]
    counts = value_counts(errors, keys, "ape")  # the forecasts are computed once, for both results
    total = F.sum("_n")
    means = counts.groupBy(*keys).agg(
        (F.sum(F.col("ape") * F.col("_n")) / total * 100).alias("mape_pct"), total.alias("n")
    )
    medians = exact_percentiles(counts, keys, "ape", {"_median": 0.5}, counted=True)
    medians = medians.select(*keys, (F.col("_median") * 100).alias("median_ape_pct"))
    return means.join(medians, keys).select(*keys, "mape_pct", "median_ape_pct", "n")


def best_per_family(scores: DataFrame) -> DataFrame:
    """Best method of each family (holt, decay, baselines) per metric."""
    family = (
        F.when(F.col("method").startswith("holt_"), "holt")
        .when(F.col("method").startswith("decay_"), "decay")
        .otherwise("baseline")
    )
    best = F.min(F.struct(F.col("mape_pct"), F.col("method")))
    return scores.groupBy("metric", family.alias("family")).agg(best.alias("_b")).select(
        "metric", "family", F.col("_b.method").alias("method"), F.col("_b.mape_pct").alias("mape_pct")
    )


def holt_grid(
    scores: DataFrame, alphas: Sequence[float] = HOLT_ALPHAS, betas: Sequence[float] = HOLT_BETAS
) -> DataFrame:
    """MAPE of the smoothing grid: rows alpha, columns beta."""
    cells = F.array(
        *[
            F.struct(F.lit(f"holt_a{a}_b{b}").alias("m"), F.lit(float(a)).alias("alpha"), F.lit(float(b)).alias("beta"))
            for a in alphas
            for b in betas
        ]
    )
    hit = F.element_at(F.filter(cells, lambda c: c["m"] == F.col("method")), 1)
    rows = scores.where(F.col("method").startswith("holt_")).withColumn("_c", hit)
    wide = [F.max(F.when(F.col("_c.beta") == float(b), F.col("mape_pct"))).alias(f"beta_{b}") for b in betas]
    return rows.groupBy("metric", F.col("_c.alpha").alias("alpha")).agg(*wide)


def ranked_methods(scores: DataFrame) -> DataFrame:
    """Methods in order of MAPE within a metric; a metric has as many rows as there are methods."""
    place = F.row_number().over(Window.partitionBy("metric").orderBy("mape_pct", "method"))
    return scores.withColumn("place", place)
