"""Grouped aggregates, pivots, unpivots and top-k."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.functions.scalar import ratio_or_zero, time_bucket

AGGREGATES = ("sum", "count", "avg", "min", "max", "count_distinct", "first", "last")


@dataclass(frozen=True)
class Aggregation:
    """One output column. ``condition`` is a SQL predicate; rows that fail it do not count.

    ``first`` and ``last`` need ``order_by``: without an order their result would depend on task timing.
    """

    source_col: str
    agg_func: str
    output_col: str
    condition: str | None = None
    order_by: str | None = None

    def column(self, df: DataFrame) -> Column:
        if self.agg_func not in AGGREGATES:
            raise ValueError(f"unknown aggregate {self.agg_func!r}")
        keep = F.expr(self.condition) if self.condition else None
        if self.source_col == "*":
            if self.agg_func != "count":
                raise ValueError("'*' can only be counted")
            return (F.count("*") if keep is None else F.count_if(keep)).alias(self.output_col)
        source = F.col(self.source_col)
        value = source if keep is None else F.when(keep, source)
        if self.agg_func == "sum":
            zero = F.lit(0).cast(df.select(source).schema[0].dataType)
            out = F.sum(F.coalesce(value, zero))
        elif self.agg_func == "count":
            out = F.count("*") if keep is None else F.count_if(keep)
        elif self.agg_func == "count_distinct":
            out = F.count_distinct(value)
        elif self.agg_func in ("first", "last"):
            if self.order_by is None:
                raise ValueError(f"{self.agg_func} of {self.source_col} needs order_by")
            order = F.col(self.order_by) if keep is None else F.when(keep, F.col(self.order_by))
            pick = F.struct(order.alias("o"), source.alias("v"))
            pick = F.when(order.isNotNull(), pick)
            out = (F.min(pick) if self.agg_func == "first" else F.max(pick))["v"]
        else:
            out = {"avg": F.avg, "min": F.min, "max": F.max}[self.agg_func](value)
        return out.alias(self.output_col)


def bucket_aggregate(
    df: DataFrame,
    group_by: Sequence[str],
    aggregations: Sequence[Aggregation],
    time_column: str | None = None,
    bucket: str | None = "hour",
) -> DataFrame:
    """Aggregates per (time bucket, dims)."""
    if time_column and bucket:
        df = df.withColumn("time_bucket", time_bucket(time_column, bucket))
        keys = ["time_bucket", *group_by]
    else:
        keys = list(group_by)
    return df.groupBy(*keys).agg(*[a.column(df) for a in aggregations])


def grouping_sets_aggregate(
    df: DataFrame,
    groupings: Mapping[str, Sequence[str]],
    aggregations: Sequence[Aggregation],
) -> DataFrame:
    """Several groupings in one scan. ``grouping_name`` tells the rows apart; dims outside a grouping are NULL."""
    dims = list(dict.fromkeys(c for cols in groupings.values() for c in cols))
    masks = {}
    for name, cols in groupings.items():
        # grouping_id() has a 1 bit, first dim highest, for each dim that is rolled away
        mask = sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in cols)
        if mask in masks:
            raise ValueError(f"groupings {masks[mask]!r} and {name!r} have the same columns")
        masks[mask] = name
    sets = [[F.col(c) for c in cols] for cols in groupings.values()]
    grouped = df.groupingSets(sets, *[F.col(d) for d in dims])
    out = grouped.agg(*[a.column(df) for a in aggregations], F.grouping_id().alias("_gid"))
    label: Column | None = None
    for mask, name in masks.items():
        hit = F.col("_gid") == mask
        label = F.when(hit, F.lit(name)) if label is None else label.when(hit, F.lit(name))
    return out.withColumn("grouping_name", label).drop("_gid")


def daily_metrics(df: DataFrame, entity: str, date: str, requests: str, revenue: str, scale: int = 10) -> DataFrame:
    """Scaled requests and revenue per 1e9 requests per (date, entity)."""
    sums = df.groupBy(date, entity).agg(F.sum(requests).alias("_req"), F.sum(revenue).alias("_rev"))
    return sums.select(
        date,
        entity,
        (F.col("_req") * scale).alias("total_requests_scaled"),
        F.when(F.col("_req") > 0, F.try_divide(F.col("_rev"), F.col("_req")) * 1e9).otherwise(F.lit(0.0)).alias("nr_per_billion"),
    )


def pivot_wide(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    values: Sequence,
    aggregates: Mapping[str, tuple[Callable[[Column], Column], Column]],
    fill: float | None = None,
) -> DataFrame:
    """Spread listed values of ``column`` over columns ``{value}_{aggregate}`` in one pass.

    ``aggregates`` maps a name to (aggregate function, source column).
    The value list fixes the output schema and saves Spark a job that looks for distinct values.
    """
    cases = [
        function(F.when(F.col(column) == F.lit(value), source)).alias(f"{value}_{name}")
        for value in values
        for name, (function, source) in aggregates.items()
    ]
    out = df.groupBy(*keys).agg(*cases)
    return out if fill is None else out.fillna(fill, subset=[c for c in out.columns if c not in keys])


def days_in(df: DataFrame, date: str) -> list[str]:
    """Every day that occurs, in order: one short list, as long as the calendar."""
    days = df.select(F.col(date).cast("string").alias("d")).where("d IS NOT NULL").distinct()
    return sorted(r["d"] for r in days.collect())


def trend_table(daily: DataFrame, entity: str, date: str, dates: Sequence[str] | None = None) -> DataFrame:
    """Two metrics by day in one pivot, gaps 0, largest total first. Without ``dates``, all days that occur."""
    dates = days_in(daily, date) if dates is None else dates
    wide = pivot_wide(
        daily.withColumn("_day", F.col(date).cast("string")),
        [entity],
        "_day",
        dates,
        {
            "requests": (F.sum, F.col("total_requests_scaled")),
            "nr_per_billion": (F.sum, F.col("nr_per_billion")),
        },
        fill=0,
    )
    total = sum((F.col(f"{d}_requests") for d in dates), F.lit(0))
    return wide.orderBy(total.desc(), entity)


def token_counts(df: DataFrame, features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows per (feature, token) after unpivoting the feature columns; one scan, counts combined before the shuffle."""
    text = df.select(*by, *[F.col(c).cast("string").alias(c) for c in features])
    return text.unpivot(list(by), list(features), "feature", "token").groupBy(*by, "feature", "token").agg(
        F.count("*").alias("count")
    )


def distribution_shift(df: DataFrame, features: Sequence[str], date: str, dates: Sequence[str] | None = None) -> DataFrame:
    """(feature, token) × date counts with gaps 0. Without ``dates``, all days that occur."""
    dates = days_in(df, date) if dates is None else dates
    counts = token_counts(df.withColumn("_day", F.col(date).cast("string")), features, ["_day"])
    cases = [F.coalesce(F.sum(F.when(F.col("_day") == d, F.col("count"))), F.lit(0)).alias(d) for d in dates]
    return counts.groupBy("feature", "token").agg(*cases)


def top_entities(df: DataFrame, entity: str, value: str, k: int, where: Column | None = None) -> DataFrame:
    """The ``k`` entities with the largest Σ value; ties go to the smaller id."""
    rows = df if where is None else df.where(where)
    sums = rows.groupBy(entity).agg(F.sum(value).alias("total"))
    return sums.orderBy(F.desc("total"), F.asc(entity)).limit(k)


def map_rest_to_other(df: DataFrame, entity: str, kept: DataFrame, other: str = "other") -> DataFrame:
    """Replace entities outside ``kept`` (a top-k frame) by ``other``; no list passes through the driver."""
    marks = kept.select(F.col(entity).alias("_kept")).distinct()
    joined = df.join(marks, df[entity] == F.col("_kept"), "left")
    mapped = F.coalesce(F.col("_kept"), F.lit(other)).alias(entity)
    return joined.select(*[mapped if c == entity else df[c] for c in df.columns])


def group_metrics(df: DataFrame, group: str, requests: str, revenue: str) -> DataFrame:
    """Requests, revenue, rows and revenue per request by group; NULL where there are no requests."""
    sums = df.groupBy(group).agg(
        F.sum(requests).alias("total_requests"), F.sum(revenue).alias("total_revenue"), F.count("*").alias("count")
    )
    return sums.withColumn(
        "revenue_per_request", F.try_divide(F.col("total_revenue"), F.col("total_requests"))
    ).orderBy(F.desc("revenue_per_request"), group)


def missing_values(df: DataFrame, column: str, required: Sequence[str]) -> DataFrame:
    """Required values that do not occur in ``column``: one aggregate row, no distinct shuffle."""
    seen = df.agg(*[F.coalesce(F.max(F.when(F.col(column) == v, 1)), F.lit(0)).alias(f"v{i}") for i, v in enumerate(required)])
    pairs = F.array(*[F.struct(F.lit(v).alias("value"), F.col(f"v{i}").alias("seen")) for i, v in enumerate(required)])
    rows = seen.select(F.explode(pairs).alias("r"))
    return rows.where("r.seen = 0").select(F.col("r.value").alias(column))


def column_profile(df: DataFrame, column: str) -> DataFrame:
    """min, max, mean, standard deviation, positive rows, all rows."""
    c = F.col(column)
    return df.agg(
        F.min(c).alias("min_val"),
        F.max(c).alias("max_val"),
        F.avg(c).alias("avg_val"),
        F.stddev(c).alias("stddev_val"),
        F.count_if(c > 0).alias("positive_count"),
        F.count("*").alias("total_count"),
    )


def history_per_key(df: DataFrame, keys: Sequence[str], date: str, metrics: Sequence[str], output: str = "series") -> DataFrame:
    """Date-ordered array of structs per key. ``df`` must hold one row per (key, date), so an array is as long as the
    range of dates and no longer."""
    return df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(date, *metrics))).alias(output))


def entity_tokens(df: DataFrame, entities: Sequence[str], token: Column, output: str = "token") -> DataFrame:
    """The set of tokens of each entity as distinct rows; entities without tokens have no rows."""
    return df.select(*entities, token.alias(output)).where(F.col(output).isNotNull()).distinct()


def chunked_sum_of_squares(df: DataFrame, id_column: str, value: str, chunk: int = 100) -> DataFrame:
    """Sum of squares per chunk of ids, then over all chunks."""
    chunks = df.groupBy(F.floor(F.col(id_column) / chunk).alias("chunk")).agg(
        F.sum(F.col(value) * F.col(value)).alias("chunk_sum")
    )
    return chunks.agg(F.sum("chunk_sum").alias("total"), F.count("*").alias("chunks"))


def totals_by(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in columns])

