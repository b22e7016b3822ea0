"""Feature mapping and feature joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.functions import scalar
from adlake.functions.vocab import OTHERS
from adlake.sources.ranges import TimeRange, within


@dataclass(frozen=True)
class Feature:
    """Contract of a feature: rules are applied in the order case, allowed values, range, fill."""

    dtype: str = "string"
    case: str | None = None
    min_value: float | None = None
    max_value: float | None = None
    allowed_values: tuple | None = None
    regex: str | None = None
    max_null_percentage: float | None = None
    nullable: bool = True
    fill_na: Any = None

    def column(self, source: str) -> Column:
        c = scalar.apply_case(F.col(source), self.case)
        if self.allowed_values is not None:
            fallback = OTHERS if self.fill_na is None else self.fill_na
            c = scalar.only_allowed(c, self.allowed_values, fallback)
        c = scalar.clamp(c, self.min_value, self.max_value)
        return c if self.fill_na is None else F.coalesce(c, F.lit(self.fill_na))


@dataclass(frozen=True)
class FieldMapping:
    """Source column -> feature -> output name."""

    source_col: str
    feature: str
    output_col: str | None = None


def map_features(df: DataFrame, mappings: Sequence[FieldMapping], features: Mapping[str, Feature]) -> DataFrame:
    """One select with every mapped output; nothing else is kept."""
    unknown = [m.feature for m in mappings if m.feature not in features]
    if unknown:
        raise KeyError(f"unknown features: {', '.join(unknown)}")
    return df.select(*[features[m.feature].column(m.source_col).alias(m.output_col or m.feature) for m in mappings])


def derived_columns(df: DataFrame, expressions: Mapping[str, str]) -> DataFrame:
    """SQL expressions in order; later ones may use earlier ones."""
    for name, text in expressions.items():
        df = df.withColumn(name, F.expr(text))
    return df


def contract_report(df: DataFrame, features: Mapping[str, Feature]) -> DataFrame:
    """Per feature column: NULL share, and rows that break its pattern, range or value list. One pass."""
    aggregates, rows = [], []
    for i, (name, f) in enumerate(features.items()):
        c = F.col(name)
        checks = {
            "null_pct": F.avg(F.when(c.isNull(), 1.0).otherwise(0.0)) * 100,
            "bad_pattern": F.count_if(~c.cast("string").rlike(f.regex)) if f.regex else F.lit(0).cast("long"),
            "out_of_range": F.count_if(_outside(c, f)),
            "not_allowed": F.count_if(~c.isin(*f.allowed_values)) if f.allowed_values else F.lit(0).cast("long"),
        }
        aggregates += [agg.alias(f"{k}_{i}") for k, agg in checks.items() if k == "null_pct" or agg is not None]
        limit = 100.0 if f.max_null_percentage is None else float(f.max_null_percentage)
        limit = limit if f.nullable else 0.0
        ok = (
            (F.col(f"null_pct_{i}") <= limit)
            & (F.col(f"bad_pattern_{i}") == 0)
            & (F.col(f"out_of_range_{i}") == 0)
            & (F.col(f"not_allowed_{i}") == 0)
        )
        rows.append(
            F.struct(
                F.lit(name).alias("feature"), *[F.col(f"{k}_{i}").alias(k) for k in checks], ok.alias("passed")
            )
        )
    return df.agg(*aggregates).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _outside(c: Column, feature: Feature) -> Column:
    tests = [F.lit(False)]
    if feature.min_value is not None:
        tests.append(c < feature.min_value)
    if feature.max_value is not None:
        tests.append(c > feature.max_value)
    return reduce(lambda a, b: a | b, tests)


@dataclass(frozen=True)
class FeatureJoin:
    """How a feature table is attached. ``keys`` maps base column -> feature column."""

    keys: Mapping[str, str]
    columns: Sequence[str]
    rename: Mapping[str, str] = field(default_factory=dict)
    fill_na: Any = None
    null_safe: bool = True


def join_features(
    base: DataFrame,
    features: DataFrame,
    spec: FeatureJoin,
    time_range: TimeRange | None = None,
    time_column: str | None = None,
) -> DataFrame:
    """Left join on null-safe key equality.

    No broadcast hint: feature tables grow with publishers and hours. Spark broadcasts them while they are below its
    size limit, by estimate or by measured size, and otherwise shuffles and splits hot keys.
    """
    if time_column:
        features = within(features, time_column, time_range)
    picked = features.select(
        *[F.col(k).alias(f"__key_{k}") for k in spec.keys.values()],
        *[F.col(c).alias(f"__val_{c}") for c in spec.columns],
    )
    tests = []
    for left, right in spec.keys.items():
        a, b = base[left], picked[f"__key_{right}"]
        tests.append(a.eqNullSafe(b) if spec.null_safe else a == b)
    joined = base.join(picked, reduce(lambda x, y: x & y, tests), "left")
    outputs = []
    for c in spec.columns:
        value = F.col(f"__val_{c}")
        if spec.fill_na is not None:
            value = F.coalesce(value, F.lit(spec.fill_na))
        outputs.append(value.alias(spec.rename.get(c, c)))
    return joined.select(*[base[c] for c in base.columns], *outputs)


def join_many(base: DataFrame, joins: Sequence[tuple[DataFrame, FeatureJoin]]) -> DataFrame:
    for features, spec in joins:
        base = join_features(base, features, spec)
    return base


def with_time_columns(df: DataFrame, time_column: str) -> DataFrame:
    """``date`` and ``hour`` text columns where they are absent."""
    extra = []
    if "date" not in df.columns:
        extra.append(scalar.date_text(time_column).alias("date"))
    if "hour" not in df.columns:
        extra.append(scalar.hour_text(time_column).alias("hour"))
    return df.select("*", *extra) if extra else df


def partition_columns(df: DataFrame, bucket_column: str = "time_bucket") -> DataFrame:
    return df.withColumns({"date": scalar.date_text(bucket_column), "hour": scalar.hour_text(bucket_column)})
