"""Comparison of two outputs and of two snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOLERANCE = 1e-6


def _join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    test = reduce(lambda a, b: a & b, [left[f"l_{k}"].eqNullSafe(right[f"r_{k}"]) for k in keys])
    return left.join(right, test, how)


def compare_outputs(new: DataFrame, old: DataFrame, keys: Sequence[str], metrics: Sequence[str], how: str = "inner") -> DataFrame:
    """new, old, difference and percent difference per metric for keys equal null-safely.

    Percent: relative to the old value; 100 where only the new one is non-zero, 0 where both are.
    """
    a = new.select(*[F.col(k).alias(f"l_{k}") for k in keys], *[F.col(m).alias(f"new_{m}") for m in metrics])
    b = old.select(*[F.col(k).alias(f"r_{k}") for k in keys], *[F.col(m).alias(f"old_{m}") for m in metrics])
    out = [F.coalesce(f"l_{k}", f"r_{k}").alias(k) for k in keys]
    for m in metrics:
        was = F.coalesce(f"old_{m}", F.lit(0))
        now = F.coalesce(f"new_{m}", F.lit(0)) if how != "inner" else F.col(f"new_{m}")
        diff = now - was
        pct = F.when(was != 0, F.try_divide(F.abs(diff), F.abs(was)) * 100).when(now != 0, F.lit(100.0)).otherwise(F.lit(0.0))
        out += [F.col(f"new_{m}"), F.col(f"old_{m}"), diff.alias(f"diff_{m}"), pct.alias(f"pct_diff_{m}")]
    return _join_on(a, b, keys, how).select(*out)


def comparison_summary(compared: DataFrame, metrics: Sequence[str], tolerance: float = TOLERANCE) -> DataFrame:
    """Per metric: rows, missing old values, exact and near matches, mean and largest differences. One pass."""
    sums, cells = [], []
    for m in metrics:
        diff = F.col(f"diff_{m}")
        parts = {
            "missing_old": F.count_if(F.col(f"old_{m}").isNull()),
            "exact_matches": F.count_if(diff == 0),
            "near_matches": F.count_if(F.abs(diff) <= tolerance),
            "avg_diff": F.avg(diff.cast("double")),
            "max_abs_diff": F.max(F.abs(diff)).cast("double"),
            "avg_pct_diff": F.avg(f"pct_diff_{m}"),
        }
        sums += [agg.alias(f"{name}_{m}") for name, agg in parts.items()]
        cells.append(F.struct(F.lit(m).alias("metric"), F.col("rows"), *[F.col(f"{n}_{m}").alias(n) for n in parts]))
    return compared.agg(F.count("*").alias("rows"), *sums).select(F.explode(F.array(*cells)).alias("r")).select("r.*")


def worst_mismatches(compared: DataFrame, metric: str, keys: Sequence[str], n: int = 20, tolerance: float = 0.0) -> DataFrame:
    size = F.abs(F.col(f"diff_{metric}"))
    return compared.where(size > tolerance).orderBy(size.desc(), *keys).limit(n)


def only_in(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key, NULLs included, is not in ``right``."""
    marks = right.select(*[F.col(k).alias(f"__{k}") for k in keys])
    test = reduce(lambda a, b: a & b, [left[k].eqNullSafe(marks[f"__{k}"]) for k in keys])
    return left.join(marks, test, "left_anti")


def require_rows(df: DataFrame, name: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{name} is empty")
    return df


def shape_summary(df: DataFrame) -> DataFrame:
    """Rows and columns as one row."""
    return df.agg(F.count("*").alias("rows")).withColumn("columns", F.lit(len(df.columns)).cast("long"))


def roster_changes(before: DataFrame, after: DataFrame, key: str, version: str) -> DataFrame:
    """What happens to each name: gone -> die, present -> age to the new version, new -> born."""
    a = before.select(F.col(key).alias("l_key"), F.col(version).alias("old_version"))
    b = after.select(F.col(key).alias("r_key"), F.col(version).alias("new_version"))
    joined = a.join(b, F.col("l_key") == F.col("r_key"), "full_outer")
    action = F.when(F.col("r_key").isNull(), "die").when(F.col("l_key").isNull(), "born").otherwise("age")
    return joined.select(F.coalesce("l_key", "r_key").alias(key), action.alias("action"), "old_version", "new_version")


def snapshot_diff(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, change): added, removed or modified; unchanged keys are left out. Values compare null-safely."""
    values = [c for c in before.columns if c not in keys and c in after.columns]

    def record(df: DataFrame, side: str) -> DataFrame:
        body = F.struct(*values) if values else F.struct(F.lit(1).alias("one"))
        return df.select(*[F.col(k).alias(f"{side}_{k}") for k in keys], body.alias(f"{side}__v"), F.lit(True).alias(f"{side}__in"))

    joined = _join_on(record(before, "l"), record(after, "r"), keys, "full_outer")
    change: Column = (
        F.when(F.col("l__in").isNull(), "added")
        .when(F.col("r__in").isNull(), "removed")
        .when(~F.col("l__v").eqNullSafe(F.col("r__v")), "modified")
    )
    rows = joined.select(*[F.coalesce(f"l_{k}", f"r_{k}").alias(k) for k in keys], change.alias("change"))
    return rows.where(F.col("change").isNotNull())
