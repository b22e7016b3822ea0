"""Duplicate removal. Each mode is one aggregation whose partial results are combined before the shuffle, so a key with
very many copies costs one row per input partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the smallest by ``order``, ties broken by the other columns, so the survivor is fixed."""
    first = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in first]
    if not first and not rest:
        return df.distinct()
    best = df.groupBy(*keys).agg(F.min(F.struct(*first, *rest)).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def drop_repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Remove every row whose key occurs more than once. A surviving key has one row, so any row of it is the row."""
    rest = [c for c in df.columns if c not in keys]
    row = F.any_value(F.struct(*rest)).alias("_row") if rest else F.lit(None).alias("_row")
    single = df.groupBy(*keys).agg(F.count("*").alias("_copies"), row).where(F.col("_copies") == 1)
    return single.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Report of keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def dedupe(df: DataFrame, keys: Sequence[str], mode: str = "keep_first", order: Sequence[str] = ()) -> DataFrame:
    if mode == "none":
        return df
    if mode == "keep_first":
        return keep_first(df, keys, order)
    if mode == "drop_all":
        return drop_repeated(df, keys)
    raise ValueError(f"unknown dedupe mode {mode!r}")
