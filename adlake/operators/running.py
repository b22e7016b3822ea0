"""Running sums, group totals, cumulative shares and exact percentiles that survive hot groups.

A window puts a whole group into one task. Here rows are range-partitioned on (group, order) instead, each range is summed
on its own, and the few range totals carry the sums across: the same steps at every size, with ranges of a bounded number
of rows. The rows are written once before they are counted, so the plan that makes them runs once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake.session import cut_lineage

# Rows that one range, and so one window task, holds.
RANGE_ROWS = 250_000


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str) -> Column:
    """Null-safe equality of ``left.key`` and ``right.{prefix}key`` for every key."""
    return reduce(
        lambda a, b: a & b, [left[k].eqNullSafe(right[f"{prefix}{k}"]) for k in keys]
    )


def attach(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join ``right`` on null-safe equality of ``keys`` and drop its copies of them.

    No broadcast is forced: the size of ``right`` is known to adaptive execution, which also splits hot keys.
    """
    renamed = right.select(*[F.col(k).alias(f"__{k}") if k in keys else F.col(k) for k in right.columns])
    return left.join(renamed, same_keys(left, renamed, keys, "__"), how).drop(*[f"__{k}" for k in keys])


def with_group_totals(df: DataFrame, keys: Sequence[str], totals: Mapping[str, Column]) -> DataFrame:
    """Add aggregates of the row's group: one partial aggregation and a join, never a whole group in a window."""
    sums = df.groupBy(*keys).agg(*[agg.alias(name) for name, agg in totals.items()])
    return attach(df, sums, keys)


def running_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    sums: Mapping[str, str],
    written: bool = False,
    range_rows: int | None = None,
) -> DataFrame:
    """Add running sums ``{output: input}`` in ``order`` within ``keys``, the current row included.

    ``order`` must be total within a group. Without keys the order is global and the whole table is the group. As in SQL,
    NULL adds nothing, and a sum is NULL until the first value. ``written`` says that ``df`` is a plain read of a table.
    """
    keys = list(keys)
    base = df if written else cut_lineage(df)
    ranges = max(1, -(-base.count() // (range_rows or RANGE_ROWS)))
    ranged = base.repartitionByRange(ranges, *keys, *order).withColumn("_range", F.spark_partition_id())
    # Range bounds come from a sample; the written copy keeps both readers below on the same bounds.
    ranged = cut_lineage(ranged)
    parts = [*keys, "_range"]
    totals = ranged.groupBy(*parts).agg(*[F.sum(c).alias(out) for out, c in sums.items()])
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *parts, *[F.sum(out).over(earlier).alias(f"_before_{out}") for out in sums]
    )
    inside = Window.partitionBy(*parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.select("*", *[F.sum(c).over(inside).alias(f"_inside_{out}") for out, c in sums.items()])
    joined = attach(local, offsets, parts)

    def carried(out: str) -> Column:
        here, before = F.col(f"_inside_{out}"), F.col(f"_before_{out}")
        return F.coalesce(here + before, here, before).alias(out)

    return joined.select(*df.columns, *[carried(out) for out in sums])


def cumulative_share(
    df: DataFrame, keys: Sequence[str], score: str, weight: str, output: str = "percentile", range_rows: int | None = None
) -> DataFrame:
    """Share of the group's weight held by rows with this score or a higher one. Equal scores share one value."""
    base = cut_lineage(df)
    return attach(base, score_shares(base, keys, score, weight, output, range_rows), [*keys, score])


def score_shares(
    df: DataFrame, keys: Sequence[str], score: str, weight: str, output: str = "percentile", range_rows: int | None = None
) -> DataFrame:
    """One row per (group, score) with the cumulative share of :func:`cumulative_share`."""
    by_score = cut_lineage(df.groupBy(*keys, score).agg(F.sum(weight).alias("_weight")))
    running = running_sums(by_score, keys, [F.desc(score)], {"_cumulative": "_weight"}, True, range_rows)
    totals = by_score.groupBy(*keys).agg(F.sum("_weight").alias("_total"))
    return attach(running, totals, keys).select(
        *keys, score, F.try_divide(F.col("_cumulative"), F.col("_total")).alias(output)
    )


def share_of_group(df: DataFrame, keys: Sequence[str], value: str, output: str) -> DataFrame:
    """value / Σ value within ``keys``."""
    total = with_group_totals(df, keys, {"_total": F.sum(value)})
    return total.withColumn(output, F.try_divide(F.col(value), F.col("_total"))).drop("_total")


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows per (group, distinct value), NULL values left out; written once because percentiles read it repeatedly."""
    return cut_lineage(df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n")))


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: Mapping[str, float],
    method: str = "linear",
    counted: bool = False,
    range_rows: int | None = None,
) -> DataFrame:
    """Exact percentiles per group without holding a group in memory.

    Values are counted per distinct value, the counts are summed in value order, and each percentile is the smallest
    value whose running count passes its rank. ``method``: ``linear`` interpolates between neighbours, ``lower`` takes
    the smallest value with at least that share of rows at or below it, ``index`` takes row ``floor(p * n)`` counted
    from 0. ``counted`` says that ``df`` already is the result of ``value_counts``.
    """
    keys = list(keys)
    counts = df if counted else value_counts(df, keys, value)
    running = running_sums(counts, keys, [F.asc(value)], {"_upto": "_n"}, True, range_rows)
    sizes = counts.groupBy(*keys).agg(F.sum("_n").alias("_size"))
    if keys:
        ranked = attach(running, sizes, keys)
    else:
        ranked = running.withColumn("_size", sizes.scalar())

    def value_at(rank: Column) -> Column:
        """Smallest value whose running count exceeds ``rank`` (0-based)."""
        return F.min(F.when(F.col("_upto") > rank, F.col(value)))

    aggregates, outputs = [], []
    for i, (name, p) in enumerate(probabilities.items()):
        if method == "linear":
            position = F.lit(float(p)) * (F.col("_size") - 1)
            aggregates += [
                value_at(F.floor(position)).alias(f"_low{i}"),
                value_at(F.ceil(position)).alias(f"_high{i}"),
                F.max(position - F.floor(position)).alias(f"_part{i}"),
            ]
            low, high = F.col(f"_low{i}"), F.col(f"_high{i}")
            outputs.append((low + (high - low) * F.col(f"_part{i}")).alias(name))
        elif method == "lower":
            rank = F.greatest(F.ceil(F.lit(float(p)) * F.col("_size")) - 1, F.lit(0))
            aggregates.append(value_at(rank).alias(name))
            outputs.append(F.col(name))
        elif method == "index":
            rank = F.least(F.floor(F.lit(float(p)) * F.col("_size")), F.col("_size") - 1)
            aggregates.append(value_at(rank).alias(name))
            outputs.append(F.col(name))
        else:
            raise ValueError(f"unknown percentile method {method!r}")
    grouped = ranked.groupBy(*keys).agg(*aggregates, F.max("_size").alias("n"))
    return grouped.select(*keys, *outputs, "n")
