"""Rolling sums over the seconds before a row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlake.functions.scalar import epoch_seconds
from adlake.operators.running import attach

# Length of a time slice, in longest windows. Longer slices copy fewer border rows, shorter ones hold fewer rows.
SLICE_WINDOWS = 16


def rolling_sums(
    df: DataFrame,
    dims: Sequence[str],
    time_column: str,
    windows: Mapping[str, int],
    columns: Sequence[str],
    one_row_per_time: bool = False,
) -> DataFrame:
    """Add ``{column}_{window}``: the sum over the ``n`` seconds before the row, the row's own second excluded.

    Rows without history get 0. Time is cut into slices, and rows in the last window of a slice are copied into the
    next one as history, so a group is (dims, slice) and stays small however hot the dims are. Unless the input has one
    row per (dims, second), it is summed to that first and the result is joined back.
    """
    longest = max(windows.values())
    slice_seconds = longest * SLICE_WINDOWS
    keys = list(dims)
    if one_row_per_time:
        base = df.withColumn("_second", epoch_seconds(time_column))
    else:
        raw = df.withColumn("_second", epoch_seconds(time_column))
        base = raw.groupBy(*keys, "_second").agg(*[F.sum(c).alias(c) for c in columns])

    own = F.floor(F.col("_second") / slice_seconds)
    needed_later = F.pmod(F.col("_second"), F.lit(slice_seconds)) >= slice_seconds - longest
    placed = base.select(
        "*",
        own.alias("_own"),
        F.explode(F.when(needed_later, F.array(own, own + 1)).otherwise(F.array(own))).alias("_slice"),
    )
    order = Window.partitionBy(*keys, "_slice").orderBy("_second")
    sums = []
    for name, seconds in windows.items():
        frame = order.rangeBetween(-seconds, -1)
        for column in columns:
            zero = F.lit(0).cast(base.schema[column].dataType)
            sums.append(F.coalesce(F.sum(column).over(frame), zero).alias(f"{column}_{name}"))
    rolled = placed.select("*", *sums).where(F.col("_slice").eqNullSafe(F.col("_own"))).drop("_slice", "_own")
    if one_row_per_time:
        return rolled.drop("_second")
    outputs = rolled.drop(*columns)
    return attach(raw, outputs, [*keys, "_second"]).drop("_second")
