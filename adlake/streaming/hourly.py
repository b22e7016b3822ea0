"""Streaming twin of the bucketed aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.operators.aggregate import Aggregation

BUCKETS = {"minute": "1 minute", "hour": "1 hour", "day": "1 day"}


def stream_aggregate(
    stream: DataFrame,
    group_by: Sequence[str],
    aggregations: Sequence[Aggregation],
    time_column: str,
    bucket: str = "hour",
    lateness: str = "1 hour",
) -> DataFrame:
    """Aggregates per (time bucket, dims) over a stream. A bucket is final once the watermark has passed its end; rows
    later than ``lateness`` are dropped, and state is kept for open buckets only.

    ``first``, ``last`` and ``count_distinct`` are left to the batch form.
    """
    for a in aggregations:
        if a.agg_func == "count_distinct":
            raise ValueError("count_distinct cannot be kept exactly in streaming state; operators.sketches.stream_states keeps an estimate")
    timed = stream.withColumn("_ts", F.col(time_column).cast("timestamp")).withWatermark("_ts", lateness)
    window = F.window("_ts", BUCKETS[bucket])
    out = timed.groupBy(window.alias("_w"), *group_by).agg(*[a.column(stream) for a in aggregations])
    return out.select(
        F.col("_w.start").cast("timestamp_ntz").alias("time_bucket"), *[c for c in out.columns if c != "_w"]
    )
