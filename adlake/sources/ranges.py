"""Time ranges: what to scan and what to keep."""

from __future__ import annotations

import math
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.functions.scalar import ColumnLike, as_column


@dataclass(frozen=True)
class TimeRange:
    """``start`` is inclusive. ``end`` is exclusive if it has a time part; a bare date means that whole day."""

    start: str | None = None
    end: str | None = None

    def lower(self, lookback_hours: int = 0) -> datetime | None:
        if self.start is None:
            return None
        return datetime.fromisoformat(self.start) - timedelta(hours=lookback_hours)

    def upper(self) -> datetime | None:
        """First moment outside the range."""
        if self.end is None:
            return None
        whole_day = len(self.end.strip()) <= 10
        return datetime.fromisoformat(self.end) + timedelta(days=1 if whole_day else 0)

    def predicate(self, time_column: ColumnLike, lookback_hours: int = 0) -> Column | None:
        """Typed bounds, so that the filter reaches the file scan."""
        c = as_column(time_column)
        tests = []
        if (low := self.lower(lookback_hours)) is not None:
            tests.append(c >= timestamp_literal(low))
        if (high := self.upper()) is not None:
            tests.append(c < timestamp_literal(high))
        if not tests:
            return None
        return tests[0] if len(tests) == 1 else tests[0] & tests[1]

    def days(self, lookback_hours: int = 0) -> list[str]:
        """Every calendar day that the (widened) range touches."""
        low, high = self.lower(lookback_hours), self.upper()
        if low is None or high is None:
            raise ValueError("both ends of the range are needed to list its days")
        last = (high - timedelta(microseconds=1)).date()
        return day_list(low.date(), last)


def timestamp_literal(moment: datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def day_list(first: date, last: date) -> list[str]:
    return [(first + timedelta(days=i)).isoformat() for i in range((last - first).days + 1)]


def lookback_hours(window_seconds: list[int]) -> int:
    """Whole hours of history that the longest window needs."""
    return math.ceil(max(window_seconds, default=0) / 3600)


def within(df: DataFrame, time_column: str, time_range: TimeRange | None, lookback: int = 0) -> DataFrame:
    test = time_range.predicate(time_column, lookback) if time_range else None
    return df if test is None else df.where(test)


def trim(df: DataFrame, time_range: TimeRange | None, bucket_column: str = "time_bucket") -> DataFrame:
    """Drop history rows that were read only to feed windows."""
    return within(df, bucket_column, time_range)


def date_spine(spark: SparkSession, first: str, last: str, column: str = "day") -> DataFrame:
    """One row per day, both ends included."""
    bounds = spark.range(1).select(F.lit(first).cast("date").alias("a"), F.lit(last).cast("date").alias("b"))
    return bounds.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias(column))


def fill_days(df: DataFrame, date_column: str, first: str, last: str) -> DataFrame:
    """Left-join ``df`` to the spine: days without data appear once, with NULLs."""
    spine = date_spine(df.sparkSession, first, last, "_day")
    joined = spine.join(df, spine["_day"] == df[date_column], "left")
    return joined.drop(date_column).withColumnRenamed("_day", date_column)
