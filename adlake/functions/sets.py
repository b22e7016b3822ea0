"""Similarity of two sets held in array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adlake.functions.scalar import ColumnLike, as_column


def jaccard(a: ColumnLike, b: ColumnLike) -> Column:
    """|A∩B| / |A∪B|, 0 for two empty sets."""
    x, y = as_column(a), as_column(b)
    union = F.size(F.array_union(x, y))
    return F.when(union > 0, F.try_divide(F.size(F.array_intersect(x, y)), union)).otherwise(F.lit(0.0))


def overlap(a: ColumnLike, b: ColumnLike) -> Column:
    """|A∩B| / min(|A|, |B|), 0 if either is empty."""
    x, y = F.array_distinct(as_column(a)), F.array_distinct(as_column(b))
    smaller = F.least(F.size(x), F.size(y))
    return F.when(smaller > 0, F.try_divide(F.size(F.array_intersect(x, y)), smaller)).otherwise(F.lit(0.0))
