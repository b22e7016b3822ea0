"""Labelled bins as Column expressions, and boundary generators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from adlake.functions import vocab
from adlake.functions.scalar import ColumnLike, as_column


def label_bins(
    c: ColumnLike,
    bounds: Sequence[ColumnLike | float],
    labels: Sequence[str],
    unknown: str = vocab.EMPTY,
    nonpositive_unknown: bool = True,
) -> Column:
    """Right-closed bins: the first bound that is not below the value names the label.

    ``bounds`` may be numbers or Columns (per-group thresholds).
    """
    if len(labels) != len(bounds) + 1:
        raise ValueError("there must be one label more than there are bounds")
    value = as_column(c)
    missing = value.isNull() | (value <= 0) if nonpositive_unknown else value.isNull()
    out = F.when(missing, F.lit(unknown))
    for bound, label in zip(bounds, labels):
        out = out.when(value <= bound, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def range_labels(bounds: Sequence[float]) -> list[str]:
    """(0,a], (a,b], … >z for bounds a, b … z."""
    text = [format(b, "g") if isinstance(b, float) and b == int(b) else str(b) for b in bounds]
    inner = [f"({low},{high}]" for low, high in zip(["0", *text], text)]
    return [*inner, f">{text[-1]}"]


def numbered_labels(n: int) -> list[str]:
    return [f"bucket_{i}" for i in range(1, n + 1)]


def hour_gap_bin(c: ColumnLike) -> Column:
    return label_bins(c, vocab.HOUR_GAP_BOUNDS, range_labels(vocab.HOUR_GAP_BOUNDS), unknown=vocab.OTHERS)


def price_bin(c: ColumnLike) -> Column:
    return label_bins(c, vocab.PRICE_BOUNDS, range_labels(vocab.PRICE_BOUNDS))


def request_count_bin(c: ColumnLike) -> Column:
    return label_bins(c, vocab.REQUEST_COUNT_BOUNDS, range_labels(vocab.REQUEST_COUNT_BOUNDS))


def price_variance_bin(c: ColumnLike) -> Column:
    return label_bins(c, vocab.PRICE_VARIANCE_BOUNDS, range_labels(vocab.PRICE_VARIANCE_BOUNDS))


def fixed_bins(
    c: ColumnLike, bounds: Sequence[float], labels: Sequence[str] | None = None, unknown: str = "unknown"
) -> Column:
    """Fixed thresholds over any range, zero and below included; only NULL is unknown."""
    names = list(labels) if labels is not None else numbered_labels(len(bounds) + 1)
    return label_bins(c, bounds, names, unknown=unknown, nonpositive_unknown=False)


def even_bounds(n: int, low: float = -2.5, high: float = 2.5) -> list[float]:
    """Inner boundaries of ``n`` even buckets on [low, high]."""
    if n < 2:
        raise ValueError("at least two buckets are needed")
    step = (high - low) / n
    return [low + step * i for i in range(1, n)]


def share_bounds(n: int, power: float = 0.5) -> list[float]:
    """Inner boundaries (i/n)^power of ``n`` buckets on [0, 1]."""
    if n < 2:
        raise ValueError("at least two buckets are needed")
    return [(i / n) ** power for i in range(1, n)]


def normalised_bin(c: ColumnLike, n: int, low: float = -2.5, high: float = 2.5) -> Column:
    return fixed_bins(c, even_bounds(n, low, high))


def share_bin(c: ColumnLike, n: int, power: float = 0.5) -> Column:
    return fixed_bins(c, share_bounds(n, power))
