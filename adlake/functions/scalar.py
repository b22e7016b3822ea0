"""Scalar features as Column expressions. A name or a Column is accepted wherever a column is."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from adlake.functions import vocab

ColumnLike = Column | str


def as_column(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def empty_to(c: ColumnLike, sentinel: str = vocab.EMPTY) -> Column:
    """NULL and '' become ``sentinel``; blanks are values and stay."""
    text = as_column(c).cast("string")
    return F.when(text.isNull() | (text == ""), F.lit(sentinel)).otherwise(text)


def keep_listed(c: ColumnLike, allowed: Sequence[str], fallback: str = vocab.OTHERS, lower: bool = True) -> Column:
    """Keep listed values, in lower case unless told otherwise; the rest, NULL included, become ``fallback``."""
    text = F.lower(as_column(c)) if lower else as_column(c)
    return F.when(text.isin(*allowed), text).otherwise(F.lit(fallback))


def top_country(c: ColumnLike) -> Column:
    return keep_listed(c, vocab.TOP_COUNTRIES)


def top_make(c: ColumnLike) -> Column:
    return keep_listed(c, vocab.TOP_MAKES)


def top_model(c: ColumnLike) -> Column:
    return keep_listed(c, vocab.TOP_MODELS)


def us_or(c: ColumnLike, other: str) -> Column:
    """'US' stays, everything else (NULL included) becomes ``other``."""
    return F.when(as_column(c) == "US", F.lit("US")).otherwise(F.lit(other))


def remap(c: ColumnLike, mapping: Mapping[str, str], default: Column | None = None) -> Column:
    """Replace listed values; ``default`` is the value for the rest (the column itself if omitted)."""
    source = as_column(c)
    out: Column | None = None
    for old, new in mapping.items():
        out = F.when(source == old, F.lit(new)) if out is None else out.when(source == old, F.lit(new))
    rest = source if default is None else default
    return rest if out is None else out.otherwise(rest)


def ad_type_group(c: ColumnLike) -> Column:
    return remap(empty_to(c), vocab.AD_TYPE_GROUPS)


def impression_type(c: ColumnLike) -> Column:
    return remap(c, vocab.IMPRESSION_TYPES, F.lit("playable"))


def major_version(c: ColumnLike) -> Column:
    """Text before the first dot or blank; NULL and '' give '-1'."""
    text = as_column(c)
    return F.when(text.isNull() | (text == ""), F.lit(vocab.NO_VERSION)).otherwise(F.split(text, "[. ]")[0])


def flag_text(c: ColumnLike) -> Column:
    """Boolean as '0' / '1', NULL counted as false."""
    return F.coalesce(as_column(c).cast("boolean"), F.lit(False)).cast("int").cast("string")


def positive(c: ColumnLike) -> Column:
    return F.when(as_column(c) > 0, 1).otherwise(0)


def fixed_decimals(c: ColumnLike, digits: int = 3) -> Column:
    return F.format_string(f"%.{digits}f", as_column(c).cast("double"))


def minute_of_hour(c: ColumnLike) -> Column:
    return F.minute(as_column(c))


def minute_text(c: ColumnLike) -> Column:
    return F.format_string("%02d", F.minute(as_column(c)))


def day_of_week(c: ColumnLike) -> Column:
    """0 for Sunday to 6 for Saturday."""
    return F.dayofweek(as_column(c)) - 1


def first_contained(c: ColumnLike, needles: Iterable[str], fallback: str = vocab.OTHERS) -> Column:
    """The first of ``needles`` that occurs in the text, letter case counted."""
    text = as_column(c)
    out: Column | None = None
    for needle in needles:
        hit = text.contains(needle)
        out = F.when(hit, F.lit(needle)) if out is None else out.when(hit, F.lit(needle))
    return F.lit(fallback) if out is None else out.otherwise(F.lit(fallback))


def sdk_supply(c: ColumnLike) -> Column:
    return first_contained(c, vocab.SDK_SUPPLIES)


def offset_capped(c: ColumnLike, add: float, cap: float) -> Column:
    moved = as_column(c) + F.lit(float(add))
    return F.when(moved > cap, F.lit(float(cap))).otherwise(moved)


def device_value_group(country: ColumnLike, ad_type: ColumnLike, price: ColumnLike, cut_off: float = 10) -> Column:
    """'all' outside US video; there 'high' above the cut, 'low' above zero, else 'unknown'.

    A NULL country or ad type does not by itself make a row 'all': NULL OR true is true, NULL OR false is not.
    """
    value = as_column(price)
    outside = (as_column(country) != "US") | (as_column(ad_type) != "video")
    return F.when(outside, "all").when(value > cut_off, "high").when(value > 0, "low").otherwise("unknown")


def pick_by(selector: ColumnLike, columns: Mapping[str, str], present: Sequence[str], default: float = 0.0) -> Column:
    """Value of the column that ``selector`` names; absent columns are skipped."""
    chosen = as_column(selector)
    out: Column | None = None
    for value, name in columns.items():
        if name in present:
            out = F.when(chosen == value, F.col(name)) if out is None else out.when(chosen == value, F.col(name))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def hours_between(later: ColumnLike, earlier: ColumnLike) -> Column:
    """Hours between two columns of epoch seconds."""
    return (as_column(later) - as_column(earlier)) / F.lit(3600.0)


def translate_code(c: ColumnLike, codes: Mapping[str, str]) -> Column:
    """Look a code up in a small literal map; unknown codes pass through, NULL stays NULL."""
    if not codes:
        return as_column(c)
    pairs = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    return F.coalesce(F.try_element_at(pairs, as_column(c)), as_column(c))


def decoded_json(c: ColumnLike, schema: str) -> Column:
    """Base64 text holding a JSON document, as a struct."""
    return F.from_json(F.unbase64(as_column(c)).cast("string"), schema)


def feature_key(columns: Sequence[ColumnLike]) -> Column:
    """One text key from several columns; NULL parts keep a place of their own."""
    parts = [F.coalesce(as_column(c).cast("string"), F.lit(vocab.NULL_KEY)) for c in columns]
    return F.concat_ws(vocab.KEY_SEPARATOR, *parts)


def date_hour(c: ColumnLike) -> Column:
    return F.date_format(as_column(c), "yyyy-MM-dd HH")


def time_bucket(c: ColumnLike, granularity: str) -> Column:
    """Start of the minute, hour or day, without a time zone."""
    if granularity not in ("minute", "hour", "day"):
        raise ValueError(f"unknown time bucket {granularity!r}")
    return F.date_trunc(granularity, as_column(c)).cast("timestamp_ntz")


def epoch_seconds(c: ColumnLike) -> Column:
    return as_column(c).cast("timestamp").cast("long")


def date_text(c: ColumnLike) -> Column:
    return F.date_format(as_column(c), "yyyy-MM-dd")


def hour_text(c: ColumnLike) -> Column:
    return F.date_format(as_column(c), "HH")


def token_id(c: ColumnLike, dtype: str, hash_with: str = "xxhash64") -> Column:
    """Stable token number: whole numbers as they are, NULL and NaN 0, text a 62-bit hash (60 bits with md5, which any
    engine can compute)."""
    value = as_column(c)
    if dtype in ("tinyint", "smallint", "int", "bigint"):
        return F.coalesce(value.cast("bigint"), F.lit(0).cast("bigint"))
    if dtype in ("float", "double"):
        return F.when(value.isNull() | F.isnan(value), F.lit(0).cast("bigint")).otherwise(value.cast("bigint"))
    if hash_with == "md5":
        hashed = F.conv(F.substring(F.md5(value.cast("string")), 1, 15), 16, 10).cast("bigint")
    else:
        hashed = F.pmod(F.xxhash64(value.cast("string")), F.lit(1 << 62))
    return F.when(value.isNull(), F.lit(0).cast("bigint")).otherwise(hashed)


def net_requests(total: ColumnLike, multiplied: ColumnLike) -> Column:
    return as_column(total) - F.coalesce(as_column(multiplied), F.lit(0))


def ratio_or_zero(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """0.0 unless the denominator is positive."""
    below = as_column(denominator)
    return F.when(below > 0, F.try_divide(as_column(numerator), below)).otherwise(F.lit(0.0))


# Contract rules ------------------------------------------------------------------------------


def apply_case(c: Column, case: str | None) -> Column:
    return {"lowercase": F.lower, "uppercase": F.upper}.get(case or "", lambda x: x)(c)


def only_allowed(c: Column, allowed: Sequence, fallback) -> Column:
    return F.when(c.isin(*allowed), c).otherwise(F.lit(fallback))


def clamp(c: Column, low: float | None = None, high: float | None = None) -> Column:
    """Keep a value inside [low, high]. NULL stays NULL (``greatest``/``least`` would fill it)."""
    if low is not None:
        c = F.when(c < low, F.lit(low)).otherwise(c)
    if high is not None:
        c = F.when(c > high, F.lit(high)).otherwise(c)
    return c
