"""Scalar helpers: Column in, Column out. All stay inside generated JVM code."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the text that stands for NULL inside a surrogate key.
NULL_KEY_TEXT = "_dbt_utils_surrogate_key_null_"

ColumnLike = Column | str


def as_column(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rename_project(df: DataFrame, names: Mapping[str, str], strict: bool = True) -> DataFrame:
    """Keep the listed columns under new names, in the listed order.

    ``strict=False`` skips listed columns that ``df`` lacks, for reduced inputs.
    """
    present = set(df.columns)
    missing = [old for old in names if old not in present]
    if strict and missing:
        raise ValueError(f"columns not in the input: {', '.join(missing)}")
    return df.select(*[F.col(old).alias(new) for old, new in names.items() if old in present])


def select_except(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def select_subset(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*names)


def map_codes(c: ColumnLike, labels: Mapping[str, str]) -> Column:
    """Code to label; unlisted codes and NULL give NULL."""
    out = None
    for code, label in labels.items():
        hit = as_column(c) == F.lit(code)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    if out is None:
        raise ValueError("map_codes needs at least one code")
    return out


def case_when(*branches: tuple[Column, object], otherwise: object = None) -> Column:
    """Searched CASE: the first branch whose condition holds."""
    (first, value), *rest = branches
    out = F.when(first, value)
    for condition, value in rest:
        out = out.when(condition, value)
    return out if otherwise is None else out.otherwise(otherwise)


def initcap(c: ColumnLike) -> Column:
    """Title case. Spark starts a new word after blanks only, not after punctuation."""
    return F.initcap(as_column(c))


def round_to(c: ColumnLike, places: int = 0) -> Column:
    """Half-up rounding; give it decimals where the last digit matters."""
    return F.round(as_column(c), places)


def cents_to_dollars(c: ColumnLike, variant: str = "default") -> Column:
    """Whole cents to currency units.

    ``default``  divide exactly, then fix two decimal places, half up.
    ``pre_cast`` fix two places first, then divide: fractions of a cent survive.
    ``rounded``  divide to nine places, then round to two, half up.
    ``cast``     divide as it stands, then cast to two places.
    """
    c = as_column(c)
    if variant == "default":
        return (c.cast("decimal(18,0)") / F.lit(Decimal(100))).cast("decimal(16,2)")
    if variant == "pre_cast":
        return c.cast("decimal(16,2)") / F.lit(Decimal(100))
    if variant == "rounded":
        return F.round((c.cast("decimal(18,2)") / F.lit(Decimal(100))).cast("decimal(38,9)"), 2)
    if variant == "cast":
        return (c.cast("decimal(18,2)") / F.lit(Decimal(100))).cast("decimal(16,2)")
    raise ValueError(f"unknown variant {variant!r}")


def scale_by(c: ColumnLike, factor: str | int | Decimal) -> Column:
    """Multiply by an exact constant, given as text or Decimal."""
    return as_column(c) * F.lit(Decimal(factor))


def flag_equals(c: ColumnLike, value: object) -> Column:
    """Equality as a plain boolean: NULL counts as false."""
    return F.coalesce(as_column(c) == F.lit(value), F.lit(False))


def derived_flag(c: ColumnLike, threshold: object) -> Column:
    """``c > threshold``; NULL stays NULL."""
    return as_column(c) > F.lit(threshold)


def to_date(c: ColumnLike) -> Column:
    return as_column(c).cast("date")


def trunc_day(c: ColumnLike, to: str = "timestamp_ntz") -> Column:
    """Midnight of the day. Goes through DATE, so the session time zone plays no part."""
    return as_column(c).cast("date").cast(to)


def trunc_month(c: ColumnLike) -> Column:
    """First day of the month, as a date."""
    return F.trunc(as_column(c), "month")


def date_shift(c: ColumnLike, unit: str, n: int) -> Column:
    """Move a date by whole days, months or years; month ends are clipped."""
    c = as_column(c)
    if unit == "day":
        return F.date_add(c, n)
    if unit in ("month", "year"):
        return F.add_months(c, n if unit == "month" else 12 * n)
    raise ValueError(f"unknown unit {unit!r}")


def surrogate_key(columns: Sequence[ColumnLike]) -> Column:
    """One text key out of several columns."""
    parts = [F.coalesce(as_column(c).cast("string"), F.lit(NULL_KEY_TEXT)) for c in columns]
    return F.md5(F.concat_ws("-", *parts))


def concat_qualified(*parts: ColumnLike, quote: str = "", sep: str = ".") -> Column:
    """Dotted name; NULL parts are left out."""
    return F.concat_ws(sep, *[F.concat(F.lit(quote), as_column(p), F.lit(quote)) for p in parts])


def starts_with_ci(c: ColumnLike, prefix: str) -> Column:
    """Case-insensitive prefix test in which ``_`` and ``%`` have no special meaning."""
    return F.upper(as_column(c)).startswith(prefix.upper())


def ilike_filter(df: DataFrame, c: ColumnLike, pattern: str = "%", exclude: str = "") -> DataFrame:
    """Rows whose text matches ``pattern`` and does not match ``exclude``, ignoring case."""
    return df.filter(as_column(c).ilike(pattern) & ~as_column(c).ilike(exclude))


def not_null_filter(df: DataFrame, *names: str) -> DataFrame:
    for name in names:
        df = df.filter(F.col(name).isNotNull())
    return df


def in_list(c: ColumnLike, values: Iterable[object]) -> Column:
    """Membership in a short literal list; an empty list holds nothing."""
    return as_column(c).isin(list(values))


def not_in_list(c: ColumnLike, values: Iterable[object]) -> Column:
    return ~in_list(c, values)


def range_filter(df: DataFrame, c: ColumnLike, low: object, high: object) -> DataFrame:
    """Both bounds are strict; either may be None for open."""
    c = as_column(c)
    if low is not None:
        df = df.filter(c > low)
    if high is not None:
        df = df.filter(c < high)
    return df


def mask_column(c: ColumnLike, is_member: Column | bool, redacted: str = "REDACTED") -> Column:
    """The value for members, a fixed text for everybody else (also when membership is unknown)."""
    allowed = is_member if isinstance(is_member, Column) else F.lit(is_member)
    return F.when(allowed, as_column(c).cast("string")).otherwise(F.lit(redacted))


def safe_ratio(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """Division that gives NULL for a zero or NULL denominator."""
    return F.try_divide(as_column(numerator), as_column(denominator))
