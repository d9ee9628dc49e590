"""Parsing, rounding, shares and ratios as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelspark.functions.calendar import col


def round_even(x: Column, places: int) -> Column:
    """Round the scaled double half to even, then scale back."""
    scale = float(10**places)
    return F.rint(x * scale) / scale


def lenient_double(text: str | Column) -> Column:
    """A number, or 0.0 where the text is missing or not a number; type suffixes and ``NaN`` are no numbers."""
    value = col(text).try_cast("double")
    bad = F.isnan(value) | col(text).cast("string").rlike(r"[0-9.][dDfF]\s*$")
    return F.when(bad, 0.0).otherwise(F.coalesce(value, F.lit(0.0)))


def strict_bigint(text: str | Column, label: str = "ridership") -> Column:
    """A whole number, thousands separators allowed; anything else fails the query."""
    clean = F.regexp_replace(col(text).cast("string"), ",", "")
    value = clean.try_cast("decimal(38,6)")
    bad = clean.isNotNull() & (value.isNull() | ~clean.rlike(r"^\s*[+-]?[0-9]+(\.0*)?\s*$"))
    message = F.concat(F.lit(f"Failed to parse '{label}' as integer: "), clean)
    return F.when(bad, F.raise_error(message).cast("bigint")).otherwise(value.cast("bigint"))


def share(part: Column, whole: Column) -> Column:
    """Percent of the whole with two decimals; 0.0 when the whole is not positive."""
    return F.when(
        whole > 0, round_even(part.cast("double") / whole.cast("double") * 100.0, 2)
    ).otherwise(F.lit(0.0))


def share_or_null(part: Column, whole: Column) -> Column:
    """Percent of the whole with two decimals; null where the whole is zero."""
    return round_even(F.try_divide(part.cast("double"), whole.cast("double")) * 100.0, 2)


def ratio(value: Column, base: Column) -> Column:
    """Value over base with four decimals; null when the base is missing or not positive."""
    return F.when(base > 0, round_even(value.cast("double") / base.cast("double"), 4))


def part_from_share(whole: Column, percent: Column) -> Column:
    """The part a rounded percentage stands for, with two decimals."""
    return round_even(whole * percent / 100.0, 2)


def clip(x: Column, low: float, high: float) -> Column:
    """Bound a number; a missing number stays missing."""
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(low)), F.lit(high)))


def exact_sum(x: Column, places: int = 2) -> Column:
    """Sum of numbers kept to ``places`` decimals, the same in whatever order rows arrive; 0 for none."""
    kind = f"decimal({18 + places},{places})"
    return F.coalesce(F.sum(x.cast(kind)), F.lit(0).cast(kind)).cast("double")


def whole_sum(x: Column) -> Column:
    """Sum of whole numbers; 0 for no values."""
    return F.coalesce(F.sum(x), F.lit(0).cast("bigint"))
