"""Keys, names, year lists and sort keys as column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelspark.functions.calendar import col
from panelspark.specs import DAY_GROUPS


def category(text: str | Column) -> Column:
    """Upper-cased category; a missing one is the empty category, not dropped."""
    return F.coalesce(F.upper(col(text)), F.lit(""))


def joined_key(*parts: str | Column) -> Column:
    """Parts joined by ``_``; missing when any part is missing."""
    pieces: list[Column] = []
    for part in parts:
        pieces += [F.lit("_"), col(part)]
    return F.concat(*pieces[1:])


def full_name(stop: str | Column, display: str | Column, separator: str = " ") -> Column:
    return F.concat(col(stop), F.lit(separator), col(display))


def year_list(text: str | Column) -> Column:
    """Comma-separated years as an array; a bad year fails the query."""
    return F.transform(F.split(col(text), ","), lambda y: F.trim(y).cast("int"))


def year_list_is_valid(text: str | Column) -> Column:
    parts = F.split(F.coalesce(col(text), F.lit("")), ",")
    return F.forall(parts, lambda y: F.trim(y).try_cast("int").isNotNull())


def int_array(values: Iterable[int]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<int>")


def valid_years(years: Column, month: Column, bad_periods: Sequence[tuple[int, int]]) -> Column:
    """The years that count for a month: the given ones without bad (year, month) periods."""
    bad: dict[int, list[int]] = {}
    for y, m in bad_periods:
        bad.setdefault(m, []).append(y)
    out = years
    for m, ys in bad.items():
        out = F.when(month == m, F.array_except(out, int_array(ys))).otherwise(out)
    return out


def id_order(ident: str | Column) -> Column:
    """Numeric order for text ids; ids that are not numbers give null, to be sorted last."""
    return col(ident).cast("string").try_cast("bigint")


def enum_order(value: str | Column, order: Sequence[str] = DAY_GROUPS) -> Column:
    return F.array_position(F.array(*[F.lit(v) for v in order]), col(value))


def compact_json(nested: str | Column) -> Column:
    return F.to_json(col(nested))


def without_json_spaces(text: str | Column) -> Column:
    """JSON text without the white space between its tokens; quoted strings stay as they are."""
    return F.regexp_replace(col(text), r'("(?:[^"\\]++|\\.)*+")|\s+', "$1")
