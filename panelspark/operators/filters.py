"""Filters, projections and duplicate-free selections."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.functions.calendar import col, in_months, minute_second, month_start
from panelspark.functions.numbers import whole_sum
from panelspark.specs import (
    ALLOWED_DIVISIONS,
    BAD_PERIODS,
    DAY_GROUPS,
    EXCLUDED_COMPLEXES,
    EXCLUDED_STATIONS,
    REPORTING_MARKS,
    SUBWAY_MODES,
    FactSpec,
)


def in_scope(
    fact: DataFrame,
    spec: FactSpec = FactSpec(),
    modes: Sequence = SUBWAY_MODES,
    excluded: Sequence = EXCLUDED_COMPLEXES,
) -> DataFrame:
    """Rows of the wanted modes without the excluded entities; rows with no entity go too."""
    return fact.filter(col(spec.mode).isin(*modes) & ~col(spec.entity).isin(*excluded))


def in_month_list(fact: DataFrame, months: list[tuple[int, int]], spec: FactSpec = FactSpec()) -> DataFrame:
    """Rows of the given (year, month) periods: half-open ranges pushed to the scan, and folders skipped."""
    rows = fact.filter(in_months(spec.time, months))
    if spec.partitions is None or not months:
        return rows
    year, month = (col(c) for c in spec.partitions)
    folders = F.lit(False)
    for y in sorted({y for y, _ in months}):
        folders = folders | ((year == y) & month.isin(*sorted({m for yy, m in months if yy == y})))
    return rows.filter(folders)


def in_years(df: DataFrame, year: str, first: int, last: int) -> DataFrame:
    return df.filter(col(year).between(first, last))


def of_entity(fact: DataFrame, entity, spec: FactSpec = FactSpec()) -> DataFrame:
    """One entity's rows, or every row when no entity is asked for."""
    return fact if entity is None else fact.filter(col(spec.entity) == F.lit(entity))


def by_station_lists(
    readings: DataFrame,
    station: str = "STATION",
    division: str = "DIVISION",
    deny: Sequence = EXCLUDED_STATIONS,
    allow: Sequence = ALLOWED_DIVISIONS,
) -> DataFrame:
    """Drop denied stations, keep allowed divisions. A missing station is not a denied one."""
    denied = F.coalesce(col(station).isin(*deny), F.lit(False)) if deny else F.lit(False)
    return readings.filter(~denied & col(division).isin(*allow))


def at_reporting_marks(readings: DataFrame, clock: str | Column = "TIME", marks: Sequence = REPORTING_MARKS) -> DataFrame:
    return readings.filter(minute_second(clock).isin(*marks))


def without_bad_periods(
    sums: DataFrame, year: str = "year", month: str = "month", periods: Sequence[tuple[int, int]] = BAD_PERIODS
) -> DataFrame:
    keep = F.lit(True)
    for y, m in periods:
        keep = keep & ~((col(year) == y) & (col(month) == m))
    return sums.filter(keep)


def day_group_slice(df: DataFrame, group: str = "total", label: str = "table") -> DataFrame:
    """One day group's rows. A table with day groups but not this one is an error."""
    if "day_group" not in df.columns:
        return df
    part = df.filter(F.col("day_group") == group)
    if part.isEmpty():
        raise ValueError(f"{label}: day groups are there, {group} is not among them")
    return part


def not_in_future(months: DataFrame, as_of: date, year: str = "year", month: str = "month") -> DataFrame:
    """Months that have begun by ``as_of``."""
    return months.filter(month_start(year, month) <= F.trunc(F.lit(as_of), "MM"))


def with_key(df: DataFrame, key: str) -> DataFrame:
    return df.filter(col(key).isNotNull())


def missing_key_count(df: DataFrame, key: str) -> DataFrame:
    """How many rows there are, and how many lack the key and would be dropped."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(col(key).isNull()).alias("dropped"),
    )


def in_scope_ids(dim: DataFrame, key: str, route: str, out_of_scope, name: str | None = None) -> DataFrame:
    """Distinct ids of dimension rows that are in scope; a missing route is in scope."""
    rows = dim.filter(~col(route).eqNullSafe(F.lit(out_of_scope)))
    return rows.select(col(key).alias(name or key)).distinct()


def as_columns(df: DataFrame, columns: Sequence[str], renames: dict[str, str] | None = None) -> DataFrame:
    """Rename, then select in the given order."""
    back = {new: old for old, new in (renames or {}).items()}
    return df.select(*[col(back.get(c, c)).alias(c) for c in columns])


def drop_present(df: DataFrame, columns: Sequence[str] = ("C/A", "UNIT", "SCP", "DIVISION")) -> DataFrame:
    return df.drop(*[c for c in columns if c in df.columns])


def placed_after(columns: Sequence[str], key: str, name: str) -> list[str]:
    """The columns with ``name`` moved to the place after ``key``."""
    rest = [c for c in columns if c != name]
    at = rest.index(key) + 1
    return [*rest[:at], name, *rest[at:]]


def with_baseline_name(baseline: DataFrame, name: str = "baseline_ridership") -> DataFrame:
    """Give the measure of any baseline schema its common name."""
    for candidate in (name, "entries", "ridership"):
        if candidate in baseline.columns:
            return baseline.withColumnRenamed(candidate, name)
    raise ValueError(f"no known baseline measure among the columns {baseline.columns}")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first in ``order``; combined on the map side, so a key's rows never meet."""
    rest = [c for c in df.columns if c not in keys]
    picked = F.min_by(F.struct(*[col(c) for c in rest]), F.struct(*[col(c) for c in order]))
    return df.groupBy(*[col(k) for k in keys]).agg(picked.alias("_row")).select(
        *[col(k) for k in keys], *[F.col("_row")[c].alias(c) for c in rest]
    )


def set_difference(df: DataFrame, column: str, allowed: Sequence = DAY_GROUPS) -> DataFrame:
    """Values seen but not allowed, and allowed but not seen, one row each."""
    seen = df.select(col(column).alias("value")).distinct().filter(F.col("value").isNotNull())
    wanted = df.sparkSession.createDataFrame([(a,) for a in allowed], seen.schema)
    return (
        seen.join(wanted, "value", "left_anti")
        .withColumn("kind", F.lit("extra"))
        .unionByName(wanted.join(seen, "value", "left_anti").withColumn("kind", F.lit("missing")))
        .select("kind", "value")
    )


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """A bounded sample: the first n rows in a stated order."""
    return df.orderBy(*[col(c) for c in order]).limit(n)


def top_entities(df: DataFrame, key: str, measure: str, label: str, n: int = 10) -> DataFrame:
    """The n entities with the largest sum, each with its smallest label.

    Summing per label first lets the wide pass hash; only its result needs the smallest text.
    """
    per_label = df.groupBy(col(key), col(label)).agg(whole_sum(col(measure)).alias(measure))
    return (
        per_label.groupBy(col(key))
        .agg(F.sum(col(measure)).alias(measure), F.min(col(label)).alias(label))
        .orderBy(col(measure).desc(), col(key).asc())
        .limit(n)
    )
