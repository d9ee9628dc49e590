"""Which months to compute, and how refreshed months replace stored ones."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.operators.filters import not_in_future


def candidate_months(
    sources: DataFrame, as_of: date, year: int | None = None, month: int | None = None
) -> DataFrame:
    """Months of the configured years that have begun: (year, month, source)."""
    if month is not None and year is None:
        raise ValueError("month requires year")
    if month is not None and not 1 <= month <= 12:
        raise ValueError("month must be in 1..12")
    wanted = sources if year is None else sources.filter(F.col("year") == year)
    months = F.sequence(F.lit(1), F.lit(12)) if month is None else F.array(F.lit(month))
    every = wanted.select(F.col("year").cast("int").alias("year"), F.explode(months).alias("month"), "source")
    return not_in_future(every, as_of)


def future_months(sources: DataFrame, as_of: date) -> DataFrame:
    """Months of the configured years that have not begun."""
    every = sources.select(
        F.col("year").cast("int").alias("year"), F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month")
    )
    return every.join(not_in_future(every, as_of), ["year", "month"], "left_anti")


def route_years(years: DataFrame, sources: DataFrame) -> DataFrame:
    """The source of each year; a year that has none is marked as skipped."""
    return years.join(sources, "year", "left").withColumn("skipped", F.col("source").isNull())


def missing_months(candidates: DataFrame, stored: DataFrame) -> DataFrame:
    """Candidate months the stored panel does not have."""
    return candidates.join(stored.select("year", "month").distinct(), ["year", "month"], "left_anti")


def upsert_months(stored: DataFrame, fresh: DataFrame, replaced: DataFrame | None = None) -> DataFrame:
    """The stored panel with the months of ``fresh`` replaced; other months stay as they are.

    ``replaced`` names those months where they are known more cheaply than from ``fresh`` itself.
    They are few, so they travel as one array value and the stored panel is filtered where it lies.
    """
    serial = F.col("year") * 12 + F.col("month")
    gone = (fresh if replaced is None else replaced).agg(F.collect_set(serial)).scalar()
    return stored.filter(~F.array_contains(gone, serial)).unionByName(fresh.select(*stored.columns))


def month_list(months: DataFrame) -> list[tuple[int, int]]:
    """The months as a Python list, to be used as scan ranges; bounded by the calendar."""
    rows = months.select("year", "month").distinct().orderBy("year", "month").collect()
    return [(r["year"], r["month"]) for r in rows]
