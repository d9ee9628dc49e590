"""A fact that lands by month, with the days of each month kept beside it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.functions.calendar import col, day_bit
from panelspark.operators.monthly import completeness_of_masks, year_month
from panelspark.operators.months import month_list
from panelspark.sources.publishing import MONTHS, OWN, Version, current, month_parts, propagate, publish, read_version


def land_fact(df: DataFrame, path: str, time: str) -> Version:
    """Publish rows by year and month; the months they are in are replaced, others stay."""
    return publish(df.select("*", *year_month(time)), path, MONTHS, OWN)


def day_masks(spark: SparkSession, path: str, time: str) -> DataFrame:
    """``year, month, mask, rows`` of a landed fact: a bit for every day that has rows.

    The table lies beside the fact and follows it month by month: only months that landed since the last call are
    looked at, and of these the time column alone.
    """
    fact, beside = current(spark, path), f"{path.rstrip('/')}-days"
    if fact is None:
        raise ValueError(f"nothing has landed at {path}")

    def build(parts: list[str]) -> DataFrame:
        rows = read_version(spark, path, fact, parts).filter(col(time).isNotNull())
        return rows.groupBy(*MONTHS).agg(F.bit_or(day_bit(time)).alias("mask"), F.count(F.lit(1)).alias("rows"))

    return read_version(spark, beside, propagate(fact, beside, current(spark, beside), time, build))


def complete_landed_months(spark: SparkSession, path: str, time: str) -> list[tuple[int, int]]:
    return month_list(completeness_of_masks(day_masks(spark, path, time)).filter("complete"))


def complete_rows(spark: SparkSession, path: str, time: str) -> DataFrame:
    """The landed rows of complete months: those folders are read once, others not at all."""
    months = complete_landed_months(spark, path, time)
    return read_version(spark, path, current(spark, path), month_parts(months))
