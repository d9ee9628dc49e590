"""Panel against baseline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions.calendar import col
from panelspark.functions.numbers import ratio
from panelspark.levels import Level
from panelspark.operators.filters import day_group_slice, with_baseline_name
from panelspark.operators.joins import left_many_to_one


def compare(panel: DataFrame, baseline: DataFrame, level: Level) -> DataFrame:
    """Each cell with its baseline and their ratio; a baseline key that occurs twice fails the query."""
    named = baseline.withColumnRenamed("ridership", "baseline")
    joined = left_many_to_one(panel, named, level.baseline_key, "baseline", f"{level.name} baseline")
    return joined.withColumn("baseline_comparison", ratio(F.col("ridership"), F.col("baseline"))).select(
        *[col(c) for c in level.final_columns]
    )


def compare_totals(panel: DataFrame, baseline: DataFrame, level: Level) -> DataFrame:
    """Monthly totals against a baseline of any schema; baseline rows of one key are added up first."""
    totals = day_group_slice(panel, "total", f"{level.name} ridership")
    base = with_baseline_name(day_group_slice(baseline, "total", f"{level.name} baseline"))
    keys = [*level.keys, "month"]
    one = collapse(base, keys)
    out = totals.join(one, keys, "left").withColumn(
        "baseline_comparison", ratio(F.col("ridership"), F.col("baseline_ridership"))
    )
    order = [*level.keys, "year", "month", "period", "ridership", "baseline_ridership", "baseline_comparison", "omny_pct"]
    return out.select(*[col(c) for c in order if c in out.columns])


def collapse(baseline: DataFrame, keys: list[str], measure: str = "baseline_ridership") -> DataFrame:
    return baseline.groupBy(*[col(k) for k in keys]).agg(F.sum(col(measure)).alias(measure))


def comparison_summary(final: DataFrame) -> DataFrame:
    """Mean, smallest and largest ratio, and how many cells have one."""
    c = F.col("baseline_comparison")
    mean = F.sum(c.cast("decimal(24,4)")).cast("double") / F.count(c)
    return final.agg(
        F.count(c).alias("compared"),
        F.when(F.count(c) > 0, mean).alias("mean_comparison"),
        F.min(c).alias("min_comparison"),
        F.max(c).alias("max_comparison"),
    )


def baseline_problems(final: DataFrame, key: str = "complex_id", baseline: str = "baseline") -> DataFrame:
    """Entities with a missing or a non-positive baseline, and how many of their rows are affected.

    One row per entity and problem, so the report stays distributed however many there are.
    """
    problem = F.when(col(baseline).isNull(), "missing").when(col(baseline) <= 0, "non_positive")
    return (
        final.withColumn("problem", problem)
        .filter(F.col("problem").isNotNull())
        .groupBy("problem", col(key))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
