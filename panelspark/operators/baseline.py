"""Multi-year baselines with per-entity valid years."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions.calendar import col
from panelspark.functions.numbers import exact_sum, round_even
from panelspark.functions.text import int_array, valid_years
from panelspark.operators.filters import without_bad_periods
from panelspark.operators.grid import baseline_grid, fill_grid
from panelspark.operators.monthly import add_total
from panelspark.specs import BAD_PERIODS, BASELINE_YEARS


def with_years(
    sums: DataFrame,
    special: DataFrame,
    years: Sequence[int],
    bad_periods: Sequence[tuple[int, int]],
    limit_special: bool,
) -> DataFrame:
    """Attach to each row its entity's valid years for the month, and whether the entity is special."""
    cases = special.select("complex_id", F.col("years").alias("_own"))
    own = F.array_intersect("_own", int_array(years)) if limit_special else F.col("_own")
    joined = sums.join(cases, "complex_id", "left")
    base = F.when(F.col("_own").isNotNull(), own).otherwise(int_array(years))
    return (
        joined.withColumn("is_special", F.col("_own").isNotNull())
        .withColumn("_years", base)
        .withColumn("_valid", valid_years(F.col("_years"), F.col("month"), bad_periods))
        .drop("_own")
    )


def baseline_means(
    sums: DataFrame,
    special: DataFrame,
    years: Sequence[int] = BASELINE_YEARS,
    bad_periods: Sequence[tuple[int, int]] = BAD_PERIODS,
    measures: Sequence[str] = ("ridership",),
    emit_empty: bool = True,
    limit_special: bool = True,
) -> DataFrame:
    """Mean over the years that count, per entity, month and any further group in ``sums``.

    The divisor is the number of configured years, so a year without data counts as zero. A
    special entity uses its own years; a month in which none of them is valid gives no row. With
    ``emit_empty`` a special entity that has any data gets a row for every month and day group,
    zero where there is no data: zeros are added to the rows that are summed. ``special`` is
    (complex_id, years array) with one row per entity. ``sums`` is read twice, so it should be a
    stored table when it comes from a large fact.
    """
    groups = [c for c in sums.columns if c not in ("complex_id", "year", "month", *measures)]
    keys = ["complex_id", "month", *groups]
    usable = without_bad_periods(sums.filter(F.col("year").isin(*years)) if limit_special else sums, periods=bad_periods)
    marked = with_years(usable, special, years, bad_periods, limit_special)
    kinds = dict(sums.dtypes)
    rows = marked.filter(F.array_contains("_valid", F.col("year"))).select(
        *[col(c) for c in [*keys, *measures]], F.size("_valid").alias("_n")
    )
    if emit_empty:
        cells = (
            marked.filter("is_special")
            .select("complex_id", "_years")
            .distinct()
            .withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12))))
            .withColumn("_n", F.size(valid_years(F.col("_years"), F.col("month"), bad_periods)))
            .filter("_n > 0")
        )
        if groups:
            cells = cells.withColumn("day_group", F.explode(F.array(F.lit("weekday"), F.lit("weekend"))))
        zeros = [F.lit(0).cast(kinds[m]).alias(m) for m in measures]
        rows = rows.unionByName(cells.select(*[col(k) for k in keys], *zeros, "_n"))
    return (
        rows.groupBy(*[col(k) for k in keys])
        .agg(*[F.sum(col(m)).alias(m) for m in measures], F.max("_n").alias("_n"))
        .select(*[col(k) for k in keys], *[(col(m) / F.col("_n")).alias(m) for m in measures])
    )


def station_baseline(
    sums: DataFrame,
    special: DataFrame,
    ids: DataFrame,
    years: Sequence[int] = BASELINE_YEARS,
    bad_periods: Sequence[tuple[int, int]] = BAD_PERIODS,
) -> DataFrame:
    """The published station baseline: means, totals, full grid, two decimals."""
    means = add_total(baseline_means(sums, special, years, bad_periods))
    keys = ["complex_id", "month", "day_group"]
    dense = fill_grid(baseline_grid(ids), means, keys, ["ridership"])
    return dense.select(*keys, round_even(F.col("ridership"), 2).alias("ridership"))


def local_baseline(
    daily_sums: DataFrame,
    special: DataFrame,
    ids: DataFrame,
    years: Sequence[int],
    measures: Sequence[str] = ("entries", "exits"),
) -> DataFrame:
    """The counter baseline: means of several measures, special years taken as configured."""
    means = baseline_means(daily_sums, special, years, (), measures, emit_empty=False, limit_special=False)
    return fill_grid(baseline_grid(ids, ()), means, ["complex_id", "month"], measures)


def roll_up_baseline(
    baseline: DataFrame,
    mapping: DataFrame | None,
    key: str | None,
    measures: Sequence[str] = ("ridership",),
    places: int | None = 2,
) -> DataFrame:
    """Baseline of the districts (with a mapping to them) or of the whole city.

    Entity values are rounded before they are summed and the sums are rounded again, as published;
    with ``places`` None nothing is rounded. Entities without a district do not count for any.
    """
    rest = [c for c in baseline.columns if c not in ("complex_id", *measures)]
    rows = baseline if mapping is None else baseline.join(mapping, "complex_id", "inner").filter(col(key).isNotNull())
    keys = [key, *rest] if key else rest
    sums = rows.groupBy(*[col(k) for k in keys]).agg(
        *[exact_sum(col(m), 8 if places is None else places).alias(m) for m in measures]
    )
    return sums if places is None else sums.select(
        *[col(k) for k in keys], *[round_even(col(m), places).alias(m) for m in measures]
    )
