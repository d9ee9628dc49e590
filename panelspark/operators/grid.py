"""Dense grids: every entity for every period and day group, zero where there is no data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions.calendar import col, period_label
from panelspark.functions.text import enum_order
from panelspark.operators.monthly import complete_months, unfold_day_groups
from panelspark.specs import DAY_GROUPS


def entity_periods(ids: DataFrame, periods: DataFrame) -> DataFrame:
    """Each entity once per observed period.

    The periods are bounded by the calendar, so they are gathered into one array value and each
    entity's row is unfolded in place: no join and no shuffle.
    """
    period = F.struct(F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month"))
    every = periods.agg(F.collect_set(period)).scalar()
    return ids.withColumn("_p", F.explode(every)).select(
        *ids.columns, F.col("_p.year").alias("year"), F.col("_p.month").alias("month")
    )


def panel_grid(ids: DataFrame, periods: DataFrame, groups: Sequence[str] = DAY_GROUPS) -> DataFrame:
    """Entities x observed periods x day groups."""
    return (
        entity_periods(ids, periods)
        .withColumn("period", period_label("year", "month"))
        .withColumn("day_group", F.explode(F.array(*[F.lit(g) for g in groups])))
    )


def baseline_grid(ids: DataFrame, groups: Sequence[str] = DAY_GROUPS) -> DataFrame:
    """Entities x 12 months x day groups; without groups, entities x 12 months."""
    grid = ids.withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12))))
    return grid.withColumn("day_group", F.explode(F.array(*[F.lit(g) for g in groups]))) if groups else grid


def fill_grid(grid: DataFrame, data: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """The grid with its data, zero where there is none. Data outside the grid disappears."""
    rest = [c for c in data.columns if c not in grid.columns]
    return grid.join(data.select(*[col(c) for c in [*keys, *rest]]), list(keys), "left").na.fill(0, list(measures))


def dense_panel(wide: DataFrame, ids: DataFrame, periods: DataFrame | None = None) -> DataFrame:
    """The published station panel from wide monthly sums.

    Filling happens on one row per entity-month, before unfolding into day groups, so the join
    moves a third of what a fill of the long table would. Only complete months have grid cells,
    which makes a separate month filter needless.
    """
    cells = entity_periods(ids, complete_months(wide) if periods is None else periods)
    numbers = [c for c in wide.columns if c not in ("complex_id", "year", "month")]
    filled = cells.join(wide, ["complex_id", "year", "month"], "left").na.fill(0, numbers)
    return unfold_day_groups(filled, keep_empty=True)


def panel_order(df: DataFrame, keys: Sequence[str], numeric: Sequence[str] = ()) -> DataFrame:
    """Sort a panel; ids in ``numeric`` by number, the day group by its published order."""
    order = []
    for key in keys:
        if key == "day_group":
            order.append(enum_order(key).asc())
        elif key in numeric:
            order += [col(key).cast("string").try_cast("bigint").asc_nulls_last(), col(key).asc_nulls_last()]
        else:
            order.append(col(key).asc_nulls_last())
    return df.orderBy(*order)
