"""Panels from daily sums of raw hourly rows, with one column per category."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions.calendar import col
from panelspark.levels import CITY, DISTRICT, STATION
from panelspark.operators.compare import compare_totals
from panelspark.operators.filters import in_scope
from panelspark.operators.grid import fill_grid, panel_grid
from panelspark.operators.monthly import completeness, daily_sums, of_complete_months, pivot_categories
from panelspark.operators.quality import require_non_negative
from panelspark.operators.rollup import roll_up_categories
from panelspark.specs import EXCLUDED_COMPLEXES, SUBWAY_MODES, FactSpec
from panelspark.workspace import stored

KEYS = ("station_complex_id", "year", "month", "period", "day_group")


def daily_table(
    hourly: DataFrame,
    spec: FactSpec = FactSpec(),
    modes: Sequence = SUBWAY_MODES,
    excluded: Sequence = EXCLUDED_COMPLEXES,
) -> DataFrame:
    """Scope filter and daily sums; negative counts are refused."""
    require_non_negative(in_scope(hourly, spec, modes, excluded), spec.measure, "hourly rows")
    return daily_sums(in_scope(hourly, spec, modes, excluded), spec)


def station_panel(
    daily: DataFrame, ids: DataFrame, categories: Sequence[str], share_category: str
) -> DataFrame:
    """Complete months, one column per category, every entity in every period.

    ``daily`` is read for its complete months and for its sums, so it should be a stored table.
    """
    months = completeness(daily, "date").filter("complete").select("year", "month")
    monthly = pivot_categories(of_complete_months(daily, "date", months), categories, share_category)
    grid = panel_grid(ids.select(col(ids.columns[0]).alias("station_complex_id")), months)
    return fill_grid(grid, monthly, KEYS, [*categories, "ridership", "omny_pct"])


def local_panels(
    hourly: DataFrame,
    ids: DataFrame,
    mapping: DataFrame,
    categories: Sequence[str],
    spec: FactSpec = FactSpec(),
    modes: Sequence = SUBWAY_MODES,
    excluded: Sequence = EXCLUDED_COMPLEXES,
) -> dict[str, DataFrame]:
    """Station, district and city panels; ``mapping`` is (station_complex_id, puma)."""
    daily = stored(daily_table(hourly, spec, modes, excluded), "daily")
    wide = stored(station_panel(daily, ids, categories, spec.share_category), "station-panel")
    measures = ["ridership", "omny_pct"]
    period = ["year", "month", "period", "day_group"]
    district = roll_up_categories(wide, categories, spec.share_category, mapping, DISTRICT.key)
    city = roll_up_categories(wide, categories, spec.share_category)
    return {
        STATION.name: wide.select(F.col("station_complex_id").alias("complex_id"), *period, *measures),
        DISTRICT.name: district.select(DISTRICT.key, *period, *measures),
        CITY.name: city.select(*period, *measures),
    }


def local_comparison(panels: dict[str, DataFrame], baselines: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Monthly totals of each level against the counter baseline."""
    levels = {STATION.name: STATION, DISTRICT.name: DISTRICT, CITY.name: CITY}
    return {name: compare_totals(panels[name], baselines[name], level) for name, level in levels.items() if name in panels}
