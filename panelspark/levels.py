"""The geography levels a panel is published at."""

from __future__ import annotations

from dataclasses import dataclass

PANEL_MEASURES = ("ridership", "omny_pct")
PERIOD_COLUMNS = ("year", "month", "period", "day_group")


@dataclass(frozen=True)
class Level:
    """One geography level; everything else about its tables follows from the key."""

    name: str
    key: str | None = None
    label: str | None = None

    @property
    def keys(self) -> tuple[str, ...]:
        return (self.key,) if self.key else ()

    @property
    def panel_columns(self) -> tuple[str, ...]:
        return (*self.keys, *PERIOD_COLUMNS, *PANEL_MEASURES)

    @property
    def baseline_columns(self) -> tuple[str, ...]:
        return (*self.keys, "month", "day_group", "ridership")

    @property
    def panel_key(self) -> tuple[str, ...]:
        return (*self.keys, "year", "month", "day_group")

    @property
    def baseline_key(self) -> tuple[str, ...]:
        return (*self.keys, "month", "day_group")

    @property
    def final_columns(self) -> tuple[str, ...]:
        return (*self.keys, *PERIOD_COLUMNS, "ridership", "baseline", "baseline_comparison", "omny_pct")


STATION = Level("station", "complex_id", "station_name")
DISTRICT = Level("puma", "puma", "puma_name")
CITY = Level("nyc")
LEVELS = {level.name: level for level in (STATION, DISTRICT, CITY)}
