"""Column names of the inputs, so that one operator serves any table of the right shape."""

from __future__ import annotations

from dataclasses import dataclass

# Day groups in their published order.
DAY_GROUPS = ("total", "weekday", "weekend")

# The scope of the published panel.
SUBWAY_MODES = ("subway",)
EXCLUDED_COMPLEXES = ("502",)
SHARE_CATEGORY = "OMNY"
OUT_OF_SCOPE_ROUTE = "SIR"

# The hourly baseline years and the month known to be bad.
BASELINE_YEARS = (2017, 2018, 2019)
BAD_PERIODS = ((2017, 1),)

# Counter cleaning.
COUNTER_CAP = 7200
OUTLIER_FACTOR = 0.1
REPORTING_MARKS = ("00:00", "30:00", "22:00")
MIDNIGHT_SPAN_HOUR = 20
EXCLUDED_STATIONS = ("ORCHARD BEACH",)
ALLOWED_DIVISIONS = ("BMT", "IND", "IRT")
FIRST_WEEKLY_FILE = 141018
COUNTER_BASELINE_YEARS = (2015, 2016, 2017, 2018, 2019)


@dataclass(frozen=True)
class FactSpec:
    """An append-only fact: when, who, which category, how many.

    ``partitions`` names the year and month columns of a fact that is stored in such folders, so
    that month filters skip folders.
    """

    time: str = "transit_timestamp"
    entity: str = "station_complex_id"
    category: str = "payment_method"
    measure: str = "ridership"
    mode: str = "transit_mode"
    share_category: str = SHARE_CATEGORY
    partitions: tuple[str, str] | None = None


@dataclass(frozen=True)
class CounterSpec:
    """Cumulative counter readings of many devices.

    ``tie`` orders readings of one device that carry the same time. ``seq`` stands for the order in
    which readings were read; it is added when readings are stored in chunks.
    ``chunk`` is any column that never falls as a device's readings advance. It splits a device's
    history over tasks, so that no device has to fit in one.
    """

    device: str = "turnstile_id"
    time: str = "DATETIME"
    counters: tuple[str, ...] = ("ENTRIES", "EXITS")
    tie: tuple[str, ...] = ("seq",)
    chunk: str = "chunk"
    entity: str = "Complex ID"
    name: str = "STATION"
    line: str = "LINENAME"

    @property
    def order(self) -> tuple[str, ...]:
        return (self.time, *self.tie)
