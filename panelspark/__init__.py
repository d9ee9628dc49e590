"""Periodic panels on Spark: entity x month x day-group sums, shares, baselines and roll-ups."""

from panelspark.levels import CITY, DISTRICT, LEVELS, STATION, Level
from panelspark.specs import CounterSpec, FactSpec

__all__ = ["CITY", "DISTRICT", "LEVELS", "STATION", "CounterSpec", "FactSpec", "Level"]
