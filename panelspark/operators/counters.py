"""From cumulative counter readings to daily entries and exits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelspark.functions.calendar import col, day_name, is_weekday, reading_time, service_day
from panelspark.functions.numbers import clip, whole_sum
from panelspark.functions.text import joined_key
from panelspark.operators.joins import BROADCAST_ROWS, lookup
from panelspark.specs import COUNTER_CAP, MIDNIGHT_SPAN_HOUR, OUTLIER_FACTOR, CounterSpec
from panelspark.workspace import stored


def with_ids(readings: DataFrame) -> DataFrame:
    """Add the device and the station key of raw readings."""
    return readings.withColumn("turnstile_id", joined_key("UNIT", "C/A", "SCP")).withColumn(
        "station_id", joined_key("STATION", "LINENAME")
    )


def with_reading_time(readings: DataFrame, name: str = "DATETIME") -> DataFrame:
    return readings.withColumn(name, reading_time("DATE", "TIME"))


def map_to_entity(readings: DataFrame, mapping: DataFrame, key: str = "station_id", entity: str = "Complex ID") -> DataFrame:
    """Attach the entity of each reading's station; readings of unmapped stations stay."""
    return lookup(readings, mapping.select(col(key), col(entity)), [key], "left")


def unique_station_names(readings: DataFrame, station: str = "STATION", line: str = "LINENAME") -> DataFrame:
    return readings.select(col(station), col(line)).distinct()


def reading_counts(readings: DataFrame, spec: CounterSpec = CounterSpec()) -> DataFrame:
    """Readings per device; a reading without a device belongs to none."""
    return (
        readings.filter(col(spec.device).isNotNull())
        .groupBy(col(spec.device))
        .agg(F.count(F.lit(1)).alias("readings"))
    )


def modal_count(counts: DataFrame) -> DataFrame:
    """The most common number of readings, the smallest of equally common ones: one row.

    Counting the counts first keeps the last aggregate's state to one pair.
    """
    return (
        counts.groupBy("readings")
        .agg(F.count(F.lit(1)).alias("devices"))
        .agg(F.max_by("readings", F.struct(F.col("devices"), -F.col("readings"))).alias("mode"))
    )


def low_count_devices(counts: DataFrame, factor: float = OUTLIER_FACTOR) -> DataFrame:
    """Devices with fewer readings than the factor times the modal count."""
    threshold = modal_count(counts).select(F.col("mode").cast("double") * factor).scalar()
    return counts.filter(F.col("readings").cast("double") < threshold)


def without_devices(readings: DataFrame, devices: DataFrame, spec: CounterSpec = CounterSpec()) -> DataFrame:
    """Readings whose device is not listed; the list's size is checked before it is broadcast."""
    return lookup(readings, devices.select(col(spec.device)), [spec.device], "left_anti")


def daily_chunk(time: str) -> Column:
    """A chunk for readings that come at a bounded rate: the day."""
    return service_day(time)


def last_readings(readings: DataFrame, keys: Sequence[str], spec: CounterSpec = CounterSpec()) -> DataFrame:
    """The last reading of each group as a struct column ``end``: its time and counters."""
    at = F.struct(*[col(c) for c in spec.order])
    end = F.struct(col(spec.time).alias("time"), *[col(c) for c in spec.counters])
    return readings.groupBy(*[col(k) for k in keys]).agg(F.max_by(end, at).alias("end"))


def with_previous(readings: DataFrame, spec: CounterSpec = CounterSpec(), earlier: DataFrame | None = None) -> DataFrame:
    """Each reading with the previous reading of its device, as a struct column ``prev``.

    A plain window over the device would put a busy device's whole history in one task. Here the
    window runs within (device, chunk). What a chunk's first reading follows is the last reading
    of the device's chunk before; those last readings are one row per (device, chunk), found by a
    map-side combined aggregate. Where chunks follow the devices' order, at most one device of a
    chunk was in an earlier one, so what is carried over is no more than one row a chunk.

    ``earlier`` holds the last reading of devices before all of these (device and ``end``). Readings
    without a device have no history and are left out.
    """
    known = readings.filter(col(spec.device).isNotNull())
    keys = [spec.device, spec.chunk]
    within = W.partitionBy(*[col(k) for k in keys]).orderBy(*[col(c).asc() for c in spec.order])
    now = F.struct(col(spec.time).alias("time"), *[col(c) for c in spec.counters])
    rows = known.select("*", F.lag(now).over(within).alias("_before"))

    last = last_readings(known, keys, spec)
    across = W.partitionBy(col(spec.device)).orderBy(col(spec.chunk).asc())
    carried = last.select(*[col(k) for k in keys], F.lag("end").over(across).alias("_carried"))
    if earlier is not None:
        old = earlier.select(col(spec.device), F.col("end").alias("_old"))
        carried = lookup(carried, stored(old, "earlier"), [spec.device], "left")
        carried = carried.select(*[col(k) for k in keys], F.coalesce("_carried", "_old").alias("_carried"))
    carried = stored(carried.filter(F.col("_carried").isNotNull()), "carried")
    few = carried.count() <= BROADCAST_ROWS  # rows of a device, a chunk, a time and the counters
    joined = rows.join(F.broadcast(carried) if few else carried, keys, "left")
    return joined.select(*[col(c) for c in readings.columns], F.coalesce("_before", "_carried").alias("prev"))


def raw_deltas(readings: DataFrame, spec: CounterSpec = CounterSpec(), earlier: DataFrame | None = None) -> DataFrame:
    """Unbounded counter differences, with the time of the previous reading; null for a first one."""
    return (
        with_previous(readings, spec, earlier)
        .withColumn("prev_time", F.col("prev.time"))
        .withColumns({f"{c}_DIFF": col(c) - F.col("prev").getField(c) for c in spec.counters})
        .drop("prev")
    )


def clean_deltas(deltas: DataFrame, spec: CounterSpec = CounterSpec(), cap: int = COUNTER_CAP) -> DataFrame:
    """Drop readings without a difference, bound the rest to [0, cap], date them by the earlier reading."""
    known = F.lit(True)
    for c in spec.counters:
        known = known & col(f"{c}_DIFF").isNotNull()
    return (
        deltas.filter(known)
        .withColumns({f"{c}_DIFF": clip(col(f"{c}_DIFF"), 0, cap).cast("bigint") for c in spec.counters})
        .withColumn("service_date", F.to_date("prev_time"))
    )


def counter_deltas(
    readings: DataFrame, spec: CounterSpec = CounterSpec(), cap: int = COUNTER_CAP, earlier: DataFrame | None = None
) -> DataFrame:
    return clean_deltas(raw_deltas(readings, spec, earlier), spec, cap)


def midnight_spans(deltas: DataFrame, spec: CounterSpec = CounterSpec(), hour: int = MIDNIGHT_SPAN_HOUR) -> DataFrame:
    """How many differences run from the given evening hour into the hour after midnight."""
    spans = (F.hour("prev_time") == hour) & (F.hour(col(spec.time)) == 0)
    return deltas.agg(F.count_if(spans).alias("midnight_spans"), F.count(F.lit(1)).alias("deltas"))


def daily_entity_sums(deltas: DataFrame, spec: CounterSpec = CounterSpec()) -> DataFrame:
    """Daily sums per entity with the active devices, the most common station name (the smallest of equally common
    ones) and all lines.

    A reading counts once for its device, its name and its line. These are counted by value first, on the map side
    too, so what meets for an entity's day is one row per device, name and line and never its readings.
    """
    kinds = {"device": spec.device, "name": spec.name, "line": spec.line}
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), col(c).cast("string").alias("value")) for k, c in kinds.items()]))
    rows = deltas.filter(col(spec.entity).isNotNull()).select(
        col(spec.entity).alias("Complex ID"), F.col("service_date").alias("DATE"), *[col(f"{c}_DIFF") for c in spec.counters], each.alias("_e")
    )
    is_kind = {k: F.col("kind") == k for k in kinds}
    values = rows.groupBy("Complex ID", "DATE", F.col("_e.kind").alias("kind"), F.col("_e.value").alias("value")).agg(
        *[F.sum(F.when(F.col("_e.kind") == "device", col(f"{c}_DIFF"))).alias(c) for c in spec.counters], F.count(F.lit(1)).alias("_n")
    )
    there = F.col("value").isNotNull()
    name = F.when(is_kind["name"] & there, F.struct(-F.col("_n"), F.col("value").alias("value")))
    return values.groupBy("Complex ID", "DATE").agg(
        *[whole_sum(col(c)).alias(c) for c in spec.counters],
        F.count_if(is_kind["device"] & there).alias("TURNSTILE_COUNT"),
        F.min(name)["value"].alias("PRIMARY_STATION_NAME"),
        F.array_join(F.array_sort(F.collect_list(F.when(is_kind["line"], F.col("value")))), ", ").alias("LINES"),
    )


def with_calendar(daily: DataFrame, day: str = "DATE") -> DataFrame:
    return daily.withColumns(
        {
            "DAY_OF_WEEK": day_name(day),
            "WEEKDAY": is_weekday(day),
            "YEAR": F.year(col(day)),
            "MONTH": F.month(col(day)),
        }
    )


def counter_profile(daily: DataFrame) -> DataFrame:
    """Date range, number of entities and totals of a daily table."""
    return daily.agg(
        F.min("DATE").alias("first_date"),
        F.max("DATE").alias("last_date"),
        F.count_distinct(col("Complex ID")).alias("entities"),
        whole_sum(F.col("ENTRIES")).alias("entries"),
        whole_sum(F.col("EXITS")).alias("exits"),
    )
