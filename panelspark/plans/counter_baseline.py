"""Weekly counter readings to monthly baselines of entries and exits."""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.functions.calendar import col
from panelspark.levels import CITY, DISTRICT, STATION
from panelspark.operators.baseline import local_baseline, roll_up_baseline
from panelspark.operators.counters import (
    counter_deltas,
    daily_entity_sums,
    low_count_devices,
    map_to_entity,
    reading_counts,
    with_calendar,
    with_ids,
    with_reading_time,
    without_devices,
)
from panelspark.operators.filters import at_reporting_marks, by_station_lists, drop_present, in_years
from panelspark.operators.monthly import entity_month_totals
from panelspark.sources.sinks import is_stored
from panelspark.specs import COUNTER_BASELINE_YEARS, OUTLIER_FACTOR, CounterSpec
from panelspark.workspace import new_path, stored


def staged_readings(readings: DataFrame, mapping: DataFrame) -> DataFrame:
    """Filtered readings with device, station and entity ids and a proper timestamp.

    Readings that don't say where they stand are numbered before the map is joined, which may move them.
    """
    placed = readings if "seq" in readings.columns else readings.withColumn("seq", F.monotonically_increasing_id())
    kept = with_ids(by_station_lists(placed))
    return with_reading_time(drop_present(map_to_entity(kept, mapping)))


# Readings per chunk beyond which there are more chunks than shuffle partitions.
ROWS_PER_CHUNK = 2_000_000


_LABELS: dict[int, list[int]] = {}


def chunk_labels(spark: SparkSession, n: int) -> list[int]:
    """``n`` ascending numbers that fall into ``n`` different buckets, so that every bucket holds one chunk. They
    depend on ``n`` alone and are kept."""
    if n in _LABELS:
        return _LABELS[n]
    labels: list[int] = []
    taken: set[int] = set()
    start, step = 0, 16 * n
    while len(labels) < n:
        some = spark.range(start, start + step).select(F.col("id").cast("int").alias("label"))
        for r in some.withColumn("bucket", F.pmod(F.hash("label"), F.lit(n))).orderBy("label").collect():
            if r["bucket"] not in taken and len(labels) < n:
                taken.add(r["bucket"])
                labels.append(r["label"])
        start += step
    _LABELS[n] = labels
    return labels


def in_chunks(
    readings: DataFrame, spec: CounterSpec = CounterSpec(), path: str | None = None, chunks: int | None = None
) -> DataFrame:
    """The readings stored in chunks of about equal size that follow (device, time, tie).

    There are as many chunks as shuffle partitions, or more where chunks would grow too large.

    Ranges are cut from a sample of the data, so a device with a third of all readings, a day with
    a third of them, or a third of them being copies of one reading, spans many chunks. The input is
    written first, so counting, sampling and moving it don't compute it again. Chunks are buckets of
    the stored table, one each, so what is grouped by device and chunk stays where it is: from here
    to the differences full rows move once and are sorted once.
    """
    spark = readings.sparkSession
    if "seq" in spec.tie and "seq" not in readings.columns:
        readings = readings.withColumn("seq", F.monotonically_increasing_id())
    readings = stored(readings, "unordered-readings")
    n = chunks or max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(readings.count() / ROWS_PER_CHUNK)
    )
    labels = F.array(*[F.lit(label) for label in chunk_labels(spark, n)])
    moved = readings.repartitionByRange(n, *[col(c) for c in (spec.device, *spec.order)])
    numbered = moved.withColumn(spec.chunk, F.get(labels, F.spark_partition_id()))
    return stored_in_buckets(numbered, spec.chunk, n, path or new_path(spark, "readings"))


def stored_in_buckets(df: DataFrame, bucket: str, n: int, path: str) -> DataFrame:
    """The rows read back from a table in ``n`` buckets, which the optimizer takes as partitioned by the column.

    A task here holds one bucket, so it writes its file as rows come and nothing is sorted for the write. The
    table's name is given up at once; its files stay.
    """
    spark = df.sparkSession
    name = f"buckets_{uuid.uuid4().hex}"
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "8")
    try:
        df.write.mode("overwrite").format("parquet").option("path", path).bucketBy(n, bucket).saveAsTable(name)
    finally:
        spark.conf.set(setting, before)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def daily_table(
    readings: DataFrame,
    spec: CounterSpec = CounterSpec(),
    factor: float = OUTLIER_FACTOR,
    clock: str = "TIME",
    marks: Sequence[str] | None = None,
) -> DataFrame:
    """Daily entity sums of chunked readings.

    Order matters: devices with few readings go first, then readings off the reporting marks, and
    only then are differences taken, so a difference may span dropped readings.
    """
    counts = stored(reading_counts(readings, spec), "reading-counts")
    few = stored(low_count_devices(counts, factor), "few-readings")
    kept = without_devices(readings, few, spec)
    marked = at_reporting_marks(kept, clock, marks) if marks else at_reporting_marks(kept, clock)
    return with_calendar(daily_entity_sums(counter_deltas(marked, spec), spec))


def counter_baselines(
    daily: DataFrame,
    special: DataFrame,
    ids: DataFrame,
    districts: DataFrame,
    years: Sequence[int] = COUNTER_BASELINE_YEARS,
) -> dict[str, DataFrame]:
    """Station, district and city baselines of entries and exits from the daily table."""
    measures = ["entries", "exits"]
    monthly = entity_month_totals(daily, "Complex ID", "DATE", ["ENTRIES", "EXITS"])
    station = local_baseline(monthly, special, ids, years, measures)
    return {
        STATION.name: station,
        DISTRICT.name: roll_up_baseline(station, districts, DISTRICT.key, measures, places=None),
        CITY.name: roll_up_baseline(station, None, None, measures, places=None),
    }


def run_counter_baseline(
    readings: DataFrame,
    mapping: DataFrame,
    special: DataFrame,
    ids: DataFrame,
    districts: DataFrame,
    root: str,
    years: Sequence[int] = COUNTER_BASELINE_YEARS,
    force_staging: bool = False,
    factor: float = OUTLIER_FACTOR,
) -> dict[str, DataFrame]:
    """The whole counter run under ``root``; staged readings are reused unless staging is forced."""
    spark = readings.sparkSession
    path = f"{root.rstrip('/')}/staged_readings"
    if force_staging or not is_stored(spark, path):
        staged = in_chunks(staged_readings(readings, mapping), path=path)
    else:
        staged = spark.read.parquet(path)
    daily = in_years(daily_table(staged, factor=factor), "YEAR", min(years), max(years))
    kept = stored(daily, "daily", f"{root.rstrip('/')}/daily")
    out = counter_baselines(kept, special, ids, districts, years)
    return {name: stored(df, name, f"{root.rstrip('/')}/counter_baseline_{name}") for name, df in out.items()}
