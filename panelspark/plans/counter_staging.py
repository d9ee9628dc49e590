"""Weekly counter files taken in as they come: new weeks are staged, old ones are not read again.

What is staged of a batch of files is published under its number: readings per device, differences between readings
at the reporting marks, and the last of those readings of each device, which is all that the next batch needs of the
past. The list of files (name, length, time) is published last, so a batch that was cut off is staged again under
its number.

Differences of one device don't depend on other devices. Devices with few readings are therefore left out when daily
sums are made, from the counts of all batches, and not when a batch is staged.

A file that changed, or a reading before its device's last staged one, can't be added to the end: then all files are
staged anew as one batch, which replaces the others at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.functions.calendar import col
from panelspark.operators.counters import (
    counter_deltas,
    daily_entity_sums,
    last_readings,
    low_count_devices,
    reading_counts,
    with_calendar,
    without_devices,
)
from panelspark.operators.filters import at_reporting_marks
from panelspark.plans.counter_baseline import in_chunks, staged_readings
from panelspark.sources.publishing import current, part_name, publish, read_published, read_version
from panelspark.sources.readings import WEEKLY_NAME, scan_weekly
from panelspark.specs import FIRST_WEEKLY_FILE, OUTLIER_FACTOR, CounterSpec
from panelspark.workspace import stored

FILES = "file string, length bigint, time timestamp, batch int"
NOTHING_NEW, ADDED, ANEW = "nothing new", "added", "staged anew"


def files_at(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Files and what tells one version of a file from another; no content is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path if isinstance(path, str) else list(path))
    return found.select(F.col("path").alias("file"), "length", F.col("modificationTime").alias("time"))


def parts_of(batch: int) -> list[str]:
    return [part_name({"batch": batch})]


def staged(spark: SparkSession, root: str, table: str, before: int | None = None) -> DataFrame | None:
    """A staged table of all batches, or of those before a number; None where there is none."""
    path = f"{root.rstrip('/')}/{table}"
    version = current(spark, path)
    if version is None:
        return None
    parts = [p for p in version.parts if before is None or int(p.split("=")[1]) < before]
    return read_version(spark, path, version, parts)


def later_of(ends: DataFrame, spec: CounterSpec) -> DataFrame:
    """The last reading of each device over all batches, which follow each other."""
    return ends.groupBy(col(spec.device)).agg(F.max_by(F.struct("end", "placed"), F.col("batch")).alias("_last")).select(
        col(spec.device), "_last.end", "_last.placed"
    )


def stage_weekly(
    spark: SparkSession,
    path: str | Sequence[str],
    root: str,
    mapping: DataFrame,
    pattern: str = WEEKLY_NAME,
    first: int = FIRST_WEEKLY_FILE,
    clock: str = "TIME",
    marks: Sequence[str] | None = None,
    spec: CounterSpec = CounterSpec(),
    anew: bool = False,
    prepare=lambda readings: readings,
) -> str:
    """Take in the files that are new since the last call and say what was done.

    ``prepare`` may mend readings before they are staged. Files that can't be used are noted too and not read again.
    """
    base = root.rstrip("/")
    now = stored(files_at(spark, path), "files")
    known = staged(spark, base, "files")
    batch, fresh = 0, now
    if known is not None and not anew:
        both = now.join(known.select("file", F.col("length").alias("_l"), F.col("time").alias("_t")), "file", "left")
        if not both.filter("_l IS NOT NULL AND (_l <> length OR _t <> time)").isEmpty():
            return stage_weekly(spark, path, root, mapping, pattern, first, clock, marks, spec, True, prepare)
        fresh = stored(both.filter("_l IS NULL").select("file", "length", "time"), "new-files")
        batch = known.agg(F.max("batch")).first()[0] + 1
    names = [r["file"] for r in fresh.select("file").collect()]
    if not names:
        return NOTHING_NEW
    readings, _ = scan_weekly(spark, names, pattern, first)
    chunked = in_chunks(staged_readings(prepare(readings), mapping), spec)
    marked = at_reporting_marks(chunked, clock, marks) if marks else at_reporting_marks(chunked, clock)
    placed = F.struct(*[col(c) for c in spec.order])
    past = staged(spark, base, "ends", batch) if batch else None
    earlier = None if past is None else stored(later_of(past, spec), "earlier")
    if earlier is not None:
        started = marked.groupBy(col(spec.device)).agg(F.min(placed).alias("_first"))
        if not started.join(earlier, spec.device).filter("_first < placed").isEmpty():
            return stage_weekly(spark, path, root, mapping, pattern, first, clock, marks, spec, True, prepare)
    ends = last_readings(marked, [spec.device], spec).join(marked.groupBy(col(spec.device)).agg(F.max(placed).alias("placed")), spec.device)
    tables = {
        "counts": reading_counts(chunked, spec),
        "deltas": counter_deltas(marked, spec, earlier=earlier).select(
            *[col(c) for c in (spec.device, spec.entity, spec.name, spec.line, "service_date")], *[col(f"{c}_DIFF") for c in spec.counters]
        ),
        "ends": ends,
        "files": fresh,
    }
    for name, df in tables.items():  # the list of files comes last
        own = df.withColumn("batch", F.lit(batch))
        publish(own, f"{base}/{name}", ["batch"], parts_of(batch) if batch else None)
    return ADDED if batch else ANEW


def staged_daily(spark: SparkSession, root: str, factor: float = OUTLIER_FACTOR, spec: CounterSpec = CounterSpec()) -> DataFrame:
    """Daily entity sums of everything staged, without devices that have few readings in all."""
    base = root.rstrip("/")
    counts = read_published(spark, f"{base}/counts").groupBy(col(spec.device)).agg(F.sum("readings").alias("readings"))
    few = stored(low_count_devices(stored(counts, "reading-counts"), factor), "few-readings")
    return with_calendar(daily_entity_sums(without_devices(read_published(spark, f"{base}/deltas"), few, spec), spec))
