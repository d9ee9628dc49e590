"""Hourly fact to published panels at every level, full, targeted, incremental or for one entity."""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.functions.calendar import col
from panelspark.levels import DISTRICT, LEVELS, STATION, Level
from panelspark.operators.baseline import roll_up_baseline, station_baseline
from panelspark.operators.compare import baseline_problems, compare
from panelspark.operators.enrich import published_order, with_name
from panelspark.operators.filters import in_month_list, of_entity
from panelspark.operators.grid import dense_panel
from panelspark.operators.months import candidate_months, missing_months, month_list, upsert_months
from panelspark.operators.monthly import complete_months, monthly_wide
from panelspark.operators.quality import require_day_group_keys, require_special_cases
from panelspark.operators.rollup import roll_up
from panelspark.schemas import STATION_PANEL
from panelspark.sources.publishing import (
    MONTHS,
    Version,
    current,
    forget,
    month_parts,
    months_of,
    propagate,
    publish,
    read_published,
    read_version,
    stale_parts,
)
from panelspark.sources.sinks import change_status, entity_folder, is_stored
from panelspark.sources.tables import load_stored_panel, special_years
from panelspark.specs import BAD_PERIODS, BASELINE_YEARS, FactSpec
from panelspark.workspace import stored, together


Keep = Callable[[str, DataFrame], DataFrame]
# One table, or several by the names that years are routed to.
Fact = DataFrame | dict[str, DataFrame]
REUSED = "reusing existing baseline files"


@dataclass(frozen=True)
class Dimensions:
    """Reference tables: in-scope ids, entity to district, names, special baseline years.

    A whole run keeps ids as text, as stored panels do, so ``complex_id`` is text here too.
    """

    ids: DataFrame
    districts: DataFrame
    entity_names: DataFrame
    district_names: DataFrame
    special: DataFrame


def special_cases(config: DataFrame) -> DataFrame:
    """Special baseline years of a configuration table; one with unusable rows is refused."""
    require_special_cases(config)
    return special_years(config)


def dimension_digest(dims: Dimensions) -> DataFrame:
    """``name, rows, digest`` of the tables that finals are made with besides panel and baseline."""
    tables = {"districts": dims.districts, "entity_names": dims.entity_names, "district_names": dims.district_names}

    def one(name: str, df: DataFrame) -> DataFrame:
        digest = F.sum(F.xxhash64(*[col(c) for c in df.columns]).cast("decimal(20,0)"))
        return df.agg(F.count(F.lit(1)).alias("rows"), digest.alias("digest")).select(F.lit(name).alias("name"), "rows", "digest")

    parts = [one(name, df) for name, df in tables.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def wide_long(wide: DataFrame) -> DataFrame:
    """Weekday and weekend sums of a wide monthly table as rows, where there is data."""
    c = F.col
    groups = F.array(
        F.struct(F.lit("weekday").alias("g"), c("weekday_sum").alias("v"), c("weekday_rows").alias("n")),
        F.struct(F.lit("weekend").alias("g"), c("weekend_sum").alias("v"), c("weekend_rows").alias("n")),
    )
    return (
        wide.withColumn("e", F.explode(F.filter(groups, lambda s: s["n"] > 0)))
        .select("complex_id", "year", "month", c("e.g").alias("day_group"), c("e.v").alias("ridership"))
    )


def district_mapping(dims: Dimensions, level: Level) -> tuple[DataFrame | None, str | None]:
    return (dims.districts, level.key) if level is DISTRICT else (None, None)


def level_panel(station: DataFrame, dims: Dimensions, level: Level) -> DataFrame:
    """The panel of a level, from the station panel."""
    return station if level is STATION else roll_up(station, *district_mapping(dims, level))


def level_baseline(station: DataFrame, dims: Dimensions, level: Level) -> DataFrame:
    """The baseline of a level, from the station baseline."""
    return station if level is STATION else roll_up_baseline(station, *district_mapping(dims, level))


def final_table(panel: DataFrame, baseline: DataFrame, dims: Dimensions, level: Level) -> DataFrame:
    """A level's panel compared with its baseline, with readable names."""
    compared = compare(panel, baseline, level)
    names = {STATION.name: dims.entity_names, DISTRICT.name: dims.district_names}.get(level.name)
    return compared if names is None else with_name(compared, names, level.key, level.label)


def baselines(
    wide: DataFrame, dims: Dimensions, years=BASELINE_YEARS, bad_periods=BAD_PERIODS, keep: Keep = lambda _, df: df
) -> dict[str, DataFrame]:
    """Baselines of every level from wide monthly sums of the baseline years.

    ``keep`` may store each table as it is made, so that roll-ups start from the stored one.
    """
    sums = wide_long(wide.filter(F.col("year").isin(*years)))
    station = keep(STATION.name, station_baseline(sums, dims.special, dims.ids, years, bad_periods))
    return {
        name: station if level is STATION else keep(name, level_baseline(station, dims, level))
        for name, level in LEVELS.items()
    }


def sort_keys(level: Level) -> tuple[str | None, tuple[str, ...]]:
    """Name or district code as text, and what settles ties: id and day group."""
    text = {"station": level.label, "puma": level.key}.get(level.name)
    return text, tuple(k for k in (level.key, "day_group") if k and k != text)


def final_order(df: DataFrame, level: Level) -> DataFrame:
    """Published order: year, month, then ``sort_keys``."""
    return published_order(df, *sort_keys(level))


def month_order(level: Level) -> list[Column]:
    """The same within one month."""
    text, ties = sort_keys(level)
    return [col(c).asc_nulls_last() for c in ([text] if text else []) + list(ties)]


def months_to_compute(
    spark: SparkSession,
    sources: DataFrame,
    stored_panel: DataFrame,
    as_of: date,
    year: int | None = None,
    month: int | None = None,
    full_refresh: bool = False,
) -> list[tuple[int, int]]:
    """Months a run looks at: all, the targeted ones, or those not stored yet."""
    if full_refresh:
        return month_list(candidate_months(sources, as_of))
    wanted = candidate_months(sources, as_of, year, month)
    return month_list(wanted if year is not None else missing_months(wanted, stored_panel))


def routed_fact(
    tables: dict[str, DataFrame], sources: DataFrame, months: list[tuple[int, int]], spec: FactSpec = FactSpec()
) -> DataFrame:
    """Rows of the months, each taken from the table its year is routed to.

    ``sources`` is (year, source); it is configuration, one row per year. Months of a year without
    a source are skipped. Every table is read for its own months only.
    """
    route = {r["year"]: r["source"] for r in sources.select("year", "source").collect()}
    parts = []
    for name, df in tables.items():
        own = [(y, m) for y, m in months if route.get(y) == name]
        if own:
            parts.append(in_month_list(df, own, spec))
    if not parts:
        return next(iter(tables.values())).limit(0)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def fresh_wide(
    fact: DataFrame, months: list[tuple[int, int]], spec: FactSpec, entity=None
) -> tuple[DataFrame, DataFrame]:
    """Wide monthly sums of the months, stored once, and which of the months are complete.

    The fact is scanned once. Completeness looks at every entity even when one is asked for.
    """
    wide = stored(monthly_wide(in_month_list(fact, months, spec), spec), "monthly-sums")
    complete = complete_months(wide)
    if entity is None:
        return wide, complete
    own = of_entity(wide, entity, FactSpec(entity="complex_id"))
    return own, complete.join(own.select("year", "month").distinct(), ["year", "month"], "left_semi")


def refreshed_panel(
    fact: DataFrame,
    stored_panel: DataFrame | None,
    ids: DataFrame,
    months: list[tuple[int, int]],
    spec: FactSpec = FactSpec(),
) -> DataFrame:
    """The stored panel with every complete month of ``months`` computed anew.

    A month that is not complete keeps its stored rows.
    """
    wide, complete = fresh_wide(fact, months, spec)
    fresh = dense_panel(wide, ids, complete)
    return fresh if stored_panel is None else upsert_months(stored_panel, fresh, complete)


def entity_panel(
    fact: DataFrame, entity, months: list[tuple[int, int]], spec: FactSpec = FactSpec()
) -> DataFrame:
    """One entity's panel, kept apart from the stored one."""
    wide, complete = fresh_wide(fact, months, spec, entity)
    ids = wide.select("complex_id").distinct()
    return dense_panel(wide, ids, complete)


def store_entity_panel(
    fact: DataFrame, path: str, entity, months: list[tuple[int, int]], spec: FactSpec = FactSpec()
) -> DataFrame:
    """Write one entity's panel beside the full one, which is left alone."""
    return stored(entity_panel(fact, entity, months, spec), "entity-panel", entity_folder(path, entity))


def session_of(fact: Fact) -> SparkSession:
    return (next(iter(fact.values())) if isinstance(fact, dict) else fact).sparkSession


def update_station_table(
    fact: Fact,
    path: str,
    sources: DataFrame,
    ids: DataFrame,
    as_of: date,
    year: int | None = None,
    month: int | None = None,
    full_refresh: bool = False,
    spec: FactSpec = FactSpec(),
) -> list[tuple[int, int]]:
    """Bring the stored station panel up to date in place and give the months that were looked at."""
    return refresh_station_table(fact, path, sources, ids, as_of, year, month, full_refresh, spec)[0]


def refresh_station_table(
    fact: Fact,
    path: str,
    sources: DataFrame,
    ids: DataFrame,
    as_of: date,
    year: int | None,
    month: int | None,
    full_refresh: bool,
    spec: FactSpec,
) -> tuple[list[tuple[int, int]], Version | None]:
    """The same; gives the months that were looked at and the version the table has then, if any.

    The panel is published in year/month folders. Only folders of refreshed months are written, so
    the cost follows the refreshed months and not the panel's length; a full refresh replaces all
    of them at once. A panel that was written before there were versions is taken over as it is.
    """
    spark = session_of(fact)
    before = current(spark, path)
    unversioned = load_stored_panel(spark, path) if before is None else None
    known = spark.createDataFrame(months_of(before.parts), "year int, month int") if before else unversioned
    months = months_to_compute(spark, sources, known, as_of, year, month, full_refresh)
    if not months:
        return months, before
    rows = routed_fact(fact, sources, months, spec) if isinstance(fact, dict) else fact
    wide, complete = fresh_wide(rows, months, spec)
    written = month_list(complete)
    if not written:  # there is nothing to put in its place, so the stored panel stays as it is
        return months, before
    if before is None and is_stored(spark, path):
        publish(stored(unversioned, "taken-over"), path, MONTHS)
    return months, publish(dense_panel(wide, ids, complete), path, MONTHS, None if full_refresh else month_parts(written))


def baseline_paths(root: str) -> dict[str, str]:
    return {name: f"{root.rstrip('/')}/baseline_{name}" for name in LEVELS}


def baseline_or_reuse(
    spark: SparkSession, root: str, build: Callable[[Keep], dict[str, DataFrame]], force: bool = False
) -> tuple[dict[str, DataFrame], str]:
    """Published baselines when all three are there and no rebuild is forced; else build and publish them."""
    versions, why = baseline_versions(spark, root, build, force)
    return {name: read_version(spark, path, versions[name]) for name, path in baseline_paths(root).items()}, why


def baseline_versions(
    spark: SparkSession, root: str, build: Callable[[Keep], dict[str, DataFrame]], force: bool
) -> tuple[dict[str, Version], str]:
    paths = baseline_paths(root)
    versions = dict(zip(paths, together(*[functools.partial(current, spark, p) for p in paths.values()])))
    if not force and all(versions.values()):
        return versions, REUSED

    def keep(name: str, df: DataFrame) -> DataFrame:
        versions[name] = publish(df, paths[name])
        return read_version(spark, paths[name], versions[name])

    reason = "forced rebuild requested" if force else "missing baseline file(s)"
    build(keep)
    return versions, reason


def run_monthly_update(
    fact: Fact,
    dims: Dimensions,
    sources: DataFrame,
    root: str,
    as_of: date,
    baseline_fact: Fact | None = None,
    year: int | None = None,
    month: int | None = None,
    full_refresh: bool = False,
    rebuild_baseline: bool = False,
    baseline_years=BASELINE_YEARS,
    bad_periods=BAD_PERIODS,
    spec: FactSpec = FactSpec(),
    keep_versions: int = 2,
) -> dict[str, str]:
    """The whole monthly run under ``root``; gives each level's change status.

    Station panel, roll-ups, baselines (built only when needed), comparison, names, output. The
    fact is scanned once for its months; each later step starts from a published table. A fact of
    several tables is routed by ``sources``.

    Roll-ups and finals are built for those months only whose inputs changed: the station panel's
    folder of the month, the baseline, the districts or the names. What a folder was made from is in
    its table's manifest, so after a run that died the next one renews what that run left behind.
    Every table stays readable in its last whole version until the next one is complete. Beside the
    finals a run leaves ``diagnostics`` of them.
    """
    spark = session_of(fact)
    base = root.rstrip("/")
    panel_paths = {name: f"{base}/ridership_{name}" for name in LEVELS}
    final_paths = {name: f"{base}/final_{name}" for name in LEVELS}
    base_paths = baseline_paths(base)

    def build(keep: Keep) -> dict[str, DataFrame]:
        every = [(y, m) for y in baseline_years for m in range(1, 13)]
        old = fact if baseline_fact is None else baseline_fact
        rows = routed_fact(old, sources, every, spec) if isinstance(old, dict) else in_month_list(old, every, spec)
        return baselines(stored(monthly_wide(rows, spec), "baseline-sums"), dims, baseline_years, bad_periods, keep)

    def refresh() -> Version:
        path = panel_paths[STATION.name]
        found = refresh_station_table(fact, path, sources, dims.ids, as_of, year, month, full_refresh, spec)[1]
        return found or publish(spark.createDataFrame([], STATION_PANEL), path, MONTHS)

    others = [p for name, p in panel_paths.items() if name != STATION.name] + list(final_paths.values())
    station, (base_versions, why), digest, *found = together(
        refresh,
        lambda: baseline_versions(spark, base, build, rebuild_baseline),
        lambda: {r["name"]: f"{r['rows']}:{r['digest']}" for r in dimension_digest(dims).collect()},
        *[functools.partial(current, spark, p) for p in others],
    )
    own = dict(zip(others, found))

    def rolled_up(name: str, level: Level) -> Version:
        if level is STATION:
            return station
        source = panel_paths[STATION.name]
        return propagate(
            station, panel_paths[name], own[panel_paths[name]], digest["districts"] if level is DISTRICT else "",
            lambda parts: level_panel(read_version(spark, source, station, parts), dims, level),
        )

    panels = dict(zip(LEVELS, together(*[functools.partial(rolled_up, name, level) for name, level in LEVELS.items()])))
    names = {STATION.name: digest["entity_names"], DISTRICT.name: digest["district_names"]}
    settings = {name: f"{base_versions[name].parts[''].batch} {names.get(name, '')}" for name in LEVELS}
    base_tables = {name: read_version(spark, path, base_versions[name]) for name, path in base_paths.items()}
    checks = [] if why == REUSED else [(base_tables[n], level.baseline_key, f"{n} baseline") for n, level in LEVELS.items()]
    for name, level in LEVELS.items():
        if stale := stale_parts(panels[name], own[final_paths[name]], settings[name]):
            checks.append((read_version(spark, panel_paths[name], panels[name], stale), level.panel_key, f"{name} ridership"))
    require_day_group_keys(checks)

    def finished(name: str, level: Level) -> Version:
        def finals(parts: list[str]) -> DataFrame:
            return final_table(read_version(spark, panel_paths[name], panels[name], parts), base_tables[name], dims, level)

        path = final_paths[name]
        return propagate(panels[name], path, own[path], settings[name], finals, order=month_order(level))

    finals = together(*[functools.partial(finished, name, level) for name, level in LEVELS.items()])
    before = {name: own[path] for name, path in final_paths.items()}
    tables = [*final_paths.values(), *panel_paths.values(), *base_paths.values()]
    report = f"{base}/diagnostics"
    if list(before.values()) != finals or current(spark, report) is None:
        now = {name: read_version(spark, final_paths[name], version) for name, version in zip(LEVELS, finals)}
        publish(diagnostics(now), report)
        tables.append(report)
    together(*[functools.partial(forget, spark, p, keep_versions) for p in tables])
    return {
        name: change_status(spark, before[name].rows if before[name] else None, after.rows) for name, after in zip(LEVELS, finals)
    }


def diagnostics(finals: dict[str, DataFrame]) -> DataFrame:
    """``level, kind, key, rows``: keys of station and district finals whose baseline is missing or not above zero, and
    keys without a name, with the rows they have."""
    parts = []
    for name, level in LEVELS.items():
        if level.key:
            named = finals[name].withColumn("_key", col(level.key).cast("string"))
            problems = baseline_problems(named, "_key").select("problem", "_key", "rows")
            unnamed = named.filter(col(level.label).isNull()).groupBy("_key").agg(F.count(F.lit(1)).alias("rows"))
            both = problems.unionByName(unnamed.select(F.lit("unnamed").alias("problem"), "_key", "rows"))
            parts.append(both.select(F.lit(name).alias("level"), F.col("problem").alias("kind"), F.col("_key").alias("key"), "rows"))
    return functools.reduce(DataFrame.unionByName, parts)


def published_diagnostics(spark: SparkSession, root: str) -> DataFrame:
    """``diagnostics`` of the finals as the last run that changed them left it."""
    return read_published(spark, f"{root.rstrip('/')}/diagnostics")


def published(spark: SparkSession, root: str, level: Level) -> DataFrame:
    """The final table of a level as the last complete run left it."""
    return read_published(spark, f"{root.rstrip('/')}/final_{level.name}")
