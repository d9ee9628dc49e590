"""Which months to compute, refreshes of a stored panel, and whole runs."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from panelspark.levels import CITY, DISTRICT, LEVELS, STATION
from panelspark.operators import grid as G
from panelspark.operators import months as I
from panelspark.operators import monthly as M
from panelspark.plans import local_panel as L
from panelspark.plans import monthly_update as U
from panelspark.sources import sinks as W
from panelspark.sources.publishing import read_published
from panelspark.sources.tables import load_stored_panel
from panelspark.streaming.refresh import start_refresh
from panelspark.workspace import new_path, stored
from workload import standins as S
from workload.panel_queries import CATEGORIES_SQL, CITY_FINAL, DISTRICT_FINAL, STATION_FINAL, panel_of, wide_of
from workload.registry import query

AS_OF = date(2001, 5, 20)
CANDIDATES_SQL = """years AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders),
candidates AS (SELECT year, CAST(m AS INTEGER) AS month FROM years CROSS JOIN range(1, 13) r(m) WHERE make_date(year, m, 1) <= DATE '2001-05-01')"""


@query(
    "candidate_months",
    f"WITH {CANDIDATES_SQL} SELECT year, month, CASE WHEN year < 1998 THEN 'early' ELSE 'late' END AS source FROM candidates",
)
def candidate_months(spark, d):
    return I.candidate_months(S.sources(spark, d), AS_OF)


@query(
    "future_months",
    "WITH years AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders)"
    " SELECT year, CAST(m AS INTEGER) AS month FROM years CROSS JOIN range(1, 13) r(m) WHERE make_date(year, m, 1) > DATE '2001-05-01'",
)
def future_months(spark, d):
    return I.future_months(S.sources(spark, d), AS_OF)


@query(
    "year_routing",
    """WITH y AS (SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) + 2 AS year FROM lineitem), s AS (SELECT DISTINCT year(o_orderdate) AS year FROM orders)
SELECT y.year, CASE WHEN s.year IS NULL THEN NULL WHEN y.year < 1998 THEN 'early' ELSE 'late' END AS source, s.year IS NULL AS skipped FROM y LEFT JOIN s USING (year)""",
)
def year_routing(spark, d):
    years = S.table(spark, d, "lineitem").select((F.year("l_shipdate") + 2).alias("year")).distinct()
    return I.route_years(years, S.sources(spark, d))


@query(
    "routed_rows",
    """SELECT l_orderkey, l_linenumber, l_suppkey, l_shipdate FROM lineitem WHERE year(l_shipdate) IN (SELECT year(o_orderdate) FROM orders)
AND (year(l_shipdate) >= 1998 OR l_linenumber <> 2)""",
)
def routed_rows(spark, d):
    """Two source tables with overlapping rows: each year comes from the one it is routed to."""
    df = S.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate")
    months = all_months(df, "l_shipdate")
    tables = {"early": df.filter("l_linenumber <> 2"), "late": df}
    return U.routed_fact(tables, S.sources(spark, d), months, S.FACT)


def all_months(df, time):
    """Every month of the years that the rows span."""
    first, last = df.agg(F.min(F.year(time)), F.max(F.year(time))).first()
    return [(y, m) for y in range(first, last + 1) for m in range(1, 13)] if first else []


def old_panel(spark, d):
    """A stored panel made from part of the fact: its numbers differ from the full fact's."""
    part = S.scoped(spark, d).filter("l_linenumber <= 3 and l_shipdate < timestamp_ntz'2000-01-01 00:00:00'")
    ids = S.station_ids(spark, d)
    wide = stored(M.monthly_wide(part, S.FACT), "old-sums")
    return stored(G.dense_panel(wide, ids, wide.select("year", "month").distinct()), "old-panel")


OLD_SQL = f"""old_cells AS (
  SELECT e, y, m, day_group, sum(q) AS whole, coalesce(sum(q) FILTER (WHERE cat = 'R'), 0) AS part
  FROM (SELECT l_suppkey AS e, year(l_shipdate) AS y, month(l_shipdate) AS m, CAST(l_quantity AS BIGINT) AS q, l_returnflag AS cat,
        CASE WHEN dayofweek(l_shipdate) IN (0, 6) THEN 'weekend' ELSE 'weekday' END AS dg
        FROM lineitem WHERE l_linenumber <= 3 AND l_suppkey <> 7 AND l_shipdate < TIMESTAMP '2000-01-01') JOIN groups ON day_group = dg OR day_group = 'total'
  GROUP BY e, y, m, day_group),
old_panel AS (
  SELECT i.complex_id, CAST(c.y AS INTEGER) AS year, CAST(c.m AS INTEGER) AS month, printf('%04d-%02d-01', c.y, c.m) AS period, g.day_group,
         CAST(coalesce(k.whole, 0) AS DOUBLE) AS ridership, {S.pct('coalesce(k.part, 0)', 'coalesce(k.whole, 0)')} AS omny_pct
  FROM ids i CROSS JOIN (SELECT DISTINCT y, m FROM old_cells) c CROSS JOIN groups g
  LEFT JOIN old_cells k ON k.e = i.complex_id AND k.y = c.y AND k.m = c.m AND k.day_group = g.day_group)"""


@query(
    "missing_months",
    f"""WITH {CANDIDATES_SQL}, stored AS (SELECT DISTINCT year(l_shipdate) AS year, month(l_shipdate) AS month FROM lineitem WHERE l_linenumber <= 3
AND l_suppkey <> 7 AND l_shipdate < TIMESTAMP '2000-01-01')
SELECT year, month, CASE WHEN year < 1998 THEN 'early' ELSE 'late' END AS source FROM candidates ANTI JOIN stored USING (year, month)""",
)
def missing_months(spark, d):
    return I.missing_months(I.candidate_months(S.sources(spark, d), AS_OF), old_panel(spark, d))


@query(
    "incremental_update",
    f"""WITH {S.PANEL_SQL}, {OLD_SQL}, {CANDIDATES_SQL},
wanted AS (SELECT year, month FROM candidates ANTI JOIN old_panel USING (year, month))
SELECT * FROM old_panel UNION ALL SELECT panel.* FROM panel SEMI JOIN wanted USING (year, month)""",
)
def incremental_update(spark, d):
    old = old_panel(spark, d)
    months = U.months_to_compute(spark, S.sources(spark, d), old, AS_OF)
    return U.refreshed_panel(S.scoped(spark, d), old, S.station_ids(spark, d), months, S.FACT)


@query(
    "targeted_refresh",
    f"""WITH {S.PANEL_SQL}, {OLD_SQL}, fresh AS (SELECT * FROM panel WHERE year = 1999 OR (year = 1995 AND month = 1))
SELECT * FROM old_panel ANTI JOIN fresh USING (year, month) UNION ALL SELECT * FROM fresh""",
)
def targeted_refresh(spark, d):
    """A year and an incomplete month are asked for; the incomplete month keeps its stored rows."""
    months = [(1999, m) for m in range(1, 13)] + [(1995, 1)]
    return U.refreshed_panel(S.scoped(spark, d), old_panel(spark, d), S.station_ids(spark, d), months, S.FACT)


@query(
    "full_refresh",
    f"WITH {S.PANEL_SQL}, {CANDIDATES_SQL} SELECT panel.* FROM panel SEMI JOIN candidates USING (year, month)",
)
def full_refresh(spark, d):
    old = old_panel(spark, d)
    months = U.months_to_compute(spark, S.sources(spark, d), old, AS_OF, full_refresh=True)
    return U.refreshed_panel(S.scoped(spark, d), None, S.station_ids(spark, d), months, S.FACT)


@query(
    "full_refresh_stored",
    f"""WITH {S.PANEL_SQL}, {CANDIDATES_SQL}, t AS (SELECT panel.* FROM panel SEMI JOIN candidates USING (year, month))
SELECT * REPLACE (CAST(complex_id AS VARCHAR) AS complex_id) FROM t""",
)
def full_refresh_stored(spark, d):
    """The stored panel is replaced as a whole."""
    path = new_path(spark, "station-panel")
    W.land_months(old_panel(spark, d), path)
    U.update_station_table(S.scoped(spark, d), path, S.sources(spark, d), S.station_ids(spark, d), AS_OF, full_refresh=True, spec=S.FACT)
    return load_stored_panel(spark, path)


@query(
    "full_refresh_without_complete_month",
    f"WITH {S.PANEL_SQL}, {OLD_SQL} SELECT * REPLACE (CAST(complex_id AS VARCHAR) AS complex_id) FROM old_panel",
)
def full_refresh_without_complete_month(spark, d):
    """Every month of the new fact lacks a day, so the stored panel stays as it is."""
    path = new_path(spark, "station-panel")
    W.land_months(old_panel(spark, d), path)
    fact = S.scoped(spark, d).filter("day(l_shipdate) <> 15")
    U.update_station_table(fact, path, S.sources(spark, d), S.station_ids(spark, d), AS_OF, full_refresh=True, spec=S.FACT)
    return load_stored_panel(spark, path)


@query(
    "single_entity_panel",
    f"""WITH {S.FACT_SQL}, {S.COMPLETE_SQL}, {S.GROUPS_SQL}, {S.CELLS_SQL}, own AS (SELECT DISTINCT y, m FROM fact WHERE e = 3)
SELECT CAST(3 AS BIGINT) AS complex_id, c.y AS year, c.m AS month, printf('%04d-%02d-01', c.y, c.m) AS period, g.day_group,
  CAST(coalesce(k.whole, 0) AS DOUBLE) AS ridership, {S.pct('coalesce(k.part, 0)', 'coalesce(k.whole, 0)')} AS omny_pct
FROM (SELECT * FROM complete SEMI JOIN own USING (y, m)) c CROSS JOIN groups g
LEFT JOIN cells k ON k.e = 3 AND k.y = c.y AND k.m = c.m AND k.day_group = g.day_group""",
)
def single_entity_panel(spark, d):
    fact = S.scoped(spark, d)
    return U.store_entity_panel(fact, new_path(spark, "panels"), 3, all_months(fact, S.FACT.time), S.FACT)


@query(
    "panel_upsert",
    f"""WITH {S.PANEL_SQL}, {OLD_SQL}, fresh AS (SELECT * FROM panel WHERE year IN (1999, 2000))
SELECT * FROM old_panel ANTI JOIN fresh USING (year, month) UNION ALL SELECT * FROM fresh""",
)
def panel_upsert(spark, d):
    fresh = panel_of(spark, d).filter("year in (1999, 2000)")
    return I.upsert_months(old_panel(spark, d), fresh)


@query(
    "partition_upsert",
    f"""WITH {S.PANEL_SQL}, {OLD_SQL}, fresh AS (SELECT * FROM panel WHERE year IN (1999, 2000)),
t AS (SELECT * FROM old_panel ANTI JOIN fresh USING (year, month) UNION ALL SELECT * FROM fresh)
SELECT * REPLACE (CAST(complex_id AS VARCHAR) AS complex_id) FROM t""",
)
def partition_upsert(spark, d):
    """The same upsert on stored year/month folders, of which only the refreshed ones are written."""
    path = new_path(spark, "station-panel")
    W.land_months(old_panel(spark, d), path)
    W.land_months(panel_of(spark, d).filter("year in (1999, 2000)"), path)
    return load_stored_panel(spark, path)


@query(
    "baseline_reuse",
    f"""WITH {S.STATION_SQL} SELECT count(*) * 36 AS rows, reason FROM ids
CROSS JOIN (VALUES ('missing baseline file(s)'), ('reusing existing baseline files'), ('forced rebuild requested')) t(reason) GROUP BY reason""",
)
def baseline_reuse(spark, d):
    """Three decisions in a row: nothing stored, all stored, a forced rebuild."""
    root = new_path(spark, "baselines")
    dims = U.Dimensions(
        S.station_ids(spark, d), S.districts(spark, d), S.station_names(spark, d), S.district_names(spark, d), S.special(spark, d)
    )
    wide = wide_of(spark, d)

    def step(force: bool):
        tables, why = U.baseline_or_reuse(spark, root, lambda keep: U.baselines(wide, dims, S.YEARS, S.BAD, keep), force)
        rows = tables["station"].agg(F.count(F.lit(1)).alias("rows")).withColumn("reason", F.lit(why))
        return stored(rows, "decision")

    first, second, third = (step(force) for force in (False, False, True))
    return first.unionByName(second).unionByName(third)


LOCAL_SQL = f"""WITH {CATEGORIES_SQL}, {S.STATION_SQL},
daily_complete AS (SELECT y, m FROM fact WHERE cat IS NOT NULL GROUP BY y, m HAVING count(DISTINCT CAST(ts AS DATE)) = day(last_day(make_date(y, m, 1)))),
station_panel AS (
  SELECT complex_id, c.y AS year, c.m AS month, printf('%04d-%02d-01', c.y, c.m) AS period, g.day_group,
         coalesce(A, 0) AS A, coalesce(N, 0) AS N, coalesce(R, 0) AS R
  FROM ids CROSS JOIN daily_complete c CROSS JOIN groups g
  LEFT JOIN pivoted p ON p.e = complex_id AND p.y = c.y AND p.m = c.m AND p.day_group = g.day_group)"""
SUMS = "CAST(sum(A) AS BIGINT) AS A, CAST(sum(N) AS BIGINT) AS N, CAST(sum(R) AS BIGINT) AS R"
EXACT_PCT = S.even("CAST(R AS DOUBLE) / nullif(CAST(A + N + R AS DOUBLE), 0) * 100.0", 2)


@query(
    "streamed_refresh",
    f"WITH {S.PANEL_SQL} SELECT * FROM panel",
)
def streamed_refresh(spark, d):
    """The fact lands as files; a stream works through them and refreshes the months they touch."""
    landing, panel = new_path(spark, "landing"), new_path(spark, "streamed-panel")
    fact = S.scoped(spark, d)
    fact.write.parquet(landing)
    stream = start_refresh(
        spark,
        landing,
        fact.schema,
        lambda: spark.read.schema(fact.schema).parquet(landing),
        S.station_ids(spark, d),
        panel,
        new_path(spark, "stream-marks"),
        S.FACT,
    )
    stream.awaitTermination()
    return read_published(spark, panel)


def local_of(spark, d):
    mapping = S.districts(spark, d).withColumnRenamed("complex_id", "station_complex_id")
    return L.local_panels(
        S.hourly(spark, d), S.station_ids(spark, d), mapping, S.CATEGORIES, S.FACT, S.MODES, S.EXCLUDED
    )


@query(
    "local_station_panel",
    f"{LOCAL_SQL} SELECT complex_id, year, month, period, day_group, A + N + R AS ridership, {S.pct('R', 'A + N + R')} AS omny_pct FROM station_panel",
)
def local_station_panel(spark, d):
    return local_of(spark, d)["station"]


@query(
    "local_district_panel",
    f"""{LOCAL_SQL}, t AS (SELECT puma, year, month, period, day_group, {SUMS} FROM station_panel JOIN station USING (complex_id) WHERE puma IS NOT NULL
GROUP BY puma, year, month, period, day_group)
SELECT puma, year, month, period, day_group, A + N + R AS ridership, {EXACT_PCT} AS omny_pct FROM t""",
)
def local_district_panel(spark, d):
    return local_of(spark, d)["puma"]


@query(
    "local_city_panel",
    f"""{LOCAL_SQL}, t AS (SELECT year, month, period, day_group, {SUMS} FROM station_panel GROUP BY year, month, period, day_group)
SELECT year, month, period, day_group, A + N + R AS ridership, {EXACT_PCT} AS omny_pct FROM t""",
)
def local_city_panel(spark, d):
    return local_of(spark, d)["nyc"]


@query(
    "local_comparison",
    f"""{LOCAL_SQL}, b AS (SELECT o_custkey AS complex_id, CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS k FROM orders GROUP BY ALL)
SELECT p.complex_id, year, p.month, period, A + N + R AS ridership, b.k AS baseline_ridership,
CASE WHEN b.k > 0 THEN {S.even('CAST(A + N + R AS DOUBLE) / b.k', 4)} END AS baseline_comparison, {S.pct('R', 'A + N + R')} AS omny_pct
FROM station_panel p LEFT JOIN b ON b.complex_id = p.complex_id AND b.month = p.month WHERE day_group = 'total'""",
)
def local_comparison(spark, d):
    base = S.table(spark, d, "orders").select(
        F.col("o_custkey").alias("complex_id"), F.month("o_orderdate").alias("month"), F.lit(1).cast("bigint").alias("entries")
    )
    panels = {"station": local_of(spark, d)["station"]}
    return L.local_comparison(panels, {"station": base})["station"]


def text_dimensions(spark, d):
    as_text = F.col("complex_id").cast("string").alias("complex_id")
    return U.Dimensions(
        S.station_ids(spark, d).select(as_text),
        S.districts(spark, d).select(as_text, "puma"),
        S.station_names(spark, d).select(as_text, "station_name"),
        S.district_names(spark, d),
        U.special_cases(S.special_config(spark, d)),
    )


def run_of(spark, d, routed=False):
    """A whole run into stored tables, then a second one that finds no new month; the fact may be two routed tables."""
    root, dims = new_path(spark, "run"), text_dimensions(spark, d)
    fact = S.scoped(spark, d).withColumn("l_suppkey", F.col("l_suppkey").cast("string"))
    for _ in range(2):
        U.run_monthly_update(
            {"early": fact, "late": fact} if routed else fact, dims, S.sources(spark, d), root, AS_OF, baseline_fact=fact,
            baseline_years=S.YEARS, bad_periods=S.BAD, spec=S.FACT,
        )
    return root


AS_OF_SQL = "make_date(final.year, final.month, 1) <= DATE '2001-05-01' AND final.year IN (SELECT year(o_orderdate) FROM orders)"


@query(
    "monthly_update_run",
    f"""WITH {STATION_FINAL} SELECT CAST(final.complex_id AS VARCHAR) AS complex_id, s.station_name, final.* EXCLUDE (complex_id)
FROM final LEFT JOIN (SELECT * FROM station WHERE named) s USING (complex_id) WHERE {AS_OF_SQL}""",
)
def monthly_update_run(spark, d):
    return U.published(spark, run_of(spark, d), STATION)


FINAL_COLUMNS = "year, month, period, day_group, ridership, baseline, baseline_comparison, omny_pct"


@query(
    "monthly_levels_run",
    f"""SELECT 'puma' AS level, CAST(puma AS VARCHAR) AS key, {FINAL_COLUMNS} FROM (WITH {DISTRICT_FINAL} SELECT * FROM final WHERE {AS_OF_SQL})
UNION ALL SELECT 'nyc', NULL, {FINAL_COLUMNS} FROM (WITH {CITY_FINAL} SELECT * FROM final WHERE {AS_OF_SQL})""",
)
def monthly_levels_run(spark, d):
    """District and city tables of a whole run over routed tables."""
    root = run_of(spark, d, routed=True)
    columns = FINAL_COLUMNS.split(", ")
    puma = U.published(spark, root, DISTRICT).select(F.lit("puma").alias("level"), F.col("puma").cast("string").alias("key"), *columns)
    city = U.published(spark, root, CITY)
    return puma.unionByName(city.select(F.lit("nyc").alias("level"), F.lit(None).cast("string").alias("key"), *columns))


PART_OF_FACT = "(year(l_shipdate) < 1999 OR l_linenumber <= 4 OR (year(l_shipdate) = 1999 AND month(l_shipdate) IN (3, 4)))"


def _levels(sql: str) -> str:
    """District and city rows of a run whose fact has only the rows of ``PART_OF_FACT``."""
    return sql.replace("l_suppkey <> 7)", f"l_suppkey <> 7 AND {PART_OF_FACT})")


@query(
    "month_through_levels",
    f"""SELECT 'station' AS level, CAST(complex_id AS VARCHAR) AS key, {FINAL_COLUMNS} FROM (WITH {_levels(STATION_FINAL)} SELECT * FROM final WHERE {AS_OF_SQL})
UNION ALL SELECT 'puma', CAST(puma AS VARCHAR), {FINAL_COLUMNS} FROM (WITH {_levels(DISTRICT_FINAL)} SELECT * FROM final WHERE {AS_OF_SQL})
UNION ALL SELECT 'nyc', NULL, {FINAL_COLUMNS} FROM (WITH {_levels(CITY_FINAL)} SELECT * FROM final WHERE {AS_OF_SQL})""",
)
def month_through_levels(spark, d):
    """A run on part of the fact, then two months are computed anew from all of it and go through to every level."""
    root = new_path(spark, "run")
    fact = S.scoped(spark, d).withColumn("l_suppkey", F.col("l_suppkey").cast("string"))
    some = fact.filter("year(l_shipdate) < 1999 or l_linenumber <= 4")
    args = dict(baseline_fact=fact, baseline_years=S.YEARS, bad_periods=S.BAD, spec=S.FACT)
    U.run_monthly_update(some, text_dimensions(spark, d), S.sources(spark, d), root, AS_OF, **args)
    for month in (3, 4):
        U.run_monthly_update(fact, text_dimensions(spark, d), S.sources(spark, d), root, AS_OF, year=1999, month=month, **args)
    columns = FINAL_COLUMNS.split(", ")
    parts = [
        U.published(spark, root, level).select(
            F.lit(level.name).alias("level"), (F.col(level.key) if level.key else F.lit(None)).cast("string").alias("key"), *columns
        )
        for level in LEVELS.values()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


LEVEL_COLUMNS = "year, month, period, ridership, baseline_ridership, baseline_comparison, omny_pct"
BY_ORDERS = "SELECT o_custkey AS complex_id, CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS k FROM orders GROUP BY ALL"


def _local_level(key: str, keys: str, base: str, base_key: str) -> str:
    """One level's totals against its baseline; both sides are sums of the station rows."""
    group, of_key = ("GROUP BY puma, year, month, period", " AND b.puma = t.puma") if keys else ("GROUP BY year, month, period", "")
    return f"""SELECT {key} AS key, year, t.month, period, A + N + R AS ridership, b.k AS baseline_ridership,
CASE WHEN b.k > 0 THEN {S.even('CAST(A + N + R AS DOUBLE) / b.k', 4)} END AS baseline_comparison, {EXACT_PCT} AS omny_pct
FROM (SELECT {keys}year, month, period, {SUMS} FROM station_panel {base} AND day_group = 'total' {group}) t
LEFT JOIN (SELECT {keys}month, CAST(sum(k) AS BIGINT) AS k FROM ({BY_ORDERS}) {base_key} GROUP BY {keys}month) b ON b.month = t.month{of_key}"""


@query(
    "local_levels_comparison",
    f"""{LOCAL_SQL} SELECT 'puma' AS level, * FROM ({_local_level(
        "CAST(t.puma AS VARCHAR)", "puma, ", "JOIN station USING (complex_id) WHERE puma IS NOT NULL", "JOIN station USING (complex_id) WHERE puma IS NOT NULL"
    )}) UNION ALL SELECT 'nyc', * FROM ({_local_level("NULL", "", "WHERE true", "")})""",
)
def local_levels_comparison(spark, d):
    """District and city totals against baselines that have one row per station, which are added up."""
    base = stored(
        S.table(spark, d, "orders").select(
            F.col("o_custkey").alias("complex_id"), F.month("o_orderdate").alias("month"), F.lit(1).cast("bigint").alias("entries")
        ),
        "order-counts",
    )
    in_district = base.join(S.districts(spark, d), "complex_id").filter("puma IS NOT NULL").select("puma", "month", "entries")
    panels = {name: df for name, df in local_of(spark, d).items() if name != STATION.name}
    found = L.local_comparison(panels, {DISTRICT.name: in_district, CITY.name: base.select("month", "entries")})
    columns = LEVEL_COLUMNS.split(", ")
    puma = found[DISTRICT.name].select(F.lit("puma").alias("level"), F.col("puma").cast("string").alias("key"), *columns)
    city = found[CITY.name].select(F.lit("nyc").alias("level"), F.lit(None).cast("string").alias("key"), *columns)
    return puma.unionByName(city)


def _problems(final: str, level: str, key: str, names: str) -> str:
    at = f"FROM (WITH {final} SELECT final.*, {names} WHERE {AS_OF_SQL})"
    return f"""SELECT '{level}' AS level, CASE WHEN baseline IS NULL THEN 'missing' ELSE 'non_positive' END AS kind, CAST({key} AS VARCHAR) AS key, count(*) AS rows
{at} WHERE baseline IS NULL OR baseline <= 0 GROUP BY ALL
UNION ALL SELECT '{level}', 'unnamed', CAST({key} AS VARCHAR), count(*) {at} WHERE name IS NULL GROUP BY ALL"""


@query(
    "update_diagnostics",
    _problems(STATION_FINAL, "station", "complex_id", "s.station_name AS name FROM final LEFT JOIN (SELECT * FROM station WHERE named) s USING (complex_id)")
    + " UNION ALL "
    + _problems(DISTRICT_FINAL, "puma", "puma", "n_name AS name FROM final LEFT JOIN nation ON n_nationkey = puma"),
)
def update_diagnostics(spark, d):
    """What a whole run says about baselines and names of its finals."""
    return U.published_diagnostics(spark, run_of(spark, d))
