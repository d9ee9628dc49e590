"""Monthly sums, shares, completeness, grids and roll-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.levels import CITY, DISTRICT, STATION
from panelspark.operators import baseline as B
from panelspark.operators import compare as C
from panelspark.operators import enrich as E
from panelspark.operators import filters as P
from panelspark.operators import grid as G
from panelspark.operators import joins as J
from panelspark.operators import monthly as M
from panelspark.operators import rollup as R
from panelspark.plans import monthly_update as U
from panelspark.sources.landing import complete_landed_months, complete_rows, land_fact
from panelspark.workspace import new_path, stored
from workload import standins as S
from workload.registry import query

# ---- filters ----


@query(
    "scope_filter",
    "SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity FROM lineitem"
    " WHERE l_linenumber IN (1, 2, 3, 4, 5, 6) AND l_suppkey <> 7",
)
def scope_filter(spark, d):
    df = P.in_scope(S.table(spark, d, "lineitem"), S.FACT, S.MODES, S.EXCLUDED)
    return df.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")


@query(
    "month_window",
    "SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem"
    " WHERE (l_shipdate >= TIMESTAMP '1997-12-01' AND l_shipdate < TIMESTAMP '1998-02-01')"
    " OR (l_shipdate >= TIMESTAMP '1999-02-01' AND l_shipdate < TIMESTAMP '1999-03-01')",
)
def month_window(spark, d):
    df = P.in_month_list(S.table(spark, d, "lineitem"), [(1998, 1), (1997, 12), (1999, 2)], S.FACT)
    return df.select("l_orderkey", "l_linenumber", "l_shipdate")


@query("single_entity", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_suppkey = 3")
def single_entity(spark, d):
    return P.of_entity(S.table(spark, d, "lineitem"), 3, S.FACT).select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "station_lists",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority <> '5-LOW' AND o_orderstatus IN ('F', 'O')",
)
def station_lists(spark, d):
    kept = P.by_station_lists(S.table(spark, d, "orders"), "o_orderpriority", "o_orderstatus", ("5-LOW",), ("F", "O"))
    return kept.select("o_orderkey", "o_orderpriority")


@query(
    "reporting_marks",
    "SELECT event_id, ts FROM events WHERE minute(ts) IN (0, 22, 30)",
)
def reporting_marks(spark, d):
    return P.at_reporting_marks(S.readings(spark, d)).select("event_id", "ts")


@query(
    "year_range",
    "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998",
)
def year_range(spark, d):
    df = S.table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    return P.in_years(df, "year", 1996, 1998)


@query(
    "bad_period_filter",
    f"WITH {S.FACT_SQL} SELECT e AS complex_id, y AS year, m AS month, dg AS day_group, CAST(sum(q) AS BIGINT) AS ridership"
    " FROM fact WHERE NOT (y = 1996 AND m = 1) GROUP BY e, y, m, dg",
)
def bad_period_filter(spark, d):
    return P.without_bad_periods(M.day_group_sums(S.scoped(spark, d), S.FACT), periods=S.BAD)


@query(
    "day_group_slice",
    f"WITH {S.PANEL_SQL} SELECT * FROM panel WHERE day_group = 'total'",
)
def day_group_slice(spark, d):
    return P.day_group_slice(panel_of(spark, d), "total", "panel")


@query(
    "null_key_filter",
    f"WITH {S.READINGS_SQL} SELECT count(*) AS rows, count(*) FILTER (WHERE e IS NULL) AS dropped FROM readings",
)
def null_key_filter(spark, d):
    return P.missing_key_count(S.readings(spark, d), "Complex ID")


@query(
    "null_key_rows",
    f"WITH {S.READINGS_SQL} SELECT event_id, e AS complex_id FROM readings WHERE e IS NOT NULL",
)
def null_key_rows(spark, d):
    return P.with_key(S.readings(spark, d), "Complex ID").select("event_id", F.col("Complex ID").alias("complex_id"))


@query("in_scope_entities", f"WITH {S.STATION_SQL} SELECT complex_id FROM ids")
def in_scope_entities(spark, d):
    return S.station_ids(spark, d)


@query(
    "level_columns",
    "SELECT c_custkey AS complex_id, c_mktsegment AS segment, c_acctbal AS ridership FROM customer",
)
def level_columns(spark, d):
    renames = {"c_custkey": "complex_id", "c_mktsegment": "segment", "c_acctbal": "ridership"}
    return P.as_columns(S.table(spark, d, "customer"), ["complex_id", "segment", "ridership"], renames)


@query("drop_raw_columns", "SELECT s_suppkey, s_acctbal FROM supplier")
def drop_raw_columns(spark, d):
    return P.drop_present(S.table(spark, d, "supplier"), ["s_name", "s_nationkey", "no_such_column"])


@query(
    "baseline_aliasing",
    "SELECT c_custkey AS complex_id, c_acctbal AS baseline_ridership FROM customer",
)
def baseline_aliasing(spark, d):
    df = S.table(spark, d, "customer").select(F.col("c_custkey").alias("complex_id"), F.col("c_acctbal").alias("entries"))
    return P.with_baseline_name(df)


# ---- sums and shares ----


@query(
    "monthly_category_sums",
    f"WITH {S.FACT_SQL} SELECT e AS complex_id, y AS year, m AS month, coalesce(cat, '') AS category, dg AS day_group,"
    " CAST(sum(q) AS BIGINT) AS ridership FROM fact GROUP BY ALL",
)
def monthly_category_sums(spark, d):
    return M.category_sums(S.scoped(spark, d), S.FACT)


@query(
    "monthly_day_group_sums",
    f"WITH {S.FACT_SQL} SELECT e AS complex_id, y AS year, m AS month, dg AS day_group, CAST(sum(q) AS BIGINT) AS ridership"
    " FROM fact WHERE y BETWEEN 1996 AND 1998 GROUP BY ALL",
)
def monthly_day_group_sums(spark, d):
    months = [(y, m) for y in S.YEARS for m in range(1, 13)]
    return M.day_group_sums(P.in_month_list(S.scoped(spark, d), months, S.FACT), S.FACT)


@query(
    "total_bucket",
    f"""WITH {S.FACT_SQL}, {S.GROUPS_SQL}
SELECT e AS complex_id, y AS year, m AS month, coalesce(cat, '') AS category, day_group, CAST(sum(q) AS BIGINT) AS ridership
FROM fact JOIN groups ON day_group = dg OR day_group = 'total' GROUP BY ALL""",
)
def total_bucket(spark, d):
    return M.add_total(M.category_sums(S.scoped(spark, d), S.FACT))


@query(
    "category_share",
    f"""WITH {S.FACT_SQL}, {S.GROUPS_SQL}, {S.CELLS_SQL}
SELECT e AS complex_id, y AS year, m AS month, day_group, CAST(whole AS DOUBLE) AS ridership, {S.pct('part', 'whole')} AS omny_pct
FROM cells""",
)
def category_share(spark, d):
    return M.category_share(M.add_total(M.category_sums(S.scoped(spark, d), S.FACT)), S.FACT)


METRICS_SQL = f"""WITH {S.FACT_SQL}, {S.GROUPS_SQL}, {S.CELLS_SQL}
SELECT e AS complex_id, y AS year, m AS month, printf('%04d-%02d-01', y, m) AS period, day_group,
       CAST(whole AS DOUBLE) AS ridership, {S.pct('part', 'whole')} AS omny_pct
FROM cells"""


@query("station_metrics", METRICS_SQL)
def station_metrics(spark, d):
    return M.station_metrics(S.scoped(spark, d), S.FACT)


@query(
    "daily_sums",
    f"WITH {S.FACT_SQL} SELECT CAST(ts AS DATE) AS date, e AS station_complex_id, cat AS payment_method,"
    " CAST(sum(q) AS BIGINT) AS ridership FROM fact WHERE cat IS NOT NULL GROUP BY ALL",
)
def daily_sums(spark, d):
    return M.daily_sums(S.scoped(spark, d), S.FACT)


CATEGORIES_SQL = PIVOT_SQL = f"""{S.FACT_SQL}, {S.GROUPS_SQL},
pivoted AS (
  SELECT e, y, m, day_group, CAST(coalesce(sum(q) FILTER (WHERE cat = 'A'), 0) AS BIGINT) AS A,
         CAST(coalesce(sum(q) FILTER (WHERE cat = 'N'), 0) AS BIGINT) AS N,
         CAST(coalesce(sum(q) FILTER (WHERE cat = 'R'), 0) AS BIGINT) AS R
  FROM fact JOIN groups ON day_group = dg OR day_group = 'total' WHERE cat IS NOT NULL GROUP BY e, y, m, day_group)"""


@query(
    "category_pivot",
    f"""WITH {PIVOT_SQL}
SELECT e AS station_complex_id, y AS year, m AS month, printf('%04d-%02d-01', y, m) AS period, day_group, A, N, R,
       A + N + R AS ridership, {S.pct('R', 'A + N + R')} AS omny_pct FROM pivoted""",
)
def category_pivot(spark, d):
    return M.pivot_categories(M.daily_sums(S.scoped(spark, d), S.FACT), S.CATEGORIES, "R")


@query(
    "raw_month_totals",
    """WITH t AS (SELECT o_custkey AS complex_id, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
  CAST(sum(CAST(round(o_totalprice) AS BIGINT)) AS BIGINT) AS entries, count(*) AS exits FROM orders GROUP BY ALL)
SELECT t.complex_id, c_name || ' ' || c_mktsegment AS station_name, year, month, entries, exits
FROM t LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON c_custkey = complex_id""",
)
def raw_month_totals(spark, d):
    from panelspark.functions.text import full_name

    daily = S.table(spark, d, "orders").select(
        "o_custkey", F.to_date("o_orderdate").alias("DATE"), F.round("o_totalprice").cast("bigint").alias("ENTRIES"), F.lit(1).cast("bigint").alias("EXITS")
    )
    totals = M.entity_month_totals(daily, "o_custkey", "DATE", ["ENTRIES", "EXITS"])
    names = S.table(spark, d, "customer").filter("c_acctbal > 0").select(
        F.col("c_custkey").alias("complex_id"), full_name("c_name", "c_mktsegment").alias("station_name")
    )
    return E.with_name(totals, names, "complex_id", "station_name")


@query(
    "yearly_summary",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(sum(CAST(round(o_totalprice) AS BIGINT)) AS BIGINT) AS entries,
  count(*) AS exits, count(DISTINCT o_custkey) AS entities FROM orders GROUP BY 1""",
)
def yearly_summary(spark, d):
    daily = S.table(spark, d, "orders").select(
        "o_custkey", F.to_date("o_orderdate").alias("DATE"), F.round("o_totalprice").cast("bigint").alias("ENTRIES"), F.lit(1).cast("bigint").alias("EXITS")
    )
    return M.yearly_summary(M.entity_month_totals(daily, "o_custkey", "DATE", ["ENTRIES", "EXITS"]), ["entries", "exits"])


# ---- completeness ----

REPORT_SQL = """WITH t AS (
  SELECT CAST(year({ts}) AS INTEGER) AS year, CAST(month({ts}) AS INTEGER) AS month, count(*) AS rows,
         CAST(count(DISTINCT CAST({ts} AS DATE)) AS INTEGER) AS days,
         CAST(day(last_day(min({ts}))) AS INTEGER) AS expected_days,
         bool_or(day({ts}) = 1) AS has_first_day, bool_or(day({ts}) = day(last_day({ts}))) AS has_last_day
  FROM {table} GROUP BY 1, 2)
SELECT *, days = expected_days AS complete,
       concat_ws('; ', CASE WHEN NOT has_first_day THEN 'first day missing' END,
                 CASE WHEN NOT has_last_day THEN 'last day missing' END,
                 CASE WHEN days <> expected_days THEN days || ' of ' || expected_days || ' days' END) AS reasons
FROM t"""


@query("month_completeness", REPORT_SQL.format(ts="o_orderdate", table="orders"))
def month_completeness(spark, d):
    return M.completeness(S.table(spark, d, "orders"), "o_orderdate")


@query("month_completeness_events", REPORT_SQL.format(ts="ts", table="events"))
def month_completeness_events(spark, d):
    return M.completeness(S.table(spark, d, "events"), "ts")


@query(
    "complete_month_rows",
    f"WITH {S.FACT_SQL}, {S.COMPLETE_SQL} SELECT e AS l_suppkey, ts AS l_shipdate, q AS ridership FROM fact SEMI JOIN complete USING (y, m)",
)
def complete_month_rows(spark, d):
    return M.of_complete_months(S.scoped(spark, d), "l_shipdate").select("l_suppkey", "l_shipdate", "ridership")


@query(
    "complete_landed_rows",
    f"WITH {S.FACT_SQL}, {S.COMPLETE_SQL} SELECT e AS l_suppkey, ts AS l_shipdate, q AS ridership FROM fact SEMI JOIN complete USING (y, m)",
)
def complete_landed_rows(spark, d):
    """The fact lands, a month of it twice: first without its last day, then whole."""
    path, fact = new_path(spark, "landed-fact"), S.scoped(spark, d).select("l_suppkey", "l_shipdate", "ridership")
    month = "year(l_shipdate) = 1999 and month(l_shipdate) = 5"
    land_fact(fact.filter(f"not ({month}) or day(l_shipdate) < 31"), path, "l_shipdate")
    before = complete_landed_months(spark, path, "l_shipdate")
    land_fact(fact.filter(month), path, "l_shipdate")
    after = complete_landed_months(spark, path, "l_shipdate")
    if (1999, 5) in before or set(before) - set(after):
        raise ValueError("the calendar does not follow the landings")
    return complete_rows(spark, path, "l_shipdate").select("l_suppkey", "l_shipdate", "ridership")


@query(
    "month_row_counts",
    "SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month, count(*) AS rows FROM lineitem GROUP BY 1, 2",
)
def month_row_counts(spark, d):
    return M.monthly_rows(S.table(spark, d, "lineitem"), "l_shipdate")


# ---- grid and panel ----


@query(
    "panel_grid",
    f"""WITH {S.STATION_SQL}, {S.GROUPS_SQL},
periods AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders)
SELECT complex_id, year, month, printf('%04d-%02d-01', year, month) AS period, day_group FROM ids CROSS JOIN periods CROSS JOIN groups""",
)
def panel_grid(spark, d):
    periods = S.table(spark, d, "orders").select(*M.year_month("o_orderdate")).distinct()
    return G.panel_grid(S.station_ids(spark, d), periods)


@query(
    "baseline_grid",
    f"WITH {S.STATION_SQL}, {S.GROUPS_SQL} SELECT complex_id, CAST(m AS INTEGER) AS month, day_group FROM ids CROSS JOIN range(1, 13) r(m) CROSS JOIN groups",
)
def baseline_grid(spark, d):
    return G.baseline_grid(S.station_ids(spark, d))


def wide_of(spark, d):
    return stored(M.monthly_wide(S.scoped(spark, d), S.FACT), "monthly-sums")


def panel_of(spark, d):
    return G.dense_panel(wide_of(spark, d), S.station_ids(spark, d))


@query("dense_station_panel", f"WITH {S.PANEL_SQL} SELECT * FROM panel")
def dense_station_panel(spark, d):
    return panel_of(spark, d)


@query(
    "grid_fill",
    f"""WITH {S.FACT_SQL}, {S.STATION_SQL}, {S.GROUPS_SQL}, months AS (SELECT CAST(m AS INTEGER) AS m FROM range(1, 13) r(m)),
t AS (SELECT e, m, dg, sum(q) AS q FROM fact GROUP BY ALL)
SELECT complex_id, months.m AS month, day_group, CAST(coalesce(q, 0) AS BIGINT) AS ridership
FROM ids CROSS JOIN months CROSS JOIN groups LEFT JOIN t ON e = complex_id AND t.m = months.m AND dg = day_group""",
)
def grid_fill(spark, d):
    sums = M.day_group_sums(S.scoped(spark, d), S.FACT)
    sums = sums.groupBy("complex_id", "month", "day_group").agg(F.sum("ridership").alias("ridership"))
    return G.fill_grid(G.baseline_grid(S.station_ids(spark, d)), sums, ["complex_id", "month", "day_group"], ["ridership"])


@query("panel_order", f"WITH {S.PANEL_SQL} SELECT * FROM panel")
def panel_order(spark, d):
    return G.panel_order(panel_of(spark, d), ["year", "month", "complex_id", "day_group"], ["complex_id"])


# ---- roll-ups ----


@query(
    "district_join",
    f"WITH {S.FACT_SQL}, {S.GROUPS_SQL}, {S.CELLS_SQL}, {S.STATION_SQL} SELECT complex_id, y AS year, m AS month, day_group, CAST(whole AS DOUBLE) AS ridership, puma"
    " FROM cells JOIN station ON complex_id = e WHERE puma IS NOT NULL",
)
def district_join(spark, d):
    panel = M.station_metrics(S.scoped(spark, d), S.FACT).select("complex_id", "year", "month", "day_group", "ridership")
    return R.to_district(panel, S.districts(spark, d))


@query(
    "unmapped_entities",
    f"WITH {S.FACT_SQL}, {S.GROUPS_SQL}, {S.CELLS_SQL}, {S.STATION_SQL} SELECT e AS complex_id, count(*) AS rows FROM cells"
    " WHERE e NOT IN (SELECT complex_id FROM station WHERE puma IS NOT NULL) GROUP BY e",
)
def unmapped_entities(spark, d):
    return R.unmapped(M.station_metrics(S.scoped(spark, d), S.FACT), S.districts(spark, d))


PART = S.even("ridership * omny_pct / 100.0", 2)
ROLL = f"""CAST(sum(CAST(ridership AS DECIMAL(20, 2))) AS DOUBLE) AS ridership, CAST(sum(CAST({PART} AS DECIMAL(20, 2))) AS DOUBLE) AS part"""
DISTRICT_SQL = f"""{S.PANEL_SQL},
d0 AS (SELECT puma, year, month, period, day_group, {ROLL} FROM panel JOIN station USING (complex_id) WHERE puma IS NOT NULL
       GROUP BY puma, year, month, period, day_group),
district AS (SELECT puma, year, month, period, day_group, ridership, {S.pct('part', 'ridership')} AS omny_pct FROM d0)"""
CITY_SQL = f"""{S.PANEL_SQL},
c0 AS (SELECT year, month, period, day_group, {ROLL} FROM panel GROUP BY year, month, period, day_group),
city AS (SELECT year, month, period, day_group, ridership, {S.pct('part', 'ridership')} AS omny_pct FROM c0)"""


@query("district_rollup", f"WITH {DISTRICT_SQL} SELECT * FROM district")
def district_rollup(spark, d):
    return R.roll_up(panel_of(spark, d), S.districts(spark, d), "puma")


@query("city_rollup", f"WITH {CITY_SQL} SELECT * FROM city")
def city_rollup(spark, d):
    return R.roll_up(panel_of(spark, d))


EXACT = "CAST(sum(A) AS BIGINT) AS A, CAST(sum(N) AS BIGINT) AS N, CAST(sum(R) AS BIGINT) AS R"
EXACT_PCT = S.even("CAST(R AS DOUBLE) / nullif(CAST(A + N + R AS DOUBLE), 0) * 100.0", 2)


@query(
    "district_exact_rollup",
    f"""WITH {PIVOT_SQL}, {S.STATION_SQL},
t AS (SELECT puma, y, m, day_group, {EXACT} FROM pivoted JOIN station ON complex_id = e WHERE puma IS NOT NULL GROUP BY puma, y, m, day_group)
SELECT puma, y AS year, m AS month, printf('%04d-%02d-01', y, m) AS period, day_group, A, N, R, A + N + R AS ridership, {EXACT_PCT} AS omny_pct FROM t""",
)
def district_exact_rollup(spark, d):
    pivoted = M.pivot_categories(M.daily_sums(S.scoped(spark, d), S.FACT), S.CATEGORIES, "R")
    mapping = S.districts(spark, d).withColumnRenamed("complex_id", "station_complex_id")
    return R.roll_up_categories(pivoted, S.CATEGORIES, "R", mapping, "puma")


@query(
    "city_exact_rollup",
    f"""WITH {PIVOT_SQL}, t AS (SELECT y, m, day_group, {EXACT} FROM pivoted GROUP BY y, m, day_group)
SELECT y AS year, m AS month, printf('%04d-%02d-01', y, m) AS period, day_group, A, N, R, A + N + R AS ridership, {EXACT_PCT} AS omny_pct FROM t""",
)
def city_exact_rollup(spark, d):
    pivoted = M.pivot_categories(M.daily_sums(S.scoped(spark, d), S.FACT), S.CATEGORIES, "R")
    return R.roll_up_categories(pivoted, S.CATEGORIES, "R")


# ---- baselines ----


def baseline_sums(spark, d):
    months = [(y, m) for y in S.YEARS for m in range(1, 13)]
    return stored(M.day_group_sums(P.in_month_list(S.scoped(spark, d), months, S.FACT), S.FACT), "baseline-sums")


@query(
    "baseline_regular_means",
    f"WITH {S.FACT_SQL}, {S.BASE_SQL} SELECT e AS complex_id, m AS month, dg AS day_group, CAST(v AS DOUBLE) AS ridership FROM regular",
)
def baseline_regular_means(spark, d):
    rows = baseline_sums(spark, d).join(S.special(spark, d), "complex_id", "left_anti")
    none = S.special(spark, d).filter("false")
    return B.baseline_means(rows, none, S.YEARS, S.BAD)


@query(
    "baseline_means",
    f"WITH {S.FACT_SQL}, {S.BASE_SQL} SELECT e AS complex_id, m AS month, dg AS day_group, v AS ridership FROM mean",
)
def baseline_means(spark, d):
    return B.baseline_means(baseline_sums(spark, d), S.special(spark, d), S.YEARS, S.BAD)


@query(
    "special_case_split",
    f"WITH {S.FACT_SQL}, {S.SPECIAL_SQL} SELECT e AS complex_id, y AS year, m AS month, dg AS day_group, CAST(sum(q) AS BIGINT) AS ridership,"
    " e IN (SELECT e FROM special) AS is_special FROM fact WHERE y BETWEEN 1996 AND 1998 GROUP BY e, y, m, dg",
)
def special_case_split(spark, d):
    return J.split_by_membership(baseline_sums(spark, d), S.special(spark, d), "complex_id")


def base_of(spark, d):
    return B.station_baseline(baseline_sums(spark, d), S.special(spark, d), S.station_ids(spark, d), S.YEARS, S.BAD)


DISTRICT_TAIL = f"""{S.STATION_BASE_SQL}, district_base AS (
  SELECT puma, month, day_group, {S.even('CAST(sum(CAST(ridership AS DECIMAL(20, 2))) AS DOUBLE)', 2)} AS ridership
  FROM base JOIN station USING (complex_id) WHERE puma IS NOT NULL GROUP BY puma, month, day_group)"""
CITY_TAIL = f"""{S.STATION_BASE_SQL}, city_base AS (
  SELECT month, day_group, {S.even('CAST(sum(CAST(ridership AS DECIMAL(20, 2))) AS DOUBLE)', 2)} AS ridership
  FROM base GROUP BY month, day_group)"""
HEAD = f"{S.FACT_SQL}, {S.STATION_SQL}, {S.GROUPS_SQL}"
STATION_BASE = f"{HEAD}, {S.STATION_BASE_SQL}"
DISTRICT_BASE = f"{HEAD}, {DISTRICT_TAIL}"
CITY_BASE = f"{HEAD}, {CITY_TAIL}"


@query("station_baseline", f"WITH {STATION_BASE} SELECT * FROM base")
def station_baseline(spark, d):
    return base_of(spark, d)


@query("district_baseline", f"WITH {DISTRICT_BASE} SELECT * FROM district_base")
def district_baseline(spark, d):
    return B.roll_up_baseline(base_of(spark, d), S.districts(spark, d), "puma")


@query("city_baseline", f"WITH {CITY_BASE} SELECT * FROM city_base")
def city_baseline(spark, d):
    return B.roll_up_baseline(base_of(spark, d), None, None)


@query(
    "baseline_order",
    f"WITH {STATION_BASE} SELECT * FROM base",
)
def baseline_order(spark, d):
    return G.panel_order(base_of(spark, d), ["month", "complex_id", "day_group"], ["complex_id"])


# ---- comparison and names ----


def final_sql(panel_ctes: str, panel: str, base_ctes: str, base: str, key: str | None) -> str:
    keys = [key] if key else []
    cols = ", ".join(f"p.{c}" for c in [*keys, "year", "month", "period", "day_group"])
    on = " AND ".join(f"p.{c} = b.{c}" for c in [*keys, "month", "day_group"])
    return f"""{panel_ctes}, {base_ctes},
final AS (SELECT {cols}, p.ridership, b.ridership AS baseline,
  CASE WHEN b.ridership > 0 THEN {S.even('p.ridership / b.ridership', 4)} END AS baseline_comparison, p.omny_pct
  FROM {panel} p LEFT JOIN {base} b ON {on})"""


STATION_FINAL = final_sql(S.PANEL_SQL, "panel", S.STATION_BASE_SQL, "base", "complex_id")
DISTRICT_FINAL = final_sql(DISTRICT_SQL, "district", DISTRICT_TAIL, "district_base", "puma")
CITY_FINAL = final_sql(CITY_SQL, "city", CITY_TAIL, "city_base", None)


@query("station_comparison", f"WITH {STATION_FINAL} SELECT * FROM final")
def station_comparison(spark, d):
    return C.compare(panel_of(spark, d), base_of(spark, d), STATION)


def final_at(spark, d, level):
    """A level's published table; the sums of the fact are stored once for panel and baseline."""
    wide = wide_of(spark, d)
    dims = U.Dimensions(
        S.station_ids(spark, d), S.districts(spark, d), S.station_names(spark, d), S.district_names(spark, d), S.special(spark, d)
    )
    sums = U.wide_long(wide.filter(F.col("year").isin(*S.YEARS)))
    base = B.station_baseline(sums, dims.special, dims.ids, S.YEARS, S.BAD)
    panel = G.dense_panel(wide, dims.ids)
    final = U.final_table(U.level_panel(panel, dims, level), U.level_baseline(base, dims, level), dims, level)
    return U.final_order(final, level)


@query("district_comparison", f"WITH {DISTRICT_FINAL} SELECT * FROM final")
def district_comparison(spark, d):
    base = B.roll_up_baseline(base_of(spark, d), S.districts(spark, d), "puma")
    return C.compare(R.roll_up(panel_of(spark, d), S.districts(spark, d), "puma"), base, DISTRICT)


@query("city_comparison", f"WITH {CITY_FINAL} SELECT * FROM final")
def city_comparison(spark, d):
    base = B.roll_up_baseline(base_of(spark, d), None, None)
    return C.compare(R.roll_up(panel_of(spark, d)), base, CITY)


@query(
    "baseline_problems",
    f"""WITH {STATION_FINAL} SELECT CASE WHEN baseline IS NULL THEN 'missing' ELSE 'non_positive' END AS problem, complex_id, count(*) AS rows
FROM final WHERE baseline IS NULL OR baseline <= 0 GROUP BY 1, 2""",
)
def baseline_problems(spark, d):
    return C.baseline_problems(station_comparison(spark, d))


@query(
    "comparison_summary",
    f"""WITH {STATION_FINAL} SELECT count(baseline_comparison) AS compared,
CAST(sum(CAST(baseline_comparison AS DECIMAL(24, 4))) AS DOUBLE) / count(baseline_comparison) AS mean_comparison,
min(baseline_comparison) AS min_comparison, max(baseline_comparison) AS max_comparison FROM final""",
)
def comparison_summary(spark, d):
    return C.comparison_summary(station_comparison(spark, d))


@query(
    "totals_comparison",
    f"""WITH {S.PANEL_SQL}, b AS (SELECT o_custkey AS complex_id, CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS n FROM orders GROUP BY ALL)
SELECT p.complex_id, p.year, p.month, p.period, p.ridership, b.n AS baseline_ridership,
  CASE WHEN b.n > 0 THEN {S.even('p.ridership / b.n', 4)} END AS baseline_comparison, p.omny_pct
FROM panel p LEFT JOIN b ON p.complex_id = b.complex_id AND p.month = b.month WHERE p.day_group = 'total'""",
)
def totals_comparison(spark, d):
    base = S.table(spark, d, "orders").select(
        F.col("o_custkey").alias("complex_id"), F.month("o_orderdate").alias("month"), F.lit(1).cast("bigint").alias("entries")
    )
    return C.compare_totals(panel_of(spark, d), base, STATION)


@query(
    "baseline_collapse",
    "SELECT o_custkey AS complex_id, CAST(month(o_orderdate) AS INTEGER) AS month, CAST(sum(CAST(round(o_totalprice) AS BIGINT)) AS BIGINT) AS baseline_ridership"
    " FROM orders GROUP BY 1, 2",
)
def baseline_collapse(spark, d):
    base = S.table(spark, d, "orders").select(
        F.col("o_custkey").alias("complex_id"), F.month("o_orderdate").alias("month"), F.round("o_totalprice").cast("bigint").alias("baseline_ridership")
    )
    return C.collapse(base, ["complex_id", "month"])


NAMED_SQL = f"{STATION_FINAL} SELECT f.complex_id, s.station_name, f.* EXCLUDE (complex_id) FROM final f LEFT JOIN (SELECT * FROM station WHERE named) s USING (complex_id)"


@query("station_names", f"WITH {NAMED_SQL}")
def station_names(spark, d):
    once = E.with_name(station_comparison(spark, d), S.station_names(spark, d), "complex_id", "station_name")
    return E.with_name(once, S.station_names(spark, d), "complex_id", "station_name")


@query(
    "name_coverage",
    f"""WITH t AS ({'WITH ' + NAMED_SQL}) SELECT count(station_name) AS matched, count(*) - count(station_name) AS missing,
round_even(count(station_name) / count(*) * 1000.0, 0) / 10.0 AS matched_pct FROM t""",
)
def name_coverage(spark, d):
    return E.name_coverage(station_names(spark, d), "station_name")


@query("station_published", f"WITH {NAMED_SQL}")
def station_published(spark, d):
    return final_at(spark, d, STATION)


@query(
    "district_published",
    f"WITH {DISTRICT_FINAL} SELECT puma, n_name AS puma_name, final.* EXCLUDE (puma) FROM final LEFT JOIN nation ON n_nationkey = puma",
)
def district_published(spark, d):
    return final_at(spark, d, DISTRICT)


@query("city_published", f"WITH {CITY_FINAL} SELECT * FROM final")
def city_published(spark, d):
    return final_at(spark, d, CITY)
