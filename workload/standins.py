"""How the test tables stand in for transit tables.

Hourly fact: lineitem (time l_shipdate, entity l_suppkey, measure l_quantity, line numbers as modes).
Geography: supplier -> nation -> everything. Counters: events (device user_id).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.operators.filters import in_scope, in_scope_ids
from panelspark.plans.counter_baseline import in_chunks
from panelspark.sources.tables import special_years
from panelspark.specs import CounterSpec, FactSpec

FACT = FactSpec(
    time="l_shipdate",
    entity="l_suppkey",
    category="category",
    measure="ridership",
    mode="l_linenumber",
    share_category="R",
)
MODES = (1, 2, 3, 4, 5, 6)
EXCLUDED = (7,)
CATEGORIES = ("A", "N", "R")
YEARS = (1996, 1997, 1998)
BAD = ((1996, 1),)
PANEL_YEARS = (1999, 2000, 2001)

COUNTER = CounterSpec(
    device="user_id",
    time="ts",
    counters=("ENTRIES", "EXITS"),
    tie=("event_id",),
    chunk="chunk",
    entity="Complex ID",
    name="event_type",
    line="LINENAME",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact, one in six categories missing and the rest in lower case."""
    cat = F.when(F.col("l_linenumber") != 6, F.lower("l_returnflag"))
    return table(spark, sf_dir, "lineitem").select(
        "l_shipdate",
        "l_suppkey",
        "l_linenumber",
        cat.alias("category"),
        F.col("l_quantity").cast("bigint").alias("ridership"),
    )


def scoped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_scope(hourly(spark, sf_dir), FACT, MODES, EXCLUDED)


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    route = F.when(n == 0, "SIR").when(n != 1, F.concat(F.lit("L"), n.cast("string")))
    return table(spark, sf_dir, "supplier").select(
        k.alias("complex_id"),
        F.col("s_name").alias("station_name"),
        route.alias("route"),
        F.when(F.col("s_acctbal") >= 0, n).alias("puma"),
        (F.col("s_acctbal") <= 9000).alias("named"),
    )


def station_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_scope_ids(stations(spark, sf_dir), "complex_id", "route", "SIR")


def districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stations(spark, sf_dir).filter("puma is not null").select("complex_id", "puma")


def station_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names for most stations."""
    return stations(spark, sf_dir).filter("named").select("complex_id", "station_name")


def district_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("puma"), F.col("n_name").alias("puma_name"))


def special_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Special-case rows for the stations of eight nations; the second kind has no valid January."""
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    years = (
        F.when(n.isin(3, 13), "1995, 1996, 1997")
        .when(n.isin(4, 14), "1995,1996")
        .when(n.isin(5, 15), "1993, 1994")
        .when(n.isin(6, 16), "1998")
    )
    return (
        table(spark, sf_dir, "supplier")
        .select(k.alias("complex_id"), years.alias("baseline_years"), F.col("s_name").alias("station_name"), (k + 2).alias("line"))
        .filter("baseline_years is not null")
    )


def special(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = special_years(special_config(spark, sf_dir))
    return rows.select(F.col("complex_id").cast("bigint").alias("complex_id"), "years")


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year -> source table, from the years orders were placed in."""
    year = F.year("o_orderdate")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(year.alias("year"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("year", F.when(F.col("year") < 1998, "early").otherwise("late").alias("source"))
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counter readings."""
    entity = F.col("user_id") % 50
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "ts",
        F.round(F.col("value") * 100).cast("bigint").alias("ENTRIES"),
        ((F.col("event_id") * 7919) % 10007).alias("EXITS"),
        "event_type",
        F.concat(F.lit("L"), (F.col("event_id") % 3).cast("string")).alias("LINENAME"),
        F.when(entity != 7, entity).alias("Complex ID"),
        F.concat(F.date_format("ts", "HH:mm"), F.lit(":00")).alias("TIME"),
    )


def chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counter readings stored in even chunks that follow device and time."""
    return in_chunks(readings(spark, sf_dir), COUNTER)


# ---- SQL pieces the twins share ----

FACT_SQL = """fact AS (
  SELECT l_suppkey AS e, l_shipdate AS ts,
         CASE WHEN l_linenumber <> 6 THEN upper(l_returnflag) END AS cat,
         CAST(l_quantity AS BIGINT) AS q,
         CAST(year(l_shipdate) AS INTEGER) AS y, CAST(month(l_shipdate) AS INTEGER) AS m,
         CASE WHEN dayofweek(l_shipdate) IN (0, 6) THEN 'weekend' ELSE 'weekday' END AS dg
  FROM lineitem WHERE l_linenumber IN (1, 2, 3, 4, 5, 6) AND l_suppkey <> 7)"""

STATION_SQL = """station AS (
  SELECT s_suppkey AS complex_id, s_name AS station_name,
         CASE WHEN s_nationkey = 0 THEN 'SIR' WHEN s_nationkey <> 1 THEN 'L' || s_nationkey END AS route,
         CASE WHEN s_acctbal >= 0 THEN s_nationkey END AS puma, s_acctbal <= 9000 AS named
  FROM supplier),
ids AS (SELECT DISTINCT complex_id FROM station WHERE route IS NULL OR route <> 'SIR')"""

COMPLETE_SQL = """complete AS (
  SELECT y, m FROM fact GROUP BY y, m
  HAVING count(DISTINCT CAST(ts AS DATE)) = day(last_day(make_date(y, m, 1))))"""

GROUPS_SQL = "groups AS (SELECT unnest(['total', 'weekday', 'weekend']) AS day_group)"

# Sums and shares per observed cell.
CELLS_SQL = """cells AS (
  SELECT e, y, m, day_group, sum(q) AS whole, coalesce(sum(q) FILTER (WHERE cat = 'R'), 0) AS part
  FROM fact JOIN groups ON day_group = dg OR day_group = 'total'
  GROUP BY e, y, m, day_group)"""


def pct(part: str, whole: str) -> str:
    return (
        f"CASE WHEN {whole} > 0 THEN round_even(CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE) * 100.0 * 100.0, 0) / 100.0"
        " ELSE 0.0 END"
    )


def even(x: str, places: int) -> str:
    return f"round_even(({x}) * {float(10 ** places)}::DOUBLE, 0) / {float(10 ** places)}::DOUBLE"


PANEL_SQL = f"""{FACT_SQL}, {STATION_SQL}, {COMPLETE_SQL}, {GROUPS_SQL}, {CELLS_SQL},
panel AS (
  SELECT i.complex_id, c.y AS year, c.m AS month, printf('%04d-%02d-01', c.y, c.m) AS period, g.day_group,
         CAST(coalesce(k.whole, 0) AS DOUBLE) AS ridership,
         {pct('coalesce(k.part, 0)', 'coalesce(k.whole, 0)')} AS omny_pct
  FROM ids i CROSS JOIN complete c CROSS JOIN groups g
  LEFT JOIN cells k ON k.e = i.complex_id AND k.y = c.y AND k.m = c.m AND k.day_group = g.day_group)"""

SPECIAL_SQL = """special AS (
  SELECT s_suppkey AS e, CASE WHEN s_nationkey IN (3, 13) THEN [1996, 1997] WHEN s_nationkey IN (4, 14) THEN [1996]
         WHEN s_nationkey IN (5, 15) THEN CAST([] AS INTEGER[]) ELSE [1998] END AS years
  FROM supplier WHERE s_nationkey IN (3, 4, 5, 6, 13, 14, 15, 16))"""

BASE_SQL = f"""{SPECIAL_SQL},
usable AS (SELECT e, y, m, dg, sum(q) AS q FROM fact WHERE y BETWEEN 1996 AND 1998 AND NOT (y = 1996 AND m = 1)
           GROUP BY e, y, m, dg),
regular AS (SELECT e, m, dg, sum(q) / CASE WHEN m = 1 THEN 2.0::DOUBLE ELSE 3.0::DOUBLE END AS v
            FROM usable WHERE e NOT IN (SELECT e FROM special) GROUP BY e, m, dg),
months AS (SELECT CAST(unnest(range(1, 13)) AS INTEGER) AS m),
special_years AS (
  SELECT s.e, months.m, list_filter(s.years, lambda x: NOT (x = 1996 AND months.m = 1)) AS valid
  FROM special s CROSS JOIN months WHERE s.e IN (SELECT e FROM usable)),
special_mean AS (
  SELECT k.e, k.m, d.dg, coalesce(sum(u.q), 0) / CAST(len(k.valid) AS DOUBLE) AS v
  FROM special_years k CROSS JOIN (VALUES ('weekday'), ('weekend')) d(dg)
  LEFT JOIN usable u ON u.e = k.e AND u.m = k.m AND u.dg = d.dg AND list_contains(k.valid, u.y)
  WHERE len(k.valid) > 0 GROUP BY k.e, k.m, d.dg, k.valid),
mean AS (SELECT e, m, dg, CAST(v AS DOUBLE) AS v FROM regular
         UNION ALL SELECT e, m, dg, CAST(v AS DOUBLE) FROM special_mean)"""

STATION_BASE_SQL = f"""{BASE_SQL},
all_mean AS (SELECT e, m, dg, v FROM mean UNION ALL SELECT e, m, 'total', sum(v) FROM mean GROUP BY e, m),
base AS (
  SELECT i.complex_id, months.m AS month, g.day_group, {even('coalesce(a.v, 0.0)', 2)} AS ridership
  FROM ids i CROSS JOIN months CROSS JOIN groups g
  LEFT JOIN all_mean a ON a.e = i.complex_id AND a.m = months.m AND a.dg = g.day_group)"""

READINGS_SQL = """readings AS (
  SELECT event_id, user_id, ts, CAST(round(value * 100) AS BIGINT) AS n, (event_id * 7919) % 10007 AS x,
         event_type, 'L' || (event_id % 3) AS line,
         CASE WHEN user_id % 50 <> 7 THEN user_id % 50 END AS e, minute(ts) AS mi
  FROM events)"""
