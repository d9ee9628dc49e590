"""Counter readings: outliers, differences, daily sums, counter baselines."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.operators import baseline as B
from panelspark.operators import counters as K
from panelspark.operators import filters as P
from panelspark.operators import monthly as M
from panelspark.plans import counter_baseline as U
from panelspark.plans import counter_staging as G
from panelspark.sources.readings import read_weekly_readings
from panelspark.workspace import new_path, stored
from workload import standins as S
from workload.registry import query
from workload.source_queries import WEEK, weekly_files

# At these sizes the published factor removes no device, so a higher one is used.
FACTOR = 0.9

LOW_SQL = f"""{S.READINGS_SQL},
counts AS (SELECT user_id, count(*) AS readings FROM readings GROUP BY user_id),
freq AS (SELECT readings, count(*) AS devices FROM counts GROUP BY readings),
modal AS (SELECT readings AS mode FROM freq ORDER BY devices DESC, readings LIMIT 1),
low AS (SELECT c.* FROM counts c CROSS JOIN modal WHERE c.readings < mode * {FACTOR}::DOUBLE)"""

LAG_SQL = """lagged AS (
  SELECT *, lag(ts) OVER w AS prev_time, n - lag(n) OVER w AS dn, x - lag(x) OVER w AS dx
  FROM {source} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"""
DELTA_SQL = """delta AS (
  SELECT *, least(greatest(dn, 0), 7200) AS cn, least(greatest(dx, 0), 7200) AS cx, CAST(prev_time AS DATE) AS d
  FROM lagged WHERE dn IS NOT NULL AND dx IS NOT NULL)"""
DAILY_SQL = """names AS (SELECT e, d, event_type, count(*) AS k FROM delta WHERE e IS NOT NULL GROUP BY ALL),
top_name AS (SELECT e, d, arg_min(event_type, (-k, event_type)) AS name FROM names GROUP BY e, d),
daily AS (
  SELECT e, d, CAST(sum(cn) AS BIGINT) AS entries, CAST(sum(cx) AS BIGINT) AS exits, count(DISTINCT user_id) AS devices,
         string_agg(DISTINCT line, ', ' ORDER BY line) AS lines
  FROM delta WHERE e IS NOT NULL GROUP BY e, d)"""
READ_DELTA = f"{S.READINGS_SQL}, {LAG_SQL.format(source='readings')}, {DELTA_SQL}"


@query("device_reading_counts", f"WITH {LOW_SQL} SELECT * FROM counts")
def device_reading_counts(spark, d):
    return K.reading_counts(S.readings(spark, d), S.COUNTER)


@query("modal_reading_count", f"WITH {LOW_SQL} SELECT mode FROM modal")
def modal_reading_count(spark, d):
    return K.modal_count(K.reading_counts(S.readings(spark, d), S.COUNTER))


def few(spark, d):
    counts = stored(K.reading_counts(S.readings(spark, d), S.COUNTER), "reading-counts")
    return K.low_count_devices(counts, FACTOR)


@query("low_count_devices", f"WITH {LOW_SQL} SELECT * FROM low")
def low_count_devices(spark, d):
    return few(spark, d)


@query("outlier_devices_removed", f"WITH {LOW_SQL} SELECT event_id, user_id FROM readings WHERE user_id NOT IN (SELECT user_id FROM low)")
def outlier_devices_removed(spark, d):
    return K.without_devices(S.readings(spark, d), stored(few(spark, d), "few-readings"), S.COUNTER).select("event_id", "user_id")


@query(
    "previous_reading",
    f"WITH {S.READINGS_SQL}, {LAG_SQL.format(source='readings')} SELECT event_id, user_id, prev_time FROM lagged",
)
def previous_reading(spark, d):
    df = K.with_previous(S.chunked(spark, d), S.COUNTER)
    return df.select("event_id", "user_id", F.col("prev.time").alias("prev_time"))


@query(
    "counter_differences",
    f"WITH {S.READINGS_SQL}, {LAG_SQL.format(source='readings')} SELECT event_id, dn AS entries_diff, dx AS exits_diff FROM lagged",
)
def counter_differences(spark, d):
    df = K.raw_deltas(S.chunked(spark, d), S.COUNTER)
    return df.select("event_id", F.col("ENTRIES_DIFF").alias("entries_diff"), F.col("EXITS_DIFF").alias("exits_diff"))


@query(
    "clean_counter_deltas",
    f"WITH {READ_DELTA} SELECT event_id, user_id, cn AS entries, cx AS exits, d AS service_date FROM delta",
)
def clean_counter_deltas(spark, d):
    df = K.counter_deltas(S.chunked(spark, d), S.COUNTER)
    return df.select(
        "event_id", "user_id", F.col("ENTRIES_DIFF").alias("entries"), F.col("EXITS_DIFF").alias("exits"), "service_date"
    )


@query(
    "marked_counter_deltas",
    f"""WITH {S.READINGS_SQL}, marked AS (SELECT * FROM readings WHERE mi IN (0, 22, 30)), {LAG_SQL.format(source='marked')}, {DELTA_SQL}
SELECT event_id, user_id, cn AS entries, cx AS exits, d AS service_date FROM delta""",
)
def marked_counter_deltas(spark, d):
    df = K.counter_deltas(P.at_reporting_marks(S.chunked(spark, d)), S.COUNTER)
    return df.select(
        "event_id", "user_id", F.col("ENTRIES_DIFF").alias("entries"), F.col("EXITS_DIFF").alias("exits"), "service_date"
    )


@query(
    "day_chunk_deltas",
    f"WITH {READ_DELTA} SELECT event_id, user_id, cn AS entries, cx AS exits, d AS service_date FROM delta",
)
def day_chunk_deltas(spark, d):
    """Without storing: the day as chunk, for devices that report at a bounded rate."""
    by_day = S.readings(spark, d).withColumn("chunk", K.daily_chunk("ts"))
    df = K.counter_deltas(by_day, S.COUNTER)
    return df.select(
        "event_id", "user_id", F.col("ENTRIES_DIFF").alias("entries"), F.col("EXITS_DIFF").alias("exits"), "service_date"
    )


@query(
    "midnight_spans",
    f"WITH {READ_DELTA} SELECT count(*) FILTER (WHERE hour(prev_time) = 20 AND hour(ts) = 0) AS midnight_spans, count(*) AS deltas FROM delta",
)
def midnight_spans(spark, d):
    return K.midnight_spans(K.counter_deltas(S.chunked(spark, d), S.COUNTER), S.COUNTER)


@query(
    "daily_complex_sums",
    f"""WITH {READ_DELTA}, {DAILY_SQL} SELECT e AS "Complex ID", d AS "DATE", entries AS "ENTRIES", exits AS "EXITS",
devices AS "TURNSTILE_COUNT", name AS "PRIMARY_STATION_NAME", lines AS "LINES" FROM daily JOIN top_name USING (e, d)""",
)
def daily_complex_sums(spark, d):
    return K.daily_entity_sums(K.counter_deltas(S.chunked(spark, d), S.COUNTER), S.COUNTER)


@query(
    "daily_calendar",
    f"""WITH {READ_DELTA}, {DAILY_SQL} SELECT e AS "Complex ID", d AS "DATE", dayname(d) AS "DAY_OF_WEEK", isodow(d) < 6 AS "WEEKDAY",
CAST(year(d) AS INTEGER) AS "YEAR", CAST(month(d) AS INTEGER) AS "MONTH" FROM daily""",
)
def daily_calendar(spark, d):
    daily = K.daily_entity_sums(K.counter_deltas(S.chunked(spark, d), S.COUNTER), S.COUNTER)
    return K.with_calendar(daily).select("Complex ID", "DATE", "DAY_OF_WEEK", "WEEKDAY", "YEAR", "MONTH")


@query(
    "counter_profile",
    f"""WITH {READ_DELTA}, {DAILY_SQL} SELECT min(d) AS first_date, max(d) AS last_date, count(DISTINCT e) AS entities,
CAST(sum(entries) AS BIGINT) AS entries, CAST(sum(exits) AS BIGINT) AS exits FROM daily""",
)
def counter_profile(spark, d):
    return K.counter_profile(K.daily_entity_sums(K.counter_deltas(S.chunked(spark, d), S.COUNTER), S.COUNTER))


@query(
    "top_complexes",
    f"""WITH {READ_DELTA}, {DAILY_SQL} SELECT e AS "Complex ID", CAST(sum(entries) AS BIGINT) AS "ENTRIES", min(name) AS "PRIMARY_STATION_NAME"
FROM daily JOIN top_name USING (e, d) GROUP BY e ORDER BY 2 DESC, 1 LIMIT 10""",
)
def top_complexes(spark, d):
    daily = K.daily_entity_sums(K.counter_deltas(S.chunked(spark, d), S.COUNTER), S.COUNTER)
    return P.top_entities(daily, "Complex ID", "ENTRIES", "PRIMARY_STATION_NAME")


@query(
    "reading_complex_mapping",
    """SELECT event_id, user_id, s_nationkey AS complex_id FROM events
LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 1000) ON s_suppkey = user_id""",
)
def reading_complex_mapping(spark, d):
    readings = S.table(spark, d, "events").select("event_id", "user_id")
    mapping = S.table(spark, d, "supplier").filter("s_acctbal > 1000").select(
        F.col("s_suppkey").alias("user_id"), F.col("s_nationkey").alias("complex_id")
    )
    return K.map_to_entity(readings, mapping, "user_id", "complex_id")


@query("unique_station_names", "SELECT DISTINCT event_type, 'L' || (event_id % 3) AS line FROM events")
def unique_station_names(spark, d):
    df = K.unique_station_names(S.readings(spark, d), "event_type", "LINENAME")
    return df.withColumnRenamed("LINENAME", "line")


# Counter baselines: customers stand in for complexes and order totals for daily counts.

LOCAL_SQL = """special AS (
  SELECT s_suppkey AS e, CASE WHEN s_nationkey IN (3, 13) THEN [1995, 1996, 1997] WHEN s_nationkey IN (4, 14) THEN [1995, 1996]
         WHEN s_nationkey IN (5, 15) THEN [1993, 1994] ELSE [1998] END AS years
  FROM supplier WHERE s_nationkey IN (3, 4, 5, 6, 13, 14, 15, 16)),
sums AS (SELECT l_suppkey AS e, year(l_shipdate) AS y, CAST(month(l_shipdate) AS INTEGER) AS m, sum(CAST(l_quantity AS BIGINT)) AS n, count(*) AS x
         FROM lineitem GROUP BY ALL),
means AS (
  SELECT e, m, sum(n) / 3.0::DOUBLE AS n, sum(x) / 3.0::DOUBLE AS x FROM sums
  WHERE e NOT IN (SELECT e FROM special) AND y IN (1996, 1997, 1998) GROUP BY e, m
  UNION ALL
  SELECT e, m, sum(n) / CAST(len(years) AS DOUBLE), sum(x) / CAST(len(years) AS DOUBLE) FROM sums JOIN special USING (e)
  WHERE list_contains(years, y) GROUP BY e, m, years)"""
LOCAL_GRID = f"""{S.STATION_SQL}, {LOCAL_SQL},
local_base AS (SELECT complex_id, CAST(r.m AS INTEGER) AS month, coalesce(n, 0.0::DOUBLE) AS entries, coalesce(x, 0.0::DOUBLE) AS exits
  FROM ids CROSS JOIN range(1, 13) r(m) LEFT JOIN means ON means.e = complex_id AND means.m = r.m)"""
LOCAL_SUM = "CAST(sum(CAST(entries AS DECIMAL(26, 8))) AS DOUBLE) AS entries, CAST(sum(CAST(exits AS DECIMAL(26, 8))) AS DOUBLE) AS exits"


def monthly_counts(spark, d):
    daily = S.table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("Complex ID"),
        F.to_date("l_shipdate").alias("DATE"),
        F.col("l_quantity").cast("bigint").alias("ENTRIES"),
        F.lit(1).cast("bigint").alias("EXITS"),
    )
    return stored(M.entity_month_totals(daily, "Complex ID", "DATE", ["ENTRIES", "EXITS"]), "monthly-counts")


@query("counter_baseline_means", f"WITH {LOCAL_SQL} SELECT e AS complex_id, m AS month, CAST(n AS DOUBLE) AS entries, CAST(x AS DOUBLE) AS exits FROM means")
def counter_baseline_means(spark, d):
    return B.baseline_means(
        monthly_counts(spark, d), S.special(spark, d), S.YEARS, (), ("entries", "exits"), emit_empty=False, limit_special=False
    )


@query("counter_baseline_station", f"WITH {LOCAL_GRID} SELECT * FROM local_base")
def counter_baseline_station(spark, d):
    return B.local_baseline(monthly_counts(spark, d), S.special(spark, d), S.station_ids(spark, d), S.YEARS)


@query(
    "counter_baseline_district",
    f"WITH {LOCAL_GRID} SELECT puma, month, {LOCAL_SUM} FROM local_base JOIN station USING (complex_id) WHERE puma IS NOT NULL GROUP BY puma, month",
)
def counter_baseline_district(spark, d):
    base = counter_baseline_station(spark, d)
    return B.roll_up_baseline(base, S.districts(spark, d), "puma", ("entries", "exits"), None)


@query("counter_baseline_city", f"WITH {LOCAL_GRID} SELECT month, {LOCAL_SUM} FROM local_base GROUP BY month")
def counter_baseline_city(spark, d):
    return B.roll_up_baseline(counter_baseline_station(spark, d), None, None, ("entries", "exits"), None)


COUNTER_RUN = f"""WITH {LOW_SQL}, kept AS (SELECT * FROM readings WHERE user_id NOT IN (SELECT user_id FROM low) AND mi IN (0, 22, 30)),
{LAG_SQL.format(source='kept')}, {DELTA_SQL}, {DAILY_SQL}"""


@query(
    "counter_daily_table",
    f"""{COUNTER_RUN} SELECT e AS "Complex ID", d AS "DATE", entries AS "ENTRIES", exits AS "EXITS", devices AS "TURNSTILE_COUNT",
name AS "PRIMARY_STATION_NAME", lines AS "LINES", dayname(d) AS "DAY_OF_WEEK", isodow(d) < 6 AS "WEEKDAY",
CAST(year(d) AS INTEGER) AS "YEAR", CAST(month(d) AS INTEGER) AS "MONTH" FROM daily JOIN top_name USING (e, d)""",
)
def counter_daily_table(spark, d):
    chunked = S.chunked(spark, d)
    return U.daily_table(chunked, S.COUNTER, FACTOR)


@query(
    "counter_baseline_run",
    f"""{COUNTER_RUN}, {S.STATION_SQL}, sums AS (SELECT e, month(d) AS m, sum(entries) AS n, sum(exits) AS x FROM daily WHERE year(d) = 2024 GROUP BY ALL)
SELECT complex_id, CAST(r.m AS INTEGER) AS month, CAST(coalesce(n, 0) AS DOUBLE) AS entries, CAST(coalesce(x, 0) AS DOUBLE) AS exits
FROM ids CROSS JOIN range(1, 13) r(m) LEFT JOIN sums ON sums.e = complex_id AND sums.m = r.m""",
)
def counter_baseline_run(spark, d):
    daily = counter_daily_table(spark, d)
    none = S.special(spark, d).filter("false")
    return U.counter_baselines(daily, none, S.station_ids(spark, d), S.districts(spark, d), (2024,))["station"]


WEEKLY_RUN = f"""WITH {S.STATION_SQL}, raw AS (
  SELECT event_id, user_id, date_trunc('minute', ts) AS ts, CAST(round(value * 100) AS BIGINT) AS n, event_id AS x, minute(ts) AS mi,
         (length(event_type) * 3 + event_id % 3) % 10 + 1 AS place, event_id % 13 = 0 OR event_id % 11 = 0 AS dropped
  FROM events WHERE {WEEK} <> '240113'),
readings AS (SELECT * EXCLUDE (dropped), CASE WHEN place <> 4 THEN place END AS e FROM raw WHERE NOT dropped),
counts AS (SELECT user_id, count(*) AS readings FROM readings GROUP BY user_id),
freq AS (SELECT readings, count(*) AS devices FROM counts GROUP BY readings),
modal AS (SELECT readings AS mode FROM freq ORDER BY devices DESC, readings LIMIT 1),
kept AS (SELECT * FROM readings WHERE mi IN (0, 22, 30)
  AND user_id NOT IN (SELECT user_id FROM counts CROSS JOIN modal WHERE counts.readings < mode * {FACTOR}::DOUBLE)),
{LAG_SQL.format(source='kept')}, {DELTA_SQL},
sums AS (SELECT e, year(d) AS y, month(d) AS m, sum(cn) AS n, sum(cx) AS x FROM delta WHERE e IS NOT NULL GROUP BY ALL),
means AS (
  SELECT e, m, sum(n) / 2.0::DOUBLE AS n, sum(x) / 2.0::DOUBLE AS x FROM sums WHERE y IN (2023, 2024) AND e NOT IN (3, 5) GROUP BY e, m
  UNION ALL SELECT e, m, sum(n) / 1.0::DOUBLE, sum(x) / 1.0::DOUBLE FROM sums WHERE (e = 3 AND y = 2024) OR (e = 5 AND y = 2023) GROUP BY e, m),
base AS (SELECT complex_id, CAST(r.m AS INTEGER) AS month, coalesce(n, 0.0::DOUBLE) AS entries, coalesce(x, 0.0::DOUBLE) AS exits
  FROM ids CROSS JOIN range(1, 13) r(m) LEFT JOIN means ON means.e = complex_id AND means.m = r.m)
SELECT 'station' AS level, CAST(complex_id AS VARCHAR) AS key, month, entries, exits FROM base
UNION ALL SELECT 'puma', CAST(puma AS VARCHAR), month, {LOCAL_SUM} FROM base JOIN station USING (complex_id) WHERE puma IS NOT NULL GROUP BY puma, month
UNION ALL SELECT 'nyc', NULL, month, {LOCAL_SUM} FROM base GROUP BY month"""


WEEK_NAME = r"week=(\d{6})"


def in_part(weekly):
    """Readings with a denied station, a division out of scope and whole minutes."""
    n = F.col("EXITS")
    return weekly.withColumns(
        {
            "STATION": F.when(n % 13 == 0, "ORCHARD BEACH").otherwise(F.col("STATION")),
            "DIVISION": F.when(n % 11 == 0, "SIR").otherwise(F.col("DIVISION")),
            "TIME": F.concat(F.substring("TIME", 1, 5), F.lit(":00")),
        }
    )


def mapping_of(readings):
    """A map from stations to complexes that has gaps."""
    names = K.with_ids(readings).select("station_id", "STATION", "LINENAME").distinct()
    place = (F.length("STATION") * 3 + F.substring("LINENAME", 2, 1).cast("int")) % 10 + 1
    return names.select("station_id", place.cast("bigint").alias("Complex ID")).filter("`Complex ID` <> 4")


@query("weekly_baseline_run", WEEKLY_RUN)
def weekly_baseline_run(spark, d):
    """The whole counter run from weekly files, with a denied station, a division out of scope and a map with gaps,
    then a second one that has no readings and reuses the staged ones."""
    weekly = read_weekly_readings(spark, weekly_files(spark, d), WEEK_NAME)
    readings = stored(in_part(weekly), "weekly-readings")
    mapping = mapping_of(readings)
    years = F.when(F.col("complex_id") == 3, F.array(F.lit(2024))).otherwise(F.array(F.lit(2023)))
    special = S.station_ids(spark, d).filter("complex_id in (3, 5)").select("complex_id", years.alias("years"))
    root = new_path(spark, "weekly-run")
    for rows in (readings, readings.limit(0)):
        out = U.run_counter_baseline(
            rows, mapping, special, S.station_ids(spark, d), S.districts(spark, d), root, (2023, 2024), factor=FACTOR
        )
    keys = {"station": F.col("complex_id").cast("string"), "puma": F.col("puma").cast("string"), "nyc": F.lit(None).cast("string")}
    parts = [out[k].select(F.lit(k).alias("level"), key.alias("key"), "month", "entries", "exits") for k, key in keys.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "growing_staging",
    f"""{WEEKLY_RUN.split("sums AS (")[0]} names AS (SELECT e, d, event_type, count(*) AS k FROM named WHERE e IS NOT NULL GROUP BY ALL),
top_name AS (SELECT e, d, arg_min(event_type, (-k, event_type)) AS name FROM names GROUP BY e, d)
SELECT e AS "Complex ID", d AS "DATE", CAST(sum(cn) AS BIGINT) AS "ENTRIES", CAST(sum(cx) AS BIGINT) AS "EXITS",
count(DISTINCT user_id) AS "TURNSTILE_COUNT", any_value(name) AS "PRIMARY_STATION_NAME", string_agg(DISTINCT line, ', ' ORDER BY line) AS "LINES"
FROM named JOIN top_name USING (e, d) GROUP BY e, d""".replace(
        "FROM lagged WHERE dn IS NOT NULL AND dx IS NOT NULL),",
        "FROM lagged WHERE dn IS NOT NULL AND dx IS NOT NULL), named AS (SELECT delta.*, event_type, 'L' || (event_id % 3) AS line FROM delta"
        " JOIN (SELECT event_id, event_type FROM events) USING (event_id)),",
    ),
)
def growing_staging(spark, d):
    """Two weeks are staged, then all weeks of which the rest are new, then nothing; one week's files can't be used."""
    path, root = weekly_files(spark, d), new_path(spark, "growing")
    mapping = stored(mapping_of(in_part(read_weekly_readings(spark, path, WEEK_NAME))), "station-map")
    two = [f"{path}/week={w}" for w in ("231230", "240106")]
    done = [G.stage_weekly(spark, p, root, mapping, WEEK_NAME, prepare=in_part) for p in (two, path, path)]
    if done != [G.ANEW, G.ADDED, G.NOTHING_NEW]:
        raise ValueError(done)
    return G.staged_daily(spark, root, FACTOR).drop("DAY_OF_WEEK", "WEEKDAY", "YEAR", "MONTH")
