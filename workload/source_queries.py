"""Readers and writers: each query writes a table's rows in the wanted format and reads them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.levels import STATION
from panelspark.operators import filters as P
from panelspark.operators import monthly as M
from panelspark.operators import quality as Q
from panelspark.sources import readings as R
from panelspark.sources import records as J
from panelspark.sources import sinks as W
from panelspark.sources import tables as L
from panelspark.specs import FactSpec
from panelspark.workspace import new_path
from workload import standins as S
from workload.registry import query


def hourly_text(spark, d):
    """The fact as the text columns of an hourly file, counts with thousands separators."""
    n = F.col("l_linenumber")
    return S.table(spark, d, "lineitem").select(
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("transit_timestamp"),
        F.when(n == 7, "tram").otherwise("subway").alias("transit_mode"),
        F.when(n == 1, F.lit(None)).otherwise(F.col("l_orderkey").cast("string")).alias("note"),
        F.col("l_suppkey").cast("string").alias("station_complex_id"),
        F.lower("l_returnflag").alias("payment_method"),
        F.format_number(F.col("l_quantity") * 100, 0).alias("ridership"),
    )


HOURLY_SQL = """SELECT l_shipdate AS transit_timestamp, CASE WHEN l_linenumber = 7 THEN 'tram' ELSE 'subway' END AS transit_mode,
CAST(l_suppkey AS VARCHAR) AS station_complex_id, lower(l_returnflag) AS payment_method, CAST(l_quantity * 100 AS BIGINT) AS ridership FROM lineitem"""


@query("hourly_csv_scan", HOURLY_SQL)
def hourly_csv_scan(spark, d):
    path = new_path(spark, "hourly")
    hourly_text(spark, d).write.option("header", True).csv(path)
    return L.read_hourly(spark, path)


@query(
    "record_pages",
    """SELECT CAST(o_orderkey AS VARCHAR) AS ridership, strftime(o_orderdate, '%Y-%m-%d') AS transit_timestamp, o_orderstatus AS payment_method,
'{"k":"' || o_custkey || '"}' AS georeference FROM orders WHERE o_orderpriority <> '5-LOW'""",
)
def record_pages(spark, d):
    """Each written page is one JSON array of records, some without the time field."""
    path = new_path(spark, "pages")
    k = F.col("o_orderkey")
    record = F.struct(
        k.cast("string").alias(":id"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.date_format("o_orderdate", "yyyy-MM-dd")).alias("transit_timestamp"),
        F.col("o_orderstatus").alias("payment_method"),
        k.cast("string").alias("ridership"),
        F.struct(F.col("o_custkey").cast("string").alias("k")).alias("georeference"),
    )
    # Row ids are unique, so a page has at most 5,000 records; each page is a file of its own.
    page = F.floor(F.monotonically_increasing_id() / 5000).alias("page")
    pages = S.table(spark, d, "orders").groupBy(page).agg(F.to_json(F.collect_list(record)).alias("value"))
    pages.select("value").write.option("maxRecordsPerFile", 1).text(path)
    columns = ["transit_timestamp", "payment_method", "ridership", "georeference"]
    return J.read_record_pages(spark, path, columns)


WEEK = "strftime(ts - INTERVAL 1 DAY * ((dayofweek(ts) + 1) % 7), '%y%m%d')"


def weekly_files(spark, d):
    """Weekly counter files: one folder of files per week; in one week the files lack a column."""
    path = new_path(spark, "weekly")
    ts = F.col("ts")
    sat = F.date_sub(F.to_date(ts), F.dayofweek(ts) % 7)
    rows = S.table(spark, d, "events").select(
        F.concat(F.lit("A"), (F.col("user_id") % 3).cast("string")).alias("C/A"),
        F.concat(F.lit("R"), F.col("user_id").cast("string")).alias("UNIT"),
        F.lit("00-00-00").alias("SCP"),
        F.col("event_type").alias("STATION"),
        F.concat(F.lit("L"), (F.col("event_id") % 3).cast("string")).alias("LINENAME"),
        F.lit("IRT").alias("DIVISION"),
        F.date_format(ts, "MM/dd/yyyy").alias("DATE"),
        F.date_format(ts, "HH:mm:ss").alias("TIME"),
        F.lit("REGULAR").alias("DESC"),
        F.round(F.col("value") * 100).cast("bigint").alias("ENTRIES"),
        F.col("event_id").alias("EXITS"),
        F.date_format(sat, "yyMMdd").alias("week"),
    )
    bad = F.col("week") == "240113"
    rows.filter(~bad).write.partitionBy("week").option("header", True).csv(path)
    rows.filter(bad).drop("DESC").write.mode("append").partitionBy("week").option("header", True).csv(path)
    return path


@query(
    "weekly_counter_files",
    f"""SELECT 'A' || (user_id % 3) AS ca, 'R' || user_id AS unit, event_type AS station, strftime(ts, '%m/%d/%Y') AS day, strftime(ts, '%H:%M:%S') AS clock,
CAST(round(value * 100) AS BIGINT) AS entries, event_id AS exits FROM events WHERE {WEEK} <> '240113'""",
)
def weekly_counter_files(spark, d):
    df = R.read_weekly_readings(spark, weekly_files(spark, d), r"week=(\d{6})", ordered=False)
    names = {"C/A": "ca", "UNIT": "unit", "STATION": "station", "DATE": "day", "TIME": "clock", "ENTRIES": "entries", "EXITS": "exits"}
    return df.select(*[F.col(f"`{a}`").alias(b) for a, b in names.items()])


@query(
    "weekly_file_report",
    f"""SELECT CAST({WEEK} AS INTEGER) AS week, count(*) AS rows, {WEEK} <> '240113' AS usable FROM events GROUP BY 1, 3""",
)
def weekly_file_report(spark, d):
    report = R.weekly_file_report(spark, weekly_files(spark, d), r"week=(\d{6})").filter("week is not null")
    return report.groupBy("week", "usable").agg(F.sum(F.col("lines") - 1).alias("rows")).select("week", "rows", "usable")


@query(
    "combined_files",
    "SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_suppkey AS VARCHAR) AS l_suppkey, CAST(month(l_shipdate) AS INTEGER) AS file_number FROM lineitem",
)
def combined_files(spark, d):
    path = new_path(spark, "monthly-files")
    df = S.table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", F.month("l_shipdate").alias("part"))
    df.write.partitionBy("part").option("header", True).csv(path)
    return L.combine_files(spark, path, r"part=(\d+)").select("l_orderkey", "l_suppkey", "file_number")


@query("required_columns", "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name FROM supplier")
def required_columns(spark, d):
    path = new_path(spark, "supplier")
    S.table(spark, d, "supplier").select("s_suppkey", "s_name").write.option("header", True).csv(path)
    return L.load_required(spark, path, ["s_suppkey", "s_name"], "supplier")


@query(
    "dimension_scan",
    "SELECT CAST(s_nationkey AS VARCHAR) AS complex_id, min(s_name) AS station_name FROM supplier GROUP BY 1",
)
def dimension_scan(spark, d):
    path = new_path(spark, "stations")
    S.table(spark, d, "supplier").select(F.col("s_nationkey").alias("Complex ID"), F.col("s_name").alias("Stop Name")).write.option(
        "header", True
    ).csv(path)
    return L.read_dimension(spark, path, {"Complex ID": "complex_id", "Stop Name": "station_name"}, "complex_id")


@query(
    "special_case_scan",
    """SELECT CAST(s_suppkey AS VARCHAR) AS complex_id, unnest(CASE WHEN s_nationkey IN (3, 13) THEN [1995, 1996, 1997] WHEN s_nationkey IN (4, 14) THEN [1995, 1996]
WHEN s_nationkey IN (5, 15) THEN [1993, 1994] ELSE [1998] END) AS year FROM supplier WHERE s_nationkey IN (3, 4, 5, 6, 13, 14, 15, 16)""",
)
def special_case_scan(spark, d):
    path = new_path(spark, "special")
    S.special_config(spark, d).drop("line").write.option("header", True).csv(path)
    years = L.special_years(L.read_special_cases(spark, path))
    return years.select("complex_id", F.explode("years").alias("year"))


@query(
    "source_map",
    "SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year, CASE WHEN year(o_orderdate) < 1998 THEN 'early' ELSE 'late' END AS source FROM orders",
)
def source_map(spark, d):
    """A {year: source} object; the years of any order table are bounded by the calendar."""
    path = new_path(spark, "source-map")
    pairs = S.sources(spark, d).agg(
        F.to_json(F.map_from_entries(F.collect_set(F.struct(F.col("year").cast("string"), "source")))).alias("value")
    )
    pairs.write.text(path)
    return L.read_source_map(spark, path)


@query(
    "stored_panel_scan",
    """SELECT CAST(c_custkey AS VARCHAR) AS complex_id, 2020 AS year, CAST(c_custkey % 12 + 1 AS INTEGER) AS month, '2020-01-01' AS period, 'total' AS day_group,
CASE WHEN c_custkey % 3 = 0 THEN 0.0 ELSE c_acctbal END AS ridership, 0.0::DOUBLE AS omny_pct FROM customer""",
)
def stored_panel_scan(spark, d):
    path = new_path(spark, "stored-panel")
    k = F.col("c_custkey")
    S.table(spark, d, "customer").select(
        k.alias("complex_id"),
        F.lit("2020").alias("year"),
        (k % 12 + 1).alias("month"),
        F.lit("2020-01-01").alias("period"),
        F.lit("total").alias("day_group"),
        F.when(k % 3 == 0, "?").otherwise(F.col("c_acctbal").cast("string")).alias("ridership"),
        F.lit(None).cast("string").alias("omny_pct"),
    ).write.option("header", True).csv(path)
    return L.load_stored_panel(spark, path, fmt="csv")


@query(
    "panel_sink",
    """WITH t AS (SELECT l_suppkey AS e, CAST(year(l_shipdate) AS INTEGER) AS y, CAST(month(l_shipdate) AS INTEGER) AS m, CAST(l_quantity AS BIGINT) AS q,
CASE WHEN dayofweek(l_shipdate) IN (0, 6) THEN 'weekend' ELSE 'weekday' END AS day_group FROM lineitem)
SELECT CAST(e AS VARCHAR) AS complex_id, y AS year, m AS month, day_group, CAST(sum(q) AS BIGINT) AS ridership FROM t GROUP BY ALL""",
)
def panel_sink(spark, d):
    path = new_path(spark, "panel")
    sums = M.day_group_sums(S.hourly(spark, d), S.FACT)
    columns = ["complex_id", "year", "month", "day_group", "ridership"]
    W.write_panel(sums, path, columns, ["year", "month", "complex_id", "day_group"], ["complex_id"])
    back = L.load_required(spark, path, columns, "panel")
    return back.select(
        "complex_id", F.col("year").cast("int"), F.col("month").cast("int"), "day_group", F.col("ridership").cast("bigint")
    )


@query(
    "month_landing",
    "SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders",
)
def month_landing(spark, d):
    """Land everything, then land one year again: its months are replaced, the others stay."""
    path = new_path(spark, "landing")
    orders = S.table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    W.land_months(orders, path, "o_orderdate")
    again = P.in_month_list(orders, [(1997, m) for m in range(1, 13)], FactSpec(time="o_orderdate"))
    W.land_months(again, path, "o_orderdate")
    return spark.read.parquet(path).select("o_orderkey", "o_totalprice", "year", "month")


@query(
    "landing_reconciliation",
    "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS source_rows, count(*) AS landed_rows, 'matched' AS status FROM orders GROUP BY 1, 2",
)
def landing_reconciliation(spark, d):
    path = new_path(spark, "landing")
    orders = S.table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    W.land_months(orders, path, "o_orderdate")
    landed = spark.read.parquet(path).groupBy("year", "month").agg(F.count(F.lit(1)).alias("rows"))
    return Q.reconcile_months(M.monthly_rows(orders, "o_orderdate"), landed)


@query(
    "change_report",
    """WITH a AS (SELECT count(*) AS n FROM lineitem WHERE l_linenumber <> 7), b AS (SELECT count(*) AS n FROM lineitem)
SELECT CASE WHEN a.n = b.n THEN 'unchanged' ELSE a.n || ' → ' || b.n END AS status, a.n AS previous_rows, b.n AS current_rows FROM a, b""",
)
def change_report(spark, d):
    df = S.table(spark, d, "lineitem")
    return W.change_report(df.filter("l_linenumber <> 7"), df)


@query(
    "level_output",
    """SELECT c_custkey AS complex_id, CAST(c_nationkey AS INTEGER) AS year, CAST(c_custkey % 12 + 1 AS INTEGER) AS month, 'p' AS period, 'total' AS day_group,
c_acctbal AS ridership, 0.0::DOUBLE AS omny_pct FROM customer""",
)
def level_output(spark, d):
    k = F.col("c_custkey")
    df = S.table(spark, d, "customer").select(
        F.lit(0.0).alias("omny_pct"),
        F.col("c_acctbal").alias("ridership"),
        k.alias("station_complex_id"),
        (k % 12 + 1).cast("int").alias("month"),
        F.col("c_nationkey").alias("year"),
        F.lit("p").alias("period"),
        F.lit("total").alias("day_group"),
    )
    return P.as_columns(df, STATION.panel_columns, {"station_complex_id": "complex_id"})
