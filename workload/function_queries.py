"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.functions import calendar as D
from panelspark.functions import numbers as N
from panelspark.functions import text as T
from workload import standins as S
from workload.registry import query


@query(
    "calendar_fields",
    """SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
CAST(hour(l_shipdate) AS INTEGER) AS hour, CAST(l_shipdate AS DATE) AS day, CAST(date_trunc('month', l_shipdate) AS DATE) AS month_start,
strftime(l_shipdate, '%Y-%m-01') AS period, strftime(l_shipdate, '%b %Y') AS label,
CAST(day(last_day(l_shipdate)) AS INTEGER) AS days_in_month, dayname(l_shipdate) AS day_name, isodow(l_shipdate) < 6 AS is_weekday,
CASE WHEN dayofweek(l_shipdate) IN (0, 6) THEN 'weekend' ELSE 'weekday' END AS day_group FROM lineitem""",
)
def calendar_fields(spark, d):
    df = S.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month")
    )
    return df.select(
        "l_orderkey",
        "l_linenumber",
        "year",
        "month",
        F.hour("l_shipdate").alias("hour"),
        D.service_day("l_shipdate").alias("day"),
        D.month_start("year", "month").alias("month_start"),
        D.period_label("year", "month").alias("period"),
        D.month_label("year", "month").alias("label"),
        D.days_in_month("year", "month").alias("days_in_month"),
        D.day_name("l_shipdate").alias("day_name"),
        D.is_weekday("l_shipdate").alias("is_weekday"),
        D.day_group("l_shipdate").alias("day_group"),
    )


@query(
    "reading_timestamps",
    """SELECT event_id, date_trunc('second', ts) AS at, strftime(ts, '%m/%d/%Y') AS day_text, strftime(ts, '%M:%S') AS minute_second FROM events""",
)
def reading_timestamps(spark, d):
    text = S.table(spark, d, "events").select(
        "event_id", "ts", F.date_format("ts", "MM/dd/yyyy").alias("DATE"), F.date_format("ts", "HH:mm:ss").alias("TIME")
    )
    return text.select(
        "event_id",
        D.reading_time("DATE", "TIME").alias("at"),
        D.reading_date_text("ts").alias("day_text"),
        D.minute_second("TIME").alias("minute_second"),
    )


@query(
    "upper_category",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 6 THEN '' ELSE l_returnflag END AS category FROM lineitem""",
)
def upper_category(spark, d):
    raw = F.when(F.col("l_linenumber") != 6, F.lower("l_returnflag"))
    return S.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", T.category(raw).alias("category"))


@query(
    "lenient_numbers",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 7 IN (0, 1) THEN 0.0 ELSE o_totalprice END AS value FROM orders",
)
def lenient_numbers(spark, d):
    k = F.col("o_orderkey") % 7
    text = F.when(k == 0, "n/a").when(k != 1, F.col("o_totalprice").cast("string"))
    return S.table(spark, d, "orders").select("o_orderkey", N.lenient_double(text).alias("value"))


@query(
    "strict_integers",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 1 THEN o_orderkey * 1237 END AS value FROM orders",
)
def strict_integers(spark, d):
    n = F.col("o_orderkey") * 1237
    text = F.when(F.col("o_orderkey") % 7 != 1, F.format_number(n, 0))
    return S.table(spark, d, "orders").select("o_orderkey", N.strict_bigint(text).alias("value"))


@query(
    "half_even_rounding",
    f"SELECT l_orderkey, l_linenumber, {S.even('l_extendedprice * l_tax', 2)} AS two, {S.even('l_extendedprice / 32.0::DOUBLE', 4)} AS four FROM lineitem",
)
def half_even_rounding(spark, d):
    return S.table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        N.round_even(F.col("l_extendedprice") * F.col("l_tax"), 2).alias("two"),
        N.round_even(F.col("l_extendedprice") / 32.0, 4).alias("four"),
    )


@query(
    "shares_and_ratios",
    f"""WITH t AS (SELECT l_orderkey, l_linenumber, CAST(l_linenumber AS DOUBLE) AS part, l_quantity - 25.0 AS whole, l_extendedprice AS x FROM lineitem)
SELECT l_orderkey, l_linenumber, {S.pct('part', 'whole')} AS share, {S.even('part / nullif(whole, 0) * 100.0', 2)} AS share_or_null,
CASE WHEN whole > 0 THEN {S.even('part / whole', 4)} END AS ratio, {S.even('x * part / 100.0', 2)} AS back FROM t""",
)
def shares_and_ratios(spark, d):
    part, whole = F.col("l_linenumber").cast("double"), F.col("l_quantity") - 25.0
    return S.table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        N.share(part, whole).alias("share"),
        N.share_or_null(part, whole).alias("share_or_null"),
        N.ratio(part, whole).alias("ratio"),
        N.part_from_share(F.col("l_extendedprice"), part).alias("back"),
    )


@query(
    "clip_and_fill",
    """SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN least(greatest(c_acctbal, 0.0::DOUBLE), 7200.0::DOUBLE) END AS clipped,
CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal ELSE 0.0 END AS filled FROM customer""",
)
def clip_and_fill(spark, d):
    some = F.when(F.col("c_custkey") % 3 != 0, F.col("c_acctbal"))
    df = S.table(spark, d, "customer").select("c_custkey", N.clip(some, 0.0, 7200.0).alias("clipped"), some.alias("filled"))
    return df.na.fill(0, ["filled"])


@query(
    "baseline_year_lists",
    """SELECT s_suppkey AS complex_id, CAST(m AS INTEGER) AS month,
len(list_filter(CASE WHEN s_nationkey IN (3, 13) THEN [1996, 1997] WHEN s_nationkey IN (4, 14) THEN [1996] WHEN s_nationkey IN (5, 15) THEN CAST([] AS INTEGER[])
  ELSE [1998] END,
  lambda y: NOT (y = 1996 AND m = 1))) AS years
FROM supplier CROSS JOIN range(1, 13) r(m) WHERE s_nationkey IN (3, 4, 5, 6, 13, 14, 15, 16)""",
)
def baseline_year_lists(spark, d):
    own = F.array_intersect(T.year_list("baseline_years"), T.int_array(S.YEARS))
    rows = S.special_config(spark, d).withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12))))
    return rows.select("complex_id", "month", F.size(T.valid_years(own, F.col("month"), S.BAD)).cast("bigint").alias("years"))


@query(
    "keys_and_names",
    """WITH t AS (SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN event_type END AS a, CAST(user_id AS VARCHAR) AS b,
  CASE WHEN event_id % 4 = 0 THEN 'X' || user_id ELSE CAST(user_id AS VARCHAR) END AS ident,
  CASE event_id % 3 WHEN 0 THEN 'total' WHEN 1 THEN 'weekday' ELSE 'weekend' END AS g FROM events)
SELECT event_id, a || '_' || b AS composite, a || ' ' || b AS spaced, a || b AS joined, TRY_CAST(ident AS BIGINT) AS id_order,
list_position(['total', 'weekday', 'weekend'], g)::BIGINT AS group_order FROM t""",
)
def keys_and_names(spark, d):
    k = F.col("event_id")
    user = F.col("user_id").cast("string")
    df = S.table(spark, d, "events").select(
        "event_id",
        F.when(k % 5 != 0, F.col("event_type")).alias("a"),
        user.alias("b"),
        F.when(k % 4 == 0, F.concat(F.lit("X"), user)).otherwise(user).alias("ident"),
        F.when(k % 3 == 0, "total").when(k % 3 == 1, "weekday").otherwise("weekend").alias("g"),
    )
    return df.select(
        "event_id",
        T.joined_key("a", "b").alias("composite"),
        T.full_name("a", "b").alias("spaced"),
        T.full_name("a", "b", "").alias("joined"),
        T.id_order("ident").alias("id_order"),
        T.enum_order("g").alias("group_order"),
    )


@query(
    "compact_json",
    """SELECT c_custkey, '{"name":"' || c_name || '","at":[' || c_nationkey || ',' || c_custkey || ']}' AS json FROM customer""",
)
def compact_json(spark, d):
    nested = F.struct(F.col("c_name").alias("name"), F.array(F.col("c_nationkey").cast("bigint"), F.col("c_custkey")).alias("at"))
    return S.table(spark, d, "customer").select("c_custkey", T.compact_json(nested).alias("json"))
