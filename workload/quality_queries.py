"""Data-quality checks, duplicates and the spatial join."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.operators import filters as P
from panelspark.operators import joins as J
from panelspark.operators import monthly as M
from panelspark.operators import quality as Q
from panelspark.operators import spatial as X
from workload import standins as S
from workload.registry import query


@query("duplicate_keys", "SELECT l_suppkey, l_shipdate, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark, d):
    return Q.duplicate_keys(S.table(spark, d, "lineitem"), ["l_suppkey", "l_shipdate"])


@query(
    "duplicate_key_samples",
    "SELECT l_suppkey, l_shipdate, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1 ORDER BY 1, 2 LIMIT 10",
)
def duplicate_key_samples(spark, d):
    return P.first_rows(duplicate_keys(spark, d), ["l_suppkey", "l_shipdate"], 10)


@query(
    "enum_violations",
    """WITH v AS (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS s FROM orders)
SELECT 'extra' AS kind, s AS value FROM v WHERE s IS NOT NULL AND s NOT IN ('F', 'X') GROUP BY s
UNION ALL SELECT 'missing', a FROM (VALUES ('F'), ('X')) t(a) WHERE a NOT IN (SELECT s FROM v WHERE s IS NOT NULL)
UNION ALL SELECT 'null', NULL WHERE EXISTS (SELECT 1 FROM v WHERE s IS NULL)""",
)
def enum_violations(spark, d):
    v = S.table(spark, d, "orders").select(F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("s"))
    return Q.enum_violations(v, "s", ("F", "X"))


@query(
    "value_set_difference",
    """SELECT 'extra' AS kind, l_returnflag AS value FROM lineitem WHERE l_returnflag NOT IN ('A', 'Z') GROUP BY 2
UNION ALL SELECT 'missing', a FROM (VALUES ('A'), ('Z')) t(a) WHERE a NOT IN (SELECT l_returnflag FROM lineitem)""",
)
def value_set_difference(spark, d):
    return P.set_difference(S.table(spark, d, "lineitem"), "l_returnflag", ("A", "Z"))


@query("negative_measures", "SELECT count(*) AS rows, count(*) FILTER (WHERE c_acctbal < 0) AS negative FROM customer")
def negative_measures(spark, d):
    return Q.negative_count(S.table(spark, d, "customer"), "c_acctbal")


@query(
    "join_row_count",
    "SELECT count(*) AS before, count(*) AS after, true AS preserved FROM lineitem",
)
def join_row_count(spark, d):
    left = S.table(spark, d, "lineitem").select("l_suppkey", "l_orderkey")
    names = S.table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return Q.row_count_change(left, J.lookup(left, names, ["l_suppkey"]))


@query(
    "month_reconciliation",
    """WITH a AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month, count(*) AS n FROM lineitem GROUP BY 1, 2),
b AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT year, month, coalesce(a.n, 0) AS source_rows, coalesce(b.n, 0) AS landed_rows,
CASE WHEN b.n IS NULL THEN 'not landed' WHEN a.n IS NULL THEN 'no data' WHEN a.n = b.n THEN 'matched' ELSE 'mismatch' END AS status
FROM a FULL JOIN b USING (year, month)""",
)
def month_reconciliation(spark, d):
    return Q.reconcile_months(
        M.monthly_rows(S.table(spark, d, "lineitem"), "l_shipdate"), M.monthly_rows(S.table(spark, d, "orders"), "o_orderdate")
    )


@query(
    "duplicate_row_summary",
    """WITH g AS (SELECT count(*) AS n FROM lineitem GROUP BY l_suppkey, l_shipdate, l_quantity)
SELECT CAST(sum(n) AS BIGINT) AS rows_scanned, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows FROM g""",
)
def duplicate_row_summary(spark, d):
    groups = Q.duplicate_groups(S.table(spark, d, "lineitem"), ["l_suppkey", "l_shipdate", "l_quantity"])
    return Q.duplicate_summary(groups)


@query(
    "duplicate_text_summary",
    """WITH g AS (SELECT count(*) AS n FROM documents GROUP BY text)
SELECT CAST(sum(n) AS BIGINT) AS rows_scanned, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows FROM g""",
)
def duplicate_text_summary(spark, d):
    return Q.duplicate_summary(Q.duplicate_groups(S.table(spark, d, "documents"), ["text"], "doc_id", wide=True))


@query(
    "duplicate_text_samples",
    "SELECT count(*) AS copies, min(doc_id) AS first_seen FROM documents GROUP BY text HAVING count(*) > 1 ORDER BY 2 LIMIT 5",
)
def duplicate_text_samples(spark, d):
    groups = Q.duplicate_groups(S.table(spark, d, "documents"), ["text"], "doc_id", wide=True)
    return Q.duplicate_samples(groups).select("copies", "first_seen")


BAD_CONFIG = """SELECT s_suppkey + 2 AS line,
  CASE WHEN s_suppkey % 7 = 1 THEN NULL WHEN s_suppkey % 7 = 2 THEN 'C' || s_suppkey ELSE CAST(s_suppkey AS VARCHAR) END AS complex_id,
  CASE WHEN s_suppkey % 5 = 1 THEN '' WHEN s_suppkey % 5 = 2 THEN '2017, x' ELSE '2017, 2018' END AS baseline_years FROM supplier"""


def bad_config(spark, d):
    k = F.col("s_suppkey")
    text = k.cast("string")
    return S.table(spark, d, "supplier").select(
        (k + 2).alias("line"),
        F.when(k % 7 == 1, F.lit(None).cast("string")).when(k % 7 == 2, F.concat(F.lit("C"), text)).otherwise(text).alias("complex_id"),
        F.when(k % 5 == 1, "").when(k % 5 == 2, "2017, x").otherwise("2017, 2018").alias("baseline_years"),
    )


@query(
    "special_case_errors",
    f"""WITH c AS ({BAD_CONFIG}), t AS (SELECT line, CASE WHEN complex_id IS NULL THEN 'row ' || line || ': no complex_id'
  WHEN baseline_years = '' THEN 'row ' || line || ', complex_id ' || complex_id || ': no baseline_years'
  WHEN complex_id LIKE 'C%' THEN 'row ' || line || ': complex_id <' || complex_id || '> is no whole number'
  WHEN baseline_years LIKE '%x%' THEN 'row ' || line || ', complex_id ' || complex_id || ': baseline_years <' || baseline_years || '> is no list of years'
  END AS error FROM c)
SELECT * FROM t WHERE error IS NOT NULL""",
)
def special_case_errors(spark, d):
    return Q.special_case_errors(bad_config(spark, d))


@query(
    "repeated_config_ids",
    """WITH c AS (SELECT s_nationkey AS complex_id, s_name AS station_name FROM supplier)
SELECT c.complex_id, station_name, n AS entries FROM c JOIN (SELECT complex_id, count(*) AS n FROM c GROUP BY 1 HAVING count(*) > 1) USING (complex_id)""",
)
def repeated_config_ids(spark, d):
    config = S.table(spark, d, "supplier").select(F.col("s_nationkey").alias("complex_id"), F.col("s_name").alias("station_name"))
    return Q.repeated_ids(config)


CONFIG_SQL = """c AS (SELECT c_custkey + 2 AS line, c_custkey AS complex_id, c_mktsegment, CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Other'
  ELSE 'Supplier#' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') || '/' || s_nationkey END AS station_name, s_suppkey, s_name, s_nationkey
  FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey)"""


def config_and_names(spark, d):
    official = S.table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("complex_id"),
        F.col("s_name").alias("Stop Name"),
        F.concat(F.lit("/"), F.col("s_nationkey").cast("string")).alias("Display Name"),
    )
    k = F.col("c_custkey")
    own = F.concat(F.lit("Supplier#"), F.lpad(k.cast("string"), 9, "0"), F.lit("/"), F.col("s_nationkey").cast("string"))
    config = (
        S.table(spark, d, "customer")
        .join(S.table(spark, d, "supplier").select(F.col("s_suppkey").alias("c_custkey"), "s_nationkey"), "c_custkey", "left")
        .select((k + 2).alias("line"), k.alias("complex_id"), F.when(F.col("c_mktsegment") == "HOUSEHOLD", "Other").otherwise(own).alias("station_name"))
    )
    return config, Q.official_names(official)


@query(
    "config_discrepancies",
    f"""WITH {CONFIG_SQL} SELECT line, complex_id, station_name,
CASE WHEN s_suppkey IS NULL THEN 'unknown id' ELSE 'name differs' END AS issue
FROM c WHERE s_suppkey IS NULL OR c_mktsegment = 'HOUSEHOLD'""",
)
def config_discrepancies(spark, d):
    return Q.config_discrepancies(*config_and_names(spark, d))


@query(
    "config_expected_names",
    f"WITH {CONFIG_SQL} SELECT complex_id, s_name || '/' || s_nationkey AS official_name FROM c WHERE s_suppkey IS NOT NULL AND c_mktsegment = 'HOUSEHOLD'",
)
def config_expected_names(spark, d):
    config, names = config_and_names(spark, d)
    return Q.expected_names(Q.config_discrepancies(config, names), names)


@query(
    "dataset_profile",
    """SELECT count(*) AS rows, count(DISTINCT user_id) AS distinct_user_id, count(DISTINCT event_type) AS distinct_event_type,
min(ts) AS first_time, max(ts) AS last_time FROM events""",
)
def dataset_profile(spark, d):
    return Q.profile(S.table(spark, d, "events"), ["user_id", "event_type"], "ts")


@query(
    "mapping_coverage",
    """SELECT count(s_nationkey) AS matched, count(*) - count(s_nationkey) AS missing,
round_even(count(s_nationkey) / count(*) * 1000.0, 0) / 10.0 AS matched_pct
FROM events LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 1000) ON s_suppkey = user_id""",
)
def mapping_coverage(spark, d):
    readings = S.table(spark, d, "events").select("event_id", "user_id")
    mapping = S.table(spark, d, "supplier").filter("s_acctbal > 1000").select(F.col("s_suppkey").alias("user_id"), "s_nationkey")
    return J.coverage(J.lookup(readings, mapping, ["user_id"]), "s_nationkey")


@query(
    "first_station_names",
    "SELECT s_nationkey, min(s_name) AS s_name FROM supplier GROUP BY s_nationkey",
)
def first_station_names(spark, d):
    return P.keep_first(S.table(spark, d, "supplier").select("s_nationkey", "s_name"), ["s_nationkey"], ["s_name"])


@query("distinct_periods", "SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month FROM lineitem")
def distinct_periods(spark, d):
    return S.table(spark, d, "lineitem").select(*M.year_month("l_shipdate")).distinct()


@query(
    "union_by_name",
    "SELECT c_custkey AS k, c_name AS name, c_acctbal AS bal FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier",
)
def union_by_name(spark, d):
    a = S.table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("bal"))
    b = S.table(spark, d, "supplier").select(F.col("s_acctbal").alias("bal"), F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"))
    return a.unionByName(b)


# Each nation is a diamond whose centre and size follow from its key; customers are points.
DIAMOND = "abs(c_acctbal - (n_nationkey * 400.0 + 100.0)) / 150.0 + abs((c_custkey % 1000) - 500.0) / 400.0 < 1.0"


def diamonds(spark, d):
    k = F.col("n_nationkey").cast("double")
    x, y = k * 400.0 + 100.0, F.lit(500.0)

    def at(dx, dy):
        return F.struct((x + dx).alias("x"), (y + dy).alias("y"))

    ring = F.array(at(-150.0, 0.0), at(0.0, -400.0), at(150.0, 0.0), at(0.0, 400.0), at(-150.0, 0.0))
    return S.table(spark, d, "nation").select("n_nationkey", F.array(ring).alias("rings"))


@query(
    "point_in_polygon",
    f"SELECT c_custkey, c_acctbal AS x, CAST(c_custkey % 1000 AS DOUBLE) AS y, n_nationkey FROM customer LEFT JOIN nation ON {DIAMOND}",
)
def point_in_polygon(spark, d):
    points = S.table(spark, d, "customer").select(
        "c_custkey", F.col("c_acctbal").alias("x"), (F.col("c_custkey") % 1000).cast("double").alias("y")
    )
    return X.locate(points, diamonds(spark, d), "n_nationkey", "x", "y", cell=300.0)


@query(
    "point_in_wkt_rectangle",
    """SELECT c_custkey, n_nationkey FROM customer LEFT JOIN nation
ON c_acctbal > n_nationkey * 400 AND c_acctbal < n_nationkey * 400 + 400 AND NOT (c_acctbal >= n_nationkey * 400 + 100 AND c_acctbal <= n_nationkey * 400 + 200)""",
)
def point_in_wkt_rectangle(spark, d):
    """Rectangles with a rectangular hole, given as text."""
    points = S.table(spark, d, "customer").select("c_custkey", F.col("c_acctbal").alias("x"), F.lit(50.0).alias("y"))
    k = F.col("n_nationkey") * 400

    def box(a, b, lo, hi):
        def v(x, y):
            return [x.cast("string"), F.lit(f" {y}")]

        parts = [*v(a, lo), F.lit(", "), *v(b, lo), F.lit(", "), *v(b, hi), F.lit(", "), *v(a, hi), F.lit(", "), *v(a, lo)]
        return F.concat(F.lit("("), *parts, F.lit(")"))

    wkt = F.concat(F.lit("MULTIPOLYGON (("), box(k, k + 400, 0, 100), F.lit(", "), box(k + 100, k + 200, 0, 100), F.lit("))"))
    shapes = S.table(spark, d, "nation").select("n_nationkey", X.rings_from_wkt(wkt).alias("rings"))
    return X.locate(points, shapes, "n_nationkey", "x", "y", cell=400.0).select("c_custkey", "n_nationkey")
