"""Lookups on both sides of the size check, quality checks, and point in polygon."""

import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelspark.operators import filters as P
from panelspark.operators import joins as J
from panelspark.operators import quality as Q
from panelspark.operators import spatial as X


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_large_dimension_path_gives_the_same_rows(spark, how):
    """A third of the fact has one key, and some of it is copies."""
    fact = spark.range(900).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"), (F.col("id") % 90).alias("v"))
    fact = fact.union(fact.filter("k = 7")).union(spark.createDataFrame([(None, 1)], "k bigint, v bigint"))
    dim = spark.range(40).select(F.col("id").alias("k"), F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"))
    small = J.lookup(fact, dim, ["k"], how)
    large = J.lookup(fact, dim, ["k"], how, max_rows=5, parts=40)
    assert small.columns == large.columns
    assert rows(small) == rows(large)


def test_hot_keys_are_split_and_only_their_rows_repeated(spark):
    """A third of the rows have one key, a third have none, and the hot ones are copies of one row."""
    k = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 1000)
    fact = spark.range(0, 30000, 1, 16).select(k.alias("k"), F.lit("same").alias("v"))
    dim = spark.range(2000).select(F.col("id").alias("k"), F.lit("x").alias("name"))
    left, right = J.salted(fact, dim, ["k"], parts=100)
    assert left.count() == 30000
    groups = [r["count"] for r in left.groupBy("k", "_salt").count().collect()]
    # Copies in one input partition stay together: no more than that partition already held.
    assert max(groups) <= 3 * 30000 / 16
    assert J.hot_keys(fact, ["k"], 100).count() == 1
    assert right.count() == 2000 + 51 - 1
    joined = J.lookup(fact, dim, ["k"], max_rows=5, parts=100)
    assert joined.filter("name is not null").count() == 20000
    assert "rightHint" not in joined._jdf.queryExecution().analyzed().toString().splitlines()[1]


def test_size_check(spark):
    assert J.is_small(spark.range(5), 5) and not J.is_small(spark.range(6), 5)
    long_texts = spark.range(3).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert not J.is_small(long_texts, 5, 2000) and J.is_small(long_texts, 5, 4000)


def test_uniqueness_and_enum_checks(spark):
    df = spark.createDataFrame([("a", "total"), ("a", "total"), ("b", None)], "k string, day_group string")
    with pytest.raises(Q.QualityError, match="duplicate keys"):
        Q.require_unique(df, ["k"], "t")
    Q.require_unique(df.distinct(), ["k"], "t")
    with pytest.raises(Q.QualityError, match="weekend"):
        Q.require_enum(df, "day_group", "t")
    good = spark.createDataFrame([("total",), ("weekday",), ("weekend",)], "day_group string")
    Q.require_enum(good, "day_group", "t")
    assert {tuple(r) for r in Q.enum_violations(df, "day_group").collect()} == {("missing", "weekday"), ("missing", "weekend"), ("null", None)}


def test_non_negative_check(spark):
    Q.require_non_negative(spark.createDataFrame([(0,), (None,)], "x int"), "x", "t")
    with pytest.raises(Q.QualityError, match="negative"):
        Q.require_non_negative(spark.createDataFrame([(0,), (-1,)], "x int"), "x", "t")


def test_config_checks_raise_with_the_row(spark):
    config = spark.createDataFrame([("5", "2019", 2), ("x", "2019", 3)], "complex_id string, baseline_years string, line int")
    with pytest.raises(Q.QualityError, match="row 3: complex_id <x>"):
        Q.require_special_cases(config)
    with pytest.raises(Q.QualityError, match="baseline_years"):
        Q.require_special_cases(config.drop("baseline_years"))


def test_config_names_may_equal_any_official_name(spark):
    official = spark.createDataFrame([(1, "A", " (1)"), (1, "B", " (2)"), (2, "C", None)], "complex_id int, `Stop Name` string, `Display Name` string")
    config = spark.createDataFrame([(2, 1, "B (2)"), (3, 1, "Z"), (4, 9, "A (1)"), (5, 1, None)], "line int, complex_id int, station_name string")
    names = Q.official_names(official)
    found = Q.config_discrepancies(config, names)
    assert {r["line"]: r["issue"] for r in found.collect()} == {
        3: "name differs", 4: "unknown id", 5: "name differs"
    }
    assert rows(Q.expected_names(found, names)) == [(1, "A (1)"), (1, "B (2)")]


@pytest.mark.parametrize("wide", [False, True])
def test_exact_duplicates_count_missing_as_empty(spark, wide):
    data = [(1, "a", None), (2, "a", ""), (3, "a", "x"), (4, "ab", "c"), (5, "a", "bc"), (6, "a", None)]
    df = spark.createDataFrame(data, "seq int, p string, q string")
    groups = Q.duplicate_groups(df, ["p", "q"], "seq", wide)
    assert tuple(Q.duplicate_summary(groups).first()) == (6, 2)
    sample = Q.duplicate_samples(groups, 5).collect()
    assert [(r["copies"], r["first_seen"]) for r in sample] == [(3, 1)]


def test_duplicate_summary_of_nothing(spark):
    empty = spark.createDataFrame([], "p string")
    assert tuple(Q.duplicate_summary(Q.duplicate_groups(empty)).first()) == (0, 0)


def test_reconciliation_states(spark):
    a = spark.createDataFrame([(2024, 1, 5), (2024, 2, 5), (2024, 3, 5)], "year int, month int, rows bigint")
    b = spark.createDataFrame([(2024, 1, 5), (2024, 2, 4), (2024, 4, 1)], "year int, month int, rows bigint")
    got = {r["month"]: r["status"] for r in Q.reconcile_months(a, b).collect()}
    assert got == {1: "matched", 2: "mismatch", 3: "not landed", 4: "no data"}


def test_station_lists_keep_missing_station_and_drop_missing_division(spark):
    df = spark.createDataFrame([("ORCHARD BEACH", "IRT"), (None, "BMT"), ("A", None), ("A", "PTH"), ("A", "IND")], "STATION string, DIVISION string")
    assert rows(P.by_station_lists(df)) == rows(spark.createDataFrame([("A", "IND"), (None, "BMT")], df.schema))


def test_missing_route_is_in_scope(spark):
    df = spark.createDataFrame([(1, "SIR"), (2, None), (3, "A"), (3, "B")], "id int, route string")
    assert {r[0] for r in P.in_scope_ids(df, "id", "route", "SIR").collect()} == {2, 3}


# ---- point in polygon ----

L_SHAPE = "POLYGON ((0 0, 4 0, 4 2, 2 2, 2 4, 0 4, 0 0))"
WITH_HOLE = "MULTIPOLYGON (((10 0, 14 0, 14 4, 10 4, 10 0), (11 1, 13 1, 13 3, 11 3, 11 1)), ((20 0, 21 0, 20.5 1, 20 0)))"


def polygons(spark):
    df = spark.createDataFrame([("L", L_SHAPE), ("H", WITH_HOLE)], "pid string, wkt string")
    return df.select("pid", X.rings_from_wkt("wkt").alias("rings"))


def located(spark, points, cell=3.0, max_rows=None):
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "i int, x double, y double")
    return [r["pid"] for r in X.locate(df, polygons(spark), "pid", "x", "y", cell).orderBy("i").collect()]


def test_inside_outside_edge_corner_hole(spark):
    points = [(1, 1), (3, 1), (1, 3), (3, 3), (0, 2), (4, 1), (2, 3), (0, 0), (2, 2), (12, 2), (10.5, 0.5), (11, 2), (20.5, 0.5), (20.5, 1), (-5, -5), (3.999, 1.999)]
    want = ["L", "L", "L", None, None, None, None, None, None, None, "H", None, "H", None, None, "L"]
    assert located(spark, points) == want
    assert located(spark, points, cell=0.7) == want
    assert located(spark, points, cell=1000.0) == want


def inside_l(x, y):
    return (0 < x < 4 and 0 < y < 2) or (0 < x < 2 and 0 < y < 4)


@settings(max_examples=5, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from([0.5, 1.7, 50.0]))
def test_random_points_against_a_plain_rule(spark, seed, cell):
    rnd = random.Random(seed)
    points = [(rnd.choice([rnd.uniform(-1, 5), float(rnd.randint(-1, 5))]), rnd.choice([rnd.uniform(-1, 5), float(rnd.randint(-1, 5))])) for _ in range(200)]
    assert located(spark, points, cell) == ["L" if inside_l(x, y) else None for x, y in points]


def even_odd(rings, x, y):
    """A plain ray to the right; None where the point is on a side."""
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            side = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
            if side == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return None
            if (y1 > y) != (y2 > y) and (side > 0) == (y2 > y1):
                odd = not odd
    return odd


@settings(max_examples=6, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from([0.75, 1.0, 2.0, 3.0, 40.0]))
def test_any_rings_on_a_grid_of_corners_equal_a_plain_ray(spark, seed, cell):
    """Whole and half coordinates: rings cross themselves and each other, sides and corners fall on cell borders."""
    rnd = random.Random(seed)
    shapes = {k: [[(rnd.randint(-8, 24) / 2, rnd.randint(-8, 24) / 2) for _ in range(rnd.randint(3, 9))] for _ in range(2)] for k in range(3)}
    points = [(i, rnd.randint(-10, 26) / 2, rnd.randint(-10, 26) / 2) for i in range(300)]
    df = spark.createDataFrame([(k, [[{"x": a, "y": b} for a, b in r] for r in rings]) for k, rings in shapes.items()], f"pid int, rings array<{X.RING}>")
    got = X.locate(spark.createDataFrame(points, "i int, x double, y double"), df, "pid", "x", "y", cell)
    want = {(i, k) for i, x, y in points for k, rings in shapes.items() if even_odd(rings, x, y)}
    assert {(r["i"], r["pid"]) for r in got.collect() if r["pid"] is not None} == want


def test_a_polygon_of_very_many_sides(spark):
    n = 100_000
    turn = F.col("id") * (2 * math.pi / n)
    far = 100 + 20 * F.sin(turn * 40)
    vertex = F.struct("id", (far * F.cos(turn)).alias("x"), (far * F.sin(turn)).alias("y"))
    ring = spark.range(n).agg(F.array_sort(F.collect_list(vertex)).alias("v")).select(F.lit("P").alias("pid"), F.expr("array(transform(v, p -> struct(p.x AS x, p.y AS y))) AS rings"))
    cells = X.cells_of(ring, "pid", 10.0)
    most, kept = cells.agg(F.max(F.size("_sides")), F.sum(F.size("_sides"))).first()
    assert most < n / 40 and kept < 1.1 * n
    rnd = random.Random(1)
    points = [(i, rnd.uniform(-130, 130), rnd.uniform(-130, 130)) for i in range(2000)]
    got = X.locate(spark.createDataFrame(points, "i int, x double, y double"), ring, "pid", "x", "y", 10.0)
    found = {r["i"] for r in got.collect() if r["pid"]}
    for i, x, y in points:  # the sides are so short that the curve itself tells, but next to it
        edge = 100 + 20 * math.sin(40 * (math.atan2(y, x) % (2 * math.pi)))
        if abs(math.hypot(x, y) - edge) > 0.01:
            assert (i in found) == (math.hypot(x, y) < edge)
