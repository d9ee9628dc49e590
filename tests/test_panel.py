"""Panel, baseline, comparison and refresh rules on hand-made tables."""

from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelspark.levels import CITY, STATION
from panelspark.operators import baseline as B
from panelspark.operators import compare as C
from panelspark.operators import enrich as E
from panelspark.operators import filters as P
from panelspark.operators import grid as G
from panelspark.operators import monthly as M
from panelspark.operators import months as I
from panelspark.operators import rollup as R
from panelspark.plans import monthly_update as U
from panelspark.sources.publishing import read_published

FACT = "transit_timestamp timestamp_ntz, transit_mode string, station_complex_id string, payment_method string, ridership bigint"


def fact(spark, rows):
    return spark.createDataFrame([(t, m, s, p, n) for t, m, s, p, n in rows], FACT.replace("timestamp_ntz", "string")).withColumn(
        "transit_timestamp", F.col("transit_timestamp").cast("timestamp_ntz")
    )


def month_rows(year, month, days, station="1", method="omny", n=10):
    return [(f"{year}-{month:02d}-{d:02d} 08:00:00", "subway", station, method, n) for d in range(1, days + 1)]


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_scope_drops_missing_ids_and_other_modes(spark):
    df = fact(spark, [("2024-01-01", "subway", s, "omny", 1) for s in ("1", "502", None)] + [("2024-01-01", "tram", "1", "omny", 1)])
    assert P.in_scope(df).count() == 1


def test_category_case_and_missing(spark):
    df = fact(spark, [("2024-01-01", "subway", "1", p, 10) for p in ("omny", "OMNY", None, "metrocard")])
    got = {r["category"]: r["ridership"] for r in M.category_sums(df).collect()}
    assert got == {"OMNY": 20, "": 10, "METROCARD": 10}
    daily = {r["payment_method"]: r["ridership"] for r in M.daily_sums(df).collect()}
    assert daily == {"OMNY": 20, "METROCARD": 10}
    shares = {r["day_group"]: r["omny_pct"] for r in M.station_metrics(df).collect()}
    assert shares == {"total": 50.0, "weekday": 50.0}


def test_completeness_is_global_and_grid_decides_who_is_shown(spark):
    """Two stations together cover the month; an unknown station disappears; a silent one is zero."""
    odd = [r for r in month_rows(2024, 2, 29, "1") if int(r[0][8:10]) % 2]
    even = [r for r in month_rows(2024, 2, 29, "99") if int(r[0][8:10]) % 2 == 0]
    partial = month_rows(2024, 3, 30, "1")
    wide = M.monthly_wide(fact(spark, odd + even + partial))
    ids = spark.createDataFrame([("1",), ("2",)], "complex_id string")
    panel = G.dense_panel(wide, ids).collect()
    assert {(r["complex_id"], r["month"]) for r in panel} == {("1", 2), ("2", 2)}
    assert len(panel) == 6
    assert sum(r["ridership"] for r in panel if r["day_group"] == "total") == 150.0
    assert all(r["ridership"] == 0.0 and r["omny_pct"] == 0.0 for r in panel if r["complex_id"] == "2")


def test_completeness_reasons(spark):
    report = M.completeness(fact(spark, month_rows(2024, 1, 31)[1:-1]), "transit_timestamp").first()
    assert not report["complete"] and report["days"] == 29
    assert report["reasons"] == "first day missing; last day missing; 29 of 31 days"


def special(spark, rows):
    return spark.createDataFrame(rows, "complex_id string, years array<int>")


SUMS = "complex_id string, year int, month int, day_group string, ridership bigint"


def test_divisor_is_the_configured_year_count(spark):
    sums = spark.createDataFrame([("1", 2017, 1, "weekday", 60), ("1", 2018, 1, "weekday", 60), ("1", 2018, 2, "weekday", 60)], SUMS)
    got = as_set(B.baseline_means(sums, special(spark, [])))
    assert got == {("1", 1, "weekday", 30.0), ("1", 2, "weekday", 20.0)}


def test_special_years_and_months_without_a_valid_year(spark):
    sums = spark.createDataFrame([("6", 2017, 2, "weekday", 90), ("6", 2018, 3, "weekday", 50), ("6", 2017, 1, "weekday", 7)], SUMS)
    rows = B.baseline_means(sums, special(spark, [("6", [2015, 2016, 2017])])).collect()
    got = {(r["month"], r["day_group"]): r["ridership"] for r in rows}
    assert got[(2, "weekday")] == 90.0
    assert got[(3, "weekday")] == 0.0
    assert not any(m == 1 for m, _ in got)
    assert len(got) == 22
    unused = B.baseline_means(sums, special(spark, [("6", [2014])])).collect()
    assert unused == []


def test_baseline_rounds_before_and_after_summing(spark):
    base = spark.createDataFrame([("1", 1, "total", 0.333), ("2", 1, "total", 0.333)], "complex_id string, month int, day_group string, ridership double")
    rounded = base.withColumn("ridership", F.round("ridership", 2))
    assert B.roll_up_baseline(rounded, None, None).first()["ridership"] == 0.66


def test_full_grid_of_the_station_baseline(spark):
    sums = spark.createDataFrame([("1", 2018, 5, "weekday", 100), ("1", 2018, 5, "weekend", 1), ("9", 2018, 5, "weekend", 1)], SUMS)
    ids = spark.createDataFrame([("1",), ("2",)], "complex_id string")
    rows = B.station_baseline(sums, special(spark, []), ids).collect()
    assert len(rows) == 2 * 12 * 3
    got = {(r["complex_id"], r["month"], r["day_group"]): r["ridership"] for r in rows}
    assert got[("1", 5, "total")] == 33.67 and got[("1", 5, "weekday")] == 33.33 and got[("1", 5, "weekend")] == 0.33
    assert got[("2", 5, "total")] == 0.0


PANEL = "complex_id string, year int, month int, period string, day_group string, ridership double, omny_pct double"


def test_roll_up_takes_parts_from_rounded_shares(spark):
    panel = spark.createDataFrame(
        [("1", 2024, 1, "2024-01-01", "total", 3.0, 33.33), ("2", 2024, 1, "2024-01-01", "total", 1.0, 0.0), ("3", 2024, 1, "2024-01-01", "total", 5.0, 100.0)], PANEL
    )
    mapping = spark.createDataFrame([("1", "a"), ("2", "a"), ("3", None)], "complex_id string, puma string")
    assert as_set(R.roll_up(panel, mapping, "puma")) == {("a", 2024, 1, "2024-01-01", "total", 4.0, 25.0)}
    assert R.roll_up(panel).first()["ridership"] == 9.0
    assert {r["complex_id"] for r in R.unmapped(panel, mapping).collect()} == {"3"}


def test_compare_leaves_blank_and_refuses_twice_occurring_keys(spark):
    panel = spark.createDataFrame([(2024, m, "p", "total", 10.0, 1.0) for m in (1, 2, 3)], PANEL.split(", ", 1)[1])
    base = spark.createDataFrame([(1, "total", 3.0), (2, "total", 0.0)], "month int, day_group string, ridership double")
    got = {r["month"]: r["baseline_comparison"] for r in C.compare(panel, base, CITY).collect()}
    assert got == {1: 3.3333, 2: None, 3: None}
    with pytest.raises(Exception, match="duplicate keys"):
        C.compare(panel, base.union(base), CITY).collect()


def test_totals_comparison_errors_without_total_rows(spark):
    panel = spark.createDataFrame([("1", 2024, 1, "p", "weekday", 10.0, 1.0)], PANEL)
    base = spark.createDataFrame([("1", 1, 5.0)], "complex_id string, month int, entries double")
    with pytest.raises(ValueError, match="total is not among them"):
        C.compare_totals(panel, base, STATION)
    with pytest.raises(ValueError, match="no known baseline measure"):
        P.with_baseline_name(base.withColumnRenamed("entries", "other"))


def test_missing_keys_never_join(spark):
    panel = spark.createDataFrame([(None, 2024, 1, "p", "total", 10.0, 1.0)], PANEL)
    base = spark.createDataFrame([(None, 1, "total", 5.0)], "complex_id string, month int, day_group string, ridership double")
    assert C.compare(panel, base, STATION).first()["baseline"] is None


def test_names_are_placed_after_the_key_and_enrichment_is_idempotent(spark):
    panel = spark.createDataFrame([("1", 2024, 5.0), ("x", 2024, 6.0)], "complex_id string, year int, ridership double")
    names = spark.createDataFrame([("1", "A St")], "complex_id string, station_name string")
    once = E.with_name(panel, names, "complex_id", "station_name")
    twice = E.with_name(once, names, "complex_id", "station_name")
    assert once.columns == ["complex_id", "station_name", "year", "ridership"] == twice.columns
    assert as_set(once) == as_set(twice) == {("1", "A St", 2024, 5.0), ("x", None, 2024, 6.0)}
    assert tuple(E.name_coverage(once, "station_name").first()) == (1, 1, 50.0)


def test_published_order_puts_missing_names_last(spark):
    df = spark.createDataFrame([(2024, 1, None, "9"), (2024, 1, "B", "2"), (2024, 1, "B", "1")], "year int, month int, station_name string, complex_id string")
    assert [r["complex_id"] for r in E.published_order(df, "station_name", ("complex_id",)).collect()] == ["1", "2", "9"]


def test_panel_order_is_numeric_with_other_ids_last(spark):
    df = spark.createDataFrame([(i, g) for i in ("10", "9", "TRAM1") for g in ("weekend", "total", "weekday")], "complex_id string, day_group string")
    got = [tuple(r) for r in G.panel_order(df, ["complex_id", "day_group"], ["complex_id"]).collect()]
    assert got[:3] == [("9", "total"), ("9", "weekday"), ("9", "weekend")] and got[-1][0] == "TRAM1"


# ---- months and refreshes ----


def sources(spark, *years):
    return spark.createDataFrame([(y, f"s{y}") for y in years], "year int, source string")


def test_candidate_months_stop_at_the_current_one(spark):
    got = I.candidate_months(sources(spark, 2023, 2024), date(2024, 2, 29))
    assert got.count() == 14
    assert I.future_months(sources(spark, 2024), date(2024, 2, 29)).count() == 10
    assert I.month_list(I.candidate_months(sources(spark, 2023, 2024), date(2024, 6, 1), 2024, 3)) == [(2024, 3)]
    assert I.month_list(I.candidate_months(sources(spark, 2023), date(2024, 6, 1), 2020)) == []
    with pytest.raises(ValueError):
        I.candidate_months(sources(spark, 2023), date(2024, 1, 1), None, 3)


def test_refresh_replaces_complete_months_only(spark):
    ids = spark.createDataFrame([("1",)], "complex_id string")
    old = spark.createDataFrame(
        [("1", 2024, m, f"2024-0{m}-01", g, 1.0, 0.0) for m in (1, 2, 3) for g in ("total", "weekday", "weekend")], PANEL
    )
    rows = month_rows(2024, 1, 31) + month_rows(2024, 2, 20) + month_rows(2024, 3, 31)
    new = U.refreshed_panel(fact(spark, rows), old, ids, [(2024, 1), (2024, 2)])
    totals = {r["month"]: r["ridership"] for r in new.filter("day_group = 'total'").collect()}
    assert totals == {1: 310.0, 2: 1.0, 3: 1.0}
    again = U.refreshed_panel(fact(spark, rows), new, ids, [(2024, 1), (2024, 2)])
    assert as_set(again) == as_set(new)


def test_single_entity_uses_everybody_for_completeness(spark):
    rows = month_rows(2024, 1, 31, "1") + month_rows(2024, 1, 3, "2")
    got = U.entity_panel(fact(spark, rows), "2", [(2024, 1)]).collect()
    assert {(r["complex_id"], r["day_group"], r["ridership"]) for r in got} == {("2", "total", 30.0), ("2", "weekday", 30.0), ("2", "weekend", 0.0)}


def test_entity_panel_has_its_own_place(spark, tmp_path):
    from panelspark.sources.sinks import entity_folder

    path = str(tmp_path / "station")
    U.store_entity_panel(fact(spark, month_rows(2024, 1, 31, "1")), path, "1", [(2024, 1)])
    assert spark.read.parquet(entity_folder(path, "1")).count() == 3
    assert entity_folder("p/x/", "4/5") == "p/x-by-entity/entity=4%2F5" != entity_folder("p/x", "45")


def test_local_panels_drop_missing_categories_and_leave_zero_districts_blank(spark):
    from panelspark.plans import local_panel as L

    rows = month_rows(2024, 2, 29, "1", "omny", 3) + month_rows(2024, 2, 29, "1", "MetroCard", 1)
    rows += month_rows(2024, 2, 29, "502", "omny", 50) + month_rows(2024, 2, 29, "1", None, 50)
    rows += month_rows(2024, 3, 30, "1", "omny", 3)
    ids = spark.createDataFrame([("1",), ("2",)], "complex_id string")
    mapping = spark.createDataFrame([("1", "a"), ("2", "b")], "station_complex_id string, puma string")
    out = L.local_panels(fact(spark, rows), ids, mapping, ("METROCARD", "OMNY"))
    station = {(r["complex_id"], r["day_group"]): (r["ridership"], r["omny_pct"]) for r in out["station"].collect()}
    assert station[("1", "total")] == (116, 75.0) and station[("2", "total")] == (0, 0.0) and len(station) == 6
    district = {(r["puma"], r["day_group"]): (r["ridership"], r["omny_pct"]) for r in out["puma"].collect()}
    assert district[("a", "total")] == (116, 75.0) and district[("b", "weekend")] == (0, None)
    assert out["nyc"].filter("day_group = 'weekday'").first()["ridership"] == 21 * 4
    base = spark.createDataFrame([("1", 2, "total", 50.0), ("1", 2, "total", 8.0), ("1", 2, "weekday", 9.0)], "complex_id string, month int, day_group string, ridership double")
    got = L.local_comparison({"station": out["station"]}, {"station": base})["station"]
    assert {(r["complex_id"], r["baseline_ridership"], r["baseline_comparison"]) for r in got.collect()} == {("1", 58.0, 2.0), ("2", None, None)}
    assert got.columns == ["complex_id", "year", "month", "period", "ridership", "baseline_ridership", "baseline_comparison", "omny_pct"]


def test_routing_takes_each_year_from_its_own_table(spark):
    early = fact(spark, month_rows(2023, 1, 2, n=1) + month_rows(2024, 1, 2, n=100))
    late = fact(spark, month_rows(2023, 1, 2, n=100) + month_rows(2024, 1, 2, n=2))
    route = spark.createDataFrame([(2023, "e"), (2024, "l")], "year int, source string")
    months = [(2023, 1), (2024, 1), (2025, 1)]
    got = U.routed_fact({"e": early, "l": late}, route, months)
    assert got.agg(F.sum("ridership")).first()[0] == 6
    assert U.routed_fact({"e": early}, route, [(2025, 1)]).count() == 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 28), st.sampled_from("123"), st.sampled_from(["omny", "cash", None]), st.integers(0, 99)), min_size=1, max_size=60))
def test_total_is_weekday_plus_weekend_and_city_is_sum_of_districts(spark, rows):
    df = fact(spark, [(f"2024-02-{d:02d} 05:00:00", "subway", s, p, n) for d, s, p, n in rows] + month_rows(2024, 2, 29))
    ids = spark.createDataFrame([("1",), ("2",), ("3",)], "complex_id string")
    panel = G.dense_panel(M.monthly_wide(df), ids)
    by = {(r["complex_id"], r["day_group"]): r["ridership"] for r in panel.collect()}
    assert len(by) == 9
    assert all(by[(s, "total")] == by[(s, "weekday")] + by[(s, "weekend")] for s in "123")
    mapping = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "b")], "complex_id string, puma string")
    district = R.roll_up(panel, mapping, "puma").filter("day_group = 'total'").agg(F.sum("ridership")).first()[0]
    city = R.roll_up(panel).filter("day_group = 'total'").first()["ridership"]
    assert district == city == sum(n for *_, n in rows) + 290


def test_stored_station_table_is_updated_in_place(spark, tmp_path):
    ids = spark.createDataFrame([("1",)], "complex_id string")
    path = str(tmp_path / "panel")
    jan = month_rows(2024, 1, 31)
    args = dict(sources=sources(spark, 2024), ids=ids, as_of=date(2024, 3, 10))
    U.update_station_table(fact(spark, jan), path, **args)
    feb = jan + month_rows(2024, 2, 29, n=7) + [("2024-01-05 09:00:00", "subway", "1", "cash", 5000)]
    looked_at = U.update_station_table(fact(spark, feb), path, **args)
    assert looked_at == [(2024, 2), (2024, 3)]

    def totals():
        rows = read_published(spark, path).filter("day_group = 'total'").collect()
        return {r["month"]: r["ridership"] for r in rows}

    assert totals() == {1: 310.0, 2: 203.0}
    U.update_station_table(fact(spark, feb), path, **args, year=2024, month=1)
    assert totals() == {1: 5310.0, 2: 203.0}
    U.update_station_table(fact(spark, jan), path, **args, full_refresh=True)
    assert totals() == {1: 310.0}


def test_whole_run_statuses_baselines_and_outputs(spark, tmp_path):
    """Created, then unchanged, then a targeted refresh; the baseline is built once and rebuilt on demand."""
    root = str(tmp_path)
    texts = "complex_id string, station_name string"
    dims = U.Dimensions(
        spark.createDataFrame([("1",), ("2",)], "complex_id string"),
        spark.createDataFrame([("1", "4108"), ("2", "4109")], "complex_id string, puma string"),
        spark.createDataFrame([("1", "A St")], texts),
        spark.createDataFrame([("4108", "North")], "puma string, puma_name string"),
        special(spark, [("2", [2019])]),
    )
    old = [r for y in (2017, 2018, 2019) for r in month_rows(y, 1, 31, "1", n=y - 2016) + month_rows(y, 1, 31, "2", n=5)]
    new = month_rows(2024, 1, 31, "1", n=7) + month_rows(2024, 1, 31, "2", "cash", n=10)
    args = dict(dims=dims, sources=sources(spark, 2024), root=root, as_of=date(2024, 2, 5), baseline_fact=fact(spark, old))
    assert set(U.run_monthly_update(fact(spark, new), **args).values()) == {"created"}

    def final(name):
        rows = read_published(spark, f"{root}/final_{name}").filter("day_group = 'total'").collect()
        return [r.asDict() for r in rows]

    one_, two = sorted(final("station"), key=lambda r: r["complex_id"])
    # Station 1: January 2017 does not count, so (2 + 3) * 31 / 2; station 2: 2019 only.
    assert (one_["baseline"], one_["baseline_comparison"], one_["omny_pct"], one_["station_name"]) == (77.5, 2.8, 100.0, "A St")
    assert (two["baseline"], two["baseline_comparison"], two["station_name"]) == (155.0, 2.0, None)
    (city,) = final("nyc")
    assert (city["ridership"], city["baseline"], city["omny_pct"]) == (527.0, 232.5, 41.18)
    assert {r["puma"]: r["puma_name"] for r in final("puma")} == {"4108": "North", "4109": None}

    assert set(U.run_monthly_update(fact(spark, new), **args).values()) == {"unchanged"}
    args["baseline_fact"] = fact(spark, [r for r in old if r[2] == "1"])
    more = new + [("2024-01-09 10:00:00", "subway", "1", "cash", 1000)]
    U.run_monthly_update(fact(spark, more), **args, year=2024)
    (city,) = final("nyc")
    assert (city["ridership"], city["baseline"]) == (1527.0, 232.5)
    U.run_monthly_update(fact(spark, more), **args, rebuild_baseline=True)
    (city,) = final("nyc")
    assert (city["ridership"], city["baseline"]) == (1527.0, 77.5)
