"""Versions of published tables: what a write touches, what readers see, and what is left after one that failed."""

import os
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from panelspark.levels import LEVELS
from panelspark.plans import monthly_update as U
from panelspark.sources import publishing as P
from tests.test_panel import fact, month_rows, sources, special

BY = ("year", "month")


def months(spark, *rows):
    return spark.createDataFrame(rows, "year int, month int, n int")


def seen(spark, path):
    return sorted(tuple(r) for r in P.read_published(spark, path).select("year", "month", "n").collect())


def test_parts_are_replaced_and_the_rest_stays(spark, tmp_path):
    path = str(tmp_path / "t")
    assert P.current(spark, path) is None
    P.publish(months(spark, (2024, 1, 1), (2024, 2, 2), (2024, 2, 3)), path, BY)
    P.publish(months(spark, (2024, 2, 9)), path, BY, P.month_parts([(2024, 2), (2024, 5)]))
    assert seen(spark, path) == [(2024, 1, 1), (2024, 2, 9)]
    version = P.current(spark, path)
    assert version.at == 2 and version.rows == 2 and P.months_of(version.parts) == [(2024, 1), (2024, 2)]
    assert seen(spark, path) == sorted(tuple(r) for r in P.read_version(spark, path, version).select("year", "month", "n").collect())
    assert P.read_version(spark, path, P.current(spark, path, 1)).count() == 3
    P.publish(months(spark).limit(0), path, BY, P.month_parts([(2024, 1)]))
    assert seen(spark, path) == [(2024, 2, 9)]
    P.publish(months(spark).limit(0), path, BY)
    assert seen(spark, path) == [] and P.read_published(spark, path).columns == ["n", "year", "month"]
    with pytest.raises(ValueError, match="outside"):
        P.publish(months(spark, (2024, 7, 1)), path, BY, P.month_parts([(2024, 8)]))


def test_only_the_parts_asked_for_are_scanned(spark, tmp_path):
    path = str(tmp_path / "t")
    version = P.publish(months(spark, *[(2024, m, m) for m in range(1, 13)]), path, BY)
    some = P.read_version(spark, path, version, P.month_parts([(2024, 3), (2025, 1)]))
    assert [r["n"] for r in some.collect()] == [3] and len(some.inputFiles()) == 1


@pytest.mark.parametrize("scope", [None, ["year=2024/month=1", "year=2024/month=2"]])
def test_a_write_that_fails_half_way_leaves_the_table(spark, tmp_path, scope):
    path = str(tmp_path / "t")
    P.publish(months(spark, (2024, 1, 1), (2024, 2, 2)), path, BY)
    new = spark.range(0, 1000, 1, 8).select(
        F.lit(2024).alias("year"), (F.col("id") % 2 + 1).cast("int").alias("month"),
        F.when(F.col("id") == 990, F.raise_error(F.lit("lost"))).otherwise(7).cast("int").alias("n"),
    )
    with pytest.raises(Exception, match="lost"):
        P.publish(new, path, BY, scope)
    assert seen(spark, path) == [(2024, 1, 1), (2024, 2, 2)]
    P.publish(new.filter("id < 900").select("year", "month", F.lit(7).alias("n")), path, BY, scope)
    assert len(seen(spark, path)) == 900


def test_old_versions_go_and_readers_of_kept_ones_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    P.publish(months(spark, *[(2024, m, 0) for m in (1, 2, 3)]), path, BY)
    for n in (1, 2, 3):
        P.publish(months(spark, (2024, 2, n)), path, BY, P.month_parts([(2024, 2)]))
    assert P.forget(spark, path, keep=2) > 0
    assert P.current(spark, path, 2) is None and P.read_version(spark, path, P.current(spark, path, 3)).count() == 3
    assert seen(spark, path) == [(2024, 1, 0), (2024, 2, 3), (2024, 3, 0)]
    assert len(list(Path(path).glob("data/*/*/month=2"))) == 2
    assert P.forget(spark, path, keep=2) == 0


def test_derived_parts_follow_their_source_and_settings(spark, tmp_path):
    up, down, built = str(tmp_path / "up"), str(tmp_path / "down"), []

    def follow(settings="s"):
        version = P.current(spark, up)

        def build(parts):
            built.append(P.months_of(parts))
            return P.read_version(spark, up, version, parts).withColumn("n", F.col("n") * 10)

        P.propagate(version, down, P.current(spark, down), settings, build)
        return seen(spark, down)

    P.publish(months(spark, (2024, 1, 1), (2024, 2, 2)), up, BY)
    assert follow() == follow() == [(2024, 1, 10), (2024, 2, 20)]
    P.publish(months(spark, (2024, 2, 5), (2024, 3, 6)), up, BY, P.month_parts([(2024, 2), (2024, 3)]))
    assert follow() == [(2024, 1, 10), (2024, 2, 50), (2024, 3, 60)]
    P.publish(months(spark).limit(0), up, BY, P.month_parts([(2024, 1)]))
    assert follow() == [(2024, 2, 50), (2024, 3, 60)]
    assert follow("other") == [(2024, 2, 50), (2024, 3, 60)]
    assert built == [[(2024, 1), (2024, 2)], [(2024, 2), (2024, 3)], [], [(2024, 2), (2024, 3)]]


def run_args(spark, root):
    texts = "complex_id string, station_name string"
    dims = U.Dimensions(
        spark.createDataFrame([("1",), ("2",)], "complex_id string"),
        spark.createDataFrame([("1", "4108"), ("2", "4109")], "complex_id string, puma string"),
        spark.createDataFrame([("1", "B St"), ("2", "A St")], texts),
        spark.createDataFrame([("4108", "North")], "puma string, puma_name string"),
        special(spark, []),
    )
    old = [r for y in (2017, 2018, 2019) for m in (1, 2, 3) for r in month_rows(y, m, 28, "1", n=3)]
    return dict(dims=dims, sources=sources(spark, 2024), root=root, as_of=date(2024, 3, 31), baseline_fact=fact(spark, old))


DAYS = {1: 31, 2: 29, 3: 31}


def files(root):
    """Data files of every level's tables with their time of writing."""
    return {p: os.stat(p).st_mtime_ns for kind in ("ridership", "final") for n in LEVELS for p in Path(f"{root}/{kind}_{n}/data").glob("**/*.parquet")}


def city(spark, root):
    rows = U.published(spark, root, LEVELS["nyc"]).filter("day_group = 'total'").collect()
    return {r["month"]: r["ridership"] for r in rows}


def test_a_targeted_month_writes_its_own_folders_at_every_level(spark, tmp_path):
    root = str(tmp_path)
    args = run_args(spark, root)
    rows = [r for m, n in DAYS.items() for r in month_rows(2024, m, n, "1", n=m)]
    U.run_monthly_update(fact(spark, rows), **args)
    before = files(root)
    more = rows + [("2024-02-09 10:00:00", "subway", "2", "cash", 100), ("2024-01-09 10:00:00", "subway", "2", "cash", 5000)]
    U.run_monthly_update(fact(spark, more), **args, year=2024, month=2)
    after = files(root)
    assert before.items() <= after.items()
    new = [p for p in after if p not in before]
    assert {p.parent.name for p in new} == {"month=2"} and {p.parts[-6] for p in new} == {f"{k}_{n}" for k in ("ridership", "final") for n in LEVELS}
    assert city(spark, root) == {1: 31.0, 2: 158.0, 3: 93.0}
    names = [r["station_name"] for r in spark.read.parquet(*[str(p) for p in new if "final_station" in str(p)]).collect()]
    assert names == ["A St"] * 3 + ["B St"] * 3
    assert set(U.run_monthly_update(fact(spark, more), **args).values()) == {"unchanged"} and files(root) == after


def test_a_run_that_dies_before_the_finals_is_made_good(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    args = run_args(spark, root)
    rows = [r for m, n in DAYS.items() for r in month_rows(2024, m, n, "1", n=m)]
    U.run_monthly_update(fact(spark, rows[:60]), **args)
    assert city(spark, root) == {1: 31.0, 2: 58.0}

    def lost(*_):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as m, pytest.raises(RuntimeError, match="lost"):
        m.setattr(U, "require_day_group_keys", lost)
        U.run_monthly_update(fact(spark, rows), **args)
    assert city(spark, root) == {1: 31.0, 2: 58.0}
    U.run_monthly_update(fact(spark, rows), **args)
    assert city(spark, root) == {1: 31.0, 2: 58.0, 3: 93.0}


def test_a_panel_without_versions_is_taken_over(spark, tmp_path):
    path = str(tmp_path / "panel")
    args = dict(sources=sources(spark, 2024), ids=spark.createDataFrame([("1",)], "complex_id string"), as_of=date(2024, 3, 31))
    U.update_station_table(fact(spark, month_rows(2024, 1, 31)), str(tmp_path / "first"), **args)
    P.read_published(spark, str(tmp_path / "first")).write.partitionBy("year", "month").parquet(path)
    assert U.update_station_table(fact(spark, month_rows(2024, 2, 29)), path, **args) == [(2024, 2), (2024, 3)]
    rows = P.read_published(spark, path).filter("day_group = 'total'").collect()
    assert {r["month"]: r["ridership"] for r in rows} == {1: 310.0, 2: 290.0}
