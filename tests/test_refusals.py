"""Nothing is left out, wiped or kept on one machine without a word."""

from datetime import date
from types import SimpleNamespace

import pytest

from panelspark.operators.monthly import pivot_categories
from panelspark.operators.quality import QualityError
from panelspark.plans import monthly_update as U
from panelspark.plans.local_panel import daily_table
from panelspark.sources.readings import read_weekly_readings
from panelspark.specs import FactSpec
from panelspark.workspace import checkpoint_dir, stored


def daily(spark):
    rows = [(1, date(2020, 1, 1), "A", 58), (1, date(2020, 1, 2), "B", 290)]
    return spark.createDataFrame(rows, "station_complex_id int, date date, payment_method string, ridership long")


def test_pivot_refuses_a_category_that_is_not_listed(spark):
    with pytest.raises(Exception, match="not listed: B"):
        pivot_categories(daily(spark), ["A"], "A").collect()
    whole = {r["ridership"] for r in pivot_categories(daily(spark), ["A", "B"], "A").filter("day_group = 'total'").collect()}
    assert whole == {348}


def test_negative_counts_are_refused(spark):
    spec = FactSpec(time="ts", entity="e", category="c", measure="n", mode="m")
    rows = spark.sql("select timestamp_ntz'2020-01-01 00:00:00' ts, 1 e, 'A' c, -5 n, 'x' m")
    with pytest.raises(QualityError, match="negative"):
        daily_table(rows, spec, ["x"], [])


def test_full_refresh_without_a_complete_month_keeps_the_stored_panel(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "panel")
    spark.sql("select 1 complex_id, 5 ridership, 2020 year, 1 month").write.partitionBy("year", "month").parquet(path)
    none = spark.sql("select 2020 year, 1 month").limit(0)
    monkeypatch.setattr(U, "load_stored_panel", lambda *a: None)
    monkeypatch.setattr(U, "months_to_compute", lambda *a: [(2020, 1)])
    monkeypatch.setattr(U, "fresh_wide", lambda *a: (none, none))
    U.update_station_table(spark.range(1), path, None, None, date(2020, 2, 1), full_refresh=True)
    assert spark.read.parquet(path).count() == 1


def test_a_cluster_without_a_shared_folder_is_an_error():
    class Session:
        conf = SimpleNamespace(get=lambda key, default: None)
        sparkContext = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_readings_are_ordered_by_file_and_line(spark, tmp_path):
    head = "C/A,UNIT,SCP,STATION,LINENAME,DIVISION,DATE,TIME,DESC,ENTRIES,EXITS"
    line = "A,R,00,S,1,D,10/18/2014,00:00:00,REGULAR,{},0"
    (tmp_path / "turnstile_141018.txt").write_text("\n".join([head, line.format(10)]))
    (tmp_path / "turnstile_141025.txt").write_text("\n".join([head, line.format(110), *[line.format(120 + i) for i in range(50)]]))
    rows = stored(read_weekly_readings(spark, str(tmp_path), ordered=True), "weekly").orderBy("seq").select("ENTRIES").collect()
    assert [int(r[0]) for r in rows] == [10, 110, *range(120, 170)]
