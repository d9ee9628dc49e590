"""The calendar beside a landed fact, and daily sums by value counts."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from panelspark.operators import counters as K
from panelspark.sources import landing as L
from panelspark.sources import publishing as P
from panelspark.specs import CounterSpec


def days(spark, year, month, which):
    rows = [(datetime(year, month, d, 8), d) for d in which] + [(None, 0)]
    return spark.createDataFrame(rows, "t timestamp_ntz, n int").filter("t IS NOT NULL")


def test_only_landed_months_are_looked_at_and_only_complete_ones_are_read(spark, tmp_path, monkeypatch):
    path, looked = str(tmp_path / "fact"), []
    keep = L.read_version
    monkeypatch.setattr(L, "read_version", lambda s, p, v, parts=None: looked.append((p, parts)) or keep(s, p, v, parts))
    L.land_fact(days(spark, 2024, 1, range(1, 32)).unionByName(days(spark, 2024, 2, range(1, 29))), path, "t")
    assert L.complete_landed_months(spark, path, "t") == [(2024, 1)]
    L.land_fact(days(spark, 2024, 2, range(1, 30)).unionByName(days(spark, 2024, 3, range(2, 32))), path, "t")
    looked.clear()
    assert L.complete_landed_months(spark, path, "t") == [(2024, 1), (2024, 2)]
    assert sorted(looked[0][1]) == P.month_parts([(2024, 2), (2024, 3)])
    looked.clear()
    df = L.complete_rows(spark, path, "t")
    assert [p for p, parts in looked if parts and p == path] == [path]
    assert df.count() == 60 and all("month=3" not in f for f in df.inputFiles())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_daily_sums_meet_by_value_and_equal_a_plain_count(spark):
    spec = CounterSpec()
    start = datetime(2024, 1, 1)
    rows = [
        (None if i % 11 == 0 else str(i % 3), start + timedelta(days=i % 2), None if i % 13 == 0 else f"d{i % 5}",
         None if i % 17 == 0 else f"S{i * i % 4}", None if i % 19 == 0 else f"L{i % 6}", i if i % 7 else None, 2 * i)
        for i in range(600)
    ]
    names = "`Complex ID` string, d timestamp_ntz, turnstile_id string, STATION string, LINENAME string, ENTRIES_DIFF bigint, EXITS_DIFF bigint"
    df = spark.createDataFrame(rows, names).withColumn("service_date", F.to_date("d")).repartition(4)
    found = K.daily_entity_sums(df, spec)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "mode(" not in plan and "collect_set" not in plan and plan.count("Exchange hashpartitioning") == 2
    groups = {}
    for r in rows:
        if r[0] is not None:
            groups.setdefault((r[0], r[1].date()), []).append(r)

    def top(values):
        known = [v for v in values if v is not None]
        return min(known, key=lambda v: (-known.count(v), v)) if known else None

    want = {
        k: (
            sum(r[5] or 0 for r in g), sum(r[6] for r in g), len({r[2] for r in g} - {None}), top([r[3] for r in g]),
            ", ".join(sorted({r[4] for r in g} - {None})),
        )
        for k, g in groups.items()
    }
    assert {(r[0], r[1]): tuple(r)[2:] for r in found.collect()} == want
    none = K.daily_entity_sums(df.withColumns({c: F.lit(None).cast("string") for c in ("turnstile_id", "STATION", "LINENAME")}), spec)
    assert {tuple(r)[4:] for r in none.collect()} == {(0, None, "")}
