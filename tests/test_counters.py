"""Counter differences against brute force, whatever the chunks and however skewed the devices."""

from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelspark.operators import counters as K
from panelspark.operators import filters as P
from panelspark.plans import counter_baseline as U
from panelspark.plans import counter_staging as G
from panelspark.schemas import READINGS
from panelspark.sources import readings as R
from panelspark.specs import CounterSpec

SPEC = CounterSpec(device="dev", time="t", counters=("ENTRIES", "EXITS"), tie=("id",))
SCHEMA = "id bigint, dev string, t timestamp_ntz, ENTRIES bigint, EXITS bigint, chunk int"
START = datetime(2024, 1, 1)


def brute_force(rows):
    """(id, previous time, entries and exits difference) by walking each device in order."""
    out, last = {}, {}
    for r in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        p = last.get(r[1])
        out[r[0]] = (p[2], r[3] - p[3], r[4] - p[4]) if p else (None, None, None)
        last[r[1]] = r
    return out


def spark_result(df):
    rows = K.raw_deltas(df, SPEC).select("id", "prev_time", "ENTRIES_DIFF", "EXITS_DIFF").collect()
    assert len({r["id"] for r in rows}) == len(rows)
    return {r["id"]: tuple(r)[1:] for r in rows}


@settings(max_examples=12, deadline=None)
@given(
    st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 50), st.integers(0, 99999), st.integers(0, 99999)), min_size=1, max_size=80),
    st.sampled_from([1, 3, 10, 1000]),
)
def test_differences_equal_brute_force_for_any_chunk_width(spark, raw, width):
    rows = [(i, d, START + timedelta(hours=h), e, x, h // width) for i, (d, h, e, x) in enumerate(raw)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert spark_result(df) == brute_force(rows)
    clean = K.counter_deltas(df, SPEC).collect()
    assert all(0 <= r["ENTRIES_DIFF"] <= 7200 and 0 <= r["EXITS_DIFF"] <= 7200 for r in clean)
    assert len(clean) == sum(1 for v in brute_force(rows).values() if v[0] is not None)


def test_a_hot_device_is_spread_and_still_right(spark):
    """Half of all readings are one device, and a third are readings of one moment."""
    rows = [(i, "hot" if i % 2 else f"d{i % 40}", START + timedelta(minutes=0 if i % 3 == 0 else i), i * 7 % 9001, i * 3 % 8009) for i in range(6000)]
    df = spark.createDataFrame(rows, SCHEMA.rsplit(",", 1)[0])
    chunked = U.in_chunks(df, SPEC, chunks=12)
    sizes = [r["count"] for r in chunked.groupBy("chunk").count().collect()]
    assert len(sizes) == 12 and max(sizes) < 3 * 6000 / 12
    assert chunked.filter("dev = 'hot'").select("chunk").distinct().count() >= 4
    assert spark_result(chunked) == brute_force(rows)


def test_copies_without_a_tie_are_ordered_by_input(spark):
    spec = CounterSpec(device="dev", time="t")
    rows = [("a", START, 5, 5)] * 300 + [("a", START + timedelta(hours=4), 9, 6)]
    df = spark.createDataFrame(rows, "dev string, t timestamp_ntz, ENTRIES bigint, EXITS bigint").coalesce(1)
    chunked = U.in_chunks(df, spec, chunks=5)
    assert max(r["count"] for r in chunked.groupBy("chunk").count().collect()) < 200
    got = K.counter_deltas(chunked, spec).agg(F.count("*"), F.sum("ENTRIES_DIFF"), F.sum("EXITS_DIFF")).first()
    assert tuple(got) == (300, 4, 1)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_full_rows_are_shuffled_once_and_sorted_once_from_raw_files_to_differences(spark, tmp_path, monkeypatch):
    head = ",".join(READINGS.names)
    for week in ("141018", "141025", "141101"):
        lines = [f"A,R{k % 5},00,S,1,BMT,{week[2:4]}/{week[4:]}/2014,{h:02d}:00:00,REGULAR,{h * 9 + k},{h}" for k in range(5) for h in range(24)]
        (tmp_path / f"turnstile_{week}.txt").write_text("\n".join([head, *lines]))
    scans, written = [], []
    keep_lines, keep_buckets = R.weekly_lines, U.stored_in_buckets
    monkeypatch.setattr(R, "weekly_lines", lambda *a: scans.append(1) or keep_lines(*a))
    monkeypatch.setattr(U, "stored_in_buckets", lambda df, *a: written.append(plan_of(df)) or keep_buckets(df, *a))
    readings, _ = R.scan_weekly(spark, str(tmp_path))
    raw = plan_of(readings)
    assert scans == [1] and "FileScan text" not in raw and "FileScan csv" not in raw
    mapping = spark.createDataFrame([("S_1", "7")], "station_id string, `Complex ID` string")
    chunked = U.in_chunks(U.staged_readings(readings, mapping), chunks=4)
    (write,) = written
    assert write.count("Exchange rangepartitioning") == write.count("Exchange") == 1 and "Sort [" not in write
    plan = plan_of(K.counter_deltas(chunked))
    assert plan.count("Exchange") == plan.count("BroadcastExchange") == 1 and plan.count("Sort [") == 1 and "Bucketed: true" in plan
    assert K.counter_deltas(chunked).count() == 3 * 5 * 24 - 5


def test_every_chunk_is_a_bucket_of_its_own(spark):
    for n in (1, 2, 7, 64):
        labels = U.chunk_labels(spark, n)
        df = spark.createDataFrame([(x,) for x in labels], "x int")
        assert labels == sorted(labels) and df.select(F.pmod(F.hash("x"), F.lit(n))).distinct().count() == len(labels) == n


def test_readings_after_earlier_ones(spark):
    """Differences in two halves, the second with the last readings of the first, equal those at once."""
    rows = [(i, f"d{i % 7}", START + timedelta(hours=i // 2), i * 37 % 9001, i * 11 % 8009) for i in range(400)]
    schema = SCHEMA.rsplit(",", 1)[0]
    first, second = (U.in_chunks(spark.createDataFrame(part, schema), SPEC, chunks=3) for part in (rows[:220], rows[220:]))
    earlier = K.last_readings(first, [SPEC.device], SPEC)
    both = [K.raw_deltas(first, SPEC), K.raw_deltas(second, SPEC, earlier)]
    got = [r for df in both for r in df.select("id", "prev_time", "ENTRIES_DIFF", "EXITS_DIFF").collect()]
    assert {r["id"]: tuple(r)[1:] for r in got} == brute_force(rows)


def weekly(path, week, days, devices=("R1", "R2"), step=10):
    head = ",".join(READINGS.names)
    lines = [
        f"A,{r},00,S,1,BMT,10/{d:02d}/2014,{h:02d}:00:00,REGULAR,{(d * 24 + h) * step},{d * 24 + h}"
        for r in devices for d in days for h in (0, 4, 8, 12, 16, 20)
    ]
    (path / f"turnstile_{week}.txt").write_text("\n".join([head, *lines, ""]))


def test_staging_grows_and_starts_anew_only_where_it_must(spark, tmp_path):
    files, mapping = tmp_path / "files", spark.createDataFrame([("S_1", "7")], "station_id string, `Complex ID` string")
    files.mkdir()
    weekly(files, "141018", range(12, 19))

    def stage(root="grown", path=files):
        return G.stage_weekly(spark, str(path), str(tmp_path / root), mapping)

    def daily(root="grown"):
        return sorted(map(tuple, G.staged_daily(spark, str(tmp_path / root)).collect()))

    def at_once(n):
        assert stage(f"once{n}") == G.ANEW
        return daily(f"once{n}")

    assert [stage(), stage()] == [G.ANEW, G.NOTHING_NEW]
    weekly(files, "141025", range(19, 26), ("R1", "R2", "R3"))
    (files / "turnstile_141101.txt").write_text("C/A,UNIT\nA,R1")
    assert [stage(), stage()] == [G.ADDED, G.NOTHING_NEW]
    assert daily() == at_once(1) and sum(r[2] for r in daily()) == (2 * 83 + 41) * 40
    assert len(list((tmp_path / "grown" / "deltas" / "data").glob("*/batch=0"))) == 1
    weekly(files, "141108", range(5, 8))  # a late week: readings before those staged
    assert stage() == G.ANEW and daily() == at_once(2)
    weekly(files, "141025", range(19, 27), ("R1", "R2", "R3"))  # a file that changed
    assert stage() == G.ANEW and daily() == at_once(3)


def test_a_batch_that_was_cut_off_is_staged_again(spark, tmp_path, monkeypatch):
    files, mapping = tmp_path / "files", spark.createDataFrame([("S_1", "7")], "station_id string, `Complex ID` string")
    files.mkdir()
    weekly(files, "141018", range(12, 19))
    root = str(tmp_path / "grown")
    G.stage_weekly(spark, str(files), root, mapping)
    weekly(files, "141025", range(19, 26))
    publish = G.publish

    def dies(df, path, *a):
        if path.endswith("files"):
            raise RuntimeError("lost")
        return publish(df, path, *a)

    with monkeypatch.context() as m, pytest.raises(RuntimeError, match="lost"):
        m.setattr(G, "publish", dies)
        G.stage_weekly(spark, str(files), root, mapping)
    assert G.stage_weekly(spark, str(files), root, mapping) == G.ADDED
    assert sum(r["ENTRIES"] for r in G.staged_daily(spark, root).collect()) == 2 * 83 * 40


def test_readings_without_a_device_give_nothing(spark):
    rows = [(i, None if i % 2 else "a", START + timedelta(hours=i), i, i, i // 4) for i in range(12)]
    got = K.counter_deltas(spark.createDataFrame(rows, SCHEMA), SPEC).collect()
    assert len(got) == 5 and {r["dev"] for r in got} == {"a"}


def test_resets_spikes_and_missing_counters(spark):
    values = [(100, 1), (90, 2), (20000, 3), (None, 4), (20010, 5)]
    rows = [(i, "a", START + timedelta(hours=4 * i), e, x, 0) for i, (e, x) in enumerate(values)]
    got = [(r["id"], r["ENTRIES_DIFF"], r["EXITS_DIFF"]) for r in K.counter_deltas(spark.createDataFrame(rows, SCHEMA), SPEC).orderBy("id").collect()]
    assert got == [(1, 0, 1), (2, 7200, 1)]


def test_difference_belongs_to_the_earlier_reading_and_may_span_dropped_ones(spark):
    clocks = ["20:00:00", "21:17:05", "00:00:00", "04:22:00"]
    days = ["01/01/2024", "01/01/2024", "01/02/2024", "01/02/2024"]
    rows = [("a", d, c, 10 * i, i, i) for i, (d, c) in enumerate(zip(days, clocks))]
    df = spark.createDataFrame(rows, "turnstile_id string, DATE string, TIME string, ENTRIES bigint, EXITS bigint, seq bigint")
    df = P.at_reporting_marks(K.with_reading_time(df)).withColumn("chunk", F.lit(0))
    deltas = K.counter_deltas(df)
    got = [(str(r["service_date"]), r["ENTRIES_DIFF"]) for r in deltas.orderBy("DATETIME").collect()]
    assert got == [("2024-01-01", 20), ("2024-01-02", 10)]
    assert K.midnight_spans(deltas).first()["midnight_spans"] == 1


def test_modal_count_ties_go_to_the_smallest(spark):
    counts = spark.createDataFrame([("a", 10), ("b", 10), ("c", 40), ("d", 40), ("e", 3)], "turnstile_id string, readings bigint")
    assert K.modal_count(counts).first()["mode"] == 10
    low = K.low_count_devices(counts, 0.5).collect()
    assert [r["turnstile_id"] for r in low] == ["e"]


def test_daily_sums_pick_the_smallest_of_equally_common_names(spark):
    rows = [("1", datetime(2024, 1, 1), "d1", n, ln, 1, 1) for n, ln in (("B ST", "Q"), ("A ST", "N"), ("B ST", "N"), ("A ST", "N"))]
    rows.append((None, datetime(2024, 1, 1), "d2", "X", "X", 5, 5))
    df = spark.createDataFrame(rows, "`Complex ID` string, d timestamp_ntz, turnstile_id string, STATION string, LINENAME string, ENTRIES_DIFF bigint, EXITS_DIFF bigint")
    got = K.daily_entity_sums(df.withColumn("service_date", F.to_date("d"))).collect()
    assert [(r["ENTRIES"], r["TURNSTILE_COUNT"], r["PRIMARY_STATION_NAME"], r["LINES"]) for r in got] == [(4, 1, "A ST", "N, Q")]


def test_whole_counter_run_and_reuse_of_staging(spark, tmp_path):
    rows = []
    for day in range(1, 32):
        for hour in (0, 4, 8, 12, 16, 20):
            n = (day * 6 + hour // 4) * 10
            rows.append(("A1", "R1", "00", "A ST", "N", "BMT", f"01/{day:02d}/2019", f"{hour:02d}:00:00", "REGULAR", n, n // 2))
            rows.append(("A1", "R2", "00", "ORCHARD BEACH", "6", "IRT", f"01/{day:02d}/2019", f"{hour:02d}:00:00", "REGULAR", n, n))
            rows.append(("A1", "R3", "00", "PATH", "1", "PTH", f"01/{day:02d}/2019", f"{hour:02d}:00:00", "REGULAR", n, n))
    from panelspark.schemas import READINGS

    readings = spark.createDataFrame(rows, READINGS)
    mapping = spark.createDataFrame([("A ST_N", "7")], "station_id string, `Complex ID` string")
    ids = spark.createDataFrame([("7",), ("8",)], "complex_id string")
    districts = spark.createDataFrame([("7", "4108")], "complex_id string, puma string")
    none = spark.createDataFrame([], "complex_id string, years array<int>")
    root = str(tmp_path)
    out = U.run_counter_baseline(readings, mapping, none, ids, districts, root, (2018, 2019))
    got = {(r["complex_id"], r["month"]): (r["entries"], r["exits"]) for r in out["station"].collect()}
    assert len(got) == 24
    assert got[("7", 1)] == (185 * 10 / 2, 185 * 5 / 2)
    assert got[("8", 1)] == (0.0, 0.0)
    assert out["puma"].filter("month = 1").first()["entries"] == 925.0
    assert out["nyc"].filter("month = 1").first()["exits"] == 462.5
    again = U.run_counter_baseline(readings.limit(0), mapping, none, ids, districts, root, (2018, 2019))
    assert again["nyc"].filter("month = 1").first()["entries"] == 925.0
