"""Readers, writers and what they refuse."""

import json

import pytest
from pyspark.sql import functions as F

from panelspark.schemas import STATION_PANEL
from panelspark.sources import readings as R
from panelspark.sources import records as J
from panelspark.sources import sinks as W
from panelspark.sources import tables as L
from panelspark.workspace import checkpoint_dir, new_path, stored

HEADER = "C/A,UNIT,SCP,STATION,LINENAME,DIVISION,DATE,TIME,DESC,ENTRIES,EXITS       "
LINE = "A002,R051,02-00-00,59 ST,NQR456W,BMT,01/02/2016,03:00:00,REGULAR,5477416,1857139    "


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_weekly_files_are_taken_or_left_whole(spark, tmp_path):
    short, long_ = LINE.rsplit(",", 1)[0], LINE.strip() + ",1"
    files = {
        "turnstile_160109.txt": [HEADER, LINE, LINE],
        "turnstile_141011.txt": [HEADER, LINE],  # before the first usable week
        "turnstile_160116.txt": [HEADER.rsplit(",", 1)[0], short],  # a column short
        "turnstile_160123.txt": [HEADER, LINE, long_],  # one row too wide
        "turnstile_16013.txt": [HEADER, LINE],  # not a date
        "notes.txt": ["hello"],
        "turnstile_160130.txt": ["x" + HEADER, LINE, short],  # other names, a short row
    }
    for name, lines in files.items():
        write(tmp_path / name, "\n".join(lines) + "\n")
    rows = R.read_weekly_readings(spark, str(tmp_path)).collect()
    assert len(rows) == 4
    assert sorted(r["EXITS"] is None for r in rows) == [False, False, False, True]
    assert {r["ENTRIES"] for r in rows} == {5477416}
    report = {r["file"].rsplit("/", 1)[1]: r["usable"] for r in R.weekly_file_report(spark, str(tmp_path)).collect()}
    assert sorted(n for n, ok in report.items() if ok) == ["turnstile_160109.txt", "turnstile_160130.txt"]


def test_hourly_files_by_name_with_thousands(spark, tmp_path):
    a = write(tmp_path / "a.csv", 'ridership,transit_mode,extra,station_complex_id,payment_method,transit_timestamp\n"1,234",subway,z,1,omny,2024-01-05T03:00:00.000\n')
    row = L.read_hourly(spark, a).first()
    assert (row["ridership"], row["station_complex_id"], str(row["transit_timestamp"])) == (1234, "1", "2024-01-05 03:00:00")
    b = write(tmp_path / "b.csv", "transit_timestamp,transit_mode,station_complex_id,payment_method,ridership\n2024-01-05,subway,1,omny,12x\n")
    with pytest.raises(Exception, match="Failed to parse"):
        L.read_hourly(spark, b).collect()
    c = write(tmp_path / "c.csv", "transit_timestamp,transit_mode\n2024-01-05,subway\n")
    with pytest.raises(ValueError, match="missing required columns.*ridership.*Found"):
        L.read_hourly(spark, c)
    with pytest.raises(FileNotFoundError, match="Missing hourly"):
        L.read_hourly(spark, str(tmp_path / "none.csv"))


def test_record_pages(spark, tmp_path):
    first = [{":id": "1", "zone": "z", "ridership": "5", "transit_timestamp": "2024-01-01", "georeference": {"type": "Point", "coordinates": [1, 2]}}]
    second = [{"transit_timestamp": "2024-01-02", "ridership": "6"}, {"ridership": "7"}]
    p1 = write(tmp_path / "pages" / "1.json", json.dumps(first, indent=1))
    write(tmp_path / "pages" / "2.json", json.dumps(second))
    header = J.page_header(spark, p1)
    assert header == ["transit_timestamp", "ridership", "georeference", "zone"]
    rows = {r["transit_timestamp"]: r for r in J.read_record_pages(spark, str(tmp_path / "pages"), header).collect()}
    assert set(rows) == {"2024-01-01", "2024-01-02"}
    assert json.loads(rows["2024-01-01"]["georeference"]) == first[0]["georeference"]
    assert " " not in rows["2024-01-01"]["georeference"]
    assert rows["2024-01-02"]["zone"] is None


def test_record_pages_are_read_once(spark, tmp_path):
    def bytes_read():
        stats = spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics()
        return sum(s.getBytesRead() for s in stats if s.getScheme() == "file")

    rows = [{"transit_timestamp": "2024-01-01", "ridership": i, "georeference": {"k": [i, 1.50], "t": "a \n\x85b"}} for i in range(3000)]
    pages = [json.dumps(rows, indent=1), json.dumps(rows[0]), "", "[{", "[null, {}]", json.dumps(rows[:2], ensure_ascii=False)]
    for i, page in enumerate(pages):
        write(tmp_path / "pages" / f"{i}.json", page)
    df = J.read_record_pages(spark, str(tmp_path / "pages"), ["transit_timestamp", "ridership", "georeference"])
    before = bytes_read()
    got = df.collect()
    assert bytes_read() - before < 4 * len("".join(pages))
    assert sorted(int(r["ridership"]) for r in got) == sorted([*range(3000), 0, 0, 1])
    assert all(json.loads(r["georeference"]) == rows[int(r["ridership"])]["georeference"] for r in got)


def test_special_cases_last_line_wins(spark, tmp_path):
    path = write(tmp_path / "s.csv", 'complex_id,baseline_years,station_name\n5,2019,"A (1,2)"\n6,"2017, 2018",B\n5,"2015,2016",A\n')
    config = L.read_special_cases(spark, path)
    assert [r["line"] for r in config.orderBy("line").collect()] == [2, 3, 4]
    assert {r["complex_id"]: r["years"] for r in L.special_years(config).collect()} == {"5": [2015, 2016], "6": [2017, 2018]}


def test_source_map_and_dimension(spark, tmp_path):
    path = write(tmp_path / "m.json", json.dumps({"2020": "a", "2025": "b"}, indent=4))
    assert {tuple(r) for r in L.read_source_map(spark, path).collect()} == {(2020, "a"), (2025, "b")}
    dim = write(tmp_path / "d.csv", "Complex ID,Stop Name\n1,B\n1,A\n2,C\n")
    got = L.read_dimension(spark, dim, {"Complex ID": "complex_id", "Stop Name": "station_name"}, "complex_id")
    assert {tuple(r) for r in got.collect()} == {("1", "A"), ("2", "C")}


def test_combined_files_know_their_number(spark, tmp_path):
    for n in (2, 10):
        write(tmp_path / f"{n}.csv", f"a\n{n}\n")
    got = L.combine_files(spark, str(tmp_path), r"(\d+)\.csv$").orderBy("file_number").collect()
    assert [(r["a"], r["file_number"]) for r in got] == [("2", 2), ("10", 10)]


def test_files_with_another_header_are_not_misread(spark, tmp_path):
    write(tmp_path / "f" / "1.csv", "a,b\n1,2\n")
    write(tmp_path / "f" / "2.csv", "b,a\n2,1\n")
    with pytest.raises(Exception, match="header"):
        L.combine_files(spark, str(tmp_path / "f")).collect()


def test_stored_panel_absent_broken_or_odd(spark, tmp_path):
    assert L.load_stored_panel(spark, str(tmp_path / "none")).count() == 0
    assert L.load_stored_panel(spark, write(tmp_path / "x.csv", "a,b\n1,2\n"), fmt="csv").schema == STATION_PANEL
    odd = write(tmp_path / "y.csv", "complex_id,year,month,period,day_group,ridership,omny_pct\n7,2024,1,2024-01-01,total,oops,\n")
    assert tuple(L.load_stored_panel(spark, odd, fmt="csv").first()) == ("7", 2024, 1, "2024-01-01", "total", 0.0, 0.0)


def test_panel_files_read_in_name_order_are_sorted(spark, tmp_path):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).cast("string").alias("complex_id"), (F.col("id") % 3).cast("int").alias("year"))
    path = tmp_path / "panel"
    W.write_panel(df, str(path), ["year", "complex_id"], ["year", "complex_id"], ["complex_id"])
    files = sorted(path.glob("part-*.csv"))
    lines = [ln for f in files for ln in f.read_text().splitlines() if ln != "year,complex_id"]
    rows = [tuple(map(int, ln.split(","))) for ln in lines]
    assert len(rows) == 5000 and rows == sorted(rows)
    assert all(f.read_text().startswith("year,complex_id\n") for f in files)


def test_landing_replaces_only_the_months_it_brings(spark, tmp_path):
    path = str(tmp_path / "land")
    day = F.to_timestamp_ntz(F.lit("2024-01-15"))
    a = spark.range(10).select("id", day.alias("t")).union(spark.range(4).select("id", F.to_timestamp_ntz(F.lit("2024-02-01")).alias("t")))
    W.land_months(a, path, "t")
    W.land_months(spark.range(3).select("id", day.alias("t")), path, "t")
    spark.catalog.refreshByPath(path)
    got = {(r["year"], r["month"]): r["count"] for r in spark.read.parquet(path).groupBy("year", "month").count().collect()}
    assert got == {(2024, 1): 3, (2024, 2): 4}
    assert W.stored_row_count(spark, path) == 7 and W.is_stored(spark, path)
    assert W.stored_row_count(spark, str(tmp_path / "none")) is None and not W.is_stored(spark, str(tmp_path / "none"))


def test_a_month_with_most_rows_is_written_by_many_tasks(spark, tmp_path):
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        day = F.when(F.col("id") % 20 > 0, F.lit("2024-01-15")).otherwise(F.lit("2024-02-15")).cast("timestamp_ntz")
        W.land_months(spark.range(0, 200000, 1, 8).select("id", day.alias("t")), str(tmp_path / "hot"), "t")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = {m: len(list((tmp_path / "hot" / "year=2024" / f"month={m}").glob("*.parquet"))) for m in (1, 2)}
    assert files[1] >= 4 > files[2]


def test_change_status(spark, tmp_path):
    got = [W.change_status(spark, a, b) for a, b in ((None, 5), (5, 5), (1000, 2500), (W.UNREADABLE, 3))]
    assert got == ["created", "unchanged", "1000 → 2500", "unreadable → 3"]
    (tmp_path / "old").mkdir()
    (tmp_path / "old" / "part-0.parquet").write_text("no table")
    assert W.stored_row_count(spark, str(tmp_path / "none")) is None
    assert W.stored_row_count(spark, str(tmp_path / "old")) == W.UNREADABLE


def test_change_report_as_a_table(spark):
    got = [W.change_report(a if a is None else spark.range(a), spark.range(b)).first() for a, b in ((None, 5), (5, 5), (5, 7))]
    assert [r["status"] for r in got] == ["created", "unchanged", "5 → 7"]


def test_intermediate_tables_live_in_the_named_folder(spark):
    kept = stored(spark.range(5), "five")
    assert kept.count() == 5
    assert kept.inputFiles()[0].split("five-")[0].endswith(checkpoint_dir(spark).rstrip("/").split(":")[-1] + "/")
    assert new_path(spark, "a") != new_path(spark, "a")


def test_month_filter_skips_folders(spark, tmp_path):
    from panelspark.operators.filters import in_month_list
    from panelspark.specs import FactSpec

    path = str(tmp_path / "fact")
    t = F.expr("timestamp_ntz'2023-11-01' + make_interval(0, CAST(id AS INT)) ").alias("t")
    W.land_months(spark.range(6).select("id", t), path, "t")
    spec = FactSpec(time="t", partitions=("year", "month"))
    df = in_month_list(spark.read.parquet(path), [(2023, 12), (2024, 1)], spec)
    assert df.count() == 2
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
