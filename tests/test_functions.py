"""Scalar rules on hand-made rows."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelspark.functions import calendar as D
from panelspark.functions import numbers as N
from panelspark.functions import text as T


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_rounding_goes_half_to_even(spark):
    x = [3.125, 3.375, -3.125, 2.675, 0.125]
    got = one(spark, *[N.round_even(F.lit(v), 2).alias(f"c{i}") for i, v in enumerate(x)])
    assert got == (3.12, 3.38, -3.12, 2.68, 0.12)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(-1e9, 1e9), min_size=1, max_size=200))
def test_rounding_equals_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = [r[0] for r in df.select(N.round_even(F.col("v"), 2)).collect()]
    assert got == np.round(np.array(values), 2).tolist()


def test_shares_and_ratios_survive_zero_and_missing(spark):
    zero, none, two = F.lit(0.0), F.lit(None).cast("double"), F.lit(2.0)
    got = one(
        spark,
        N.share(two, zero).alias("a"),
        N.share(two, none).alias("b"),
        N.share(F.lit(1.0), F.lit(3.0)).alias("c"),
        N.share_or_null(zero, zero).alias("d"),
        N.ratio(two, zero).alias("e"),
        N.ratio(two, none).alias("f"),
        N.ratio(two, F.lit(-1.0)).alias("g"),
        N.ratio(F.lit(1.0), F.lit(3.0)).alias("h"),
    )
    assert got == (0.0, 0.0, 33.33, None, None, None, None, 0.3333)


def test_lenient_and_strict_numbers(spark):
    assert one(spark, *[N.lenient_double(F.lit(v)).alias(f"c{i}") for i, v in enumerate(["1.5", "x", "", "NaN", "1.5d", " -2e3 "])]) == (1.5, 0.0, 0.0, 0.0, 0.0, -2000.0)
    assert one(spark, N.strict_bigint(F.lit("1,234,567")), N.strict_bigint(F.lit(None).cast("string")), N.strict_bigint(F.lit("5.0"))) == (1234567, None, 5)
    for bad in ("12.5", "abc", "1 2", "1.0000001", "1.5", "1d"):
        with pytest.raises(Exception, match="Failed to parse"):
            one(spark, N.strict_bigint(F.lit(bad)))


def test_clip_keeps_missing(spark):
    vals = [None, -5, 3, 9000]
    got = one(spark, *[N.clip(F.lit(v).cast("bigint"), 0, 7200).cast("bigint").alias(f"c{i}") for i, v in enumerate(vals)])
    assert got == (None, 0, 3, 7200)


def test_exact_sum_ignores_order_and_gives_zero_for_nothing(spark):
    vals = [0.1] * 10 + [1e9, -1e9, 0.2]
    a = spark.createDataFrame([(v,) for v in vals], "v double").repartition(5)
    b = spark.createDataFrame([(v,) for v in reversed(vals)], "v double").repartition(3)
    assert a.agg(N.exact_sum(F.col("v"))).first()[0] == b.agg(N.exact_sum(F.col("v"))).first()[0] == 1.2
    empty = spark.createDataFrame([(None,)], "v double")
    assert empty.agg(N.exact_sum(F.col("v")), N.whole_sum(F.col("v").cast("bigint"))).first() == (0.0, 0)


def test_day_groups_and_calendar(spark):
    week = [f"2024-01-0{d} 23:59:59" for d in range(1, 8)]  # Monday to Sunday
    df = spark.createDataFrame([(w,) for w in week], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    rows = df.select(D.day_group("t"), D.is_weekday("t"), D.day_name("t")).collect()
    assert [r[0] for r in rows] == ["weekday"] * 5 + ["weekend"] * 2
    assert [r[1] for r in rows] == [True] * 5 + [False] * 2
    assert rows[0][2] == "Monday"
    got = one(
        spark, D.days_in_month(F.lit(2024), F.lit(2)), D.days_in_month(F.lit(1900), F.lit(2)), D.period_label(F.lit(2020), F.lit(3)), D.month_label(F.lit(2026), F.lit(2))
    )
    assert got == (29, 28, "2020-03-01", "Feb 2026")


def test_day_group_does_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    df = spark.sql("SELECT timestamp_ntz'2024-01-05 23:30:00' AS t")
    try:
        for z in ("America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", z)
            assert df.select(D.day_group("t"), D.service_day("t").cast("string")).first() == ("weekday", "2024-01-05")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_month_ranges_merge_runs(spark):
    df = spark.sql("SELECT explode(sequence(timestamp_ntz'2019-11-15', timestamp_ntz'2020-04-15', interval 1 month)) AS t")
    kept = [str(r[0])[:7] for r in df.filter(D.in_months("t", [(2020, 1), (2019, 12), (2020, 4)])).collect()]
    assert kept == ["2019-12", "2020-01", "2020-04"]
    assert df.filter(D.in_months("t", [])).count() == 0


def test_keys_and_year_lists(spark):
    none = F.lit(None).cast("string")
    assert one(spark, T.joined_key(F.lit("a"), none), T.joined_key(F.lit("a"), F.lit("b"))) == (None, "a_b")
    assert one(spark, T.category(none), T.category(F.lit("omny"))) == ("", "OMNY")
    assert one(spark, T.year_list(F.lit("2015, 2016,2019"))) == ([2015, 2016, 2019],)
    years = T.int_array([2017, 2018])
    assert one(spark, T.valid_years(years, F.lit(1), [(2017, 1)]), T.valid_years(years, F.lit(2), [(2017, 1)])) == ([2018], [2017, 2018])
    assert one(spark, T.id_order(F.lit("TRAM1")), T.id_order(F.lit("12"))) == (None, 12)


def test_distinct_days_are_counted_by_bits(spark):
    df = spark.sql("SELECT explode(sequence(timestamp_ntz'2024-01-01', timestamp_ntz'2024-01-31 23:00:00', interval 5 hours)) AS t")
    assert df.agg(F.bit_count(F.bit_or(D.day_bit("t")))).first()[0] == 31
    assert math.log2(one(spark, D.day_bit(F.lit("2024-01-31").cast("date")))[0]) == 30


def test_json_spaces_go_but_not_within_strings(spark):
    text = '{ "a b" : [1,\n 2],  "c": "x \\" y" }'
    assert one(spark, T.without_json_spaces(F.lit(text))) == ('{"a b":[1,2],"c":"x \\" y"}',)
