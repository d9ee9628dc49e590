"""The stored panel follows files as they land."""

from pyspark.sql import functions as F

from panelspark.specs import FactSpec
from panelspark.sources.publishing import read_published
from panelspark.streaming.refresh import start_refresh


def test_only_touched_complete_months_are_refreshed(spark, tmp_path):
    ids = spark.createDataFrame([("1",)], "complex_id string")
    landing, panel, marks = (str(tmp_path / n) for n in ("landing", "panel", "marks"))

    def land(year, month, days, n):
        day = F.expr(f"CAST(make_date({year}, {month}, CAST(id AS INT) + 1) AS TIMESTAMP_NTZ)")
        df = spark.range(days).select(
            day.alias("transit_timestamp"), F.lit("subway").alias("transit_mode"), F.lit("1").alias("station_complex_id"),
            F.lit("omny").alias("payment_method"), F.lit(n).cast("bigint").alias("ridership"),
        )
        df.coalesce(2).write.mode("append").parquet(landing)
        return df.schema

    def run(schema):
        query = start_refresh(
            spark, landing, schema, lambda: spark.read.parquet(landing), ids, panel, marks, FactSpec()
        )
        query.awaitTermination(120)
        assert query.exception() is None
        rows = read_published(spark, panel).filter("day_group = 'total'").collect()
        return {r["month"]: r["ridership"] for r in rows}

    schema = land(2024, 1, 31, 10)
    land(2024, 2, 5, 10)
    assert run(schema) == {1: 310.0}
    assert run(schema) == {1: 310.0}
    land(2024, 2, 29, 1)
    assert run(schema) == {1: 310.0, 2: 79.0}
