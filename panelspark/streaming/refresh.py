"""Refresh stored months as new fact files arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from panelspark.operators.monthly import year_month
from panelspark.operators.months import month_list
from panelspark.plans.monthly_update import fresh_wide
from panelspark.operators.grid import dense_panel
from panelspark.sources.publishing import MONTHS, month_parts, publish
from panelspark.specs import FactSpec


def refresh_touched_months(
    batch: DataFrame, fact: DataFrame, ids: DataFrame, panel_path: str, spec: FactSpec = FactSpec()
) -> list[tuple[int, int]]:
    """Recompute the months a batch has rows in, from the whole fact; incomplete ones are left alone."""
    months = month_list(batch.select(*year_month(spec.time)))
    if months:
        wide, complete = fresh_wide(fact, months, spec)
        if written := month_list(complete):
            publish(dense_panel(wide, ids, complete), panel_path, MONTHS, month_parts(written))
    return months


def start_refresh(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    load_fact: Callable[[], DataFrame],
    ids: DataFrame,
    panel_path: str,
    checkpoint: str,
    spec: FactSpec = FactSpec(),
    fmt: str = "parquet",
) -> StreamingQuery:
    """Work through the files that have landed, then stop.

    A batch only tells which months changed; sums come from the fact itself, so running a batch
    again gives the same panel.
    """
    arrivals = spark.readStream.schema(schema).format(fmt).load(landing)

    def handle(batch: DataFrame, _: int) -> None:
        refresh_touched_months(batch, load_fact(), ids, panel_path, spec)

    return (
        arrivals.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
