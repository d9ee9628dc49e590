"""Panel outputs, month-partitioned landing, and what a write changed."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.functions.calendar import col
from panelspark.operators.grid import panel_order
from panelspark.operators.monthly import year_month
from panelspark.sources.tables import read_text_columns


def write_panel(
    df: DataFrame, path: str, columns: Sequence[str], keys: Sequence[str], numeric: Sequence[str] = (), fmt: str = "csv"
) -> None:
    """Write in fixed column order and total order.

    The sort is by ranges, so the numbered part files, read in order, are the sorted panel; no
    single task has to hold it.
    """
    ordered = panel_order(df.select(*[col(c) for c in columns]), keys, numeric)
    writer = ordered.write.mode("overwrite")
    writer.option("header", True).csv(path) if fmt == "csv" else writer.format(fmt).save(path)


def entity_folder(path: str, entity: object) -> str:
    """Where the panel of one entity is kept: a partition folder beside the full panel, one for each id."""
    return f"{path.rstrip('/')}-by-entity/entity={quote(str(entity), safe='')}"


def land_months(df: DataFrame, path: str, time: str | None = None) -> None:
    """Write rows into year/month folders; only months present in ``df`` are replaced.

    Rows are rebalanced by month first: adaptive execution gives a month that holds most rows to
    many writers and packs small months together, so files come out of about equal size.
    """
    dated = df if time is None else df.select("*", *year_month(time))
    (
        dated.hint("rebalance", F.col("year"), F.col("month"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month")
        .parquet(path)
    )


def is_stored(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """Whether there is a table at the path; no row is read."""
    try:
        return bool(spark.read.format(fmt).load(path).columns)
    except AnalysisException:
        return False


#: Row count of an output that is there and can't be read.
UNREADABLE = -1


def stored_row_count(spark: SparkSession, path: str, fmt: str = "parquet") -> int | None:
    """Rows now stored at the path; None where there is nothing, ``UNREADABLE`` where what is there is no table."""
    try:
        df = read_text_columns(spark, path) if fmt == "csv" else spark.read.format(fmt).load(path)
        return df.count()
    except AnalysisException as e:
        return None if e.getCondition() == "PATH_NOT_FOUND" else UNREADABLE
    except Py4JJavaError:  # files that are there and damaged
        return UNREADABLE


def _status(previous: Column, current: Column) -> Column:
    """``created`` where nothing was there, ``unchanged`` for as many rows as before, else the two counts."""
    before = F.when(previous == UNREADABLE, "unreadable").otherwise(previous.cast("string"))
    both = F.concat_ws(" → ", before, current.cast("string"))
    return F.when(previous.isNull(), "created").when(previous == current, "unchanged").otherwise(both)


def change_status(spark: SparkSession, previous: int | None, current: int) -> str:
    """What a write did, from the row counts before and after."""
    counts = spark.range(1).select(F.lit(previous).cast("bigint").alias("a"), F.lit(current).cast("bigint").alias("b"))
    return counts.select(_status(F.col("a"), F.col("b"))).first()[0]


def change_report(before: DataFrame | None, after: DataFrame) -> DataFrame:
    """The same as a table, with both counts; ``before`` is None where nothing was stored."""
    n = F.count(F.lit(1))
    counts = after.agg(n.alias("current_rows"))
    previous = F.lit(None).cast("bigint") if before is None else before.agg(n).scalar()
    counts = counts.select(previous.alias("previous_rows"), "current_rows")
    return counts.select(_status(F.col("previous_rows"), F.col("current_rows")).alias("status"), "previous_rows", "current_rows")
