"""Pages of JSON records whose values are all text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.functions.calendar import col
from panelspark.functions.text import without_json_spaces
from panelspark.schemas import HOURLY_RECORD_COLUMNS


def page_header(spark: SparkSession, first_page: str, preferred: Sequence[str] = HOURLY_RECORD_COLUMNS) -> list[str]:
    """Column names of the first page: preferred ones in their order, then others; ``:`` keys are dropped.

    Only this one page, bounded by the page size, is looked at.
    """
    found = spark.read.option("multiLine", True).option("primitivesAsString", True).json(first_page).columns
    others = [c for c in found if c not in preferred and not c.startswith(":")]
    return [c for c in preferred if c in found] + others


def read_record_pages(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str],
    time_field: str = "transit_timestamp",
    nested: Sequence[str] = ("georeference",),
) -> DataFrame:
    """All pages as one table of text columns; the ``nested`` ones become compact JSON text.

    Each page is one JSON array; records without the time field are skipped.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    # A page is read as one line, as JSON holds no bare control characters. A multi-line reader goes back to the file for the
    # text of each value that is no string, some kilobytes a time.
    pages = spark.read.schema(schema).option("lineSep", "\x1e\x1e").json(paths)
    kept = pages.filter(col(time_field).isNotNull())
    return kept.select(*[without_json_spaces(c).alias(c) if c in nested else F.col(f"`{c}`") for c in columns])
