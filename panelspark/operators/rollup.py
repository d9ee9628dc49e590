"""Roll-ups along the geography: entity to district to city."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions.calendar import col
from panelspark.functions.numbers import exact_sum, part_from_share, share, share_or_null, whole_sum

PERIOD = ("year", "month", "period", "day_group")


def to_district(panel: DataFrame, mapping: DataFrame, key: str = "puma", entity: str = "complex_id") -> DataFrame:
    """Attach the district; entities without one disappear."""
    return panel.join(mapping.select(col(entity), col(key)), entity, "inner").filter(col(key).isNotNull())


def unmapped(panel: DataFrame, mapping: DataFrame, key: str = "puma", entity: str = "complex_id") -> DataFrame:
    """Entities of the panel that have no district, with their rows."""
    known = mapping.filter(col(key).isNotNull())
    return panel.join(known, entity, "left_anti").groupBy(col(entity)).agg(F.count(F.lit(1)).alias("rows"))


def roll_up(panel: DataFrame, mapping: DataFrame | None = None, key: str | None = None) -> DataFrame:
    """District or city panel from the station panel.

    The share is built anew from each cell's part, which is taken back from its rounded
    percentage, as published; it is not the exact share.
    """
    rows = panel if mapping is None else to_district(panel, mapping, key)
    keys = [*([key] if key else []), *PERIOD]
    part = part_from_share(F.col("ridership"), F.col("omny_pct"))
    return (
        rows.groupBy(*[col(k) for k in keys])
        .agg(exact_sum(F.col("ridership")).alias("ridership"), exact_sum(part).alias("_part"))
        .select(*[col(k) for k in keys], "ridership", share(F.col("_part"), F.col("ridership")).alias("omny_pct"))
    )


def roll_up_categories(
    panel: DataFrame,
    categories: Sequence[str],
    share_category: str,
    mapping: DataFrame | None = None,
    key: str | None = None,
    entity: str = "station_complex_id",
) -> DataFrame:
    """District or city panel from category columns: the exact share, missing where nothing was counted."""
    rows = panel if mapping is None else to_district(panel, mapping, key, entity)
    keys = [*([key] if key else []), *PERIOD]
    sums = rows.groupBy(*[col(k) for k in keys]).agg(
        *[whole_sum(col(c)).alias(c) for c in [*categories, "ridership"]]
    )
    if share_category not in categories:
        return sums.withColumn("omny_pct", F.lit(0.0))
    return sums.withColumn("omny_pct", share_or_null(col(share_category), F.col("ridership")))
