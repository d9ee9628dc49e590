"""Readable names for published panels."""

from __future__ import annotations

from pyspark.sql import DataFrame

from panelspark.functions.calendar import col
from panelspark.operators.filters import placed_after
from panelspark.operators.joins import coverage


def with_name(df: DataFrame, names: DataFrame, key: str, name: str) -> DataFrame:
    """Join the name of the key and place it right after the key; running it twice changes nothing."""
    bare = df.drop(name)
    joined = bare.join(names.select(col(key), col(name)), key, "left")
    return joined.select(*[col(c) for c in placed_after([*bare.columns, name], key, name)])


def published_order(df: DataFrame, name: str | None, ties: tuple[str, ...] = ()) -> DataFrame:
    """Year, month, then the name as text with missing names last; ``ties`` settle the rest."""
    order = [col("year").asc(), col("month").asc()]
    if name:
        order.append(col(name).asc_nulls_last())
    return df.orderBy(*order, *[col(t).asc_nulls_last() for t in ties])


def name_coverage(df: DataFrame, name: str) -> DataFrame:
    return coverage(df, name)
