"""Lookups from facts to dimensions that stay balanced whatever the keys look like."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.functions.calendar import col
from panelspark.workspace import stored

# A dimension of at most this many rows and bytes is sent to every executor; a larger one is not.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024
# A key with more than one part in this many of a fact's rows is split.
HOT_PARTS = 10_000


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the table is within both bounds: one aggregate over it, combined on the map side.

    Bytes are those of the rows as JSON text, which long names and polygons cannot hide from.
    """
    size = F.octet_length(F.to_json(F.struct(*[col(c) for c in df.columns])))
    seen = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    return seen["n"] <= max_rows and seen["bytes"] <= max_bytes


def hot_keys(fact: DataFrame, keys: Sequence[str], parts: int = HOT_PARTS) -> DataFrame:
    """Keys with more than 1/``parts`` of the fact's rows, and into how many pieces to split each.

    There are fewer than ``parts`` such keys, and fewer than twice ``parts`` pieces, whatever the data.
    """
    counts = fact.dropna(subset=list(keys)).groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
    fair = counts.agg(F.greatest(F.ceil(F.sum("_n") / parts), F.lit(1))).scalar()
    return counts.filter(F.col("_n") > fair).select(*[col(k) for k in keys], F.ceil(F.col("_n") / fair).alias("_pieces"))


def salted(
    fact: DataFrame, dim: DataFrame, keys: Sequence[str], parts: int = HOT_PARTS
) -> tuple[DataFrame, DataFrame]:
    """Both sides with a ``_salt`` column to join on as well: a hot key's rows get one of its pieces.

    The dimension repeats a hot key's rows once per piece and no others. Rows without a key match
    nothing, so they are spread over all salts. The salt follows from the row and its input
    partition, so a task that runs again gives the same; equal rows of one partition stay together,
    no more than that partition already held.
    """
    hot = F.broadcast(stored(hot_keys(fact, keys, parts), "hot-keys"))
    spread = F.xxhash64(F.spark_partition_id(), *[col(c) for c in fact.columns])
    lacking = F.lit(False)
    for k in keys:
        lacking = lacking | col(k).isNull()
    salt = (
        F.when(lacking, F.pmod(spread, F.lit(parts)))
        .when(F.col("_pieces").isNotNull(), F.pmod(spread, F.col("_pieces")))
        .otherwise(F.lit(0))
    )
    left = fact.join(hot, list(keys), "left").select(*[col(c) for c in fact.columns], salt.alias("_salt"))
    pieces = F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col("_pieces"), F.lit(1)) - 1)
    right = dim.join(hot, list(keys), "left").select(*[col(c) for c in dim.columns], F.explode(pieces).alias("_salt"))
    return left, right


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    condition: Column | None = None,
    max_rows: int = BROADCAST_ROWS,
    parts: int = HOT_PARTS,
) -> DataFrame:
    """Join a large table with a dimension on columns both have, without moving a hot key to one task.

    The dimension's size is checked first; one that is costly to compute should be a stored table.
    A small one is broadcast, so the fact does not move at all. With a larger one, keys that hold
    too many of the fact's rows are found and split over many tasks. Rows and order of columns are
    the same either way. ``condition`` is an extra predicate; its columns must be named
    differently in the two tables.
    """
    if is_small(dim, max_rows):
        right, left, on = F.broadcast(dim), fact, list(keys)
    else:
        left, right = salted(fact, dim, keys, parts)
        on = [*keys, "_salt"]
    extra = [c for c in dim.columns if c not in keys] if how not in ("left_semi", "left_anti") else []
    if condition is None:
        return left.join(right, on, how).select(*[col(c) for c in [*fact.columns, *extra]])
    renamed = right.select(*[col(c).alias(f"_r_{c}" if c in on else c) for c in right.columns])
    equal = F.lit(True)
    for c in on:
        equal = equal & (col(c) == col(f"_r_{c}"))
    return left.join(renamed, equal & condition, how).select(*[col(c) for c in [*fact.columns, *extra]])


def left_many_to_one(
    left: DataFrame, right: DataFrame, keys: Sequence[str], value: str, label: str = "baseline"
) -> DataFrame:
    """Left join that fails the query when a matched right key occurs twice; rows never multiply."""
    one = right.groupBy(*[col(k) for k in keys]).agg(
        F.first(col(value)).alias(value), F.count(F.lit(1)).alias("_n")
    )
    message = F.lit(f"{label} has duplicate keys for {list(keys)}")
    checked = F.when(F.col("_n") > 1, F.raise_error(message).cast("double")).otherwise(col(value))
    return left.join(one.select(*[col(k) for k in keys], checked.alias(value)), list(keys), "left")


def split_by_membership(df: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Every row with a flag telling whether its key is among the members: one join, not two."""
    marked = members.select(col(key)).distinct().withColumn("is_special", F.lit(True))
    return df.join(marked, key, "left").withColumn("is_special", F.coalesce("is_special", F.lit(False)))


def coverage(df: DataFrame, column: str) -> DataFrame:
    """Rows with and without a value, and the percent with one."""
    matched = F.count(col(column))
    total = F.count(F.lit(1))
    return df.agg(
        matched.alias("matched"),
        (total - matched).alias("missing"),
        F.coalesce(F.rint(F.try_divide(matched, total) * 1000.0) / 10.0, F.lit(0.0)).alias("matched_pct"),
    )
