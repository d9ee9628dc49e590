"""Vectors with whole components, as the exact operators on vectors take them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.tables import col
from panelspark.workspace import stored


def largest(dims: int) -> int:
    """A size up to which components are so small that the squared distance of any two vectors fits in 63 bits."""
    return int(((2**63 - 1) / (4 * max(dims, 1))) ** 0.5 * 0.999)


def whole_vectors(
    vectors: DataFrame, scale: int, id_col: str = "vec_id", vector_col: str = "embedding", keep: dict[str, str] | None = None, parts: int = 1
) -> tuple[DataFrame, int]:
    """A stored table ``id, v, row`` and the columns to keep (old name -> new name), and the number of components.

    A component x becomes floor(scale * x) of x as a double; ``row`` tells rows apart. Rows are left out whose vector
    is null, has a null or non-finite component, has another length than the vector of the smallest id whose length
    is a multiple of ``parts``, or has a component beyond ``largest``, where a result would not fit in a long.
    """
    v = col(vector_col).cast("array<double>")
    names = [col(a).alias(b) for a, b in (keep or {}).items()]
    rows = vectors.select(col(id_col).alias("id"), v.alias("v"), *names, F.monotonically_increasing_id().alias("row"))
    fine = F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(fine)
    sized = rows.filter((F.size("v") > 0) & (F.size("v") % parts == 0))
    first = sized.select("id", F.size("v").alias("n")).orderBy(F.col("id").asc_nulls_last(), "n").first()
    dims = first["n"] if first else 0
    limit = float(largest(dims))
    scaled = F.transform("v", lambda x: F.floor(F.when(F.abs(x) < limit, x).otherwise(0.0) * F.lit(float(scale))))
    near = F.forall("v", lambda x: F.abs(x) * F.lit(float(scale)) < limit)
    kept = rows.filter((F.size("v") == dims) & (dims > 0) & near)
    return stored(kept.withColumn("v", scaled), "whole-vectors"), dims
