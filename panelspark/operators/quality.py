"""Data-quality checks: each gives a table of violations; the ``require_*`` forms raise."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.functions.calendar import col
from panelspark.functions.text import full_name, year_list_is_valid
from panelspark.operators.filters import set_difference
from panelspark.operators.joins import lookup
from panelspark.specs import DAY_GROUPS


class QualityError(ValueError):
    """A table broke a rule it must keep."""


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with how often."""
    return df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def require_unique(df: DataFrame, keys: Sequence[str], label: str, samples: int = 10) -> None:
    found = duplicate_keys(df, keys).orderBy(*[col(k) for k in keys]).limit(samples).collect()
    if found:
        raise QualityError(f"{label} has duplicate keys for {list(keys)}: {[r.asDict() for r in found]}")


def enum_violations(df: DataFrame, column: str, allowed: Sequence[str] = DAY_GROUPS) -> DataFrame:
    """Missing values, values not allowed, and allowed values never seen."""
    nulls = (
        df.agg(F.count_if(col(column).isNull()).alias("n"))
        .filter("n > 0")
        .select(F.lit("null").alias("kind"), F.lit(None).cast("string").alias("value"))
    )
    return set_difference(df, column, allowed).withColumn("value", F.col("value").cast("string")).unionByName(nulls)


def require_enum(df: DataFrame, column: str, label: str, allowed: Sequence[str] = DAY_GROUPS) -> None:
    """One aggregate decides; the violations are listed only when there are any."""
    c = col(column)
    wrong = F.count_if(c.isNull() | ~c.isin(*allowed)).alias("wrong")
    row = df.agg(wrong, *[F.count_if(c == a).alias(f"n{i}") for i, a in enumerate(allowed)]).first()
    if row["wrong"] or not all(row[f"n{i}"] for i in range(len(allowed))):
        found = enum_violations(df, column, allowed).orderBy("kind", "value").limit(20).collect()
        raise QualityError(f"{label}: {column} breaks {sorted(allowed)}: {[tuple(r) for r in found]}")


def require_day_group_keys(tables: Sequence[tuple[DataFrame, Sequence[str], str]]) -> None:
    """``require_enum`` of the day group and ``require_unique`` of the keys, which hold it, for (table, keys, label)s.

    One job over all tables, one aggregate each; the table that breaks a rule is looked at again to say how.
    """
    dg = F.col("day_group")
    seen = [F.count_if(dg == g).alias(f"n{i}") for i, g in enumerate(DAY_GROUPS)]
    wrong = F.count_if(dg.isNull() | ~dg.isin(*DAY_GROUPS) | (F.col("_n") > 1)).alias("wrong")
    parts = [
        df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n")).agg(wrong, *seen).select(F.lit(i).alias("i"), "*")
        for i, (df, keys, _) in enumerate(tables)
    ]
    for r in functools.reduce(DataFrame.unionByName, parts).collect() if parts else []:
        if r["wrong"] or not all(r[f"n{k}"] for k in range(len(DAY_GROUPS))):
            df, keys, label = tables[r["i"]]
            require_enum(df, "day_group", label)
            require_unique(df, keys, label)


def negative_count(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(col(column) < 0).alias("negative"))


def require_non_negative(df: DataFrame, column: str, label: str) -> None:
    if not df.filter(col(column) < 0).limit(1).isEmpty():
        raise QualityError(f"{label}: {column} has negative counts")


def row_count_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row counts before and after a step, and whether they agree: two aggregates, one row."""
    n = F.count(F.lit(1))
    return before.agg(n.alias("before"), after.agg(n).scalar().alias("after")).select(
        "before", "after", (F.col("before") == F.col("after")).alias("preserved")
    )


def reconcile_months(source: DataFrame, landed: DataFrame) -> DataFrame:
    """Row counts of each month at the source and as landed, with a status.

    Both sides are (year, month, rows), so the full join is between two calendars.
    """
    a = source.select("year", "month", F.col("rows").alias("source_rows"))
    b = landed.select("year", "month", F.col("rows").alias("landed_rows"))
    status = (
        F.when(F.col("landed_rows").isNull(), "not landed")
        .when(F.col("source_rows").isNull(), "no data")
        .when(F.col("source_rows") == F.col("landed_rows"), "matched")
        .otherwise("mismatch")
    )
    return a.join(b, ["year", "month"], "full").select(
        "year",
        "month",
        F.coalesce("source_rows", F.lit(0)).alias("source_rows"),
        F.coalesce("landed_rows", F.lit(0)).alias("landed_rows"),
        status.alias("status"),
    )


def row_digest(columns: Sequence[str]) -> Column:
    """A 256-bit digest of the columns as text; each length is written down, so rows cannot run together."""
    texts = [F.coalesce(col(c).cast("string"), F.lit("")) for c in columns]
    return F.sha2(F.concat(*[F.concat(F.length(t).cast("string"), F.lit(":"), t) for t in texts]), 256)


def duplicate_groups(
    df: DataFrame, columns: Sequence[str] | None = None, order: str | None = None, wide: bool = False
) -> DataFrame:
    """Groups of rows equal in every column, an empty field and a missing one being equal.

    Gives the group's size and its first place in ``order``. ``wide`` groups by a digest instead
    of the columns themselves, so that long texts are not shuffled.
    """
    names = list(columns or df.columns)
    if wide:
        keys = [row_digest(names).alias("digest")]
    else:
        texts = {c for c, kind in df.dtypes if kind == "string"}
        keys = [F.coalesce(col(c), F.lit("")).alias(c) if c in texts else col(c) for c in names]
    seen = [F.min(col(order)).alias("first_seen")] if order else []
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"), *seen)


def duplicate_summary(groups: DataFrame) -> DataFrame:
    """Rows scanned, and rows beyond the first of each group."""
    return groups.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_scanned"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def duplicate_samples(groups: DataFrame, n: int = 5) -> DataFrame:
    """The first n groups with copies, by first place."""
    return groups.filter(F.col("copies") > 1).orderBy("first_seen").limit(n)


def special_case_errors(config: DataFrame) -> DataFrame:
    """Rows of a special-case table that cannot be used, with the line and what is wrong."""
    cid, years = F.col("complex_id").cast("string"), F.col("baseline_years")
    row = F.concat(F.lit("row "), F.col("line").cast("string"))
    error = (
        F.when(F.coalesce(F.trim(cid), F.lit("")) == "", F.concat(row, F.lit(": no complex_id")))
        .when(
            F.coalesce(F.trim(years), F.lit("")) == "",
            F.concat(row, F.lit(", complex_id "), cid, F.lit(": no baseline_years")),
        )
        .when(
            F.trim(cid).try_cast("int").isNull(),
            F.concat(row, F.lit(": complex_id <"), cid, F.lit("> is no whole number")),
        )
        .when(
            ~year_list_is_valid(years),
            F.concat(row, F.lit(", complex_id "), cid, F.lit(": baseline_years <"), years, F.lit("> is no list of years")),
        )
    )
    return config.select("line", error.alias("error")).filter(F.col("error").isNotNull())


def require_special_cases(config: DataFrame) -> None:
    missing = [c for c in ("complex_id", "baseline_years") if c not in config.columns]
    if missing:
        raise QualityError(f"special cases without {' and '.join(missing)}")
    found = special_case_errors(config).orderBy("line").limit(20).collect()
    if found:
        raise QualityError("; ".join(r["error"] for r in found))


def repeated_ids(config: DataFrame, key: str = "complex_id") -> DataFrame:
    """Config rows whose id occurs more than once, with how often."""
    many = duplicate_keys(config, [key]).withColumnRenamed("rows", "entries")
    return lookup(config, many, [key], "inner")


def official_names(
    official: DataFrame, stop: str = "Stop Name", display: str = "Display Name", key: str = "complex_id"
) -> DataFrame:
    """The distinct (id, full name) pairs of the official table."""
    return official.select(col(key), full_name(stop, display, "").alias("station_name")).distinct()


def config_discrepancies(config: DataFrame, names: DataFrame, key: str = "complex_id") -> DataFrame:
    """Config rows whose id is unknown, or whose name is none of the id's official ``names``."""
    ids = names.select(col(key)).distinct().withColumn("_known", F.lit(True))
    wrong = lookup(config.select("line", col(key), "station_name"), names, [key, "station_name"], "left_anti")
    issue = F.when(F.col("_known").isNull(), "unknown id").otherwise("name differs")
    return lookup(wrong, ids, [key]).withColumn("issue", issue).drop("_known")


def expected_names(discrepancies: DataFrame, names: DataFrame, key: str = "complex_id") -> DataFrame:
    """The official names of ids with a wrong name, one row each, for the report."""
    wrong = discrepancies.select(col(key)).distinct()
    return lookup(names, wrong, [key], "left_semi").withColumnRenamed("station_name", "official_name")


def profile(df: DataFrame, distinct: Sequence[str], time: str) -> DataFrame:
    """Rows, exact distinct counts and the time range of a table."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_distinct(col(c)).alias(f"distinct_{c}") for c in distinct],
        F.min(col(time)).alias("first_time"),
        F.max(col(time)).alias("last_time"),
    )
