"""Monthly sums, category shares and month completeness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.functions.calendar import (
    col,
    day_bit,
    day_group,
    days_in_month,
    is_weekend,
    period_label,
    service_day,
)
from panelspark.functions.numbers import share, whole_sum
from panelspark.functions.text import category
from panelspark.specs import FactSpec


def year_month(ts: str) -> list[Column]:
    return [F.year(col(ts)).alias("year"), F.month(col(ts)).alias("month")]


def category_sums(fact: DataFrame, spec: FactSpec = FactSpec()) -> DataFrame:
    """Monthly sum per entity, category and day group."""
    return fact.groupBy(
        col(spec.entity).alias("complex_id"),
        *year_month(spec.time),
        category(spec.category).alias("category"),
        day_group(spec.time).alias("day_group"),
    ).agg(whole_sum(col(spec.measure)).alias("ridership"))


def day_group_sums(fact: DataFrame, spec: FactSpec = FactSpec()) -> DataFrame:
    """Monthly sum per entity and day group, all categories together."""
    return fact.groupBy(
        col(spec.entity).alias("complex_id"), *year_month(spec.time), day_group(spec.time).alias("day_group")
    ).agg(whole_sum(col(spec.measure)).alias("ridership"))


def monthly_wide(fact: DataFrame, spec: FactSpec = FactSpec()) -> DataFrame:
    """All a panel needs from the fact, in one pass: one row per entity and month.

    Weekday and weekend sums, the part of each that is the share category, how many rows of each
    there were, and the days seen as a bit mask. Every aggregate combines on the map side, so the
    shuffle carries one row per entity-month and task, however the fact is skewed.
    """
    weekend = is_weekend(spec.time)
    shared = category(spec.category) == spec.share_category
    x = col(spec.measure)
    return fact.groupBy(col(spec.entity).alias("complex_id"), *year_month(spec.time)).agg(
        whole_sum(F.when(~weekend, x)).alias("weekday_sum"),
        whole_sum(F.when(weekend, x)).alias("weekend_sum"),
        whole_sum(F.when(~weekend & shared, x)).alias("weekday_part"),
        whole_sum(F.when(weekend & shared, x)).alias("weekend_part"),
        F.count_if(~weekend).alias("weekday_rows"),
        F.count_if(weekend).alias("weekend_rows"),
        F.bit_or(day_bit(spec.time)).alias("days_mask"),
    )


def unfold_day_groups(wide: DataFrame, keep_empty: bool = False) -> DataFrame:
    """Total, weekday and weekend rows of a wide monthly table; ``keep_empty`` keeps groups without data."""

    def row(group: str, whole: Column, part: Column, rows: Column) -> Column:
        return F.struct(
            F.lit(group).alias("day_group"),
            whole.cast("double").alias("ridership"),
            share(part, whole).alias("omny_pct"),
            rows.alias("rows"),
        )

    c = F.col
    three = F.array(
        row(
            "total",
            c("weekday_sum") + c("weekend_sum"),
            c("weekday_part") + c("weekend_part"),
            c("weekday_rows") + c("weekend_rows"),
        ),
        row("weekday", c("weekday_sum"), c("weekday_part"), c("weekday_rows")),
        row("weekend", c("weekend_sum"), c("weekend_part"), c("weekend_rows")),
    )
    shown = three if keep_empty else F.filter(three, lambda g: g["rows"] > 0)
    return wide.withColumn("g", F.explode(shown)).select(
        "complex_id",
        "year",
        "month",
        period_label("year", "month").alias("period"),
        c("g.day_group"),
        c("g.ridership"),
        c("g.omny_pct"),
    )


def add_total(sums: DataFrame, measures: Sequence[str] = ("ridership",)) -> DataFrame:
    """Add a ``total`` row beside the day groups: each row counts for its group and for the total."""
    keys = [c for c in sums.columns if c not in (*measures, "day_group")]
    both = sums.withColumn("day_group", F.explode(F.array(F.col("day_group"), F.lit("total"))))
    return (
        both.groupBy(*[col(k) for k in keys], "day_group")
        .agg(*[F.sum(col(m)).alias(m) for m in measures])
        .select(*[col(c) for c in sums.columns])
    )


def category_share(sums: DataFrame, spec: FactSpec = FactSpec()) -> DataFrame:
    """Whole and share of one category per group, from category sums and in one aggregate."""
    keys = [c for c in sums.columns if c not in ("category", "ridership")]
    part = F.when(F.col("category") == spec.share_category, F.col("ridership"))
    return (
        sums.groupBy(*[col(k) for k in keys])
        .agg(whole_sum(F.col("ridership")).alias("_whole"), whole_sum(part).alias("_part"))
        .select(
            *[col(k) for k in keys],
            F.col("_whole").cast("double").alias("ridership"),
            share(F.col("_part"), F.col("_whole")).alias("omny_pct"),
        )
    )


def station_metrics(fact: DataFrame, spec: FactSpec = FactSpec()) -> DataFrame:
    """Sums and shares for the observed entity, month and day group combinations."""
    return unfold_day_groups(monthly_wide(fact, spec))


def daily_sums(fact: DataFrame, spec: FactSpec = FactSpec()) -> DataFrame:
    """Daily sum per entity and category; rows without entity or category are not counted."""
    return (
        fact.filter(col(spec.entity).isNotNull() & col(spec.category).isNotNull())
        .groupBy(
            service_day(spec.time).alias("date"),
            col(spec.entity).alias("station_complex_id"),
            F.upper(col(spec.category)).alias("payment_method"),
        )
        .agg(whole_sum(col(spec.measure)).alias("ridership"))
    )


def pivot_categories(daily: DataFrame, categories: Sequence[str], share_category: str) -> DataFrame:
    """One column per category for each entity, month and day group, the sum of all rows, and the share.

    The categories are given, so no extra pass is needed to find them and the schema is stable. A row of a
    category that isn't given fails the query, so nothing is left out of the sum unseen.
    """
    unlisted = F.concat(F.lit("category not listed: "), F.coalesce(F.col("payment_method"), F.lit("null")))
    listed = F.when(F.col("payment_method").isin(list(categories)), F.col("ridership"))
    every = whole_sum(listed.otherwise(F.raise_error(unlisted).cast("bigint"))).alias("ridership")
    sums = [
        whole_sum(F.when(F.col("payment_method") == c, F.col("ridership"))).alias(c) for c in categories
    ]
    observed = daily.groupBy(
        "station_complex_id", *year_month("date"), day_group("date").alias("day_group")
    ).agg(*sums, every)
    pivoted = add_total(observed, [*categories, "ridership"])
    part = col(share_category) if share_category in categories else F.lit(0)
    return pivoted.withColumn("ridership", F.coalesce("ridership", F.lit(0).cast("bigint"))).select(
        "station_complex_id",
        "year",
        "month",
        period_label("year", "month").alias("period"),
        "day_group",
        *[col(c) for c in categories],
        "ridership",
        share(part, F.col("ridership")).alias("omny_pct"),
    )


def completeness(fact: DataFrame, time: str) -> DataFrame:
    """Days seen in each month, all entities together, against the days the month has.

    The distinct days are an OR of bits, which combines on the map side; a distinct count would
    shuffle every (month, day) pair of every task.
    """
    seen = fact.filter(col(time).isNotNull()).groupBy(*year_month(time)).agg(
        F.bit_or(day_bit(time)).alias("mask"), F.count(F.lit(1)).alias("rows")
    )
    return completeness_of_masks(seen)


def completeness_of_masks(masks: DataFrame) -> DataFrame:
    """The completeness report from (year, month, mask, rows)."""
    expected = days_in_month("year", "month")
    days = F.bit_count("mask")
    first = F.col("mask").bitwiseAND(1) != 0
    last = F.col("mask").bitwiseAND(F.call_function("shiftleft", F.lit(1), expected - 1)) != 0
    reasons = F.array(
        F.when(~first, "first day missing"),
        F.when(~last, "last day missing"),
        F.when(days != expected, F.concat(days.cast("string"), F.lit(" of "), expected.cast("string"), F.lit(" days"))),
    )
    return masks.select(
        "year",
        "month",
        "rows",
        days.alias("days"),
        expected.alias("expected_days"),
        first.alias("has_first_day"),
        last.alias("has_last_day"),
        (days == expected).alias("complete"),
        F.array_join(F.array_compact(reasons), "; ").alias("reasons"),
    )


def complete_months(wide: DataFrame) -> DataFrame:
    """The (year, month) periods with every day covered, from a wide monthly table."""
    masks = wide.groupBy("year", "month").agg(F.bit_or("days_mask").alias("mask"), F.count(F.lit(1)).alias("rows"))
    return completeness_of_masks(masks).filter("complete").select("year", "month")


def of_complete_months(fact: DataFrame, time: str, months: DataFrame | None = None) -> DataFrame:
    """Rows of complete months only, or of the given (year, month) periods.

    The complete months are at most a few hundred, so they travel as one array value and the fact
    is filtered where it lies.
    """
    kept = completeness(fact, time).filter("complete") if months is None else months
    serial = F.year(col(time)) * 12 + F.month(col(time))
    allowed = kept.agg(F.collect_set(F.col("year") * 12 + F.col("month"))).scalar()
    return fact.filter(F.array_contains(allowed, serial))


def monthly_rows(fact: DataFrame, time: str) -> DataFrame:
    return fact.groupBy(*year_month(time)).agg(F.count(F.lit(1)).alias("rows"))


def entity_month_totals(
    daily: DataFrame, entity: str, day: str, measures: Sequence[str], name: str = "complex_id"
) -> DataFrame:
    """Raw monthly totals of a daily table."""
    return daily.groupBy(col(entity).alias(name), *year_month(day)).agg(
        *[whole_sum(col(m)).alias(m.lower()) for m in measures]
    )


def yearly_summary(monthly: DataFrame, measures: Sequence[str], entity: str = "complex_id") -> DataFrame:
    """Totals per year and the number of entities with data."""
    return monthly.groupBy("year").agg(
        *[whole_sum(col(m)).alias(m) for m in measures], F.count_distinct(col(entity)).alias("entities")
    )
