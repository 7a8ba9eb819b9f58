"""Counts, revenue and bounds of sold listings.

Every grouping aggregates within map tasks first, so a vendor, day or type holding a large
share of the rows costs its reducer one row per task.  NULL group keys are dropped.

``weight`` names a column of row counts when the input is already grouped, such as
``daily_vendor_rollup``; by default every row counts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import date_label, weekday_name

# Weekdays in report order.
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def _n_rows(weight: str | None = None) -> Column:
    return F.count(F.lit(1)) if weight is None else F.sum(weight)


def row_count(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Number of rows, as one row."""
    return df.agg(F.coalesce(_n_rows(weight), F.lit(0).cast("bigint")).alias("row_count"))


def bounds(df: DataFrame, columns: tuple[str, ...] = ("price", "days_on_market", "sold_date")) -> DataFrame:
    """Minimum and maximum of each column in one pass."""
    return df.agg(*[f(c).alias(f"{c}_{f.__name__}") for c in columns for f in (F.min, F.max)])


def distinct_vendors(df: DataFrame) -> DataFrame:
    """Vendor choices, sorted."""
    return df.select("vendor").distinct().orderBy("vendor")


def counts_by(df: DataFrame, column: str, name: str = "count", weight: str | None = None) -> DataFrame:
    """Rows per value, most frequent first (ties by value)."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(_n_rows(weight).alias(name))
    return counts.orderBy(F.desc(name), F.asc(column))


def counts_by_type(df: DataFrame) -> DataFrame:
    """Rows per product type, most frequent first."""
    return counts_by(df, "product_type")


def products_by_vendor(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Products sold per vendor, most first."""
    return counts_by(df, "vendor", "products_sold", weight)


def _on_spine(counts: DataFrame, value: str) -> DataFrame:
    """``counts`` has at most one row per weekday name, so it is safe to broadcast."""
    spine = counts.sparkSession.createDataFrame(list(enumerate(WEEKDAYS, 1)), "ord int, day_of_week string")
    filled = F.coalesce(F.col(value), F.lit(0).cast("bigint")).alias(value)
    return spine.join(F.broadcast(counts), "day_of_week", "left").select("ord", "day_of_week", filled).orderBy("ord")


def weekday_spine(counts: DataFrame, value: str = "sales_count") -> DataFrame:
    """All seven weekdays, Monday first, with 0 where ``counts`` has no row.

    Rows of ``counts`` with the same name are added up, other names are dropped.
    """
    known = counts.where(F.col("day_of_week").isin(*WEEKDAYS))
    return _on_spine(known.groupBy("day_of_week").agg(F.sum(value).alias(value)), value)


def order_weekday(df: DataFrame, column: str = "day_of_week") -> DataFrame:
    """Rows with a weekday name, Monday first."""
    names = F.array(*[F.lit(d) for d in WEEKDAYS])
    return df.withColumn("ord", F.array_position(names, F.col(column)).cast("int")).orderBy("ord")


def sales_by_weekday(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Sales per weekday including empty ones, Monday first.

    Rows are counted per date before the weekday name is formed, so the name is formatted
    once per date.
    """
    days = sales_per_day(df, weight).select(weekday_name("sold_date").alias("day_of_week"), "sales_count")
    counts = days.groupBy("day_of_week").agg(F.sum("sales_count").alias("sales_count"))
    return _on_spine(counts, "sales_count").select("day_of_week", "sales_count")


def sales_per_day(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Sales per date."""
    keyed = df.where(F.col("sold_date").isNotNull())
    return keyed.groupBy("sold_date").agg(_n_rows(weight).alias("sales_count"))


def sales_per_day_vendor(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Sales per date and vendor."""
    keyed = df.where(F.col("sold_date").isNotNull() & F.col("vendor").isNotNull())
    return keyed.groupBy("sold_date", "vendor").agg(_n_rows(weight).alias("sales_count"))


def vendor_totals(per_day_vendor: DataFrame) -> DataFrame:
    """Sum of the daily counts per vendor, most first (legend order)."""
    totals = per_day_vendor.groupBy("vendor").agg(F.sum("sales_count").alias("sales_count"))
    return totals.orderBy(F.desc("sales_count"), F.asc("vendor"))


def revenue_per_day(df: DataFrame) -> DataFrame:
    """Revenue per date, as ``Date`` and ``Total Revenue``."""
    keyed = df.where(F.col("sold_date").isNotNull())
    return keyed.groupBy(F.col("sold_date").alias("Date")).agg(F.sum("price").alias("Total Revenue"))


def sales_by_color_day(df: DataFrame) -> DataFrame:
    """Bags sold per date and exterior color, with a dated weekday label."""
    keyed = df.where(F.col("sold_date").isNotNull() & F.col("exterior_color").isNotNull())
    counts = keyed.groupBy("sold_date", "exterior_color").agg(_n_rows().alias("bags_sold"))
    return counts.withColumn("day_of_week", date_label("sold_date"))


def daily_vendor_rollup(df: DataFrame) -> DataFrame:
    """Sales and revenue per (date, vendor), NULL keys kept.

    One pass from which the charts over dates, weekdays and vendors all follow.
    """
    return df.groupBy("sold_date", "vendor").agg(
        _n_rows().alias("sales_count"), F.sum("price").alias("revenue")
    )


def sold_partials(df: DataFrame, date: str = "sold_date") -> DataFrame:
    """Mergeable figures of stored sold rows per (store, date, vendor), NULL vendors kept.

    ``n_rows``, the bounds of whole price and age, and ``sales_count`` and ``revenue`` of the rows that
    an unfiltered report shows: those with a price, an age and a title.
    """
    price, days = F.col("price").cast("int"), F.col("days_on_market")
    shown = price.isNotNull() & days.isNotNull() & F.col("title").isNotNull()
    return df.groupBy("vendor", "store", date).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(shown).alias("sales_count"),
        F.sum(F.when(shown, price)).alias("revenue"),
        *[f(c).alias(f"{n}_{f.__name__}") for n, c in (("price", price), ("days_on_market", days)) for f in (F.min, F.max)],
    )


def merged_bounds(partials: DataFrame) -> DataFrame:
    """``bounds`` of the rows that ``partials`` were made from."""
    return partials.agg(
        *[f(f"{c}_{f.__name__}").alias(f"{c}_{f.__name__}") for c in ("price", "days_on_market") for f in (F.min, F.max)],
        *[f(F.to_date("sold_date")).alias(f"sold_date_{f.__name__}") for f in (F.min, F.max)],
    )


def merged_rollup(partials: DataFrame) -> DataFrame:
    """``daily_vendor_rollup`` of the shown rows that ``partials`` were made from, all shops together."""
    return (
        partials.where(F.col("sales_count") > 0)
        .groupBy(F.to_date("sold_date").alias("sold_date"), "vendor")
        .agg(F.sum("sales_count").alias("sales_count"), F.sum("revenue").alias("revenue"))
    )
