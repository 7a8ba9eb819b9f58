"""Everything one report page shows, over one filtered frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import currency_label, date_label
from shelfmark.operators.aggregates import (
    bounds,
    daily_vendor_rollup,
    distinct_vendors,
    merged_bounds,
    merged_rollup,
    products_by_vendor,
    revenue_per_day,
    row_count,
    sales_by_color_day,
    sales_by_weekday,
    sales_per_day,
    sales_per_day_vendor,
    vendor_totals,
)
from shelfmark.operators.boxplot import box_outliers, box_stats
from shelfmark.operators.filters import filter_sold, filter_vendor, prepare_sold
from shelfmark.operators.points import price_vs_condition_points, price_vs_type_points


def _reached(partials: DataFrame, dates, vendor: str) -> DataFrame:
    """Partial aggregates of the chosen dates and vendor."""
    low, high = dates or (None, None)
    out = filter_vendor(partials, vendor)
    out = out if low is None else out.where(F.col("sold_date") >= str(low)[:10])
    return out if high is None else out.where(F.col("sold_date") <= str(high)[:10])


def dashboard(
    sold: DataFrame,
    price=None,
    days=None,
    dates=None,
    title: str = "",
    color: str | None = None,
    vendor: str = "All",
    type_chart: bool = True,
    partials: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Frames of a report page by name; ``color`` (also '') adds those of shops with colors.

    Seven of them follow from one rollup by date and vendor, which is cached: it is small
    and replaces seven scans.  Call ``result["rollup"].unpersist()`` when done.  Box plots
    and points read only their own columns from the filtered table.

    With ``partials`` (``read_rollup`` of the same table and shops) the choices come from them, and so
    do those seven frames unless price, age, title or color are filtered: no sold row is read then.
    """
    rows = prepare_sold(filter_sold(sold, price, days, dates, title, color, vendor))
    by_row = title or color is not None or any(v is not None for pair in (price, days) for v in pair or ())
    if partials is None or by_row:
        rollup = daily_vendor_rollup(rows).persist()
    else:
        rollup = merged_rollup(_reached(partials, dates, vendor)).persist()
    weight = "sales_count"
    per_day_vendor = sales_per_day_vendor(rollup, weight)
    revenue = revenue_per_day(rollup.select("sold_date", F.col("revenue").alias("price")))

    box_price, box_days = box_stats(rows, "price"), box_stats(rows, "days_on_market")

    page = {
        "rows": rows,
        "rollup": rollup,
        "bounds": bounds(prepare_sold(sold)) if partials is None else merged_bounds(partials),
        "vendors": distinct_vendors(sold if partials is None else partials),
        "row_count": row_count(rollup, weight),
        "box_price": box_price,
        "box_days": box_days,
        "outliers_price": box_outliers(rows, "price", box_price),
        "outliers_days": box_outliers(rows, "days_on_market", box_days),
        "sales_by_weekday": sales_by_weekday(rollup, weight),
        "sales_per_day": sales_per_day(rollup, weight).withColumn("label", date_label("sold_date", two_lines=True)),
        "sales_per_day_vendor": per_day_vendor.withColumn("label", date_label("sold_date", two_lines=True)),
        "vendor_totals": vendor_totals(per_day_vendor),
        "revenue_per_day": revenue.withColumn("label", currency_label("Total Revenue")),
        "products_by_vendor": products_by_vendor(rollup, weight),
    }
    if type_chart:
        page["price_vs_type"] = price_vs_type_points(rows)
    if color is not None:
        page["price_vs_condition"] = price_vs_condition_points(rows)
        page["sales_by_color_day"] = sales_by_color_day(rows)
    return page
