"""Preparation and filters of sold listings for reporting."""

from __future__ import annotations

from decimal import ROUND_CEILING, ROUND_FLOOR, Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ALL_VENDORS = "All"


def cast_price_int(df: DataFrame) -> DataFrame:
    """Price in whole units, truncated toward zero."""
    return df.withColumn("price", F.col("price").cast("int"))


def cast_sold_date(df: DataFrame) -> DataFrame:
    """``sold_date`` text as a date."""
    return df.withColumn("sold_date", F.to_date("sold_date"))


def drop_columns(df: DataFrame) -> DataFrame:
    """Drop the columns reports do not show."""
    return df.drop("id", "store")


def prepare_sold(df: DataFrame) -> DataFrame:
    """A sold table as reports use it: whole prices, dates, no id and store."""
    return drop_columns(cast_sold_date(cast_price_int(df)))


def _whole(value, rounding: str) -> int:
    return int(Decimal(str(value)).to_integral_value(rounding=rounding))


def _price_range(column: Column, kind: T.DataType, low, high) -> Column:
    """Inclusive bounds on the truncated price, stated on the stored one.

    Comparing the stored decimal lets the bounds reach the Parquet scan; a cast would not.
    """
    keep = column.isNotNull()
    exact = isinstance(kind, T.DecimalType)
    if low is not None:
        first = _whole(low, ROUND_CEILING)
        if exact and first <= 0:
            keep = keep & (column > F.lit(Decimal(first - 1)))
        else:
            keep = keep & (column >= F.lit(Decimal(first) if exact else first))
    if high is not None:
        last = _whole(high, ROUND_FLOOR)
        if exact and last >= 0:
            keep = keep & (column < F.lit(Decimal(last + 1)))
        else:
            keep = keep & (column <= F.lit(Decimal(last) if exact else last))
    return keep


def _range(column: Column, low, high) -> Column:
    keep = column.isNotNull()
    if low is not None:
        keep = keep & (column >= F.lit(low))
    if high is not None:
        keep = keep & (column <= F.lit(high))
    return keep


def _date_bound(kind: T.DataType, value):
    if value is None:
        return None
    text = str(value)[:10]
    return text if isinstance(kind, T.StringType) else F.lit(text).cast("date")


def filter_range(df: DataFrame, price=None, days=None, dates=None) -> DataFrame:
    """Inclusive (low, high) bounds on price, days on market and sold date.

    An open bound (None) still drops NULLs, like a comparison with the column's own
    minimum.  Works on a sold table as stored and on a prepared one; on the stored table
    the bounds are pushed to the scan and dates prune partitions.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    price, days, dates = (b or (None, None) for b in (price, days, dates))
    date_kind = kinds["sold_date"]
    return df.where(
        _price_range(F.col("price"), kinds["price"], *price)
        & _range(F.col("days_on_market"), *days)
        & _range(F.col("sold_date"), *(_date_bound(date_kind, d) for d in dates))
    )


def matches(column: Column | str, pattern: str) -> Column:
    """Case-insensitive regex search; NULL never matches, an empty pattern any other text."""
    column = F.col(column) if isinstance(column, str) else column
    if not pattern:
        return column.isNotNull()
    return F.coalesce(column.rlike("(?iu)" + pattern), F.lit(False))


def filter_title(df: DataFrame, pattern: str = "") -> DataFrame:
    """Rows whose title matches."""
    return df.where(matches("title", pattern))


def filter_color(df: DataFrame, pattern: str = "") -> DataFrame:
    """Rows whose exterior color matches; a NULL color is dropped even by an empty pattern."""
    return df.where(matches("exterior_color", pattern))


def filter_vendor(df: DataFrame, vendor: str = ALL_VENDORS) -> DataFrame:
    """Rows of one vendor, or all rows for ``"All"``."""
    return df if vendor == ALL_VENDORS else df.where(F.col("vendor") == vendor)


def filter_sold(
    df: DataFrame,
    price=None,
    days=None,
    dates=None,
    title: str = "",
    color: str | None = None,
    vendor: str = ALL_VENDORS,
) -> DataFrame:
    """All report filters together; ``color=None`` for shops without colors."""
    out = filter_title(filter_range(df, price, days, dates), title)
    if color is not None:
        out = filter_color(out, color)
    return filter_vendor(out, vendor)
