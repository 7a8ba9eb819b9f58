"""Append guard of incremental tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the date assumed for a table without rows.
NEVER = "1970-01-01"


def latest_or_never(column: str = "sold_date") -> Column:
    """Aggregate: the latest date, or the default for a table without rows."""
    return F.coalesce(F.max(F.col(column).cast("string")), F.lit(NEVER))


def _reached(target: DataFrame, today: str, column: str) -> DataFrame:
    """Rows of ``today`` or later, all the guard has to look at.

    If there are none the maximum is earlier than ``today`` and the guard passes either
    way; on a table partitioned by the date only those partitions are read.
    """
    return target.where(F.col(column) >= today)


def incremental_guard(
    new_rows: DataFrame, target: DataFrame | None, today: str, column: str = "sold_date"
) -> DataFrame:
    """Keep ``new_rows`` only if ``today`` is after every date in ``target``.

    Without a target everything passes.  Same-day reruns and days before the stored
    maximum add nothing.
    """
    if target is None:
        return new_rows
    latest = _reached(target, today, column).agg(latest_or_never(column)).scalar()
    return new_rows.where(F.lit(today) > latest)


def guard_passes(target: DataFrame, today: str, column: str = "sold_date") -> bool:
    """The guard's verdict as a Python value (one row is fetched)."""
    latest = _reached(target, today, column).agg(latest_or_never(column).alias("latest"))
    return today > latest.first()["latest"]


def open_stores(target: DataFrame, stores: list[str], today: str, column: str = "sold_date") -> list[str]:
    """The shops the guard lets through, for one table holding all shops.

    At most one row per named shop is fetched.  Filtering the history by the result prunes
    whole partitions of shops that are already done.
    """
    reached = _reached(target, today, column).where(F.col("store").isin(stores))
    marks = reached.groupBy("store").agg(latest_or_never(column).alias("latest"))
    done = {row["store"] for row in marks.collect() if today <= row["latest"]}
    return [s for s in stores if s not in done]
