"""Which (store, day) drops are expected, and which are missing."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _date(value: Column | str) -> Column:
    return F.lit(value).cast("date") if isinstance(value, str) else value


def expand_days(stores: DataFrame, start: Column | str, end: Column | str) -> DataFrame:
    """One row per store row and day from ``start`` up to, not including, ``end``."""
    last = F.date_sub(_date(end), 1)
    days = F.when(_date(start) <= last, F.sequence(_date(start), last))
    return stores.withColumn("day", F.explode(days))


def coverage_grid(spark: SparkSession, stores: Sequence[str], start: str, end: str) -> DataFrame:
    """(store, day) for every store and day, ``end`` exclusive.

    The product of the two lists comes from exploding arrays, not from a join.
    """
    if not stores or dt.date.fromisoformat(start) >= dt.date.fromisoformat(end):
        return spark.createDataFrame([], "store string, day date")
    grid = spark.range(1).select(F.explode(F.array(*[F.lit(s) for s in stores])).alias("store"))
    return expand_days(grid, start, end)


def store_start_gate(grid: DataFrame, starts: Mapping[str, str], default: str | None = None) -> DataFrame:
    """Drop days before a store's first day.

    Stores absent from ``starts`` use ``default``; without one all their days pass.
    """
    first = F.lit(default).cast("date")
    for store, day in starts.items():
        first = F.when(F.col("store") == store, F.lit(day).cast("date")).otherwise(first)
    return grid.where(F.coalesce(F.col("day") >= first, F.lit(True)))


def missing_drops(grid: DataFrame, landed: DataFrame) -> DataFrame:
    """Grid cells without landed rows; ``landed`` has ``store`` and ``day``."""
    return grid.join(landed.select("store", "day").distinct(), ["store", "day"], "left_anti")
