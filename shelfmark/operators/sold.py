"""Which listings sold: the difference between consecutive daily snapshots."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.staging import latest_by_id
from shelfmark.schemas import MART_COLUMNS, SOLD_COLUMNS, SOLD_EXT_COLUMNS


def day_before(day: str) -> str:
    return (dt.date.fromisoformat(day) - dt.timedelta(days=1)).isoformat()


def filter_snapshot_day(history: DataFrame, day: str) -> DataFrame:
    """Rows of one snapshot; on a partitioned table only that partition is read."""
    return history.where(F.col("ingestion_date") == day)


def last_available_days(history: DataFrame, today: str) -> dict[str, str]:
    """Latest snapshot of each shop before ``today``; one row per shop is fetched."""
    before = history.where(F.col("ingestion_date") < today)
    days = before.groupBy("store").agg(F.max("ingestion_date").alias("day")).collect()
    return {r["store"]: r["day"] for r in days}


def landed_drops(history: DataFrame, days: Sequence[str]) -> set[tuple[str, str]]:
    """The (store, day) pairs that have a snapshot; one row each is fetched.

    Only partition columns are read.
    """
    found = history.where(F.col("ingestion_date").isin(list(days))).select("store", "ingestion_date").distinct()
    return {(r["store"], r["ingestion_date"]) for r in found.collect()}


def last_available_day(history: DataFrame, today: str) -> str | None:
    """Latest snapshot before ``today`` (one row is fetched), None if there is none."""
    before = history.where(F.col("ingestion_date") < today)
    return before.agg(F.max("ingestion_date").alias("day")).first()["day"]


def snapshot_diff(
    history: DataFrame,
    today: str,
    yesterday: str | None = None,
    key: Sequence[str] | str = "id",
    mode: str = "per_day",
    order: str = "updated_at",
    ties: Sequence[str] = (),
    text_order: bool = False,
) -> DataFrame:
    """Rows of yesterday's snapshot whose key is missing today, with ``sold_date``.

    ``mode="per_day"`` deduplicates within each day and anti-joins the two days; it reads
    two partitions whatever the length of the history.  ``mode="latest_view"`` keeps the
    latest row of each key over all days up to ``today`` and returns those dated
    yesterday.  The two agree while ``order`` never decreases from day to day.

    Both sides reach the join with at most one row per key, and the deduplication already
    partitions by that key, so the join adds one exchange of today's keys alone.
    """
    keys = [key] if isinstance(key, str) else list(key)
    yesterday = yesterday or day_before(today)
    if mode == "per_day":
        gone = latest_by_id(filter_snapshot_day(history, yesterday), keys, order, ties, text_order)
        listed = filter_snapshot_day(history, today).select(*keys).distinct()
        gone = gone.join(listed, keys, "left_anti")
    elif mode == "latest_view":
        seen = history.where(F.col("ingestion_date") <= today)
        latest = latest_by_id(seen, keys, order, ("ingestion_date", *ties), text_order)
        gone = filter_snapshot_day(latest, yesterday)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return gone.withColumn("sold_date", F.lit(today))


def snapshot_diff_days(
    history: DataFrame,
    days: Sequence[str],
    key: Sequence[str] | str = "id",
    order: str = "updated_at",
    ties: Sequence[str] = (),
    text_order: bool = False,
    landed: Iterable[tuple[str, str]] | None = None,
) -> DataFrame:
    """``snapshot_diff`` of many run dates at once, for catching up.

    Gives the union of the single diffs from one pass: each snapshot row is matched with
    the same key one day later.  A backfill of n days costs one job instead of n.

    ``landed`` names the (store, day) pairs that have a snapshot: without one, all that a shop
    listed the day before would seem sold, so other pairs give no rows.
    """
    keys = [key] if isinstance(key, str) else list(key)
    days = list(days)
    befores = [day_before(d) for d in days]
    rows = history.where(F.col("ingestion_date").isin(befores))
    gone = latest_by_id(rows, (*keys, "ingestion_date"), order, ties, text_order)
    day_earlier = F.date_format(F.date_sub(F.to_date("ingestion_date"), 1), "yyyy-MM-dd")
    # Shifted before the distinct, so that its partitioning is the one the join needs.
    listed = history.where(F.col("ingestion_date").isin(days))
    listed = listed.select(*keys, day_earlier.alias("ingestion_date")).distinct()
    gone = gone.join(listed, [*keys, "ingestion_date"], "left_anti")
    next_day = F.date_format(F.date_add(F.to_date("ingestion_date"), 1), "yyyy-MM-dd")
    gone = gone.withColumn("sold_date", next_day)
    if landed is None:
        return gone
    return gone.where(F.concat_ws("/", "store", "sold_date").isin([f"{s}/{d}" for s, d in sorted(landed)]))


def require_complete_day(history: DataFrame, today: str, yesterday: str, min_share: float) -> None:
    """Raise if a shop's snapshot today is smaller than ``min_share`` of yesterday's.

    A scrape that lost pages would otherwise look like sales.  One row per shop is fetched.
    """
    days = history.where(F.col("ingestion_date").isin(today, yesterday))
    sizes = days.groupBy("store").agg(
        F.count_if(F.col("ingestion_date") == today).alias("now"),
        F.count_if(F.col("ingestion_date") == yesterday).alias("before"),
    )
    short = sizes.where(F.col("now") < F.col("before") * F.lit(min_share)).collect()
    if short:
        raise ValueError(f"incomplete snapshots on {today}: {[tuple(r) for r in short]}")


def project_sold(df: DataFrame) -> DataFrame:
    """Columns of a sold table."""
    return df.select(*SOLD_COLUMNS)


def project_sold_ext(df: DataFrame) -> DataFrame:
    """Columns of a sold table of a shop with condition and color."""
    return df.select(*SOLD_EXT_COLUMNS)


def project_mart(df: DataFrame) -> DataFrame:
    """Columns all shops share."""
    return df.select(*MART_COLUMNS)


def sold_products_mart(tables: Sequence[DataFrame]) -> DataFrame:
    """Sold listings of all shops in one frame (bag union by name)."""
    if not tables:
        raise ValueError("no sold tables to unite")
    return reduce(DataFrame.unionByName, [project_mart(t) for t in tables])
