"""The latest row of every listing, kept as a table that advances by the days that are new to it.

Versions of the state lie side by side as partitions ``as_of``; each holds one row per (store, id), the
one ``latest_by_id`` picks from all days up to that one.  Picking the latest row is associative, so a
version follows from the one before it and the days since, and a day that is landed again only needs
the version before that day.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators.staging import latest_by_id
from shelfmark.sources.tables import drop_partitions, ensure_table, evolve_table, insert_bucketed, partition_values

AS_OF = "as_of"
KEY = ("store", "id")
BUCKETS = 200


@dataclass
class Advance:
    """What ``advance_state`` did: the version written, the one it started from, and its rows."""

    as_of: str
    base: str | None
    rows: int


def state_versions(spark: SparkSession, state: str) -> list[str]:
    """Days the state is kept for, from the catalog's partitions; none if there is no table."""
    if not spark.catalog.tableExists(state):
        return []
    return sorted({p[AS_OF] for p in partition_values(spark, state)})


def merged_state(
    spark: SparkSession, products: str, state: str, base: str | None, until: str, text_order: bool = False
) -> DataFrame:
    """Version ``until``: the version ``base`` and the days after it, or all days without a base.

    Reads the partitions of those days and of that version, nothing else, and shuffles them once.
    """
    history = spark.table(products).where(F.col("ingestion_date") <= until)
    if base is not None:
        before = spark.table(state).where(F.col(AS_OF) == base).drop(AS_OF)
        history = history.where(F.col("ingestion_date") > base).unionByName(before, allowMissingColumns=True)
    return latest_by_id(history, KEY, ties=("ingestion_date",), text_order=text_order)


def advance_state(
    spark: SparkSession,
    products: str,
    state: str,
    day: str,
    keep: int = 3,
    text_order: bool = False,
    path: str | None = None,
    buckets: int = BUCKETS,
) -> Advance:
    """Bring the state up to date after ``day`` was landed, for the first time or again.

    Starts from the newest version before ``day``; with none it is computed from the whole history.
    Versions from ``day`` on are out of date then: the newest of them, or ``day``, is written anew and
    the others are dropped, as are all but the ``keep`` newest.  Safe to repeat.
    """
    versions = state_versions(spark, state)
    until = max([day, *versions])
    base = max((v for v in versions if v < day), default=None)
    rows = merged_state(spark, products, state, base, until, text_order).withColumn(AS_OF, F.lit(until))
    if not ensure_table(spark, state, rows, (AS_OF, "store"), path, buckets, ("id",)):
        evolve_table(spark, state, rows.schema, until)
    written = insert_bucketed(spark, state, rows, [{AS_OF: until}])
    stale = [v for v in versions if day <= v != until]
    kept = sorted({*versions, until} - set(stale))
    drop_partitions(spark, state, [{AS_OF: v} for v in [*stale, *kept[:-keep]]])
    return Advance(until, base, written)


def latest_state(spark: SparkSession, state: str, as_of: str | None = None) -> DataFrame:
    """One row per (store, id), the latest up to ``as_of`` (by default the newest version)."""
    versions = state_versions(spark, state)
    wanted = as_of or max(versions, default=None)
    if wanted not in versions:
        raise LookupError(f"{state} is not kept for {wanted}; it is for {versions}")
    return spark.table(state).where(F.col(AS_OF) == wanted).drop(AS_OF)


def sold_from_state(spark: SparkSession, state: str, today: str, yesterday: str) -> DataFrame:
    """``snapshot_diff(mode="latest_view")`` from the version of ``today`` instead of the whole history."""
    gone = latest_state(spark, state, today).where(F.col("ingestion_date") == yesterday)
    return gone.withColumn("sold_date", F.lit(today))
