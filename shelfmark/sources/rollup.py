"""Figures of a sold table per (store, date, vendor), kept as a table in step with it.

A rollup is named in a property of its sold table, so every function of ``tables`` that changes rows
there also recomputes the (store, date) partitions it touched, from those partitions alone.  Before
rows change, the rollup is marked as behind; the mark goes when it has caught up.  A run that dies in
between leaves the mark, reading then raises, and the next write or ``repair_rollup`` catches up.
Like the tables themselves, a sold table takes one writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.sources import tables

_NAME = "shelfmark.rollup"  # property of the sold table: its rollup
_BEHIND = "shelfmark.behind"  # property of the rollup: partitions to recompute, or "all"
_MARK_CHARS = 3000  # metastores limit the length of a property

Drop = tuple[str, str]


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {tables._name(name)}").collect()}


def rollup_of(spark: SparkSession, sold: str) -> str | None:
    """The rollup attached to a table, if any."""
    return _properties(spark, sold).get(_NAME)


def _mark(spark: SparkSession, rollup: str, drops: Iterable[Drop] | None) -> None:
    text = "all" if drops is None else json.dumps(sorted(set(drops)))
    text = text if len(text) <= _MARK_CHARS else "all"
    spark.sql(f"ALTER TABLE {tables._name(rollup)} SET TBLPROPERTIES ({tables._text(_BEHIND)} = {tables._text(text)})")


def _behind(spark: SparkSession, rollup: str) -> tuple[bool, list[Drop] | None]:
    """Whether the rollup is behind, and for which partitions (None: all)."""
    text = _properties(spark, rollup).get(_BEHIND)
    return text is not None, None if text in (None, "all") else [tuple(d) for d in json.loads(text)]


def _catch_up(spark: SparkSession, sold: str, rollup: str, drops: Iterable[Drop] | None) -> int:
    """Recompute partitions of the rollup (None: all), remove the mark; returns rows written."""
    from shelfmark.operators.aggregates import sold_partials

    column = tables.partition_columns(spark, sold)[1]
    rows = spark.table(sold)
    if drops is None:
        known = tables.partition_values(spark, sold) + tables.partition_values(spark, rollup)
        drops = {(p["store"], p[column]) for p in known}
    else:
        drops = set(drops)
        # Only these partitions are listed and read.
        rows = rows.where(F.col("store").isin([s for s, _ in drops]) & F.col(column).isin([d for _, d in drops]))
        rows = rows.where(F.concat_ws("/", "store", column).isin([f"{s}/{d}" for s, d in drops]))
    written = 0
    if drops:
        partials = sold_partials(rows, column).hint("rebalance", F.col("store"), F.col(column))
        written = sum(tables.replace_days(spark, rollup, partials, sorted(drops), column).values())
    spark.sql(f"ALTER TABLE {tables._name(rollup)} UNSET TBLPROPERTIES IF EXISTS ({tables._text(_BEHIND)})")
    return written


@contextmanager
def in_step(spark: SparkSession, sold: str, drops: Iterable[Drop] | None = None) -> Iterator[set[Drop]]:
    """Around a change of ``sold``: yields the set of touched partitions, to which the change may add.

    Name ``drops`` where they are known before; the mark then covers them alone.
    """
    rollup = rollup_of(spark, sold)
    touched = set(drops or ())
    if rollup is None:
        yield touched
        return
    repair_rollup(spark, sold)
    _mark(spark, rollup, None if drops is None else touched)
    yield touched
    _catch_up(spark, sold, rollup, touched)


def attach_rollup(spark: SparkSession, sold: str, rollup: str, path: str | None = None) -> int:
    """Make ``rollup`` the rollup of ``sold`` and compute it from all rows; returns its rows.

    ``sold`` is partitioned by store and a date; what the rollup held before is replaced.
    """
    from shelfmark.operators.aggregates import sold_partials

    keys = tables.partition_columns(spark, sold)
    if len(keys) != 2 or keys[0] != "store":
        raise ValueError(f"{sold} is partitioned by {keys}, not by store and a date")
    tables.ensure_table(spark, rollup, sold_partials(spark.table(sold), keys[1]), keys, path)
    _mark(spark, rollup, None)
    spark.sql(f"ALTER TABLE {tables._name(sold)} SET TBLPROPERTIES ({tables._text(_NAME)} = {tables._text(rollup)})")
    return _catch_up(spark, sold, rollup, None)


def detach_rollup(spark: SparkSession, sold: str) -> None:
    """Later writes leave the rollup alone; its table stays, marked as behind."""
    rollup = rollup_of(spark, sold)
    if rollup is not None:
        _mark(spark, rollup, None)
        spark.sql(f"ALTER TABLE {tables._name(sold)} UNSET TBLPROPERTIES IF EXISTS ({tables._text(_NAME)})")


def repair_rollup(spark: SparkSession, sold: str) -> int:
    """Recompute what an interrupted write left behind; returns rows written, 0 if nothing was."""
    rollup = rollup_of(spark, sold)
    if rollup is None:
        raise LookupError(f"{sold} has no rollup")
    late, drops = _behind(spark, rollup)
    return _catch_up(spark, sold, rollup, drops) if late else 0


def read_rollup(spark: SparkSession, sold: str) -> DataFrame:
    """The partial aggregates of ``sold``, see ``sold_partials``.  Raises while they are behind."""
    rollup = rollup_of(spark, sold)
    if rollup is None:
        raise LookupError(f"{sold} has no rollup")
    if _behind(spark, rollup)[0]:
        raise RuntimeError(f"{rollup} is behind {sold}; see repair_rollup")
    return spark.table(rollup)
