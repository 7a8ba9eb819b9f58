"""Exact values at given ranks of any ordered numeric column, by rounds that narrow an interval.

A round asks ``percentile_approx`` for a value surely below and one surely above each wanted rank, and
counts the rows around them.  What is left between the two is a thousandth of the rows, or the rank
lies among equal values at one end and is found.  Where that does not get ahead, because the sketch's
doubles cannot tell the values apart, a value of the column splits them instead.  No task ever holds more values than the sketch of
``percentile_approx`` or the few that are left at the end, however many rows or distinct values there are.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ACCURACY = 10_000
LEFT = 1_000  # values that are sorted at the end, for each wanted rank

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


@dataclass
class _Search:
    """Rank ``rank`` of all values is number ``rank - before`` of the ``inside`` ones between the limits."""

    rank: int
    before: int
    inside: int
    low: Any = None  # exclusive; None: open
    high: Any = None
    value: Any = None
    found: bool = False
    kind: str = "double"
    stuck: bool = False  # the last round did not get ahead

    def literal(self, value: Any) -> Column:
        """Of the column's own type: a comparison then changes neither side."""
        return F.lit(value).cast(self.kind)

    def holds(self, value: Column) -> Column:
        within = F.lit(True)
        if self.low is not None:
            within = within & (value > self.literal(self.low))
        if self.high is not None:
            within = within & (value < self.literal(self.high))
        return within

    def take(self, value: Any) -> None:
        self.value, self.found = value, True


def _values(df: DataFrame, column: str) -> DataFrame:
    kind = df.schema[column].dataType
    if not isinstance(kind, NUMERIC):
        raise TypeError(f"{column} must be numeric, not {kind.simpleString()}")
    value = F.col(f"`{column}`")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        value = F.nanvl(value.cast("double"), F.lit(None))
    return df.select(value.alias("value")).where(F.col("value").isNotNull())


def _around(search: _Search) -> list[float]:
    """Shares of the inside rows that lie surely below and above the rank."""
    at = (search.rank - search.before + 0.5) / search.inside
    return [max(0.0, at - 2 / ACCURACY), min(1.0, at + 2 / ACCURACY)]


def _narrow(rows: DataFrame, searches: list[_Search]) -> None:
    """One round for all searches: two passes over the rows, one row fetched from each."""
    value = F.col("value")

    def bounds(s: _Search) -> Column:
        inside = F.when(s.holds(value), value)
        if s.stuck:
            # The sketch computes in doubles; values closer than these tell apart are halved by one of them.
            pivot = F.min(F.when(s.holds(value), F.struct(F.xxhash64(value).alias("hash"), value)))["value"]
            return F.array(pivot, pivot)
        return F.percentile_approx(inside, F.array(*[F.lit(p) for p in _around(s)]), ACCURACY)

    ends = rows.agg(*[bounds(s).alias(f"b{i}") for i, s in enumerate(searches)]).first()
    counts = []
    for i, s in enumerate(searches):
        low, high = (s.literal(end) for end in ends[f"b{i}"])
        counts += [
            F.count_if(s.holds(value) & (value < low)).alias(f"below{i}"),
            F.count_if(value == low).alias(f"low{i}"),
            F.count_if((value > low) & (value < high)).alias(f"inner{i}"),
            F.count_if(value == high).alias(f"high{i}"),
        ]
    found = rows.agg(*counts).first()
    for i, s in enumerate(searches):
        low, high = ends[f"b{i}"]
        before = s.inside
        start = s.before + found[f"below{i}"]
        inner = start + found[f"low{i}"]
        end = inner if low == high else inner + found[f"inner{i}"] + found[f"high{i}"]
        if s.rank < start:  # beyond the sketch's promise; the interval still shrinks from above
            s.high, s.inside = low, start - s.before
        elif s.rank < inner:
            s.take(low)
        elif s.rank >= end:  # beyond it on the other side
            s.low, s.inside, s.before = high, s.before + s.inside - end, end
        elif s.rank >= inner + found[f"inner{i}"]:
            s.take(high)
        else:
            s.low, s.high, s.before, s.inside = low, high, inner, found[f"inner{i}"]
        s.stuck = not s.found and s.inside == before


def values_at(df: DataFrame, column: str, shares: tuple[float, ...]) -> tuple[int, Any, list[tuple[Any, Any, float]]]:
    """(rows with a value, least value, per share (value below, value above, weight of the latter)).

    Shares are those of the linear rule: position ``share * (rows - 1)``.  NULL and NaN are no values.
    Runs jobs when called: one, and for each thousandfold of a thousand rows another two.
    """
    rows = _values(df, column)
    total, least = rows.agg(F.count(F.lit(1)), F.min("value")).first()
    if not total:
        return 0, None, [(None, None, 0.0)] * len(shares)
    positions = [share * (total - 1) for share in shares]
    wanted = sorted({r for p in positions for r in (int(p), min(int(p) + 1, total - 1))})
    kind = rows.schema["value"].dataType.simpleString()
    searches = [_Search(r, 0, total, kind=kind) for r in wanted]
    while open_ := [s for s in searches if not s.found and s.inside > LEFT]:
        _narrow(rows, open_)
    last = [s for s in searches if not s.found]
    if last:
        lists = [F.sort_array(F.collect_list(F.when(s.holds(F.col("value")), F.col("value")))).alias(f"v{i}") for i, s in enumerate(last)]
        left = rows.agg(*lists).first()
        for i, s in enumerate(last):
            s.take(left[f"v{i}"][s.rank - s.before])
    at = {s.rank: s.value for s in searches}
    return total, least, [(at[int(p)], at[min(int(p) + 1, total - 1)], p - int(p)) for p in positions]
