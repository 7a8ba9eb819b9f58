"""Exact quartiles and box-plot figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.operators.ranks import values_at

QUARTILES = (0.25, 0.5, 0.75)

_BLOCK_BITS = 16


def _five_numbers(df: DataFrame, column: str) -> DataFrame:
    """One row: ``least`` and the exact quartiles ``q1``, ``q2``, ``q3`` of a numeric column.

    For integers of at most 32 bits this is one lazy plan; wider and fractional columns are
    searched by rounds when this is called.
    ``percentile`` keeps a counter per distinct value in one task.  To bound that, values
    are counted first, and blocks of 2^16 neighbouring values that hold none of the wanted
    ranks are then represented by one value each, which leaves every other rank as it was.
    At most 2^16 blocks and the values of six of them reach ``percentile``, whatever the
    number of rows or distinct values.
    """
    if not isinstance(df.schema[column].dataType, (T.ByteType, T.ShortType, T.IntegerType)):
        return _five_numbers_by_rounds(df, column)

    value = F.col(column).alias("value")
    counts = df.select(value).where(F.col("value").isNotNull()).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    block = F.shiftright("value", _BLOCK_BITS)

    # One row per block: at most 2^16 for 32-bit values, so ordering them in one task is safe.
    running = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    blocks = (
        counts.groupBy(block.alias("block"))
        .agg(F.sum("n").alias("n"))
        .select("block", (F.sum("n").over(running) - F.col("n")).alias("before"), F.sum("n").over(running).alias("upto"))
    )
    # The last running sum is the number of rows; ranks of the linear rule follow from it.
    spans = F.collect_list(F.struct("block", "before", "upto")).alias("spans")
    spans = blocks.agg(spans, F.max("upto").alias("rows"))
    at = F.transform(F.array(*[F.lit(p) for p in QUARTILES]), lambda p: p * (F.col("rows") - 1))

    def holds_rank(span: Column) -> Column:
        def inside(rank: Column) -> Column:
            return (rank >= span["before"]) & (rank < span["upto"])

        return F.exists(at, lambda r: inside(F.floor(r)) | inside(F.ceil(r)))

    chosen = spans.select(F.transform(F.filter("spans", holds_rank), lambda s: s["block"])).scalar()

    kept = F.when(F.array_contains(chosen, block), F.col("value")).otherwise(F.shiftleft(block, _BLOCK_BITS))
    quartile = F.percentile("kept", F.array(*[F.lit(p) for p in QUARTILES]), F.col("n"))
    stats = counts.select("value", "n", kept.alias("kept")).agg(F.min("value").alias("least"), quartile.alias("q"))
    return stats.select("least", *[F.col("q")[i].alias(f"q{i + 1}") for i in range(len(QUARTILES))])


def _five_numbers_by_rounds(df: DataFrame, column: str) -> DataFrame:
    """The same for 64-bit integers, decimals, floats and doubles; quartiles are doubles."""
    _, least, around = values_at(df, column, QUARTILES)

    def between(below, above, weight: float) -> float | None:
        return None if below is None else float(below) + (float(above) - float(below)) * weight

    kind = df.schema[column].dataType
    schema = T.StructType([T.StructField("least", T.DoubleType() if isinstance(kind, T.FloatType) else kind)])
    for i in range(len(QUARTILES)):
        schema.add(f"q{i + 1}", T.DoubleType())
    return df.sparkSession.createDataFrame([(least, *[between(*a) for a in around])], schema)


def quartiles(df: DataFrame, column: str) -> DataFrame:
    """``q1``, ``median``, ``q3`` of a numeric column, exact and linearly interpolated.

    NULL and NaN do not count.
    """
    return _five_numbers(df, column).select("q1", F.col("q2").alias("median"), "q3")


def box_stats(df: DataFrame, column: str) -> DataFrame:
    """One row of box-plot figures; all NULL when no row has a value.

    ``box_min`` and ``box_max`` are the 1.5·IQR limits, with the column minimum in place of
    a negative lower limit.  ``lower_fence`` is the limit before that replacement.
    """
    stats = _five_numbers(df, column)
    iqr = F.col("q3") - F.col("q1")
    fence = F.col("q1") - F.lit(1.5) * iqr
    return stats.select(
        F.when(fence < 0, F.col("least").cast("double")).otherwise(fence).alias("box_min"),
        "q1",
        F.col("q2").alias("median"),
        "q3",
        (F.col("q3") + F.lit(1.5) * iqr).alias("box_max"),
        iqr.alias("iqr"),
        fence.alias("lower_fence"),
    )


def box_outliers(df: DataFrame, column: str, stats: DataFrame | None = None) -> DataFrame:
    """Rows beyond the 1.5·IQR fences, the points a box plot draws singly.

    ``stats`` takes the row of ``box_stats`` over the same rows if it is there already.
    """
    stats = box_stats(df, column) if stats is None else stats
    fences = stats.select(F.struct("lower_fence", F.col("box_max").alias("upper_fence")).alias("fences")).scalar()
    value = F.col(column)
    return df.where((value < fences["lower_fence"]) | (value > fences["upper_fence"]))
