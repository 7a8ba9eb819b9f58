"""Row-level points of the dot plots, and categories ranked by frequency."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.session import ensure_checkpoint_dir

def _rank_sorted(df: DataFrame, *order) -> DataFrame:
    """Number the rows 1..n in the given order without moving them into one partition.

    Sorted rows are materialised, so their partitions stay as they are; each partition then
    starts at the number of rows before it (one small row per partition).
    """
    rows = df.orderBy(*order).checkpoint()
    rows = rows.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_pos"))
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_pos").alias("_start"))
    running = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = sizes.select("_part", "_start", (F.sum("_n").over(running) - F.col("_n")).alias("_before"))
    ranked = rows.join(F.broadcast(sizes), "_part")
    rank = (F.col("_pos") - F.col("_start") + F.col("_before") + 1).cast("bigint")
    return ranked.withColumn("rank", rank).drop("_part", "_pos", "_n", "_start", "_before")


def ordered_category(df: DataFrame, column: str) -> DataFrame:
    """Each value of ``column`` with its row count and rank, 1 for the most frequent.

    Ties are ranked by value.  The counts are sorted when this is called, in as many tasks as the
    sort needs, and kept in the checkpoint folder.
    """
    ensure_checkpoint_dir(df.sparkSession)
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return _rank_sorted(counts, F.desc("count"), F.asc(column))


def points(df: DataFrame, category: str, value: str = "price", order_by_count: bool = False) -> DataFrame:
    """(category, value) of every row with a category; with the category's rank on request.

    How the ranks are joined is left to Spark, which splits skewed partitions at run time.
    """
    rows = df.where(F.col(category).isNotNull()).select(category, value)
    if not order_by_count:
        return rows
    ranks = ordered_category(df, category).select(category, "rank")
    return rows.join(ranks, category).select(category, value, "rank")


def price_vs_type_points(df: DataFrame) -> DataFrame:
    """Price of every sale by product type, with the type's frequency rank."""
    return points(df, "product_type", order_by_count=True)


def price_vs_condition_points(df: DataFrame) -> DataFrame:
    """Price of every sale by condition."""
    return points(df, "condition")
