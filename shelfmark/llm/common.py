"""Shared pieces of the corpus operators."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.session import ensure_checkpoint_dir

# ASCII white space; a word is a maximal run of anything else.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, a null read as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def word_count(column: str = "text") -> Column:
    return F.when(F.col(column).isNull(), 0).otherwise(F.regexp_count(F.col(column), F.lit(WORD))).cast("long")


def id_text(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def position52(*parts: Column) -> Column:
    """52 bits of an MD5 as a number; any SQL engine can compute the same."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("long")


def cut(df: DataFrame) -> DataFrame:
    """Materialise a narrow intermediate in the shared checkpoint folder and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def small(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows (counted), else as it is."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def number_repeated(rows: DataFrame, key: list[str], tell: list[str], above: int = 1, max_keys: int = 100_000) -> DataFrame:
    """``number`` for rows whose ``key`` more than ``above`` rows share, null for the others.

    Counts from 0 among the rows that agree in ``key`` and ``tell``; which of them gets which number is
    open.  A key with a large share of the rows is numbered task by task: each counts its own rows and
    starts where those before it end.  Without such keys the rows come back as they are.
    """
    shared = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > above)
    shared = cut(shared.select(*[F.col(c).alias(f"__{c}") for c in key]))
    if shared.isEmpty():
        return rows.withColumn("number", F.lit(None).cast("long"))
    hint = small(shared, max_keys)
    same = functools.reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in key])
    single = rows.join(hint, same, "left_anti").withColumn("number", F.lit(None).cast("long"))
    several = cut(rows.join(hint, same, "left_semi")).withColumn("__task", F.spark_partition_id())
    group = key + tell
    counts = several.groupBy(*group, "__task").agg(F.count(F.lit(1)).alias("n"))
    until = F.sum("n").over(Window.partitionBy(*group).orderBy("__task"))
    starts = counts.select(*[F.col(c).alias(f"__{c}") for c in group], F.col("__task").alias("__t"), (until - F.col("n")).alias("__start"))
    within = F.row_number().over(Window.partitionBy(*group, "__task").orderBy(*key)) - 1
    own = functools.reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in group], F.col("__task") == F.col("__t"))
    numbered = several.withColumn("__within", within).join(starts, own)
    return single.unionByName(numbered.select(*rows.columns, (F.col("__start") + F.col("__within")).cast("long").alias("number")))


def search(bounds: list[int], value: Column) -> Column:
    """How many of the sorted ``bounds`` are at most ``value``: a binary search without a UDF."""
    size = 1
    while size <= len(bounds):
        size *= 2
    padded = list(bounds) + [None] * (size - len(bounds))
    array = F.array(*[F.lit(b).cast("long") for b in padded])
    at: Column = F.lit(0)
    steps = []
    while size > 1:
        size //= 2
        steps.append(size)

    def step(low: Column, width: Column) -> Column:
        reached = F.element_at(array, (low + width).cast("int")) <= value
        return F.when(reached, low + width).otherwise(low)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), at, step) if steps else at


def per_batch(function: Callable, *args) -> Callable:
    """Bind arguments to a ``mapInArrow`` function."""
    return functools.partial(function, *args)
