"""Few large files instead of many small ones, partition by partition."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfmark.sources import tables

TARGET_BYTES = 128 * 1024 * 1024
FILES_PER_JOB = 10_000


@dataclass
class Compacted:
    """What ``compact`` did: partitions and rows written anew, files before and after."""

    partitions: int = 0
    rows: int = 0
    files_before: int = 0
    files_after: int = 0


def file_sizes(spark: SparkSession, name: str) -> DataFrame:
    """Every data file of a table: its partition columns, ``file``, ``bytes`` and ``rows``.  Reads footers only."""
    keys = tables.partition_columns(spark, name)
    files = spark.table(name).groupBy(*keys, F.col("_metadata.file_path").alias("file"))
    return files.agg(F.max("_metadata.file_size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def _fragmented(spark: SparkSession, name: str, target_bytes: int) -> DataFrame:
    """Partitions whose files hold less than half the target on average, and how many files they need."""
    keys = tables.partition_columns(spark, name)
    sums = file_sizes(spark, name).dropna(subset=keys).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")
    )
    needed = sums.withColumn("needed", F.ceil(F.col("bytes") / target_bytes).cast("int"))
    return needed.where((F.col("files") > 1) & (F.col("bytes") / F.col("files") < target_bytes / 2) & (F.col("needed") < F.col("files")))


def _batches(found: Iterable, size: int) -> Iterator[list]:
    """Partitions in groups that need about ``size`` files together."""
    batch: list = []
    files = 0
    for r in found:
        if batch and files + r["needed"] > size:
            yield batch
            batch, files = [], 0
        batch.append(r)
        files += r["needed"]
    if batch:
        yield batch


def compact(
    spark: SparkSession,
    name: str,
    target_bytes: int = TARGET_BYTES,
    order_by: Iterable[str] = ("vendor",),
    files_per_job: int = FILES_PER_JOB,
) -> Compacted:
    """Write partitions of many small files anew, in files of about ``target_bytes``; rows stay the same.

    A partition is chosen if its files hold less than half the target on average; files of those written
    hold about the target, or at least half of it, so repeating the call does nothing.  Rows are dealt to
    files whatever their values, one task a file, and sorted by ``order_by`` within it, so a hot vendor
    makes no large file.  Old files stay readable until a job commits; a job that dies can be repeated.
    Rows are counted before, while written and after; a difference raises.  The driver fetches one row per
    partition chosen.  Bucketed tables keep their files, one a bucket.
    """
    if tables._buckets(spark, name)[0]:
        raise ValueError(f"{name} is bucketed: its files follow from its buckets")
    keys = tables.partition_columns(spark, name)
    done = Compacted()
    for batch in _batches(_fragmented(spark, name, target_bytes).orderBy(*keys).collect(), files_per_job):
        placed, total = [], 0
        for r in batch:
            placed.append((*[r[k] for k in keys], total, r["needed"]))
            total += r["needed"]
        table = spark.table(name)
        own = ", ".join(f"`__{k}` {table.schema[k].dataType.simpleString()}" for k in keys)
        plan = spark.createDataFrame(placed, f"{own}, `__first` int, `__needed` int")
        chosen = table
        for k in keys:
            chosen = chosen.where(F.col(k).isin(sorted({r[k] for r in batch})))
        same = [F.col(k) == F.col(f"__{k}") for k in keys]
        dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("__needed"))
        rows = chosen.join(F.broadcast(plan), same).withColumn("__file", (F.col("__first") + dealt).cast("int"))
        rows = rows.repartitionById(total, F.col("__file"))
        rows = rows.sortWithinPartitions(*keys, *[F.asc_nulls_last(c) for c in order_by if c in table.columns]).select(*table.columns)
        seen = Observation()
        with tables._dynamic_overwrite(spark):
            rows.observe(seen, F.count(F.lit(1)).alias("written")).write.mode("overwrite").insertInto(name)
        before = sum(r["rows"] for r in batch)
        after = file_sizes(spark, name).join(F.broadcast(plan), same)
        found = after.agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files")).first()
        if not before == seen.get["written"] == found["rows"]:
            raise RuntimeError(f"{name}: {before} rows, wrote {seen.get['written']}, found {found['rows']}")
        done.partitions += len(batch)
        done.rows += before
        done.files_before += sum(r["files"] for r in batch)
        done.files_after += found["files"]
    return done
