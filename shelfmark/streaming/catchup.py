"""Catch-up landing: which drops have new pages since the last run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.sources.landing import _PAGE_PATH


def catch_up(
    spark: SparkSession,
    raw_root: str,
    state_dir: str,
    land: Callable[[list[tuple[str, str]]], object],
) -> None:
    """Call ``land`` with the (store, day) drops that received pages since the last call.

    A file-source stream with an available-now trigger remembers in ``state_dir`` (a shared
    folder) which pages were seen.  It only detects the drops; ``land`` reads a drop whole
    and replaces it, so late pages, repeated batches and retries give the same table as
    landing each drop once.  One (store, day) pair per touched drop reaches the driver.
    """

    def on_batch(batch: DataFrame, _batch_id: int) -> None:
        part = [F.regexp_extract("file", _PAGE_PATH, i) for i in range(1, 5)]
        day = F.date_format(F.make_date(*(p.cast("int") for p in part[1:])), "yyyy-MM-dd")
        drops = batch.select(part[0].alias("store"), day.alias("day")).distinct()
        found = sorted((r["day"], r["store"]) for r in drops.collect())
        if found:
            land([(store, day) for day, store in found])

    # Only paths are selected, so page contents are not read here.
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    pages = (
        spark.readStream.format("binaryFile")
        .schema(schema)
        .option("pathGlobFilter", "*.json")
        .load(f"{raw_root.rstrip('/')}/*/*/*/*")
        .select(F.col("path").alias("file"))
    )
    query = (
        pages.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", state_dir)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
