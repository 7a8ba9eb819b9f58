"""Raw pages in one scan: typed columns, all other fields as a VARIANT, and bad pages told apart.

A page is parsed once, to a VARIANT, so no pass over the pages is needed to find a schema, and a shop
that adds a field or nests one deeper changes nothing here.  A page that cannot be read does not stop
the others: it is a row with a reason.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.schemas import OTHER, PRODUCT, SNAPSHOT_PARTITIONS
from shelfmark.sources.files import empty_files, exists

# <store>/<year>/<month>/<day>/<page>, plain or as key=value folders, numbers padded or not.
_DROP = r"/(?:store=)?([^/=]+)/(?:year=)?(\d{4})/(?:month=)?(\d{1,2})/(?:day=)?(\d{1,2})/[^/]+$"

NOT_JSON, NO_LIST, NO_OBJECT = "not JSON", "no list of products", "a listing is not an object"


def scan_pages(spark: SparkSession, paths: str | list[str], multi_line: bool = True, glob: str = "*.json") -> DataFrame:
    """``file``, ``store``, ``ingestion_date`` (from the path, NULL if it names none) and ``text`` of each page.

    With ``multi_line`` a file is one page, an empty one too; else every line that is not blank is one.
    """
    if multi_line:
        blank = empty_files(spark, paths, glob)
        files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(paths)
        pages = files.select(F.col("path").alias("file"), F.col("content").cast("string").alias("text"))
        if blank:
            pages = pages.unionByName(spark.createDataFrame([(file, "") for file in blank], "file string, text string"))
    else:
        lines = spark.read.option("pathGlobFilter", glob).text(paths)
        pages = lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text")).where(F.trim("text") != "")
    plain = F.url_decode(F.replace(F.col("file"), F.lit("+"), F.lit("%2B")))
    pages = pages.select(plain.alias("file"), F.ltrim(F.col("text"), F.lit("\ufeff")).alias("text"))
    part = [F.regexp_extract("file", _DROP, i) for i in range(1, 5)]
    day = F.make_date(*(p.try_cast("int") for p in part[1:]))
    return pages.select(
        "file", F.nullif(part[0], F.lit("")).alias("store"), F.date_format(day, "yyyy-MM-dd").alias("ingestion_date"), "text"
    )


def parse_pages(pages: DataFrame) -> DataFrame:
    """Adds ``listings`` (array of VARIANT) and ``reason``: NULL, or why the page is bad."""
    page = F.try_parse_json("text")
    read = pages.withColumn("_page", page)
    read = read.withColumn("listings", F.try_variant_get("_page", "$.products", "array<variant>"))
    odd = F.exists("listings", lambda p: p.isNull() | F.try_variant_get(p, "$", "map<string,variant>").isNull())
    reason = F.when(F.col("_page").isNull(), NOT_JSON).when(F.col("listings").isNull(), NO_LIST).when(odd, NO_OBJECT)
    return read.withColumn("reason", reason).drop("_page")


def _other(listing: Column, typed: list[str]) -> Column:
    fields = F.try_variant_get(listing, "$", "map<string,variant>")
    rest = F.map_filter(fields, lambda name, _: ~name.isin(typed))
    return F.when(F.size(rest) > 0, F.to_variant_object(rest))


def explode_listings(parsed: DataFrame, schema: T.StructType = PRODUCT, other: str | None = OTHER) -> DataFrame:
    """One row per listing of the good pages: the columns of ``schema``, and ``other`` with all else.

    A value that does not fit its column's type is NULL there.  Arrays and objects may hold more than
    their column has, so they are in ``other`` too, whole; a listing without anything else has NULL.
    """
    rows = parsed.where(F.col("reason").isNull()).select("store", "ingestion_date", F.explode("listings").alias("_listing"))
    columns = [F.try_variant_get("_listing", f"$['{f.name}']", f.dataType.simpleString()).alias(f.name) for f in schema.fields]
    plain = [f.name for f in schema.fields if not isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))]
    if other is not None:
        columns.append(_other(F.col("_listing"), plain).alias(other))
    return rows.select(*SNAPSHOT_PARTITIONS, *columns)


def read_pages(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType = PRODUCT,
    other: str | None = OTHER,
    multi_line: bool = True,
    glob: str = "*.json",
) -> DataFrame:
    """Listings of all good pages, in one scan of the files; see ``explode_listings``.

    Bad pages are left out: ``bad_pages`` has them.
    """
    return explode_listings(parse_pages(scan_pages(spark, paths, multi_line, glob)), schema, other)


def bad_pages(spark: SparkSession, paths: str | list[str], multi_line: bool = True, glob: str = "*.json") -> DataFrame:
    """``store``, ``ingestion_date``, ``file``, ``reason`` and ``text`` of the pages that cannot be read."""
    parsed = parse_pages(scan_pages(spark, paths, multi_line, glob))
    return parsed.where(F.col("reason").isNotNull()).select(*SNAPSHOT_PARTITIONS, "file", "reason", "text")


def page_counts(spark: SparkSession, paths: str | list[str], multi_line: bool = True, glob: str = "*.json") -> DataFrame:
    """Pages, bad pages and listings of the good ones, per (store, ingestion_date)."""
    parsed = parse_pages(scan_pages(spark, paths, multi_line, glob))
    listings = F.when(F.col("reason").isNull(), F.size("listings")).otherwise(0)
    return parsed.groupBy(*SNAPSHOT_PARTITIONS).agg(
        F.count(F.lit(1)).alias("pages"), F.count("reason").alias("bad"), F.sum(listings).cast("long").alias("listings")
    )


# ---------------------------------------------------------------- pages put aside


def quarantine(bad: DataFrame, root: str) -> None:
    """Keep bad pages with their text below ``root``; the (store, day) partitions among them are replaced."""
    rows = bad.repartition(*SNAPSHOT_PARTITIONS, F.pmod(F.xxhash64("file", "text"), F.lit(16)))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*SNAPSHOT_PARTITIONS).parquet(root)


def quarantined(spark: SparkSession, root: str) -> DataFrame:
    """Pages put aside: ``file``, ``reason``, ``text``, ``store``, ``ingestion_date``.  None if there is no folder yet."""
    schema = "file string, reason string, text string, store string, ingestion_date string"
    return spark.read.schema(schema).parquet(root) if exists(spark, root) else spark.createDataFrame([], schema)


def release(spark: SparkSession, root: str, drops: Iterable[tuple[str, str]]) -> list[tuple[str, str]]:
    """Empty the quarantine of drops that have been read since; returns those that were in it."""
    held = quarantined(spark, root)
    key = F.concat_ws("/", *SNAPSHOT_PARTITIONS)
    found = held.where(key.isin([f"{s}/{d}" for s, d in drops])).select(*SNAPSHOT_PARTITIONS).distinct().collect()
    empty = spark.createDataFrame([], held.drop(*SNAPSHOT_PARTITIONS).schema)
    for store, day in found:
        empty.write.mode("overwrite").parquet(f"{root.rstrip('/')}/store={store}/ingestion_date={day}")
    return sorted((r["store"], r["ingestion_date"]) for r in found)


# ---------------------------------------------------------------- fields of the VARIANT


def other_fields(df: DataFrame, column: str = OTHER) -> list[tuple[str, str]]:
    """(dotted name, type) of every field the VARIANT column holds, from one pass over that column.

    Objects are followed, arrays are not; a field seen with types that have nothing in common is a
    ``variant``.
    """
    shape = df.agg(F.schema_of_variant_agg(column).alias("shape")).first()["shape"]
    if shape in (None, "VOID"):
        return []
    fields: list[tuple[str, str]] = []

    def walk(kind: T.DataType, path: str) -> None:
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                walk(f.dataType, f"{path}.{f.name}" if path else f.name)
        else:
            fields.append((path, kind.simpleString()))

    empty = df.sparkSession.createDataFrame([], f"v {shape.replace('OBJECT<', 'STRUCT<')}")
    walk(empty.schema["v"].dataType, "")
    return fields


def lift_fields(df: DataFrame, fields: Iterable[tuple[str, str]], column: str = OTHER) -> DataFrame:
    """Add the named fields of the VARIANT column as typed columns; absent or unfitting values are NULL."""

    def path(name: str) -> str:
        return "$" + "".join(f"['{part}']" for part in name.split("."))

    return df.withColumns({name: F.try_variant_get(column, path(name), kind) for name, kind in fields})
