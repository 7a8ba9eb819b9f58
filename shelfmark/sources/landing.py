"""From raw JSON pages to the columnar base snapshot of a day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.schemas import PRODUCT, SNAPSHOT_PARTITIONS, page_schema

# <root>/<store>/<year>/<month>/<day>/<page>.json, month and day unpadded.
VENDOR_PARTS = 16
_PAGE_PATH = r"/([^/]+)/(\d{4})/(\d{1,2})/(\d{1,2})/[^/]+$"


def day_path(store: str, day: str | dt.date) -> str:
    """``<store>/<year>/<month>/<day>`` with unpadded numbers, for reader paths."""
    if isinstance(day, str):
        day = dt.date.fromisoformat(day)
    return f"{store}/{day.year}/{day.month}/{day.day}"


def day_path_column(store: Column | str, day: Column | str) -> Column:
    """The same path as a Column."""
    store = F.col(store) if isinstance(store, str) else store
    day = F.col(day) if isinstance(day, str) else day
    return F.concat_ws("/", store, F.year(day), F.month(day), F.dayofmonth(day))


def _page_reader(spark: SparkSession, schema: T.StructType | None, multi_line: bool):
    reader = (
        spark.read.option("multiLine", multi_line)
        .option("pathGlobFilter", "*.json")
        .option("mode", "FAILFAST")
    )
    return reader.schema(page_schema(schema)) if schema is not None else reader


def _listings(pages: DataFrame, *keep: Column) -> DataFrame:
    products = F.when(
        F.col("products").isNull(), F.raise_error(F.lit("page without a products list"))
    ).otherwise(F.col("products"))
    return pages.select(*keep, F.inline(products))


def _page_folders(spark: SparkSession, paths: str | list[str], glob: str = "*.json") -> set[str]:
    """Folders that hold pages: a job over the file names, of which one row per folder is fetched."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(paths)
    folder = F.regexp_extract("path", r"^(.*)/[^/]+$", 1)
    return {unquote(r["folder"]) for r in files.select(folder.alias("folder")).distinct().collect()}


def require_folders(spark: SparkSession, paths: str | list[str], folders: list[str], glob: str = "*.json") -> None:
    """Raise unless every folder (the end of a path) holds a page."""
    found = _page_folders(spark, paths, glob)
    missing = [f for f in folders if not any(name.endswith("/" + f) for name in found)]
    if missing or not found:
        raise FileNotFoundError(f"no JSON pages in {missing or 'the given path'}")


def _merged(needed: T.DataType, found: T.DataType) -> T.DataType:
    """Needed fields first and of the type they need, then all others that were found."""
    if isinstance(needed, T.StructType) and isinstance(found, T.StructType):
        others = {f.name: f.dataType for f in found.fields}
        fields = [T.StructField(f.name, _merged(f.dataType, others.pop(f.name, f.dataType))) for f in needed.fields]
        return T.StructType(fields + [T.StructField(n, t) for n, t in others.items()])
    if isinstance(needed, T.ArrayType) and isinstance(found, T.ArrayType):
        return T.ArrayType(_merged(needed.elementType, found.elementType))
    return needed


def listing_schema(spark: SparkSession, paths: str | list[str], multi_line: bool = True) -> T.StructType:
    """Every field of the listings in the pages, with the columns of ``PRODUCT`` in any case."""
    pages = _page_reader(spark, None, multi_line).json(paths).schema
    found = pages["products"].dataType if "products" in pages.names else None
    listing = found.elementType if isinstance(found, T.ArrayType) else None
    return _merged(PRODUCT, listing)


def unread_fields(spark: SparkSession, paths: str | list[str], schema: T.StructType, multi_line: bool = True) -> list[str]:
    """Dotted names of the fields that the pages have and reading them with ``schema`` leaves out."""

    def names(kind: T.DataType, path: str) -> list[str]:
        if isinstance(kind, T.ArrayType):
            return names(kind.elementType, path)
        if isinstance(kind, T.StructType):
            return [n for f in kind.fields for n in names(f.dataType, f"{path}.{f.name}" if path else f.name)]
        return [path]

    known = set(names(schema, ""))
    return [n for n in names(listing_schema(spark, paths, multi_line), "") if n not in known]


def read_raw_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Listings of all ``*.json`` pages in a folder, one row each, with every field they have.

    The fields are found by a pass over the pages; columns of ``PRODUCT`` that none has are NULL.
    A ``schema`` of one listing saves that pass and leaves out what it does not name, which
    ``unread_fields`` lists.  ``multi_line=False`` reads one page per line, which lets Spark
    split large files.  Malformed pages fail the job and a folder without pages raises.
    """
    require_folders(spark, path, [])
    schema = schema or listing_schema(spark, path, multi_line)
    return _listings(_page_reader(spark, schema, multi_line).json(path))


def read_raw_days(
    spark: SparkSession,
    root: str,
    drops: Iterable[tuple[str, str]],
    schema: T.StructType | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Listings of many (store, day) drops in one scan, with ``store`` and ``ingestion_date``.

    Both columns come from the file path, so a backfill of many days is a single job.
    """
    folders = [day_path(store, day) for store, day in drops]
    paths = [f"{root.rstrip('/')}/{f}" for f in folders]
    require_folders(spark, paths, folders)
    schema = schema or listing_schema(spark, paths, multi_line)
    pages = _page_reader(spark, schema, multi_line).json(paths)
    file = F.col("_metadata.file_path")
    part = [F.regexp_extract(file, _PAGE_PATH, i) for i in range(1, 5)]
    day = F.make_date(*(p.cast("int") for p in part[1:]))
    return _listings(
        pages, part[0].alias("store"), F.date_format(day, "yyyy-MM-dd").alias("ingestion_date")
    )


def landed_stores(spark: SparkSession, root: str, day: str, stores: Iterable[str]) -> list[str]:
    """The shops that have JSON pages for the day.  Lists files, reads none."""
    names = list(stores)
    folders = f"{root.rstrip('/')}/" + day_path("{" + ",".join(names) + "}", day)
    try:
        found = _page_folders(spark, folders)
    except AnalysisException:
        return []
    return [s for s in names if any(folder.endswith("/" + day_path(s, day)) for folder in found)]


def flatten_nested(df: DataFrame, sep: str = ".") -> DataFrame:
    """Lift fields of nested structs to the top level as ``a<sep>b``; arrays stay as they are."""

    def leaves(schema: T.StructType, path: tuple[str, ...]) -> list[tuple[str, ...]]:
        out = []
        for f in schema.fields:
            here = (*path, f.name)
            out += leaves(f.dataType, here) if isinstance(f.dataType, T.StructType) else [here]
        return out

    def quoted(path: tuple[str, ...]) -> str:
        return ".".join("`" + name.replace("`", "``") + "`" for name in path)

    paths = leaves(df.schema, ())
    names = [sep.join(p) for p in paths]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"columns that flattening would make twice: {twice}")
    return df.select([F.col(quoted(p)).alias(n) for p, n in zip(paths, names)])


def concat_pages(pages: list[DataFrame]) -> DataFrame:
    """Stack frames by column name; a column missing in one becomes NULL there."""
    if not pages:
        raise ValueError("no pages to concatenate")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pages)


def cluster_by_vendor(df: DataFrame, column: str = "vendor", by: tuple[str, ...] = ()) -> DataFrame:
    """Order rows by vendor, NULLs last, so row groups cover narrow vendor ranges.

    Rows are dealt by vendor and one of ``VENDOR_PARTS`` numbers from a row hash: a vendor holding
    a third of the rows is spread over many partitions instead of filling one, and the input is
    read once.  ``by`` puts partition columns in front when several days are written at once.
    """
    lead = [F.asc(c) for c in by] + [F.asc_nulls_last(column)]
    hashed = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in hashed]), F.lit(VENDOR_PARTS))
    return df.repartition(*by, column, part).sortWithinPartitions(*lead)


def write_base_parquet(
    df: DataFrame, root: str, max_records_per_file: int = 5_000_000
) -> None:
    """Write base snapshots below ``root``, partitioned by store and day.

    Only the (store, day) partitions present in ``df`` are replaced, so rerunning a day
    leaves one copy of it.  Files are ordered by vendor, NULLs last, without a shuffle: the
    writer sorts each task's rows by partition anyway.
    """
    (
        df.sortWithinPartitions(*SNAPSHOT_PARTITIONS, F.asc_nulls_last("vendor"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*SNAPSHOT_PARTITIONS)
        .parquet(root)
    )


def _base_dir(root: str, store: str, day: str) -> str:
    return f"{root.rstrip('/')}/store={store}/ingestion_date={day}"


def purge_base_day(spark: SparkSession, root: str, store: str, day: str) -> bool:
    """Empty one (store, day) base snapshot; other days, also ``day`` + digits, stay.

    False if the day was never written.
    """
    path = _base_dir(root, store, day)
    try:
        schema = spark.read.parquet(path).schema
    except AnalysisException:
        return False
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
    return True


def read_base_parquet(spark: SparkSession, root: str, store: str, day: str) -> DataFrame:
    """All files of one (store, day) base snapshot."""
    return spark.read.parquet(_base_dir(root, store, day))


def stamp_ingestion_date(df: DataFrame, day: str) -> DataFrame:
    """Add the constant run date."""
    return df.withColumn("ingestion_date", F.lit(day))


def read_base_days(spark: SparkSession, root: str, drops: Iterable[tuple[str, str]]) -> DataFrame:
    """Base snapshots of many drops, with ``store`` and ``ingestion_date`` as text."""
    paths = [_base_dir(root, store, day) for store, day in drops]
    base = spark.read.option("basePath", root).option("mergeSchema", True).parquet(*paths)
    return base.withColumns({c: F.col(c).cast("string") for c in SNAPSHOT_PARTITIONS})
