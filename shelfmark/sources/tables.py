"""Rerun-safe maintenance of partitioned Parquet tables in the session catalog.

Functions that change rows keep the table's rollup, if it has one, in step (see ``rollup``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.schemas import OTHER, SNAPSHOT_PARTITIONS, SOLD_PARTITIONS
from shelfmark.sources.files import exists, remove_folders

_ADDED = "shelfmark.added."  # table property: the day a column came
# Characters that Spark escapes in partition folder names, beside control characters.
_UNSAFE = "\"#%'*/:=?\\\x7f{[]^"


def _name(identifier: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in identifier.split("."))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@contextmanager
def _dynamic_overwrite(spark: SparkSession):
    """Overwrite only the partitions written.  Inserts read this from the session alone."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def ensure_table(
    spark: SparkSession,
    name: str,
    df: DataFrame,
    partitions: Iterable[str] = SNAPSHOT_PARTITIONS,
    path: str | None = None,
    buckets: int | None = None,
    bucket_by: Iterable[str] = ("id",),
) -> bool:
    """Create an empty table with the frame's columns unless it exists; True if created.

    Columns of later days are added by ``evolve_table`` or ``append_day(on_unknown="add")``.  With a
    ``path`` that already holds partitions (a new session over old data) they become visible, and so
    do columns that only those files have.

    ``buckets`` deals each partition's rows to that many files by ``bucket_by``; joins, windows and
    groupings on these columns then need no shuffle (see ``insert_bucketed``).
    """
    if spark.catalog.tableExists(name):
        return False
    partitions = list(partitions)
    columns = [f for f in df.schema.fields if f.name not in partitions]
    if path is not None:
        known = {f.name for f in df.schema.fields}
        columns += [f for f in _stored_schema(spark, path).fields if f.name not in known]
    columns += [df.schema[c] for c in partitions]
    ddl = T.StructType([T.StructField(f.name, f.dataType) for f in columns]).toDDL()
    keys = ", ".join(f"`{c}`" for c in partitions)
    location = "" if path is None else f" LOCATION {_text(path)}"
    dealt = ""
    if buckets:
        own = ", ".join(f"`{c}`" for c in bucket_by)
        dealt = f" CLUSTERED BY ({own}) INTO {int(buckets)} BUCKETS"
    spark.sql(f"CREATE TABLE {_name(name)} ({ddl}) USING parquet PARTITIONED BY ({keys}){dealt}{location}")
    if path is not None:
        # Appending no rows makes sure the folder is there to look into.
        df.limit(0).write.mode("append").partitionBy(*partitions).parquet(path)
        spark.catalog.recoverPartitions(name)
    return True


def _stored_schema(spark: SparkSession, path: str) -> T.StructType:
    """The columns of all files below a folder, merged; none if there are no files."""
    if not exists(spark, path):
        return T.StructType()
    try:
        return spark.read.option("mergeSchema", True).parquet(path).schema
    except AnalysisException:
        return T.StructType()


def evolve_table(spark: SparkSession, name: str, schema: T.StructType, seen_on: str | None = None) -> list[str]:
    """Add the columns of ``schema`` that the table lacks; returns their names.

    Rows written before read NULL there.  When a column came is kept with the table (``seen_on``, by
    default today), see ``schema_history``.  New fields inside a struct or an array of structs cannot
    be added to a Parquet table; ``append_day(on_unknown="other")`` keeps them in a VARIANT.
    """
    have = set(spark.table(name).columns)
    new = [f for f in schema.fields if f.name not in have]
    if not new:
        return []
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in new)
    spark.sql(f"ALTER TABLE {_name(name)} ADD COLUMNS ({ddl})")
    day = seen_on or dt.date.today().isoformat()
    marks = ", ".join(f"{_text(_ADDED + f.name)} = {_text(day)}" for f in new)
    spark.sql(f"ALTER TABLE {_name(name)} SET TBLPROPERTIES ({marks})")
    return [f.name for f in new]


def schema_history(spark: SparkSession, name: str) -> DataFrame:
    """``column``, ``type`` and ``added_on`` (NULL: there from the start) of every column."""
    marks = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {_name(name)}").collect()}
    rows = [(f.name, f.dataType.simpleString(), marks.get(_ADDED + f.name)) for f in spark.table(name).schema.fields]
    return spark.createDataFrame(rows, "column string, type string, added_on string")


def _unknown_fields(have: T.DataType, want: T.DataType) -> bool:
    """Whether ``have`` has a field, at any depth, that ``want`` lacks."""
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        return any(f.name not in want.names or _unknown_fields(f.dataType, want[f.name].dataType) for f in have.fields)
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return _unknown_fields(have.elementType, want.elementType)
    return False


def _known_part(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """``value`` without the fields, at any depth, that ``want`` lacks."""
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        kept = [f for f in have.fields if f.name in want.names]
        fields = [_known_part(value[f.name], f.dataType, want[f.name].dataType).alias(f.name) for f in kept]
        return F.when(value.isNotNull(), F.struct(*fields)) if fields else F.lit(None)
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType) and _unknown_fields(have, want):
        return F.transform(value, lambda x: _known_part(x, have.elementType, want.elementType))
    return value


def set_aside(df: DataFrame, schema: T.StructType, other: str = OTHER) -> DataFrame:
    """Move what a table of ``schema`` has no place for into the VARIANT column ``other``.

    A column the table lacks goes there whole, and so does one with a nested field the table lacks;
    the part of it that the table knows stays in its column too.  Rows keep what ``other`` held.
    """
    lacking = [c for c in df.columns if c not in schema.names and c != other]
    wider = [c for c in df.columns if c in schema.names and _unknown_fields(df.schema[c].dataType, schema[c].dataType)]
    if not lacking and not wider:
        return df
    moved = F.struct(*[F.col(f"`{c}`").alias(c) for c in lacking + wider])
    extra = F.try_variant_get(F.to_variant_object(moved), "$", "map<string,variant>")
    if other in df.columns:
        before = F.try_variant_get(F.col(other), "$", "map<string,variant>")
        empty = F.create_map().cast("map<string,variant>")
        before = F.map_filter(F.coalesce(before, empty), lambda k, _: ~k.isin(lacking + wider))
        extra = F.map_concat(before, extra)
    out = df.withColumn(other, F.to_variant_object(extra))
    for c in wider:
        out = out.withColumn(c, _known_part(F.col(f"`{c}`"), df.schema[c].dataType, schema[c].dataType))
    return out.drop(*[f"{c}" for c in lacking])


def _as_type(value: Column, have: T.DataType, want: T.DataType, path: str) -> Column:
    """``value`` with the fields of ``want``, matched by name at every depth."""
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        unknown = [f"{path}.{n}" for n in have.names if n not in want.names]
        if unknown:
            raise ValueError(f"fields not in the table: {unknown}")
        fields = [
            (_as_type(value[f.name], have[f.name].dataType, f.dataType, f"{path}.{f.name}") if f.name in have.names else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in want.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        if have.simpleString() == want.simpleString():
            return value
        return F.transform(value, lambda x: _as_type(x, have.elementType, want.elementType, path))
    return value.cast(want)


def align_to_table(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns in table order and type, fields of structs by name at every depth.

    Missing ones become NULL, unknown ones raise.
    """
    unknown = [c for c in df.columns if c not in schema.names]
    if unknown:
        raise ValueError(f"columns not in the table: {unknown}")

    def aligned(f: T.StructField) -> Column:
        if f.name not in df.columns:
            return F.lit(None).cast(f.dataType).alias(f.name)
        return _as_type(F.col(f"`{f.name}`"), df.schema[f.name].dataType, f.dataType, f.name).cast(f.dataType).alias(f.name)

    return df.select([aligned(f) for f in schema.fields])


def fit_to_table(spark: SparkSession, name: str, df: DataFrame, on_unknown: str = "raise", seen_on: str | None = None) -> DataFrame:
    """Rows in the table's layout, with unknown columns treated as ``on_unknown`` says.

    ``raise``: an error before anything is written.  ``add``: the table gets the new columns first;
    nested new fields still raise.  ``other``: what the table has no place for goes to its VARIANT
    column, which is added if need be, so no field is lost and none stops the run.
    """
    if on_unknown == "add":
        have = spark.table(name).schema
        align_to_table(df, T.StructType(have.fields + [f for f in df.schema.fields if f.name not in have.names]))  # raises first
        evolve_table(spark, name, df.schema, seen_on)
    elif on_unknown == "other":
        variant = T.StructType([T.StructField(OTHER, T.VariantType())])
        df = set_aside(df, spark.table(name).schema)
        if OTHER in df.columns:
            evolve_table(spark, name, variant, seen_on)
    elif on_unknown != "raise":
        raise ValueError(f"unknown choice {on_unknown!r}")
    return align_to_table(df, spark.table(name).schema)


def append_day(spark: SparkSession, name: str, df: DataFrame, on_unknown: str = "raise", seen_on: str | None = None) -> int:
    """Append rows and return how many were written, counted during the write.

    See ``fit_to_table`` for columns the table does not have.
    """
    from shelfmark.sources.rollup import in_step, rollup_of

    seen = Observation()
    rows = fit_to_table(spark, name, df, on_unknown, seen_on)
    count, own = _buckets(spark, name)
    rows = rows.repartition(count, *own) if count else rows
    metrics = [F.count(F.lit(1)).alias("written")]
    if rollup_of(spark, name):
        metrics.append(F.collect_set(F.struct(*partition_columns(spark, name))).alias("filled"))
    with in_step(spark, name) as touched:
        rows.observe(seen, *metrics).write.insertInto(name)
        touched.update(tuple(p) for p in seen.get.get("filled", ()))
    return seen.get["written"]


def delete_days(spark: SparkSession, name: str, drops: Iterable[tuple[str, str]], column: str = "ingestion_date") -> int:
    """Remove the given (store, day) partitions, any number of them in one catalog statement.

    Parquet tables take no DELETE; the catalog forgets the partitions, so no reader sees their rows
    any more, and their files go.  No job runs.  Safe to repeat.  Returns partitions removed.
    """
    return drop_partitions(spark, name, [{"store": store, column: day} for store, day in drops])


def delete_day(
    spark: SparkSession,
    name: str,
    day: str,
    stores: Iterable[str],
    column: str = "ingestion_date",
) -> None:
    """Remove the day's partition of each store."""
    delete_days(spark, name, [(store, day) for store in stores], column)


def _partition_spec(wanted: Iterable[dict[str, str]]) -> str:
    return ", ".join("PARTITION (" + ", ".join(f"`{c}` = {_text(v)}" for c, v in p.items()) + ")" for p in wanted)


def partition_values(spark: SparkSession, name: str) -> list[dict[str, str]]:
    """The partitions the catalog knows, one small row each; no file is listed or read."""
    rows = spark.sql(f"SHOW PARTITIONS {_name(name)}").collect()
    return [dict(part.split("=", 1) for part in unquote(r["partition"]).split("/")) for r in rows]


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_name(name)}").collect()}


def drop_partitions(spark: SparkSession, name: str, wanted: Iterable[dict[str, str]]) -> int:
    """Drop all partitions that agree with one of ``wanted`` (column to value), files included.

    One catalog statement whatever their number.  Files of an external table outlive their catalog
    entry; they are deleted after it, so a reader finds a partition whole or not at all, and repeating
    the call finishes what a crash left.  Returns partitions dropped.
    """
    from shelfmark.sources.rollup import in_step

    wanted = list(wanted)
    if not wanted:
        return 0
    gone = [p for p in partition_values(spark, name) if any(all(p.get(c) == v for c, v in w.items()) for w in wanted)]
    with in_step(spark, name, [tuple(p.values()) for p in gone]):
        _drop(spark, name, wanted, gone)
    return len(gone)


def _drop(spark: SparkSession, name: str, wanted: list[dict[str, str]], gone: list[dict[str, str]]) -> None:
    """Drop the partitions ``gone``, and the files of those in ``wanted`` that the catalog no longer knows."""
    columns = partition_columns(spark, name)
    if gone:
        spark.sql(f"ALTER TABLE {_name(name)} DROP IF EXISTS {_partition_spec(gone)}")
    about = _described(spark, name)
    if about.get("Type") == "EXTERNAL":
        whole = gone + [w for w in wanted if set(w) == set(columns) and w not in gone]
        remove_folders(spark, ["/".join([about["Location"], *[f"{c}={_escaped(p[c])}" for c in columns]]) for p in whole])


def _escaped(value: str) -> str:
    """A value as Spark writes it into a folder name."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or c in _UNSAFE else c for c in value)


def insert_bucketed(spark: SparkSession, name: str, df: DataFrame, replaced: Iterable[dict[str, str]]) -> int:
    """Overwrite partitions of a bucketed table, one file per bucket and partition.

    Rows are dealt by the bucket columns to as many tasks as there are buckets, so every task fills
    one bucket.  Partitions that ``replaced`` names and the rows do not fill are dropped.
    """
    from shelfmark.sources.rollup import in_step

    replaced = list(replaced)
    rows = align_to_table(df, spark.table(name).schema)
    count, columns = _buckets(spark, name)
    seen = Observation()
    partitions = list(partition_columns(spark, name))
    filled = F.collect_set(F.struct(*[F.col(c).cast("string").alias(c) for c in partitions]))
    with in_step(spark, name) as touched:
        with _dynamic_overwrite(spark):
            dealt = rows.repartition(count, *columns) if count else rows
            dealt.observe(seen, F.count(F.lit(1)).alias("written"), filled.alias("filled")).write.mode("overwrite").insertInto(name)
        kept = {tuple(p[c] for c in partitions) for p in (r.asDict() for r in seen.get["filled"])}
        stale = [p for p in partition_values(spark, name) if any(all(p[c] == v for c, v in w.items()) for w in replaced)]
        stale = [p for p in stale if tuple(p[c] for c in partitions) not in kept]
        _drop(spark, name, stale, stale)
        touched.update(kept | {tuple(p[c] for c in partitions) for p in stale})
    return seen.get["written"]


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(_name(name)) if c.isPartition]


def _buckets(spark: SparkSession, name: str) -> tuple[int, list[str]]:
    """(number of buckets, bucket columns) of a table; (0, []) if it has none."""
    columns = [c.name for c in spark.catalog.listColumns(_name(name)) if c.isBucket]
    if not columns:
        return 0, []
    return int(_described(spark, name)["Num Buckets"]), columns


def _drop_counts(
    spark: SparkSession, name: str, drops: list[tuple[str, str]], column: str
) -> dict[tuple[str, str], int]:
    """Rows per (store, day) partition, for the drops that have any; one row each is fetched."""
    days = spark.table(name).where(
        F.col("store").isin(sorted({s for s, _ in drops})) & F.col(column).isin(sorted({d for _, d in drops}))
    )
    counts = days.groupBy("store", column).agg(F.count(F.lit(1)).alias("n")).collect()
    found = {(r["store"], r[column]): r["n"] for r in counts}
    return {drop: found[drop] for drop in drops if drop in found}


def replace_days(
    spark: SparkSession,
    name: str,
    df: DataFrame,
    drops: list[tuple[str, str]],
    column: str = "ingestion_date",
    on_unknown: str = "raise",
) -> dict[tuple[str, str], int]:
    """Replace the given (store, day) partitions by the rows of ``df`` in one job.

    Returns rows per drop.  Old partitions stay readable until the job commits, so a failed
    attempt can simply be repeated.  A drop without rows ends up empty.  Rows outside
    ``drops`` fail the job instead of replacing a partition nobody named, and so does a
    difference between the rows written and those found afterwards.
    """
    from shelfmark.sources.rollup import in_step

    drops = list(drops)
    rows = fit_to_table(spark, name, df, on_unknown, max((d for _, d in drops), default=None))
    key = F.concat_ws("/", "store", column)
    named = F.col("store").isNotNull() & F.col(column).isNotNull() & key.isin([f"{s}/{d}" for s, d in drops])
    outside = F.raise_error(F.lit("row outside the days to replace")).cast("boolean")
    guarded = rows.where(F.when(named, F.lit(True)).otherwise(outside))

    seen = Observation()
    metrics = F.count(F.lit(1)).alias("written"), F.collect_set(key).alias("filled")
    count, own = _buckets(spark, name)
    guarded = guarded.repartition(count, *own) if count else guarded
    with in_step(spark, name, drops):
        with _dynamic_overwrite(spark):
            guarded.observe(seen, *metrics).write.mode("overwrite").insertInto(name)

        counts = _drop_counts(spark, name, drops, column)
        filled = set(seen.get["filled"])
        emptied = [d for d in counts if "/".join(d) not in filled]
        if emptied:
            gone = [{"store": store, column: day} for store, day in emptied]
            _drop(spark, name, gone, gone)
        for drop in emptied:
            counts.pop(drop)
    if sum(counts.values()) != seen.get["written"]:
        raise RuntimeError(f"{name}: wrote {seen.get['written']} rows but found {sum(counts.values())}")
    return {drop: counts.get(drop, 0) for drop in drops}


def replace_day(
    spark: SparkSession,
    name: str,
    df: DataFrame,
    day: str,
    stores: list[str],
    column: str = "ingestion_date",
) -> tuple[int, int, int]:
    """Replace one day of the given stores; returns (old, new, written) row counts.

    ``old`` and ``new`` count the replaced partitions only, so the cost does not grow with
    the history.
    """
    touched = F.col("store").isin(list(stores)) & (F.col(column) == day)
    old = audit_counts(spark, name, touched)
    written = replace_days(spark, name, df, [(s, day) for s in stores], column)
    return old, audit_counts(spark, name, touched), sum(written.values())


def audit_counts(spark: SparkSession, name: str, where=None) -> int:
    """Row count of a table, or of the partitions ``where`` selects."""
    rows = spark.table(name)
    if where is not None:
        rows = rows.where(where)
    return rows.agg(F.count(F.lit(1)).alias("n")).first()["n"]


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """All rows of a table."""
    return spark.table(name)


def materialize_view(df: DataFrame, name: str) -> None:
    """Publish a frame as a temporary view; nothing is computed."""
    df.createOrReplaceTempView(name)


def store_view(
    spark: SparkSession,
    name: str,
    table: str,
    columns: Iterable[str],
    stores: Iterable[str],
    database: str | None = None,
) -> None:
    """Publish columns of some shops' rows of a table as a view in the catalog."""
    target = f"{database}.{name}" if database else name
    chosen = ", ".join(f"`{c}`" for c in columns)
    names = ", ".join(_text(s) for s in stores)
    spark.sql(
        f"CREATE OR REPLACE VIEW {_name(target)} AS SELECT {chosen} FROM {_name(table)} WHERE store IN ({names})"
    )


def materialize_incremental(
    spark: SparkSession,
    name: str,
    rows: DataFrame,
    today: str,
    partitions: Iterable[str] = SOLD_PARTITIONS,
    column: str = "sold_date",
    path: str | None = None,
) -> int:
    """Append ``rows`` of ``today`` unless the table already holds that day or a later one.

    The first call creates the table.  The guard is read before planning the append (one
    row), so a blocked run does not compute ``rows`` at all.  Returns rows
    written.
    """
    from shelfmark.operators.guard import guard_passes

    if not ensure_table(spark, name, rows, partitions, path):
        if not guard_passes(spark.table(name), today, column):
            return 0
    return append_day(spark, name, rows)
