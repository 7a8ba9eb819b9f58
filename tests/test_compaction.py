import uuid

import pytest
from pyspark.sql import functions as F

from shelfmark import sources as src
from shelfmark.sources import compaction

SCHEMA = "id long, vendor string, store string, ingestion_date string"


def content(spark, name):
    return sorted((tuple(r) for r in spark.table(name).collect()), key=str)


@pytest.fixture
def table(spark, tmp_path):
    """Two days of many small files, the second with one row a thousand times, and a day of one file."""
    name = f"t_{uuid.uuid4().hex}"
    many = spark.range(3000).select(
        F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("id"),
        F.when(F.col("id") % 5 != 0, F.lit("hot")).alias("vendor"),
        F.lit("a/b").alias("store"),
        F.concat(F.lit("2024-12-0"), (F.col("id") % 2 + 1).cast("string")).alias("ingestion_date"),
    )
    src.ensure_table(spark, name, many, path=str(tmp_path / "t"))
    src.append_day(spark, name, many.repartition(12))
    src.append_day(spark, name, spark.createDataFrame([(1, "x", "c", "2024-12-03")], SCHEMA))
    return name


def test_rows_stay_and_files_go(spark, table):
    before = content(spark, table)
    assert src.file_sizes(spark, table).count() == 25
    done = src.compact(spark, table)
    assert (done.partitions, done.rows, done.files_before, done.files_after) == (2, 3000, 24, 2)
    assert content(spark, table) == before
    assert src.compact(spark, table) == compaction.Compacted()


def test_files_lie_in_the_size_band(spark, table):
    before, total = content(spark, table), src.file_sizes(spark, table).where("store = 'a/b'").agg(F.sum("bytes")).first()[0]
    done = src.compact(spark, table, target_bytes=total // 8, files_per_job=4)
    sizes = [r["rows"] for r in src.file_sizes(spark, table).where("store = 'a/b'").collect()]
    assert done.files_after == len(sizes) <= 10 and done.files_before == 24
    # Equal rows and a hot vendor are dealt like any others.
    for day in ("2024-12-01", "2024-12-02"):
        own = [r["rows"] for r in src.file_sizes(spark, table).where(F.col("ingestion_date") == day).collect()]
        assert max(own) < 1.3 * 1500 / len(own) and min(own) > 0.7 * 1500 / len(own)
    assert content(spark, table) == before


def test_a_lost_row_is_noticed(spark, table, monkeypatch):
    sizes = compaction.file_sizes
    monkeypatch.setattr(compaction, "file_sizes", lambda s, n: sizes(s, n).withColumn("rows", F.col("rows") + 1))
    with pytest.raises(RuntimeError, match="rows"):
        src.compact(spark, table)


def test_bucketed_and_empty_tables(spark, tmp_path):
    rows = spark.createDataFrame([(1, "x", "c", "2024-12-03")], SCHEMA)
    name = f"b_{uuid.uuid4().hex}"
    src.ensure_table(spark, name, rows, path=str(tmp_path / "b"), buckets=2)
    with pytest.raises(ValueError, match="bucketed"):
        src.compact(spark, name)
    empty = f"e_{uuid.uuid4().hex}"
    src.ensure_table(spark, empty, rows, path=str(tmp_path / "e"))
    assert src.compact(spark, empty) == compaction.Compacted()
