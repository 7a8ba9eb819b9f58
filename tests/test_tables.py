import uuid

import pytest
from pyspark.sql import functions as F

from shelfmark import sources as src

SCHEMA = "id long, vendor string, store string, ingestion_date string"


def rows(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


@pytest.fixture
def table(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    src.ensure_table(spark, name, rows(spark), path=str(tmp_path / "t"))
    return name


def content(spark, name):
    return sorted(tuple(r) for r in spark.table(name).select("id", "store", "ingestion_date").collect())


def test_ensure_once(spark, table):
    assert src.ensure_table(spark, table, rows(spark)) is False
    assert spark.table(table).count() == 0
    assert spark.table(table).schema["ingestion_date"].dataType.simpleString() == "string"


def test_table_over_existing_files_is_visible(spark, table, tmp_path):
    src.append_day(spark, table, rows(spark, (1, "a", "dct", "2024-12-01")))
    again = f"t_{uuid.uuid4().hex}"
    assert src.ensure_table(spark, again, rows(spark), path=str(tmp_path / "t")) is True
    assert content(spark, again) == [(1, "dct", "2024-12-01")]


def test_append_aligns_columns(spark, table):
    df = spark.createDataFrame([("2024-12-01", "dct", 1)], "ingestion_date string, store string, id int")
    assert src.append_day(spark, table, df) == 1
    assert spark.table(table).first()["vendor"] is None
    with pytest.raises(ValueError, match="extra"):
        src.append_day(spark, table, df.withColumn("extra", F.lit(1)))


def test_delete_day_is_exact(spark, table):
    src.append_day(spark, table, rows(
        spark, (1, "a", "dct", "2024-12-01"), (2, "a", "dct", "2024-12-10"), (3, "a", "vsp", "2024-12-01")))
    src.delete_day(spark, table, "2024-12-01", ["dct"])
    assert content(spark, table) == [(2, "dct", "2024-12-10"), (3, "vsp", "2024-12-01")]


def test_replace_day_twice_equals_once(spark, table):
    day = rows(spark, (1, "a", "dct", "2024-12-01"), (2, "a", "vsp", "2024-12-01"))
    src.append_day(spark, table, rows(spark, (9, "a", "dct", "2024-11-30"), (8, "x", "dct", "2024-12-01")))
    assert src.replace_day(spark, table, day, "2024-12-01", ["dct", "vsp"]) == (1, 2, 2)
    once = content(spark, table)
    assert src.replace_day(spark, table, day, "2024-12-01", ["dct", "vsp"]) == (2, 2, 2)
    assert content(spark, table) == once == [(1, "dct", "2024-12-01"), (2, "vsp", "2024-12-01"), (9, "dct", "2024-11-30")]


def test_replace_with_no_rows_empties_the_day(spark, table):
    src.append_day(spark, table, rows(spark, (1, "a", "dct", "2024-12-01"), (2, "a", "vsp", "2024-12-01")))
    kept = rows(spark, (5, "a", "vsp", "2024-12-01"))
    src.replace_day(spark, table, kept, "2024-12-01", ["dct", "vsp"])
    assert content(spark, table) == [(5, "vsp", "2024-12-01")]


def test_replace_rejects_rows_of_other_days(spark, table):
    src.append_day(spark, table, rows(spark, (1, "a", "dct", "2024-12-02")))
    with pytest.raises(Exception, match="outside"):
        src.replace_day(spark, table, rows(spark, (2, "a", "dct", "2024-12-02")), "2024-12-01", ["dct"])
    assert content(spark, table) == [(1, "dct", "2024-12-02")]


def test_replace_leaves_the_session_setting(spark, table):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "static")
    try:
        src.append_day(spark, table, rows(spark, (1, "a", "dct", "2024-11-30")))
        src.replace_day(spark, table, rows(spark, (2, "a", "dct", "2024-12-01")), "2024-12-01", ["dct"])
        assert spark.conf.get(key) == "static"
    finally:
        spark.conf.set(key, before)
    assert len(content(spark, table)) == 2


def test_incremental_append(spark, tmp_path):
    name, path = f"s_{uuid.uuid4().hex}", str(tmp_path / "s")
    def sold(day):
        return spark.createDataFrame([(1, "dct", day)], "id long, store string, sold_date string")
    written = [src.materialize_incremental(spark, name, sold(d), d, path=path)
               for d in ("2024-12-09", "2024-12-09", "2024-12-08", "2024-12-10")]
    assert written == [1, 0, 0, 1]
    assert sorted(r["sold_date"] for r in spark.table(name).collect()) == ["2024-12-09", "2024-12-10"]


def test_replace_many_days_at_once(spark, table):
    drops = [(s, f"2024-{m:02d}-{d:02d}") for s in ("dct", "vsp") for m in range(1, 13) for d in range(1, 29)]
    src.append_day(spark, table, rows(spark, (7, "a", "vsp", "2024-03-01"), (8, "a", "vsp", "2023-12-31")))
    new = spark.createDataFrame([(i, "v", s, d) for i, (s, d) in enumerate(drops) if s == "dct"], SCHEMA)
    counts = src.replace_days(spark, table, new, drops)
    assert len(counts) == len(drops) and sum(counts.values()) == len(drops) // 2
    assert counts[("vsp", "2024-03-01")] == 0
    assert [r for r in content(spark, table) if r[1] == "vsp"] == [(8, "vsp", "2023-12-31")]


def test_nested_fields_are_aligned_by_name(spark):
    table = spark.createDataFrame([], "id long, variants array<struct<price:string,sku:string>>, seo struct<a:int,b:struct<c:int>>").schema
    day = spark.sql("SELECT 1L AS id, array(struct('yes' AS sku, '10.00' AS price), NULL) AS variants, struct(struct(3 AS c) AS b) AS seo")
    row = src.align_to_table(day, table).first()
    assert (row["variants"][0]["price"], row["variants"][0]["sku"], row["variants"][1]) == ("10.00", "yes", None)
    assert row["seo"]["a"] is None and row["seo"]["b"]["c"] == 3
    with pytest.raises(ValueError, match="variants.available"):
        src.align_to_table(spark.sql("SELECT array(struct(true AS available)) AS variants"), table)
