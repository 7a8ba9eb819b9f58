import datetime as dt
import json
import os

import pytest
from fixtures import product, write_page
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark import sources as src
from shelfmark.schemas import PRODUCT


def test_reads_single_line_and_indented_pages_and_ignores_other_files(spark, tmp_path):
    root = str(tmp_path)
    folder = write_page(root, "rebag", "2024-12-09", "1.json", [product(1), product(2)])
    write_page(root, "rebag", "2024-12-09", "2.json", [product(3, vendor="Hermès")], indent=2)
    rows = src.read_raw_json(spark, folder)
    assert {(r["id"], r["vendor"]) for r in rows.collect()} == {(1, "Chanel"), (2, "Chanel"), (3, "Hermès")}
    assert rows.columns == PRODUCT.names


def test_infers_a_schema_when_none_is_given(spark, tmp_path):
    folder = write_page(str(tmp_path), "dct", "2024-12-09", "1.json", [product(1, seo={"slug": {"a": 1}}, tags=["x"])])
    rows = src.flatten_nested(src.read_raw_json(spark, folder, schema=None))
    assert "seo.slug.a" in rows.columns and "tags" in rows.columns
    assert rows.select(F.col("`seo.slug.a`")).first()[0] == 1


def test_all_fields_of_a_listing_are_kept(spark, tmp_path):
    extra = product(1, tags=["x"], options={"size": "M"}) | {"variants": [{"price": "1.00", "sku": "s"}]}
    folder = write_page(str(tmp_path), "dct", "2024-12-09", "1.json", [extra, product(2)])
    rows = src.flatten_nested(src.read_raw_json(spark, folder))
    assert {"tags", "options.size"} <= set(rows.columns) and rows.columns[: len(PRODUCT.names)] == PRODUCT.names
    first = rows.where("id = 1").select("variants").first()[0][0]
    assert (first["price"], first["sku"]) == ("1.00", "s")
    assert sorted(src.unread_fields(spark, folder, PRODUCT)) == ["options.size", "tags", "variants.sku"]


def test_flattening_raises_on_names_made_twice(spark):
    rows = spark.sql("SELECT 1 AS `a.b`, struct(2 AS b) AS a")
    with pytest.raises(ValueError):
        src.flatten_nested(rows)


def test_many_days_in_one_scan(spark, tmp_path):
    root = str(tmp_path)
    write_page(root, "dct", "2024-12-01", "1.json", [product(1)])
    write_page(root, "dct", "2024-12-10", "1.json", [product(2)])
    write_page(root, "vsp", "2024-12-01", "1.json", [product(3)])
    drops = [("dct", "2024-12-01"), ("vsp", "2024-12-01")]
    rows = src.read_raw_days(spark, root, drops).select("store", "ingestion_date", "id")
    assert {tuple(r) for r in rows.collect()} == {("dct", "2024-12-01", 1), ("vsp", "2024-12-01", 3)}


def test_no_pages_raises(spark, tmp_path):
    folder = write_page(str(tmp_path), "dct", "2024-12-09", "1.json", [])
    os.rename(os.path.join(folder, "1.json"), os.path.join(folder, "1.txt"))
    with pytest.raises(FileNotFoundError):
        src.read_raw_json(spark, folder)
    with pytest.raises(FileNotFoundError):
        src.read_raw_days(spark, str(tmp_path), [("dct", "2024-12-09")])


def test_malformed_page_fails(spark, tmp_path):
    folder = write_page(str(tmp_path), "dct", "2024-12-09", "1.json", [product(1)])
    with open(os.path.join(folder, "2.json"), "w") as f:
        f.write('{"products": [')
    with pytest.raises(Exception):
        src.read_raw_json(spark, folder).collect()


def test_page_without_products_fails(spark, tmp_path):
    folder = write_page(str(tmp_path), "dct", "2024-12-09", "1.json", [product(1)])
    with open(os.path.join(folder, "2.json"), "w") as f:
        json.dump({"error": "x"}, f)
    with pytest.raises(Exception, match="products"):
        src.read_raw_json(spark, folder).collect()


def test_day_path_is_unpadded(spark):
    assert src.day_path("vsp", "2024-02-03") == "vsp/2024/2/3"
    row = spark.range(1).select(src.day_path_column(F.lit("vsp"), F.lit(dt.date(2024, 2, 3))).alias("p")).first()
    assert row["p"] == "vsp/2024/2/3"


def test_concat_pages_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, vendor string")
    b = spark.createDataFrame([(2, "t")], "id int, title string")
    rows = {tuple(r) for r in src.concat_pages([a, b]).select("id", "vendor", "title").collect()}
    assert rows == {(1, "x", None), (2, None, "t")}
    with pytest.raises(ValueError):
        src.concat_pages([])


def test_cluster_orders_by_vendor_and_spreads_a_hot_vendor(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, F.lit("Hot")).otherwise(
        F.when(F.col("id") % 2 == 0, F.lit("Z"))).alias("vendor"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = src.cluster_by_vendor(rows).select("vendor", F.spark_partition_id().alias("p")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    for part in {r["p"] for r in parts}:
        order = [r["vendor"] for r in parts if r["p"] == part]
        assert order == sorted(order, key=lambda v: (v is None, v or ""))
    assert len({r["p"] for r in parts if r["vendor"] == "Hot"}) > 1


def test_base_write_is_rerun_safe_and_purge_is_exact(spark, tmp_path):
    root = str(tmp_path / "base")
    rows = spark.createDataFrame(
        [(1, "b", "dct", "2024-12-01"), (2, None, "dct", "2024-12-10"), (3, "a", "vsp", "2024-12-01")],
        "id long, vendor string, store string, ingestion_date string",
    )
    src.write_base_parquet(rows, root)
    src.write_base_parquet(rows.where("ingestion_date = '2024-12-01'"), root)
    drops = [("dct", "2024-12-01"), ("dct", "2024-12-10"), ("vsp", "2024-12-01")]
    assert sorted(r["id"] for r in src.read_base_days(spark, root, drops).collect()) == [1, 2, 3]
    src.purge_base_day(spark, root, "dct", "2024-12-01")
    assert [r["id"] for r in src.read_base_parquet(spark, root, "dct", "2024-12-01").collect()] == []
    assert [r["id"] for r in src.read_base_parquet(spark, root, "dct", "2024-12-10").collect()] == [2]


def test_csv_export_keeps_header_and_values(spark, tmp_path):
    path = str(tmp_path / "csv")
    src.export_csv(spark.createDataFrame([(1, 'say "hi", ok')], "id int, title string"), path)
    assert spark.read.option("header", True).option("escape", '"').csv(path).first()["title"] == 'say "hi", ok'


def test_seed(spark, tmp_path):
    assert src.load_seed(spark).count() == 137
    path = tmp_path / "seed.csv"
    path.write_bytes("vendor\r\nChloé\r\nHermès".encode())
    assert {r[0] for r in src.load_seed(spark, str(path)).collect()} == {"Chloé", "Hermès"}


def test_flatten_keeps_arrays(spark):
    inner = T.StructType().add("b.c", T.IntegerType()).add("d", T.ArrayType(T.IntegerType()))
    schema = T.StructType().add("a", inner).add("e", T.IntegerType())
    df = spark.createDataFrame([((1, [2]), 3)], schema)
    flat = src.flatten_nested(df)
    assert flat.columns == ["a.b.c", "a.d", "e"] and tuple(flat.first()) == (1, [2], 3)
