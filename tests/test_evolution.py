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
    src.append_day(spark, name, rows(spark, (1, "a", "dct", "2024-12-01"), (2, "b", "vsp", "2024-12-01")))
    return name


def test_added_columns_read_null_on_older_days(spark, table):
    new = rows(spark, (1, "a", "dct", "2024-12-02")).withColumns({"sku": F.lit("s1"), "stock": F.lit(5)})
    with pytest.raises(ValueError, match="sku"):
        src.append_day(spark, table, new)
    assert spark.table(table).count() == 2
    assert src.append_day(spark, table, new, on_unknown="add", seen_on="2024-12-02") == 1
    assert src.append_day(spark, table, rows(spark, (1, "a", "dct", "2024-12-03")), on_unknown="add") == 1
    found = spark.table(table).orderBy("ingestion_date", "id")
    assert found.columns == ["id", "vendor", "sku", "stock", "store", "ingestion_date"]
    assert [(r["sku"], r["stock"]) for r in found.collect()] == [(None, None), (None, None), ("s1", 5), (None, None)]
    history = {r["column"]: (r["type"], r["added_on"]) for r in src.schema_history(spark, table).collect()}
    assert history["sku"] == ("string", "2024-12-02") and history["stock"] == ("int", "2024-12-02") and history["id"] == ("bigint", None)


def test_replace_days_with_an_added_column(spark, table):
    new = rows(spark, (7, "a", "dct", "2024-12-01")).withColumn("sku", F.lit("x"))
    with pytest.raises(ValueError, match="sku"):
        src.replace_days(spark, table, new, [("dct", "2024-12-01")])
    src.replace_days(spark, table, new, [("dct", "2024-12-01")], on_unknown="add")
    assert sorted((r["id"], r["sku"]) for r in spark.table(table).collect()) == [(2, None), (7, "x")]


def test_added_columns_are_found_again_over_old_files(spark, table, tmp_path):
    src.append_day(spark, table, rows(spark, (1, "a", "dct", "2024-12-02")).withColumn("sku", F.lit("s")), on_unknown="add")
    again = f"t_{uuid.uuid4().hex}"
    src.ensure_table(spark, again, rows(spark), path=str(tmp_path / "t"))
    assert spark.table(again).columns == ["id", "vendor", "sku", "store", "ingestion_date"]
    assert {r["sku"] for r in spark.table(again).collect()} == {None, "s"}


def test_nested_new_fields_go_to_the_variant(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    first = spark.sql("SELECT 1L AS id, array(struct('1.00' AS price)) AS variants, struct(1 AS a) AS seo, 'dct' AS store, '2024-12-01' AS ingestion_date")
    src.ensure_table(spark, name, first, path=str(tmp_path / "n"))
    src.append_day(spark, name, first)
    wider = spark.sql(
        "SELECT 2L AS id, array(struct('2.00' AS price, 's' AS sku), NULL) AS variants, struct(2 AS a, struct(3 AS c) AS b) AS seo, "
        "true AS available, 'dct' AS store, '2024-12-02' AS ingestion_date"
    )
    with pytest.raises(ValueError, match="variants.sku"):
        src.append_day(spark, name, wider, on_unknown="add")
    assert src.append_day(spark, name, wider, on_unknown="other") == 1
    assert src.append_day(spark, name, first, on_unknown="other") == 1
    row = spark.table(name).where("id = 2").select("variants", "seo", F.to_json("other").alias("other")).first()
    assert row["variants"][0]["price"] == "2.00" and row["variants"][1] is None and row["seo"]["a"] == 2
    assert '"sku":"s"' in row["other"] and '"available":true' in row["other"] and '"c":3' in row["other"]
    assert spark.table(name).where("id = 1 AND other IS NULL").count() == 2
    with pytest.raises(ValueError):
        src.append_day(spark, name, wider, on_unknown="ignore")


def test_what_the_variant_held_stays(spark):
    schema = spark.sql("SELECT 1 AS id, parse_json('{}') AS other").schema
    df = spark.sql("SELECT 1 AS id, 'n' AS sku, parse_json('{\"seen\": 1, \"sku\": \"old\"}') AS other UNION ALL SELECT 2, NULL, NULL")
    out = src.set_aside(df, schema).select("id", F.to_json("other").alias("other")).orderBy("id").collect()
    assert out[0]["other"] == '{"seen":1,"sku":"n"}' and out[1]["other"] in ("{}", '{"sku":null}')


def test_many_emptied_days_take_one_catalog_statement(spark, tmp_path, monkeypatch):
    name = f"t_{uuid.uuid4().hex}"
    days = [f"2024-{m:02d}-{d:02d}" for m in range(1, 11) for d in range(1, 21)]
    src.ensure_table(spark, name, rows(spark), path=str(tmp_path / "many"))
    src.append_day(spark, name, rows(spark, *[(i, "a", "dct", d) for i, d in enumerate(days)], (999, "a", "o'dd = %x", "2024-01-01")))
    said = []
    sql = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: (said.append(text), sql(self, text, *a, **k))[1])
    kept = rows(spark, (5, "a", "vsp", "2024-01-01"))
    counts = src.replace_days(spark, name, kept, [("dct", d) for d in days] + [("vsp", "2024-01-01")])
    changes = [t for t in said if t.startswith(("ALTER", "INSERT"))]
    assert len(changes) == 1 and changes[0].count("PARTITION (") == 200
    assert sum(counts.values()) == 1 and len(counts) == 201
    assert {r["id"] for r in spark.table(name).collect()} == {5, 999}
    src.delete_day(spark, name, "2024-01-01", ["o'dd = %x", "nobody"])
    assert {r["id"] for r in spark.table(name).collect()} == {5}
    # No file is left to come back when the folder is attached again.
    again = f"t_{uuid.uuid4().hex}"
    src.ensure_table(spark, again, rows(spark), path=str(tmp_path / "many"))
    assert {r["id"] for r in spark.table(again).collect()} == {5}


def test_delete_days_of_a_managed_table_and_again(spark):
    name = f"t_{uuid.uuid4().hex}"
    src.ensure_table(spark, name, rows(spark))
    src.append_day(spark, name, rows(spark, (1, "a", "dct", "2024-12-01"), (2, "a", "dct", "2024-12-02")))
    assert src.delete_days(spark, name, [("dct", "2024-12-01"), ("dct", "2024-11-01")]) == 1
    assert src.delete_days(spark, name, [("dct", "2024-12-01")]) == 0 and src.delete_days(spark, name, []) == 0
    assert [r["id"] for r in spark.table(name).collect()] == [2]
    spark.sql(f"DROP TABLE {name}")
