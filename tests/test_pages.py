import contextlib
import io
import json
import os
import uuid

import pytest
from fixtures import product, write_page
from pyspark.sql import functions as F

from shelfmark import operators as op
from shelfmark import sources as src
from shelfmark.plans import BadPagesError, land_days, quarantine_root, run_day
from shelfmark.schemas import PRODUCT

DAY = "2024-12-09"


def text_page(root, store, day, name, text):
    folder = write_page(root, store, day, "placeholder.json", [])
    os.remove(os.path.join(folder, "placeholder.json"))
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write(text)
    return folder


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture
def place(tmp_path):
    tag = uuid.uuid4().hex
    return {
        "raw_root": str(tmp_path / "raw"), "base_root": str(tmp_path / "base"),
        "products": f"products_{tag}", "sold": f"sold_{tag}",
        "products_path": str(tmp_path / "products"), "sold_path": str(tmp_path / "sold"),
    }


def test_one_scan_of_the_pages(spark, tmp_path):
    folder = write_page(str(tmp_path), "dct", DAY, "1.json", [product(1, seo={"slug": {"a": 1}})])
    text = plan(src.read_pages(spark, folder))
    assert text.count("Scan binaryFile") == 2 and "Scan json" not in text  # once in the tree, once in the details
    # Building the plan looks into no page: a broken one is seen when the rows are.
    text_page(str(tmp_path), "dct", DAY, "2.json", "{")
    assert src.read_pages(spark, folder).count() == 1


def test_typed_columns_and_all_other_fields(spark, tmp_path):
    root = str(tmp_path)
    rich = product(1, tags=["x"], options={"size": "M"}, seo={"slug": {"a": 1}}) | {"variants": [{"price": "1.00", "sku": "s"}]}
    write_page(root, "dct", DAY, "1.json", [rich, product(2, seo={"slug": {"b": "text"}})])
    folder = write_page(root, "dct", DAY, "2.json", [{"id": 3}], indent=2)
    rows = src.read_pages(spark, folder)
    assert rows.columns == ["store", "ingestion_date", *PRODUCT.names, "other"]
    assert {(r["store"], r["ingestion_date"], r["id"]) for r in rows.collect()} == {("dct", DAY, i) for i in (1, 2, 3)}
    first = rows.where("id = 1").select("title", "variants", F.to_json("other").alias("other")).first()
    assert first["title"] == "Bag 1" and first["variants"][0]["price"] == "1.00"
    assert json.loads(first["other"]) == {k: rich[k] for k in ("tags", "options", "seo", "variants")}
    third = rows.where("id = 3").select("title", "variants", "other").first()
    assert tuple(third) == (None, None, None)
    assert sorted(src.other_fields(rows)) == [
        ("options.size", "string"), ("seo.slug.a", "bigint"), ("seo.slug.b", "string"), ("tags", "array<string>"),
        ("variants", "array<struct<price:string,sku:string>>"),
    ]
    lifted = src.lift_fields(rows, src.other_fields(rows)).where("id < 3").orderBy("id")
    assert [tuple(r) for r in lifted.select("`options.size`", "`seo.slug.a`", "`seo.slug.b`").collect()] == [("M", 1, None), (None, None, "text")]


def test_values_that_do_not_fit_are_null(spark, tmp_path):
    folder = write_page(str(tmp_path), "dct", DAY, "1.json", [product("abc", title=5, variants="none"), product("7", vendor=None)])
    rows = {r["id"]: r for r in src.read_pages(spark, folder, other=None).collect()}
    assert rows[None]["title"] == "5" and rows[None]["variants"] is None
    assert rows[7]["vendor"] is None


def test_reasons_of_bad_pages(spark, tmp_path):
    root = str(tmp_path)
    for i, text in enumerate(('{"products": [', '{"items": []}', '{"products": [1]}', '{"products": [null]}', "", "null", '{"products": {}}', "[]")):
        text_page(root, "vsp", DAY, f"{i}.json", text)
    folder = write_page(root, "vsp", DAY, "good.json", [product(1)])
    bad = {os.path.basename(r["file"])[0]: r["reason"] for r in src.bad_pages(spark, folder).collect()}
    not_json, no_list, no_object = "not JSON", "no list of products", "a listing is not an object"
    assert bad == {"0": not_json, "1": no_list, "2": no_object, "3": no_object, "4": not_json, "5": no_list, "6": no_list, "7": no_list}
    assert src.read_pages(spark, folder).count() == 1
    assert [tuple(r) for r in src.page_counts(spark, folder).collect()] == [("vsp", DAY, 9, 8, 1)]


def test_lines_as_pages_and_key_value_folders(spark, tmp_path):
    folder = tmp_path / "store=a b%2Fc" / "year=2024" / "month=01" / "day=05"
    os.makedirs(folder)
    page = json.dumps({"products": [product(1), product(2)]})
    (folder / "part-0.txt").write_text("﻿" + page + "\n\n" + page[:40] + "\n" + json.dumps({"products": []}) + "\n", encoding="utf-8")
    found = src.page_counts(spark, str(tmp_path / "*" / "*" / "*" / "*"), multi_line=False, glob="*.txt").collect()
    assert [(r["ingestion_date"], r["pages"], r["bad"], r["listings"]) for r in found] == [("2024-01-05", 3, 1, 2)]


def test_a_bad_page_stops_its_shop_alone(spark, place):
    stores = ("vsp", "rebag", "dct", "treasures")
    for store in stores:
        write_page(place["raw_root"], store, DAY, "1.json", [product(1), product(2)])
        write_page(place["raw_root"], store, "2024-12-10", "1.json", [product(1)])
    run_day(spark, **place, day=DAY)
    text_page(place["raw_root"], "dct", "2024-12-10", "2.json", '{"products": [{"id": 2')
    with pytest.raises(op.DataQualityError, match="dct: 1 bad pages: not JSON") as error:
        run_day(spark, **place, day="2024-12-10")
    report = error.value.report
    assert report.sold == 3 and list(report.failed) == ["dct"] and sorted(s for s, _ in report.landed) == ["rebag", "treasures", "vsp"]
    assert spark.table(place["sold"]).where("store = 'dct'").count() == 0
    assert spark.table(place["products"]).where("store = 'dct' AND ingestion_date = '2024-12-10'").count() == 0
    assert spark.read.parquet(place["base_root"]).where("store = 'dct' AND ingestion_date = '2024-12-10'").count() == 0
    aside = src.quarantined(spark, quarantine_root(place["base_root"]))
    assert [(r["store"], r["ingestion_date"], r["reason"], r["text"]) for r in aside.collect()] == [
        ("dct", "2024-12-10", "not JSON", '{"products": [{"id": 2')]
    # Once the page is whole the shop catches up, and nothing stays in quarantine.
    write_page(place["raw_root"], "dct", "2024-12-10", "2.json", [product(3)])
    again = run_day(spark, **place, day="2024-12-10")
    assert again.sold == 1 and again.failed == {}
    assert src.quarantined(spark, quarantine_root(place["base_root"])).count() == 0


def test_a_landed_day_survives_a_bad_rerun(spark, place):
    write_page(place["raw_root"], "vsp", DAY, "1.json", [product(1)])
    write_page(place["raw_root"], "dct", DAY, "1.json", [product(1)])
    drops = [("vsp", DAY), ("dct", DAY)]
    land = dict(spark=spark, raw_root=place["raw_root"], base_root=place["base_root"], products=place["products"], path=place["products_path"])
    assert land_days(**land, drops=drops) == {("vsp", DAY): 1, ("dct", DAY): 1}
    text_page(place["raw_root"], "vsp", DAY, "2.json", "oops")
    with pytest.raises(BadPagesError, match="vsp 2024-12-09: 1 bad pages: not JSON") as error:
        land_days(**land, drops=drops)
    assert error.value.landed == {("dct", DAY): 1}
    failed = {}
    assert land_days(**land, drops=[("vsp", DAY)], failed=failed) == {} and list(failed) == [("vsp", DAY)]
    assert {(r["store"], r["id"]) for r in spark.table(place["products"]).collect()} == {("vsp", 1), ("dct", 1)}


def test_all_shops_bad_on_the_first_day(spark, place):
    text_page(place["raw_root"], "vsp", DAY, "1.json", "{")
    with pytest.raises(op.DataQualityError, match="vsp") as error:
        run_day(spark, **place, day=DAY)
    assert error.value.report.landed == {} and error.value.report.sold == 0


def test_pages_without_listings_empty_a_day(spark, place):
    write_page(place["raw_root"], "vsp", DAY, "1.json", [product(1)])
    land = dict(spark=spark, raw_root=place["raw_root"], base_root=place["base_root"], products=place["products"], path=place["products_path"])
    land_days(**land, drops=[("vsp", DAY)])
    write_page(place["raw_root"], "vsp", DAY, "1.json", [])
    assert land_days(**land, drops=[("vsp", DAY)]) == {("vsp", DAY): 0}
    assert spark.table(place["products"]).count() == 0


def test_new_and_nested_fields_stop_no_shop(spark, place):
    write_page(place["raw_root"], "vsp", DAY, "1.json", [product(1), product(2)])
    write_page(place["raw_root"], "dct", DAY, "1.json", [product(1), product(2)])
    run_day(spark, **place, day=DAY)
    write_page(place["raw_root"], "vsp", "2024-12-10", "1.json", [product(1, seo={"slug": {"a": 1}}, extra=[{"b": 2}])])
    write_page(place["raw_root"], "dct", "2024-12-10", "1.json", [product(1)])
    report = run_day(spark, **place, day="2024-12-10")
    assert report.sold == 2 and report.failed == {}
    rows = spark.table(place["products"]).where("store = 'vsp'").orderBy("ingestion_date", "id")
    assert [r[0] for r in rows.select(F.try_variant_get("other", "$.seo.slug.a", "int")).collect()] == [None, None, 1]
    assert spark.table("stg_vsp__products").count() == 2
