import os
import uuid

import pytest
from fixtures import product, write_page
from pyspark.sql import functions as F

from shelfmark import operators as op
from shelfmark.plans import build_sold, land_days, rebuild_sold, run_day
from shelfmark.streaming import catch_up


@pytest.fixture
def place(tmp_path):
    tag = uuid.uuid4().hex
    return {
        "raw_root": str(tmp_path / "raw"), "base_root": str(tmp_path / "base"),
        "products": f"products_{tag}", "sold": f"sold_{tag}",
        "products_path": str(tmp_path / "products"), "sold_path": str(tmp_path / "sold"),
    }


def seed_pages(root):
    """Listing 1 stays, 2 sells on the 10th, 3 appears then, 4 sells and is back on the 11th."""
    for store in ("vsp", "rebag", "dct", "treasures"):
        write_page(root, store, "2024-12-09", "1.json", [product(1), product(2, price="1.005")])
        write_page(root, store, "2024-12-09", "2.json", [product(4), product(4, "2024-12-08T11:00:00-05:00")], indent=1)
        write_page(root, store, "2024-12-10", "1.json", [product(1), product(3)])
        write_page(root, store, "2024-12-11", "1.json", [product(1), product(3), product(4)])


def run(spark, place, day):
    return run_day(spark, **place, day=day)


def test_three_days(spark, place):
    seed_pages(place["raw_root"])
    first = run(spark, place, "2024-12-09")
    assert set(first.landed.values()) == {4} and first.sold == 0
    assert run(spark, place, "2024-12-10").sold == 8
    assert run(spark, place, "2024-12-11").sold == 0
    rows = spark.table(place["sold"])
    assert {(r["store"], r["id"], r["sold_date"]) for r in rows.collect()} == {
        (s, i, "2024-12-10") for s in ("vsp", "rebag", "dct", "treasures") for i in (2, 4)
    }
    row = rows.where("store = 'rebag' and id = 2").first()
    assert str(row["price"]) == "1.01" and row["condition"] == "Excellent" and row["exterior_color"] == "Brown"
    assert row["days_on_market"] == 20
    assert rows.where("store = 'dct'").first()["condition"] is None
    assert spark.table("sold_products").count() == 8
    assert "condition" in spark.table("inc_rebag__sold_products").columns
    assert "condition" not in spark.table("inc_vsp__sold_products").columns
    # Nothing sold on a day is listed on it.
    listed = spark.table(place["products"]).where("ingestion_date = '2024-12-10'")
    assert rows.join(listed, ["store", "id"], "left_semi").count() == 0


def test_reruns_change_nothing(spark, place):
    seed_pages(place["raw_root"])
    for day in ("2024-12-09", "2024-12-10", "2024-12-10", "2024-12-09"):
        run(spark, place, day)
    assert spark.table(place["products"]).count() == 4 * 4 + 4 * 2
    assert spark.table(place["sold"]).count() == 8


def test_stores_join_on_their_first_day(spark, place):
    for store in ("vsp", "rebag"):
        write_page(place["raw_root"], store, "2024-12-01", "1.json", [product(1)])
    assert set(run(spark, place, "2024-12-01").landed) == {("vsp", "2024-12-01"), ("rebag", "2024-12-01")}
    assert run(spark, place, "2024-11-12").landed == {}


def test_a_shop_without_pages_does_not_hold_up_the_others(spark, place):
    seed_pages(place["raw_root"])
    run(spark, place, "2024-12-09")
    folder = f"{place['raw_root']}/dct/2024/12/10"
    os.rename(f"{folder}/1.json", f"{folder}/1.late")
    late = run(spark, place, "2024-12-10")
    assert late.missing == ["dct"] and late.sold == 6
    os.rename(f"{folder}/1.late", f"{folder}/1.json")
    again = run(spark, place, "2024-12-10")
    assert again.missing == [] and again.sold == 2
    with pytest.raises(FileNotFoundError):
        run(spark, place, "2024-12-31")


def test_failing_shop_stops_alone(spark, place):
    seed_pages(place["raw_root"])
    run(spark, place, "2024-12-09")
    write_page(place["raw_root"], "vsp", "2024-12-10", "2.json", [product(8, variants=[])])
    with pytest.raises(op.DataQualityError, match="vsp: stg_vsp__products.price not_null: 1") as error:
        run(spark, place, "2024-12-10")
    assert error.value.report.sold == 6 and list(error.value.report.failed) == ["vsp"]
    assert {r["store"] for r in spark.table(place["sold"]).collect()} == {"rebag", "dct", "treasures"}
    write_page(place["raw_root"], "vsp", "2024-12-10", "2.json", [product(8)])
    assert run(spark, place, "2024-12-10").sold == 2
    assert spark.table("stg_rebag__products").count() == 4


def test_bad_rows_of_the_day_before_are_not_appended(spark, place):
    seed_pages(place["raw_root"])
    write_page(place["raw_root"], "dct", "2024-12-09", "3.json", [product(9, variants=[])])
    with pytest.raises(op.DataQualityError, match="dct"):
        run(spark, place, "2024-12-09")
    with pytest.raises(op.DataQualityError, match="sold_dct.price"):
        run(spark, place, "2024-12-10")
    assert spark.table(place["sold"]).where("store = 'dct'").count() == 0
    write_page(place["raw_root"], "dct", "2024-12-09", "3.json", [product(9)])
    run(spark, place, "2024-12-09")
    assert run(spark, place, "2024-12-10").sold == 3


def test_no_sale_without_a_snapshot(spark, place):
    for day, ids in (("2024-12-09", (1, 2)), ("2024-12-11", (1,))):
        write_page(place["raw_root"], "dct", day, "1.json", [product(i) for i in ids])
    write_page(place["raw_root"], "vsp", "2024-12-09", "1.json", [product(1)])
    write_page(place["raw_root"], "vsp", "2024-12-10", "1.json", [product(5)])
    drops = [("dct", "2024-12-09"), ("dct", "2024-12-11"), ("vsp", "2024-12-09"), ("vsp", "2024-12-10")]
    land_days(spark, place["raw_root"], place["base_root"], place["products"], drops, path=place["products_path"])
    written = rebuild_sold(spark, place["products"], place["sold"], ["2024-12-10", "2024-12-11"], path=place["sold_path"])
    assert written == {("dct", "2024-12-11"): 0, ("vsp", "2024-12-10"): 1}
    other = place["sold"] + "_b"
    path = place["sold_path"] + "_b"
    assert build_sold(spark, place["products"], other, "2024-12-10", path=path) == 1
    # Each shop is compared with its own latest snapshot.
    assert build_sold(spark, place["products"], other, "2024-12-11", previous="last_available", path=path) == 1


def test_guard_is_per_store(spark, place):
    seed_pages(place["raw_root"])
    raw, base, products, sold = (place[k] for k in ("raw_root", "base_root", "products", "sold"))
    drops = [(s, d) for s in ("vsp", "dct") for d in ("2024-12-09", "2024-12-10")]
    assert sum(land_days(spark, raw, base, products, drops, path=place["products_path"]).values()) == 12
    from shelfmark.stores import STORES

    vsp = [s for s in STORES if s.name == "vsp"]
    both = [s for s in STORES if s.name in ("vsp", "dct")]
    assert build_sold(spark, products, sold, "2024-12-10", vsp, path=place["sold_path"]) == 2
    assert build_sold(spark, products, sold, "2024-12-10", both) == 2
    assert build_sold(spark, products, sold, "2024-12-10", both) == 0
    counts = spark.table(sold).groupBy("store").agg(F.count(F.lit(1)).alias("n")).collect()
    assert {r["store"]: r["n"] for r in counts} == {"vsp": 2, "dct": 2}


def test_catch_up_lands_touched_days_whole(spark, place, tmp_path):
    raw = place["raw_root"]
    state = str(tmp_path / "state")
    calls = []

    def land(drops):
        calls.append(drops)
        land_days(spark, raw, place["base_root"], place["products"], drops, path=place["products_path"])

    write_page(raw, "vsp", "2024-12-01", "1.json", [product(1)])
    write_page(raw, "vsp", "2024-12-10", "1.json", [product(2)])
    catch_up(spark, raw, state, land)
    catch_up(spark, raw, state, land)
    write_page(raw, "vsp", "2024-12-01", "2.json", [product(3)])
    catch_up(spark, raw, state, land)
    assert calls == [[("vsp", "2024-12-01"), ("vsp", "2024-12-10")], [("vsp", "2024-12-01")]]
    got = {(r["ingestion_date"], r["id"]) for r in spark.table(place["products"]).collect()}
    assert got == {("2024-12-01", 1), ("2024-12-10", 2), ("2024-12-01", 3)}


def test_rebuild_equals_daily_runs_and_replaces(spark, place, tmp_path):
    seed_pages(place["raw_root"])
    days = ("2024-12-09", "2024-12-10", "2024-12-11")
    for day in days:
        run(spark, place, day)
    again = f"sold_{uuid.uuid4().hex}"
    for _ in range(2):
        written = rebuild_sold(spark, place["products"], again, days, path=str(tmp_path / "again"))
        assert sum(written.values()) == 8 and written[("vsp", "2024-12-10")] == 2
    rows, daily = spark.table(again), spark.table(place["sold"])
    assert rows.columns == daily.columns
    assert rows.exceptAll(daily).count() == 0 and daily.exceptAll(rows).count() == 0
