import random

import pytest
from fixtures import BODY
from pyspark.sql import functions as F

from shelfmark import functions as fn
from shelfmark import operators as op
from shelfmark.stores import HTML_ATTRIBUTES, STORES

HISTORY = "store string, id long, ingestion_date string, updated_at string"


def history(spark, *values):
    return spark.createDataFrame([("s", *v) for v in values], HISTORY)


def sold(df, today, **kw):
    rows = op.snapshot_diff(df, today, key=("store", "id"), **kw)
    return sorted(r["id"] for r in rows.collect())


def test_latest_row_wins_within_a_day(spark):
    df = history(spark, (1, "2024-12-08", "2024-12-08T10:00:00Z"), (1, "2024-12-08", "2024-12-08T11:00:00Z"))
    out = op.latest_by_id(df, ["id", "ingestion_date"]).collect()
    assert [r["updated_at"] for r in out] == ["2024-12-08T11:00:00Z"]


def test_order_is_by_instant_unless_text_is_asked_for(spark):
    early, late = "2024-12-08T12:00:00+05:00", "2024-12-08T09:00:00-05:00"
    df = history(spark, (1, "2024-12-08", early), (1, "2024-12-08", late))
    assert op.latest_by_id(df).first()["updated_at"] == late
    assert op.latest_by_id(df, text_order=True).first()["updated_at"] == early


def test_ties_are_stable(spark):
    df = spark.createDataFrame([(1, "t", v) for v in range(50)], "id long, updated_at string, v int")
    picks = {op.latest_by_id(df.repartition(n), text_order=True).first()["v"] for n in (1, 3, 7)}
    assert len(picks) == 1
    assert op.latest_by_id(df, ties=["v"], text_order=True).first()["v"] == 49


def test_missing_update_time_ranks_last(spark):
    df = history(spark, (1, "2024-12-08", None), (1, "2024-12-09", "2024-12-08T09:00:00Z"), (2, "2024-12-08", None))
    assert {(r["id"], r["ingestion_date"]) for r in op.latest_by_id(df).collect()} == {(1, "2024-12-09"), (2, "2024-12-08")}


def test_sold_is_listed_yesterday_and_missing_today(spark):
    t = "2024-12-01T00:00:00Z"
    df = history(spark, (1, "2024-12-08", t), (1, "2024-12-09", t), (2, "2024-12-08", t), (3, "2024-12-09", t))
    assert sold(df, "2024-12-09") == [2]


def test_relisting_does_not_undo_a_sale(spark):
    t = "2024-12-01T00:00:00Z"
    df = history(spark, (1, "2024-12-08", t), (2, "2024-12-09", t), (1, "2024-12-10", t))
    assert sold(df, "2024-12-09") == [1]
    assert sold(df, "2024-12-09", mode="latest_view") == [1]
    assert sold(df, "2024-12-10") == [2]


def test_no_snapshot_yesterday_means_nothing_sold(spark):
    t = "2024-12-01T00:00:00Z"
    df = history(spark, (1, "2024-12-06", t), (2, "2024-12-09", t))
    assert sold(df, "2024-12-09") == []
    assert op.last_available_day(df, "2024-12-09") == "2024-12-06"
    assert sold(df, "2024-12-09", yesterday="2024-12-06") == [1]


def test_null_ids_of_yesterday_are_kept(spark):
    df = history(spark, (None, "2024-12-08", "t"), (None, "2024-12-09", "t"))
    assert op.snapshot_diff(df, "2024-12-09", key=("store", "id")).count() == 1


def test_modes_and_bulk_diff_agree_with_brute_force(spark):
    rng = random.Random(7)
    days = [f"2024-12-{d:02d}" for d in range(1, 9)]
    for _ in range(3):
        values, listed = [], {}
        for i, day in enumerate(days):
            for id in range(12):
                if rng.random() < 0.6:
                    listed.setdefault(day, set()).add(id)
                    for _ in range(rng.choice((1, 1, 2))):
                        values.append((id, day, f"2024-12-{rng.randint(1, i + 1):02d}T00:00:00Z"))
        # Updates never go back, as the two modes require.
        newest = {}
        for n, (id, day, at) in enumerate(values):
            newest[id] = max(newest.get(id, ""), at)
            values[n] = (id, day, newest[id])
        df = history(spark, *values).cache()
        expected = {d: sorted(listed.get(y, set()) - listed.get(d, set())) for y, d in zip(days, days[1:])}
        for day, ids in expected.items():
            assert sold(df, day) == ids
            assert sold(df, day, mode="latest_view") == ids
        bulk = op.snapshot_diff_days(df, days[1:], ("store", "id")).collect()
        assert sorted((r["sold_date"], r["id"]) for r in bulk) == [(d, i) for d, ids in expected.items() for i in ids]
        df.unpersist()


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        op.snapshot_diff(history(spark), "2024-12-09", mode="x")


def test_incomplete_snapshot_is_refused(spark):
    df = history(spark, *[(i, "2024-12-08", "t") for i in range(10)], *[(i, "2024-12-09", "t") for i in range(4)])
    op.require_complete_day(df, "2024-12-09", "2024-12-08", 0.4)
    with pytest.raises(ValueError, match="incomplete"):
        op.require_complete_day(df, "2024-12-09", "2024-12-08", 0.5)


def one(spark, **columns):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in columns.items()])


@pytest.mark.parametrize("text,price", [("1.005", "1.01"), ("99", "99.00"), ("n/a", None), (None, None)])
def test_price_text(spark, text, price):
    df = spark.createDataFrame([([{"price": text}],)], "variants array<struct<price:string>>")
    value = df.select(fn.variant_price()).first()[0]
    assert (None if value is None else str(value)) == price


def test_price_of_no_variants(spark):
    df = spark.createDataFrame([([],), (None,)], "variants array<struct<price:string>>")
    assert [r[0] for r in df.select(fn.variant_price()).collect()] == [None, None]


def test_age_uses_the_date_in_its_own_zone(spark):
    df = one(spark, p="2024-11-20T23:30:00-05:00")
    assert df.select(fn.days_on_market("p", "2024-12-09")).first()[0] == 19
    assert one(spark, p="soon").select(fn.days_on_market("p", "2024-12-09")).first()[0] is None


def test_url_of_missing_handle(spark):
    df = spark.createDataFrame([("x",), (None,)], "handle string")
    assert [r[0] for r in df.select(fn.product_url("b/")).collect()] == ["b/x", None]


def test_attributes_of_sample_html(spark):
    row = op.extract_attributes(one(spark, body_html=BODY), "body_html", HTML_ATTRIBUTES).first().asDict()
    row.pop("body_html")
    assert {k: v for k, v in row.items() if v is not None} == {
        "condition": "Excellent", "condition_details": "Light wear to corners", "accessories": "Dust Bag",
        "height_inches": "9", "width_inches": "12", "depth_inches": "4", "exterior_color": "Brown",
    }


def test_unterminated_condition_loses_its_last_letter(spark):
    df = one(spark, body_html="<b>Condition:</b> Good")
    assert df.select(fn.extract_attribute("body_html", *HTML_ATTRIBUTES["condition"])).first()[0] == "Goo"


def test_stores_together_equal_stores_alone(spark):
    rows = [(i, f"h{i}", BODY, "2024-11-20T10:00:00Z", [{"price": "10"}], s.name) for i, s in enumerate(STORES)]
    df = spark.createDataFrame(
        rows, "id long, handle string, body_html string, published_at string, variants array<struct<price:string>>, store string"
    )
    together = op.enrich_stores(df, STORES, "2024-12-09").drop("variants")
    for spec in STORES:
        alone = op.enrich(df.where(F.col("store") == spec.name), spec, "2024-12-09").drop("variants")
        both = together.where(F.col("store") == spec.name).first()
        assert all(both[c] == alone.first()[c] for c in alone.columns)
        assert spec.attributes or both["condition"] is None


def test_guard(spark):
    new = spark.createDataFrame([(1,)], "id int")
    target = spark.createDataFrame([("2024-12-08",)], "sold_date string")
    assert op.incremental_guard(new, None, "2024-12-01").count() == 1
    assert op.incremental_guard(new, target.where("false"), "2024-12-01").count() == 1
    assert [op.incremental_guard(new, target, d).count() for d in ("2024-12-07", "2024-12-08", "2024-12-09")] == [0, 0, 1]
    assert [op.guard_passes(target, d) for d in ("2024-12-07", "2024-12-08", "2024-12-09")] == [False, False, True]
    assert op.guard_passes(target.where("false"), "2024-12-01")
    assert op.open_stores(target.withColumn("store", F.lit("a")), ["a", "b"], "2024-12-08") == ["b"]


def test_mart_unites_tables_of_different_width(spark):
    base = "id long, vendor string, title string, price decimal(10,2), days_on_market int, store string, sold_date string"
    a = spark.createDataFrame([(1, "v", "t", None, 1, "a", "d")], base)
    b = a.withColumn("condition", F.lit("Good"))
    assert op.sold_products_mart([a, b]).count() == 2
    with pytest.raises(ValueError):
        op.sold_products_mart([])
