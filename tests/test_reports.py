import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark import functions as fn
from shelfmark import operators as op
from shelfmark.plans import dashboard

SOLD = (
    "id long, vendor string, title string, price decimal(10,2), condition string, exterior_color string, "
    "product_type string, days_on_market int, store string, sold_date string"
)


def sold_rows(spark, n=300, seed=1):
    rng = random.Random(seed)
    rows = [
        (
            i, rng.choice(["Chanel", "Chanel", "Hermès", None]), rng.choice(["Flap CHLOÉ", "Tote", None]),
            Decimal(rng.randint(-100, 900000)) / 100, rng.choice(["Good", "Fair", None]),
            rng.choice(["Brown", "dark brown", "Black", None]), rng.choice(["Bag", "Bag", "Wallet", None]),
            rng.choice([None, *range(-5, 60)]), "rebag", f"2024-12-{rng.randint(2, 7):02d}",
        )
        for i in range(n)
    ]
    return spark.createDataFrame(rows, SOLD), rows


@pytest.mark.parametrize("values", [[1, 2, 3, 4], [5], [7, 7, 7], [-3, 0, 70000, 200000, -70000], list(range(0, 400000, 1777))])
def test_quartiles_equal_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v int")
    assert list(op.quartiles(df, "v").first()) == list(np.percentile(values, [25, 50, 75]))


def test_quartiles_of_many_blocks_and_hot_values(spark):
    rng = random.Random(3)
    values = [rng.randint(-(2**31), 2**31 - 1) for _ in range(2000)] + [12345] * 1000 + [2**31 - 1, -(2**31)]
    for take in (3001, 3002, 1999, 1998):
        df = spark.createDataFrame([(v,) for v in values[:take]], "v int")
        assert list(op.quartiles(df, "v").first()) == list(np.percentile(values[:take], [25, 50, 75]))


def test_quartiles_need_numbers(spark):
    assert tuple(op.quartiles(spark.range(3), "id").first()) == (0.5, 1.0, 1.5)
    with pytest.raises(TypeError):
        op.quartiles(spark.range(3).selectExpr("string(id) AS id"), "id")


def test_box_minimum_replaces_a_negative_limit(spark):
    df = spark.createDataFrame([(v,) for v in (10, 11, 12, 13, 100)], "v int")
    row = op.box_stats(df, "v").first()
    assert (row["box_min"], row["box_max"], row["iqr"]) == (8.0, 16.0, 2.0)
    wide = spark.createDataFrame([(v,) for v in (1, 5, 50, 90)], "v int")
    row = op.box_stats(wide, "v").first()
    assert row["lower_fence"] < 0 and row["box_min"] == 1.0
    assert [r["v"] for r in op.box_outliers(df, "v").collect()] == [100]


def test_box_of_nothing_is_one_row_of_nulls(spark):
    df = spark.createDataFrame([], "v int")
    assert [tuple(r) for r in op.box_stats(df, "v").collect()] == [(None,) * 7]
    assert op.box_outliers(df, "v").count() == 0


def test_filter_on_stored_and_prepared_tables_agree(spark):
    df, rows = sold_rows(spark)
    prepared = op.cast_sold_date(op.cast_price_int(df))
    for price in [(None, None), (0, 5000), (-1, 10), (100, None), (None, -1), (10.5, 20.5), (0, 0)]:
        for days in [None, (0, 30)]:
            args = dict(price=price, days=days, dates=("2024-12-03", "2024-12-05"))
            a = sorted(r["id"] for r in op.filter_range(df, **args).collect())
            b = sorted(r["id"] for r in op.filter_range(prepared, **args).collect())
            low, high = price
            want = sorted(
                r[0] for r in rows
                if (low is None or int(r[3]) >= low) and (high is None or int(r[3]) <= high)
                and r[7] is not None and (days is None or days[0] <= r[7] <= days[1])
                and "2024-12-03" <= r[9] <= "2024-12-05"
            )
            assert a == b == want


def test_text_filters(spark):
    df, rows = sold_rows(spark)
    assert op.filter_title(df, "chloé").count() == sum(r[2] == "Flap CHLOÉ" for r in rows)
    assert op.filter_title(df, "").count() == sum(r[2] is not None for r in rows)
    assert op.filter_color(df, "BROWN$").count() == sum(r[5] in ("Brown", "dark brown") for r in rows)
    assert op.filter_color(df, "").count() == sum(r[5] is not None for r in rows)
    assert op.filter_vendor(df, "All").count() == len(rows)


def test_weekdays_are_complete_and_ordered(spark):
    df, rows = sold_rows(spark)
    got = op.sales_by_weekday(op.prepare_sold(df)).collect()
    assert [r["day_of_week"] for r in got] == list(op.WEEKDAYS)
    assert sum(r["sales_count"] for r in got) == len(rows) and got[6]["sales_count"] == 0
    empty = op.sales_by_weekday(op.prepare_sold(df.where("false"))).collect()
    assert [r["sales_count"] for r in empty] == [0] * 7


def test_null_keys_are_dropped_and_ties_ordered(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("c",)], "vendor string")
    assert [tuple(r) for r in op.products_by_vendor(df).collect()] == [("c", 2), ("a", 1), ("b", 1)]


def test_daily_vendor_counts_sum_up(spark):
    df, _ = sold_rows(spark)
    prepared = op.prepare_sold(df)
    per_day = {r["sold_date"]: r["sales_count"] for r in op.sales_per_day(prepared.where("vendor is not null")).collect()}
    by_vendor = op.sales_per_day_vendor(prepared).groupBy("sold_date").agg(F.sum("sales_count").alias("n")).collect()
    assert {r["sold_date"]: r["n"] for r in by_vendor} == per_day


def test_dashboard_equals_separate_reports(spark):
    df, _ = sold_rows(spark)
    args = dict(price=(0, 8000), title="", color="")
    page = dashboard(df, **args)
    rows = op.prepare_sold(op.filter_sold(df, **args))

    def bag(frame):
        return sorted(map(str, (tuple(r) for r in frame.collect())))

    assert "id" not in page["rows"].columns and "store" not in page["rows"].columns
    assert page["row_count"].first()["row_count"] == rows.count()
    assert bag(page["sales_by_weekday"]) == bag(op.sales_by_weekday(rows))
    assert bag(page["sales_per_day"].drop("label")) == bag(op.sales_per_day(rows))
    assert bag(page["sales_per_day_vendor"].drop("label")) == bag(op.sales_per_day_vendor(rows))
    assert bag(page["vendor_totals"]) == bag(op.vendor_totals(op.sales_per_day_vendor(rows)))
    assert bag(page["revenue_per_day"].drop("label")) == bag(op.revenue_per_day(rows))
    assert bag(page["products_by_vendor"]) == bag(op.products_by_vendor(rows))
    assert page["price_vs_type"].count() == rows.where("product_type is not null").count()
    assert page["price_vs_condition"].count() == rows.where("condition is not null").count()
    assert page["sales_by_color_day"].agg(F.sum("bags_sold")).first()[0] == rows.count()
    page["rollup"].unpersist()


def test_category_ranks(spark):
    values = ["x"] * 5 + ["y"] * 3 + ["a"] * 3 + ["z"] + [None] * 9
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "product_type string, price int")
    got = {r["product_type"]: (r["count"], r["rank"]) for r in op.ordered_category(df, "product_type").collect()}
    assert got == {"x": (5, 1), "a": (3, 2), "y": (3, 3), "z": (1, 4)}
    points = op.points(df, "product_type", order_by_count=True).collect()
    assert len(points) == 12 and all(r["rank"] == got[r["product_type"]][1] for r in points)


# (amount, label) by hand: both thresholds, ties to the even digit, doubles just below a tie, negatives.
LABELS = [
    (0.0, "$0"), (0.5, "$0"), (1.5, "$2"), (2.5, "$2"), (999.4, "$999"), (999.5, "$1000"), (-3.0, "$-3"),
    (1000.0, "$1K"), (1499.0, "$1K"), (1500.0, "$2K"), (2500.0, "$2K"), (3500.0, "$4K"), (999499.0, "$999K"),
    (999500.0, "$1000K"), (1000000.0, "$1.0M"), (1049999.0, "$1.0M"), (1050000.0, "$1.1M"), (1150000.0, "$1.1M"),
    (1250000.0, "$1.2M"), (1350000.0, "$1.4M"), (2250000.0, "$2.2M"), (12345678901.0, "$12345.7M"), (-1234567.0, "$-1234567"),
]


def test_currency_labels(spark):
    df = spark.createDataFrame([(a,) for a, _ in LABELS], "x double")
    assert {r["x"]: r["label"] for r in df.select("x", fn.currency_label("x").alias("label")).collect()} == dict(LABELS)
    assert spark.createDataFrame([(None,)], "x double").select(fn.currency_label("x")).first()[0] is None
