import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark import operators as op
from shelfmark.operators import ranks


def quartiles(df, column="x"):
    return tuple(op.quartiles(df, column).first())


def frame(spark, values, kind):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}").repartition(5)


def expected(values):
    return tuple(float(v) for v in np.percentile(np.array([float(v) for v in values]), [25, 50, 75], method="linear"))


@pytest.fixture
def rounds(monkeypatch):
    """Many rounds on few rows: a rough sketch and nearly no list at the end."""
    monkeypatch.setattr(ranks, "ACCURACY", 200)
    monkeypatch.setattr(ranks, "LEFT", 10)


def test_doubles_by_rounds(spark, rounds):
    rng = random.Random(1)
    for values in (
        [rng.gauss(0, 1) * 10 ** rng.randint(-200, 200) for _ in range(1501)],
        [rng.choice((-1.5, 0.0, 2.5)) for _ in range(2000)],
        [7.25] * 1000 + [rng.random() for _ in range(999)],
        [float(i) for i in range(1, 5)],
        [3.5],
    ):
        found = quartiles(frame(spark, values, "double"))
        assert np.allclose(found, expected(values), rtol=1e-12, atol=0)


def test_64_bit_integers_and_decimals(spark, rounds):
    rng = random.Random(2)
    longs = [rng.randrange(-(2**52), 2**52) for _ in range(1500)] + [-(2**52)] * 700
    assert np.allclose(quartiles(frame(spark, longs, "long")), expected(longs), rtol=1e-12)
    for kind, digits in (("decimal(10,2)", 8), ("decimal(38,6)", 30)):
        decimals = [Decimal(rng.randrange(-(10**digits), 10**digits)).scaleb(-2) for _ in range(1200)]
        assert np.allclose(quartiles(frame(spark, decimals, kind)), expected(decimals), rtol=1e-12)


def test_no_long_list_in_a_task(spark, monkeypatch):
    """However many rows, what is sorted at the end is short."""
    seen = []
    narrow = ranks._narrow
    monkeypatch.setattr(ranks, "_narrow", lambda rows, open_: (seen.append([s.inside for s in open_]), narrow(rows, open_)))
    df = spark.range(400_000).select((F.col("id") * 1.5).alias("x"))
    total, least, around = ranks.values_at(df, "x", (0.25, 0.5, 0.75))
    assert (total, least) == (400_000, 0.0) and len(seen) == 1
    assert around[1][:2] == (199_999 * 1.5, 200_000 * 1.5)


def test_missing_values_do_not_count(spark):
    df = frame(spark, [1.0, None, float("nan"), 2.0, 4.0, 3.0], "double")
    assert quartiles(df) == (1.75, 2.5, 3.25)
    assert quartiles(df.where("x > 100 AND NOT isnan(x)")) == (None, None, None)
    row = op.box_stats(df.where("x IS NULL"), "x").first()
    assert row["box_min"] is None and row["iqr"] is None
    with pytest.raises(TypeError):
        op.quartiles(spark.createDataFrame([("a",)], "x string"), "x")


def test_wide_path_agrees_with_the_integer_path(spark):
    rng = random.Random(3)
    values = [rng.randrange(-50_000, 90_000) for _ in range(5000)]
    df = frame(spark, values, "int")
    for kind in ("long", "double", "decimal(12,2)"):
        wide = df.select(F.col("x").cast(kind).alias("x"))
        assert tuple(op.box_stats(wide, "x").first()) == tuple(op.box_stats(df, "x").first())
        assert op.box_outliers(wide, "x").count() == op.box_outliers(df, "x").count()


def test_outliers_of_a_decimal_price(spark):
    values = [Decimal("10.00")] * 20 + [Decimal("11.50")] * 20 + [Decimal("99.99"), Decimal("0.01")]
    found = op.box_outliers(frame(spark, values, "decimal(10,2)"), "x").collect()
    assert sorted(r["x"] for r in found) == [Decimal("0.01"), Decimal("99.99")]
