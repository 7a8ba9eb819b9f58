import pytest

from shelfmark import operators as op


def frame(spark, values, name="vendor"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


@pytest.mark.parametrize(
    "values,seed,outside",
    [
        (["a", "b", None], ["a"], ["b"]),
        (["a", "b", None], ["a", None], []),
        (["a", None], [], ["a", None]),
        (["b", "b"], ["a", "a"], ["b", "b"]),
    ],
)
def test_not_in_follows_sql(spark, values, seed, outside):
    df, listed = frame(spark, values), frame(spark, seed, "allowed")
    got = [r[0] for r in op.not_in_seed(df, "vendor", listed, "allowed").collect()]
    df.createOrReplaceTempView("v")
    listed.createOrReplaceTempView("l")
    sql = [r[0] for r in spark.sql("SELECT * FROM v WHERE vendor NOT IN (SELECT allowed FROM l)").collect()]
    assert sorted(got, key=str) == sorted(sql, key=str) == sorted(outside, key=str)


def test_invalid_vendors_are_distinct(spark):
    got = op.dq_valid_vendors(frame(spark, ["x", "x", None, "a"]), "vendor", frame(spark, ["a"]))
    assert [r[0] for r in got.collect()] == ["x"]


def test_not_null_and_unique(spark):
    df = spark.createDataFrame([(1, None), (1, "x"), (None, None), (None, "y")], "id long, title string")
    assert {r["column"]: r["failures"] for r in op.dq_not_null(df, "m", ["id", "title"]).collect()} == {"id": 2, "title": 2}
    assert op.dq_unique(df, "m").first()["failures"] == 1
    assert op.dq_unique(df.where("id is null"), "m").first()["failures"] == 0


def test_gate(spark):
    df = spark.createDataFrame([(1, "x")], "id long, title string")
    op.dq_gate([op.dq_not_null(df, "m", ["id"]), op.dq_unique(df, "m")])
    with pytest.raises(op.DataQualityError, match="m.id unique: 1"):
        op.dq_gate([op.dq_unique(df.union(df), "m")])


def test_coverage_grid_has_an_open_end(spark):
    grid = op.coverage_grid(spark, ["a", "b"], "2024-12-30", "2025-01-02")
    assert sorted((r["store"], str(r["day"])) for r in grid.collect()) == [
        (s, d) for s in "ab" for d in ("2024-12-30", "2024-12-31", "2025-01-01")
    ]
    assert op.coverage_grid(spark, ["a"], "2025-01-01", "2025-01-01").count() == 0
    assert op.coverage_grid(spark, [], "2025-01-01", "2025-01-05").count() == 0


def test_start_gate_and_missing_drops(spark):
    grid = op.coverage_grid(spark, ["a", "b", "c"], "2024-12-01", "2024-12-04")
    gated = op.store_start_gate(grid, {"a": "2024-12-03", "b": "2024-11-01"})
    assert {r["store"]: r["count"] for r in gated.groupBy("store").count().collect()} == {"a": 1, "b": 3, "c": 3}
    landed = gated.where("store <> 'a'").union(gated.where("store = 'b'"))
    assert [(r["store"], str(r["day"])) for r in op.missing_drops(gated, landed).collect()] == [("a", "2024-12-03")]
