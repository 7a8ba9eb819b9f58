import contextlib
import io
import uuid

import pytest
from pyspark.sql import functions as F
from test_reports import sold_rows

from shelfmark import operators as op
from shelfmark import sources as src
from shelfmark.plans import dashboard
from shelfmark.schemas import SOLD_PARTITIONS
from shelfmark.sources import rollup as r


def bag(frame):
    return sorted(map(str, (tuple(x) for x in frame.collect())))


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture
def sold(spark, tmp_path):
    name = f"sold_{uuid.uuid4().hex}"
    rows, _ = sold_rows(spark)
    rows = rows.withColumn("store", F.when(F.col("id") % 3 == 0, "dct").otherwise("rebag"))
    src.ensure_table(spark, name, rows, SOLD_PARTITIONS, str(tmp_path / "sold"))
    src.append_day(spark, name, rows.where("id % 2 = 0"))
    src.attach_rollup(spark, name, f"rollup_{name}", str(tmp_path / "rollup"))
    return name, rows


def in_step(spark, name):
    kept = src.read_rollup(spark, name)
    return bag(kept) == bag(op.sold_partials(spark.table(name)).select(*kept.columns))


def test_every_write_keeps_the_rollup_in_step(spark, sold):
    name, rows = sold
    assert in_step(spark, name) and src.read_rollup(spark, name).count() > 0
    src.append_day(spark, name, rows.where("id % 2 = 1"))
    assert in_step(spark, name)
    src.append_day(spark, name, rows.limit(0))
    assert in_step(spark, name)
    drops = [(s, d) for s in ("rebag", "dct") for d in ("2024-12-03", "2024-12-04")]
    src.replace_days(spark, name, rows.where("sold_date = '2024-12-03' and vendor is null"), drops, "sold_date")
    assert in_step(spark, name)
    assert src.read_rollup(spark, name).where("sold_date = '2024-12-04'").count() == 0
    src.delete_days(spark, name, [("rebag", "2024-12-05"), ("rebag", "2030-01-01")], "sold_date")
    assert in_step(spark, name)
    src.drop_partitions(spark, name, [{"sold_date": "2024-12-06"}])
    assert in_step(spark, name)
    src.replace_day(spark, name, rows.where("sold_date = '2024-12-06' and store = 'dct'"), "2024-12-06", ["dct"], "sold_date")
    assert in_step(spark, name) and spark.table(name).where("sold_date = '2024-12-06'").count() > 0


def test_a_write_that_died_is_noticed_and_repaired(spark, sold, monkeypatch):
    name, rows = sold
    before = r._catch_up

    def dies(*_):
        raise InterruptedError

    for write in (
        lambda: src.append_day(spark, name, rows.where("id % 2 = 1")),
        lambda: src.replace_days(spark, name, rows.where("id < 0"), [("rebag", "2024-12-03")], "sold_date"),
    ):
        monkeypatch.setattr(r, "_catch_up", dies)
        with pytest.raises(InterruptedError):
            write()
        monkeypatch.setattr(r, "_catch_up", before)
        with pytest.raises(RuntimeError, match="behind"):
            src.read_rollup(spark, name)
        src.repair_rollup(spark, name)
        assert in_step(spark, name)
    # The next write catches up with what the last one left, then with its own.
    monkeypatch.setattr(r, "_catch_up", dies)
    with pytest.raises(InterruptedError):
        src.delete_days(spark, name, [("dct", "2024-12-02")], "sold_date")
    monkeypatch.setattr(r, "_catch_up", before)
    src.append_day(spark, name, rows.where("sold_date = '2024-12-07'"))
    assert in_step(spark, name)
    assert src.repair_rollup(spark, name) == 0


def test_a_change_recomputes_its_partitions_only(spark, sold, monkeypatch):
    name, rows = sold
    seen = []
    monkeypatch.setattr(op.aggregates, "sold_partials", lambda df, c: seen.append(plan(df)) or op.sold_partials(df, c))
    src.replace_days(spark, name, rows.where("id = -1"), [("dct", "2024-12-04")], "sold_date")
    assert len(seen) == 1 and "PartitionFilters" in seen[0] and "2024-12-04" in seen[0].split("PartitionFilters")[1].split("\n")[0]
    assert in_step(spark, name)


def test_detached_and_missing(spark, sold):
    name, rows = sold
    src.detach_rollup(spark, name)
    src.append_day(spark, name, rows.where("id % 2 = 1"))
    for call in (src.read_rollup, src.repair_rollup):
        with pytest.raises(LookupError):
            call(spark, name)
    src.attach_rollup(spark, name, f"rollup_{name}")
    assert in_step(spark, name)


@pytest.mark.parametrize("args", [{}, {"dates": ("2024-12-03", "2024-12-05")}, {"vendor": "Chanel"}, {"dates": (None, "2024-12-04"), "price": (None, None)}])
def test_page_from_the_rollup(spark, sold, args):
    name, _ = sold
    table = spark.table(name)
    kept, plain = dashboard(table, partials=src.read_rollup(spark, name), **args), dashboard(table, **args)
    frames = (
        "rollup", "bounds", "vendors", "row_count", "sales_by_weekday", "sales_per_day", "sales_per_day_vendor", "vendor_totals",
        "revenue_per_day", "products_by_vendor",
    )
    for frame in frames:
        assert bag(kept[frame]) == bag(plain[frame].select(*kept[frame].columns)), frame
        assert kept[frame].columns == plain[frame].columns
        assert f".{name} " not in plan(kept[frame])
    assert f".{name} " in plan(plain["row_count"]) and f".rollup_{name} " in plan(kept["row_count"])
    for page in (kept, plain):
        page["rollup"].unpersist()


def test_filters_on_rows_read_the_rows(spark, sold):
    name, _ = sold
    table = spark.table(name)
    for args in ({"price": (100, 4000)}, {"days": (0, 20)}, {"title": "flap"}, {"color": ""}):
        kept, plain = dashboard(table, partials=src.read_rollup(spark, name), **args), dashboard(table, **args)
        assert bag(kept["row_count"]) == bag(plain["row_count"])
        assert bag(kept["products_by_vendor"]) == bag(plain["products_by_vendor"])
