import contextlib
import io
import re
import uuid

import pytest
from pyspark.sql import functions as F

from shelfmark import operators as op
from shelfmark import sources as src
from shelfmark.checks.adapters import EVENT_STORES, TODAY, YESTERDAY, listings
from shelfmark.plans import advance_state, latest_state, merged_state, sold_from_state, state_versions

COLUMNS = ("id", "title", "vendor", "handle", "updated_at", "variants", "event_id", "store", "ingestion_date")
DAYS = [f"2024-01-{d:02d}" for d in range(10, 17)]


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture
def place(spark, tmp_path):
    tag = uuid.uuid4().hex
    return f"products_{tag}", f"state_{tag}", str(tmp_path / "products"), str(tmp_path / "state")


def land(spark, sf_dir, products, path, days, change=None):
    rows = listings(spark, sf_dir).select(*COLUMNS).where(F.col("ingestion_date").isin(days))
    rows = change(rows) if change else rows
    src.ensure_table(spark, products, rows, path=path)
    src.replace_days(spark, products, rows, [(s.name, d) for s in EVENT_STORES for d in days])


def recomputed(spark, products, until):
    history = spark.table(products).where(F.col("ingestion_date") <= until)
    return op.latest_by_id(history, ("store", "id"), ties=("ingestion_date",))


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_state_equals_the_recompute(spark, sf_dir, place):
    products, state, products_path, state_path = place
    options = {"path": state_path, "buckets": 4}
    bases = []
    for day in DAYS[:5]:
        land(spark, sf_dir, products, products_path, [day])
        bases.append(advance_state(spark, products, state, day, **options).base)
        assert same(latest_state(spark, state), recomputed(spark, products, day))
    assert bases == [None, *DAYS[:4]] and state_versions(spark, state) == DAYS[2:5]
    # The same day again, with other rows.
    land(spark, sf_dir, products, products_path, [DAYS[4]], lambda df: df.where("event_id % 3 <> 0").withColumn("vendor", F.lit("new")))
    assert advance_state(spark, products, state, DAYS[4], **options).base == DAYS[3]
    assert same(latest_state(spark, state), recomputed(spark, products, DAYS[4]))
    # An earlier day that is still kept, then one that is not.
    land(spark, sf_dir, products, products_path, [DAYS[3]], lambda df: df.where("event_id % 2 = 0"))
    again = advance_state(spark, products, state, DAYS[3], **options)
    assert (again.as_of, again.base) == (DAYS[4], DAYS[2])
    assert same(latest_state(spark, state), recomputed(spark, products, DAYS[4]))
    assert state_versions(spark, state) == [DAYS[2], DAYS[4]]
    land(spark, sf_dir, products, products_path, [DAYS[0]], lambda df: df.where("event_id % 2 = 1"))
    assert advance_state(spark, products, state, DAYS[0], **options).base is None
    assert same(latest_state(spark, state), recomputed(spark, products, DAYS[4]))
    # A day without any row, and days that were skipped.
    land(spark, sf_dir, products, products_path, DAYS[5:7])
    assert advance_state(spark, products, state, DAYS[6], **options).base == DAYS[4]
    assert same(latest_state(spark, state), recomputed(spark, products, DAYS[6]))
    with pytest.raises(LookupError):
        latest_state(spark, state, "2020-01-01")


def test_state_follows_new_columns(spark, sf_dir, place):
    products, state, products_path, state_path = place
    land(spark, sf_dir, products, products_path, DAYS[:1])
    advance_state(spark, products, state, DAYS[0], path=state_path, buckets=4)
    rows = listings(spark, sf_dir).select(*COLUMNS).where(F.col("ingestion_date") == DAYS[1]).withColumn("sku", F.col("handle"))
    src.replace_days(spark, products, rows, [(s.name, DAYS[1]) for s in EVENT_STORES], on_unknown="add")
    advance_state(spark, products, state, DAYS[1], path=state_path, buckets=4)
    assert same(latest_state(spark, state), recomputed(spark, products, DAYS[1]))
    assert latest_state(spark, state).where("sku IS NOT NULL").count() > 0


def test_advance_reads_one_day_and_the_state(spark, sf_dir, place):
    products, state, products_path, state_path = place
    for day in DAYS[:2]:
        land(spark, sf_dir, products, products_path, [day])
        advance_state(spark, products, state, day, path=state_path, buckets=4)
    merged = merged_state(spark, products, state, DAYS[0], DAYS[1])
    read = {f.split("/products/")[-1].split("/state/")[-1].rsplit("/", 1)[0] for f in merged.inputFiles()}
    assert "PartitionFilters" in plan(merged)
    files = merged.select(F.col("ingestion_date")).distinct().collect()
    assert read and files
    scans = re.findall(r"PartitionFilters: \[(.*?)\]\n", plan(merged))
    assert any("ingestion_date" in s and f"> {DAYS[0]}" in s for s in scans) and any(f"as_of" in s and DAYS[0] in s for s in scans)


def test_sold_from_state_is_the_latest_view_diff(spark, sf_dir, place):
    products, state, products_path, state_path = place
    days = [f"2024-01-{d:02d}" for d in range(1, 16)]
    land(spark, sf_dir, products, products_path, days)
    advance_state(spark, products, state, TODAY, path=state_path, buckets=4)
    found = sold_from_state(spark, state, TODAY, YESTERDAY)
    whole = op.snapshot_diff(spark.table(products), TODAY, YESTERDAY, ("store", "id"), mode="latest_view", ties=("ingestion_date",))
    assert found.count() > 0 and same(found, whole)


@pytest.fixture
def no_broadcast(spark):
    """Plan joins as for sides too large to broadcast."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key in keys:
        spark.conf.unset(key)


def bucketed(spark, sf_dir, tmp_path, days):
    rows = listings(spark, sf_dir).where(F.col("ingestion_date").isin(days))
    name = f"bucketed_{uuid.uuid4().hex}"
    src.ensure_table(spark, name, rows, path=str(tmp_path / name), buckets=4)
    src.append_day(spark, name, rows)
    return spark.table(name)


def test_diff_of_bucketed_days_shuffles_nothing(spark, sf_dir, tmp_path, no_broadcast):
    history = bucketed(spark, sf_dir, tmp_path, [YESTERDAY, TODAY])
    enriched = op.enrich_stores(history, EVENT_STORES, TODAY).select("id", "store", "title", "price", "event_id", "ingestion_date", "updated_at")
    gone = op.snapshot_diff(enriched, TODAY, key=("store", "id"), ties=("event_id",))
    tree = plan(gone).split("\n\n")[0]
    assert "SortMergeJoin LeftAnti" in tree and "Exchange" not in tree
    plain = listings(spark, sf_dir)
    same_rows = op.snapshot_diff(op.enrich_stores(plain, EVENT_STORES, TODAY).select(*enriched.columns), TODAY, key=("store", "id"), ties=("event_id",))
    assert gone.count() > 0 and same(gone, same_rows)


def test_bucketed_days_hold_one_file_per_bucket(spark, sf_dir, tmp_path):
    history = bucketed(spark, sf_dir, tmp_path, [TODAY])
    files = history.select(F.col("_metadata.file_path").alias("f"), "store").distinct().groupBy("store").count().collect()
    assert files and all(r["count"] <= 4 for r in files)


def test_advancing_shuffles_once(spark, sf_dir, tmp_path, place, no_broadcast):
    _, state, _, state_path = place
    history = bucketed(spark, sf_dir, tmp_path, DAYS[:2])
    history.createOrReplaceTempView(state + "_history")
    advance_state(spark, state + "_history", state, DAYS[0], path=state_path, buckets=4)
    merged = merged_state(spark, state + "_history", state, DAYS[0], DAYS[1])
    tree = plan(merged).split("\n\n")[0]
    assert "Union" in tree and tree.count("Exchange (") == 1
    # Each task sends one row per listing.
    assert tree.rindex("WindowGroupLimit") > tree.index("Exchange")
    assert same(merged, op.latest_by_id(history, ("store", "id"), ties=("ingestion_date",)))


def test_bucketed_daily_run(spark, tmp_path):
    """Pages to a bucketed products table and its sales, in which a replaced day stays dealt by listing."""
    from fixtures import product, write_page

    from shelfmark.plans import build_sold, land_days

    raw, tag = str(tmp_path / "raw"), uuid.uuid4().hex
    for store in ("vsp", "dct"):
        write_page(raw, store, "2024-12-09", "1.json", [product(i) for i in range(1, 40)])
        write_page(raw, store, "2024-12-10", "1.json", [product(i) for i in range(1, 30)])
    drops = [(s, d) for s in ("vsp", "dct") for d in ("2024-12-09", "2024-12-10")]
    for _ in range(2):
        landed = land_days(spark, raw, str(tmp_path / "base"), f"p_{tag}", drops, path=str(tmp_path / "p"), buckets=4)
    assert sum(landed.values()) == 2 * (39 + 29)
    assert build_sold(spark, f"p_{tag}", f"s_{tag}", "2024-12-10", path=str(tmp_path / "s")) == 20
