"""Physical plans stay the ones intended: pruning, pushdown, few shuffles, no Python."""

import contextlib
import io
import re
import uuid

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from shelfmark import operators as op
from shelfmark import sources as src
from shelfmark.checks.adapters import EVENT_STORES, TODAY, listings, sold_view
from shelfmark.plans.daily import staged_day
from shelfmark.operators.quality import STAGING_NOT_NULL


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def tree(df) -> str:
    """The operator tree alone, with reused parts appearing once."""
    return plan(df).split("\n\n")[0]


def shuffles(df) -> int:
    return len(re.findall(r"Exchange \(", tree(df))) - len(re.findall(r"BroadcastExchange \(", tree(df)))


@pytest.fixture(scope="module")
def history(spark, sf_dir, tmp_path_factory):
    rows = listings(spark, sf_dir)
    name = f"history_{uuid.uuid4().hex}"
    src.ensure_table(spark, name, rows, path=str(tmp_path_factory.mktemp("history") / "t"))
    src.append_day(spark, name, src.cluster_by_vendor(rows, by=("store", "ingestion_date")))
    return spark.table(name)


@pytest.fixture
def no_broadcast(spark):
    """Plan joins as for sides too large to broadcast."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key in keys:
        spark.conf.unset(key)


NEEDED = ("id", "store", "vendor", "title", "price", "product_type", "days_on_market", "ingestion_date", "updated_at")


def diff(history):
    enriched = op.enrich_stores(history, EVENT_STORES, TODAY).select(*NEEDED)
    return op.project_sold(op.snapshot_diff(enriched, TODAY, key=("store", "id")))


def test_diff_reads_two_partitions_and_needed_columns(history):
    text = plan(diff(history))
    assert text.count("PartitionFilters: [isnotnull(ingestion_date") == 2
    assert "body_html" not in text and "handle" not in text
    assert "LeftAnti" in text and text.count("WindowGroupLimit") >= 2
    assert "price:string" in text


def test_diff_shuffles_each_side_once(history, no_broadcast):
    assert "SortMergeJoin LeftAnti" in tree(diff(history))
    assert shuffles(diff(history)) == 2


def test_bulk_diff_shuffles_each_side_once(history, no_broadcast):
    days = [f"2024-01-{d:02d}" for d in range(2, 31)]
    rows = op.snapshot_diff_days(history.select("store", "id", "vendor", "ingestion_date", "updated_at"), days, ("store", "id"))
    assert shuffles(rows) == 2


def test_dedup_limits_rows_before_the_shuffle(history):
    text = tree(op.latest_by_id(history.select("id", "updated_at", "vendor")))
    assert shuffles(op.latest_by_id(history.select("id", "updated_at", "vendor"))) == 1
    assert text.rindex("WindowGroupLimit") > text.index("Exchange")


def test_staging_checks_reuse_the_dedup_partitioning(history):
    staged = staged_day(history, EVENT_STORES, TODAY, TODAY, STAGING_NOT_NULL)
    checks = op.check_staging(staged, "s", key=("store", "id"))
    # One for the deduplication, one for the single result row.
    assert shuffles(checks) == 2
    assert "body_html" not in plan(checks)


def test_report_filters_reach_the_scan(spark, sf_dir, tmp_path):
    path = str(tmp_path / "sold")
    columns = ("id", "vendor", "title", "price", "days_on_market", "store", "sold_date")
    sold_view(spark, sf_dir, columns).where("sold_date >= '2001-01-01'").write.partitionBy("store", "sold_date").parquet(path)
    sold = spark.read.parquet(path)
    filtered = op.filter_sold(sold, (20000, 60000), (0, 700), ("2001-01-05", "2001-02-10"), "", None, "Brand#12")
    text = plan(op.sales_per_day(op.prepare_sold(filtered)))
    assert "GreaterThanOrEqual(price,20000" in text and "LessThan(price,60001" in text
    assert "EqualTo(vendor,Brand#12)" in text and "sold_date" in text.split("PartitionFilters")[1][:200]
    assert "id:bigint" not in text


def test_revenue_reads_two_columns(spark, sf_dir):
    rows = op.cast_price_int(sold_view(spark, sf_dir, ["sold_date", "price"], dates=True))
    text = plan(op.revenue_per_day(rows))
    assert "ReadSchema: struct<l_extendedprice:double,l_shipdate:timestamp_ntz>" in text
    assert shuffles(op.revenue_per_day(rows)) == 1


def test_guard_is_a_scalar_subquery(history):
    rows = history.select("id", "ingestion_date")
    text = plan(op.incremental_guard(rows, rows, TODAY, "ingestion_date"))
    assert "Subquery" in text and "Join" not in text


def test_not_in_needs_no_broadcast(history, no_broadcast, spark):
    seed = spark.range(100000).select(F.concat(F.lit("Brand#"), "id").alias("vendor"))
    text = tree(op.not_in_seed(history.select("id", "vendor"), "vendor", seed))
    assert "SortMergeJoin LeftAnti" in text and "NestedLoop" not in text


@pytest.mark.parametrize("name", sorted(entry_module.QUERIES))
def test_no_python_workers_and_no_products(spark, sf_dir, name):
    text = plan(entry_module.QUERIES[name](spark, sf_dir))
    for node in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct", "NestedLoopJoin"):
        assert node not in text, node
