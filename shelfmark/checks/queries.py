"""One query per operator, over the benchmark tables, each with its SQL twin."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark import functions as fn
from shelfmark import operators as op
from shelfmark import plans
from shelfmark import sources as src
from shelfmark.checks import oracle as o
from shelfmark.checks.adapters import EVENT_STORES, TODAY, YESTERDAY, body_html, listings, sold_view, table
from shelfmark.schemas import SOLD_PARTITIONS
from shelfmark.session import scratch_path
from shelfmark.stores import HTML_ATTRIBUTES

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


def _report(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Sold products as reports see them, only the columns asked for."""
    df = sold_view(spark, sf_dir, columns, dates=True)
    return op.cast_price_int(df) if "price" in columns else df


LISTING_TIES = ("ingestion_date", "event_id")
SOLD_INPUT = (
    "id", "event_id", "store", "vendor", "title", "price", "product_type", "condition", "exterior_color",
    "days_on_market", "ingestion_date", "updated_at",
)


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.enrich_stores(listings(spark, sf_dir), EVENT_STORES, TODAY)


def _gone(spark: SparkSession, sf_dir: str, today: str = TODAY, mode: str = "per_day") -> DataFrame:
    rows = _staged(spark, sf_dir).select(*SOLD_INPUT)
    return op.snapshot_diff(rows, today, key=("store", "id"), mode=mode, ties=("event_id",))


# Sources, sinks and table maintenance


def _pages(spark: SparkSession, sf_dir: str) -> str:
    """Write all listings as pages of up to 250 (event ids are unique); returns the folder."""
    rows = listings(spark, sf_dir)
    product = F.struct(*[c for c in rows.columns if c not in ("event_id", "store", "ingestion_date")])
    page = F.floor(F.col("event_id") / 250)
    path = scratch_path(spark, "pages")
    rows.groupBy(page.alias("page")).agg(F.collect_list(product).alias("products")).select("products").write.json(path)
    return path


@query(
    "read_raw_json",
    o.with_(
        o.LISTINGS,
        select="SELECT id, title, handle, vendor, product_type, published_at, updated_at, first_price FROM listings",
    ),
)
def read_raw_json(spark, sf_dir):
    rows = src.read_raw_json(spark, _pages(spark, sf_dir), multi_line=False)
    return rows.select(
        "id", "title", "handle", "vendor", "product_type", "published_at", "updated_at",
        F.get("variants", F.lit(0))["price"].alias("first_price"),
    )


@query(
    "flatten_nested",
    o.with_(
        o.LISTINGS,
        select="SELECT event_id, title AS seo__title, handle AS seo__slug__handle, store AS seo__slug__store, "
        "ingestion_date FROM listings",
    ),
)
def flatten_nested(spark, sf_dir):
    slug = F.struct("handle", "store").alias("slug")
    nested = listings(spark, sf_dir).select("event_id", F.struct("title", slug).alias("seo"), "ingestion_date")
    return src.flatten_nested(nested, sep="__")


@query(
    "concat_pages",
    o.with_(
        o.LISTINGS,
        select="SELECT event_id, id, title, CASE WHEN store <> 'click' THEN vendor END AS vendor FROM listings",
    ),
)
def concat_pages(spark, sf_dir):
    rows = listings(spark, sf_dir)
    with_vendor = rows.where("store <> 'click'").select("event_id", "id", "title", "vendor")
    without = rows.where("store = 'click'").select("title", "id", "event_id")
    return src.concat_pages([with_vendor, without])


@query("cluster_by_vendor", o.with_(o.LISTINGS, select="SELECT event_id, vendor, title FROM listings"))
def cluster_by_vendor(spark, sf_dir):
    return src.cluster_by_vendor(listings(spark, sf_dir).select("event_id", "vendor", "title"))


def _base(spark: SparkSession, sf_dir: str) -> str:
    rows = listings(spark, sf_dir).select("event_id", "id", "vendor", "updated_at", "store", "ingestion_date")
    root = scratch_path(spark, "base")
    src.write_base_parquet(src.cluster_by_vendor(rows, by=("store", "ingestion_date")), root)
    return root


def _drops(spark: SparkSession, sf_dir: str) -> list[tuple[str, str]]:
    days = table(spark, sf_dir, "events").select("event_type", F.to_date("ts").cast("string").alias("day")).distinct()
    return [(r["event_type"], r["day"]) for r in days.collect()]


_BASE_COLUMNS = "SELECT event_id, id, vendor, updated_at, store, ingestion_date FROM listings"


@query("write_base_parquet", o.with_(o.LISTINGS, select=_BASE_COLUMNS))
def write_base_parquet(spark, sf_dir):
    root = _base(spark, sf_dir)
    return spark.read.parquet(root).withColumn("ingestion_date", F.col("ingestion_date").cast("string"))


@query("read_base_parquet", o.with_(o.LISTINGS, select=_BASE_COLUMNS))
def read_base_parquet(spark, sf_dir):
    """Every drop by itself, united."""
    root = _base(spark, sf_dir)
    days = [
        src.read_base_parquet(spark, root, store, day).select(
            "event_id", "id", "vendor", "updated_at", F.lit(store).alias("store"), F.lit(day).alias("ingestion_date")
        )
        for store, day in _drops(spark, sf_dir)
    ]
    return reduce(DataFrame.unionByName, days)


@query("read_base_days", o.with_(o.LISTINGS, select=_BASE_COLUMNS))
def read_base_days(spark, sf_dir):
    return src.read_base_days(spark, _base(spark, sf_dir), _drops(spark, sf_dir))


@query(
    "purge_base_day",
    o.with_(o.LISTINGS, select=_BASE_COLUMNS + " WHERE NOT (store = 'click' AND ingestion_date = '2024-01-01')"),
)
def purge_base_day(spark, sf_dir):
    root = _base(spark, sf_dir)
    src.purge_base_day(spark, root, "click", "2024-01-01")
    return spark.read.parquet(root).withColumn("ingestion_date", F.col("ingestion_date").cast("string"))


@query("stamp_ingestion_date", f"SELECT c_custkey, c_name, '{TODAY}' AS ingestion_date FROM customer")
def stamp_ingestion_date(spark, sf_dir):
    return src.stamp_ingestion_date(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), TODAY)


_TABLE_COLUMNS = ("event_id", "id", "vendor", "price", "store", "ingestion_date")


def _products_table(spark: SparkSession, sf_dir: str, load: bool = True) -> tuple[str, DataFrame]:
    """A new table below the shared folder, with all listings unless ``load`` is off."""
    rows = _staged(spark, sf_dir).select(*_TABLE_COLUMNS)
    name = f"products_{uuid.uuid4().hex}"
    src.ensure_table(spark, name, rows, path=scratch_path(spark, "products"))
    if load:
        src.append_day(spark, name, src.cluster_by_vendor(rows, by=("store", "ingestion_date")))
    return name, rows


_TABLE_ROWS = "SELECT event_id, id, vendor, price, store, ingestion_date FROM staged"


@query(
    "ensure_table",
    "SELECT false AS created_again, CAST(0 AS BIGINT) AS n_before, count(*) AS n_after FROM events",
)
def ensure_table(spark, sf_dir):
    name, rows = _products_table(spark, sf_dir, load=False)
    again = src.ensure_table(spark, name, rows)
    before = src.audit_counts(spark, name)
    src.append_day(spark, name, rows)
    return spark.table(name).agg(
        F.lit(again).alias("created_again"), F.lit(before).cast("bigint").alias("n_before"),
        F.count(F.lit(1)).alias("n_after"),
    )


@query("limit_zero", o.with_(o.LISTINGS, o.staged(), select=_TABLE_ROWS))
def limit_zero(spark, sf_dir):
    """The empty table's schema alone, and all rows brought into it."""
    name, rows = _products_table(spark, sf_dir, load=False)
    empty = spark.table(name)
    return empty.unionByName(src.align_to_table(rows, empty.schema))


@query("append_day", o.with_(o.LISTINGS, o.staged(), select=_TABLE_ROWS))
def append_day(spark, sf_dir):
    return spark.table(_products_table(spark, sf_dir)[0])


@query(
    "append_day_drift",
    o.with_(
        o.LISTINGS,
        select="SELECT event_id, first_price AS price, handle AS sku, CASE WHEN event_id % 2 = 0 THEN store END AS shop, store, "
        "ingestion_date FROM listings",
    ),
)
def append_day_drift(spark, sf_dir):
    """Two halves whose variants have other fields in another order, appended one after the other."""
    rows = listings(spark, sf_dir)
    price, sku = F.get("variants", F.lit(0))["price"].alias("price"), F.col("handle").alias("sku")
    keys = [F.col("store"), F.col("ingestion_date")]
    even = rows.where("event_id % 2 = 0").select("event_id", F.array(F.struct(price, sku, F.col("store").alias("shop"))).alias("variants"), *keys)
    odd = rows.where("event_id % 2 <> 0").select("event_id", F.array(F.struct(sku, price)).alias("variants"), *keys)
    name = f"drift_{uuid.uuid4().hex}"
    src.ensure_table(spark, name, even, path=scratch_path(spark, "drift"))
    for half in (even, odd):
        src.append_day(spark, name, half)
    first = F.get("variants", F.lit(0))
    return spark.table(name).select("event_id", first["price"].alias("price"), first["sku"].alias("sku"), first["shop"].alias("shop"), *keys)


@query("scan_table", o.with_(o.LISTINGS, o.staged(), select=_TABLE_ROWS))
def scan_table(spark, sf_dir):
    return src.scan_table(spark, _products_table(spark, sf_dir)[0])


@query(
    "delete_day",
    o.with_(o.LISTINGS, o.staged(), select=_TABLE_ROWS + f" WHERE NOT (ingestion_date = '{TODAY}' AND store IN ('click', 'view'))"),
)
def delete_day(spark, sf_dir):
    name, _ = _products_table(spark, sf_dir)
    src.delete_day(spark, name, TODAY, ["click", "view"])
    return spark.table(name)


@query(
    "replace_day",
    o.with_(
        o.LISTINGS,
        o.staged(),
        select=f"SELECT event_id, id, CASE WHEN ingestion_date = '{TODAY}' THEN 'replaced' ELSE vendor END AS vendor, "
        f"price, store, ingestion_date FROM staged WHERE NOT (ingestion_date = '{TODAY}' AND store = 'view')",
    ),
)
def replace_day(spark, sf_dir):
    """Replace a day twice; one shop has no rows in the replacement."""
    name, rows = _products_table(spark, sf_dir)
    new = rows.where((F.col("ingestion_date") == TODAY) & (F.col("store") != "view"))
    new = new.withColumn("vendor", F.lit("replaced"))
    for _ in range(2):
        src.replace_day(spark, name, new, TODAY, [s.name for s in EVENT_STORES])
    return spark.table(name)


@query(
    "audit_counts",
    f"SELECT count(*) FILTER (WHERE d) AS old, count(*) FILTER (WHERE d AND s) AS new, "
    f"count(*) FILTER (WHERE d AND s) AS written, count(*) FILTER (WHERE NOT d OR s) AS total FROM "
    f"(SELECT strftime(ts, '%Y-%m-%d') = '{TODAY}' AS d, event_type <> 'view' AS s FROM events)",
)
def audit_counts(spark, sf_dir):
    name, rows = _products_table(spark, sf_dir)
    new = rows.where((F.col("ingestion_date") == TODAY) & (F.col("store") != "view"))
    counts = src.replace_day(spark, name, new, TODAY, [s.name for s in EVENT_STORES])
    total = src.audit_counts(spark, name)
    return spark.createDataFrame([(*counts, total)], "old long, new long, written long, total long")


@query("load_seed", "SELECT DISTINCT p_brand AS vendor FROM part")
def load_seed(spark, sf_dir):
    path = scratch_path(spark, "seed")
    src.export_csv(table(spark, sf_dir, "part").select(F.col("p_brand").alias("vendor")).distinct(), path)
    return src.load_seed(spark, path)


@query("materialize_view", o.with_(o.LISTINGS, o.staged(), select="SELECT event_id, price, url, days_on_market FROM staged"))
def materialize_view(spark, sf_dir):
    src.materialize_view(_staged(spark, sf_dir), "stg_events__products")
    return spark.table("stg_events__products").select("event_id", "price", "url", "days_on_market")


def _gone_sql(select: str, today: str = TODAY, yesterday: str = YESTERDAY) -> str:
    return o.with_(*o.diff(today, yesterday), o.staged(TODAY, "gone"), select=select)


_SOLD_SQL = "SELECT id, vendor, title, price, product_type, days_on_market, store, sold_date FROM staged"
_SOLD_EXT_SQL = (
    "SELECT id, vendor, title, price, condition, exterior_color, product_type, days_on_market, store, sold_date FROM staged"
)


@query(
    "materialize_incremental",
    "SELECT * FROM (" + _gone_sql(_SOLD_SQL) + ") UNION ALL SELECT * FROM ("
    + _gone_sql(_SOLD_SQL, "2024-01-16", TODAY) + ")",
)
def materialize_incremental(spark, sf_dir):
    """Append a day, the same day again, an earlier day and the next day; two of them count."""
    name, path = f"sold_{uuid.uuid4().hex}", scratch_path(spark, "sold")
    for day in (TODAY, TODAY, "2024-01-10", "2024-01-16"):
        rows = op.project_sold(_gone(spark, sf_dir, day))
        src.materialize_incremental(spark, name, rows, day, path=path)
    return spark.table(name)


# Pages by drop, some of them bad, with fields that only some listings have

_PAGE_SIZE = 50
_PAGED_SQL = (
    f"paged AS (SELECT *, event_id // {_PAGE_SIZE} AS page FROM listings)",
    "graded AS (SELECT *, CASE WHEN page % 7 = 3 THEN 'not JSON' WHEN page % 11 = 5 THEN 'no list of products' END AS reason FROM paged)",
)


def _drop_pages(spark: SparkSession, sf_dir: str) -> str:
    """Write every drop as pages, one per line, in folders named key=value; returns the folder.

    Every seventh page is cut off, every eleventh has no listings; fields vary from listing to listing.
    """
    rows = listings(spark, sf_dir)
    even, third = F.col("event_id") % 2 == 0, F.col("event_id") % 3 == 0
    price = F.get("variants", F.lit(0))["price"].alias("price")
    product = F.struct(
        *[c for c in rows.columns if c not in ("event_id", "store", "ingestion_date", "variants")],
        F.array(F.struct(price, F.when(third, F.col("handle")).alias("sku"))).alias("variants"),
        F.struct(F.struct(F.when(even, F.col("handle")).alias("handle")).alias("slug")).alias("seo"),
        F.when(third, F.col("id")).alias("stock"),
    )
    page = F.floor(F.col("event_id") / _PAGE_SIZE)
    text = F.to_json(F.struct(F.collect_list(product).alias("products")))
    pages = rows.groupBy("store", "ingestion_date", page.alias("page")).agg(text.alias("whole"))
    cut = F.expr("left(whole, length(whole) - 9)")
    value = F.when(F.col("page") % 7 == 3, cut).when(F.col("page") % 11 == 5, F.lit('{"items": []}')).otherwise(F.col("whole"))
    day = F.to_date("ingestion_date")
    path = scratch_path(spark, "drops")
    folders = {"year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day)}
    pages.select(value.alias("value"), "store", *[c.alias(n) for n, c in folders.items()]).write.partitionBy("store", *folders).text(path)
    return f"{path}/*/*/*/*"


@query(
    "read_pages",
    o.with_(
        o.LISTINGS,
        *_PAGED_SQL,
        select="SELECT store, ingestion_date, id, title, handle, vendor, product_type, published_at, updated_at, first_price, "
        "CASE WHEN event_id % 2 = 0 THEN handle END AS slug, CASE WHEN event_id % 3 = 0 THEN handle END AS sku, "
        "CASE WHEN event_id % 3 = 0 THEN id END AS stock FROM graded WHERE reason IS NULL",
    ),
)
def read_pages(spark, sf_dir):
    """One scan: typed columns, and fields of some listings out of the VARIANT."""
    rows = src.read_pages(spark, _drop_pages(spark, sf_dir), multi_line=False, glob="*.txt")
    rows = src.lift_fields(rows, [("seo.slug.handle", "string"), ("stock", "bigint")])
    first = F.get("variants", F.lit(0))["price"].alias("first_price")
    sku = F.try_variant_get("other", "$.variants[0].sku", "string").alias("sku")
    return rows.select(
        "store", "ingestion_date", "id", "title", "handle", "vendor", "product_type", "published_at", "updated_at", first,
        F.col("`seo.slug.handle`").alias("slug"), sku, "stock",
    )


@query(
    "quarantine_counts",
    o.with_(
        o.LISTINGS,
        *_PAGED_SQL,
        select="SELECT store, ingestion_date, count(DISTINCT page) AS pages, count(DISTINCT page) FILTER (WHERE reason IS NOT NULL) AS bad, "
        "count(*) FILTER (WHERE reason IS NULL) AS listings FROM graded GROUP BY 1, 2",
    ),
)
def quarantine_counts(spark, sf_dir):
    return src.page_counts(spark, _drop_pages(spark, sf_dir), multi_line=False, glob="*.txt")


@query(
    "bad_pages",
    o.with_(
        o.LISTINGS,
        *_PAGED_SQL,
        select="SELECT store, ingestion_date, reason, count(DISTINCT page) AS pages FROM graded WHERE reason IS NOT NULL GROUP BY 1, 2, 3",
    ),
)
def bad_pages(spark, sf_dir):
    """Bad pages put aside and read back."""
    root = scratch_path(spark, "quarantine")
    src.quarantine(src.bad_pages(spark, _drop_pages(spark, sf_dir), multi_line=False, glob="*.txt"), root)
    return src.quarantined(spark, root).groupBy("store", "ingestion_date", "reason").agg(F.count(F.lit(1)).alias("pages"))


@query(
    "append_day_added",
    o.with_(
        o.LISTINGS,
        select="SELECT event_id, vendor, CASE WHEN event_id % 2 <> 0 THEN handle END AS sku, CASE WHEN event_id % 2 <> 0 THEN id END AS stock, "
        "store, ingestion_date FROM listings",
    ),
)
def append_day_added(spark, sf_dir):
    """The second half of the rows brings two columns that the table gets then."""
    rows = listings(spark, sf_dir)
    even = rows.where("event_id % 2 = 0").select("event_id", "vendor", "store", "ingestion_date")
    odd = rows.where("event_id % 2 <> 0").select("event_id", F.col("handle").alias("sku"), "vendor", F.col("id").alias("stock"), "store", "ingestion_date")
    name = f"added_{uuid.uuid4().hex}"
    src.ensure_table(spark, name, even, path=scratch_path(spark, "added"))
    src.append_day(spark, name, even)
    src.append_day(spark, name, odd, on_unknown="add")
    return spark.table(name)


@query(
    "append_day_other",
    o.with_(
        o.LISTINGS,
        select="SELECT event_id, first_price AS price, CASE WHEN event_id % 2 <> 0 THEN handle END AS sku, "
        "CASE WHEN event_id % 2 <> 0 THEN vendor END AS maker, store, ingestion_date FROM listings",
    ),
)
def append_day_other(spark, sf_dir):
    """The second half brings a column and a nested field, kept in the VARIANT column."""
    rows = listings(spark, sf_dir)
    price = F.get("variants", F.lit(0))["price"].alias("price")
    keys = [F.col("store"), F.col("ingestion_date")]
    even = rows.where("event_id % 2 = 0").select("event_id", F.array(F.struct(price)).alias("variants"), *keys)
    wider = F.array(F.struct(F.col("handle").alias("sku"), price)).alias("variants")
    odd = rows.where("event_id % 2 <> 0").select("event_id", wider, F.col("vendor").alias("maker"), *keys)
    name = f"other_{uuid.uuid4().hex}"
    src.ensure_table(spark, name, even, path=scratch_path(spark, "other"))
    for half in (even, odd):
        src.append_day(spark, name, half, on_unknown="other")
    sku = F.try_variant_get("other", "$.variants[0].sku", "string").alias("sku")
    maker = F.try_variant_get("other", "$.maker", "string").alias("maker")
    return spark.table(name).select("event_id", F.get("variants", F.lit(0))["price"].alias("price"), sku, maker, *keys)


@query(
    "delete_days",
    o.with_(o.LISTINGS, o.staged(), select=_TABLE_ROWS + " WHERE NOT (store IN ('click', 'view') AND ingestion_date >= '2024-01-10')"),
)
def delete_days(spark, sf_dir):
    """Many days of two shops in one catalog statement."""
    name, _ = _products_table(spark, sf_dir)
    src.delete_days(spark, name, [(s, d) for s, d in _drops(spark, sf_dir) if s in ("click", "view") and d >= "2024-01-10"])
    return spark.table(name)


_STATE_COLUMNS = ("event_id", "id", "title", "vendor", "handle", "updated_at", "store", "ingestion_date")


def _bucketed_products(spark: SparkSession, sf_dir: str, rows: DataFrame) -> str:
    name = f"bucketed_{uuid.uuid4().hex}"
    src.ensure_table(spark, name, rows, path=scratch_path(spark, "bucketed"), buckets=8)
    return name


@query(
    "latest_state",
    o.with_(
        o.LISTINGS,
        f"landed AS (SELECT * REPLACE (CASE WHEN ingestion_date = '{TODAY}' THEN 'replaced' ELSE vendor END AS vendor) FROM listings)",
        o.latest("landed", "store, id"),
        select="SELECT event_id, id, title, vendor, handle, updated_at, store, ingestion_date FROM latest",
    ),
)
def latest_state(spark, sf_dir):
    """Advanced in the middle, at the end, and after a day in between was landed again."""
    rows = listings(spark, sf_dir).select(*_STATE_COLUMNS)
    days = sorted({d for _, d in _drops(spark, sf_dir)})
    products = _bucketed_products(spark, sf_dir, rows)
    state, path = f"state_{uuid.uuid4().hex}", scratch_path(spark, "state")
    src.append_day(spark, products, rows.where(F.col("ingestion_date") < TODAY))
    plans.advance_state(spark, products, state, YESTERDAY, path=path, buckets=8)
    src.append_day(spark, products, rows.where(F.col("ingestion_date") >= TODAY))
    plans.advance_state(spark, products, state, days[-1], path=path, buckets=8)
    again = rows.where(F.col("ingestion_date") == TODAY).withColumn("vendor", F.lit("replaced"))
    src.replace_days(spark, products, again, [(s.name, TODAY) for s in EVENT_STORES])
    plans.advance_state(spark, products, state, TODAY, path=path, buckets=8)
    return plans.latest_state(spark, state)


@query("sold_from_state", o.with_(
    o.LISTINGS,
    f"seen AS (SELECT * FROM listings WHERE ingestion_date <= '{TODAY}')",
    o.latest("seen", "store, id"),
    select=f"SELECT event_id, id, title, vendor, store, ingestion_date, '{TODAY}' AS sold_date FROM latest WHERE ingestion_date = '{YESTERDAY}'",
))
def sold_from_state(spark, sf_dir):
    rows = listings(spark, sf_dir).select(*_STATE_COLUMNS)
    products = _bucketed_products(spark, sf_dir, rows)
    state, path = f"state_{uuid.uuid4().hex}", scratch_path(spark, "state")
    src.append_day(spark, products, rows)
    for day in (YESTERDAY, TODAY):
        plans.advance_state(spark, products, state, day, path=path, buckets=8)
    gone = plans.sold_from_state(spark, state, TODAY, YESTERDAY)
    return gone.select("event_id", "id", "title", "vendor", "store", "ingestion_date", "sold_date")


@query("snapshot_diff_bucketed", _gone_sql("SELECT event_id, id, title, vendor, store, ingestion_date, sold_date FROM staged"))
def snapshot_diff_bucketed(spark, sf_dir):
    """The diff over a table whose days are dealt by listing: no shuffle."""
    rows = listings(spark, sf_dir).select(*_STATE_COLUMNS)
    products = _bucketed_products(spark, sf_dir, rows)
    src.append_day(spark, products, rows)
    gone = op.snapshot_diff(spark.table(products), TODAY, key=("store", "id"), ties=("event_id",))
    return gone.select("event_id", "id", "title", "vendor", "store", "ingestion_date", "sold_date")


@query(
    "day_path",
    "SELECT event_type || '/' || year(ts) || '/' || month(ts) || '/' || day(ts) AS path, count(*) AS n "
    "FROM events GROUP BY 1",
)
def day_path(spark, sf_dir):
    path = src.day_path_column("event_type", F.to_date("ts")).alias("path")
    return table(spark, sf_dir, "events").groupBy(path).agg(F.count(F.lit(1)).alias("n"))


@query(
    "export_csv",
    o.with_(o.SOLD, select="SELECT CAST(id AS VARCHAR) AS id, vendor, title, CAST(price AS VARCHAR) AS price, sold_date FROM sold"),
)
def export_csv(spark, sf_dir):
    path = scratch_path(spark, "export")
    src.export_csv(sold_view(spark, sf_dir, ["id", "vendor", "title", "price", "sold_date"]), path)
    return spark.read.option("header", True).csv(path)


_FEEDS_SQL = (
    "feeds AS (SELECT event_type || '-' || user_id AS store, min(CAST(ts AS DATE)) AS first_day, "
    "max(CAST(ts AS DATE)) AS last_day FROM events GROUP BY 1), "
    "grid AS (SELECT store, CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS day FROM feeds)"
)


def _feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every listing of every shop as a daily feed from its first to its last day."""
    events = table(spark, sf_dir, "events")
    day = F.to_date("ts")
    feed = F.concat_ws("-", "event_type", F.col("user_id").cast("string"))
    return events.groupBy(feed.alias("store")).agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def _feed_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = op.expand_days(_feeds(spark, sf_dir), F.col("first_day"), F.date_add("last_day", 1))
    return days.select("store", "day")


@query("expand_days", f"WITH {_FEEDS_SQL} SELECT store, day FROM grid")
def expand_days(spark, sf_dir):
    return _feed_grid(spark, sf_dir)


@query(
    "coverage_grid",
    "WITH span AS (SELECT min(CAST(ts AS DATE)) AS a, max(CAST(ts AS DATE)) AS b FROM events), "
    "shops AS (SELECT DISTINCT event_type AS store FROM events) "
    "SELECT store, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM shops, span",
)
def coverage_grid(spark, sf_dir):
    """Every shop of the events on every day from the first to the last."""
    day = F.to_date("ts")
    facts = table(spark, sf_dir, "events").agg(F.collect_set("event_type").alias("shops"), F.min(day).alias("a"), F.max(day).alias("b")).first()
    return op.coverage_grid(spark, facts["shops"], str(facts["a"]), str(facts["b"] + dt.timedelta(days=1)))


@query(
    "missing_drops",
    f"WITH {_FEEDS_SQL} SELECT store, day FROM grid WHERE NOT EXISTS (SELECT 1 FROM events "
    "WHERE event_type || '-' || user_id = store AND CAST(ts AS DATE) = day)",
)
def missing_drops(spark, sf_dir):
    feed = F.concat_ws("-", "event_type", F.col("user_id").cast("string"))
    landed = table(spark, sf_dir, "events").select(feed.alias("store"), F.to_date("ts").alias("day"))
    return op.missing_drops(_feed_grid(spark, sf_dir), landed)


_SPAN_SQL = (
    "span AS (SELECT min(CAST(ts AS DATE)) AS a, max(CAST(ts AS DATE)) AS b FROM events), "
    "grid AS (SELECT store, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day "
    "FROM (SELECT DISTINCT event_type AS store FROM events), span)"
)


def _store_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every shop by every day of the history."""
    events = table(spark, sf_dir, "events")
    day = F.to_date("ts")
    span = events.agg(F.struct(F.min(day).alias("first"), F.date_add(F.max(day), 1).alias("end")).alias("span")).scalar()
    stores = events.select(F.col("event_type").alias("store")).distinct()
    return op.expand_days(stores, span["first"], span["end"])


@query("grid_cross", f"WITH {_SPAN_SQL} SELECT store, day FROM grid")
def grid_cross(spark, sf_dir):
    return _store_grid(spark, sf_dir)


@query(
    "store_start_gate",
    f"WITH {_SPAN_SQL} SELECT store, day FROM grid WHERE day >= CASE store "
    + " ".join(f"WHEN '{s.name}' THEN DATE '{s.start_date}'" for s in EVENT_STORES) + " END",
)
def store_start_gate(spark, sf_dir):
    return op.store_start_gate(_store_grid(spark, sf_dir), {s.name: s.start_date for s in EVENT_STORES})


# Staging: deduplication and enrichment


@query(
    "latest_by_id",
    o.with_(o.LISTINGS, o.latest("listings", "id"), select="SELECT event_id, id, vendor, updated_at, ingestion_date FROM latest"),
)
def latest_by_id(spark, sf_dir):
    rows = listings(spark, sf_dir).select("event_id", "id", "vendor", "updated_at", "ingestion_date")
    return op.latest_by_id(rows, ["id"], "updated_at", LISTING_TIES)


@query(
    "latest_by_id_per_day",
    o.with_(
        o.LISTINGS,
        o.latest("listings", "store, id, ingestion_date"),
        select="SELECT event_id, store, id, ingestion_date, title FROM latest",
    ),
)
def latest_by_id_per_day(spark, sf_dir):
    rows = listings(spark, sf_dir).select("event_id", "store", "id", "ingestion_date", "updated_at", "title")
    return op.latest_by_id(rows, ["store", "id", "ingestion_date"], "updated_at", ["event_id"]).drop("updated_at")


@query(
    "stage",
    o.with_(
        o.LISTINGS,
        o.latest("listings", "store, id"),
        o.staged(TODAY, "latest"),
        select="SELECT event_id, id, store, price, url, days_on_market, " + ", ".join(HTML_ATTRIBUTES) + " FROM staged",
    ),
)
def stage(spark, sf_dir):
    """The staging models of all shops, united."""
    history = listings(spark, sf_dir)
    base = ["event_id", "id", "store", "price", "url", "days_on_market"]
    models = [
        op.stage(history.where(F.col("store") == s.name), s, TODAY, LISTING_TIES, columns=[*base, *s.attributes]) for s in EVENT_STORES
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), models).select(*base, *HTML_ATTRIBUTES)


@query(
    "project_star_plus",
    o.with_(
        o.LISTINGS,
        o.staged(),
        select="SELECT event_id, id, title, handle, vendor, product_type, published_at, updated_at, store, "
        "ingestion_date, price, url, days_on_market, " + ", ".join(HTML_ATTRIBUTES) + " FROM staged",
    ),
)
def project_star_plus(spark, sf_dir):
    return _staged(spark, sf_dir).drop("variants", "body_html")


@query("tag_store", "SELECT p_partkey, p_name, 'vsp' AS store FROM part")
def tag_store(spark, sf_dir):
    return op.tag_store(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "vsp")


@query("variant_price", o.with_(o.LISTINGS, select="SELECT event_id, CAST(first_price AS DECIMAL(10,2)) AS price FROM listings"))
def variant_price(spark, sf_dir):
    return listings(spark, sf_dir).select("event_id", fn.variant_price().alias("price"))


@query("product_url", "SELECT c_custkey, 'https://shop.example.com/products/' || c_name AS url FROM customer")
def product_url(spark, sf_dir):
    url = fn.product_url("https://shop.example.com/products/", "c_name").alias("url")
    return table(spark, sf_dir, "customer").select("c_custkey", url)


@query(
    "days_on_market",
    o.with_(o.LISTINGS, select=f"SELECT event_id, {o._age('2024-02-01')} AS days_on_market FROM listings"),
)
def days_on_market(spark, sf_dir):
    return listings(spark, sf_dir).select("event_id", fn.days_on_market("published_at", "2024-02-01").alias("days_on_market"))


_LINE_HTML = f"lines AS (SELECT l_orderkey, l_linenumber, {o.body_html('(l_partkey + l_suppkey)')} AS body_html FROM lineitem)"


def _line_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    return rows.select("l_orderkey", "l_linenumber", body_html("l_partkey + l_suppkey").alias("body_html"))


@query("extract_attributes", o.with_(_LINE_HTML, select=f"SELECT l_orderkey, l_linenumber, {o.ATTRIBUTES} FROM lines"))
def extract_attributes(spark, sf_dir):
    return op.extract_attributes(_line_html(spark, sf_dir), "body_html", HTML_ATTRIBUTES).drop("body_html")


def _attribute_query(attribute: str) -> None:
    pattern, group = HTML_ATTRIBUTES[attribute]
    sql = o.with_(
        _LINE_HTML, select=f"SELECT l_orderkey, l_linenumber, {o._attribute(pattern, group)} AS {attribute} FROM lines"
    )

    @query(f"attr_{attribute}", sql)
    def attr(spark, sf_dir):
        value = fn.extract_attribute("body_html", pattern, group).alias(attribute)
        return _line_html(spark, sf_dir).select("l_orderkey", "l_linenumber", value)


for _name in HTML_ATTRIBUTES:
    _attribute_query(_name)


_PAGE_PATTERNS = {
    "lang": (r'<html lang="([a-z]+)"', 1),
    "heading": (r"<h1>([^<]+)</h1>", 1),
    "described": (r'<meta name="description" content="([^"]+)"', 1),
}


@query(
    "no_match_is_null",
    "SELECT page_id, " + ", ".join(
        f"nullif(regexp_extract(html, '{p}', {g}), '') AS {n}" for n, (p, g) in _PAGE_PATTERNS.items()
    ) + " FROM pages",
)
def no_match_is_null(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    return op.extract_attributes(pages, "html", _PAGE_PATTERNS).drop("html")


# Sold products


@query(
    "filter_snapshot_day",
    o.with_(o.LISTINGS, select=f"SELECT event_id, store, id, ingestion_date FROM listings WHERE ingestion_date = '{TODAY}'"),
)
def filter_snapshot_day(spark, sf_dir):
    return op.filter_snapshot_day(listings(spark, sf_dir), TODAY).select("event_id", "store", "id", "ingestion_date")


@query("snapshot_diff", _gone_sql("SELECT event_id, " + _SOLD_EXT_SQL.removeprefix("SELECT ")))
def snapshot_diff(spark, sf_dir):
    return _gone(spark, sf_dir).drop("ingestion_date", "updated_at")


@query(
    "snapshot_diff_latest_view",
    o.with_(
        o.LISTINGS,
        f"seen AS (SELECT * FROM listings WHERE ingestion_date <= '{TODAY}')",
        o.latest("seen", "store, id"),
        f"y AS (SELECT * FROM latest WHERE ingestion_date = '{YESTERDAY}')",
        f"t AS (SELECT * FROM latest WHERE ingestion_date = '{TODAY}')",
        f"gone AS (SELECT y.*, '{TODAY}' AS sold_date FROM y LEFT JOIN t ON y.store = t.store AND y.id = t.id WHERE t.id IS NULL)",
        o.staged(TODAY, "gone"),
        select="SELECT event_id, " + _SOLD_EXT_SQL.removeprefix("SELECT "),
    ),
)
def snapshot_diff_latest_view(spark, sf_dir):
    return _gone(spark, sf_dir, mode="latest_view").drop("ingestion_date", "updated_at")


@query(
    "snapshot_diff_days",
    o.with_(
        o.LISTINGS,
        "span AS (SELECT min(CAST(ingestion_date AS DATE)) AS a, max(CAST(ingestion_date AS DATE)) AS b FROM listings)",
        o.latest("listings", "store, id, ingestion_date"),
        select="SELECT latest.event_id, latest.store, latest.id, latest.vendor, "
        "strftime(CAST(latest.ingestion_date AS DATE) + 1, '%Y-%m-%d') AS sold_date FROM latest, span "
        "WHERE CAST(latest.ingestion_date AS DATE) < b AND NOT EXISTS (SELECT 1 FROM listings n WHERE n.store = latest.store "
        "AND n.id = latest.id AND CAST(n.ingestion_date AS DATE) = CAST(latest.ingestion_date AS DATE) + 1)",
    ),
)
def snapshot_diff_days(spark, sf_dir):
    """Every day of the history at once."""
    day = F.to_date("ts")
    span = table(spark, sf_dir, "events").agg(F.min(day).alias("a"), F.max(day).alias("b")).first()
    days = [str(span["a"] + dt.timedelta(days=n)) for n in range(1, (span["b"] - span["a"]).days + 1)]
    rows = listings(spark, sf_dir).select("event_id", "store", "id", "vendor", "ingestion_date", "updated_at")
    gone = op.snapshot_diff_days(rows, days, ("store", "id"), ties=("event_id",))
    return gone.drop("ingestion_date", "updated_at")


@query(
    "rebuild_sold",
    o.with_(
        o.LISTINGS,
        f"kept AS (SELECT * FROM listings WHERE NOT (store = 'click' AND ingestion_date = '{TODAY}'))",
        o.latest("kept", "store, id, ingestion_date"),
        select="SELECT id, store, vendor, strftime(CAST(ingestion_date AS DATE) + 1, '%Y-%m-%d') AS sold_date FROM latest l "
        "WHERE EXISTS (SELECT 1 FROM kept d WHERE d.store = l.store AND CAST(d.ingestion_date AS DATE) = CAST(l.ingestion_date AS DATE) + 1) "
        "AND NOT EXISTS (SELECT 1 FROM kept n WHERE n.store = l.store AND n.id = l.id "
        "AND CAST(n.ingestion_date AS DATE) = CAST(l.ingestion_date AS DATE) + 1)",
    ),
)
def rebuild_sold(spark, sf_dir):
    """Sales of every day; one shop has no snapshot on one day and sells nothing then."""
    rows = listings(spark, sf_dir).where(~((F.col("store") == "click") & (F.col("ingestion_date") == TODAY))).drop("event_id")
    products, sold = (f"{kind}_{uuid.uuid4().hex}" for kind in ("products", "sold"))
    src.ensure_table(spark, products, rows, path=scratch_path(spark, "products"))
    src.append_day(spark, products, src.cluster_by_vendor(rows, by=("store", "ingestion_date")))
    span = table(spark, sf_dir, "events").agg(F.min(F.to_date("ts")).alias("a"), F.max(F.to_date("ts")).alias("b")).first()
    days = [str(span["a"] + dt.timedelta(days=n)) for n in range(1, (span["b"] - span["a"]).days + 1)]
    plans.rebuild_sold(spark, products, sold, days, EVENT_STORES, path=scratch_path(spark, "sold"))
    return spark.table(sold).select("id", "store", "vendor", "sold_date")


@query("project_sold", _gone_sql(_SOLD_SQL))
def project_sold(spark, sf_dir):
    return op.project_sold(_gone(spark, sf_dir))


@query("project_sold_ext", _gone_sql(_SOLD_EXT_SQL))
def project_sold_ext(spark, sf_dir):
    return op.project_sold_ext(_gone(spark, sf_dir))


@query("project_mart", _gone_sql("SELECT vendor, title, price, days_on_market, store, sold_date FROM staged"))
def project_mart(spark, sf_dir):
    return op.project_mart(_gone(spark, sf_dir))


@query(
    "incremental_guard",
    o.with_(
        o.LISTINGS,
        select="SELECT event_id, store, ingestion_date FROM listings WHERE "
        "'2024-01-31' > (SELECT coalesce(max(ingestion_date), '1970-01-01') FROM listings)",
    ),
)
def incremental_guard(spark, sf_dir):
    """A day after the stored maximum passes; one equal to it adds nothing."""
    rows = listings(spark, sf_dir).select("event_id", "store", "ingestion_date")
    passed = op.incremental_guard(rows, rows, "2024-01-31", "ingestion_date")
    return passed.unionByName(op.incremental_guard(rows, rows, "2024-01-30", "ingestion_date"))


@query(
    "coalesce_default",
    o.with_(
        o.LISTINGS,
        select="SELECT event_type AS store, coalesce(max(strftime(ts, '%Y-%m-%d')) FILTER (WHERE value > 300), '1970-01-01') "
        "AS latest FROM events GROUP BY 1 UNION ALL SELECT 'none', "
        "coalesce(max(ingestion_date), '1970-01-01') FROM listings WHERE id < 0",
    ),
)
def coalesce_default(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("store"),
        F.when(F.col("value") > 300, F.date_format("ts", "yyyy-MM-dd")).alias("sold_date"),
        "user_id",
    )
    latest = op.latest_or_never().alias("latest")
    none = rows.where("user_id < 0").agg(latest).select(F.lit("none").alias("store"), "latest")
    return rows.groupBy("store").agg(latest).unionByName(none)


@query(
    "sold_products_mart",
    o.with_(o.LISTINGS, o.staged(), select="SELECT vendor, title, price, days_on_market, store, ingestion_date AS sold_date FROM staged"),
)
def sold_products_mart(spark, sf_dir):
    """One scan: the sold tables of all shops are one table with a column for the shop."""
    rows = op.enrich_stores(listings(spark, sf_dir), EVENT_STORES, TODAY)
    return op.sold_products_mart([rows.withColumnRenamed("ingestion_date", "sold_date")])


# Data quality

_STAGED_LATEST = (o.LISTINGS, o.latest("listings", "store, id"), o.staged(TODAY, "latest"))


@query("dq_not_null", o.with_(*_STAGED_LATEST, select=o.not_null("staged", "stg_events", o.STAGING_COLUMNS)))
def dq_not_null(spark, sf_dir):
    columns = list(o.STAGING_COLUMNS)
    rows = _staged(spark, sf_dir).select("store", "updated_at", "event_id", *columns)
    return op.dq_not_null(op.latest_by_id(rows, ("store", "id"), "updated_at", LISTING_TIES), "stg_events", columns)


@query(
    "check_staging",
    o.with_(
        *_STAGED_LATEST,
        select=o.not_null("staged", "stg_events", o.STAGING_COLUMNS)
        + " UNION ALL SELECT 'stg_events', 'unique', 'id', count(*) FROM "
        "(SELECT 1 FROM staged GROUP BY store, id HAVING count(*) > 1)",
    ),
)
def check_staging(spark, sf_dir):
    """All checks of a staging model, one shuffle."""
    rows = _staged(spark, sf_dir).select("store", "updated_at", "event_id", *o.STAGING_COLUMNS)
    latest = op.latest_by_id(rows, ("store", "id"), "updated_at", LISTING_TIES)
    return op.check_staging(latest, "stg_events", o.STAGING_COLUMNS, ("store", "id"))


@query(
    "dq_unique",
    "SELECT 'events' AS model, 'unique' AS \"check\", 'user_id' AS \"column\", count(*) AS failures FROM "
    "(SELECT user_id FROM events GROUP BY 1 HAVING count(*) > 1) UNION ALL "
    "SELECT 'events', 'unique', 'event_id', count(*) FROM (SELECT event_id FROM events GROUP BY 1 HAVING count(*) > 1)",
)
def dq_unique(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return op.dq_unique(events, "events", "user_id").unionByName(op.dq_unique(events, "events", "event_id"))


@query(
    "duplicate_keys",
    "SELECT l_orderkey * 10 + l_linenumber AS id, count(*) AS n_records FROM lineitem GROUP BY 1 HAVING count(*) > 1",
)
def duplicate_keys(spark, sf_dir):
    return op.duplicate_keys(sold_view(spark, sf_dir, ["id"]), "id")


def _brand_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whitelist: the brands sorting below ``Brand#20``."""
    return table(spark, sf_dir, "part").where("p_brand < 'Brand#20'").select(F.col("p_brand").alias("vendor"))


@query(
    "not_in_seed",
    o.with_(
        o.LISTINGS,
        select="SELECT event_id, vendor FROM listings WHERE vendor NOT IN (SELECT p_brand FROM part WHERE p_brand < 'Brand#20')",
    ),
)
def not_in_seed(spark, sf_dir):
    rows = listings(spark, sf_dir).select("event_id", "vendor")
    return op.not_in_seed(rows, "vendor", _brand_seed(spark, sf_dir))


@query(
    "not_in_seed_with_null",
    o.with_(
        o.LISTINGS,
        select="SELECT event_id, vendor FROM listings WHERE vendor NOT IN (SELECT nullif(p_brand, 'Brand#7') FROM part)",
    ),
)
def not_in_seed_with_null(spark, sf_dir):
    rows = listings(spark, sf_dir).select("event_id", "vendor")
    seed = table(spark, sf_dir, "part").select(F.nullif("p_brand", F.lit("Brand#7")).alias("vendor"))
    return op.not_in_seed(rows, "vendor", seed)


_INVALID_SQL = (
    "SELECT DISTINCT vendor FROM listings WHERE vendor NOT IN (SELECT p_brand FROM part WHERE p_brand < 'Brand#20')"
)


@query("dq_valid_vendors", o.with_(o.LISTINGS, select=_INVALID_SQL))
def dq_valid_vendors(spark, sf_dir):
    return op.dq_valid_vendors(listings(spark, sf_dir), "vendor", _brand_seed(spark, sf_dir))


@query("select_distinct", o.with_(o.LISTINGS, select="SELECT DISTINCT vendor FROM listings"))
def select_distinct(spark, sf_dir):
    return listings(spark, sf_dir).select("vendor").distinct()


@query(
    "dq_gate",
    o.with_(
        o.LISTINGS, o.staged(), o.SOLD,
        select="SELECT * FROM (" + o.not_null("staged", "stg_events", o.STAGING_COLUMNS)
        + " UNION ALL " + o.not_null("sold", "sold", o.SOLD_CHECKS) + " UNION ALL "
        + o.not_null("sold", "mart", o.MART_CHECKS) + ") WHERE failures > 0",
    ),
)
def dq_gate(spark, sf_dir):
    """Failing checks of three models, from the error that the gate raises on them."""
    staged = op.dq_not_null(_staged(spark, sf_dir), "stg_events", o.STAGING_COLUMNS)
    sold = sold_view(spark, sf_dir, ["id", "vendor", "title", "price", "product_type", "days_on_market", "sold_date"])
    failed = []
    try:
        op.dq_gate([staged, op.check_sold(sold, "sold"), op.check_mart(sold, "mart")])
    except op.DataQualityError as error:
        failed = error.failures
    return spark.createDataFrame([tuple(r) for r in failed], "model string, check string, column string, failures long")


# Report preparation and filters

_REPORT_SQL = "SELECT vendor, title, price, days_on_market, sold_date FROM report"
_REPORT_COLUMNS = ("vendor", "title", "price", "days_on_market", "sold_date")


@query("cast_price_int", o.with_(o.SOLD, select="SELECT id, CAST(trunc(price) AS INTEGER) AS price FROM sold"))
def cast_price_int(spark, sf_dir):
    return op.cast_price_int(sold_view(spark, sf_dir, ["id", "price"]))


@query("cast_sold_date", o.with_(o.SOLD, select="SELECT id, CAST(sold_date AS DATE) AS sold_date FROM sold"))
def cast_sold_date(spark, sf_dir):
    return op.cast_sold_date(sold_view(spark, sf_dir, ["id", "sold_date"]))


@query("to_date_only", o.with_(o.LISTINGS, select="SELECT event_id, CAST(substr(published_at, 1, 10) AS DATE) AS day FROM listings"))
def to_date_only(spark, sf_dir):
    return listings(spark, sf_dir).select("event_id", fn.zone_local_date("published_at").alias("day"))


@query("drop_columns", o.with_(o.SOLD, select="SELECT vendor, title, price FROM sold"))
def drop_columns(spark, sf_dir):
    return op.drop_columns(sold_view(spark, sf_dir, ["id", "store", "vendor", "title", "price"]))


_PRICE, _DAYS, _DATES = (20000, 60000), (-500, 700), ("1996-03-01", "2000-02-29")
_RANGE_SQL = (
    f" WHERE price BETWEEN {_PRICE[0]} AND {_PRICE[1]} AND days_on_market BETWEEN {_DAYS[0]} AND {_DAYS[1]} "
    f"AND sold_date BETWEEN DATE '{_DATES[0]}' AND DATE '{_DATES[1]}'"
)


def _prepared(df: DataFrame) -> DataFrame:
    return op.cast_sold_date(op.cast_price_int(df))


@query("filter_range", o.with_(o.REPORT, select=_REPORT_SQL + _RANGE_SQL))
def filter_range(spark, sf_dir):
    return _prepared(op.filter_range(sold_view(spark, sf_dir, _REPORT_COLUMNS), _PRICE, _DAYS, _DATES))


@query("filter_title", o.with_(o.REPORT, select="SELECT title, price FROM report WHERE regexp_matches(title, '(?i)RING|^hot')"))
def filter_title(spark, sf_dir):
    return op.cast_price_int(op.filter_title(sold_view(spark, sf_dir, ["title", "price"]), "RING|^hot"))


@query(
    "filter_color",
    o.with_(o.REPORT, select="SELECT exterior_color, price FROM report WHERE regexp_matches(exterior_color, '(?i)RED|L.')"),
)
def filter_color(spark, sf_dir):
    return op.cast_price_int(op.filter_color(sold_view(spark, sf_dir, ["exterior_color", "price"]), "RED|L."))


@query("filter_color_empty", o.with_(o.REPORT, select="SELECT exterior_color, price FROM report WHERE exterior_color IS NOT NULL"))
def filter_color_empty(spark, sf_dir):
    return op.cast_price_int(op.filter_color(sold_view(spark, sf_dir, ["exterior_color", "price"]), ""))


@query("filter_vendor", o.with_(o.REPORT, select=_REPORT_SQL + " WHERE vendor = 'Brand#12'"))
def filter_vendor(spark, sf_dir):
    return _prepared(op.filter_vendor(sold_view(spark, sf_dir, _REPORT_COLUMNS), "Brand#12"))


@query(
    "filter_sold",
    o.with_(
        o.REPORT,
        select=_REPORT_SQL + _RANGE_SQL + " AND regexp_matches(title, '(?i)ring') AND vendor = 'Brand#12' "
        "AND regexp_matches(exterior_color, '(?i)e')",
    ),
)
def filter_sold(spark, sf_dir):
    rows = sold_view(spark, sf_dir, (*_REPORT_COLUMNS, "exterior_color"))
    return _prepared(op.filter_sold(rows, _PRICE, _DAYS, _DATES, "ring", "E", "Brand#12").drop("exterior_color"))


# Reports

_BY_DAY = "SELECT sold_date, count(*) AS sales_count FROM report GROUP BY 1"
_BY_DAY_VENDOR = "SELECT sold_date, vendor, count(*) AS sales_count FROM report GROUP BY 1, 2"


@query(
    "sales_by_weekday",
    o.with_(
        o.REPORT, "days AS (SELECT dayname(sold_date) AS day_of_week, count(*) AS n FROM report GROUP BY 1)",
        select=f"SELECT spine.day_of_week, coalesce(n, 0) AS sales_count FROM {o.WEEKDAY_SPINE} LEFT JOIN days USING (day_of_week)",
    ),
)
def sales_by_weekday(spark, sf_dir):
    return op.sales_by_weekday(_report(spark, sf_dir, "sold_date"))


_BY_NAME_SQL = "by_name AS (SELECT dayname(o_orderdate) AS day_of_week, count(*) AS n FROM orders GROUP BY 1)"


@query(
    "weekday_spine",
    o.with_(
        _BY_NAME_SQL,
        select=f"SELECT ord, spine.day_of_week, coalesce(n, 0) AS sales_count FROM {o.WEEKDAY_SPINE} "
        "LEFT JOIN by_name USING (day_of_week)",
    ),
)
def weekday_spine(spark, sf_dir):
    name = fn.weekday_name("o_orderdate")
    orders = table(spark, sf_dir, "orders")
    return op.weekday_spine(orders.groupBy(name.alias("day_of_week")).agg(F.count(F.lit(1)).alias("sales_count")))


@query(
    "order_weekday",
    o.with_(
        o.REPORT, "days AS (SELECT dayname(sold_date) AS day_of_week, count(*) AS n FROM report GROUP BY 1)",
        select=f"SELECT days.day_of_week, n, ord FROM days JOIN {o.WEEKDAY_SPINE} USING (day_of_week)",
    ),
)
def order_weekday(spark, sf_dir):
    name = fn.weekday_name("sold_date").alias("day_of_week")
    counts = _report(spark, sf_dir, "sold_date").groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    return op.order_weekday(counts)


@query("sales_per_day", o.with_(o.REPORT, select=_BY_DAY))
def sales_per_day(spark, sf_dir):
    return op.sales_per_day(_report(spark, sf_dir, "sold_date"))


@query("sales_per_day_vendor", o.with_(o.REPORT, select=_BY_DAY_VENDOR))
def sales_per_day_vendor(spark, sf_dir):
    return op.sales_per_day_vendor(_report(spark, sf_dir, "sold_date", "vendor"))


@query("vendor_totals", o.with_(o.REPORT, select="SELECT vendor, count(*) AS sales_count FROM report GROUP BY 1"))
def vendor_totals(spark, sf_dir):
    return op.vendor_totals(op.sales_per_day_vendor(_report(spark, sf_dir, "sold_date", "vendor")))


@query(
    "revenue_per_day",
    o.with_(o.REPORT, select='SELECT sold_date AS "Date", CAST(sum(price) AS BIGINT) AS "Total Revenue" FROM report GROUP BY 1'),
)
def revenue_per_day(spark, sf_dir):
    return op.revenue_per_day(_report(spark, sf_dir, "sold_date", "price"))


@query("counts_by_type", o.with_(o.REPORT, select='SELECT product_type, count(*) AS "count" FROM report GROUP BY 1'))
def counts_by_type(spark, sf_dir):
    return op.counts_by_type(_report(spark, sf_dir, "product_type"))


@query("products_by_vendor", o.with_(o.REPORT, select="SELECT vendor, count(*) AS products_sold FROM report GROUP BY 1"))
def products_by_vendor(spark, sf_dir):
    return op.products_by_vendor(_report(spark, sf_dir, "vendor"))


@query(
    "order_by_count_desc",
    o.with_(
        o.LISTINGS,
        select="SELECT vendor, count(*) AS n FROM listings WHERE vendor IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1",
    ),
)
def order_by_count_desc(spark, sf_dir):
    return op.counts_by(listings(spark, sf_dir), "vendor", "n")


@query(
    "sales_by_color_day",
    o.with_(
        o.REPORT,
        select="SELECT sold_date, exterior_color, count(*) AS bags_sold, strftime(sold_date, '%Y-%m-%d (%A)') AS day_of_week "
        "FROM report WHERE exterior_color IS NOT NULL GROUP BY 1, 2",
    ),
)
def sales_by_color_day(spark, sf_dir):
    return op.sales_by_color_day(_report(spark, sf_dir, "sold_date", "exterior_color"))


@query(
    "daily_vendor_rollup",
    o.with_(
        o.REPORT,
        select="SELECT sold_date, vendor, count(*) AS sales_count, CAST(sum(price) AS BIGINT) AS revenue FROM report GROUP BY 1, 2",
    ),
)
def daily_vendor_rollup(spark, sf_dir):
    return op.daily_vendor_rollup(_report(spark, sf_dir, "sold_date", "vendor", "price"))


@query("row_count", o.with_(o.REPORT, select="SELECT count(*) AS row_count FROM report WHERE price BETWEEN 20000 AND 60000"))
def row_count(spark, sf_dir):
    rows = sold_view(spark, sf_dir, ["price", "days_on_market", "sold_date"])
    return op.row_count(op.filter_range(rows, price=_PRICE))


@query(
    "bounds",
    o.with_(
        o.REPORT,
        select="SELECT min(price) AS price_min, max(price) AS price_max, min(days_on_market) AS days_on_market_min, "
        "max(days_on_market) AS days_on_market_max, min(sold_date) AS sold_date_min, max(sold_date) AS sold_date_max FROM report",
    ),
)
def bounds(spark, sf_dir):
    return op.bounds(_report(spark, sf_dir, "price", "days_on_market", "sold_date"))


@query("distinct_vendors", o.with_(o.REPORT, select="SELECT DISTINCT vendor FROM report"))
def distinct_vendors(spark, sf_dir):
    return op.distinct_vendors(_report(spark, sf_dir, "vendor"))


def _box_queries(column: str, label: str) -> None:
    @query(f"quartiles_{label}", o.with_(o.REPORT, o.box(column), select="SELECT q1, median, q3 FROM box"))
    def quartiles(spark, sf_dir):
        return op.quartiles(_report(spark, sf_dir, column), column)

    @query(f"box_stats_{label}", o.with_(o.REPORT, o.box(column), select=o.box_select()))
    def box_stats(spark, sf_dir):
        return op.box_stats(_report(spark, sf_dir, column), column)


_box_queries("price", "price")
_box_queries("days_on_market", "days")

# Fifth powers of order totals: long-tailed whole numbers with outliers.
_TAIL_SQL = (
    "tail AS (SELECT o_orderkey, CAST(CAST(floor(o_totalprice) AS INTEGER) // 1000 AS BIGINT) AS k FROM orders), "
    "tailed AS (SELECT o_orderkey, CAST(k * k * k * k * k // 1000000 AS INTEGER) AS price FROM tail)"
)


def _tailed(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("k", F.expr("cast(floor(o_totalprice) as int) div 1000"))
    return orders.select("o_orderkey", F.expr("k * k * k * k * k div 1000000").cast("int").alias("price"))


@query(
    "box_outliers",
    o.with_(
        _TAIL_SQL, o.box("price", "tailed"),
        select="SELECT o_orderkey, price FROM tailed, box WHERE price < q1 - 1.5 * (q3 - q1) OR price > q3 + 1.5 * (q3 - q1)",
    ),
)
def box_outliers(spark, sf_dir):
    return op.box_outliers(_tailed(spark, sf_dir), "price")


@query("box_stats_empty", "SELECT CAST(NULL AS DOUBLE) AS q1, CAST(NULL AS DOUBLE) AS median, CAST(NULL AS DOUBLE) AS q3 FROM "
       "(SELECT count(*) AS n FROM orders)")
def box_stats_empty(spark, sf_dir):
    """No row has a value: one row of NULLs."""
    return op.quartiles(_tailed(spark, sf_dir).select(F.when(F.col("o_orderkey") < 0, F.col("price")).alias("price")), "price")


def _wide_box(select: str) -> str:
    """Figures of prices as stored: a double, a decimal and a 64-bit integer beyond 32 bits."""
    kinds = ("CAST(l_extendedprice AS DOUBLE)", "CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS DOUBLE)", "CAST(l_orderkey * 10000019 - 5000000000 AS DOUBLE)")
    return " UNION ALL ".join(
        f"SELECT '{name}' AS kind, * FROM (" + o.with_(f"source AS (SELECT {kind} AS x FROM lineitem)", o.box("x", "source"), select=select) + ")"
        for name, kind in zip(("double", "decimal", "bigint"), kinds)
    )


def _wide(spark: SparkSession, sf_dir: str, figures: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_extendedprice").alias("double"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("decimal"),
        (F.col("l_orderkey") * F.lit(10000019) - F.lit(5000000000)).alias("bigint"),
    )
    return reduce(DataFrame.unionByName, [figures(lines, c).select(F.lit(c).alias("kind"), "*") for c in lines.columns])


@query("quartiles_wide", _wide_box("SELECT q1, median, q3 FROM box"))
def quartiles_wide(spark, sf_dir):
    """Exact quartiles of columns that are no 32-bit integers."""
    return _wide(spark, sf_dir, op.quartiles)


@query("box_stats_wide", _wide_box(o.box_select()))
def box_stats_wide(spark, sf_dir):
    return _wide(spark, sf_dir, op.box_stats)


@query(
    "box_outliers_decimal",
    o.with_(
        "tailed AS (SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(o_orderkey AS DECIMAL(12,0)) AS DECIMAL(24,2)) AS price "
        "FROM orders)",
        "wide AS (SELECT o_orderkey, price, CAST(price AS DOUBLE) AS x FROM tailed)",
        o.box("x", "wide"),
        select="SELECT o_orderkey, price FROM wide, box WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)",
    ),
)
def box_outliers_decimal(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.expr("cast(cast(o_totalprice as decimal(12,2)) * cast(o_orderkey as decimal(12,0)) as decimal(24,2))").alias("price")
    )
    return op.box_outliers(rows, "price")


_RANKS_SQL = (
    'ranks AS (SELECT product_type, count(*) AS "count", row_number() OVER (ORDER BY count(*) DESC, product_type) AS rank '
    "FROM report GROUP BY 1)"
)


@query("ordered_category", o.with_(o.REPORT, _RANKS_SQL, select='SELECT product_type, "count", rank FROM ranks'))
def ordered_category(spark, sf_dir):
    return op.ordered_category(_report(spark, sf_dir, "product_type"), "product_type")


@query(
    "ordered_category_many",
    "SELECT o_custkey, count(*) AS \"count\", row_number() OVER (ORDER BY count(*) DESC, o_custkey) AS rank FROM orders GROUP BY 1",
)
def ordered_category_many(spark, sf_dir):
    return op.ordered_category(table(spark, sf_dir, "orders").select("o_custkey"), "o_custkey")


@query(
    "price_vs_type_points",
    o.with_(o.REPORT, _RANKS_SQL, select="SELECT product_type, price, rank FROM report JOIN ranks USING (product_type)"),
)
def price_vs_type_points(spark, sf_dir):
    return op.price_vs_type_points(_report(spark, sf_dir, "product_type", "price"))


@query(
    "price_vs_condition_points",
    o.with_(o.REPORT, select="SELECT condition, price FROM report WHERE condition IS NOT NULL"),
)
def price_vs_condition_points(spark, sf_dir):
    return op.price_vs_condition_points(_report(spark, sf_dir, "condition", "price"))


@query("weekday_name", "SELECT o_orderkey, dayname(o_orderdate) AS day_of_week FROM orders")
def weekday_name(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", fn.weekday_name("o_orderdate").alias("day_of_week"))


@query(
    "date_label",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d (%A)') AS label, "
    "strftime(o_orderdate, '%Y-%m-%d') || chr(10) || strftime(o_orderdate, '(%A)') AS axis_label FROM orders",
)
def date_label(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", fn.date_label("o_orderdate").alias("label"),
        fn.date_label("o_orderdate", two_lines=True).alias("axis_label"),
    )


@query(
    "currency_label",
    "WITH amounts AS (SELECT l_orderkey, l_linenumber, CAST(round(l_extendedprice) AS BIGINT) * CAST(l_quantity AS BIGINT) "
    "// CAST(l_suppkey % 500 + 1 AS BIGINT) * 50 AS amount FROM lineitem) "
    "SELECT l_orderkey, l_linenumber, CASE WHEN amount >= 1000000 THEN printf('$%.1fM', amount / 1e6) "
    "WHEN amount >= 1000 THEN printf('$%.0fK', amount / 1e3) ELSE printf('$%.0f', CAST(amount AS DOUBLE)) END AS label FROM amounts",
)
def currency_label(spark, sf_dir):
    """Multiples of 50 between 0 and hundreds of millions, many of them rounding ties."""
    amount = F.floor(
        F.round("l_extendedprice").cast("bigint") * F.col("l_quantity").cast("bigint") / (F.col("l_suppkey") % 500 + 1)
    ) * 50
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", fn.currency_label(amount).alias("label"))


@query(
    "dashboard",
    o.with_(
        o.REPORT,
        select="SELECT sold_date, vendor, count(*) AS sales_count, "
        "strftime(sold_date, '%Y-%m-%d') || chr(10) || '(' || dayname(sold_date) || ')' AS label FROM report "
        "WHERE vendor IS NOT NULL AND sold_date IS NOT NULL GROUP BY sold_date, vendor",
    ),
)
def dashboard(spark, sf_dir):
    """The per-vendor series of the report page, from the rollup that most of its frames share."""
    columns = ["id", "store", "vendor", "title", "price", "product_type", "condition", "exterior_color", "days_on_market", "sold_date"]
    page = plans.dashboard(sold_view(spark, sf_dir, columns), type_chart=False)
    return page["sales_per_day_vendor"]


# The rollup of a sold table, kept in step by every write to it

_DATED_SQL = (
    "dated AS (SELECT store, ingestion_date AS sold_date, vendor, title, CAST(trunc(price) AS INTEGER) AS price, days_on_market, "
    "CAST(substr(ingestion_date, 9) AS INTEGER) AS dom, event_id FROM staged)",
    "stored AS (SELECT *, price IS NOT NULL AND days_on_market IS NOT NULL AND title IS NOT NULL AS shown FROM dated "
    "WHERE dom % 7 <> 0 AND (dom % 5 <> 0 OR event_id % 2 = 0))",
)


def _rolled_up(spark: SparkSession, sf_dir: str) -> str:
    """A sold table with a rollup: rows appended twice, every fifth day replaced, every seventh deleted."""
    columns = ["event_id", "vendor", "title", "price", "days_on_market", "store", F.col("ingestion_date").alias("sold_date")]
    rows = _staged(spark, sf_dir).select(*columns)
    drops = _drops(spark, sf_dir)
    sold, rollup = f"sold_{uuid.uuid4().hex}", f"rollup_{uuid.uuid4().hex}"
    src.ensure_table(spark, sold, rows, SOLD_PARTITIONS, scratch_path(spark, "sold"))
    src.attach_rollup(spark, sold, rollup, scratch_path(spark, "rollup"))
    for part in (rows.where("event_id % 3 = 0"), rows.where("event_id % 3 <> 0")):
        src.append_day(spark, sold, part.hint("rebalance", F.col("store"), F.col("sold_date")))
    fifth = [d for d in drops if int(d[1][8:]) % 5 == 0]
    again = rows.where((F.substring("sold_date", 9, 2).cast("int") % 5 == 0) & (F.col("event_id") % 2 == 0))
    src.replace_days(spark, sold, again, fifth, "sold_date")
    src.delete_days(spark, sold, [d for d in drops if int(d[1][8:]) % 7 == 0], "sold_date")
    return sold


@query(
    "sold_rollup",
    o.with_(
        o.LISTINGS,
        o.staged(),
        *_DATED_SQL,
        select="SELECT store, sold_date, vendor, count(*) AS n_rows, count(*) FILTER (WHERE shown) AS sales_count, "
        "CAST(sum(price) FILTER (WHERE shown) AS BIGINT) AS revenue, min(price) AS price_min, max(price) AS price_max, "
        "min(days_on_market) AS days_on_market_min, max(days_on_market) AS days_on_market_max FROM stored GROUP BY ALL",
    ),
)
def sold_rollup(spark, sf_dir):
    return src.read_rollup(spark, _rolled_up(spark, sf_dir))


@query(
    "dashboard_rollup",
    o.with_(
        o.LISTINGS,
        o.staged(),
        *_DATED_SQL,
        select="SELECT CAST(sold_date AS DATE) AS sold_date, vendor, count(*) AS sales_count FROM stored "
        "WHERE shown AND vendor IS NOT NULL GROUP BY ALL",
    ),
)
def dashboard_rollup(spark, sf_dir):
    """The per-vendor series of an unfiltered page, which reads the rollup alone."""
    sold = _rolled_up(spark, sf_dir)
    page = plans.dashboard(spark.table(sold), type_chart=False, partials=src.read_rollup(spark, sold))
    return page["sales_per_day_vendor"].drop("label")


@query(
    "compact",
    o.with_(
        o.LISTINGS,
        o.staged(),
        select="SELECT store, ingestion_date, count(*) AS n_rows, CAST(sum(event_id) AS BIGINT) AS ids, "
        "CAST(sum(price) AS DECIMAL(20,2)) AS price, CAST(1 AS BIGINT) AS files FROM staged GROUP BY ALL",
    ),
)
def compact(spark, sf_dir):
    """Every day appended in pieces, then one file a day: the rows are the same."""
    name, rows = _products_table(spark, sf_dir, load=False)
    src.append_day(spark, name, rows.repartition(4, F.pmod("event_id", F.lit(4))))
    src.compact(spark, name)
    files = F.count_distinct("_metadata.file_path").alias("files")
    sums = F.count(F.lit(1)).alias("n_rows"), F.sum("event_id").alias("ids"), F.sum("price").cast("decimal(20,2)").alias("price")
    return spark.table(name).groupBy("store", "ingestion_date").agg(*sums, files)
