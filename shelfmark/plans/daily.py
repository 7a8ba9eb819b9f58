"""The daily run: land, check, diff, append, publish.  All shops go through one job each step."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.operators.guard import open_stores
from shelfmark.operators.quality import STAGING_NOT_NULL, DataQualityError, check_sold, check_staging, dq_failures_by_store
from shelfmark.operators.sold import (
    day_before,
    filter_snapshot_day,
    landed_drops,
    last_available_days,
    project_sold_ext,
    require_complete_day,
    snapshot_diff,
    snapshot_diff_days,
)
from shelfmark.operators.staging import enrich_stores, latest_by_id, stage
from shelfmark.schemas import (
    MART_COLUMNS,
    PRODUCT,
    SNAPSHOT_PARTITIONS,
    SOLD_COLUMNS,
    SOLD_EXT_COLUMNS,
    SOLD_PARTITIONS,
)
from shelfmark.session import ensure_checkpoint_dir
from shelfmark.sources.landing import (
    cluster_by_vendor,
    day_path,
    landed_stores,
    purge_base_day,
    read_base_days,
    require_folders,
    write_base_parquet,
)
from shelfmark.sources.pages import bad_pages, explode_listings, parse_pages, quarantine, release, scan_pages
from shelfmark.sources.tables import append_day, ensure_table, materialize_view, replace_days, store_view
from shelfmark.stores import STORES, StoreSpec


@dataclass
class DayReport:
    """What one run wrote."""

    day: str
    missing: list[str] = field(default_factory=list)
    landed: dict[tuple[str, str], int] = field(default_factory=dict)
    sold: int = 0
    failed: dict[str, list[str]] = field(default_factory=dict)


def quarantine_root(base_root: str) -> str:
    """Where the bad pages of a landing area are put aside."""
    return base_root.rstrip("/") + "_quarantine"


def land_days(
    spark: SparkSession,
    raw_root: str,
    base_root: str,
    products: str,
    drops: Sequence[tuple[str, str]],
    schema: T.StructType | None = None,
    multi_line: bool = True,
    path: str | None = None,
    failed: dict[tuple[str, str], list[str]] | None = None,
    glob: str = "*.json",
    buckets: int | None = None,
) -> dict[tuple[str, str], int]:
    """Raw pages to base snapshots to the ``products`` table, for any number of drops.

    Repeating a drop replaces it in both places.  Returns rows landed per drop.  The pages are read
    once: columns of ``schema`` (by default those later stages rely on) are typed, and all other fields
    of a listing are kept in a VARIANT column, whatever fields a day brings.

    A drop with a bad page does not land, since listings on the page would seem sold: its base
    snapshot is emptied, ``products`` keeps what it had, and the bad pages go to ``quarantine_root``.
    All other drops land.  Failing drops are entered in ``failed`` with their reasons; without such a
    dictionary they raise ``BadPagesError`` once the others have landed.
    """
    drops = list(drops)
    folders = [day_path(store, day) for store, day in drops]
    paths = [f"{raw_root.rstrip('/')}/{f}" for f in folders]
    require_folders(spark, paths, folders, glob)
    parsed = parse_pages(scan_pages(spark, paths, multi_line, glob))
    key = F.concat_ws("/", *SNAPSHOT_PARTITIONS)
    seen = Observation()
    some = F.col("reason").isNull() & (F.size("listings") > 0)
    parsed = parsed.observe(
        seen,
        F.collect_set(F.when(F.col("reason").isNotNull(), key)).alias("bad"),
        F.collect_set(F.when(some, key)).alias("filled"),
    )
    write_base_parquet(explode_listings(parsed, schema or PRODUCT), base_root)
    bad, filled = set(seen.get["bad"]), set(seen.get["filled"])

    broken = [d for d in drops if "/".join(d) in bad]
    for store, day in drops:
        if (store, day) in broken or f"{store}/{day}" not in filled:
            purge_base_day(spark, base_root, store, day)
    aside = quarantine_root(base_root)
    reasons: dict[tuple[str, str], list[str]] = {}
    if broken:
        own = [f"{raw_root.rstrip('/')}/{day_path(store, day)}" for store, day in broken]
        found = bad_pages(spark, own, multi_line, glob)
        quarantine(found, aside)
        for r in found.groupBy(*SNAPSHOT_PARTITIONS, "reason").agg(F.count(F.lit(1)).alias("n")).orderBy("reason").collect():
            reasons.setdefault((r["store"], r["ingestion_date"]), []).append(f"{r['n']} bad pages: {r['reason']}")
    good = [d for d in drops if d not in broken]
    release(spark, aside, good)

    landed: dict[tuple[str, str], int] = {}
    if good:
        whole = [d for d in good if "/".join(d) in filled]
        if whole:
            base = read_base_days(spark, base_root, whole)
        else:
            base = explode_listings(parsed, schema or PRODUCT).limit(0)
        ensure_table(spark, products, base, SNAPSHOT_PARTITIONS, path, buckets)
        landed = replace_days(spark, products, cluster_by_vendor(base, by=tuple(SNAPSHOT_PARTITIONS)), good, on_unknown="add")
    if failed is not None:
        failed |= reasons
    elif reasons:
        raise BadPagesError(reasons, landed)
    return landed


class BadPagesError(ValueError):
    """Drops that could not be read; the others have landed."""

    def __init__(self, failed: dict[tuple[str, str], list[str]], landed: dict[tuple[str, str], int]):
        super().__init__("; ".join(f"{store} {day}: {', '.join(why)}" for (store, day), why in sorted(failed.items())))
        self.failed, self.landed = failed, landed


def staged_day(
    history: DataFrame, stores: Sequence[StoreSpec], day: str, as_of: str, columns: Sequence[str]
) -> DataFrame:
    """Staging rows of one snapshot of all shops, one per (store, id).

    Only ``columns`` and what the deduplication needs are shuffled.
    """
    enriched = enrich_stores(filter_snapshot_day(history, day), stores, as_of)
    needed = list(dict.fromkeys(("store", "id", "updated_at", *columns)))
    return latest_by_id(enriched.select(*needed), ("store", "id"))


def _sold_input(enriched: DataFrame) -> DataFrame:
    """Only the columns of a sold row and what the diff compares."""
    for column in ("condition", "exterior_color"):
        if column not in enriched.columns:
            enriched = enriched.withColumn(column, F.lit(None).cast("string"))
    return enriched.select(*[c for c in SOLD_EXT_COLUMNS if c != "sold_date"], "ingestion_date", "updated_at")


def build_sold(
    spark: SparkSession,
    products: str,
    sold: str,
    today: str,
    stores: Sequence[StoreSpec] = STORES,
    yesterday: str | None = None,
    previous: str = "calendar",
    as_of: str | None = None,
    mode: str = "per_day",
    min_share: float | None = None,
    text_order: bool = False,
    path: str | None = None,
    failed: dict[str, list[str]] | None = None,
) -> int:
    """Append the listings sold on ``today``; returns rows written.

    Shops whose stored sales already reach ``today`` are skipped before anything is read, and
    so are shops without a snapshot of ``today``: all they listed would seem sold.
    Listings are enriched and cut down to the sold columns before the shuffle, so listing
    HTML is parsed in the scan tasks and never moved.  ``previous="last_available"``
    compares each shop with its own latest earlier snapshot when yesterday's is missing.

    With a dictionary ``failed``, rows are checked before they are written: failing shops are
    entered there with their failures and write nothing.
    """
    history = spark.table(products)
    names = [s.name for s in stores]
    if spark.catalog.tableExists(sold):
        names = open_stores(spark.table(sold), names, today)
    landed = {store for store, _ in landed_drops(history.where(F.col("store").isin(names)), [today])}
    names = [n for n in names if n in landed]
    if not names:
        return 0
    history = history.where(F.col("store").isin(names))

    before = dict.fromkeys(names, yesterday or day_before(today))
    if yesterday is None and previous == "last_available":
        before |= last_available_days(history, today)
    compared = []
    for day in sorted(set(before.values())):
        own = history.where(F.col("store").isin([n for n in names if before[n] == day]))
        if min_share is not None:
            require_complete_day(own, today, day, min_share)
        enriched = _sold_input(enrich_stores(own, stores, as_of or today))
        compared.append(snapshot_diff(enriched, today, day, ("store", "id"), mode, text_order=text_order))
    rows = project_sold_ext(reduce(DataFrame.unionByName, compared))
    if failed is not None:
        # The rows that are checked are the rows that are written.
        ensure_checkpoint_dir(spark)
        rows = rows.checkpoint()
        failed |= dq_failures_by_store({n: [check_sold(rows.where(F.col("store") == n), f"sold_{n}")] for n in names})
        rows = rows.where(~F.col("store").isin(list(failed))) if failed else rows
    ensure_table(spark, sold, rows, SOLD_PARTITIONS, path)
    # Few of the compared rows sold: gather them into well-sized files per shop.
    return append_day(spark, sold, rows.hint("rebalance", F.col("store")))


def rebuild_sold(
    spark: SparkSession,
    products: str,
    sold: str,
    days: Sequence[str],
    stores: Sequence[StoreSpec] = STORES,
    text_order: bool = False,
    path: str | None = None,
) -> dict[tuple[str, str], int]:
    """Recompute the sales of many run dates in one job and replace those partitions.

    For backfills the guard would block, and for catching up on many days.  Ages count up
    to each sale's own date.  Returns rows written per (store, day).  Pairs without a snapshot
    of that day are left alone and missing from the result: all they listed would seem sold.
    """
    names = [s.name for s in stores]
    history = spark.table(products).where(F.col("store").isin(names))
    as_of = F.date_add(F.to_date("ingestion_date"), 1)
    enriched = _sold_input(enrich_stores(history, stores, as_of))
    drops = sorted(landed_drops(history, days))
    if not drops:
        return {}
    gone = snapshot_diff_days(enriched, days, ("store", "id"), text_order=text_order, landed=drops)
    rows = project_sold_ext(gone)
    ensure_table(spark, sold, rows, SOLD_PARTITIONS, path)
    return replace_days(spark, sold, rows.hint("rebalance", F.col("store"), F.col("sold_date")), drops, "sold_date")


def publish_staging(spark: SparkSession, products: str, stores: Sequence[StoreSpec] = STORES, as_of: str | None = None) -> None:
    """``stg_<store>__products`` per shop: the latest row of each listing with all columns.

    Temporary views of the session, computed when they are read; ages count to ``as_of``, by
    default to the day of reading.
    """
    for spec in stores:
        history = spark.table(products).where(F.col("store") == spec.name)
        materialize_view(stage(history, spec, as_of or F.current_date()), f"stg_{spec.name}__products")


def publish_views(
    spark: SparkSession, sold: str, stores: Sequence[StoreSpec] = STORES, database: str | None = None
) -> None:
    """``inc_<store>__sold_products`` per shop and the ``sold_products`` mart over all.

    The shops share one table partitioned by store, so a shop's view prunes to its
    partitions and the mart is a projection instead of a union.  The views are stored in
    the catalog, for other sessions too.
    """
    for spec in stores:
        columns = SOLD_EXT_COLUMNS if spec.attributes else SOLD_COLUMNS
        store_view(spark, f"inc_{spec.name}__sold_products", sold, columns, [spec.name], database)
    store_view(spark, "sold_products", sold, MART_COLUMNS, [s.name for s in stores], database)


def run_day(
    spark: SparkSession,
    raw_root: str,
    base_root: str,
    products: str,
    sold: str,
    day: str,
    stores: Sequence[StoreSpec] = STORES,
    schema: T.StructType | None = None,
    check: bool = True,
    as_of: str | None = None,
    products_path: str | None = None,
    sold_path: str | None = None,
) -> DayReport:
    """One scheduled day for every shop that had started by then.  Safe to repeat.

    A shop with a page that cannot be read lands nothing that day, and its bad pages are put aside
    (see ``land_days``); a shop that fails a check stops there, before anything is built on its bad
    rows.  The other shops go on; at the end the failing ones are named in an error that carries the
    report.
    Shops without pages that day are left out and named in the report.  Both can be run later,
    since the append guard is per shop.
    """
    started = [s for s in stores if s.start_date <= day]
    report = DayReport(day)
    if not started:
        return report
    present = landed_stores(spark, raw_root, day, [s.name for s in started])
    active = [s for s in started if s.name in present]
    report.missing = [s.name for s in started if s.name not in present]
    if not active:
        raise FileNotFoundError(f"no JSON pages of any shop for {day}")
    drops = [(s.name, day) for s in active]
    unread: dict[tuple[str, str], list[str]] = {}
    report.landed = land_days(spark, raw_root, base_root, products, drops, schema, path=products_path, failed=unread)
    report.failed |= {store: why for (store, _), why in unread.items()}
    active = [s for s in active if s.name not in report.failed]
    if check and active:
        history = spark.table(products)
        # Ids are unique within a shop only.  Each shop's check reads its own partition.
        checks = {
            s.name: [
                check_staging(
                    staged_day(history.where(F.col("store") == s.name), [s], day, as_of or day, STAGING_NOT_NULL),
                    f"stg_{s.name}__products", key=("store", "id"),
                )
            ]
            for s in active
        }
        report.failed |= dq_failures_by_store(checks)
        active = [s for s in active if s.name not in report.failed]
    if active:
        sold_failures: dict[str, list[str]] | None = {} if check else None
        report.sold = build_sold(spark, products, sold, day, active, as_of=as_of, path=sold_path, failed=sold_failures)
        report.failed |= sold_failures or {}
    if spark.catalog.tableExists(products):
        publish_staging(spark, products, stores, as_of)
    if spark.catalog.tableExists(sold):
        publish_views(spark, sold, stores)
    if report.failed:
        error = DataQualityError("; ".join(f"{s}: {', '.join(f)}" for s, f in sorted(report.failed.items())))
        error.report = report
        raise error
    return report
