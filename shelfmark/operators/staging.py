"""Latest row per listing, and enrichment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions import days_on_market, extract_attribute, no_match_is_null, product_url, variant_price
from shelfmark.stores import StoreSpec


def row_hash(df: DataFrame) -> Column:
    """Stable hash of a whole row, the last resort between otherwise equal rows.

    A VARIANT counts as its JSON text.  NULL columns leave the hash as it is, so columns that are
    added later do not change the order of old rows.
    """

    def hashed(f: T.StructField) -> Column:
        column = F.col(f"`{f.name}`")
        return F.to_json(column) if isinstance(f.dataType, T.VariantType) else column

    return F.xxhash64(*[hashed(f) for f in df.schema.fields if not isinstance(f.dataType, T.MapType)])


def latest_by_id(
    df: DataFrame,
    keys: Sequence[str] = ("id",),
    order: str = "updated_at",
    ties: Sequence[str] = (),
    text_order: bool = False,
) -> DataFrame:
    """Keep one row per key: the one with the latest ``order`` value.

    ``order`` holds ISO-8601 text and is compared as an instant; ``text_order`` compares
    the text (other column types are always compared as they are).  Ties go to the larger
    ``ties`` columns, then to a hash of the row, so reruns agree.

    Spark keeps one row per key in every map task before it shuffles (WindowGroupLimit),
    so a key holding a large share of the rows reaches its reducer as one row per task.
    """
    ranked_by = F.col(order)
    if isinstance(df.schema[order].dataType, T.StringType) and not text_order:
        ranked_by = F.try_to_timestamp(ranked_by)
    window = Window.partitionBy(*keys).orderBy(
        F.desc_nulls_last("_order"), *[F.desc_nulls_last(t) for t in ties], F.desc("_hash")
    )
    return (
        df.withColumns({"_order": ranked_by, "_hash": row_hash(df)})
        .withColumn("_rank", F.row_number().over(window))
        .where(F.col("_rank") == 1)
        .drop("_order", "_hash", "_rank")
    )


def tag_store(df: DataFrame, store: str) -> DataFrame:
    """Add the constant shop name."""
    return df.withColumn("store", F.lit(store))


def extract_attributes(
    df: DataFrame, column: str, attributes: dict[str, tuple[str, int]]
) -> DataFrame:
    """One new column per named (pattern, group); NULL where the pattern does not match."""
    return df.withColumns(
        {name: extract_attribute(column, pattern, group) for name, (pattern, group) in attributes.items()}
    )


def enrich(df: DataFrame, store: StoreSpec, as_of: Column | str) -> DataFrame:
    """All columns plus store, price, URL, age in days and the shop's HTML attributes."""
    out = tag_store(df, store.name).withColumns(
        {
            "price": variant_price(),
            "url": product_url(store.url_base),
            "days_on_market": days_on_market("published_at", as_of),
        }
    )
    return extract_attributes(out, "body_html", store.attributes) if store.attributes else out


def enrich_stores(df: DataFrame, stores: Sequence[StoreSpec], as_of: Column | str) -> DataFrame:
    """``enrich`` for rows of many shops at once, by their ``store`` column.

    Attribute columns of any shop are present for all and NULL where the shop has none.
    """
    store = F.col("store")
    no_text = F.lit(None).cast("string")
    url, found = no_text, {}
    for spec in stores:
        own = store == spec.name
        url = F.when(own, product_url(spec.url_base)).otherwise(url)
        for name, (pattern, group) in spec.attributes.items():
            text = F.regexp_extract("body_html", pattern, group)
            found[name] = F.when(own, text).otherwise(found.get(name, no_text))
    return df.withColumns(
        {
            "price": variant_price(),
            "url": url,
            "days_on_market": days_on_market("published_at", as_of),
            # Outside the condition, where Spark evaluates the regex once for the test and the value.
            **{name: no_match_is_null(text) for name, text in found.items()},
        }
    )


def stage(
    history: DataFrame,
    store: StoreSpec,
    as_of: Column | str,
    ties: Sequence[str] = ("ingestion_date",),
    per_day: bool = False,
    text_order: bool = False,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Staging model of one shop: latest row per listing, enriched.

    ``per_day`` keeps one row per listing and day instead of one over all days.  With ``columns``
    only those come out: rows are then enriched in the scan tasks, and listing HTML is not
    shuffled unless it is among them.
    """
    keys = ("id", "ingestion_date") if per_day else ("id",)
    if columns is not None:
        needed = list(dict.fromkeys((*keys, "updated_at", *ties, *columns)))
        rows = enrich(history, store, as_of).select(*needed)
        return latest_by_id(rows, keys, "updated_at", ties, text_order).select(*columns)
    return enrich(latest_by_id(history, keys, "updated_at", ties, text_order), store, as_of)
