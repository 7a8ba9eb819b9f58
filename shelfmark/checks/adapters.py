"""The benchmark tables in the shape of listings and sold products.

``events`` plays the listing history (one shop per event type, one listing per user) and
``lineitem`` the sold products.  Every adapter reads whole tables; each has a SQL twin in
``oracle.py``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.stores import HTML_ATTRIBUTES, StoreSpec

EVENT_STORES: tuple[StoreSpec, ...] = (
    StoreSpec("click", "https://click.example.com/products/", "2024-01-01", HTML_ATTRIBUTES),
    StoreSpec("error", "https://error.example.com/products/", "2024-01-01"),
    StoreSpec("purchase", "https://purchase.example.com/products/", "2024-01-08"),
    StoreSpec("signup", "https://signup.example.com/collections/all/products/", "2024-01-08"),
    StoreSpec("view", "https://view.example.com/en-us/products/", "2024-01-15"),
)

TODAY, YESTERDAY = "2024-01-15", "2024-01-14"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _part(label: str, values: list[str], gaps: int) -> list[str]:
    """Alternatives of one HTML part; the last ``gaps`` leave it out."""
    return [f"<b>{label}:</b> {v} <br>" for v in values] + [""] * gaps


# Alternatives of each part of a listing's HTML; a number picks one of every list.
HTML_PARTS: list[list[str]] = [
    [
        *(
            f"<b>Condition:</b> {c}. Light wear to {place}.<br>"
            for c in ("Excellent", "Very Good", "Good", "Fair")
            for place in ("corners", "the handles")
        ),
        "<b>Condition:</b> Pristine<br>",
        "<b>Condition:</b>  Good. <br>",
        "",
    ],
    _part("Accessories", ["Dust Bag", "Box, Étui"], 1),
    [f"Measurements: Height {h}.5, Width {2 * h + 1}, Depth {h % 7 + 1} <br>" for h in range(1, 20)]
    + [f"Height {h} <br>" for h in range(20, 23)],
    _part("Exterior Material", ["Leather", "Toile"], 1),
    _part("Exterior Color", ["Brown", "Black", "Bordeaux", "Gris Élégant"], 1),
    _part("Interior Material", ["Suede", "Canvas", "Satin"], 4),
    _part("Interior Color", ["Beige", "Red", "Ivory", "Noir"], 4),
    _part("Hardware Color", ["Gold", "Silver", "Ruthénium"], 2),
]


def body_html(n: str) -> Column:
    """Listing HTML for a number, given as a SQL expression."""
    lists = ["array(" + ", ".join(f"'{t}'" for t in texts) + ")" for texts in HTML_PARTS]
    picks = [f"element_at({a}, int(({n}) % {len(texts)}) + 1)" for a, texts in zip(lists, HTML_PARTS)]
    return F.expr(f"concat({', '.join(picks)})")


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing history from ``events``, with ``event_id`` to break ties."""
    events = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    k = F.col("k")
    day = F.to_date("ts")
    price = F.col("value").cast("decimal(12,3)").cast("string")
    no_variants = F.array().cast("array<struct<price:string>>")
    return events.select(
        "event_id",
        F.col("user_id").alias("id"),
        F.when(k % 17 != 0, F.concat(F.lit("Item "), F.col("user_id").cast("string"), F.lit(" Chloé"))).alias("title"),
        F.concat_ws("-", "event_type", F.col("user_id").cast("string")).alias("handle"),
        body_html("user_id + k").alias("body_html"),
        F.when(k % 23 != 0, F.concat(F.lit("Brand#"), (F.col("user_id") % 30).cast("string"))).alias("vendor"),
        F.concat(F.lit("Type "), (F.col("user_id") % 6).cast("string")).alias("product_type"),
        F.concat(F.date_format(F.date_sub(day, k), "yyyy-MM-dd"), F.lit("T23:30:00-05:00")).alias("published_at"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("updated_at"),
        F.when(k % 50 == 0, no_variants).otherwise(F.array(F.struct(price.alias("price")))).alias("variants"),
        F.col("event_type").alias("store"),
        F.date_format(day, "yyyy-MM-dd").alias("ingestion_date"),
    )


def sold_view(spark: SparkSession, sf_dir: str, columns: Sequence[str], dates: bool = False) -> DataFrame:
    """Sold products from ``lineitem``, one row per line, only the columns asked for.

    ``sold_date`` is text as in a sold table, or a date with ``dates``.

    ``part`` and ``orders`` are joined (left, on their keys) only if a column needs them.
    """
    out = table(spark, sf_dir, "lineitem")
    if {"vendor", "title", "product_type", "exterior_color"} & set(columns):
        part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
        out = out.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    if "days_on_market" in columns:
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
        out = out.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    sold = F.to_date("l_shipdate")
    available = {
        "id": lambda: F.col("l_orderkey") * 10 + F.col("l_linenumber"),
        "store": lambda: F.col("l_linestatus"),
        "vendor": lambda: F.col("p_brand"),
        "title": lambda: F.col("p_name"),
        "product_type": lambda: F.col("p_type"),
        "exterior_color": lambda: F.when(F.col("l_quantity") != 13, F.split("p_name", " ")[0]),
        "condition": lambda: F.when(F.col("l_quantity") != 7, F.col("l_returnflag")),
        "price": lambda: F.col("l_extendedprice").cast("decimal(10,2)"),
        "days_on_market": lambda: F.datediff(sold, F.to_date("o_orderdate")),
        "sold_date": lambda: sold if dates else F.date_format(sold, "yyyy-MM-dd"),
    }
    return out.select([available[c]().alias(c) for c in columns])
