"""Column layouts of the stages a listing passes through."""

from __future__ import annotations

from pyspark.sql import types as T

VARIANTS = T.ArrayType(T.StructType([T.StructField("price", T.StringType())]))

# One listing as the shops publish it; only the columns later stages rely on.
PRODUCT = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("handle", T.StringType()),
        T.StructField("body_html", T.StringType()),
        T.StructField("vendor", T.StringType()),
        T.StructField("product_type", T.StringType()),
        T.StructField("published_at", T.StringType()),
        T.StructField("updated_at", T.StringType()),
        T.StructField("variants", VARIANTS),
    ]
)


def page_schema(product: T.StructType = PRODUCT) -> T.StructType:
    """Schema of one page: an object whose ``products`` holds the listings."""
    return T.StructType([T.StructField("products", T.ArrayType(product))])


# The VARIANT column that holds every field without a column of its own.
OTHER = "other"

SNAPSHOT_PARTITIONS = ["store", "ingestion_date"]
SOLD_PARTITIONS = ["store", "sold_date"]

SOLD_COLUMNS = [
    "id",
    "vendor",
    "title",
    "price",
    "product_type",
    "days_on_market",
    "store",
    "sold_date",
]
SOLD_EXT_COLUMNS = [
    "id",
    "vendor",
    "title",
    "price",
    "condition",
    "exterior_color",
    "product_type",
    "days_on_market",
    "store",
    "sold_date",
]
MART_COLUMNS = ["vendor", "title", "price", "days_on_market", "store", "sold_date"]
