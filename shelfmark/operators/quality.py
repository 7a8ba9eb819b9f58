"""Data-quality checks.  Each returns its findings; an empty or all-zero result passes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Columns that must not be NULL, per kind of model.
STAGING_NOT_NULL = (
    "title",
    "vendor",
    "product_type",
    "ingestion_date",
    "published_at",
    "id",
    "price",
    "days_on_market",
)
SOLD_NOT_NULL = ("sold_date", "vendor", "product_type", "id", "price", "days_on_market")
MART_NOT_NULL = ("title", "vendor", "price", "days_on_market")


def _column(name: str) -> Column:
    """A column by its whole name, which may hold dots."""
    return F.col("`" + name.replace("`", "``") + "`")


class DataQualityError(Exception):
    """A gate found failing checks."""


def dq_not_null(df: DataFrame, model: str, columns: Sequence[str]) -> DataFrame:
    """(model, check, column, failures) per column, from one pass over ``df``."""
    counts = df.agg(*[F.count_if(_column(c).isNull()).alias(f"_{i}") for i, c in enumerate(columns)])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("failures")) for i, c in enumerate(columns)]
    long = counts.select(F.inline(F.array(*rows)))
    return long.select(
        F.lit(model).alias("model"), F.lit("not_null").alias("check"), "column", "failures"
    )


def duplicate_keys(df: DataFrame, column: str = "id") -> DataFrame:
    """Values occurring more than once, with their count; NULLs are not compared."""
    counts = df.select(_column(column).alias(column)).where(_column(column).isNotNull())
    counts = counts.groupBy(_column(column)).agg(F.count(F.lit(1)).alias("n_records"))
    return counts.where(F.col("n_records") > 1)


def dq_unique(df: DataFrame, model: str, column: str = "id") -> DataFrame:
    """(model, check, column, failures): number of values that occur more than once."""
    return duplicate_keys(df, column).agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(model).alias("model"), F.lit("unique").alias("check"), F.lit(column).alias("column"), "failures"
    )


def not_in_seed(
    df: DataFrame, column: str, seed: DataFrame, seed_column: str = "vendor"
) -> DataFrame:
    """Rows whose ``column`` is NOT IN the seed, with SQL's NULL rules.

    A NULL in the seed leaves no rows, a NULL in ``column`` drops the row, an empty seed
    keeps everything.  The NULL rules are two scalar subqueries over the seed, so the rest
    is an ordinary anti join: Spark broadcasts the seed when its size allows and shuffles
    otherwise, while the null-aware join of ``NOT IN`` can only broadcast.
    """
    listed = seed.select(_column(seed_column).alias("_listed"))
    facts = listed.agg(
        F.struct(
            (F.count(F.lit(1)) == 0).alias("is_empty"),
            (F.count_if(F.col("_listed").isNull()) > 0).alias("has_null"),
        ).alias("facts")
    ).scalar()
    outside = df.join(listed.where(F.col("_listed").isNotNull()), _column(column) == F.col("_listed"), "left_anti")
    return outside.where(facts["is_empty"] | (~facts["has_null"] & _column(column).isNotNull()))


def dq_valid_vendors(
    df: DataFrame, column: str, seed: DataFrame, seed_column: str = "vendor"
) -> DataFrame:
    """Distinct values outside the whitelist; only distinct values reach the join."""
    return not_in_seed(df.select(_column(column).alias(column)).distinct(), column, seed, seed_column)


def check_staging(
    df: DataFrame, model: str, columns: Sequence[str] = STAGING_NOT_NULL, key: Sequence[str] = ("id",)
) -> DataFrame:
    """All checks of a staging model in one pass: NULLs per column, and a unique ``key``.

    NULLs are counted per key and then summed.  On deduplicated input the grouping reuses
    the partitioning of the deduplication, so the checks add no shuffle of rows.
    """
    nulls = [F.count_if(_column(c).isNull()).alias(f"_null_{c}") for c in columns]
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), *nulls)
    has_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    zero = F.lit(0).cast("bigint")
    totals = per_key.agg(
        *[F.coalesce(F.sum(_column(f"_null_{c}")), zero).alias(f"not_null {c}") for c in columns],
        F.count_if(has_key & (F.col("_n") > 1)).alias(f"unique {key[-1]}"),
    )
    names = F.split("name", " ")
    return totals.unpivot([], totals.columns, "name", "failures").select(
        F.lit(model).alias("model"), names[0].alias("check"), names[1].alias("column"), "failures"
    )


def check_sold(df: DataFrame, model: str) -> DataFrame:
    """All checks of a sold table."""
    return dq_not_null(df, model, SOLD_NOT_NULL)


def check_mart(df: DataFrame, model: str = "sold_products") -> DataFrame:
    """All checks of the mart."""
    return dq_not_null(df, model, MART_NOT_NULL)


def dq_failures_by_store(checks: dict[str, Sequence[DataFrame]]) -> dict[str, list[str]]:
    """Failing checks of each shop that has any; one row per failing check is fetched."""
    tagged = [c.withColumn("store", F.lit(store)) for store, own in checks.items() for c in own]
    found: dict[str, list[str]] = {}
    for r in dq_failures(tagged).collect():
        found.setdefault(r["store"], []).append(f"{r['model']}.{r['column']} {r['check']}: {r['failures']}")
    return found


def dq_failures(checks: Sequence[DataFrame]) -> DataFrame:
    """Failing checks of several models in one frame."""
    return reduce(DataFrame.unionByName, checks).where(F.col("failures") > 0)


def dq_gate(checks: Sequence[DataFrame]) -> None:
    """Run the checks and raise if any fails; the error carries one row per failing check."""
    failed = dq_failures(checks).collect()
    if failed:
        error = DataQualityError("; ".join(f"{r['model']}.{r['column']} {r['check']}: {r['failures']}" for r in failed))
        error.failures = failed
        raise error
