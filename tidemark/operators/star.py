"""Gold: one fact and five dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import seconds_between
from tidemark.operators.ranking import ROWS_PER_TASK, positions
from tidemark.session import materialize

# The columns of the fact.
FACT_COLUMNS = [
    "order_id",
    "customer_id",
    "product_id",
    "category_sk",
    "order_ts",
    "order_date",
    "amount",
    "quantity",
    "unit_amount",
    "trip_duration_min",
    "gross_revenue",
]

DIMENSIONS = ["dim_customer", "dim_vendor", "dim_product", "dim_category", "dim_date"]


def duration_minutes(whole_minutes: bool = False) -> Column:
    """Minutes from order_ts to updated_at, never below 0; 0 when one is missing."""
    if whole_minutes:
        minutes = F.timestamp_diff("MINUTE", F.col("order_ts"), F.col("updated_at")).cast("double")
    else:
        minutes = seconds_between(F.col("order_ts"), F.col("updated_at")) / F.lit(60.0)
    return F.greatest(F.lit(0.0), F.coalesce(minutes, F.lit(0.0)))


def measures(silver: DataFrame, whole_minutes: bool = False) -> DataFrame:
    """Silver with the derived columns of the fact; still carries the category."""
    return silver.withColumns(
        {
            "order_date": F.to_date("order_ts"),
            "unit_amount": F.col("amount") / F.col("quantity"),
            "trip_duration_min": duration_minutes(whole_minutes),
            "gross_revenue": F.col("amount") * F.col("quantity"),
        }
    )


def dim_customer(silver: DataFrame) -> DataFrame:
    return silver.select("customer_id").distinct()


def dim_vendor(customers: DataFrame) -> DataFrame:
    """From dim_customer: the last part of the id is the vendor's code."""
    code = F.element_at(F.split("customer_id", "_"), -1)
    return customers.select(F.col("customer_id").alias("vendor_id"), code.alias("vendor_code"))


def dim_product(silver: DataFrame) -> DataFrame:
    """Distinct (product, category) pairs; a product may have several."""
    return silver.select("product_id", "category").distinct()


def dim_category(silver: DataFrame, key_style: str = "dense", rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Categories with a key: dense 1..n in category order, or a hash of the category.

    The dense key stores the distinct categories first, so their number is
    known before they are numbered and their size before they are joined.
    """
    known = silver.where(F.col("category").isNotNull()).select("category").distinct()
    if key_style == "hash":
        key = F.xxhash64("category").bitwiseAND(F.lit((1 << 63) - 1))
        return known.select(key.alias("category_sk"), "category")
    if key_style != "dense":
        raise ValueError(f"Unknown key style: {key_style}")
    numbered = positions(
        materialize(known, "categories"), [F.col("category").asc()], out="category_sk", rows_per_task=rows_per_task
    )
    return numbered.select("category_sk", "category")


def dim_date(silver: DataFrame) -> DataFrame:
    day = F.col("order_date")
    # stored Silver has the day in its folders, so none of its files is decoded
    days = silver.select(day) if "order_date" in silver.columns else silver.select(F.to_date("order_ts").alias("order_date"))
    return (
        days.distinct()
        .select(
            day,
            F.year(day).alias("year"),
            F.month(day).alias("month"),
            F.weekofyear(day).alias("week_of_year"),
            (F.weekday(day) + 1).alias("day_of_week"),
        )
    )


def fact_orders(silver: DataFrame, categories: DataFrame, whole_minutes: bool = False) -> DataFrame:
    """The category is swapped for its key; a null category keeps a null key.

    There is no broadcast hint: Spark broadcasts the dimension when its size
    allows, and otherwise splits a category that holds much of the fact (AQE
    skew join).
    """
    return measures(silver, whole_minutes).join(categories, "category", "left").select(*FACT_COLUMNS)


def build_star(silver: DataFrame, key_style: str = "dense", whole_minutes: bool = False) -> dict[str, DataFrame]:
    categories, customers = dim_category(silver, key_style), dim_customer(silver)
    return {
        "dim_customer": customers,
        "dim_vendor": dim_vendor(customers),
        "dim_product": dim_product(silver),
        "dim_category": categories,
        "dim_date": dim_date(silver),
        "fact_orders": fact_orders(silver, categories, whole_minutes),
    }
