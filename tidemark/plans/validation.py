"""Checks of the stored layers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The columns whose null rate is reported.
NULL_CHECKED = ["order_id", "customer_id", "product_id", "order_ts", "amount"]


def duplicate_rows(orders: DataFrame, out: str) -> DataFrame:
    """Rows beyond the distinct order_ids."""
    return orders.agg((F.count("*") - F.count_distinct("order_id")).alias(out))


def null_rates(silver: DataFrame) -> DataFrame:
    return silver.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(f"{c}_null_rate") for c in NULL_CHECKED])


def _unmatched(fact: DataFrame, dim: DataFrame, key: str, out: str) -> DataFrame:
    """Fact rows whose key the dimension lacks (a null key has no match), counted per key first."""
    per_key = fact.groupBy(key).agg(F.count("*").alias("rows"))
    lost = per_key.join(dim.select(key).distinct(), key, "left_anti")
    return lost.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias(out))


def referential_integrity(fact: DataFrame, dim_customer: DataFrame, dim_product: DataFrame) -> DataFrame:
    customers = _unmatched(fact, dim_customer, "customer_id", "missing_customer_fk")
    products = _unmatched(fact, dim_product, "product_id", "missing_product_fk")
    both = customers.unionByName(products, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in ("missing_customer_fk", "missing_product_fk")])


def validation_suite(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The four checks over the stored layers, by the name each result is stored under."""
    bronze, silver, fact = tables["bronze_orders"], tables["silver_orders"], tables["fact_orders"]
    return {
        "validation_duplicates_before": duplicate_rows(bronze, "duplicate_rows_before"),
        "validation_duplicates_after": duplicate_rows(silver, "duplicate_rows_after"),
        "validation_null_rates_silver": null_rates(silver),
        "validation_referential_integrity": referential_integrity(
            fact, tables["dim_customer"], tables["dim_product"]
        ),
    }
