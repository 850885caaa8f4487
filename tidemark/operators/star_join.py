"""The fact with its dimensions joined back."""

from __future__ import annotations

from pyspark.sql import DataFrame


def enrich(fact: DataFrame, dim_product: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """fact LEFT JOIN dim_product LEFT JOIN dim_customer; a product of several categories fans out.

    Both dimensions grow with the data, so Spark chooses the joins by their
    size: broadcast while small, else sorted shuffles in which AQE splits hot keys.
    """
    return fact.join(dim_product, "product_id", "left").join(dim_customer, "customer_id", "left")
