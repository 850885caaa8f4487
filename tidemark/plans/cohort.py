"""Cohort retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.time import month_of, months_between_starts


def cohort_retention(fact: DataFrame) -> DataFrame:
    """Share of the customers of each first-order month that ordered again n months later.

    The fact is cut to distinct (customer, month) pairs before anything groups
    by customer, so a customer has at most one row per month of history then,
    and a cohort at most one row per month number.
    """
    return retention_of(fact.select("customer_id", month_of(F.col("order_ts")).alias("active_month")).distinct())


def retention_of(pairs: DataFrame) -> DataFrame:
    """The same from the distinct (customer, active month) pairs."""
    active = pairs.where(F.col("customer_id").isNotNull())
    first = F.min("active_month").over(Window.partitionBy("customer_id"))
    retention = (
        active.withColumn("cohort_month", first)
        .groupBy(
            "cohort_month",
            months_between_starts(F.col("cohort_month"), F.col("active_month")).cast("bigint").alias("month_number"),
        )
        .agg(F.count("*").alias("active_customers"))
    )
    # month 0 holds every customer of the cohort
    size = F.max(F.when(F.col("month_number") == 0, F.col("active_customers"))).over(
        Window.partitionBy("cohort_month")
    )
    return (
        retention.withColumn("cohort_size", size)
        .withColumn("retention_rate", F.round(F.col("active_customers") / F.nullif(F.col("cohort_size"), F.lit(0)), 4))
        .orderBy("cohort_month", "month_number")
    )
