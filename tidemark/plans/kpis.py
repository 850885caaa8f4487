"""The KPI suite over the Gold tables.

Each KPI aggregates the fact before it joins or ranks, so a customer, product
or day with much of the data is reduced in the map tasks.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.money import exact_sum, partial_sums, resum, running_total, total
from tidemark.functions.time import week_of
from tidemark.operators.ranking import ROWS_PER_TASK, ntile, positions
from tidemark.session import materialize

# The columns of the fact that ranking its orders needs.
RANKED = ["customer_id", "order_id", "order_ts", "gross_revenue"]


def _revenue() -> Column:
    return exact_sum(F.col("gross_revenue"))


def by_day(fact: DataFrame) -> DataFrame:
    """Revenue (in parts that add up exactly) and orders per day; most KPIs over time need no more."""
    return fact.groupBy(F.to_date("order_ts").alias("order_day")).agg(
        *partial_sums(F.col("gross_revenue"), "revenue"), F.count("gross_revenue").alias("orders")
    )


def by_customer(fact: DataFrame) -> DataFrame:
    return fact.groupBy("customer_id").agg(_revenue().alias("total_revenue"), F.count("*").alias("order_count"))


def by_category(fact: DataFrame, dim_category: DataFrame) -> DataFrame:
    """Revenue and units per category, summed by the key before the category is looked up."""
    per_key = fact.groupBy("category_sk").agg(_revenue().alias("revenue"), F.sum("quantity").alias("units"))
    return per_key.join(dim_category, "category_sk", "left").select("category", "revenue", "units")


def daily_revenue(days: DataFrame) -> DataFrame:
    return days.select("order_day", total("revenue").alias("revenue")).orderBy("order_day")


def revenue_by_week(days: DataFrame) -> DataFrame:
    weeks = days.groupBy(week_of(F.col("order_day")).alias("order_week")).agg(*resum("revenue"))
    return weeks.select("order_week", total("revenue").alias("revenue")).orderBy("order_week")


def revenue_lag(days: DataFrame) -> DataFrame:
    """Each day's revenue beside that of the last day before it that has any."""
    # one row per day, so one task is enough for the window
    previous = F.lag("revenue").over(Window.orderBy("order_day"))
    return daily_revenue(days).withColumn("prev_day_revenue", previous).orderBy("order_day")


def running_revenue(days: DataFrame) -> DataFrame:
    so_far = Window.orderBy("order_day").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    running = running_total("revenue", so_far)
    return days.select("order_day", total("revenue").alias("revenue"), running.alias("running_revenue")).orderBy(
        "order_day"
    )


def avg_order_value(days: DataFrame) -> DataFrame:
    whole = days.agg(*resum("revenue"), F.sum("orders").alias("orders"))
    return whole.select((total("revenue") / F.nullif(F.col("orders"), F.lit(0))).alias("avg_order_value"))


def orders_per_customer(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", "order_count").orderBy(F.desc("order_count"), "customer_id")


def peak_hour(fact: DataFrame) -> DataFrame:
    return busiest(by_hour(fact))


def by_hour(fact: DataFrame) -> DataFrame:
    return fact.groupBy(F.hour("order_ts").cast("bigint").alias("order_hour")).agg(F.count("*").alias("orders"))


def busiest(hours: DataFrame) -> DataFrame:
    return hours.orderBy(F.desc("orders"), "order_hour")


def top_products(fact: DataFrame, k: int = 5) -> DataFrame:
    return greatest_products(by_product(fact), k)


def by_product(fact: DataFrame) -> DataFrame:
    return fact.groupBy("product_id").agg(_revenue().alias("revenue"))


def greatest_products(products: DataFrame, k: int = 5) -> DataFrame:
    return products.orderBy(F.col("revenue").desc_nulls_last(), F.col("product_id").asc_nulls_last()).limit(k)


def top_categories(categories: DataFrame, k: int = 5) -> DataFrame:
    return (
        categories.select("category", "revenue")
        .orderBy(F.col("revenue").desc_nulls_last(), F.col("category").asc_nulls_last())
        .limit(k)
    )


def quantity_by_category(categories: DataFrame) -> DataFrame:
    return categories.select("category", "units").orderBy(
        F.col("units").desc_nulls_last(), F.col("category").asc_nulls_last()
    )


def top_categories_via_product(fact: DataFrame, dim_product: DataFrame, k: int = 5) -> DataFrame:
    """As above, joined on the product alone: a product of several categories counts in each."""
    per_product = fact.groupBy("product_id").agg(*partial_sums(F.col("gross_revenue"), "revenue"))
    return (
        per_product.join(dim_product, "product_id")
        .groupBy("category")
        .agg(*resum("revenue"))
        .select("category", total("revenue").alias("revenue"))
        .orderBy(F.col("revenue").desc_nulls_last(), F.col("category").asc_nulls_last())
        .limit(k)
    )


def quantity_by_category_via_product(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    per_product = fact.groupBy("product_id").agg(F.sum("quantity").alias("units"))
    return (
        per_product.join(dim_product, "product_id")
        .groupBy("category")
        .agg(F.sum("units").alias("units"))
        .orderBy(F.col("units").desc_nulls_last(), F.col("category").asc_nulls_last())
    )


def order_rank_per_customer(
    fact: DataFrame, top_n: int | None = None, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Orders of each customer by revenue, greatest first; equal revenue in order_id order.

    With top_n Spark drops the other orders in the map tasks. Without it every
    order is ranked; fact should then be a stored table (see positions()).
    """
    orders = fact.select(*RANKED)
    greatest = [F.col("gross_revenue").desc_nulls_last(), F.col("order_id").asc()]
    if top_n is None:
        ranked = positions(orders, greatest, within=["customer_id"], rows_per_task=rows_per_task)
    else:
        place = F.row_number().over(Window.partitionBy("customer_id").orderBy(*greatest))
        ranked = orders.withColumn("rn", place).where(F.col("rn") <= top_n).withColumn("rn", F.col("rn").cast("bigint"))
    return ranked.select("customer_id", "order_ts", "gross_revenue", "rn")


def customer_ntile(customers: DataFrame, buckets: int = 4, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Revenue quartile of each customer, lowest first; equal revenue in customer_id order.

    customers should be stored, see ntile().
    """
    totals = customers.select("customer_id", "total_revenue")
    ascending = [F.col("total_revenue").asc_nulls_last(), F.col("customer_id").asc_nulls_last()]
    return ntile(totals, buckets, ascending, "revenue_quartile", rows_per_task)


def kpi_suite(tables: Mapping[str, DataFrame], sums: Mapping[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The twelve KPIs over stored Gold tables, by the name each result is stored under.

    What several KPIs share is summed up and stored once, not scanned from the
    fact for each. sums gives what is summed up already (see totals.shared_sums); only the
    rank of each order then reads the fact.
    """
    fact = tables["fact_orders"]
    sums = sums or {
        "days": by_day(fact),
        "customers": by_customer(fact),
        "categories": by_category(fact, tables["dim_category"]),
        "hours": by_hour(fact),
        "products": by_product(fact),
    }
    days = materialize(sums["days"], "by_day")
    customers = materialize(sums["customers"], "by_customer")
    categories = materialize(sums["categories"], "by_category")
    return {
        "kpi_daily_revenue": daily_revenue(days),
        "kpi_top_categories": top_categories(categories),
        "kpi_order_rank_per_customer": order_rank_per_customer(fact),
        "kpi_revenue_lag": revenue_lag(days),
        "kpi_running_revenue": running_revenue(days),
        "kpi_customer_ntile": customer_ntile(customers),
        "kpi_avg_order_value": avg_order_value(days),
        "kpi_orders_per_customer": orders_per_customer(customers),
        "kpi_peak_hour": busiest(sums["hours"]),
        "kpi_top_products": greatest_products(sums["products"]),
        "kpi_revenue_by_week": revenue_by_week(days),
        "kpi_quantity_by_category": quantity_by_category(categories),
    }
