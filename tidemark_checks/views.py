"""The driver's tables seen as orders, trips and events (FIXTURES.md F4, F5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.adapt import adapt_taxi
from tidemark.operators.silver import build_silver
from tidemark.operators.star import measures
from tidemark.session import materialize, pin_utc
from tidemark.sources.raw import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LINE_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"]


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one order per line item, with null customers, null and negative amounts."""
    pin_utc(spark)
    lines = spread(table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS))
    orders, part = table(spark, sf_dir, "orders"), table(spark, sf_dir, "part")
    key = F.col("l_orderkey")
    return (
        lines.join(orders, key == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.concat(F.lit("o"), key, F.lit("-"), F.col("l_linenumber")).alias("order_id"),
            F.when(key % 97 != 0, F.concat(F.lit("cust_"), F.col("o_custkey"))).alias("customer_id"),
            F.concat(F.lit("p"), F.col("l_partkey")).alias("product_id"),
            F.col("o_orderdate").alias("order_ts"),
            F.col("l_shipdate").alias("updated_at"),
            F.concat(F.lit("  "), F.col("p_brand"), F.lit(" ")).alias("category"),
            F.when(key % 101 == 0, None)
            .when(key % 53 == 0, -F.col("l_extendedprice"))
            .otherwise(F.col("l_extendedprice"))
            .alias("amount"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            F.col("l_suppkey").alias("supplier"),
        )
    )


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_silver(raw_orders(spark, sf_dir))


def stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver as the job stores it, for what reads it more than once."""
    return materialize(silver(spark, sf_dir), "silver")


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact's measures with the category itself, for what needs no category key."""
    return measures(silver(spark, sf_dir))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F5a: events as orders; they have times of day."""
    pin_utc(spark)
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("e"), F.col("event_id")).alias("order_id"),
        F.concat(F.lit("vendor_"), F.col("user_id")).alias("customer_id"),
        F.col("event_type").alias("product_id"),
        F.col("ts").alias("order_ts"),
        F.col("ts").alias("updated_at"),
        F.col("event_type").alias("category"),
        F.col("value").alias("amount"),
        F.get_json_object("props", "$.k").cast("bigint").alias("quantity"),
    )


def event_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measures(build_silver(raw_events(spark, sf_dir)))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F5b: line items in the shape of taxi trips; a route has several vendors."""
    pin_utc(spark)
    lines = spread(table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS).drop("l_quantity"))
    orders = table(spark, sf_dir, "orders")
    key = F.col("l_orderkey")
    return lines.join(orders, key == F.col("o_orderkey")).select(
        (F.col("o_custkey") % 3 + 1).alias("VendorID"),
        F.col("o_orderdate").alias("tpep_pickup_datetime"),
        F.col("l_shipdate").alias("tpep_dropoff_datetime"),
        (F.col("l_partkey") % 265).alias("PULocationID"),
        (F.col("l_suppkey") % 265).alias("DOLocationID"),
        F.when(key % 7 != 0, F.col("l_extendedprice")).alias("total_amount"),
        F.col("l_extendedprice").alias("fare_amount"),
        F.when(key % 11 != 0, F.col("l_linenumber").cast("bigint")).alias("passenger_count"),
    )


def stored_trip_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(build_silver(adapt_taxi(trips(spark, sf_dir))), "silver")
