"""One key with much of the data, when nothing is small enough to broadcast."""

from __future__ import annotations

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tidemark.operators import star
from tidemark.operators.star_join import enrich
from tidemark.session import materialize


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def large_tables(spark):
    """The planner sees tables too large to broadcast and partitions large enough to split."""
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    ):
        yield


def hot_silver(spark):
    """40,000 orders, half of them of one category, product and customer."""

    def key(name):
        return F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit(name), F.col("id") % 500)).alias(name)

    return materialize(
        spark.range(40_000, numPartitions=8).select(
            F.concat(F.lit("o"), "id").alias("order_id"),
            key("customer_id"),
            key("product_id"),
            F.lit("2026-01-01").cast("timestamp_ntz").alias("order_ts"),
            F.lit("2026-01-02").cast("timestamp_ntz").alias("updated_at"),
            key("category"),
            (F.col("id") % 977 + 0.25).alias("amount"),
            F.lit(1).cast("bigint").alias("quantity"),
        ),
        "silver",
    )


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_category_is_split(spark, large_tables):
    silver = hot_silver(spark)
    fact = star.fact_orders(silver, star.dim_category(silver))
    assert "SortMergeJoin(skew=true)" in executed(fact)
    assert fact.count() == 40_000 and fact.where("category_sk IS NULL").count() == 0


def test_a_hot_product_is_split(spark, large_tables):
    silver = hot_silver(spark)
    joined = enrich(star.measures(silver).drop("category"), star.dim_product(silver), star.dim_customer(silver))
    assert "SortMergeJoin(skew=true)" in executed(joined)
    assert joined.count() == 40_000
