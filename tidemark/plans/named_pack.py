"""Packs of named SQL queries over the stored layers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.layers import register_views


def run_named_pack(
    spark: SparkSession, tables: Mapping[str, DataFrame], pack: Mapping[str, str]
) -> dict[str, DataFrame]:
    """Register the tables as views and give each query's (lazy) result by its name."""
    register_views(tables)
    return {name: spark.sql(text) for name, text in pack.items()}
