"""Stored layers: files at any depth, SQL views."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def register_views(tables: Mapping[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet file, or all Parquet files below a folder, however deep.

    Files may have different columns, which are null where a file lacks them; Spark reads their
    footers in tasks. Names of folders are not columns, and columns of types that don't fit
    one another raise an error.
    """
    return spark.read.options(recursiveFileLookup=True, pathGlobFilter="*.parquet", mergeSchema=True).parquet(path)
