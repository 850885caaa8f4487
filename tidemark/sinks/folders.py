"""Folders of a store that Spark can write to, listed and removed from the driver."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

REMOVES_AT_ONCE = 8


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def children(spark: SparkSession, path: str) -> list[str]:
    """The names directly below a folder, without hidden ones; none if there is no such folder."""
    store, place = _at(spark, path)
    if not store.exists(place):
        return []
    names = (entry.getPath().getName() for entry in store.listStatus(place))
    return sorted(name for name in names if not name.startswith(("_", ".")))


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Remove folders with all below them; those already gone are passed over."""

    def one(path: str) -> None:
        store, place = _at(spark, path)
        store.delete(place, True)

    with ThreadPoolExecutor(REMOVES_AT_ONCE) as pool:
        list(pool.map(one, paths))
