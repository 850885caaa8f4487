"""Freeing what recent states of the stored tables no longer read."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemark.operators.star import DIMENSIONS
from tidemark.plans.totals import kinds
from tidemark.sinks.folders import children, remove
from tidemark.sinks.versions import Versions


def vacuum_tables(spark: SparkSession, output_root: str, keep: int) -> list[str]:
    """Keep the last `keep` states of each stored table of a job; give the folders that were removed.

    Dimensions and totals lie in a folder per version of Silver; those that the kept states of
    the fact name stay. Bronze, quarantine and reports are left alone. Not to be called while a run goes on.
    """
    gold = f"{output_root}/gold"
    fact = Versions(spark, f"{gold}/fact_orders")
    named = {f"version={v}" for v in fact.recent_versions(keep)}
    if not named:  # Gold was never finished: nothing says what a reader may need
        return []
    tables = [f"{output_root}/silver/orders", fact.root, *[f"{gold}/parts/{kind}" for kind in kinds()]]
    gone = [folder for table in tables for folder in Versions(spark, table).vacuum(keep)]
    beside = [f"{gold}/{name}" for name in DIMENSIONS] + [f"{gold}/totals/{kind}" for kind in kinds()]
    unnamed = [f"{path}/{v}" for path in beside for v in children(spark, path) if v not in named]
    remove(spark, unnamed)
    return gone + unnamed
