"""Every query with its Spark form and, where SQL can say it, its DuckDB form."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Check:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


CHECKS: dict[str, Check] = {}


def check(name: str, sql: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        CHECKS[name] = Check(run, sql)
        return run

    return register
