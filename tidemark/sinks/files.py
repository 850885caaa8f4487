"""Plain file outputs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# No day of so small a table is too large for one task.
SMALL_TABLE_ROWS = 4_000_000
# Quotes within a value are doubled, as common readers expect; blanks around a value belong to it.
CSV_FORM = {"quote": '"', "escape": '"'}


def write_bronze(df: DataFrame, root: str, ingested_at: datetime, run_id: str) -> str:
    """Add a run's raw rows under its day; only a repeat of the same run replaces them."""
    path = f"{root}/ingest_date={ingested_at:%Y-%m-%d}/run_id={run_id}"
    df.write.mode("overwrite").parquet(path)
    return path


def write_quarantine(df: DataFrame, root: str, run_id: str) -> str:
    """Keep a run's rejects beside those of earlier runs."""
    path = f"{root}/run_id={run_id}"
    df.write.mode("overwrite").parquet(path)
    return path


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV files with headers; AQE leaves one file when the result is small."""
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(header=True, **CSV_FORM, **blanks).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_by_day(
    df: DataFrame, path: str, day: str, order_by: str, rows: int | None = None, in_place: bool = False
) -> None:
    """One folder per day, each file in order.

    A day's rows are gathered so that it has few files. The rebalance hint lets
    AQE split a day that is large into several tasks. By size alone it would
    also pack many small days into one task, which then opens their files one
    by one, so the days of a table known to be small are dealt out to all cores.
    in_place says that the rows come by day already, so nothing is shuffled.
    """
    if in_place:
        gathered = df
    elif rows is not None and rows <= SMALL_TABLE_ROWS:
        gathered = df.repartition(df.sparkSession.sparkContext.defaultParallelism, F.col(day))
    else:
        gathered = df.hint("rebalance", F.col(day))
    gathered.sortWithinPartitions(day, order_by).write.mode("overwrite").partitionBy(day).parquet(path)
