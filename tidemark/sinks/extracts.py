"""Bounded extracts of results for publication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame

from tidemark.sinks.files import write_csv

MAX_ROWS = 5000
# results that do not end in an order of their own
ORDER_OF = {
    "kpi_order_rank_per_customer": ("customer_id", "rn"),
    "kpi_customer_ntile": ("total_revenue", "customer_id"),
}


def capped(df: DataFrame, order_by: Sequence[Column | str] = (), max_rows: int = MAX_ROWS) -> DataFrame:
    """The first rows of a result, in the given order (results that end in an order keep it)."""
    return (df.orderBy(*order_by) if order_by else df).limit(max_rows)


def publish_extracts(
    kpis: Mapping[str, DataFrame],
    validations: Mapping[str, DataFrame],
    target: str,
    source: str,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Write KPI results cut to max_rows, validations whole, and a manifest; give the manifest."""
    for name, df in kpis.items():
        write_csv(capped(df, ORDER_OF.get(name, ()), max_rows), f"{target}/kpis/{name}")
    for name, df in validations.items():
        write_csv(df, f"{target}/validation/{name}")
    spark = next(iter([*kpis.values(), *validations.values()])).sparkSession
    note = "each result is cut to its first rows; validations are whole"
    manifest = spark.createDataFrame([(source, max_rows, note)], "source string, max_rows_per_csv int, note string")
    write_csv(manifest, f"{target}/manifest")
    return manifest
