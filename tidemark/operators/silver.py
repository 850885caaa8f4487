"""Cleaning: types, validity, latest version of each order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import strip_whitespace
from tidemark.functions.time import as_naive_timestamp
from tidemark.operators.adapt import CANONICAL_COLUMNS, _whole

KEY = "order_id"
VERSION = "updated_at"


def normalize(df: DataFrame) -> DataFrame:
    """Cast the canonical columns; what cannot be read becomes null and is quarantined."""
    types = {field.name: field.dataType for field in df.schema.fields}
    return df.withColumns(
        {
            "order_id": F.col("order_id").cast("string"),
            "customer_id": F.col("customer_id").cast("string"),
            "product_id": F.col("product_id").cast("string"),
            "category": strip_whitespace(F.lower(F.col("category").cast("string"))),
            "amount": F.col("amount").try_cast("double"),
            "quantity": _whole(F.col("quantity"), types["quantity"]),
            "order_ts": as_naive_timestamp(F.col("order_ts"), types["order_ts"]),
            "updated_at": as_naive_timestamp(F.col("updated_at"), types["updated_at"]),
        }
    )


def is_valid() -> Column:
    """The rule of valid rows; it is null, so not true, where amount or quantity is null."""
    rule = F.col("amount") > 0
    rule = rule & (F.col("quantity") > 0)
    for c in ("order_id", "customer_id", "product_id", "order_ts", "updated_at"):
        rule = rule & F.col(c).isNotNull()
    return rule


def valid_rows(df: DataFrame) -> DataFrame:
    # the bare rule, so that its parts are pushed down to the scan
    return df.where(is_valid())


def quarantined_rows(df: DataFrame) -> DataFrame:
    """Every row that is not valid, those with a null amount or quantity included."""
    return df.where(~F.coalesce(is_valid(), F.lit(False)))


def _sortable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _sortable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_sortable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def _tie_breakers(df: DataFrame) -> list[Column]:
    """Every other column: canonical ones first, then by name; what has no order goes by a hash of its JSON text."""
    types = {f.name: f.dataType for f in df.schema.fields if f.name not in (KEY, VERSION)}
    names = [c for c in CANONICAL_COLUMNS if c in types] + sorted(set(types) - set(CANONICAL_COLUMNS))
    return [F.col(f"`{c}`") if _sortable(types[c]) else F.xxhash64(F.to_json(F.col(f"`{c}`"))) for c in names]


def latest_per_order(df: DataFrame) -> DataFrame:
    """The row with the greatest updated_at of each order_id.

    Rows equal in updated_at are ordered by their remaining columns, greatest
    first, so the same row wins in any partitioning. Spark cuts to one row per
    order in each map task before the shuffle (WindowGroupLimit), so an order
    with very many versions does not load one reducer. The hash leads the window's
    sort because ids share long prefixes and are slow to compare.
    """
    newest_first = [c.desc_nulls_last() for c in [F.col(VERSION), *_tie_breakers(df)]]
    place = F.row_number().over(Window.partitionBy(F.xxhash64(KEY), KEY).orderBy(*newest_first))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def build_silver(bronze: DataFrame) -> DataFrame:
    return latest_per_order(valid_rows(normalize(bronze)))
