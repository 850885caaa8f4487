"""Known input shapes, brought to the canonical order schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The canonical columns, and the columns that mark a taxi trip file.
CANONICAL_COLUMNS = [
    "order_id",
    "customer_id",
    "product_id",
    "order_ts",
    "updated_at",
    "category",
    "amount",
    "quantity",
]
TAXI_COLUMNS = [
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "PULocationID",
    "DOLocationID",
]
CANONICAL = "canonical"
TAXI = "nyc_tlc_yellow_taxi"


def _whole(c: Column, dtype: T.DataType) -> Column:
    """Whole number, cutting a fraction off; unreadable values to null."""
    if isinstance(dtype, T.StringType):
        return F.coalesce(c.try_cast("bigint"), c.try_cast("double").try_cast("bigint"))
    return c.try_cast("bigint")


def _time_text(c: Column, dtype: T.DataType) -> Column:
    """A timestamp with nine decimals, whatever its stored unit; text as it is."""
    text = c.cast("string")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.concat(F.substring(text, 1, 19), F.lit("."), F.rpad(F.substring(text, 21, 6), 9, "0"))
    return text


def _optional(df: DataFrame, name: str, to: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(to)


def adapt_taxi(df: DataFrame) -> DataFrame:
    """One order per trip: the vendor is customer and category, the route the product."""
    types = {field.name: field.dataType for field in df.schema.fields}
    vendor, pu, do = (F.col(n).cast("string") for n in ("VendorID", "PULocationID", "DOLocationID"))
    pickup, dropoff = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    passengers = _optional(df, "passenger_count", "bigint")
    bar, dash = F.lit("|"), F.lit("-")
    # concat, unlike concat_ws, gives null when a part is null, and Silver quarantines the row
    return df.select(
        F.concat(
            F.lit("trip_"), bar, vendor, bar, _time_text(pickup, types["tpep_pickup_datetime"]), bar, pu, bar, do
        ).alias("order_id"),
        F.concat(F.lit("vendor_"), vendor).alias("customer_id"),
        F.concat(F.lit("route_"), dash, pu, dash, do).alias("product_id"),
        pickup.alias("order_ts"),
        F.coalesce(dropoff, pickup).alias("updated_at"),
        F.concat(F.lit("vendor_"), vendor).alias("category"),
        F.coalesce(
            _optional(df, "total_amount", "double").try_cast("double"),
            _optional(df, "fare_amount", "double").try_cast("double"),
        ).alias("amount"),
        F.coalesce(_whole(passengers, types.get("passenger_count", T.LongType())), F.lit(1)).alias("quantity"),
        *[c for c in df.columns if c == "_metadata"],  # of a frame put together from several scans
    )


def adapt_to_canonical(df: DataFrame, source: str) -> tuple[DataFrame, str]:
    """The frame in the canonical schema, and the name of the shape it had."""
    names = set(df.columns)
    if names.issuperset(CANONICAL_COLUMNS):
        return df, CANONICAL
    if names.issuperset(TAXI_COLUMNS):
        return adapt_taxi(df), TAXI
    raise ValueError(
        f"Unsupported schema for input {source}: needs the canonical columns {CANONICAL_COLUMNS} "
        f"or the taxi trip columns {TAXI_COLUMNS}"
    )


def align_to(df: DataFrame, columns: list[str]) -> DataFrame:
    """The named columns in that order, nulls for those the frame lacks."""
    return df.select([F.col(c) if c in df.columns else F.lit(None).alias(c) for c in columns])
