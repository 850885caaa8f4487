"""Exact positions in large ordered groups.

row_number() and ntile() sort a group in one task. Groups here may be the whole
table, or one customer with a third of it, so groups beyond a checked size are
sorted across tasks and numbered by slot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.session import materialize

ROWS_PER_TASK = 4_000_000
MAX_SLOTS = 100_000


def running(
    df: DataFrame,
    order_by: Sequence[Column],
    within: Sequence[str] = (),
    weight: str | None = None,
    out: str = "rn",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add the 1-based place of each row within its group, or the running sum of its weight.

    order_by must leave no ties inside a group. df is read up to three times,
    so it should be a stored table.
    """
    within = list(within)
    sizes = df.groupBy(*within).agg(F.count("*").alias("n")) if within else df.agg(F.count("*").alias("n"))
    largest, rows = sizes.agg(F.max("n"), F.sum("n")).first()
    if (largest or 0) <= rows_per_task:
        return df.withColumn(out, _place(Window.partitionBy(*within).orderBy(*order_by), weight))

    # Sort the rows across slots of about rows_per_task rows. They are stored
    # with their slot number because the slot bounds come from a sample, which
    # another evaluation could draw differently.
    slots = min(MAX_SLOTS, -(-rows // rows_per_task))
    placed = materialize(
        df.repartitionByRange(slots, *[F.col(c).asc() for c in within], *order_by).withColumn(
            "_slot", F.spark_partition_id()
        ),
        "placed",
    )
    numbered = placed.withColumn("_local", _place(Window.partitionBy("_slot", *within).orderBy(*order_by), weight))

    # What the same group holds in earlier slots. Slots are contiguous, so at most
    # one group runs on into a slot: no more rows than slots, hence the broadcast.
    earlier = Window.partitionBy(*within).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    held = F.count("*") if weight is None else F.sum(weight)
    carry = (
        placed.groupBy("_slot", *within)
        .agg(held.alias("_held"))
        .withColumn("_before", F.sum("_held").over(earlier))
        .where(F.col("_before").isNotNull())
        .select("_slot", *within, "_before")
    )
    match = F.col("a._slot") == F.col("b._slot")
    for c in within:
        match = match & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    place = (F.col("a._local") + F.coalesce(F.col("b._before"), F.lit(0))).cast("bigint").alias(out)
    return (
        numbered.alias("a")
        .join(F.broadcast(carry).alias("b"), match, "left")
        .select(*[F.col(f"a.{c}") for c in df.columns], place)
    )


def _place(window: WindowSpec, weight: str | None) -> Column:
    if weight is None:
        return F.row_number().over(window).cast("bigint")
    return F.sum(weight).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def positions(
    df: DataFrame,
    order_by: Sequence[Column],
    within: Sequence[str] = (),
    out: str = "rn",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """ROW_NUMBER() over the order, for groups of any size."""
    return running(df, order_by, within, None, out, rows_per_task)


def bucket_of(place: Column, rows: int, buckets: int) -> Column:
    """The ntile bucket of a place among so many rows: the first rows % buckets are one longer."""
    size, longer = divmod(rows, buckets)
    if size == 0:
        return place.cast("bigint")
    head = longer * (size + 1)
    return F.when(place <= head, F.ceil(place / F.lit(size + 1))).otherwise(
        F.lit(longer) + F.ceil((place - F.lit(head)) / F.lit(size))
    ).cast("bigint")


def ntile(
    df: DataFrame,
    buckets: int,
    order_by: Sequence[Column],
    out: str,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """NTILE(buckets) over the whole frame in one order. df should be a stored table."""
    rows = df.count()
    placed = positions(df, order_by, out="_rank", rows_per_task=rows_per_task)
    return placed.withColumn(out, bucket_of(F.col("_rank"), rows, buckets)).drop("_rank")


def top_k(df: DataFrame, label: str, value: str, k: int = 5) -> DataFrame:
    """The k greatest (label, value) pairs; equal values in label order."""
    pairs = df.select(F.col(label).cast("string").alias(label), F.col(value).cast("double").alias(value))
    return pairs.orderBy(F.col(value).desc_nulls_last(), F.col(label).asc_nulls_last()).limit(k)
