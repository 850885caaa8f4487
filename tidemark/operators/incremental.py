"""Merging new rows into an existing Silver table."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import naive
from tidemark.operators.relax import relaxed_union
from tidemark.operators.silver import KEY, VERSION, latest_per_order
from tidemark.operators.sizes import BROADCAST_BYTES, fits_broadcast
from tidemark.session import materialize


def high_water_mark(silver: DataFrame) -> datetime | None:
    return silver.agg(F.max(VERSION)).first()[0]


def newer_than(valid: DataFrame, mark: datetime | None, lateness: timedelta | None = None) -> DataFrame:
    """Rows beyond the mark, or beyond a bound that much before it; all when there is no mark."""
    if mark is None:
        return valid
    bound = mark - lateness if lateness else mark
    return valid.where(F.col(VERSION) > naive(bound))


def merge_latest(existing: DataFrame, incoming: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Latest row per order of both frames, each of which holds an order once; incoming is stored.

    Columns that one side lacks are null there; a column of two types takes the
    wider one, or text. The ids of a small batch are
    broadcast, and the existing rows of other orders pass without a shuffle; a
    larger batch is merged by a shuffle of both sides.
    """
    if not fits_broadcast(incoming, KEY, broadcast_bytes):
        return latest_per_order(relaxed_union(existing, incoming))
    ids = F.broadcast(incoming.select(KEY))
    kept = existing.join(ids, KEY, "left_anti")
    touched = relaxed_union(existing.join(ids, KEY, "left_semi"), incoming)
    return relaxed_union(kept, latest_per_order(touched))


def changed_days(existing: DataFrame, incoming: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Days that a merge changes: those of the new rows, and those an updated order leaves."""
    ids = incoming.select(KEY)
    if fits_broadcast(incoming, KEY, broadcast_bytes):
        ids = F.broadcast(ids)
    left = existing.select(KEY, "order_date").join(ids, KEY, "left_semi").select("order_date")
    return left.union(incoming.select("order_date")).distinct()


def load(
    existing: DataFrame | None,
    valid: DataFrame,
    full_refresh: bool = False,
    lateness: timedelta | None = None,
) -> DataFrame:
    """Silver after a batch of valid rows; the existing frame itself when none of them is new."""
    if existing is None or full_refresh:
        return latest_per_order(valid)
    new = newer_than(valid, high_water_mark(existing), lateness)
    incoming = materialize(latest_per_order(new), "incoming")
    return existing if incoming.isEmpty() else merge_latest(existing, incoming)
