"""Checks of a frame's columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def require_columns(df: DataFrame, required: Iterable[str]) -> None:
    """Raise ValueError naming the columns, in their order, that the frame doesn't have."""
    absent = dict.fromkeys(required)
    for name in df.columns:
        absent.pop(name, None)
    if absent:
        raise ValueError(f"the input has no column {', '.join(map(repr, absent))}; missing columns can't be loaded")
