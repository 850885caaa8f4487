"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import strip_whitespace


def composite_key(*parts: Column) -> Column:
    """SHA-256 of the parts, each stripped and lower-cased; a null counts as 'none'."""
    # coalesce comes first because concat_ws would leave nulls out
    words = [F.coalesce(F.lower(strip_whitespace(p.cast("string"))), F.lit("none")) for p in parts]
    return F.sha2(F.concat_ws("||", *words), 256)
