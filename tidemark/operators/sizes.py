"""How large a frame is before it is broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A broadcast table's limit, reckoned with the overhead of a hash table entry.
BROADCAST_BYTES = 64 << 20
ENTRY_BYTES = 64


def fits_broadcast(df: DataFrame, text_column: str, limit: int = BROADCAST_BYTES) -> bool:
    """Whether a stored frame of one text column (and small others) may be broadcast."""
    entry = F.coalesce(F.octet_length(text_column), F.lit(0)) + F.lit(ENTRY_BYTES).cast("bigint")
    return (df.agg(F.sum(entry)).first()[0] or 0) <= limit
