"""What the trained scorers share: folds and bounded samples of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 20_000


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the folds; a null id counts as empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds).cast("int")


def sample(rows: DataFrame, by: str, most: int) -> DataFrame:
    """About `most` rows or all, chosen by a hash of a column, so that reruns agree.

    The bound holds in expectation (its standard deviation is below its root), so
    the result may be broadcast.
    """
    share = min(1.0, most / max(1, rows.count()))
    return rows if share == 1.0 else rows.where(F.pmod(F.xxhash64(by, F.lit("sample")), F.lit(1 << 40)) < int(share * (1 << 40)))
