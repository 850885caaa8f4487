"""Raw rows with the marks of their ingestion."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stamp(df: DataFrame, ingested_at: datetime, source_file: str | None = None) -> DataFrame:
    """Add source_file (the name of the file each row came from) and ingest_time.

    source_file is needed only for frames that were not scanned from files.
    """
    origin = F.col("_metadata.file_name") if source_file is None else F.lit(source_file)
    return df.withColumns({"source_file": origin, "ingest_time": F.lit(ingested_at.isoformat())}).drop("_metadata")
