"""What the package needs of the caller's session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_scratch: dict[str, str] = {}


def pin_utc(spark: SparkSession) -> SparkSession:
    """Make zoned timestamps read as UTC; nothing else of the session is changed."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared folder that spark.checkpoint.dir names.

    Only a local master may go without that setting; executors of a cluster do
    not share the driver's temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _local_scratch:
            _local_scratch[app] = tempfile.mkdtemp(prefix="tidemark-")
        base = _local_scratch[app]
    return f"{base.rstrip('/')}/tidemark/{uuid.uuid4().hex}/{name}"


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Later reads see fixed rows whatever executors are lost, prune columns, and
    give the planner the real size to choose joins by.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
