"""Input files."""

from __future__ import annotations

from pathlib import PurePosixPath
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.relax import relaxed_union
from tidemark.session import materialize
from tidemark.sinks.files import CSV_FORM
from tidemark.sources.records import has_broken_values, quoted_records, text_lines

PREVIEW_ROWS = 2000
SMALL_SPLITS = 32


def read_raw(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    json_lines: bool | None = None,
    quoted_lines: bool | None = None,
) -> DataFrame:
    """Read CSV, JSON or Parquet, chosen by the suffix of the path.

    CSV values may be quoted, with doubled quotes, commas and line breaks in them. Files whose
    headers differ in names or order raise an error. Where a value holds a line break, records
    are put together from the lines of each split (see `records`); unless quoted_lines says
    whether one does, a pass over the files tells. CSV and JSON values stay text until Silver
    casts them, so no pass over the data infers types. A JSON file has one record per line, which Spark can
    split, or one document (an array of records); unless json_lines says which for all files, the first line
    of each that isn't blank tells, and files of both forms may lie in one folder.
    Without a schema Spark passes over JSON once for the field names, so give
    one when the input is large.

    A frame put together from several scans has the column `_metadata` with the file_name
    of each row, which a single scan has hidden.
    """
    suffix = PurePosixPath(str(path)).suffix.lower()
    reader = spark.read if schema is None else spark.read.schema(schema)
    if suffix == ".csv":
        lines = text_lines(spark, str(path))
        if has_broken_values(lines) if quoted_lines is None else quoted_lines:
            return _from_records(quoted_records(lines), schema)
        return reader.options(header=True, enforceSchema=False, **CSV_FORM).csv(str(path))
    if suffix == ".json":
        if json_lines is None:
            return _read_json(spark, str(path), schema)
        return reader.options(multiLine=not json_lines, primitivesAsString=True).json(str(path))
    if suffix == ".parquet":
        return reader.parquet(str(path))
    raise ValueError(f"Unsupported input type: {suffix}")


def _file_name(path: Column) -> Column:
    """As scans give it."""
    return F.struct(F.element_at(F.split(path, "/"), -1).alias("file_name"))


def _from_records(records: DataFrame, schema: T.StructType | None) -> DataFrame:
    """The values of CSV records under the files' header."""
    spark = records.sparkSession
    records = records.select("file", "opening", F.rtrim("record", F.lit("\r")).alias("record"))
    headers = records.where("opening").select(F.ltrim("record", F.lit("\ufeff")).alias("record")).distinct().limit(2).collect()
    if len(headers) > 1:
        raise ValueError(f"The files' headers differ: {[r.record for r in headers]}")
    if not headers:
        return spark.createDataFrame([], schema or T.StructType())
    named = spark.read.options(header=True, **CSV_FORM).csv(spark.sparkContext.parallelize([headers[0].record], 1)).schema
    names = [f.name for f in named.fields]
    if schema is not None and [f.name.lower() for f in schema.fields] != [n.lower() for n in names]:
        raise ValueError(f"The header {names} doesn't conform to the schema {schema.fieldNames()}")
    text = schema or T.StructType([T.StructField(n, T.StringType()) for n in names])
    rows = records.where("not opening and trim(record) <> ''")
    return rows.select(F.from_csv("record", _ddl(text), CSV_FORM).alias("row"), _file_name(F.col("file")).alias("_metadata")).select(
        "row.*", "_metadata"
    )


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)


def _read_json(spark: SparkSession, path: str, schema: T.StructType | None) -> DataFrame:
    """Each file by its own form; with both forms, two scans put together."""
    lines = text_lines(spark, path).withColumn("id", F.monotonically_increasing_id()).where(F.trim("value") != "")
    # each file's first line that isn't blank, found in one pass, then whether that line stands for itself
    first = lines.groupBy("file").agg(F.min_by("value", F.struct("block", "id")).alias("value"))
    line = F.ltrim("value", F.lit("\ufeff"))
    alone = F.json_object_keys(line).isNotNull() | F.json_array_length(line).isNotNull()
    verdicts = first.select("file", alone.alias("alone"))
    verdicts = materialize(verdicts, "verdicts")
    forms = [r.alone for r in verdicts.select("alone").distinct().collect()]
    reader = spark.read if schema is None else spark.read.schema(schema)
    reader = reader.option("primitivesAsString", True)
    if len(forms) < 2:
        return reader.option("multiLine", forms != [True]).json(path)
    parts = []
    for form in (True, False):  # the driver lists the files of an input anyway
        files = [unquote(r.file) for r in verdicts.where(F.col("alone") == form).select("file").collect()]
        part = reader.option("multiLine", not form).json(files)
        parts.append(part.select("*", F.struct("_metadata.file_name").alias("_metadata")))
    return relaxed_union(*parts)


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a small input out to all cores when its files have too few splits.

    One file of a few row groups would otherwise keep one core per row group
    busy. Inputs of more than SMALL_SPLITS splits are left as they are, so
    nothing large is ever shuffled here. Rows go by the hash of their values,
    which a repeated task finds again.
    """
    splits, cores = df.rdd.getNumPartitions(), df.sparkSession.sparkContext.defaultParallelism
    if splits >= min(cores, SMALL_SPLITS):
        return df
    return df.repartition(cores, *[f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)])


def preview(df: DataFrame, order_by: list[str] | None = None, rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows of a result for display, in a fixed order when one is named."""
    return (df.orderBy(*order_by) if order_by else df).limit(rows)
