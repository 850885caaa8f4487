"""Records of text files whose values may hold line breaks, read by many tasks per file.

Spark's multi-line CSV reader takes a file as a whole. Here lines are read split by split, as
plain text, and only whether a split begins within a quoted value is found beforehand: each
line's quotes are counted, a split's sum gives its parity, and the parities of a file's earlier splits,
added up, say where the next one begins. Within a split a record ends at each line after which
the count is even. What a split holds of records that cross its ends is put together
afterwards; there are two such pieces a split at most, however large the file.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Splits that begin within a value are named to the tasks: one number each, at most so many.
MOST_INSIDE = 1_000_000
_HEAD, _WHOLE, _MIDDLE, _TAIL = range(4)
_PIECE = "file string, block bigint, kind int, opening boolean, record string"


def text_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(value, file, block): the lines of the files, each with its file and where its split begins."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _quotes(value) -> F.Column:
    return F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))


def has_broken_values(lines: DataFrame) -> bool:
    """Whether a value goes on over a line's end: then, and only then, a line has an odd number of quotes."""
    return not lines.where(_quotes(F.col("value")) % 2 == 1).isEmpty()


def splits_inside(lines: DataFrame) -> DataFrame:
    """(file, block) of the splits that begin within a quoted value."""
    blocks = lines.groupBy("file", "block").agg((F.sum(_quotes(F.col("value"))) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.withColumn("before", F.coalesce(F.sum("odd").over(before), F.lit(0))).where("before % 2 = 1").select("file", "block")


def _assembled(inside: set[tuple[str, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []  # the lines of a record that isn't complete
        place, continued = None, False

        def pieces(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [()] * 5
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string())
            names = ["file", "block", "kind", "opening", "record"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        def unfinished() -> list[tuple]:
            return [(*place, _MIDDLE if continued else _HEAD, opening, "\n".join(held))] if held else []

        opening = False
        for batch in batches:
            files, blocks = batch.column("file").to_pylist(), batch.column("block").to_numpy()
            values = batch.column("value").to_pylist()
            odd = pc.count_substring(batch.column("value"), '"').to_numpy(zero_copy_only=False) % 2
            # a file is named by one object per split, so most comparisons are cheap
            cuts = [i for i in range(len(files)) if i == 0 or blocks[i] != blocks[i - 1] or files[i] != files[i - 1]]
            out: list[tuple] = []
            for lo, hi in zip(cuts, [*cuts[1:], len(files)]):
                now = (files[lo], int(blocks[lo]))
                if now != place:
                    out += unfinished()
                    place, held, continued = now, [], now in inside
                    opening = now[1] == 0
                parity = np.cumsum(odd[lo:hi]) + (1 if held or continued else 0)
                at = lo
                for end in (np.flatnonzero(parity % 2 == 0) + lo).tolist():
                    record = values[end] if end == at and not held else "\n".join([*held, *values[at : end + 1]])
                    out.append((*place, _TAIL if continued else _WHOLE, opening, record))
                    at, held, continued, opening = end + 1, [], False, False
                held += values[at:hi]
            yield pieces(out)
        if place is not None:
            yield pieces(unfinished())

    return run


def quoted_records(lines: DataFrame) -> DataFrame:
    """(file, opening, record): the records of the files; opening marks each file's first."""
    inside = splits_inside(lines).limit(MOST_INSIDE + 1).collect()
    if len(inside) > MOST_INSIDE:
        raise ValueError(f"More than {MOST_INSIDE} splits begin within a value; raise spark.sql.files.maxPartitionBytes")
    found = lines.mapInArrow(_assembled({(r.file, r.block) for r in inside}), _PIECE)
    whole = found.where(F.col("kind") == _WHOLE).select("file", "opening", "record")
    parts = found.where(F.col("kind") != _WHOLE)
    # within a split what ends an earlier record comes before what begins one
    place = F.struct("block", F.when(F.col("kind") == _HEAD, 1).otherwise(0))
    number = F.count_if(F.col("kind") == _HEAD).over(Window.partitionBy("file").orderBy(place))
    parts = parts.withColumn("number", number).withColumn("place", place)
    joined = parts.groupBy("file", "number").agg(
        F.bool_or("opening").alias("opening"), F.array_sort(F.collect_list(F.struct("place", "record"))).alias("pieces")
    )
    return whole.unionByName(joined.select("file", "opening", F.array_join("pieces.record", "\n").alias("record")))
