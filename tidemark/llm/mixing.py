"""Mixing sources to target weights by systematic sampling.

A source's target is its weight's share of all words, at most max_repeat times
what it has; the excess goes to the others by weight until none is above (found
in one pass: sources in order of cap / weight fill up first). Within a source
every document's expected copies are target / size of the source. Documents are
ordered by size, their expected copies summed up from the front, one random offset per
source is added, and a document is emitted once per integer that its step crosses. As
neighbours are alike in size, the words taken miss the target by less than the
source's longest document.

The place of a document in its source comes from a numbering that splits sources
of more than rows_per_task documents over tasks, so the running sum, place times
expected copies, needs no single task and reruns agree.

Defined cases: a null or empty text has size 0 and is sampled like any other; null
is a source of its own, the last; repeated rows are sampled one by one; without
words all targets are 0; other columns pass through `mixed`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.rows import packed, unpacked
from tidemark.operators.ranking import positions
from tidemark.session import materialize

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
SEED = "mix"
ROWS_PER_TASK = 100_000


def word_count(text: Column) -> Column:
    """Runs of bytes other than space and 0x09-0x0D."""
    bare = F.regexp_replace(text, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    return F.when(F.coalesce(bare, F.lit("")) == "", 0).otherwise(F.size(F.split(bare, r"[\x20\x09-\x0D]+"))).cast("bigint")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size, target) from (source, source_size); one row per source."""
    # one row per source, so a window without partitions is small
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn - 1) % len(weights) + 1)
    cap = F.col("source_size") * F.lit(float(max_repeat))
    rows = sizes.withColumn("weight", weight).withColumn("cap", cap)
    by = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, onward = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    rows = rows.withColumn("full", F.col("cap") <= F.col("weight") * left / F.sum("weight").over(onward))
    everything = Window.partitionBy()
    spare = F.sum("source_size").over(everything) - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(everything)
    share = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(everything)
    target = F.when(F.col("full"), F.col("cap")).otherwise(F.col("weight") * (spare / share))
    return rows.select("source", "source_size", target.alias("target"))


def offset(source: Column, seed: str) -> Column:
    """A number in [0, 1) drawn for each source."""
    text = F.md5(F.concat(F.lit(seed), F.coalesce(source, F.lit("\u0000"))))
    return F.conv(F.substring(text, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def _drawn(rows: DataFrame, weights, max_repeat, seed, rows_per_task) -> DataFrame:
    """rows has id, source, size and anything else; adds source_size, target and copies."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    aims = materialize(targets(sizes, weights, max_repeat), "targets")
    order = [F.col("size").asc(), F.col("id").asc_nulls_last(), F.col("row").asc()]
    placed = positions(rows, order, ["source"], "place", rows_per_task).withColumnRenamed("source", "from")
    placed = placed.join(aims, F.col("from").eqNullSafe(F.col("source")))
    # without words any number of copies takes none
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    start = offset(F.col("source"), seed)
    copies = F.floor(start + each * F.col("place")) - F.floor(start + each * (F.col("place") - 1))
    return placed.withColumn("copies", F.least(copies, F.lit(max_repeat)).cast("bigint")).drop("from")


def draw(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_repeat: int = MAX_REPEAT,
    seed: str = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """One row per document: id, uid, text_key, source, size, source_size, target, copies."""
    rows = packed(docs, text_col, id=id_col, source=source_col)
    rows = rows.select(
        F.col("id").cast("bigint").alias("id"),
        F.coalesce(F.col("id").cast("bigint"), F.lit(0).cast("bigint")).alias("uid"),
        F.xxhash64("id", "text").alias("text_key"),
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text")).alias("size"),
        F.monotonically_increasing_id().alias("row"),
    )
    return _drawn(materialize(rows, "sized"), weights, max_repeat, seed, rows_per_task).drop("row", "place")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The documents, each as often as it was drawn."""
    drawn = draw(docs, id_col=id_col, text_col=text_col, source_col=source_col, **how)
    copies = drawn.groupBy("uid", "text_key", "source").agg(F.sum("copies").alias("copies"), F.count("*").alias("rows"))
    copies = copies.where("copies > 0").withColumnRenamed("source", "from")
    rows = packed(docs, text_col, id=id_col, source=source_col)
    rows = rows.withColumn("uid", F.coalesce(F.col("id").cast("bigint"), F.lit(0).cast("bigint")))
    rows = rows.withColumn("text_key", F.xxhash64("id", "text")).withColumn("source", F.col("source").cast("string"))
    rows = rows.join(copies.hint("merge"), ["uid", "text_key"]).where(F.col("source").eqNullSafe(F.col("from")))
    # rows equal in id, text and source share what they drew together
    turn = F.row_number().over(Window.partitionBy("uid", "text_key", "source").orderBy(F.lit(1)))
    rows = rows.withColumn("turn", F.when(F.col("rows") > 1, turn).otherwise(1))
    each = F.floor(F.col("copies") / F.col("rows")) + F.when(F.col("turn") <= F.col("copies") % F.col("rows"), 1).otherwise(0)
    rows = rows.withColumn("each", each.cast("int")).where("each > 0")
    return unpacked(rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("each")))), docs.columns, text_col)


ORACLE_SQL = """
WITH sized AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0
    ELSE len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) END::BIGINT AS size FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, source_size * 3.0::DOUBLE AS cap,
    [5.0::DOUBLE, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM sums),
filled AS (SELECT *, cap <= weight * ((SELECT sum(source_size)::DOUBLE FROM sums)
    - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
    / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    AS is_full FROM weighed),
rest AS (SELECT (SELECT sum(source_size)::DOUBLE FROM sums) - coalesce(sum(cap) FILTER (is_full), 0.0) AS spare,
    sum(weight) FILTER (NOT is_full) AS share FROM filled),
aims AS (SELECT source, source_size, CASE WHEN is_full THEN cap ELSE weight * (spare / share) END AS target,
    ('0x' || substr(md5('mix' || coalesce(source, chr(0))), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE AS u
    FROM filled, rest),
placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, doc_id NULLS LAST) AS place FROM sized)
SELECT doc_id, size, source_size, target,
  (CASE WHEN source_size > 0 THEN least(3, floor(u + target / source_size * place)
     - floor(u + target / source_size * (place - 1))) ELSE 0 END * size)::BIGINT AS taken
FROM placed JOIN aims ON placed.source IS NOT DISTINCT FROM aims.source
"""
