"""Near-duplicate vectors by a forest of random-projection trees.

Vectors of equal label and dimension are split again and again by a random
direction per tree node at the median, with the middle SPILL share going to both
sides, until leaves have at most LEAF vectors. Medians come from mergeable
quantile summaries, so a level of all trees is one aggregate; only (vector, node,
projection) rows are shuffled, not the vectors. Every tree holds every vector.

Random cuts can't part a node of vectors that lie about as near to each other as
linked ones do. So each cut is rated by the chance that a pair at the distance of the
weakest link stays together. Nodes whose cut keeps fewer than SAFE of such pairs are not
cut, nor those below which all trees together would lose more than MISS of them. The
deeper a label's trees get, the more of them it has. A label that isn't cut at all is
in one tree only.

Leaves, whatever their size, are compared exactly in double precision, in pairs of
blocks of about BLOCK vectors. A pair that shares several
leaves counts in the first of them, so links are counted without being emitted;
each pair of blocks hands on, for each vector, its number of new links and the least
vector of its group there. Groups are united over all leaves.

Equal vectors of a label form one class that takes part once, with its size.

Defined cases: a vector that is null, zero, or holds null or non-finite numbers,
or whose label is null, links with nothing and is its own component (null if its
id is null); repeated rows are linked copies; labels of any type are compared as they
are; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.components import components
from tidemark.llm.rows import column
from tidemark.session import materialize

COSINE = 0.93
TREES = 10
LEAF = 1000
SPILL = 0.1
SAFE = 0.85
MISS = 1e-4
BLOCK = 2000
PATH_BITS = 48


def _matrix(lists: pa.ListArray) -> np.ndarray:
    rows = len(lists)
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _projections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        part = batch.column("leaves")
        row = np.repeat(np.arange(len(batch)), np.diff(part.offsets.to_numpy()))
        leaf, out = part.flatten().to_numpy(), np.empty(len(row))
        sizes = np.array(batch.column("dim").to_pylist())
        vectors = {d: _unit(_matrix(batch.column("vector").take(pa.array(np.flatnonzero(sizes == d))))) for d in set(sizes)}
        at = np.zeros(len(batch), np.int64)
        for d in vectors:
            at[sizes == d] = np.arange((sizes == d).sum())
        for here in np.unique(leaf):
            for d, x in vectors.items():
                direction = np.random.default_rng(int(here)).standard_normal(d)
                pick = np.flatnonzero((leaf == here) & (sizes[row] == d))
                out[pick] = x[at[row[pick]]] @ direction * np.sqrt(d / (direction @ direction))
        rows = pa.array(row)
        columns = {k: batch.column(k).take(rows) for k in ("node", "label", "dim")}
        yield pa.RecordBatch.from_pydict(columns | {"leaf": pa.array(leaf), "projection": pa.array(out)})


def _compare(least: float):
    """The links of one pair of a leaf's blocks, or of one block."""

    def run(table: pa.Table) -> pa.Table:
        own, one, two = (table.column(k)[0].as_py() for k in ("leaf", "one", "two"))
        sides = []
        for block in (one, two):
            rows = table.filter(pa.array(table.column("block").to_numpy() == block)).combine_chunks()
            lists = rows.column("leaves").combine_chunks()
            lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
            member, leaf = np.repeat(np.arange(rows.num_rows), np.diff(lists.offsets.to_numpy())), lists.flatten().to_numpy()
            member, leaf = member[leaf < own], leaf[leaf < own]
            by = np.argsort(leaf, kind="stable")
            parts = np.split(member[by], np.flatnonzero(np.diff(leaf[by])) + 1)
            vector = rows.column("vector").combine_chunks()
            vector = vector.chunk(0) if isinstance(vector, pa.ChunkedArray) else vector
            x = _unit(_matrix(vector)) if rows.num_rows else None
            sides.append((rows.column("node").to_numpy(), rows.column("weight").to_numpy(), x, dict(zip(np.unique(leaf), parts))))
        (a, heavy_a, x, in_a), (b, heavy_b, y, in_b) = sides
        empty = {"node": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "least": pa.array([], pa.int64())}
        if len(a) == 0 or len(b) == 0:
            return pa.table(empty)
        near = x @ y.T >= least
        near[a[:, None] == b[None, :]] = False
        group_a, group_b, none = a, b, np.iinfo(np.int64).max
        while True:  # each takes the least of its neighbours
            lower_a = np.minimum(group_a, np.where(near, group_b[None, :], none).min(axis=1))
            lower_b = np.minimum(group_b, np.where(near, lower_a[:, None], none).min(axis=0))
            if (lower_a == group_a).all() and (lower_b == group_b).all():
                break
            group_a, group_b = lower_a, lower_b
        for shared in in_a.keys() & in_b.keys():
            near[np.ix_(in_a[shared], in_b[shared])] = False
        found = [(a, near @ heavy_b, group_a)] + ([(b, heavy_a @ near, group_b)] if one != two else [])
        node, links, group = (np.concatenate(x) for x in zip(*found))
        some = (links > 0) | (group != node)
        return pa.table({"node": node[some], "links": links[some].astype(np.int64), "least": group[some]})

    return run


def _together(link: float):
    """The chance that a member's cut leaves it in one node with a vector at that distance in a random direction."""
    low, high, at = F.col("cut")[0], F.col("cut")[1], F.col("projection")
    z = F.when(at < low, at - high).when(at > high, low - at) / F.lit(link)
    return F.coalesce(1 - 1 / (1 + F.exp(-z * (1.5976 + 0.07056 * z * z))), F.lit(1.0))  # of the normal distribution


def _leaves(vectors: DataFrame, trees: int, leaf_size: int, spill: float, cosine: float) -> DataFrame:
    """(node, label, dim, leaf): the leaves of each vector. A leaf's number is its tree and its path from the root.

    `keep` is the chance of a weakest link to be whole in a node, `trees` the number of trees of the label.
    """

    def roots(first: Column, last: Column) -> Column:
        return F.transform(F.sequence(first, last), lambda t: t.cast("bigint") * F.lit(1 << PATH_BITS) + 1)

    label, columns = ["label", "dim"], ["node", "label", "dim", "leaf", "keep", "trees"]
    key, link = [*label, "leaf"], max(2 - 2 * cosine, 1e-12) ** 0.5
    places = vectors.select(*columns[:3], F.lit(1.0).alias("keep"), F.lit(trees).alias("trees"))
    large = materialize(places.groupBy(*label).agg(F.count("*").alias("n")).where(F.col("n") > leaf_size), "large")
    done = places.join(large.select(*label), label, "left_anti").withColumn("leaf", F.lit(1).cast("bigint")).select(*columns)
    places = places.join(large.select(*label), label)
    places = places.withColumn("leaf", F.explode(roots(F.lit(0), F.lit(trees - 1)))).select(*columns)
    top = True
    while True:
        places = materialize(places, "places")
        sizes = places.groupBy(*key).agg(F.count("*").alias("n"))
        large = materialize(sizes.where(F.col("n") > leaf_size).select(*key), "large")
        done = done.unionByName(places.join(large, key, "left_anti"))
        if large.isEmpty():
            return materialize(done.select("node", "label", "dim", "leaf"), "leaves")
        held = places.join(large, key)
        lists = held.groupBy("node").agg(F.collect_list("leaf").alias("leaves"))
        rows = vectors.join(lists, "node").select("node", "label", "dim", "vector", "leaves")
        found = rows.mapInArrow(_projections, "node bigint, label string, dim int, leaf bigint, projection double")
        # equal projections are told apart by a hash, so that every split makes progress
        nudge = F.pmod(F.xxhash64("node", "leaf"), F.lit(1 << 20)) * F.lit(1e-15)
        found = materialize(found.withColumn("projection", F.col("projection") + nudge), "projections")
        cuts = found.groupBy(*key).agg(F.percentile_approx("projection", [0.5 - spill / 2, 0.5 + spill / 2], 2000).alias("cut"))
        cut = found.join(materialize(cuts, "cuts"), key)
        rated = cut.groupBy(*key).agg(F.avg(_together(link)).alias("safe"), F.count("*").alias("n"))
        of_node = places.groupBy(*key).agg(F.first("keep").alias("keep"), F.first("trees").alias("trees"))
        rated = materialize(rated.join(of_node, key), "rated")
        if top:  # all trees of a label are cut or none; there are as many as its depth asks for
            depth = F.ceil(F.log(F.max("n") / F.lit(leaf_size)) / F.lit(-np.log((1 + spill) / 2)))
            whole = F.least(F.pow(F.avg("safe"), depth), F.lit(1 - 1e-9))
            many = F.greatest(F.lit(trees), F.ceil(F.lit(np.log(MISS)) / F.log(1 - whole)).cast("int"))
            asked = rated.groupBy(*label).agg(F.avg("safe").alias("safe"), many.alias("trees"))
            rated = rated.select(*key, "keep").join(materialize(asked, "asked"), label)
        below = F.col("keep") * F.col("safe")
        fits = (F.col("safe") >= SAFE) & (F.lit(True) if top else F.pow(1 - below, "trees") <= MISS)
        rated = materialize(rated.select(*key, below.alias("keep"), "trees", fits.alias("fits")), "rated")
        stay = places.join(rated.where("not fits").select(*key), key)
        done = done.unionByName(stay.where("leaf = 1") if top else stay)
        sides = cut.join(rated.where("fits"), key)
        tree = F.shiftright("leaf", PATH_BITS) * F.lit(1 << PATH_BITS)
        path = (F.col("leaf") - tree) * 2
        left = F.when(F.col("projection") <= F.col("cut")[1], tree + path)
        right = F.when(F.col("projection") >= F.col("cut")[0], tree + path + 1)
        children = F.explode(F.array_compact(F.array(left, right)))
        places = sides.select("node", "label", "dim", "keep", "trees", children.alias("leaf")).select(*columns)
        if top:
            more = rated.where(F.col("fits") & (F.col("trees") > trees)).select(*label, "trees").distinct()
            more = vectors.select("node", *label).join(more, label).withColumn("keep", F.lit(1.0))
            more = more.withColumn("leaf", F.explode(roots(F.lit(trees), F.col("trees") - 1)))
            places = places.unionByName(more.select(*columns))
        top = False


def _block_pairs(members: DataFrame) -> DataFrame:
    """The members of each leaf once for each block that their own is compared with."""
    key = ["label", "dim", "leaf"]
    sizes = members.groupBy(*key).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    rows = members.join(materialize(sizes, "blocks"), key)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node", "leaf"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.withColumn("one", F.least("block", "other")).withColumn("two", F.greatest("block", "other")).drop("blocks", "other")


def _label(rows: DataFrame, name: str) -> Column:
    """A label of any type as text: equal labels, and only those, have equal texts."""
    kind = rows.select(column(rows, name)).schema[0].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (column(rows, name) + 0).cast("string")  # -0.0 is 0.0
    if isinstance(kind, T.BinaryType):
        return F.hex(column(rows, name))
    nested = isinstance(kind, (T.ArrayType, T.MapType, T.StructType))
    return F.to_json(column(rows, name)) if nested else column(rows, name).cast("string")


def near_duplicates(
    rows: DataFrame,
    cosine: float = COSINE,
    trees: int = TREES,
    leaf_size: int = LEAF,
    spill: float = SPILL,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    vector = column(rows, vector_col).cast("array<double>")
    every = rows.select(
        column(rows, id_col).cast("bigint").alias("vec_id"),
        _label(rows, label_col).alias("label"),
        vector.alias("vector"),
        F.monotonically_increasing_id().alias("row"),
    )
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fine = F.coalesce(fine & F.exists("vector", lambda x: x != 0) & F.col("label").isNotNull(), F.lit(False))
    every = every.withColumn("fine", fine).withColumn("dim", F.size("vector"))
    every = every.withColumn("one", F.xxhash64("vector")).withColumn("two", F.xxhash64(F.lit("2"), "vector"))
    every = materialize(every, "vectors")
    same = ["label", "dim", "one", "two"]
    classes = every.where("fine").groupBy(*same).agg(
        F.min("row").alias("node"), F.count("*").alias("weight"), F.min("vec_id").alias("smallest")
    )
    classes = materialize(classes, "classes")
    vectors = every.select("row", "vector").join(classes.withColumnRenamed("node", "row"), "row")
    vectors = materialize(vectors.withColumnRenamed("row", "node"), "class_vectors")

    leaves = _leaves(vectors, trees, leaf_size, spill, cosine)
    lists = leaves.groupBy("node").agg(F.collect_list("leaf").alias("leaves"))
    places = _block_pairs(leaves).join(lists, "node").join(vectors.select("node", "weight", "vector"), "node")
    pairs = places.groupBy("label", "dim", "leaf", "one", "two")
    found = pairs.applyInArrow(_compare(cosine), "node bigint, links bigint, least bigint")
    found = materialize(found, "found")
    united = materialize(components(found.select(F.col("node").alias("a"), F.col("least").alias("b"))), "united")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = classes.join(united, "node", "left").join(counts, "node", "left")
    named = materialize(named.withColumn("component", F.coalesce("component", "node")), "named")
    names = materialize(named.groupBy("component").agg(F.min("smallest").alias("component_id")), "names")
    result = named.join(names, "component").select(
        *same, (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id"
    )
    joined = every.where("fine").select("vec_id", *same).join(materialize(result, "result"), same)
    alone = every.where("not fine").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    both = joined.select("vec_id", "n_links", "component_id").unionByName(alone)
    return both.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
