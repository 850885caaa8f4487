"""N-gram Jaccard join by parity sketches.

A document is the set of its distinct word shingles. Sets that are equal form one
class, which takes part once. For sets of sizes a and b, a Jaccard similarity of
at least 9/10 means a symmetric difference of at most d = (a + b) / 19.

The parity sketch of a set deals its shingles by hash into parts and keeps, for
each part, the XOR of its shingles' hashes. A shingle in only one of two sets
changes one part, so the number of parts that differ (the Hamming distance of the
sketches over parts) never exceeds the symmetric difference. With d + 1 + e parts, similar
sets agree in at least e + 1 of them. Sizes are cut into geometric bands, each
with its own number of parts; a set also visits the next band where a similar
larger set could lie. Buckets are the parts' values, joined over the cluster.

A set's size bounds its own differences more closely than the band does, so a set
knows of more parts in which all that are similar must agree with it. Parts with
fewer than `light` shingles (below 9/10: without any) would make large buckets of unlike
sets. Where a set has fewer of them than it must agree in, one of the agreeing parts is
not light, and its light parts aren't joined; it then shares at least as many buckets
with every similar set as there are parts to agree in beyond its light ones. Other sets join on all
parts, among themselves on the light ones too. A set that shares fewer buckets with
any others than it would with a similar one is like none and leaves its band.

A bucket of many near copies isn't expanded into pairs. In each of a few rounds every
set that is still apart from its bucket's leader is compared exactly with one leader,
and links merge components; a bucket within one component is settled. In the
buckets that are left, blocks of at most about BLOCK sets are compared within tasks
by a finer parity sketch, of single bits, whose Hamming distance bounds the symmetric
difference from below. Of the pairs of different components that pass, at first each two
blocks emit a forest, nearest sets first, which is compared exactly and merges most of
what links; then all pairs that pass and whose components still differ are compared.
Pairs within a component need no comparison, so the components are exact.

Defined cases: without a word (null or empty text) a document has no shingles and
links with nothing; rows equal in text are one class; a null id joins its class but
is never a component's id (null if no member has one); texts may be of any length;
other columns pass through `one_of_each`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.components import components
from tidemark.llm.rows import packed, unpacked
from tidemark.session import materialize

SHINGLE = 3
PERCENT = 90
SLICE_BYTES = 1 << 20
BAND = 1.37
ROUNDS = 2
BLOCK = 512
PARTS = 64  # a bound of parts for similarities below 0.9, where exactness would take a third of the shingles
BITS = 26  # of a hash that picks a bit of the bitmap of wanted rows, which thus has 8 MB at every input size
SKETCHES = "uid bigint, text_key bigint, id bigint, n int, one bigint, two bigint, keys array<int>, first int, band int, need array<int>"


def difference(a, b, percent: int = PERCENT):
    """The largest symmetric difference of linked sets of these sizes."""
    return (a + b) * (100 - percent) // (100 + percent)


def linked(common, a, b, percent: int = PERCENT):
    return 100 * common >= percent * (a + b - common)


def bands(largest: int) -> list[int]:
    """The least size of each band."""
    out = [1]
    while out[-1] <= largest:
        out.append(int(out[-1] * BAND) + 1)
    return out


def parity_bands(shingles: np.ndarray, percent: int, starts: np.ndarray, most: int | None = None) -> list[tuple[int, int, np.ndarray]]:
    """The band, the need and the parts' values of a set in its own band and, where need be, the next one.

    A value has 32 bits, which with band and part name its bucket; sets that meet by chance are compared. It is 0
    where the set doesn't join on the part. With each similar set it shares as many buckets as it needs, at least.

    Where more than `most` parts would be needed, the set joins on `most` of fewer,
    larger ones. A part of linked sets then agrees with a chance of at least about
    exp(-1.5), each for itself, so that 64 miss one link in ten million.
    """
    n, out = len(shingles), []
    own = int(np.searchsorted(starts, n, "right")) - 1
    reach = n * 100 // percent
    for band in range(own, own + 2):
        if band > own and reach < starts[band]:
            break
        top = int(starts[band + 1]) - 1
        least_parts = difference(top, top, percent) + 1
        if least_parts == 1:
            continue  # only equal sets can link
        parts = least_parts + least_parts // 8
        some = most is not None and parts > most
        if some:
            parts = max(most, int(least_parts / 1.5))
        part = ((shingles >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        size = np.bincount(part, minlength=parts)
        full = np.flatnonzero(size)
        value = np.zeros(parts, np.uint64)
        value[full] = np.bitwise_xor.reduceat(shingles[order], (np.cumsum(size) - size)[full])
        light = size < (3 if percent >= 90 else 2 if some else 1)
        place = W.mix((np.uint64(band) << np.uint64(40)) + np.arange(parts, dtype=np.uint64) * np.uint64(2) + light)
        values = np.maximum(W.mix(value ^ place) >> np.uint64(32), np.uint64(1)).astype(np.uint32)
        need = parts - difference(n, min(top, reach), percent) - int(light.sum())
        if some or need > 0:
            values[light] = 0
        out.append((band, 1, values[:most]) if some else (band, max(need, 1), values))
    return out


def parity_keys(shingles: np.ndarray, percent: int, starts: np.ndarray, most: int | None = None) -> np.ndarray:
    """The buckets of a set in all its bands."""
    out = [np.zeros(0, np.uint64)]
    for band, _, values in parity_bands(shingles, percent, starts, most):
        part = np.flatnonzero(values).astype(np.uint64)
        out.append((np.uint64(band) << np.uint64(56)) + (part << np.uint64(32)) + values[values > 0].astype(np.uint64))
    return np.concatenate(out)


def shingle_sets(data: np.ndarray, off: np.ndarray, lo: int, hi: int, size: int) -> Iterator[np.ndarray]:
    """The sorted hashes of each text's distinct shingles."""
    words = W.Words(data, off, lo, hi, lower=True)
    runs = W.Runs(words.hashes())
    every = runs.all(size)
    for i in range(hi - lo):
        first, n = words.first[i], words.count[i]
        if n >= size:
            yield np.unique(every[first : first + n - size + 1])
        elif n:
            yield runs.at(np.array([first]), int(n))
        else:
            yield np.zeros(0, np.uint64)


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    ends = np.cumsum([0, *[len(p) for p in parts]]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64 if flat.itemsize == 8 else np.int32)))


def _sketches(size: int, percent: int, most: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, none = np.array(bands(1000)), np.zeros(0, np.uint32)
        for batch in batches:
            data, off = W.text_bytes(batch.column("text"))
            for lo, hi in W.slices(off, SLICE_BYTES):
                sets = list(shingle_sets(data, off, lo, hi, size))
                largest = max(map(len, sets))
                starts = starts if starts[-1] > 4 * largest else np.array(bands(8 * largest))
                joins = [parity_bands(s, percent, starts, most) if len(s) else [] for s in sets]
                sums = [[int(W.mix(s ^ np.uint64(c)).sum(dtype=np.uint64)) for s in sets] for c in (11, 13)]
                yield pa.RecordBatch.from_pydict(
                    {k: batch.column(k).slice(lo, hi - lo) for k in ("uid", "text_key", "id")}
                    | {"n": pa.array([len(s) for s in sets], pa.int32())}
                    | {k: pa.array(np.array(v, np.uint64).view(np.int64)) for k, v in zip(("one", "two"), sums)}
                    | {"keys": _lists([np.concatenate([none, *[values for _, _, values in x]]) for x in joins])}
                    | {"first": pa.array([len(x[0][2]) if x else 0 for x in joins], pa.int32())}
                    | {"band": pa.array([x[0][0] if x else 0 for x in joins], pa.int32())}
                    | {"need": pa.array([[need for _, need, _ in x] for x in joins], pa.list_(pa.int32()))}
                )

    return run


def parity_bits(shingles: np.ndarray, percent: int) -> np.ndarray:
    """Each shingle flips one bit. There are 16 or more bits per allowed difference, a power of two of them."""
    bits = 64
    while bits < 16 * difference(len(shingles), len(shingles), percent):
        bits *= 2
    flips = np.bincount((shingles % np.uint64(bits)).astype(np.int64), minlength=bits) % 2
    return np.packbits(flips.astype(np.uint8), bitorder="little").view(np.uint64)


def folded(sketch: np.ndarray, size: int) -> np.ndarray:
    """A sketch as if it had been made with so many words."""
    return np.bitwise_xor.reduce(sketch.reshape(-1, size), axis=0)


def _sets(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = W.text_bytes(batch.column("text"))
            for lo, hi in W.slices(off, SLICE_BYTES):
                sets = list(shingle_sets(data, off, lo, hi, size))
                yield pa.RecordBatch.from_pydict(
                    {
                        "node": batch.column("node").slice(lo, hi - lo),
                        "n": pa.array([len(x) for x in sets], pa.int32()),
                        "bits": pa.array([parity_bits(x, percent).tobytes() for x in sets], pa.binary()),
                        "shingles": _lists(sets),
                    }
                )

    return run


def _near(sketches: list[bytes], n: np.ndarray, component: np.ndarray, side: np.ndarray, percent: int, forest: bool):
    """Pairs of places whose components differ and whose sketches allow a link; sides, where two, are compared across.

    With `forest`, each pair joins its components for those that follow, so there are fewer pairs than components.
    """
    words = min(len(x) for x in sketches) // 8
    bits = np.stack([folded(np.frombuffer(x, np.uint64), words) for x in sketches])
    for i in range(len(n) - 1):
        j = np.arange(i + 1, len(n))
        j = j[(component[j] != component[i]) & ((side[j] != side[i]) | (side[0] == side[-1]))]
        if len(j):
            apart = np.bitwise_count(bits[j] ^ bits[i]).sum(axis=1)
            passed = apart <= difference(n[j] + n[i], 0, percent)
            near = j[passed]
            if not forest:
                yield from ((i, k) for k in near)
                continue
            near = near[np.argsort(apart[passed], kind="stable")]
            while len(near):
                yield i, near[0]
                component[component == component[near[0]]] = component[i]
                near = near[component[near] != component[i]]


def _candidates(percent: int, forest: bool):
    """Rows come sorted by bucket and pair of blocks."""

    def pairs(rows: pa.Table) -> pa.RecordBatch:
        node, n, component, side = (rows.column(k).to_numpy() for k in ("node", "n", "component", "block"))
        order = np.argsort(side, kind="stable")
        sketches = rows.column("bits").to_pylist()
        found = _near([sketches[i] for i in order], n[order].astype(np.int64), component[order], side[order], percent, forest)
        ends = np.array([(node[order[i]], node[order[j]]) for i, j in found], np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_pydict({"a": pa.array(ends.max(axis=1, initial=0)), "b": pa.array(ends.min(axis=1, initial=1 << 62))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            key, one, two = (table.column(k).to_numpy() for k in ("key", "one", "two"))
            edge = np.flatnonzero((key[1:] != key[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])) + 1
            begins = [0, *edge.tolist()]
            for a, b in zip(begins, begins[1:]):
                yield pairs(table.slice(a, b - a))
            held = table.slice(begins[-1]).combine_chunks()
        if held is not None and held.num_rows:
            yield pairs(held)

    return run


def _block_pairs(members: DataFrame, sets: DataFrame, percent: int, forest: bool = False) -> DataFrame:
    """Pairs (a, b) of sets of different components in a bucket that their fine sketches let pass.

    With `forest`, only as many in each pair of blocks as would join what all of them join.
    """
    sizes = members.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    rows = members.join(materialize(sizes, "sizes"), "key").join(sets.select("node", "n", "bits"), "node")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node", "key"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumn("one", F.least("block", "other")).withColumn("two", F.greatest("block", "other"))
    rows = rows.select("key", "one", "two", "block", "node", "component", "n", "bits")
    rows = rows.repartition("key", "one", "two").sortWithinPartitions("key", "one", "two")
    return rows.mapInArrow(_candidates(percent, forest), "a bigint, b bigint").distinct()


def _compare(percent: int):
    """Whether the two sets of each pair link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for name in ("left", "right"):
                column = batch.column(name)
                sides.append((column.flatten().to_numpy().view(np.uint64), column.offsets.to_numpy() - column.offsets[0].as_py()))
            (left, at), (right, to) = sides
            yes = np.zeros(len(batch), bool)
            for i in range(len(batch)):
                a, b = left[at[i] : at[i + 1]], right[to[i] : to[i + 1]]
                both = np.sort(np.concatenate([a, b]))
                yes[i] = linked(int((both[1:] == both[:-1]).sum()), len(a), len(b), percent)
            yield pa.RecordBatch.from_pydict({"a": batch.column("a"), "b": batch.column("b"), "linked": pa.array(yes)})

    return run


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) and whether they link."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return materialize(rows.mapInArrow(_compare(percent), "a bigint, b bigint, linked boolean"), "verified")


def _open_buckets(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets that hold more than one component, with their component and the bucket's leader."""
    here = members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    here = materialize(here, "labelled")
    open_ = (
        here.groupBy("key")
        .agg(F.min(F.struct("component", "node")).alias("lead"), F.max("component").alias("most"))
        .where("lead.component <> most")
        .select("key", "lead")
    )
    return materialize(here.join(materialize(open_, "open"), "key"), "members")


def class_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) enough to give the components of all links between the buckets' members."""
    spark = members.sparkSession
    tested = spark.createDataFrame([], "a bigint, b bigint, linked boolean")
    labels = spark.createDataFrame([], "node bigint, component bigint")
    for number in range(ROUNDS):
        members = _open_buckets(members.select("key", "node"), labels)
        if number:  # another leader each time, from any of the bucket's components
            by = F.min_by(F.struct("component", "node"), F.xxhash64("node", F.lit(number)))
            lead = materialize(members.groupBy("key").agg(by.alias("lead")), "leaders")
            members = members.drop("lead").join(lead, "key")
        asked = members.where("component <> lead.component").select(
            F.greatest("node", "lead.node").alias("a"), F.least("node", "lead.node").alias("b"), "node"
        )
        asked = asked.groupBy("a", "b", "node").agg(F.count("*").alias("shared")).join(tested, ["a", "b"], "left_anti")
        best = asked.groupBy("node").agg(F.max(F.struct("shared", "a", "b")).alias("pair"))
        tested = tested.unionByName(_verified(best.select("pair.a", "pair.b").distinct(), sets, percent))
        labels = materialize(components(tested.where("linked").select("a", "b")), "labels")
    members = _open_buckets(members.select("key", "node"), labels)
    joining = _block_pairs(members, sets, percent, forest=True).join(tested, ["a", "b"], "left_anti")
    tested = tested.unionByName(_verified(joining, sets, percent))
    labels = materialize(components(tested.where("linked").select("a", "b")), "labels")
    members = _open_buckets(members.select("key", "node"), labels)
    rest = _block_pairs(members, sets, percent).join(tested, ["a", "b"], "left_anti")
    return tested.unionByName(_verified(rest, sets, percent)).where("linked").select("a", "b")


def _among(rows: DataFrame, wanted: DataFrame, key: list[str]) -> DataFrame:
    """The rows that may be wanted: those whose hash has its bit set in a bitmap of the wanted ones.

    Its 2^BITS bits come to 8 MB to broadcast, whatever the input. Rows that share a bit by
    chance fall out in the join that follows; a bitmap that fills up only spares less.
    """
    at = F.pmod(F.xxhash64(*key), F.lit(1 << BITS))
    chunk, place = F.shiftright(at, 15).cast("int"), at.bitwiseAND(F.lit((1 << 15) - 1))
    bits = wanted.groupBy(chunk.alias("chunk")).agg(F.bitmap_construct_agg(place).alias("bits"))
    byte = F.conv(F.hex(F.substring("bits", (F.shiftright("place", 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    marked = rows.withColumns({"chunk": chunk, "place": place}).join(F.broadcast(materialize(bits, "bits")), "chunk")
    return marked.where(F.getbit(byte, (F.col("place") % 8).cast("int")) == 1).select(*rows.columns)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = packed(docs, text_col, id=id_col).withColumn("id", F.col("id").cast("bigint"))
    return rows.select(
        F.coalesce("id", F.lit(0).cast("bigint")).alias("uid"), F.xxhash64("id", "text").alias("text_key"), "id", "text", "rest"
    )


def similar_documents(
    docs: DataFrame,
    size: int = SHINGLE,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
    most_parts: int | None = None,
) -> DataFrame:
    """Each row's id, n_shingles and component_id; text, uid, text_key and "rest" go along."""
    rows = _keyed(docs, id_col, text_col)
    classes = similar_classes(rows, size, percent, most_parts).drop("component", "place")
    return rows.join(classes, ["uid", "text_key"], "left")


def similar_classes(rows: DataFrame, size: int, percent: int, most_parts: int | None = None) -> DataFrame:
    """One row per (uid, text_key): n_shingles, component_id, the component's node and a place to order its rows by."""
    sketches = rows.select("uid", "text_key", "id", "text").mapInArrow(_sketches(size, percent, most_parts), SKETCHES)
    sketches = materialize(sketches.withColumn("row", F.monotonically_increasing_id()), "sketches")
    docs = sketches.select("uid", "text_key", "id", "n", "one", "two", "row")
    classes = materialize(
        docs.where("n > 0").groupBy("n", "one", "two").agg(F.min("row").alias("node"), F.min("id").alias("least")), "classes"
    )
    first = sketches.join(classes.select(F.col("node").alias("row")), "row", "left_semi")
    # a seat is a class in one of its two bands
    buckets = first.select("row", "first", "band", F.posexplode("keys").alias("at", "value")).where("value <> 0")
    second, value = (F.col("at") >= F.col("first")).cast("bigint"), F.col("value").cast("bigint").bitwiseAND(F.lit((1 << 32) - 1))
    part = F.shiftleft(F.col("at") - second * F.col("first"), 32)
    buckets = buckets.select(
        (F.shiftleft(F.col("band") + second, 56) + part + value).alias("key"), (F.col("row") * 2 + second).alias("seat")
    )
    needs = first.select("row", F.posexplode("need").alias("at", "need")).select((F.col("row") * 2 + F.col("at")).alias("seat"), "need")
    # the keys are shuffled once and only those of buckets with two classes or more are written
    bucket = Window.partitionBy("key")
    shared = buckets.withColumns({"a": F.min("seat").over(bucket), "b": F.max("seat").over(bucket)})
    shared = materialize(shared.where("a <> b").select("key", "seat"), "shared")
    # no set that is similar to one of fewer shared buckets than it needs lies in that band
    enough = shared.groupBy("seat").agg(F.count("*").alias("shared")).join(needs, "seat").where("shared >= need")
    enough = materialize(enough.select("seat"), "enough")
    members = materialize(shared.join(enough, "seat").select("key", F.shiftright("seat", 1).alias("node")), "members")

    wanted = members.select(F.col("node").alias("row")).distinct()
    wanted = sketches.select("uid", "text_key", "row").join(wanted, "row").withColumnRenamed("row", "node")
    wanted = materialize(wanted, "wanted")
    sets = _among(rows.select("uid", "text_key", "text"), wanted, ["uid", "text_key"]).join(wanted, ["uid", "text_key"])
    # repeated rows go before their sets are made: the join has dealt the texts out by these columns, the sets needn't be
    sets = sets.dropDuplicates(["uid", "text_key"]).select("node", "text")
    sets = materialize(sets.mapInArrow(_sets(size, percent), "node bigint, n int, bits binary, shingles array<bigint>"), "sets")

    labels = materialize(components(class_links(members, sets, percent)), "labels")
    named = classes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = materialize(
        named.join(materialize(names, "names"), "component").select("n", "one", "two", "component", "component_id"), "named"
    )
    return (
        docs.join(named, ["n", "one", "two"], "left")
        .groupBy("uid", "text_key")
        .agg(
            F.max(F.col("n").cast("bigint")).alias("n_shingles"),
            F.min(F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))).alias("component_id"),
            F.min("component").alias("component"),
            F.min(F.struct(F.col("id").isNull().alias("nameless"), "uid", "text_key")).alias("place"),
        )
    )


def one_of_each(
    docs: DataFrame,
    size: int = SHINGLE,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
    most_parts: int | None = None,
) -> DataFrame:
    """The documents, one of each component: a row of its id, or one without where none has an id. Of rows equal in id and text one stays.

    Documents without a word stay.
    """
    rows, key = _keyed(docs, id_col, text_col), ["uid", "text_key"]
    classes = materialize(similar_classes(rows, size, percent, most_parts), "row_classes")
    first = classes.where("n_shingles > 0").groupBy("component").agg(F.min("place").alias("place"))
    first = first.select("place.uid", "place.text_key", F.lit(True).alias("once"))
    stay = first.unionByName(classes.where("n_shingles = 0").select(*key, F.lit(False).alias("once")))
    rows = rows.join(materialize(stay, "stay"), key)
    turn = Window.partitionBy(*key).orderBy("text_key")
    once = rows.where("once").withColumn("turn", F.row_number().over(turn)).where("turn = 1").drop("turn")
    return unpacked(once.unionByName(rows.where("not once")), docs.columns, text_col)
