"""WARC archives of pages, and their captures merged into one ordered history.

Each record is a gzip member of its own. Members are gathered into archives of
about ARCHIVE_BYTES and written by Spark's text writer (which writes bytes as they
are; the zero byte it puts after each archive is padding to gzip readers). Of pages with
equal payloads the one of the smallest id is a response with the payload, the
others are revisits that refer to it; payloads below least_bytes are always
responses.

Reading parses every archive back, checks each payload against its digest, and
indexes the captures. An archive's captures, sorted by url key, time and page,
are one run. Runs are merged like an external sort: ranges of the key are dealt
to tasks, and each merges its part of every run by a tree of losers. `place` grows along the
whole history.

Defined cases: a null html is an empty payload; a null url has no target and an
empty key, and sorts first; rows of equal page_id and payload are all responses
or all revisits; a null page_id is never the smallest unless all are null, in
which case all are responses; no pages give no archives and no captures.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.rows import column
from tidemark.session import materialize, scratch_path

ARCHIVE_BYTES = 8 << 20
BROADCAST_ROWS = 100_000  # repeated payloads that may be broadcast, some 100 bytes each
MERGE_ROWS = 200_000  # captures that a task merges
CAPTURES = (
    "page_id bigint, url_key string, captured string, record_type string, refers_to bigint, payload_bytes bigint, "
    "payload_digest string, target string, archive string, at bigint, size bigint"
)
EPOCH = datetime(2024, 1, 1, tzinfo=timezone.utc)


def capture_time(page_id: int | None) -> str:
    """The tables have no times: pages count as captured a second apart."""
    return (EPOCH + timedelta(seconds=(page_id or 0) % (3650 * 86400))).strftime("%Y-%m-%dT%H:%M:%SZ")


def url_key(url: str) -> str:
    """Host parts from the last to the first, then the rest: captures of a site sort together."""
    m = re.match(r"[^:/?#]+://([^/?#]*)(.*)", url, re.S)
    if not m:
        return url
    host = m[1].rpartition("@")[2].lower()
    return ",".join(reversed(host.split("."))) + ")" + (m[2].partition("#")[0] or "/")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record as a gzip member."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url))
    head += [f"WARC-Date: {capture_time(page_id)}", f"WARC-Payload-Digest: sha1:{digest(payload)}"]
    if revisit:
        head += [f"WARC-Refers-To: {_name(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def records(content: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """Offset, size, headers and block of every record of an archive."""
    view, at = memoryview(content), 0
    while at < len(view):
        if view[at] == 0:
            at += 1
            continue
        unpack, begin, out = zlib.decompressobj(31), at, []
        while not unpack.eof:
            if at >= len(view):
                raise ValueError("an archive ends within a record")
            out.append(unpack.decompress(view[at : at + 65536]))
            at += min(65536, len(view) - at)
        at -= len(unpack.unused_data)
        head, _, rest = b"".join(out).partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        yield begin, at - begin, fields, rest[: int(fields["Content-Length"])]


def _archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        for row in zip(*[batch.column(k).to_pylist() for k in ("page_id", "url", "html", "first", "revisit")]):
            page_id, url, html, first, revisit = row
            held.append(record(page_id, url, (html or "").encode(), first, revisit))
            size += len(held[-1])
            if size >= ARCHIVE_BYTES:
                yield pa.RecordBatch.from_pydict({"archive": pa.array([b"".join(held)], pa.binary())})
                held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pydict({"archive": pa.array([b"".join(held)], pa.binary())})


def write(pages: DataFrame, path: str, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write the archives of all pages into a new folder."""
    rows = pages.select(
        column(pages, id_col).cast("bigint").alias("page_id"),
        column(pages, url_col).cast("string").alias("url"),
        column(pages, html_col).cast("string").alias("html"),
    )
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = rows.withColumn("payload", F.when(F.length(payload) >= least_bytes, F.sha1(payload)))
    again = rows.where("payload is not null").groupBy("payload").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    again = materialize(again.where("n > 1 and first is not null").select("payload", "first"), "again")
    again = F.broadcast(again) if again.count() <= BROADCAST_ROWS else again
    rows = rows.join(again, "payload", "left")
    revisit = F.coalesce(~F.col("page_id").eqNullSafe(F.col("first")) & F.col("first").isNotNull(), F.lit(False))
    rows = rows.select("page_id", "url", "html", "first", revisit.alias("revisit"))
    archives = rows.mapInArrow(_archives, "archive binary").select(F.col("archive").cast("string"))
    archives.write.option("lineSep", "\u0000").option("maxRecordsPerFile", 1).text(path)


def _captures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def page(name: str) -> int | None:
        value = name.strip("<>").rpartition(":")[2]
        return None if value == "none" else int(value)

    for batch in batches:
        for archive, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            run = []
            for at, size, head, block in records(content.as_py()):
                revisit, name = head["WARC-Type"] == "revisit", head["WARC-Payload-Digest"].removeprefix("sha1:")
                payload = block.partition(b"\r\n\r\n")[2]
                if not revisit and digest(payload) != name:
                    raise ValueError(f"{archive}: the payload at {at} doesn't have its digest")
                target = head.get("WARC-Target-URI")
                refers = page(head["WARC-Refers-To"]) if revisit else None
                row = {"page_id": page(head["WARC-Record-ID"]), "url_key": url_key(target or ""), "captured": head["WARC-Date"]}
                row |= {"record_type": head["WARC-Type"], "refers_to": refers, "payload_bytes": None if revisit else len(payload)}
                run.append(row | {"payload_digest": name, "target": target, "archive": archive, "at": at, "size": size})
            run.sort(key=capture_order)
            if run:
                yield pa.RecordBatch.from_pylist(run, schema=pa.schema(_FIELDS))


_FIELDS = [(c.split()[0], pa.int64() if c.split()[1] == "bigint" else pa.string()) for c in CAPTURES.split(", ")]


def capture_order(row: dict) -> tuple:
    return (row["url_key"], row["captured"], row["page_id"] is not None, row["page_id"] or 0)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The captures of all archives of a folder, each archive's in order."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_captures, CAPTURES)


def merged(runs: list[list[tuple]]) -> Iterator[tuple[int, int]]:
    """(run, place in it) of every key in order; equal keys in the order of runs.

    A tree of losers: an inner node holds the run that lost there, so replacing
    the winner costs one comparison on each level.
    """
    k = len(runs)
    if k == 0:
        return
    at, last = [0] * k, (1,)

    def head(r: int) -> tuple:
        return (0, runs[r][at[r]], r) if at[r] < len(runs[r]) else (*last, r)

    tree = [-1] * k

    def play(r: int) -> int:
        node = (r + k) // 2
        while node > 0:
            if tree[node] < 0:  # the first to come waits for its opponent
                tree[node] = r
                return -1
            if head(tree[node]) < head(r):
                tree[node], r = r, tree[node]
            node //= 2
        return r

    winner = -1
    for r in range(k):
        winner = max(winner, play(r))
    while at[winner] < len(runs[winner]):
        yield winner, at[winner]
        at[winner] += 1
        winner = play(winner)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
    if table is None or table.num_rows == 0:
        return
    rows, runs, seen = table.to_pylist(), {}, {}
    for i, row in enumerate(rows):
        runs.setdefault(row["archive"], []).append(capture_order(row))
        seen.setdefault(row["archive"], []).append(i)
    names = sorted(runs)
    order = [seen[names[r]][i] for r, i in merged([runs[n] for n in names])]
    first = TaskContext.get().partitionId() << 40
    out = table.take(pa.array(order)).append_column("place", pa.array(range(first, first + len(order)), pa.int64()))
    yield from out.to_batches()


def history(captures: DataFrame) -> DataFrame:
    """All captures in one order of url key, time and page; captures is a stored table."""
    order = ["url_key", "captured", F.col("page_id").asc_nulls_first()]
    ranges = max(1, -(-captures.count() // MERGE_ROWS))
    runs = captures.repartitionByRange(ranges, *order).sortWithinPartitions("archive", *order)
    return runs.mapInArrow(_merge, CAPTURES + ", place bigint")


def archive_and_merge(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write the pages' archives, read them back, and merge their captures; revisits get their response's length."""
    spark = pages.sparkSession
    path = scratch_path(spark, "archives")
    write(pages, path, least_bytes)
    captures = materialize(read(spark, path), "captures")
    merged_ = history(captures)
    lengths = captures.where("record_type = 'response'").groupBy("payload_digest").agg(F.min("payload_bytes").alias("full"))
    merged_ = merged_.join(materialize(lengths, "lengths"), "payload_digest")
    return merged_.withColumn("payload_bytes", F.coalesce("payload_bytes", "full")).drop("full")
