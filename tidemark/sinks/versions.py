"""Tables by day that are replaced day by day without disturbing their readers.

A run never overwrites what it reads. It writes its days into a folder of its
own and then adds one small file to the table's list of commits; each day is
read from the newest commit that names it. Days the run did not touch stay
where they are, so an incremental run rewrites only what changed. One writer
at a time is assumed, as in any overwrite.

Every few commits the current days are written down as a checkpoint, so the
state is read from one checkpoint and the commits after it, however many there
were. `vacuum` removes the folders that no recent state reads.
"""

from __future__ import annotations

import json
from collections import Counter
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.relax import shaped
from tidemark.sinks.files import write_by_day
from tidemark.sinks.folders import children, remove

DAY = "order_date"
CHECKPOINT_EVERY = 20

# A commit has an entry per day and one without a day, its head; only the head holds the
# columns of the rows and the number of days written.
_COMMITS = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("version", T.StringType()),
        T.StructField("day", T.DateType()),
        T.StructField("live", T.BooleanType()),
        T.StructField("rows", T.LongType()),
        T.StructField("high_water", T.TimestampNTZType()),
        T.StructField("columns", T.StringType()),
        T.StructField("days", T.LongType()),
    ]
)


@dataclass(frozen=True)
class State:
    """The current folders of a table: one entry per day, however many rows it has.

    whole names the versions all of whose days are current, schemas the columns
    each version was written with.
    """

    seq: int
    version: str | None
    versions: dict[date, str]
    whole: set[str]
    rows: int
    high_water: datetime | None
    schema: T.StructType | None
    schemas: dict[str, T.StructType]


@dataclass(frozen=True)
class Versions:
    spark: SparkSession
    root: str
    order_by: str = "order_ts"
    high_water_column: str | None = None

    checkpoint_every: int = CHECKPOINT_EVERY

    def _numbers(self, kind: str, upto: int | None = None) -> list[int]:
        found = (int(name) for name in children(self.spark, f"{self.root}/{kind}"))
        return sorted(n for n in found if upto is None or n <= upto)

    def _base(self, upto: int | None) -> int:
        """The newest finished checkpoint; 0 without one."""
        for n in reversed(self._numbers("checkpoints", upto)):
            if children(self.spark, _numbered(self.root, "checkpoints", n)):
                return n
        return 0

    def _log(self, upto: int | None = None) -> DataFrame | None:
        """The entries of one checkpoint and of the commits after it."""
        base = self._base(upto)
        paths = [_numbered(self.root, "commits", n) for n in self._numbers("commits", upto) if n > base]
        paths += [_numbered(self.root, "checkpoints", base)] if base else []
        return self.spark.read.schema(_COMMITS).parquet(*paths) if paths else None

    def state(self, upto: int | None = None) -> State:
        """The table as it is, or as it was after the commit of that number, if that is still kept."""
        log = self._log(upto)
        if log is None:
            return State(0, None, {}, set(), 0, None, None, {})
        rows = _newest(log, "day").collect()  # one per day, and the last head
        heads = {r.version: r for r in _newest(log.where("day IS NULL"), "version").collect()}
        last = next((r for r in rows if r.day is None), None)
        live = [r for r in rows if r.live]
        current = Counter(r.version for r in live)
        return State(
            seq=last.seq if last else 0,
            version=last.version if last else None,
            versions={r.day: r.version for r in live},
            whole={v for v, n in current.items() if heads[v].days == n},
            rows=sum(r.rows for r in live),
            high_water=max((r.high_water for r in live if r.high_water is not None), default=None),
            schema=T.StructType.fromJson(json.loads(last.columns)) if last else None,
            schemas={v: T.StructType.fromJson(json.loads(heads[v].columns)) for v in current},
        )

    def checkpoint(self, upto: int) -> None:
        """Write down the state after a commit: its days, and the heads of the versions they are in."""
        log = self._log(upto)
        newest = _newest(log, "day")
        heads = _newest(log.where("day IS NULL"), "version").where(F.col("seq") < upto)
        used = heads.join(newest.where("live"), "version", "left_semi")
        kept = newest.where("live OR day IS NULL").unionByName(used.select(*newest.columns))
        kept.coalesce(1).write.mode("overwrite").parquet(_numbered(self.root, "checkpoints", upto))

    def recent_versions(self, keep: int) -> set[str]:
        """The versions that the last commits published."""
        oldest = self._oldest(keep)
        log = self._log(oldest)
        if log is None:
            return set()
        commits = self._commits_after(oldest)
        heads = _newest(log, "day").where("day IS NULL")
        heads = heads if commits is None else heads.unionByName(commits.where("day IS NULL"))
        return {r.version for r in heads.select("version").collect()}

    def _oldest(self, keep: int) -> int:
        """The number of the oldest of the last `keep` commits, or of the oldest state still kept."""
        if keep < 1:
            raise ValueError("at least the current state is kept")
        commits, points = self._numbers("commits"), self._numbers("checkpoints")
        first = points[0] if points and 1 not in commits else 1
        return max(first, self.state().seq - keep + 1)  # the folder of a commit that died has a number too

    def _commits_after(self, seq: int) -> DataFrame | None:
        paths = [_numbered(self.root, "commits", n) for n in self._numbers("commits") if n > seq]
        return self.spark.read.schema(_COMMITS).parquet(*paths) if paths else None

    def vacuum(self, keep: int) -> list[str]:
        """Remove the day folders that none of the states after the last `keep` commits reads; give them.

        Readers of those states are not disturbed; older states are gone, and so are folders of
        runs that died before their commit. Not to be called while a run publishes.
        """
        oldest = self._oldest(keep)
        was = self.state(oldest)
        if was.seq == 0:
            return []
        used = {(v, d) for d, v in was.versions.items()}
        later = self._commits_after(oldest)
        used |= {(r.version, r.day) for r in later.where("live").select("version", "day").collect()} if later else set()

        # first what names the folders, so that no kept state names one that is gone
        if self._base(oldest) != oldest:
            self.checkpoint(oldest)
        old = [_numbered(self.root, "commits", n) for n in self._numbers("commits", oldest)]
        old += [_numbered(self.root, "checkpoints", n) for n in self._numbers("checkpoints", oldest - 1)]
        remove(self.spark, old)

        gone = []
        for version in children(self.spark, f"{self.root}/data"):
            folder, name = f"{self.root}/data/{version}", version.removeprefix("version=")
            kept = {f"{DAY}={d}" for v, d in used if v == name}
            gone += [f"{folder}/{d}" for d in children(self.spark, folder) if d not in kept] if kept else [folder]
        remove(self.spark, gone)
        return gone

    def read(self, state: State | None = None) -> DataFrame | None:
        """The table as last published; None when it never was."""
        state = state or self.state()
        if state.schema is None:
            return None
        if not state.versions:
            return self.spark.createDataFrame([], state.schema)
        data = f"{self.root}/data"
        folders = [(v, f"{data}/version={v}") for v in sorted(state.whole)]
        folders += [
            (v, f"{data}/version={v}/{DAY}={d}") for d, v in sorted(state.versions.items()) if v not in state.whole
        ]
        alike: dict[str, list[str]] = {}  # by the schema they were written with
        for version, folder in folders:
            alike.setdefault(state.schemas[version].json(), []).append(folder)
        parts = []
        for columns, paths in alike.items():
            reader = self.spark.read.option("basePath", data).schema(T.StructType.fromJson(json.loads(columns)))
            parts.append(shaped(reader.parquet(*paths), state.schema))
        return reduce(DataFrame.union, parts)

    def written_by(self, version: str, schema: T.StructType) -> DataFrame:
        """The rows that one publish wrote, as they were written."""
        return self.spark.read.schema(schema).parquet(f"{self.root}/data/version={version}")

    def publish(
        self,
        df: DataFrame,
        version: str,
        days: list[date] | None = None,
        at_most: int | None = None,
        in_place: bool = False,
        before: State | None = None,
    ) -> None:
        """Replace the given days (all, when none are given) with the rows of df, which has no others.

        at_most bounds the rows of df where the caller knows a bound; in_place
        says that they are read from a table by day and not shuffled since; before is the
        state if the caller has just read it.
        """
        before = before or self.state()
        path = f"{self.root}/data/version={version}"
        write_by_day(df, path, DAY, self.order_by, at_most, in_place)
        written = self.written_by(version, df.schema)
        newest = F.max(self.high_water_column) if self.high_water_column else F.lit(None).cast("timestamp_ntz")
        per_day = written.groupBy(DAY).agg(F.count("*").alias("rows"), newest.alias("high_water")).collect()

        seq, columns = before.seq + 1, df.schema.json()
        # the head says what was last published even when no day is left
        commit = [(seq, version, None, False, 0, None, columns, len(per_day))]
        commit += [(seq, version, r[DAY], True, r["rows"], r["high_water"], None, None) for r in per_day]
        emptied = set(before.versions if days is None else days) - {r[DAY] for r in per_day}
        commit += [(seq, version, d, False, 0, None, None, None) for d in sorted(emptied)]
        entries = self.spark.createDataFrame(commit, _COMMITS).coalesce(1)
        entries.write.mode("overwrite").parquet(_numbered(self.root, "commits", seq))
        if seq % self.checkpoint_every == 0:
            self.checkpoint(seq)


def _numbered(root: str, kind: str, n: int) -> str:
    return f"{root}/{kind}/{n:020d}"


def _newest(log: DataFrame, key: str) -> DataFrame:
    return log.groupBy(key).agg(F.max_by(F.struct(*_COMMITS.fieldNames()), "seq").alias("c")).select("c.*")
