"""Run checks on Spark and DuckDB and compare them: python -m tests.compare [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time
from datetime import date, datetime

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, date) and not isinstance(value, datetime):
        return ("date", value)
    return value


# DuckDB's names of Spark's types
TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
}


def differences(spark_df, con, sql: str) -> list[str]:
    """What differs in columns, types, rows or values; exact for every type."""
    rows = [r.asDict() for r in spark_df.collect()]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    oracle = [dict(zip(names, r)) for r in result.fetchall()]
    if sorted(spark_df.columns) != sorted(names):
        return [f"columns {sorted(spark_df.columns)} / {sorted(names)}"]
    ours = dict(spark_df.dtypes)
    theirs = {d[0]: TYPES.get(str(d[1]), str(d[1])) for d in result.description}
    if ours != theirs:
        return [f"types {[(c, ours[c], theirs[c]) for c in ours if ours[c] != theirs[c]]}"]
    if len(rows) != len(oracle):
        return [f"rows {len(rows)} / {len(oracle)}"]
    key = sorted(names)
    left, right = (
        sorted(([_plain(r[c]) for c in key] for r in side), key=lambda v: [(x is None, str(x)) for x in v])
        for side in (rows, oracle)
    )
    return [f"{dict(zip(key, a))} / {dict(zip(key, b))}" for a, b in zip(left, right) if a != b][:3]


def main() -> int:
    import __spark_entry__ as contract
    from tests.conftest import new_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con = new_session(), connect(sf_dir)
    oracle, bad = contract.oracle_sql(), 0
    for name, run in contract.queries().items():
        if wanted and name not in wanted:
            continue
        began = time.perf_counter()
        try:
            df = run(spark, sf_dir)
            diff = differences(df, con, oracle[name]) if name in oracle else [f"no SQL, {df.count()} rows"]
        except Exception as error:  # report and go on with the others
            diff = [str(error)[:1500]]
        bad += bool(diff) and name in oracle
        print(f"{'DIFF' if diff else 'ok':5}{time.perf_counter() - began:6.2f}s {name}", *diff, sep="\n      ", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
