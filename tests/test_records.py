"""Values with quotes, commas and line breaks, and JSON of both forms in one folder."""

from __future__ import annotations

import csv
import json
import random
from pathlib import Path
from urllib.parse import quote

import duckdb
import pytest

from tidemark.plans.full_run import run
from tidemark.sinks.files import write_csv
from tidemark.sources.raw import read_raw
from tidemark.sources.records import has_broken_values, text_lines

VALUES = ["plain", 'say "hi", you', "a\nb", '"', '""', '\n\n"x"\n', "back\\slash", "\\", " blanks ", "é,漢", 'end"', '\n', None, "tab\t"]


def write(folder, name, text):
    path = Path(folder) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, newline="")
    return str(path)


def made(rows, seed):
    rng = random.Random(seed)
    return [(str(i), *[rng.choice(VALUES) for _ in range(3)]) for i in range(rows)]


def got(df):
    return sorted((tuple(r) for r in df.select("id", "x", "y", "z").collect()), key=lambda r: int(r[0]))


def test_what_write_csv_writes_is_read_again(spark, folder):
    rows = made(3000, 1)
    write_csv(spark.createDataFrame(rows, "id string, x string, y string, z string"), f"{folder}/own.csv")
    assert got(read_raw(spark, f"{folder}/own.csv")) == rows
    con = duckdb.connect()
    read = f"SELECT * FROM read_csv('{folder}/own.csv/*.csv', header = true, all_varchar = true, quote = '\"', escape = '\"')"
    assert sorted(con.sql(read).fetchall(), key=lambda r: int(r[0])) == rows


def test_what_duckdb_writes_is_read(spark, folder):
    rows = made(500, 2)
    con = duckdb.connect()
    con.execute("CREATE TABLE t (id VARCHAR, x VARCHAR, y VARCHAR, z VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?, ?)", rows)
    con.execute(f"COPY t TO '{folder}/duck.csv' (HEADER)")
    assert got(read_raw(spark, f"{folder}/duck.csv")) == rows


@pytest.mark.parametrize("split", [64, 1000, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_across_splits(spark, folder, split, end):
    """Splits of a few bytes end within values, which may be longer than a split."""
    rows = made(60, 3) + [("60", "long\n" * 100, 'q"\n' * 50, "z")]
    for part in range(2):
        with open(write(folder, f"in.csv/{part}.csv", ""), "w", newline="") as file:
            out = csv.writer(file, lineterminator=end, quoting=csv.QUOTE_ALL)
            out.writerows([("id", "x", "y", "z"), *rows[part::2]])  # null as "", which Spark reads as null
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        raw = read_raw(spark, f"{folder}/in.csv")
        assert got(raw) == rows
        assert {r.n for r in raw.selectExpr("_metadata.file_name AS n").collect()} == {"0.csv", "1.csv"}
        if split == 64:
            assert text_lines(spark, f"{folder}/in.csv").rdd.getNumPartitions() > 20
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_plain_files_keep_the_plain_scan(spark, folder):
    path = write(folder, "plain.csv", 'id,x,y,z\n1,"say ""hi"", you",\\,"a,b"\n')
    assert not has_broken_values(text_lines(spark, path))
    assert got(read_raw(spark, path)) == [("1", 'say "hi", you', "\\", "a,b")]
    assert "_metadata" not in read_raw(spark, path).columns


def test_unlike_headers_are_refused(spark, folder):
    write(folder, "in.csv/1.csv", 'a,b\n"x\ny",1\n')
    write(folder, "in.csv/2.csv", "b,a\n1,2\n")
    with pytest.raises(ValueError, match="header"):
        read_raw(spark, f"{folder}/in.csv")
    with pytest.raises(ValueError, match="header"):
        read_raw(spark, write(folder, "one.csv", 'a,b\n"x\ny",1\n'), schema=spark.createDataFrame([], "a string, c string").schema)


def test_orders_with_quoted_categories_all_arrive(spark, folder):
    head = "order_id,customer_id,product_id,order_ts,updated_at,category,amount,quantity\n"
    for kind, category in (("comma", '"say ""hi"", you"'), ("break", '"a\n""b"""')):
        lines = [f"o{i},c{i % 5},p{i % 3},2024-01-0{i % 9 + 1} 10:00:00,2024-01-10 10:00:00,{category},{i + 1}.5,2\n" for i in range(50)]
        result = run(spark, write(folder, f"{kind}.csv", head + "".join(lines)), f"{folder}/{kind}", reports=False)
        assert (result.bronze_rows, result.quarantined_rows, result.silver_rows) == (50, 0, 50)
        assert "_metadata" not in result.tables["bronze_orders"].columns
        assert {r.source_file for r in result.tables["bronze_orders"].select("source_file").collect()} == {f"{kind}.csv"}


def test_json_of_both_forms_in_one_folder(spark, folder):
    records = [{"a": str(i), "b": {"c": str(i % 3)}} for i in range(200)]
    for first, second in (("1 x", "2"), ("2", "1")):
        path = f"{folder}/{first}.json"
        write(path, f"{first}.json", json.dumps(records[:100], indent=2))
        write(path, f"{second}.json", "\n" + "\n".join(map(json.dumps, records[100:150])))
        write(path, f"{second}0.json", json.dumps(records[150:]))
        raw = read_raw(spark, path)
        assert sorted(int(r.a) for r in raw.collect()) == list(range(200))
        assert sorted({r.n for r in raw.selectExpr("_metadata.file_name AS n").collect()}) == sorted(quote(f"{n}.json") for n in (first, second, f"{second}0"))
        assert {r.c for r in raw.selectExpr("b.c").collect()} == {"0", "1", "2"}
