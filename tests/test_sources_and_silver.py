"""Readers, adapters, cleaning: the fixtures F1-F3 with exact values."""

from __future__ import annotations

import json
import random
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.data import CANONICAL_SCHEMA, ORDERS_CSV, write_text
from tidemark.functions.keys import composite_key
from tidemark.functions.text import plain_double, strip_whitespace
from tidemark.functions.time import as_naive_timestamp, seconds_between
from tidemark.operators.adapt import CANONICAL_COLUMNS, adapt_to_canonical, align_to
from tidemark.operators.bronze import stamp
from tidemark.operators.expectations import require_columns
from tidemark.operators.silver import build_silver, latest_per_order, normalize, quarantined_rows, valid_rows
from tidemark.sources.raw import preview, read_raw, spread

TAXI_SCHEMA = (
    "VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, PULocationID int, "
    "DOLocationID int, total_amount double, fare_amount double, passenger_count bigint"
)
AT, LATER = datetime(2023, 8, 9), datetime(2023, 8, 9, 0, 22)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_csv_keeps_text_until_silver(spark, folder):
    raw = read_raw(spark, write_text(folder, "orders.CSV", ORDERS_CSV))
    assert {f.dataType.simpleString() for f in raw.schema.fields} == {"string"}
    assert raw.count() == 10 and raw.where("customer_id IS NULL").count() == 1


def test_json_lines_are_recognised(spark, folder):
    lines = "\n".join(json.dumps({"a": str(i)}) for i in range(1000))
    assert read_raw(spark, write_text(folder, "lines.json", "\n" + lines)).count() == 1000
    document = json.dumps([{"a": str(i)} for i in range(1000)], indent=1)
    assert read_raw(spark, write_text(folder, "document.json", document)).count() == 1000


def test_json_document_and_json_lines(spark, folder):
    records = [{"order_id": "o1", "amount": 1.5}, {"order_id": "o2", "amount": 2}]
    document = read_raw(spark, write_text(folder, "a.json", json.dumps(records)))
    lines = read_raw(spark, write_text(folder, "b.json", "\n".join(map(json.dumps, records))), json_lines=True)
    assert rows(document, "order_id", "amount") == rows(lines, "order_id", "amount") == [("o1", "1.5"), ("o2", "2")]


def test_json_shapes(spark, folder):
    pretty = json.dumps({"a": "1", "b": ["x"]}, indent=2)
    assert read_raw(spark, write_text(folder, "one.json", pretty)).collect() == [("1", ["x"])]
    flat = json.dumps([{"a": 1}, {"a": 2}])
    assert read_raw(spark, write_text(folder, "flat.json", flat)).count() == 2
    assert read_raw(spark, write_text(folder, "two.json", f"{flat}\n{flat}\n")).count() == 4


def test_csv_files_of_unlike_headers_are_refused(spark, folder):
    (Path(folder) / "in.csv").mkdir()
    write_text(f"{folder}/in.csv", "1.csv", "order_id,amount\na,5\n")
    write_text(f"{folder}/in.csv", "2.csv", "amount,order_id\n6,b\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_raw(spark, f"{folder}/in.csv").collect()


def test_whole_number_times_ignore_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        df = spark.createDataFrame([(0,), (1_700_000_000_123_456,), (-1,)], "t bigint")
        got = [r[0] for r in df.select(as_naive_timestamp(F.col("t"), T.LongType())).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [datetime(1970, 1, 1), datetime(2023, 11, 14, 22, 13, 20, 123456), datetime(1969, 12, 31, 23, 59, 59, 999999)]


def test_ties_with_nested_maps(spark):
    df = spark.sql("SELECT 'a' AS order_id, TIMESTAMP_NTZ '2024-01-01' AS updated_at, array(map('k', n)) AS extra FROM VALUES (1), (2) AS t(n)")
    assert latest_per_order(df).collect() == latest_per_order(df.repartition(3)).collect()


def test_unknown_suffix(spark):
    with pytest.raises(ValueError, match="Unsupported input type"):
        read_raw(spark, "orders.avro")


def test_spread_and_preview(spark, folder):
    spark.range(100).coalesce(1).write.parquet(f"{folder}/n.parquet")
    df = spread(read_raw(spark, f"{folder}/n.parquet"))
    assert df.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert [r.id for r in preview(df, ["id"], 3).collect()] == [0, 1, 2]
    assert preview(df).count() == 100


def test_canonical_passes_through_with_extra_columns(spark):
    df = spark.createDataFrame([], "note string, " + CANONICAL_SCHEMA)
    out, kind = adapt_to_canonical(df, "x")
    assert kind == "canonical" and out.columns == df.columns


def test_unknown_shape(spark):
    with pytest.raises(ValueError, match="Unsupported schema"):
        adapt_to_canonical(spark.range(1), "x")


def test_taxi_trip(spark):
    df = spark.createDataFrame([(6, AT, LATER, 31, 7, 18.75, 14.0, 3)], TAXI_SCHEMA)
    out, kind = adapt_to_canonical(df, "x")
    assert kind == "nyc_tlc_yellow_taxi" and out.columns == CANONICAL_COLUMNS
    (row,) = out.collect()
    assert row.order_id == "trip_|6|2023-08-09 00:00:00.000000000|31|7"
    assert (row.customer_id, row.category, row.product_id) == ("vendor_6", "vendor_6", "route_-31-7")
    assert (row.order_ts, row.updated_at, row.amount, row.quantity) == (AT, LATER, 18.75, 3)


def test_taxi_gaps(spark):
    trips = [
        (1, AT, LATER, 1, 2, None, 20.0, 2),  # total from the fare
        (2, AT, LATER, 1, 2, 9.0, 20.0, None),  # one passenger
        (3, AT, None, 1, 2, 9.0, 20.0, 2),  # dropoff from the pickup
        (4, AT, LATER, None, 2, 9.0, 20.0, 2),  # no ids
        (5, AT, LATER, 1, 2, -9.0, 20.0, 2),  # a negative total stays
        (6, AT, LATER, 1, 2, 9.0, 20.0, 0),  # as does 0
    ]
    out = adapt_to_canonical(spark.createDataFrame(trips, TAXI_SCHEMA), "x")[0]
    by_vendor = {r.customer_id: r for r in out.collect()}
    assert by_vendor["vendor_1"].amount == 20.0
    assert by_vendor["vendor_2"].quantity == 1
    assert by_vendor["vendor_3"].updated_at == AT
    assert by_vendor["vendor_4"].order_id is None and by_vendor["vendor_4"].product_id is None
    assert by_vendor["vendor_5"].amount == -9.0 and by_vendor["vendor_6"].quantity == 0
    assert rows(quarantined_rows(normalize(out)), "customer_id") == [("vendor_4",), ("vendor_5",), ("vendor_6",)]


def test_taxi_text_and_missing_columns(spark):
    df = spark.createDataFrame(
        [("6", "2023-08-09 00:00:00", "2023-08-09 00:22:00", "31", "7", "18.75", "3.0")],
        "VendorID string, tpep_pickup_datetime string, tpep_dropoff_datetime string, PULocationID string, "
        "DOLocationID string, total_amount string, passenger_count string",
    )
    (row,) = build_silver(adapt_to_canonical(df, "x")[0]).collect()
    assert row.order_id == "trip_|6|2023-08-09 00:00:00|31|7"
    assert (row.amount, row.quantity, row.order_ts) == (18.75, 3, AT)
    bare = df.drop("total_amount", "passenger_count")
    (row,) = adapt_to_canonical(bare, "x")[0].collect()
    assert (row.amount, row.quantity) == (None, 1)


def test_align(spark):
    df = spark.createDataFrame([(1, 2)], "b int, a int")
    assert align_to(df, ["a", "c", "b"]).collect()[0].asDict() == {"a": 2, "c": None, "b": 1}


def test_required_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    require_columns(df, ["a", "b"])
    with pytest.raises(ValueError, match="b"):
        require_columns(df.drop("b"), ["a", "b"])


def test_stamp_names_the_file(spark, folder):
    raw = read_raw(spark, write_text(folder, "orders.csv", ORDERS_CSV))
    at = datetime(2024, 1, 2, tzinfo=timezone.utc)
    marks = stamp(adapt_to_canonical(raw, "x")[0], at).select("source_file", "ingest_time").distinct().collect()
    assert [tuple(m) for m in marks] == [("orders.csv", "2024-01-02T00:00:00+00:00")]


def test_sample_orders(spark, folder):
    normal = normalize(read_raw(spark, write_text(folder, "orders.csv", ORDERS_CSV)))
    assert valid_rows(normal).count() == 8
    assert rows(quarantined_rows(normal), "order_id") == [("A-13",), ("A-14",)]
    silver = latest_per_order(valid_rows(normal))
    assert rows(silver.where("order_id = 'A-11'"), "amount", "category") == [(31.0, "textile")]
    assert silver.count() == 7


def test_null_amounts_are_quarantined(spark):
    at = datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [
            ("o1", "c", "p", at, at, "x", 1.0, 1),
            ("o2", "c", "p", at, at, "x", None, 1),
            (None, "c", "p", at, at, "x", None, 1),
            ("o4", "c", "p", at, at, "x", -1.0, 1),
            ("o5", "c", "p", at, at, None, 1.0, 1),
        ],
        CANONICAL_SCHEMA,
    )
    normal = normalize(df)
    assert valid_rows(normal).count() == 2 and quarantined_rows(normal).count() == 3


def test_bad_text_becomes_null(spark):
    df = spark.createDataFrame(
        [("o", "c", "p", "soon", "2024-01-01T10:00:00", "  \tBooks \n", "ten", "3.0")],
        ", ".join(f"{c} string" for c in CANONICAL_COLUMNS),
    )
    (row,) = normalize(df).collect()
    assert (row.order_ts, row.amount, row.quantity, row.category) == (None, None, 3, "books")
    assert row.updated_at == datetime(2024, 1, 1, 10)


def test_ties_do_not_depend_on_the_partitions(spark):
    at = datetime(2024, 1, 1)
    versions = [(f"o{i % 7}", f"c{i % 5}", f"p{i % 3}", at, at, None if i % 4 else "x", float(i % 11), i % 2) for i in range(300)]
    expected = None
    for seed, parts in [(1, 1), (2, 7), (3, 20)]:
        random.Random(seed).shuffle(versions)
        out = latest_per_order(spark.createDataFrame(versions, CANONICAL_SCHEMA).repartition(parts))
        got = sorted(map(str, out.collect()))
        assert expected is None or got == expected
        expected = got
    again = latest_per_order(latest_per_order(spark.createDataFrame(versions, CANONICAL_SCHEMA)))
    assert sorted(map(str, again.collect())) == expected


def test_dedup_reduces_before_the_shuffle(spark):
    df = spark.createDataFrame([], CANONICAL_SCHEMA)
    plan = latest_per_order(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_composite_key(spark):
    df = spark.createDataFrame([(" A ", "B", None), ("a", "b", None)], "x string, y string, z string")
    keys = {r[0] for r in df.select(composite_key(F.col("x"), F.col("y"))).collect()}
    assert len(keys) == 1 and keys.pop().startswith("23360994fdaa608e")
    import hashlib

    with_null = {r[0] for r in df.select(composite_key(F.col("x"), F.col("z"))).collect()}
    assert with_null == {hashlib.sha256(b"a||none").hexdigest()}


def test_text_helpers(spark):
    values = [12.5, 68423460.0, 1234567890.12, 0.00025, 1e20, 100.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(plain_double(F.col("v"))).collect()] == [
        "12.5",
        "68423460.0",
        "1234567890.12",
        "0.00025",
        "1.0E20",
        "100.0",
    ]
    df = spark.createDataFrame([("  a b \n",)], "s string")
    assert df.select(strip_whitespace(F.col("s"))).first()[0] == "a b"


def test_duration_ignores_the_session_zone(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 3, 10, 1, 0, 0, 900000), datetime(2024, 3, 10, 3, 30, 1)), (AT, datetime(2023, 8, 8, 23))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = [r[0] for r in df.select(seconds_between(F.col("a"), F.col("b"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [2 * 3600 + 1801, -3600]


def test_json_forms_are_told_in_one_pass_over_the_lines(spark, folder, monkeypatch):
    """each file's first line that isn't blank is found by one scan of the lines, not two."""
    import tidemark.sources.raw as raw

    seen = []
    monkeypatch.setattr(raw, "materialize", lambda df, name="table": seen.append(df) or df)
    Path(folder, "in.json").mkdir()
    write_text(f"{folder}/in.json", "a.json", "\n\n" + "\n".join(json.dumps({"a": str(i)}) for i in range(3)))
    write_text(f"{folder}/in.json", "b.json", "\n  \n" + json.dumps([{"a": "7"}, {"a": "8"}], indent=2))
    assert rows(read_raw(spark, f"{folder}/in.json"), "a") == [("0",), ("1",), ("2",), ("7",), ("8",)]
    verdicts = sorted((Path(r.file).name, r.alone) for r in seen[0].collect())
    assert verdicts == [("a.json", True), ("b.json", False)]
    final = str(seen[0]._jdf.queryExecution().executedPlan()).split("Initial Plan")[0]
    assert final.count("Scan text") == 1
