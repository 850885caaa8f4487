"""Incremental loads, stored versions, profiles, extracts, the whole job."""

from __future__ import annotations

import time
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.data import CANONICAL_SCHEMA, ORDERS_CSV, write_text
from tidemark import session
from tidemark.operators import profile
from tidemark.operators.adapt import CANONICAL_COLUMNS
from tidemark.operators.incremental import changed_days, high_water_mark, load, merge_latest, newer_than
from tidemark.operators.relax import common_type, relaxed_union
from tidemark.plans.full_run import merge_days, run
from tidemark.plans.retention import vacuum_tables
from tidemark.sinks.extracts import publish_extracts
from tidemark.sinks.files import write_bronze, write_by_day
from tidemark.sinks.versions import Versions


def order(key, day, updated, amount=1.0, category="x"):
    at = datetime(2026, 1, day)
    return (key, "c", "p", at, datetime(2026, 2, updated), category, amount, 1)


def frame(spark, *orders):
    df = spark.createDataFrame(list(orders), CANONICAL_SCHEMA)
    return df.withColumn("order_date", F.to_date("order_ts"))


def amounts(df):
    return sorted((r.order_id, r.amount) for r in df.collect())


FIRST = [order("a", 1, 5), order("b", 1, 3), order("c", 2, 4)]


def test_load_takes_newer_rows_only(spark):
    existing = frame(spark, *FIRST)
    batch = frame(spark, order("a", 1, 9, 2.0), order("b", 1, 4, 3.0), order("c", 2, 5, 4.0), order("d", 3, 6, 5.0))
    assert high_water_mark(existing) == datetime(2026, 2, 5)
    # b is older than the mark, c ties with it
    assert amounts(load(existing, batch)) == [("a", 2.0), ("b", 1.0), ("c", 1.0), ("d", 5.0)]
    late = load(existing, batch, lateness=timedelta(days=3))
    assert amounts(late) == [("a", 2.0), ("b", 3.0), ("c", 4.0), ("d", 5.0)]
    assert amounts(load(late, batch, lateness=timedelta(days=30))) == amounts(late)


def test_the_mark_ignores_the_host_zone(spark, monkeypatch):
    existing, batch = frame(spark, *FIRST), frame(spark, order("e", 1, 5), order("f", 1, 6))
    try:
        for zone in ("Asia/Kolkata", "America/New_York"):
            monkeypatch.setenv("TZ", zone)
            time.tzset()
            assert high_water_mark(existing) == datetime(2026, 2, 5)
            assert amounts(newer_than(batch, high_water_mark(existing))) == [("f", 1.0)]
    finally:
        monkeypatch.undo()
        time.tzset()


def test_load_without_news_or_without_silver(spark):
    existing = frame(spark, *FIRST)
    assert load(existing, frame(spark, order("z", 1, 5))) is existing
    assert amounts(load(None, existing)) == amounts(existing)
    assert amounts(load(existing.where("false"), existing)) == amounts(existing)
    assert amounts(load(existing, frame(spark, order("z", 1, 1)), full_refresh=True)) == [("z", 1.0)]


@pytest.mark.parametrize("broadcast_bytes", [0, 10_000])
def test_both_ways_of_merging(spark, broadcast_bytes):
    existing = frame(spark, *FIRST).withColumn("old", F.lit("kept"))
    incoming = frame(spark, order("a", 2, 9, 2.0), order("d", 3, 6, 5.0)).withColumn("new", F.lit(1))
    merged = merge_latest(existing, incoming, broadcast_bytes)
    assert sorted((r.order_id, r.amount, r.old, r.new) for r in merged.collect()) == [
        ("a", 2.0, None, 1),
        ("b", 1.0, "kept", None),
        ("c", 1.0, "kept", None),
        ("d", 5.0, None, 1),
    ]
    # a leaves the first for the second
    days = changed_days(existing, incoming, broadcast_bytes)
    assert sorted(r.order_date.day for r in days.collect()) == [1, 2, 3]


def test_versions_replace_days(spark, folder):
    table = Versions(spark, f"{folder}/t", high_water_column="updated_at")
    assert table.read() is None and table.state().versions == {}
    table.publish(frame(spark, *FIRST), "v1")
    reader = table.read()
    state = table.state()
    assert (state.rows, state.whole, state.high_water) == (3, {"v1"}, datetime(2026, 2, 5))

    # b moves from the first, which a keeps, to the third; the second is untouched
    moved = frame(spark, order("a", 1, 5), order("b", 3, 8, 9.0)).withColumn("extra", F.lit("e"))
    table.publish(moved, "v2", [date(2026, 1, 1), date(2026, 1, 3)])
    state = table.state()
    assert state.versions == {date(2026, 1, 1): "v2", date(2026, 1, 2): "v1", date(2026, 1, 3): "v2"}
    assert state.whole == {"v2"} and state.rows == 3 and state.high_water == datetime(2026, 2, 8)
    assert sorted((r.order_id, r.amount, r.extra) for r in table.read().collect()) == [
        ("a", 1.0, "e"),
        ("b", 9.0, "e"),
        ("c", 1.0, None),
    ]
    # readers of the version before are not disturbed
    assert amounts(reader) == amounts(frame(spark, *FIRST))

    # a day that is left empty goes away, as does a whole table
    table.publish(frame(spark).withColumn("extra", F.lit("e")), "v3", [date(2026, 1, 3)])
    assert set(table.state().versions) == {date(2026, 1, 1), date(2026, 1, 2)}
    table.publish(frame(spark), "v4")
    assert table.state().rows == 0 and table.read().count() == 0


def test_types_may_change_between_batches(spark, folder):
    """Text, then whole numbers, then fractions in one column; a column that comes and goes."""
    notes = [frame(spark, order("a", 1, 5)).withColumn("note", F.lit("n")).withColumn("old", F.lit(1))]
    notes.append(frame(spark, order("b", 2, 6)).withColumn("note", F.lit(7).cast("bigint")))
    notes.append(frame(spark, order("c", 1, 7)).withColumn("note", F.lit(2.5)).withColumn("old", F.lit(9).cast("bigint")))
    table = Versions(spark, f"{folder}/t", high_water_column="updated_at")
    table.publish(notes[0], "v0")
    for i, batch in enumerate(notes[1:], 1):
        merge_days(table, table.state(), batch, f"v{i}")
    got = sorted((r.order_id, r.note, r.old) for r in table.read().collect())
    assert got == [("a", "n", 1), ("b", "7", None), ("c", "2.5", 9)]
    wide = common_type(T.DecimalType(10, 2), T.LongType())
    assert (wide.precision, wide.scale) == (21, 2) and common_type(T.IntegerType(), T.DoubleType()) == T.DoubleType()


def test_nested_types_meet_part_by_part(spark):
    a = spark.sql("SELECT 1 AS id, named_struct('n', 1, 'gone', 'g') AS s, array(1) AS l, map('k', 1) AS m, array('x') AS t")
    b = spark.sql(
        "SELECT 2 AS id, named_struct('new', named_struct('x', 1L), 'n', 2.5D) AS s, array(2L) AS l, map('k', 'v') AS m, 'text' AS t"
    )
    c = spark.sql("SELECT 3 AS id, CAST(NULL AS STRUCT<n: INT>) AS s")
    got = {r.id: r for r in relaxed_union(a, b, c).collect()}
    assert got[1].s.asDict(recursive=True) == {"n": 1.0, "gone": "g", "new": None}
    assert got[2].s.asDict(recursive=True) == {"n": 2.5, "gone": None, "new": {"x": 1}}
    assert (got[1].l, got[2].l, got[1].m, got[2].m) == ([1], [2], {"k": "1"}, {"k": "v"})
    assert (got[1].t, got[2].t, got[3].s, got[3].l) == ('["x"]', "text", None, None)


def test_old_states_are_freed(spark, folder):
    table = Versions(spark, f"{folder}/t", high_water_column="updated_at", checkpoint_every=3)
    table.publish(frame(spark, *FIRST), "v1")
    for i in range(2, 8):  # the first day again and again; the second stays as it was
        table.publish(frame(spark, order("a", 1, 5, float(i)), order("b", 1, 3)), f"v{i}", [date(2026, 1, 1)])
    # one checkpoint and the commits after it
    assert sorted(Path(p).parent.name[-1] for p in table._log().inputFiles()) == ["6", "7"]
    assert table._log().where("day IS NULL").count() == 3  # the heads of v1, v6 and v7
    state = table.state()
    assert state.versions == {date(2026, 1, 1): "v7", date(2026, 1, 2): "v1"} and state.whole == {"v7"}
    assert (state.seq, state.rows, state.high_water) == (7, 3, datetime(2026, 2, 5))
    assert amounts(table.read(table.state(4))) == [("a", 4.0), ("b", 1.0), ("c", 1.0)]

    reader = table.read(table.state(5))
    Path(f"{folder}/t/data/version=dead/order_date=2026-01-09").mkdir(parents=True)  # a run that died
    Path(f"{folder}/t/commits/{8:020d}").mkdir()
    gone = {p.removeprefix(f"{folder}/t/data/") for p in table.vacuum(keep=3)}
    assert gone == {"version=v1/order_date=2026-01-01", "version=dead", *[f"version=v{i}" for i in range(2, 5)]}
    assert amounts(reader) == [("a", 5.0), ("b", 1.0), ("c", 1.0)]
    assert table.state() == state and table.state(5).seq == 5 and table.state(4).seq == 0
    assert table.recent_versions(9) == {"v5", "v6", "v7"} and table.vacuum(keep=9) == []

    table.publish(frame(spark, order("a", 1, 9, 8.0)), "v8")
    assert table.state().versions == {date(2026, 1, 1): "v8"}
    assert len(table.vacuum(keep=1)) == 4 and amounts(table.read()) == [("a", 8.0)]
    with pytest.raises(ValueError):
        table.vacuum(keep=0)


def test_freeing_the_tables_of_a_job(spark, folder):
    assert vacuum_tables(spark, f"{folder}/nothing", keep=1) == []
    header = ",".join(n for n in CANONICAL_COLUMNS)
    for i, name in enumerate(("one.csv", "two.csv", "three.csv")):
        line = f"k{i},c{i},p,2025-03-0{i + 1}T07:00:00,2025-04-0{i + 1}T09:00:00,Art,{i + 1},1"
        path = write_text(folder, name, f"{header}\n{line}")
        last = run(spark, path, f"{folder}/out", incremental=True, reports=False)
        if i == 1:
            before = last
    gone = vacuum_tables(spark, f"{folder}/out", keep=2)
    assert any("dim_customer" in p for p in gone) and any("totals" in p for p in gone)
    assert before.tables["fact_orders"].count() == 2 and before.tables["dim_customer"].count() == 2
    vacuum_tables(spark, f"{folder}/out", keep=1)
    assert last.tables["fact_orders"].count() == 3 and last.tables["dim_customer"].count() == 3
    again = run(spark, f"{folder}/three.csv", f"{folder}/out", incremental=True, reports=False)
    assert not again.changed and again.tables["dim_date"].count() == 3
    path = write_text(folder, "four.csv", f"{header}\nk0,c9,p,2025-03-01T07:00:00,2025-05-01T09:00:00,Art,5,1")
    moved = run(spark, path, f"{folder}/out", incremental=True, reports=False)
    assert moved.silver_rows == 3 and {r.customer_id for r in moved.tables["dim_customer"].collect()} == {"c1", "c2", "c9"}


def test_estimates_are_held_against_exact_figures(spark):
    rows = [(f"k{i}", "often" if i % 5 == 0 else f"v{i % 300}", float(i % 97), i if i % 3 else None) for i in range(3000)]
    df = spark.createDataFrame([*rows, (None, None, None, 10**6)], "k string, s string, d double, n bigint")
    rough = profile.profile(df, exact=False)
    checked = {r.column: r[2:] for r in profile.within_bounds(df, rough).collect()}
    assert checked == {"k": (True, True, None), "s": (True, True, None), "d": (True, None, True), "n": (True, None, True)}
    assert {r.column: r.top_category for r in rough.collect()}["s"] == "often"
    wrong = rough.withColumns(
        {
            "distinct_count": F.col("distinct_count") * 2,
            "outlier_count": F.col("outlier_count") + 900,
            "top_category": F.when(F.col("column") == "s", "v1").otherwise(F.col("top_category")),
        }
    )
    checked = {r.column: r[2:] for r in profile.within_bounds(df, wrong).collect()}
    assert checked["s"] == (False, False, None) and checked["d"] == (False, None, False) and checked["n"][2] is False
    empty = profile.profile(df.limit(0), exact=False)
    assert all(False not in r[2:] for r in profile.within_bounds(df.limit(0), empty).collect())


def test_unique_columns_need_no_count(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 3)], "id string, n int")
    exact, known = profile.profile(df), profile.profile(df, unique=["id", "n"])
    assert exact.collect() == known.collect() and known.first().top_category == "b"


def test_nested_values_are_told_apart(spark):
    df = spark.sql("SELECT array('a, b') AS x UNION ALL SELECT array('a', 'b')")
    assert profile.profile(df).first().distinct_count == 2


def test_bronze_runs_do_not_replace_each_other(spark, folder):
    df, at = spark.range(3), datetime(2026, 1, 1)
    for run_id in ("r1", "r2", "r2"):
        write_bronze(df, folder, at, run_id)
    assert spark.read.parquet(folder).groupBy("run_id").count().orderBy("run_id").collect() == [("r1", 3), ("r2", 3)]


@pytest.mark.parametrize("how", [{}, {"rows": 4}, {"in_place": True}])
def test_days_are_written_in_order(spark, folder, how):
    df = frame(spark, order("b", 2, 1), order("a", 1, 1), order("c", 1, 2), order("d", 1, 3))
    write_by_day(df, f"{folder}/t", "order_date", "order_ts", **how)
    assert {p.name for p in Path(f"{folder}/t").glob("order_date=*")} == {"order_date=2026-01-01", "order_date=2026-01-02"}
    assert amounts(spark.read.parquet(f"{folder}/t")) == amounts(df)


def test_profile_of_known_columns(spark):
    df = spark.createDataFrame(
        [("teal", 7.0), ("teal", 9.0), ("gold", 250.0), (None, 8.0)], "category string, amount double"
    )
    got = {r.column: r for r in profile.profile(df).collect()}
    assert got["category"][1:] == ("string", 0.25, 3, "teal", None, None, None)
    assert got["amount"][1:] == ("double", 0.0, 4, None, "7.0", "250.0", 1)
    short = profile.summary(profile.profile(df))
    assert short.columns == ["column", "null_rate", "distinct_count", "outlier_count"]
    rough = {r.column: r for r in profile.profile(df, exact=False).collect()}
    assert rough == got


def test_profile_edges(spark):
    schema = "s string, d double, i int, t timestamp_ntz, b boolean, x date"
    empty = {r.column: r for r in profile.profile(spark.createDataFrame([], schema)).collect()}
    assert list(empty) == ["s", "d", "i", "t", "b", "x"]
    assert empty["s"][2:] == (0.0, 0, None, None, None, None) and empty["d"].outlier_count == 0
    at = datetime(2026, 1, 1, 9)
    same = [("x", 0.0, 5, at, True, at.date()), (None, -0.0, None, at, False, None)] + [(None, 0.0, 5, at, True, None)] * 4
    got = {r.column: r for r in profile.profile(spark.createDataFrame(same, schema)).collect()}
    assert (got["d"].distinct_count, got["d"].outlier_count) == (1, 0)
    assert (got["i"].distinct_count, got["i"].null_rate) == (2, 1 / 6)
    assert (got["t"].min_value, got["x"].max_value, got["b"].distinct_count) == ("2026-01-01 09:00:00", "2026-01-01", 2)
    skipped = profile.profile(spark.createDataFrame(same, schema), skip_mode=["s"]).where("column = 's'").first()
    assert skipped.top_category is None
    only_text = spark.createDataFrame([("b",), ("a",)], "s string")
    assert profile.profile(only_text).first().top_category == "b"


@pytest.mark.parametrize("rows_per_task", [60, 10_000])
def test_outliers_by_brute_force(spark, rows_per_task):
    values = [float((i * 37) % 501) for i in range(999)] + [5000.0] * 3 + [-900.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    ordered = sorted(values)
    q1, q3 = (ordered[int((len(values) - 1) * q + 0.5)] for q in (0.25, 0.75))
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    expected = sum(v < low or v > high for v in values)
    assert profile.outliers(df, rows_per_task=rows_per_task).first().outlier_count == expected == 4


def test_extracts_are_capped(spark, folder):
    ranked, checks = spark.range(20).orderBy(F.desc("id")), spark.range(9)
    publish_extracts({"k": ranked}, {"v": checks}, folder, source="there", max_rows=5)
    read = spark.read.option("header", True)
    assert sorted(int(r.id) for r in read.csv(f"{folder}/kpis/k").collect()) == [15, 16, 17, 18, 19]
    assert read.csv(f"{folder}/validation/v").count() == 9
    assert read.csv(f"{folder}/manifest").first().asDict()["max_rows_per_csv"] == "5"


def test_scratch_needs_a_shared_folder(spark):
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert session.scratch_path(spark, "x").startswith(named)

    class Cluster:
        class conf:
            get = staticmethod(lambda *_: None)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_path(Cluster, "x")


def test_whole_job_full_then_incremental(spark, folder, monkeypatch):
    first = write_text(folder, "orders.csv", ORDERS_CSV)
    done = run(spark, first, f"{folder}/out")
    assert (done.kind, done.bronze_rows, done.quarantined_rows, done.dedup_removed, done.silver_rows) == (
        "canonical",
        10,
        2,
        1,
        7,
    )
    csv = spark.read.option("header", True)
    assert csv.csv(f"{folder}/out/kpis/kpi_daily_revenue").count() == 6
    assert csv.csv(f"{folder}/out/reports/data_profile").count() == 11
    assert len(list(Path(f"{folder}/out/kpis").iterdir())) == 13

    # the same file again brings nothing
    with monkeypatch.context() as m:  # neither the star nor the reports are built
        m.setattr("tidemark.plans.full_run._gold", None)
        m.setattr("tidemark.plans.full_run._report", None)
        again = run(spark, first, f"{folder}/out", incremental=True)
    assert (again.changed, again.skipped_rows, again.silver_rows) == (False, 8, 7)
    assert set(again.tables) == set(done.tables) and again.tables["fact_orders"].count() == 7

    # a correction that moves A-18 by a day, a new order of a known category, a late row
    header, *lines = ORDERS_CSV.splitlines()
    news = [
        "A-18,ola,cup,2025-03-13T10:00:00,2025-03-14T10:00:00,Ceramics,5,5",
        "A-19,uma,pot,2025-03-07T16:00:00,2025-03-15T16:00:00,Lighting,7,2",
        "A-10,kim,lamp,2025-03-06T07:15:00,2025-03-06T08:15:00,Lighting,999,1",
    ]
    second = write_text(folder, "more.csv", "\n".join([header, *news]))
    more = run(spark, second, f"{folder}/out", incremental=True, reports=False)
    assert (more.changed, more.skipped_rows, more.dedup_removed, more.silver_rows) == (True, 1, 1, 8)
    whole = write_text(folder, "all.csv", "\n".join([header, *lines, *news[:2]]))
    fresh = run(spark, whole, f"{folder}/fresh", reports=False)
    for name in ("fact_orders", "dim_product", "dim_category", "dim_date", "dim_customer", "dim_vendor"):
        assert sorted(map(str, more.tables[name].collect())) == sorted(map(str, fresh.tables[name].collect())), name
    # only the days that changed were written again
    fact = Versions(spark, f"{folder}/out/gold/fact_orders").state()
    rewritten = {d.day for d, v in fact.versions.items() if v == more.run_id}
    assert rewritten == {7, 13} and set(d.day for d in fact.versions) == {6, 7, 9, 10, 11, 13}

    # a new category moves the dense keys, so the whole fact is built again
    third = write_text(folder, "third.csv", f"{header}\nA-20,kim,lamp,2025-03-06T07:15:00,2025-03-20T09:00:00,Art,1,1")
    last = run(spark, third, f"{folder}/out", incremental=True, reports=False)
    keys = {r.category: r.category_sk for r in last.tables["dim_category"].collect()}
    assert keys == {"art": 1, "ceramics": 2, "furniture": 3, "lighting": 4, "textile": 5}
    assert {r.category_sk for r in last.tables["fact_orders"].collect()} == {1, 2, 3, 4, 5}
    refreshed = run(spark, first, f"{folder}/out", incremental=True, full_refresh=True, reports=False)
    assert refreshed.silver_rows == 7 and refreshed.tables["fact_orders"].count() == 7

    # tables of earlier runs can still be read, with keys that fit one another
    assert {r.category_sk for r in more.tables["dim_category"].collect()} == {1, 2, 3, 4}
    assert more.tables["dim_customer"].count() == fresh.tables["dim_customer"].count()
    assert last.tables["fact_orders"].join(last.tables["dim_category"], ["category_sk"], "left_anti").isEmpty()


def test_bronze_runs_share_one_build_of_the_raw_rows(spark, folder, monkeypatch):
    """the four runs write rows joined once, not the joins of lineitem, orders and part four times."""
    import tidemark_checks.jobs as jobs
    from tidemark_checks.catalog import CHECKS

    lines = [(k, k % 3, 7, n, 2.0, 10.5 * k, date(2024, 1, k)) for k in (1, 2, 3) for n in (1, 2)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                          "l_extendedprice double, l_shipdate date").write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(k, k * 10, date(2023, 12, k)) for k in (1, 2, 3)], "o_orderkey long, o_custkey long, "
                          "o_orderdate date").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(p, f"Brand#{p}") for p in (0, 1, 2)], "p_partkey long, p_brand string").write.parquet(f"{folder}/part.parquet")
    written = []
    real = jobs.write_bronze
    monkeypatch.setattr(jobs, "write_bronze", lambda df, *a: written.append(df) or real(df, *a))
    counts = CHECKS["bronze_partition_counts"].run(spark, folder)
    assert sorted(tuple(r) for r in counts.collect()) == [
        (date(2024, 1, 2), "first", 6), (date(2024, 1, 2), "second", 6), (date(2024, 1, 3), "third", 6)
    ]
    assert len(written) == 4
    for df in written:
        assert "Join" not in str(df._jdf.queryExecution().executedPlan())
