"""Totals kept up to date by the days that changed."""

from __future__ import annotations

import random
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.data import CANONICAL_SCHEMA
from tidemark.operators.silver import latest_per_order
from tidemark.plans import full_run
from tidemark.plans import totals as order_totals
from tidemark.plans.full_run import run
from tidemark.sinks.versions import Versions

EXACT = ["orders", "units", "odd", "revenue__hi", "revenue__lo"]


def orders(spark, rows):
    return spark.createDataFrame(rows, CANONICAL_SCHEMA)


def order(key, day, updated, amount, category="x", customer="c", product="p", hour=0):
    return (key, customer, product, datetime(2026, 1, day, hour), datetime(2026, 2, updated), category, amount, 2)


def rows_of(df, kind):
    return {
        tuple(r[c] for c in kind.groups): (tuple(r[c] for c in EXACT), r[order_totals.REST]) for r in df.collect()
    }


def assert_same_totals(got, want):
    for name, kind in order_totals.kinds().items():
        a, b = rows_of(got[f"totals_{name}"], kind), rows_of(want[f"totals_{name}"], kind)
        assert {k: v[0] for k, v in a.items()} == {k: v[0] for k, v in b.items()}, name
        assert {k: v[1] for k, v in a.items()} == pytest.approx({k: v[1] for k, v in b.items()}, nan_ok=True), name


def test_batches_come_to_what_one_run_gives(spark, folder):
    """Orders that move between days, groups that vanish, fine and huge amounts, null categories."""
    rng = random.Random(5)
    amounts = [1.25, 3.0, 1e-9, 1 / 3, 5e9, 1e308, float("inf")]
    history, batches = {}, []
    for batch in range(2):
        rows = []
        for _ in range(30):
            key = f"o{rng.randrange(40)}"
            row = order(key, rng.randrange(1, 8), 1 + batch, rng.choice(amounts[: 4 + 3 * batch]), rng.choice(["x", "y", None]),
                        rng.choice("abc"), rng.choice("pqr"), rng.randrange(3))
            rows.append(row)
        batches.append(rows)
        history[batch] = [r for b in batches for r in b]
    for i, rows in enumerate(batches):
        orders(spark, rows).write.parquet(f"{folder}/b{i}.parquet")
        got = run(spark, f"{folder}/b{i}.parquet", f"{folder}/lake", incremental=i > 0, reports=i == 1).tables
    orders(spark, history[1]).write.parquet(f"{folder}/all.parquet")
    want = run(spark, f"{folder}/all.parquet", f"{folder}/fresh").tables
    assert_same_totals(got, want)
    for name in full_run.star.DIMENSIONS + ["fact_orders"]:
        assert sorted(map(str, got[name].collect())) == sorted(map(str, want[name].collect())), name
    for path in Path(f"{folder}/fresh/kpis").iterdir():
        if path.name not in full_run.FACT_SIZED:
            read = spark.read.option("header", True).csv
            a, b = (sorted(map(str, read(f"{folder}/{root}/kpis/{path.name}").collect())) for root in ("lake", "fresh"))
            assert a == b, path.name


def test_totals_are_those_of_the_orders(spark):
    """Against plain Python, for each kind."""
    rng = random.Random(6)
    rows = [order(f"o{i}", rng.randrange(1, 5), 1, rng.randrange(1, 999) / 100, rng.choice(["x", None]), rng.choice("ab")) for i in range(60)]
    silver = orders(spark, rows).withColumn("order_date", F.to_date("order_ts"))
    kinds = order_totals.kinds()
    got = order_totals.by_customer(order_totals.totals_of(order_totals.parts_of(silver, kinds["customers"]), kinds["customers"]))
    want = {c: (sum(round(r[6] * 100) * 2 for r in rows if r[1] == c) / 100, sum(r[1] == c for r in rows)) for c in "ab"}
    assert {r.customer_id: (r.total_revenue, r.order_count) for r in got.collect()} == want
    got = order_totals.by_category(order_totals.totals_of(order_totals.parts_of(silver, kinds["products"]), kinds["products"]))
    want = {c: (sum(round(r[6] * 100) * 2 for r in rows if r[5] == c) / 100, 2 * sum(r[5] == c for r in rows)) for c in ("x", None)}
    assert {r.category: (r.revenue, r.units) for r in got.collect()} == want
    empty = order_totals.totals_of(order_totals.parts_of(silver.where("false"), kinds["hours"]), kinds["hours"])
    assert empty.count() == 0


def spoil(folder, keep_days):
    """Files of other days hold bytes that no reader takes for Parquet."""
    spoilt = 0
    for path in Path(folder).rglob("*.parquet"):
        if path.is_file() and "order_date=" in str(path) and not any(f"order_date=2026-01-0{d}" in str(path) for d in keep_days):
            path.write_bytes(b"not parquet")
            path.with_name(f".{path.name}.crc").unlink(missing_ok=True)
            spoilt += 1
    return spoilt


def test_days_that_did_not_change_are_not_read(spark, folder):
    first = [order(f"o{d}{i}", d, 1, 2.5, customer=f"c{i}") for d in range(1, 7) for i in range(3)]
    orders(spark, first).write.parquet(f"{folder}/first.parquet")
    run(spark, f"{folder}/first.parquet", f"{folder}/lake", reports=False)
    silver = Versions(spark, f"{folder}/lake/silver/orders", high_water_column="updated_at")
    was = silver.state()
    news = orders(spark, [order("new", 2, 5, 7.0, customer="c9"), order("o30", 4, 6, 1.0, customer="c0")])
    news = latest_per_order(news.withColumn("order_date", F.to_date("order_ts")))
    days = full_run.merge_days(silver, was, news, "second")
    assert sorted(d.day for d in days) == [2, 3, 4]
    now = silver.state()
    assert spoil(f"{folder}/lake/silver", (2, 3, 4)) and spoil(f"{folder}/lake/gold/parts", (2, 3, 4))
    gold = full_run._gold(silver.read(now), f"{folder}/lake/gold", was.version, now, days)
    customers = order_totals.by_customer(gold["totals_customers"])
    assert {r.customer_id: (r.order_count, r.total_revenue) for r in customers.collect()} == {
        "c0": (6, 27.0),
        "c1": (6, 30.0),
        "c2": (6, 30.0),
        "c9": (1, 14.0),
    }
    with pytest.raises(Exception, match="(?i)parquet"):  # the spoilt days are really unreadable
        silver.read(now).agg(F.sum("amount")).collect()


def test_a_star_stored_without_totals_gets_them(spark, folder, monkeypatch):
    orders(spark, [order("a", 1, 1, 2.0)]).write.parquet(f"{folder}/in.parquet")
    done = run(spark, f"{folder}/in.parquet", f"{folder}/lake", reports=False)
    version = Versions(spark, f"{folder}/lake/gold/fact_orders").state().version
    elsewhere = lambda root, name, version: f"{root}/totals_anew/{name}/version={version}"
    monkeypatch.setattr(order_totals, "totals_path", elsewhere)
    again = run(spark, f"{folder}/in.parquet", f"{folder}/lake", incremental=True, reports=False)
    assert not again.changed and again.tables["totals_hours"].collect() == done.tables["totals_hours"].collect()
    assert Versions(spark, f"{folder}/lake/gold/fact_orders").state().version == version
