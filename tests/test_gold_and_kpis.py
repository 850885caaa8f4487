"""Star, ranking, KPIs, cohorts, validations."""

from __future__ import annotations

import math
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.data import CANONICAL_SCHEMA, ORDERS_CSV, write_text
from tidemark.functions.money import exact_avg, exact_sum, partial_sums, resum, total
from tidemark.operators import star
from tidemark.operators.ranking import ntile, positions, running, top_k
from tidemark.operators.silver import build_silver
from tidemark.operators.star_join import enrich
from tidemark.plans import kpis, validation
from tidemark.plans.cohort import cohort_retention
from tidemark.plans.named_pack import run_named_pack
from tidemark.session import materialize
from tidemark.sources.raw import read_raw


@pytest.fixture(scope="module")
def sample(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sample")
    bronze = read_raw(spark, write_text(str(folder), "orders.csv", ORDERS_CSV))
    silver = materialize(build_silver(bronze), "silver")
    tables = star.build_star(silver)
    tables["fact_orders"] = materialize(tables["fact_orders"], "fact")
    return tables | {"bronze_orders": bronze, "silver_orders": silver}


@pytest.fixture(scope="module")
def sample_kpis(sample):
    return kpis.kpi_suite(sample)


def listed(df):
    return [tuple(r) for r in df.collect()]


def test_star_of_one_trip(spark):
    df = spark.createDataFrame(
        [("t7", "vendor_6", "route_31-7", datetime(2025, 5, 4), datetime(2025, 5, 4, 0, 24), "vendor_6", 45.0, 3)],
        CANONICAL_SCHEMA,
    )
    tables = star.build_star(df)
    assert set(tables) == {"dim_customer", "dim_vendor", "dim_product", "dim_category", "dim_date", "fact_orders"}
    assert listed(tables["dim_vendor"]) == [("vendor_6", "6")]
    (fact,) = tables["fact_orders"].collect()
    assert tables["fact_orders"].columns == star.FACT_COLUMNS
    assert (fact.trip_duration_min, fact.unit_amount, fact.gross_revenue, fact.category_sk) == (24.0, 15.0, 135.0, 1)


def test_sample_dimensions(sample):
    assert listed(sample["dim_category"].orderBy("category_sk")) == [
        (1, "ceramics"),
        (2, "furniture"),
        (3, "lighting"),
        (4, "textile"),
    ]
    weeks = sample["dim_date"].orderBy("order_date").select("week_of_year", "day_of_week")
    assert listed(weeks) == [(10, 4), (10, 5), (10, 7), (11, 1), (11, 2), (11, 3)]
    durations = {r.order_id: r.trip_duration_min for r in sample["fact_orders"].collect()}
    assert (durations.pop("A-11"), durations.pop("A-12")) == (720.0, 30.0) and set(durations.values()) == {0.0}


def test_null_category_and_durations(spark):
    at = datetime(2026, 1, 1, 10)
    df = spark.createDataFrame(
        [
            ("a", "c", "p", at, at + timedelta(seconds=90), None, 1.0, 1),
            ("b", "c", "p", at, at - timedelta(hours=1), "x", 1.0, 1),
        ],
        CANONICAL_SCHEMA,
    )
    tables = star.build_star(df)
    assert listed(tables["dim_category"]) == [(1, "x")]
    got = {r.order_id: (r.category_sk, r.trip_duration_min) for r in tables["fact_orders"].collect()}
    assert got == {"a": (None, 1.5), "b": (1, 0.0)}
    whole = star.measures(df, whole_minutes=True)
    assert {r.order_id: r.trip_duration_min for r in whole.collect()} == {"a": 1.0, "b": 0.0}


def test_hashed_category_keys(sample):
    keys = star.dim_category(sample["silver_orders"], key_style="hash").collect()
    assert len({r.category_sk for r in keys}) == 4 and all(r.category_sk >= 0 for r in keys)
    with pytest.raises(ValueError):
        star.dim_category(sample["silver_orders"], key_style="other")


def test_many_categories_get_the_same_dense_keys(spark):
    df = spark.range(500).select(F.format_string("c%05d", F.col("id") % 250).alias("category"))
    keys = star.dim_category(df, rows_per_task=40).orderBy("category").collect()
    assert [r.category_sk for r in keys] == list(range(1, 251))


def test_sample_kpis(sample_kpis):
    got = {name: listed(df) for name, df in sample_kpis.items()}
    days = [date(2025, 3, d) for d in (6, 7, 9, 10, 11, 12)]
    assert got["kpi_daily_revenue"] == list(zip(days, [191.0, 50.0, 240.0, 99.0, 225.0, 20.0]))
    assert [r[2] for r in got["kpi_revenue_lag"]] == [None, 191.0, 50.0, 240.0, 99.0, 225.0]
    assert [r[2] for r in got["kpi_running_revenue"]] == [191.0, 241.0, 481.0, 580.0, 805.0, 825.0]
    assert got["kpi_revenue_by_week"] == [(date(2025, 3, 3), 481.0), (date(2025, 3, 10), 344.0)]
    assert got["kpi_top_categories"] == [("furniture", 465.0), ("lighting", 160.0), ("textile", 130.0), ("ceramics", 70.0)]
    units = [("ceramics", 9), ("furniture", 2), ("lighting", 2), ("textile", 4)]
    assert sorted(got["kpi_quantity_by_category"]) == units
    assert got["kpi_top_products"] == [("desk", 465.0), ("lamp", 160.0), ("rug", 130.0), ("vase", 50.0), ("cup", 20.0)]
    assert got["kpi_orders_per_customer"] == [("kim", 3), ("ola", 2), ("ravi", 1), ("tess", 1)]
    quartiles = [("kim", 4), ("ola", 1), ("ravi", 3), ("tess", 2)]
    assert sorted((c, q) for c, _, q in got["kpi_customer_ntile"]) == quartiles
    assert sorted(got["kpi_peak_hour"]) == [(h, 1) for h in (7, 10, 11, 13, 16, 18, 20)]
    assert got["kpi_avg_order_value"] == [(825.0 / 7,)]
    assert sorted((c, g, rn) for c, _, g, rn in got["kpi_order_rank_per_customer"])[:3] == [
        ("kim", 50.0, 3),
        ("kim", 160.0, 2),
        ("kim", 225.0, 1),
    ]


def test_sample_cohort_and_validations(sample):
    assert listed(cohort_retention(sample["fact_orders"])) == [(date(2025, 3, 1), 0, 4, 4, 1.0)]
    got = {name: listed(df)[0] for name, df in validation.validation_suite(sample).items()}
    assert got == {
        "validation_duplicates_before": (1,),
        "validation_duplicates_after": (0,),
        "validation_null_rates_silver": (0.0, 0.0, 0.0, 0.0, 0.0),
        "validation_referential_integrity": (0, 0),
    }


def test_integrity_of_an_empty_and_of_a_broken_fact(sample):
    fact, customers, products = (sample[n] for n in ("fact_orders", "dim_customer", "dim_product"))
    assert listed(validation.referential_integrity(fact.where("false"), customers, products)) == [(0, 0)]
    # kim has three orders, desk two; a doubled dimension row must not count them twice
    few = customers.where("customer_id <> 'kim'")
    less = products.where("product_id <> 'desk'")
    assert listed(validation.referential_integrity(fact, few.union(few), less.union(less))) == [(3, 2)]


def test_categories_of_a_product_count_twice_only_via_product(spark):
    at = datetime(2026, 1, 1)
    df = spark.createDataFrame(
        [("a", "c", "p", at, at, "x", 10.0, 1), ("b", "c", "p", at, at, "y", 5.0, 2)], CANONICAL_SCHEMA
    )
    tables = star.build_star(df)
    fact = tables["fact_orders"]
    by_key = kpis.by_category(fact, tables["dim_category"])
    assert listed(kpis.top_categories(by_key)) == [("x", 10.0), ("y", 10.0)]
    assert listed(kpis.quantity_by_category(by_key)) == [("y", 2), ("x", 1)]
    assert listed(kpis.top_categories_via_product(fact, tables["dim_product"])) == [("x", 20.0), ("y", 20.0)]
    assert listed(kpis.quantity_by_category_via_product(fact, tables["dim_product"])) == [("x", 3), ("y", 3)]
    assert enrich(fact, tables["dim_product"], tables["dim_customer"]).count() == 4


def test_named_pack(spark, sample):
    out = run_named_pack(spark, sample, {"n": "SELECT count(*) AS n FROM fact_orders", "m": "SELECT 1 AS m"})
    assert listed(out["n"]) == [(7,)] and listed(out["m"]) == [(1,)]


def skewed(spark, rows=3000):
    """A third of the rows in one group, and in that group a third of the values equal."""
    return materialize(
        spark.range(rows).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), F.col("id") % 50)).alias("g"),
            F.when(F.col("id") % 9 == 0, 7.0).otherwise((F.col("id") * 7919 % 1000).cast("double")).alias("v"),
            F.col("id"),
        ),
        "skewed",
    )


@pytest.mark.parametrize("rows_per_task", [37, 400, 10_000])
def test_positions_equal_row_number(spark, rows_per_task):
    df, order = skewed(spark), [F.col("v").desc(), F.col("id").asc()]
    expected = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(*order)).cast("bigint"))
    assert sorted(listed(positions(df, order, ["g"], rows_per_task=rows_per_task))) == sorted(listed(expected))


@pytest.mark.parametrize("rows_per_task", [100, 10_000])
def test_running_sum_equals_the_window(spark, rows_per_task):
    df, order = skewed(spark), [F.col("v").asc(), F.col("id").asc()]
    frame = Window.partitionBy("g").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    expected = df.withColumn("s", F.sum("id").over(frame))
    assert sorted(listed(running(df, order, ["g"], "id", "s", rows_per_task))) == sorted(listed(expected))


def test_null_groups_have_positions(spark):
    df = materialize(spark.range(90).select(F.when(F.col("id") % 2 == 0, "a").alias("g"), "id"), "nulls")
    got = listed(positions(df, [F.col("id").asc()], ["g"], rows_per_task=10))
    assert sorted(r[2] for r in got if r[0] is None) == list(range(1, 46))


def test_ntile_equals_the_builtin(spark):
    order = [F.col("v").asc(), F.col("id").asc()]
    for n in [*range(0, 21), 333]:
        df = materialize(skewed(spark, 333).where(F.col("id") < n), "few")
        expected = sorted(listed(df.withColumn("t", F.ntile(4).over(Window.orderBy(*order)).cast("bigint"))))
        for rows_per_task in [5, 10_000] if n in (0, 3, 7, 20, 333) else [10_000]:
            assert sorted(listed(ntile(df, 4, order, "t", rows_per_task))) == expected


def test_order_ranks_of_a_hot_customer(spark):
    at = datetime(2026, 1, 1)
    fact = materialize(
        skewed(spark, 900).select(
            F.col("g").alias("customer_id"),
            F.concat(F.lit("o"), "id").alias("order_id"),
            F.lit(at).cast("timestamp_ntz").alias("order_ts"),
            F.col("v").alias("gross_revenue"),
        ),
        "fact",
    )
    split = listed(kpis.order_rank_per_customer(fact, rows_per_task=50))
    assert sorted(split) == sorted(listed(kpis.order_rank_per_customer(fact)))
    top = listed(kpis.order_rank_per_customer(fact, top_n=2))
    assert sorted(top) == sorted(r for r in split if r[3] <= 2)


def test_top_k(spark):
    df = spark.createDataFrame([("jay", 4.5), ("elk", 9.0), ("owl", 6.0), ("bat", 6.0)], "label string, value double")
    assert listed(top_k(df, "label", "value", 2)) == [("elk", 9.0), ("bat", 6.0)]


def test_exact_sums(spark):
    random.seed(5)
    cents = [random.randrange(1, 10**9) for _ in range(2000)]
    df = spark.createDataFrame([(c / 100, i % 3) for i, c in enumerate(cents)], "v double, k int")
    for parts in (1, 7):
        spread = df.repartition(parts)
        assert spread.agg(exact_sum(F.col("v"))).first()[0] == sum(cents) / 100
        assert spread.agg(exact_avg(F.col("v"))).first()[0] == sum(cents) / 100 / 2000
        twice = spread.groupBy("k").agg(*partial_sums(F.col("v"), "s")).agg(*resum("s")).select(total("s"))
        assert twice.first()[0] == sum(cents) / 100


def test_sums_leave_nothing_out(spark):
    def add(*values):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        return df.agg(exact_sum(F.col("v"))).first()[0]

    assert add(1e12, 0.5, -2.25) == 1e12 - 1.75
    assert math.isinf(add(1.0, math.inf)) and math.isnan(add(1.0, math.nan))
    assert math.isclose(add(*[4e-7] * 1000), 4e-4, rel_tol=1e-12)
    assert math.isclose(add(3.0, 1.25e-7), 3.000000125, rel_tol=1e-15)
    near = [999_999_999.999999] * 1000
    assert math.isclose(add(*near), 999_999_999_999.999, rel_tol=1e-15)
    assert add(None, None) is None and add(None, -0.1, 0.3) == 0.2
    assert spark.createDataFrame([], "v double").agg(exact_avg(F.col("v"))).first()[0] is None


def test_retention_counts_a_customer_once_a_month(spark):
    def order(i, customer, *day):
        at = datetime(*day)
        return (f"o{i}", customer, "p", at, at, "x", 1.0, 1)

    df = spark.createDataFrame(
        [
            order(1, "a", 2025, 11, 3),
            order(2, "a", 2025, 11, 9),
            order(3, "a", 2026, 1, 1),
            order(4, "b", 2025, 11, 30),
            order(5, "c", 2026, 1, 31),
        ],
        CANONICAL_SCHEMA,
    )
    assert listed(cohort_retention(df)) == [
        (date(2025, 11, 1), 0, 2, 2, 1.0),
        (date(2025, 11, 1), 2, 1, 2, 0.5),
        (date(2026, 1, 1), 0, 1, 1, 1.0),
    ]
