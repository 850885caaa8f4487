"""KPIs, cohorts, validations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark_checks import views
from tidemark_checks.catalog import check
from tidemark_checks.oracle import REVENUE, SILVER, events, orders, trips
from tidemark.operators import star
from tidemark.plans import cohort, kpis, validation
from tidemark.session import materialize

DAY = "CAST(order_ts AS DATE)"


@check("kpi_daily_revenue", orders(f"SELECT {DAY} AS order_day, {REVENUE} AS revenue FROM fact GROUP BY 1"))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.daily_revenue(kpis.by_day(views.fact(spark, sf_dir)))


@check(
    "kpi_daily_revenue_fine_amounts",
    orders(f"SELECT {DAY} AS order_day, round(sum(gross_revenue / 1e7), 9) AS revenue FROM fact GROUP BY 1"),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    # amounts far below a millionth's precision, against a plain sum of doubles
    fine = views.silver(spark, sf_dir).withColumn("amount", F.col("amount") / F.lit(1e7))
    return kpis.daily_revenue(kpis.by_day(star.measures(fine))).withColumn("revenue", F.round("revenue", 9))


@check(
    "kpi_revenue_by_week",
    orders(f"SELECT CAST(date_trunc('week', order_ts) AS DATE) AS order_week, {REVENUE} AS revenue FROM fact GROUP BY 1"),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.revenue_by_week(kpis.by_day(views.fact(spark, sf_dir)))


@check(
    "kpi_revenue_lag",
    orders(
        f"""SELECT *, lag(revenue) OVER (ORDER BY order_day) AS prev_day_revenue
            FROM (SELECT {DAY} AS order_day, {REVENUE} AS revenue FROM fact GROUP BY 1)"""
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.revenue_lag(kpis.by_day(views.fact(spark, sf_dir)))


@check(
    "kpi_running_revenue",
    orders(
        f"""SELECT order_day, CAST(CAST(revenue AS VARCHAR) AS DOUBLE) AS revenue,
              CAST(CAST(sum(revenue) OVER (ORDER BY order_day) AS VARCHAR) AS DOUBLE) AS running_revenue
            FROM (SELECT {DAY} AS order_day, SUM(CAST(gross_revenue AS DECIMAL(28,6))) AS revenue
                  FROM fact GROUP BY 1)"""
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.running_revenue(kpis.by_day(views.fact(spark, sf_dir)))


@check("kpi_avg_order_value", orders(f"SELECT {REVENUE} / count(gross_revenue) AS avg_order_value FROM fact"))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.avg_order_value(kpis.by_day(views.fact(spark, sf_dir)))


@check(
    "kpi_orders_per_customer",
    orders("SELECT customer_id, count(*) AS order_count FROM fact GROUP BY 1"),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.orders_per_customer(kpis.by_customer(views.fact(spark, sf_dir)))


@check(
    "kpi_peak_hour",
    events("SELECT CAST(hour(order_ts) AS BIGINT) AS order_hour, count(*) AS orders FROM fact GROUP BY 1"),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.peak_hour(views.event_fact(spark, sf_dir))


@check(
    "kpi_top_products",
    orders(f"SELECT product_id, {REVENUE} AS revenue FROM fact GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.top_products(views.fact(spark, sf_dir))


@check(
    "kpi_customer_ntile",
    orders(
        f"""SELECT customer_id, total_revenue,
              CAST(ntile(4) OVER (ORDER BY total_revenue, customer_id) AS BIGINT) AS revenue_quartile
            FROM (SELECT customer_id, {REVENUE} AS total_revenue FROM fact GROUP BY 1)"""
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.customer_ntile(materialize(kpis.by_customer(views.fact(spark, sf_dir)), "customers"))


@check(
    "kpi_order_rank_per_customer",
    orders(
        """SELECT customer_id, order_ts, gross_revenue,
             row_number() OVER (PARTITION BY customer_id ORDER BY gross_revenue DESC, order_id) AS rn FROM fact"""
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.order_rank_per_customer(materialize(views.fact(spark, sf_dir).select(*kpis.RANKED), "orders"))


# The next two have their tasks hold a sixth of the rows, so that the groups are split.


@check(
    "kpi_order_rank_few_customers",
    trips(
        """SELECT customer_id, order_ts, gross_revenue,
             row_number() OVER (PARTITION BY customer_id ORDER BY gross_revenue DESC, order_id) AS rn FROM fact"""
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    # three customers, each with a third of the orders
    fact = materialize(star.measures(views.stored_trip_silver(spark, sf_dir)).select(*kpis.RANKED), "orders")
    return kpis.order_rank_per_customer(fact, rows_per_task=max(1, fact.count() // 6))


@check(
    "kpi_customer_ntile_split",
    orders(
        f"""SELECT customer_id, total_revenue,
              CAST(ntile(4) OVER (ORDER BY total_revenue, customer_id) AS BIGINT) AS revenue_quartile
            FROM (SELECT customer_id, {REVENUE} AS total_revenue FROM fact GROUP BY 1)"""
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = materialize(kpis.by_customer(views.fact(spark, sf_dir)), "customers")
    return kpis.customer_ntile(customers, rows_per_task=max(1, customers.count() // 6))


@check(
    "kpi_order_rank_top3",
    orders(
        """SELECT customer_id, order_ts, gross_revenue, rn FROM (SELECT *,
             row_number() OVER (PARTITION BY customer_id ORDER BY gross_revenue DESC, order_id) AS rn FROM fact)
           WHERE rn <= 3"""
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.order_rank_per_customer(views.fact(spark, sf_dir), top_n=3)


TOP_CATEGORIES = f"SELECT category, {REVENUE} AS revenue FROM fact GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"
UNITS = "SELECT category, CAST(sum(quantity) AS BIGINT) AS units FROM fact GROUP BY 1"


def _by_category(silver: DataFrame) -> DataFrame:
    categories = star.dim_category(silver)
    return kpis.by_category(star.fact_orders(silver, categories), categories)


@check("kpi_top_categories", orders(TOP_CATEGORIES))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.top_categories(_by_category(views.stored_silver(spark, sf_dir)))


@check("kpi_top_categories_trips", trips(TOP_CATEGORIES))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.top_categories(_by_category(views.stored_trip_silver(spark, sf_dir)))


@check("kpi_quantity_by_category", orders(UNITS))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.quantity_by_category(_by_category(views.stored_silver(spark, sf_dir)))


@check("kpi_quantity_by_category_trips", trips(UNITS))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.quantity_by_category(_by_category(views.stored_trip_silver(spark, sf_dir)))


@check(
    "kpi_top_categories_via_product",
    trips(
        f"""SELECT p.category, {REVENUE} AS revenue FROM fact f JOIN dim_product p USING (product_id)
            GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"""
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = views.stored_trip_silver(spark, sf_dir)
    return kpis.top_categories_via_product(star.measures(silver), star.dim_product(silver))


@check(
    "kpi_quantity_by_category_via_product",
    trips(
        """SELECT p.category, CAST(sum(f.quantity) AS BIGINT) AS units
           FROM fact f JOIN dim_product p USING (product_id) GROUP BY 1"""
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = views.stored_trip_silver(spark, sf_dir)
    return kpis.quantity_by_category_via_product(star.measures(silver), star.dim_product(silver))


@check(
    "cohort_retention",
    orders(
        """, seen AS (
             SELECT DISTINCT customer_id AS who, CAST(date_trunc('month', order_ts) AS DATE) AS m FROM fact),
           since AS (SELECT m, min(m) OVER (PARTITION BY who) AS start FROM seen),
           counted AS (SELECT start, date_diff('month', start, m) AS k, count(*) AS n FROM since GROUP BY ALL)
           SELECT start AS cohort_month, k AS month_number, n AS active_customers,
                  first_value(n) OVER by_start AS cohort_size,
                  round(CAST(n AS DOUBLE) / first_value(n) OVER by_start, 4) AS retention_rate
           FROM counted WINDOW by_start AS (PARTITION BY start ORDER BY k)"""
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort.cohort_retention(views.fact(spark, sf_dir))


@check(
    "validation_duplicates_before",
    orders("SELECT count(*) - count(DISTINCT order_id) AS duplicate_rows_before FROM raw", ""),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.duplicate_rows(views.raw_orders(spark, sf_dir), "duplicate_rows_before")


@check(
    "validation_duplicates_after",
    orders("SELECT count(*) - count(DISTINCT order_id) AS duplicate_rows_after FROM silver", SILVER),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.duplicate_rows(views.silver(spark, sf_dir), "duplicate_rows_after")


@check(
    "validation_null_rates_silver",
    orders(
        "SELECT "
        + ", ".join(f"avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS {c}_null_rate" for c in validation.NULL_CHECKED)
        + " FROM silver",
        SILVER,
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.null_rates(views.silver(spark, sf_dir))


@check(
    "validation_null_rates_bronze",
    orders(
        "SELECT "
        + ", ".join(f"avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS {c}_null_rate" for c in validation.NULL_CHECKED)
        + " FROM raw",
        "",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.null_rates(views.raw_orders(spark, sf_dir))


@check(
    "validation_referential_integrity",
    orders(
        """SELECT
             (SELECT count(*) FROM fact WHERE NOT EXISTS (
                SELECT 1 FROM customer WHERE c_acctbal >= 0 AND concat('cust_', c_custkey) = fact.customer_id)
             ) AS missing_customer_fk,
             (SELECT count(*) FROM fact WHERE NOT EXISTS (
                SELECT 1 FROM part WHERE p_size < 40 AND concat('p', p_partkey) = fact.product_id)
             ) AS missing_product_fk"""
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    # dimensions that lack some of the fact's keys
    fact = materialize(views.fact(spark, sf_dir).select("customer_id", "product_id"), "keys")
    customers = views.table(spark, sf_dir, "customer").where("c_acctbal >= 0")
    parts = views.table(spark, sf_dir, "part").where("p_size < 40")
    return validation.referential_integrity(
        fact,
        customers.select(F.concat(F.lit("cust_"), "c_custkey").alias("customer_id")),
        parts.select(F.concat(F.lit("p"), "p_partkey").alias("product_id")),
    )
