"""Sources, adapters, Silver and Gold."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark_checks import views
from tidemark_checks.catalog import check
from tidemark_checks.oracle import NORMAL, SILVER, VALID, events, money, orders, trips
from tidemark.functions.keys import composite_key
from tidemark.functions.money import exact_sum
from tidemark.functions.time import naive
from tidemark.operators import silver as clean
from tidemark.operators import star
from tidemark.operators.adapt import CANONICAL_COLUMNS, adapt_taxi
from tidemark.operators.bronze import stamp
from tidemark.operators.incremental import high_water_mark
from tidemark.operators.star_join import enrich
from tidemark.session import pin_utc, scratch_path
from tidemark.sinks.files import write_csv
from tidemark.sources.raw import read_raw

SOURCE_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"
CANONICAL_SQL = ", ".join(CANONICAL_COLUMNS)
INGESTED_AT = datetime(2024, 1, 2, 3, 4, 5, tzinfo=timezone.utc)


def _typed(df: DataFrame, like: DataFrame) -> DataFrame:
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in like.schema.fields])


@check("src_parquet_scan", SOURCE_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    return read_raw(spark, f"{sf_dir}/orders.parquet")


@check("src_csv_roundtrip", SOURCE_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    source, path = views.table(spark, sf_dir, "orders"), scratch_path(spark, "orders.csv")
    source.write.option("header", True).csv(path)
    return _typed(read_raw(spark, path), source)


@check("src_json_roundtrip", SOURCE_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    source, path = views.table(spark, sf_dir, "orders"), scratch_path(spark, "orders.json")
    source.write.json(path)
    names = source.select([F.col(c).cast("string") for c in source.columns]).schema
    return _typed(read_raw(spark, path, schema=names, json_lines=True), source)


@check("src_json_lines", SOURCE_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    source, path = views.table(spark, sf_dir, "orders"), scratch_path(spark, "orders.json")
    source.write.json(path)
    return _typed(read_raw(spark, path), source)


@check("src_json_array", SOURCE_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Array documents over many lines, one per file, of up to a thousand records each."""
    pin_utc(spark)
    source, path = views.table(spark, sf_dir, "orders"), scratch_path(spark, "orders.json")
    group = F.expr("o_orderkey div 4000")
    documents = source.groupBy(group.alias("g")).agg(F.to_json(F.collect_list(F.struct("*")), {"pretty": "true"}).alias("value"))
    documents.repartition("g").write.partitionBy("g").text(path)
    return _typed(read_raw(spark, path), source)


NOTE_SQL = """SELECT o_orderkey, 'say "' || o_orderpriority || '", \\' || chr(10) || '"' || o_orderstatus || '",' AS note FROM orders"""


@check("src_csv_quoted", NOTE_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values with quotes, commas, backslashes and line breaks, written and read."""
    path, status = scratch_path(spark, "notes.csv"), F.concat(F.lit('\n"'), "o_orderstatus", F.lit('",'))
    note = F.concat(F.lit('say "'), "o_orderpriority", F.lit('", \\'), status).alias("note")
    source = views.table(spark, sf_dir, "orders").select("o_orderkey", note)
    write_csv(source, path)
    return _typed(read_raw(spark, path), source)


@check("src_json_mixed_folder", SOURCE_SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the orders as lines, half as arrays over many lines, in one folder."""
    pin_utc(spark)
    source, path = views.table(spark, sf_dir, "orders"), scratch_path(spark, "orders.json")
    even = F.col("o_orderkey") % 8 < 4
    lines = source.where(even).select(F.to_json(F.struct("*")).alias("value"), F.lit(-1).cast("bigint").alias("g"))
    rest = source.where(~even).groupBy(F.expr("o_orderkey div 4000").alias("g"))
    documents = rest.agg(F.to_json(F.collect_list(F.struct("*")), {"pretty": "true"}).alias("value")).select("value", "g")
    lines.unionByName(documents).repartition("g").write.partitionBy("g").text(path)
    return _typed(read_raw(spark, path), source)


@check("adapt_taxi", trips(f"SELECT {CANONICAL_SQL} FROM raw", ""))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapt_taxi(views.trips(spark, sf_dir))


@check("bronze_stamp", events(f"SELECT {CANONICAL_SQL}, 'events.parquet' AS source_file FROM raw", ""))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stamp(views.raw_events(spark, sf_dir), INGESTED_AT).select(*CANONICAL_COLUMNS, "source_file")


@check("silver_normalize", orders(f"SELECT {CANONICAL_SQL} FROM normal", NORMAL))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.normalize(views.raw_orders(spark, sf_dir)).select(*CANONICAL_COLUMNS)


@check("silver_valid", orders(f"SELECT {CANONICAL_SQL} FROM normal WHERE {VALID}", NORMAL))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.valid_rows(clean.normalize(views.raw_orders(spark, sf_dir))).select(*CANONICAL_COLUMNS)


@check("quarantine_rows", orders(f"SELECT {CANONICAL_SQL} FROM normal WHERE NOT ({VALID})", NORMAL))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.quarantined_rows(clean.normalize(views.raw_orders(spark, sf_dir))).select(*CANONICAL_COLUMNS)


@check("silver_dedup_latest", orders(f"SELECT {CANONICAL_SQL}, supplier FROM silver", SILVER))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.silver(spark, sf_dir)


@check(
    "dedup_removed",
    orders(f"SELECT count(*) - count(DISTINCT order_id) AS dedup_removed FROM normal WHERE {VALID}", NORMAL),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = clean.valid_rows(clean.normalize(views.raw_orders(spark, sf_dir)))
    removed = valid.count() - clean.latest_per_order(valid).count()
    return spark.createDataFrame([(removed,)], "dedup_removed bigint")


@check("silver_watermark", orders("SELECT max(updated_at) AS watermark FROM silver", SILVER))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    mark = high_water_mark(views.silver(spark, sf_dir))
    return spark.range(1).select(naive(mark).alias("watermark"))


@check("fact_measures", orders("SELECT order_id, order_date, unit_amount, gross_revenue FROM fact"))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.fact(spark, sf_dir).select("order_id", "order_date", "unit_amount", "gross_revenue")


@check("fact_duration", orders("SELECT order_id, order_ts, updated_at, trip_duration_min FROM fact"))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.fact(spark, sf_dir).select("order_id", "order_ts", "updated_at", "trip_duration_min")


@check("fact_orders", orders(f"SELECT {', '.join(star.FACT_COLUMNS)} FROM fact"))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = views.stored_silver(spark, sf_dir)
    return star.fact_orders(silver, star.dim_category(silver))


@check("dim_customer", orders("SELECT customer_id FROM dim_customer"))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_customer(views.silver(spark, sf_dir))


@check("dim_product", orders("SELECT product_id, category FROM dim_product"))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_product(views.silver(spark, sf_dir))


@check("dim_category", orders("SELECT category_sk, category FROM dim_category"))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_category(views.silver(spark, sf_dir))


@check(
    "dim_date",
    orders(
        """SELECT DISTINCT order_date, CAST(year(order_date) AS INTEGER) AS year,
           CAST(month(order_date) AS INTEGER) AS month, CAST(week(order_date) AS INTEGER) AS week_of_year,
           CAST(isodow(order_date) AS INTEGER) AS day_of_week FROM fact"""
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_date(views.silver(spark, sf_dir))


@check(
    "dim_vendor",
    events("SELECT customer_id AS vendor_id, split_part(customer_id, '_', -1) AS vendor_code FROM dim_customer"),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_vendor(star.dim_customer(clean.build_silver(views.raw_events(spark, sf_dir))))


@check(
    "star_enrich",
    trips(
        f"""SELECT p.category, count(*) AS joined_rows, {money('f.gross_revenue')} AS joined_revenue,
            count(DISTINCT f.order_id) AS orders
        FROM fact f LEFT JOIN dim_product p ON f.product_id = p.product_id
        LEFT JOIN dim_customer c ON f.customer_id = c.customer_id GROUP BY p.category"""
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = views.stored_trip_silver(spark, sf_dir)
    joined = enrich(star.measures(silver).drop("category"), star.dim_product(silver), star.dim_customer(silver))
    return joined.groupBy("category").agg(
        F.count("*").alias("joined_rows"),
        exact_sum(F.col("gross_revenue")).alias("joined_revenue"),
        F.count_distinct("order_id").alias("orders"),
    )


@check(
    "composite_key",
    orders(
        """SELECT order_id, supplier, updated_at, sha256(concat(coalesce(lower(trim(customer_id)), 'none'), '||',
             coalesce(lower(trim(category)), 'none'), '||', coalesce(lower(trim(product_id)), 'none'))) AS order_key
           FROM raw""",
        "",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = views.raw_orders(spark, sf_dir)
    key = composite_key(F.col("customer_id"), F.col("category"), F.col("product_id"))
    return raw.select("order_id", "supplier", "updated_at", key.alias("order_key"))
