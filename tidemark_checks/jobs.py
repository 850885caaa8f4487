"""Stored layers, incremental loads, profiles, extracts and query packs."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark_checks import views
from tidemark_checks.catalog import check
from tidemark_checks.layers import CANONICAL_SQL, INGESTED_AT
from tidemark_checks.oracle import LATEST, NORMAL, REVENUE, SILVER, VALID, events, orders
from tidemark.operators import profile
from tidemark.operators.bronze import stamp
from tidemark.operators.incremental import load, newer_than
from tidemark.operators.ranking import top_k
from tidemark.operators.silver import build_silver, latest_per_order, normalize, quarantined_rows, valid_rows
from tidemark.plans import kpis, validation
from tidemark.plans.full_run import FACT_SIZED, merge_days, run
from tidemark.plans.named_pack import run_named_pack
from tidemark.session import materialize, scratch_path
from tidemark.sinks.extracts import MAX_ROWS, publish_extracts
from tidemark.sinks.files import write_bronze, write_by_day, write_quarantine
from tidemark.sinks.versions import Versions
from tidemark.sources.layers import read_layer
from tidemark.sources.raw import PREVIEW_ROWS, preview

FIRST_BATCH_ENDS = "1999-01-01"
SILVER_SQL = f"{CANONICAL_SQL}, supplier"


@check(
    "bronze_partition_counts",
    orders(
        """SELECT DATE '2024-01-02' AS ingest_date, 'first' AS run_id, count(*) AS bronze_rows FROM raw
           UNION ALL SELECT DATE '2024-01-02', 'second', count(*) FROM raw
           UNION ALL SELECT DATE '2024-01-03', 'third', count(*) FROM raw""",
        "",
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the joins behind the raw rows run once, not once for each run
    root, raw = scratch_path(spark, "bronze"), materialize(views.raw_orders(spark, sf_dir), "raw")
    # the second run is repeated, which must not add its rows twice
    for run_id, day in [("first", 0), ("second", 0), ("second", 0), ("third", 1)]:
        at = INGESTED_AT + timedelta(days=day)
        write_bronze(stamp(raw, at, "lineitem"), root, at, run_id)
    return spark.read.parquet(root).groupBy("ingest_date", "run_id").agg(F.count("*").alias("bronze_rows"))


@check(
    "quarantine_partition_counts",
    orders(f"SELECT 'first' AS run_id, count(*) AS rejected FROM normal WHERE NOT ({VALID})", NORMAL),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "quarantine")
    write_quarantine(quarantined_rows(normalize(views.raw_orders(spark, sf_dir))), root, "first")
    return spark.read.parquet(root).groupBy("run_id").agg(F.count("*").alias("rejected"))


@check(
    "silver_partition_counts",
    orders("SELECT CAST(order_ts AS DATE) AS order_date, count(*) AS orders FROM silver GROUP BY 1", SILVER),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, dated = scratch_path(spark, "by_day"), views.fact(spark, sf_dir).select("order_id", "order_ts", "order_date")
    stored = materialize(dated, "silver")
    write_by_day(stored, path, "order_date", "order_ts", rows=stored.count())
    return spark.read.parquet(path).groupBy("order_date").agg(F.count("*").alias("orders"))


@check("src_layer_recursive", events(f"SELECT {CANONICAL_SQL}, CASE WHEN quantity > 1 THEN 'deep' END AS origin FROM silver", SILVER))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver in files at two depths, one of which has a column more."""
    path, silver = scratch_path(spark, "layer"), materialize(build_silver(views.raw_events(spark, sf_dir)), "silver")
    silver.where("quantity <= 1").write.parquet(f"{path}/a")
    silver.where("quantity > 1").withColumn("origin", F.lit("deep")).write.parquet(f"{path}/b/run=1/part")
    return read_layer(spark, path)


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_rows(normalize(views.raw_orders(spark, sf_dir)))


def _first_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = _valid(spark, sf_dir).where(F.col("updated_at") < F.lit(FIRST_BATCH_ENDS).cast("timestamp_ntz"))
    return materialize(latest_per_order(first), "silver")


FIRST_SILVER = f"""{NORMAL},
valid AS (SELECT * FROM normal WHERE {VALID}),
existing AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, {LATEST} AS place FROM valid WHERE updated_at < TIMESTAMP '{FIRST_BATCH_ENDS}') WHERE place = 1
)"""


def _merged_sql(lateness: str) -> str:
    return orders(
        f"""SELECT {SILVER_SQL} FROM (SELECT *, {LATEST} AS place FROM (
              SELECT * FROM existing UNION ALL
              SELECT * FROM valid WHERE updated_at > (SELECT max(updated_at) FROM existing) - {lateness}))
            WHERE place = 1""",
        FIRST_SILVER,
    )


@check("incremental_merge", _merged_sql("INTERVAL 0 DAY"))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(_first_silver(spark, sf_dir), _valid(spark, sf_dir))


@check("incremental_merge_late", _merged_sql("INTERVAL 30 DAY"))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    # rows of the last 30 days are read again, and merging them twice changes nothing
    return load(_first_silver(spark, sf_dir), _valid(spark, sf_dir), lateness=timedelta(days=30))


@check(
    "incremental_merge_mixed_types",
    orders(
        f"""SELECT {CANONICAL_SQL}, CAST(supplier AS VARCHAR) AS supplier, origin
            FROM (SELECT *, {LATEST} AS place FROM (
              SELECT *, 'first' AS origin FROM existing UNION ALL
              SELECT *, NULL FROM valid WHERE updated_at > (SELECT max(updated_at) FROM existing)))
            WHERE place = 1""",
        FIRST_SILVER,
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a column that is text on one side and whole numbers on the other, and one that only Silver has
    first = _first_silver(spark, sf_dir).withColumn("supplier", F.col("supplier").cast("string"))
    return load(first.withColumn("origin", F.lit("first")), _valid(spark, sf_dir))


@check(
    "incremental_merge_nested",
    orders(
        """SELECT order_id, updated_at, key, CAST(units AS DOUBLE) AS units, tag FROM (SELECT *, row_number() OVER (PARTITION BY order_id
               ORDER BY updated_at DESC) AS place FROM (
             SELECT order_id, updated_at, order_id AS key, quantity AS units, NULL AS tag FROM existing UNION ALL
             SELECT order_id, updated_at, NULL, quantity + 0.5, category FROM valid
              WHERE updated_at > (SELECT max(updated_at) FROM existing)))
           WHERE place = 1""",
        FIRST_SILVER,
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A struct that loses a field, gains one and changes the type of a third stays a struct."""
    had = F.struct(F.col("order_id").alias("key"), F.col("quantity").alias("units"))
    has = F.struct((F.col("quantity") + F.lit(0.5)).alias("units"), F.array("category").alias("tags"))
    merged = load(_first_silver(spark, sf_dir).withColumn("detail", had), _valid(spark, sf_dir).withColumn("detail", has))
    return merged.select("order_id", "updated_at", "detail.key", "detail.units", F.get("detail.tags", F.lit(0)).alias("tag"))


@check(
    "full_run_counts",
    events(
        f"""SELECT (SELECT count(*) FROM raw) AS bronze_rows,
             (SELECT count(*) FROM normal WHERE NOT ({VALID})) AS quarantined_rows,
             (SELECT count(*) - count(DISTINCT order_id) FROM normal WHERE {VALID}) AS dedup_removed,
             (SELECT count(*) FROM silver) AS silver_rows, (SELECT count(*) FROM fact) AS fact_rows,
             (SELECT count(*) FROM dim_customer) AS customers, (SELECT count(*) FROM dim_product) AS products,
             (SELECT count(*) FROM dim_category) AS categories"""
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "events.parquet")
    views.raw_events(spark, sf_dir).write.parquet(path)
    done = run(spark, path, scratch_path(spark, "lake"), reports=False)
    names = ["bronze_rows", "quarantined_rows", "dedup_removed", "silver_rows"]
    stored = {"fact_rows": "fact_orders", "customers": "dim_customer", "products": "dim_product", "categories": "dim_category"}
    counts = [getattr(done, n) for n in names] + [done.tables[t].count() for t in stored.values()]
    return spark.createDataFrame([tuple(counts)], ", ".join(f"{n} bigint" for n in [*names, *stored]))


_TABLES = {
    "fact_orders": ("fact", "length(order_id) + quantity + category_sk"),
    "dim_customer": ("dim_customer", "length(customer_id)"),
    "dim_product": ("dim_product", "length(product_id) + length(category)"),
    "dim_category": ("dim_category", "category_sk * length(category)"),
    "dim_date": ("(SELECT DISTINCT order_date FROM fact)", "year(order_date) * 400 + month(order_date) * 31 + day(order_date)"),
    "dim_vendor": ("dim_customer", "length(customer_id)"),
}
_RESULTS = {
    "kpi_orders_per_customer": ("(SELECT customer_id, count(*) AS order_count FROM fact GROUP BY 1)", "length(customer_id) * order_count"),
    "kpi_quantity_by_category": ("(SELECT category, sum(quantity) AS units FROM fact GROUP BY 1)", "length(category) * units"),
    "kpi_peak_hour": ("(SELECT hour(order_ts) AS order_hour, count(*) AS orders FROM fact GROUP BY 1)", "(order_hour + 1) * orders"),
    "kpi_order_rank_per_customer": (
        "(SELECT customer_id, row_number() OVER (PARTITION BY customer_id ORDER BY order_ts) AS rn FROM fact)",
        "length(customer_id) * rn",
    ),
}


def _sums_sql(sources: dict[str, tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS name, count(*) AS n, CAST(sum({value}) AS BIGINT) AS checksum FROM {source} AS t"
        for name, (source, value) in sources.items()
    )


def _sums(frames: dict[str, DataFrame], sources: dict[str, tuple[str, str]]) -> DataFrame:
    """The rows of stored tables and a sum that doesn't depend on their order."""
    vendor = {"dim_vendor": "length(vendor_id)"}
    rows = [
        frames[name].agg(F.count("*").alias("n"), F.sum(F.expr(vendor.get(name, value))).cast("bigint").alias("checksum")).select(
            F.lit(name).alias("name"), "n", "checksum"
        )
        for name, (_, value) in sources.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def _stored_results(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The KPIs of a run, as their files hold them."""
    out = {}
    for name in _RESULTS:
        fact_sized = name in FACT_SIZED
        out[name] = spark.read.parquet(f"{root}/kpis/{name}") if fact_sized else spark.read.option("header", True).csv(f"{root}/kpis/{name}")
    return out


def _run_events(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, DataFrame]]:
    path, root = scratch_path(spark, "events.parquet"), scratch_path(spark, "lake")
    views.raw_events(spark, sf_dir).write.parquet(path)
    return root, run(spark, path, root).tables


@check("full_run_tables", events(_sums_sql(_TABLES)))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sums(_run_events(spark, sf_dir)[1], _TABLES)


@check("full_run_reports", events(_sums_sql(_RESULTS)))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _tables = _run_events(spark, sf_dir)
    return _sums(_stored_results(spark, root), _RESULTS)


@check("full_run_incremental", events(_sums_sql(_TABLES | _RESULTS)))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, the second with all rows again, come to what one run makes of them."""
    first, every, root = scratch_path(spark, "first.parquet"), scratch_path(spark, "every.parquet"), scratch_path(spark, "lake")
    raw = views.raw_events(spark, sf_dir)
    middle = raw.agg(F.date_trunc("day", F.percentile_approx("order_ts", 0.5)).alias("at"))
    early = raw.join(F.broadcast(middle), F.col("order_ts") < F.col("at"), "left_semi")
    early.write.parquet(first)
    raw.write.parquet(every)
    run(spark, first, root, reports=False)
    tables = run(spark, every, root, incremental=True).tables
    return _sums(tables | _stored_results(spark, root), _TABLES | _RESULTS)


@check("incremental_noop", orders(f"SELECT {SILVER_SQL} FROM existing", FIRST_SILVER))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = _first_silver(spark, sf_dir)
    return load(silver, silver)


@check("incremental_full_refresh", orders(f"SELECT {SILVER_SQL} FROM silver", SILVER))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(_first_silver(spark, sf_dir), _valid(spark, sf_dir), full_refresh=True)


@check("incremental_publish", events(f"SELECT {CANONICAL_SQL}, CAST(order_ts AS DATE) AS order_date FROM silver", SILVER))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the first half of the month, then all of them, in day folders."""
    silver = Versions(spark, scratch_path(spark, "silver"), high_water_column="updated_at")
    valid = valid_rows(normalize(views.raw_events(spark, sf_dir))).withColumn("order_date", F.to_date("order_ts"))
    silver.publish(latest_per_order(valid.where("updated_at < TIMESTAMP_NTZ '2024-01-15'")), "first")
    was = silver.state()
    merge_days(silver, was, newer_than(valid, was.high_water), "second")
    return silver.read()


@check("stored_table_vacuumed", events(f"SELECT {CANONICAL_SQL}, CAST(order_ts AS DATE) AS order_date FROM silver", SILVER))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events published in four lots, of which only the last state is kept."""
    table = Versions(spark, scratch_path(spark, "silver"), high_water_column="updated_at", checkpoint_every=2)
    every = latest_per_order(valid_rows(normalize(views.raw_events(spark, sf_dir)))).withColumn("order_date", F.to_date("order_ts"))
    every = materialize(every, "orders")
    table.publish(every, "lot0")
    for lot in range(1, 4):
        part = every.where(F.dayofmonth("order_date") % 4 == lot)
        table.publish(part, f"lot{lot}", [r.order_date for r in part.select("order_date").distinct().collect()])
    table.vacuum(keep=1)
    return table.read()


# (column, Spark type, kind) of Silver over the driver's tables
PROFILED = [
    ("order_id", "string", "text"),
    ("customer_id", "string", "text"),
    ("product_id", "string", "text"),
    ("order_ts", "timestamp_ntz", "time"),
    ("updated_at", "timestamp_ntz", "time"),
    ("category", "string", "text"),
    ("amount", "double", "number"),
    ("quantity", "bigint", "number"),
    ("supplier", "bigint", "number"),
]


def _outliers_sql(c: str) -> str:
    at = "(SELECT CAST({c} AS DOUBLE) AS v FROM (SELECT {c}, row_number() OVER (ORDER BY {c}) - 1 AS r FROM silver"
    at = at + " WHERE {c} IS NOT NULL) WHERE r = (SELECT floor((count({c}) - 1) * {q} + 0.5) FROM silver))"
    q1, q3 = at.format(c=c, q=0.25), at.format(c=c, q=0.75)
    return f"""(SELECT CASE WHEN count(s.{c}) < 4 OR max(b.v - a.v) = 0 THEN 0 ELSE
        count(CASE WHEN s.{c} < a.v - 1.5 * (b.v - a.v) OR s.{c} > b.v + 1.5 * (b.v - a.v) THEN 1 END) END
        FROM silver s, {q1} a, {q3} b)"""


def _top_sql(c: str) -> str:
    return (
        f"(SELECT {c} FROM silver WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} DESC LIMIT 1)"
    )


def _profile_sql(c: str, dtype: str, kind: str) -> str:
    ranged = kind != "text"
    return f"""SELECT '{c}' AS "column", '{dtype}' AS dtype,
        CAST(count(*) - count({c}) AS DOUBLE) / greatest(count(*), 1) AS null_rate,
        count(DISTINCT {c}) + CASE WHEN count(*) > count({c}) THEN 1 ELSE 0 END AS distinct_count,
        {_top_sql(c) if kind == "text" else "CAST(NULL AS VARCHAR)"} AS top_category,
        {f"CAST(min({c}) AS VARCHAR)" if ranged else "CAST(NULL AS VARCHAR)"} AS min_value,
        {f"CAST(max({c}) AS VARCHAR)" if ranged else "CAST(NULL AS VARCHAR)"} AS max_value,
        {_outliers_sql(c) if kind == "number" else "CAST(NULL AS BIGINT)"} AS outlier_count
        FROM silver"""


PROFILE_SQL = " UNION ALL ".join(_profile_sql(*line) for line in PROFILED)


@check("profile_columns", orders(PROFILE_SQL, SILVER))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile(views.stored_silver(spark, sf_dir), unique=["order_id"])


@check(
    "profile_summary",
    orders(f'SELECT "column", null_rate, distinct_count, outlier_count FROM ({PROFILE_SQL})', SILVER),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.summary(profile.profile(views.stored_silver(spark, sf_dir), unique=["order_id"]))


@check(
    "profile_top_category",
    orders(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", {_top_sql(c)} AS top_category""" for c, _, kind in PROFILED if kind == "text"
        ),
        SILVER,
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.top_values(views.silver(spark, sf_dir))


@check(
    "profile_outliers",
    orders(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", {_outliers_sql(c)} AS outlier_count"""
            for c, _, kind in PROFILED
            if kind == "number"
        ),
        SILVER,
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.outliers(views.silver(spark, sf_dir))


def _within_sql(c: str, kind: str) -> str:
    return f"""SELECT '{c}' AS "column", CAST(count(*) - count({c}) AS DOUBLE) / greatest(count(*), 1) AS null_rate,
        TRUE AS distinct_within, {"TRUE" if kind == "text" and c != "order_id" else "CAST(NULL AS BOOLEAN)"} AS top_within,
        {"TRUE" if kind == "number" else "CAST(NULL AS BOOLEAN)"} AS outliers_within FROM silver"""


@check("profile_approximate", orders(" UNION ALL ".join(_within_sql(c, kind) for c, _, kind in PROFILED), SILVER))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the estimates of a profile are within their bounds."""
    silver = views.stored_silver(spark, sf_dir)
    return profile.within_bounds(silver, profile.profile(silver, exact=False, skip_mode=["order_id"]))


@check(
    "top_k",
    orders(f"SELECT product_id, {REVENUE} AS revenue FROM fact GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 7"),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = views.fact(spark, sf_dir)
    revenue = fact.groupBy("product_id").agg(kpis._revenue().alias("revenue"))
    return top_k(revenue, "product_id", "revenue", 7)


@check("preview_limit", orders(f"SELECT {SILVER_SQL} FROM silver ORDER BY order_id LIMIT {PREVIEW_ROWS}", SILVER))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(views.silver(spark, sf_dir), ["order_id"])


@check(
    "publish_capped",
    orders(
        f"""SELECT customer_id, order_ts, gross_revenue, rn FROM (SELECT *,
             row_number() OVER (PARTITION BY customer_id ORDER BY gross_revenue DESC, order_id) AS rn FROM fact)
           ORDER BY customer_id, rn LIMIT {MAX_ROWS}"""
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, fact = scratch_path(spark, "extracts"), views.fact(spark, sf_dir)
    ranked = kpis.order_rank_per_customer(materialize(fact.select(*kpis.RANKED), "orders"))
    nulls = validation.null_rates(fact)
    publish_extracts({"kpi_order_rank_per_customer": ranked}, {"null_rates": nulls}, target, source=sf_dir)
    return spark.read.schema(ranked.schema).option("header", True).csv(f"{target}/kpis/kpi_order_rank_per_customer")


PACK = {
    "units_per_day": "SELECT CAST(order_date AS STRING) AS label, sum(quantity) AS value FROM fact_orders GROUP BY 1",
    "orders_per_customer": "SELECT customer_id AS label, count(*) AS value FROM fact_orders GROUP BY 1",
    "products_per_category": "SELECT category AS label, count(*) AS value FROM dim_product GROUP BY 1",
}


@check(
    "named_query_pack",
    orders(
        """SELECT 'units_per_day' AS query, CAST(order_date AS VARCHAR) AS label, CAST(sum(quantity) AS BIGINT) AS value
             FROM fact GROUP BY 2
           UNION ALL SELECT 'orders_per_customer', customer_id, count(*) FROM fact GROUP BY 2
           UNION ALL SELECT 'products_per_category', category, count(*) FROM dim_product GROUP BY 2"""
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = views.fact(spark, sf_dir)
    tables = {"fact_orders": fact, "dim_product": fact.select("product_id", "category").distinct()}
    named = [df.withColumn("query", F.lit(name)) for name, df in run_named_pack(spark, tables, PACK).items()]
    return named[0].unionByName(named[1]).unionByName(named[2])
