"""The whole job: input file to Bronze, Silver, Gold, KPIs, validations and profile."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import star
from tidemark.operators.adapt import CANONICAL_COLUMNS, adapt_to_canonical
from tidemark.operators.bronze import stamp
from tidemark.operators.expectations import require_columns
from tidemark.operators.incremental import changed_days, merge_latest, newer_than
from tidemark.operators.profile import profile, summary
from tidemark.operators.silver import latest_per_order, normalize, quarantined_rows, valid_rows
from tidemark.operators.sizes import fits_broadcast
from tidemark.plans import totals as order_totals
from tidemark.plans.cohort import retention_of
from tidemark.plans.kpis import kpi_suite
from tidemark.plans.validation import validation_suite
from tidemark.session import materialize, pin_utc
from tidemark.sinks.files import write_bronze, write_csv, write_parquet, write_quarantine
from tidemark.sinks.versions import State, Versions
from tidemark.sources.layers import register_views
from tidemark.sources.raw import read_raw, spread

# As large as the fact, so stored as Parquet and not as CSV.
FACT_SIZED = {"kpi_order_rank_per_customer"}

WRITES_AT_ONCE = 4


@dataclass(frozen=True)
class RunResult:
    run_id: str
    kind: str
    changed: bool
    bronze_rows: int
    quarantined_rows: int
    skipped_rows: int
    dedup_removed: int
    silver_rows: int
    tables: dict[str, DataFrame] = field(repr=False)


def run(
    spark: SparkSession,
    input_path: str,
    output_root: str,
    incremental: bool = False,
    full_refresh: bool = False,
    lateness: timedelta | None = None,
    exact_profile: bool = False,
    skip_mode: Sequence[str] = (),
    reports: bool = True,
    json_lines: bool | None = None,
    schema: T.StructType | None = None,
) -> RunResult:
    """Run the job and give the counts of the run and its stored tables.

    Each layer is stored before the next reads it, so no row is computed twice
    and a lost executor costs no more than its own tasks. An incremental run
    without new rows gives the stored tables and leaves the reports as they are.
    A schema spares JSON the pass that looks for field names; skip_mode names text
    columns whose most frequent value an estimated profile needn't find.
    """
    pin_utc(spark)
    ingested_at = datetime.now(timezone.utc)
    run_id = f"{ingested_at:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"

    canonical, kind = adapt_to_canonical(read_raw(spark, input_path, schema, json_lines), input_path)
    raw = spread(stamp(canonical, ingested_at))
    require_columns(raw, CANONICAL_COLUMNS)
    path = write_bronze(raw, f"{output_root}/bronze", ingested_at, run_id)
    bronze = spark.read.schema(raw.schema).parquet(path)

    rows = normalize(bronze)
    path = write_quarantine(quarantined_rows(rows), f"{output_root}/quarantine", run_id)
    bad = spark.read.schema(rows.schema).parquet(path)
    counts = {"bronze_rows": bronze.count(), "quarantined_rows": bad.count()}

    silver = Versions(spark, f"{output_root}/silver/orders", high_water_column="updated_at")
    was = silver.state()
    days, valid = None, valid_rows(rows).withColumn("order_date", F.to_date("order_ts"))
    taken = counts["bronze_rows"] - counts["quarantined_rows"]
    if incremental and not full_refresh and was.rows:
        new = newer_than(valid, was.high_water, lateness)
        all_valid, taken = taken, new.count()
        skipped, changed = all_valid - taken, taken > 0
        if changed:
            days = merge_days(silver, was, new, run_id)
    else:
        skipped, changed = 0, True
        silver.publish(latest_per_order(valid), run_id, at_most=taken)
    now = silver.state() if changed else was
    removed = (taken + (was.rows if days is not None else 0) - now.rows) if changed else 0

    orders = silver.read(now)
    stored = None if changed else _stored_gold(spark, f"{output_root}/gold", now)
    tables = stored or _gold(orders, f"{output_root}/gold", was.version, now, days)
    tables |= {"bronze_orders": bronze, "silver_orders": orders}
    register_views(tables)
    if reports and not stored:
        _report(tables, output_root, exact_profile, skip_mode)
    return RunResult(
        run_id, kind, changed, skipped_rows=skipped, dedup_removed=removed, silver_rows=now.rows, tables=tables, **counts
    )


def merge_days(silver: Versions, was: State, new: DataFrame, run_id: str) -> list:
    """Rewrite the days of Silver that the new rows touch; give those days."""
    existing = silver.read(was)
    incoming = materialize(latest_per_order(new), "incoming")
    days = [r.order_date for r in changed_days(existing, incoming).collect()]
    merged = merge_latest(existing.where(F.col("order_date").isin(days)), incoming)
    silver.publish(merged, run_id, days, at_most=was.rows + incoming.count())
    return days


def _same_rows(a: DataFrame, b: DataFrame) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def _stored_gold(spark: SparkSession, root: str, silver: State) -> dict[str, DataFrame] | None:
    """The stored star, if it was built from this Silver."""
    fact = Versions(spark, f"{root}/fact_orders")
    state = fact.state()
    if state.version != silver.version:
        return None
    try:
        stored = {name: spark.read.parquet(path) for name, path in _dimension_paths(root, state.version).items()}
        totals = order_totals.stored_totals(spark, root, state.version)
    except AnalysisException as error:  # stored before totals were kept
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return stored | _named(totals) | {"fact_orders": fact.read(state)}


def _named(totals: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {f"totals_{name}": df for name, df in totals.items()}


def _dimension_paths(root: str, version: str) -> dict[str, str]:
    """Where the dimensions built from this version of Silver lie."""
    return {name: f"{root}/{name}/version={version}" for name in star.DIMENSIONS}


def _gold(
    orders: DataFrame, root: str, silver_was: str | None, silver_now: State, days: list | None
) -> dict[str, DataFrame]:
    """Bring the star in line with Silver and give its stored tables.

    The fact carries the version of the Silver it was built from, and that names
    the folders of the dimensions and totals too: its commit switches all of them over, and
    readers of earlier ones are not disturbed. When Gold was in line before this run, only the
    changed days of Silver are read: the totals take the difference, the dimensions are the
    groups of the totals, and the fact's other days stay unless a category got another key.
    """
    spark = orders.sparkSession
    fact = Versions(spark, f"{root}/fact_orders")
    built_from = fact.state().version
    in_line = days is not None and built_from is not None and built_from == silver_was
    totals = order_totals.refresh(
        orders, root, silver_now.version, built_from if in_line else None, days, silver_now.rows, _at_once
    )
    if built_from == silver_now.version:  # only the totals were missing
        return _stored_gold(spark, root, silver_now)
    paths = _dimension_paths(root, silver_now.version)
    dimensions = {
        "dim_customer": star.dim_customer(totals["customers"]),
        "dim_product": star.dim_product(totals["products"]),
        "dim_category": star.dim_category(totals["products"]),
        "dim_date": star.dim_date(totals["hours"]),
    }
    _at_once([partial(write_parquet, df, paths[name]) for name, df in dimensions.items()])
    stored = {name: spark.read.schema(df.schema).parquet(paths[name]) for name, df in dimensions.items()}
    vendors = star.dim_vendor(stored["dim_customer"])
    write_parquet(vendors, paths["dim_vendor"])
    stored["dim_vendor"] = spark.read.schema(vendors.schema).parquet(paths["dim_vendor"])

    categories = stored["dim_category"]
    if in_line:
        before = _dimension_paths(root, built_from)["dim_category"]
        in_line = _same_rows(categories, spark.read.schema(categories.schema).parquet(before))
    part = days if in_line else None
    rows = orders if part is None else orders.where(F.col("order_date").isin(part))
    # with the categories broadcast the fact keeps the day folders of Silver and needs no shuffle
    small = fits_broadcast(categories, "category")
    rows = star.fact_orders(rows, F.broadcast(categories) if small else categories)
    fact.publish(rows, silver_now.version, part, at_most=silver_now.rows, in_place=small)
    return stored | _named(totals) | {"fact_orders": fact.read()}


def _report(tables: dict[str, DataFrame], root: str, exact_profile: bool, skip_mode: Sequence[str]) -> None:
    totals = {name: tables[f"totals_{name}"] for name in order_totals.kinds()}
    results = kpi_suite(tables, order_totals.shared_sums(totals))
    results["cohort_retention"] = retention_of(order_totals.active_months(totals["customers"]))
    writes = [
        partial(write_parquet if name in FACT_SIZED else write_csv, df, f"{root}/kpis/{name}")
        for name, df in results.items()
    ]
    writes += [partial(write_csv, df, f"{root}/validation/{name}") for name, df in validation_suite(tables).items()]
    profiled = materialize(profile(tables["silver_orders"], exact=exact_profile, skip_mode=skip_mode, unique=["order_id"]), "profile")
    writes += [
        partial(write_csv, profiled, f"{root}/reports/data_profile"),
        partial(write_csv, summary(profiled), f"{root}/reports/data_quality_summary"),
    ]
    _at_once(writes)


def _at_once(writes: list[Callable[[], None]]) -> None:
    """Start independent small writes together, so that one's last tasks do not hold up the next."""
    with ThreadPoolExecutor(WRITES_AT_ONCE) as pool:
        list(pool.map(lambda write: write(), writes))
