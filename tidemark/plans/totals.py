"""Totals of the orders that a batch brings up to date from the days it changed.

Each kind of totals is kept twice. Its parts hold one row per day and group and are replaced
day by day, as Silver is. Its totals hold one row per group over all days. A batch
subtracts from the totals what its days held before and adds what they hold now, so only
the changed days of Silver and of the parts are read; a group whose count of orders comes to
nothing is gone, which is how dimensions lose members. Counts and whole millionths of money
are integers, so the totals equal those of a full run to the last bit. What amounts hold beside
whole millionths (see `money`) is a double, which subtraction would spoil: for groups that a
change of such amounts touches, that part alone is added up again from the parts of all days.

Orders are valid rows of Silver, so their amounts are not null; a null category is a group.
Without orders there are no groups. A hot group is one row per day and task before any shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.money import fine_rows, partial_sums, resum, total
from tidemark.functions.time import month_of
from tidemark.operators.star import measures
from tidemark.session import materialize
from tidemark.sinks.files import write_parquet
from tidemark.sinks.versions import DAY, Versions

REVENUE = "revenue"
REST = f"{REVENUE}__rest"
_COUNTS = ["orders", "units", "odd", f"{REVENUE}__hi", f"{REVENUE}__lo"]


@dataclass(frozen=True)
class Kind:
    """What the parts of a day are grouped by, and the totals' groups in terms of the parts."""

    per_day: tuple[str, ...]
    groups: dict[str, Column | str]

    def columns(self) -> list[Column]:
        return [(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in self.groups.items()]


def kinds() -> dict[str, Kind]:
    return {
        "hours": Kind(("order_hour",), {DAY: DAY, "order_hour": "order_hour"}),
        "customers": Kind(("customer_id",), {"customer_id": "customer_id", "order_month": month_of(F.col(DAY))}),
        "products": Kind(("product_id", "category"), {"product_id": "product_id", "category": "category"}),
    }


def parts_of(orders: DataFrame, kind: Kind) -> DataFrame:
    """One row per day and group of Silver's orders."""
    rows = measures(orders).withColumn("order_hour", F.hour("order_ts").cast("bigint"))
    sums = rows.groupBy(DAY, *kind.per_day).agg(
        F.count("*").alias("orders"),
        F.sum("quantity").alias("units"),
        *partial_sums(F.col("gross_revenue"), REVENUE),
        fine_rows(F.col("gross_revenue")).alias("odd"),
    )
    return sums.select(DAY, *kind.per_day, *_COUNTS[:3], *[F.coalesce(c, F.lit(0)).alias(c) for c in _COUNTS[3:]], REST)


def totals_of(parts: DataFrame, kind: Kind) -> DataFrame:
    return parts.groupBy(*kind.columns()).agg(*_summed())


def _summed() -> list[Column]:
    return [F.sum(c).alias(c) for c in [*_COUNTS, REST]]


def after_change(before: DataFrame, was: DataFrame, now: DataFrame, every: DataFrame, kind: Kind) -> DataFrame:
    """The totals once the parts `was` of the changed days are replaced by `now`.

    `every` holds the parts of all days after the change. It is read only for groups where a
    change touches amounts that aren't whole millionths.
    """
    signed = [
        parts.select(*kind.columns(), *[(F.col(c) * F.lit(sign)).alias(c) for c in _COUNTS], F.col("odd").alias("touched"))
        for parts, sign in ((was, -1), (now, 1))
    ]
    change = reduce(DataFrame.unionByName, signed).groupBy(*kind.groups)
    change = materialize(change.agg(*[F.sum(c).alias(c) for c in _COUNTS], F.sum("touched").alias("touched")), "change")
    spoilt = change.where("touched > 0").select(*kind.groups)
    held = before
    if not spoilt.isEmpty():
        again = every.select(*kind.columns(), REST).alias("e").join(spoilt.alias("s"), _same(kind, "e", "s"), "left_semi")
        again = again.groupBy(*kind.groups).agg(F.sum(REST).alias(REST)).withColumns({c: F.lit(0).cast("bigint") for c in _COUNTS})
        kept = before.alias("b").join(
            spoilt.withColumn("_spoilt", F.lit(True)).alias("s"), _same(kind, "b", "s"), "left"
        )
        kept = kept.select(
            *[F.col(f"b.{c}") for c in [*kind.groups, *_COUNTS]],
            F.when(F.col("s._spoilt").isNull(), F.col(f"b.{REST}")).alias(REST),
        )
        held = kept.unionByName(again)
    moved = change.select(*kind.groups, *_COUNTS, F.lit(None).cast("double").alias(REST))
    return held.select(*kind.groups, *_COUNTS, REST).unionByName(moved).groupBy(*kind.groups).agg(*_summed()).where("orders > 0")


def _same(kind: Kind, a: str, b: str) -> Column:
    return reduce(Column.__and__, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in kind.groups])


def totals_path(root: str, name: str, version: str) -> str:
    return f"{root}/totals/{name}/version={version}"


def stored_totals(spark: SparkSession, root: str, version: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(totals_path(root, name, version)) for name in kinds()}


def refresh(
    orders: DataFrame,
    root: str,
    version: str,
    built_from: str | None,
    days: list | None,
    at_most: int,
    at_once: Callable[[list[Callable[[], None]]], None],
) -> dict[str, DataFrame]:
    """Bring the stored totals to a version of Silver, which orders reads.

    With days and the version that was built before, only those days of orders are read; a
    kind whose parts are of another version (a run died, or they were never built) is built anew.
    """
    made = kinds()
    at_once([partial(_refresh_kind, orders, root, version, built_from, days, at_most, n, k) for n, k in made.items()])
    return stored_totals(orders.sparkSession, root, version)


def _refresh_kind(
    orders: DataFrame, root: str, version: str, built_from: str | None, days: list | None, at_most: int, name: str, kind: Kind
) -> None:
    spark = orders.sparkSession
    parts = Versions(spark, f"{root}/parts/{name}", order_by=kind.per_day[0])
    was = parts.state()
    in_line = days is not None and built_from is not None and was.version == built_from
    changed = F.col(DAY).isin(days) if in_line else F.lit(True)
    rows = parts_of(orders.where(changed), kind)
    parts.publish(rows, version, days if in_line else None, at_most=at_most, before=was)
    written = parts.written_by(version, rows.schema)
    if in_line:
        before = spark.read.parquet(totals_path(root, name, built_from))
        result = after_change(before, parts.read(was).where(changed), written, parts.read(), kind)
    else:
        result = totals_of(written, kind)
    write_parquet(result, totals_path(root, name, version))


def by_day(hours: DataFrame) -> DataFrame:
    """As kpis.by_day gives from the fact."""
    return hours.groupBy(F.col(DAY).alias("order_day")).agg(*resum(REVENUE), F.sum("orders").alias("orders"))


def by_customer(customers: DataFrame) -> DataFrame:
    sums = customers.groupBy("customer_id").agg(*resum(REVENUE), F.sum("orders").alias("order_count"))
    return sums.select("customer_id", total(REVENUE).alias("total_revenue"), "order_count")


def by_category(products: DataFrame) -> DataFrame:
    sums = products.groupBy("category").agg(*resum(REVENUE), F.sum("units").alias("units"))
    return sums.select("category", total(REVENUE).alias("revenue"), "units")


def by_hour(hours: DataFrame) -> DataFrame:
    return hours.groupBy("order_hour").agg(F.sum("orders").alias("orders"))


def by_product(products: DataFrame) -> DataFrame:
    sums = products.groupBy("product_id").agg(*resum(REVENUE))
    return sums.select("product_id", total(REVENUE).alias("revenue"))


def active_months(customers: DataFrame) -> DataFrame:
    return customers.select("customer_id", F.col("order_month").alias("active_month"))


def shared_sums(totals: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """What the KPIs share, by the names kpi_suite takes them under."""
    return {
        "days": by_day(totals["hours"]),
        "customers": by_customer(totals["customers"]),
        "categories": by_category(totals["products"]),
        "hours": by_hour(totals["hours"]),
        "products": by_product(totals["products"]),
    }
