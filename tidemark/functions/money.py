"""Sums of money that do not depend on the order of the rows.

A double sum changes in its last digits with partitioning, and casting each row
to DECIMAL costs over ten times a double sum. Here each amount becomes a whole
number of millionths, whose high and low bits are summed as BIGINTs; both sums
stay exact, in codegen and in partial aggregation, for up to 2^38 rows a group (beyond,
the ANSI sum raises an error). What an amount has below a millionth is added as a double
where it exceeds the noise of the amount itself, so finely divided amounts keep their
sums. Amounts from LARGEST on, and NaN or infinite ones, are added as doubles; sums that
hold these or fine amounts may differ in the last digits by the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

SCALE = 1_000_000
LOW_BITS = 25
LARGEST = 1e9
NOISE = 2.0**-50

_PARTS = ("hi", "lo", "rest")


def _split(c: Column) -> dict[str, Column]:
    ordinary = F.abs(c) < LARGEST
    units = F.rint(c * F.lit(float(SCALE))).cast("bigint")
    below = c - units / F.lit(float(SCALE))
    fine = F.abs(below) > F.abs(c) * F.lit(NOISE)
    return {
        "hi": F.when(ordinary, F.shiftright(units, LOW_BITS)),
        "lo": F.when(ordinary, units.bitwiseAND(F.lit((1 << LOW_BITS) - 1))),
        "rest": F.when(~ordinary, c).when(fine, below),
    }


def _join(hi: Column, lo: Column, rest: Column) -> Column:
    whole = hi.cast("decimal(20,0)") * F.lit(1 << LOW_BITS).cast("decimal(8,0)") + lo.cast("decimal(20,0)")
    exact = (whole * F.lit("0.000001").cast("decimal(6,6)")).cast("double")
    return F.when(rest.isNull(), exact).otherwise(F.coalesce(exact, F.lit(0.0)) + rest)


def exact_sum(c: Column) -> Column:
    """SUM(c) as a double; null when there is nothing to add."""
    return _join(*(F.sum(part) for part in _split(c).values()))


def exact_avg(c: Column) -> Column:
    """AVG(c) as a double; null when there is nothing to average."""
    return exact_sum(c) / F.nullif(F.count(c), F.lit(0))


def partial_sums(c: Column, name: str) -> list[Column]:
    """Aggregates to keep when the sum goes on: resum() adds them up, total() reads them."""
    return [F.sum(part).alias(f"{name}__{key}") for key, part in _split(c).items()]


def fine_rows(c: Column) -> Column:
    """How many amounts add to the double beside the whole millionths; where none does, sums may be subtracted."""
    return F.count(_split(c)["rest"])


def resum(name: str) -> list[Column]:
    return [F.sum(f"{name}__{key}").alias(f"{name}__{key}") for key in _PARTS]


def total(name: str) -> Column:
    return _join(*(F.col(f"{name}__{key}") for key in _PARTS))


def running_total(name: str, window: WindowSpec) -> Column:
    return _join(*(F.sum(f"{name}__{key}").over(window) for key in _PARTS))
