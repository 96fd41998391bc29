"""Averages and percentages that do not depend on how rows are partitioned.

Double sums change in the last digit with the order of addition, so a rounded average can
differ between two runs of one job. These aggregates add whole millionths as BIGINT, which is
exact for sensor values of up to six decimals, keeps the hot path in hash aggregation, and
leaves a single decimal step per group.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MILLION = 1_000_000


def millionths(value: Column) -> Column:
    return F.rint(value * MILLION).cast("bigint")


def _whole(value: Column) -> Column:
    return value.cast("decimal(38,0)")


def round_ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """numerator / denominator rounded half away from zero; both sides whole numbers."""
    scale = 10**digits
    bottom = _whole(F.nullif(denominator, F.lit(0)))
    top = F.abs(_whole(numerator)) * F.lit(2 * scale) + bottom
    steps = F.call_function("div", top, bottom * F.lit(2))
    whole = F.signum(numerator).cast("bigint") * steps
    return whole.cast("double") / F.lit(float(scale))


def rounded_mean(value: Column, digits: int) -> Column:
    """Aggregate: AVG(value) rounded to ``digits``; NULLs are skipped."""
    return round_ratio(F.sum(millionths(value)), F.count(value) * F.lit(MILLION), digits)


def stable_mean(value: Column) -> Column:
    """Aggregate: AVG(value) without rounding, identical for any partitioning."""
    return F.sum(millionths(value)).cast("double") / F.nullif(
        F.count(value).cast("double") * F.lit(float(MILLION)), F.lit(0.0)
    )


def percentage(part: Column, whole: Column, digits: int) -> Column:
    """100 * part / whole for whole-number counts, rounded to ``digits``."""
    return round_ratio(part * F.lit(100), whole, digits)


def plain_number(value: Column) -> Column:
    """Number as text without a trailing ``.0`` (22.0 -> '22', 22.5 -> '22.5')."""
    return F.regexp_replace(value.cast("string"), r"\.0$", "")
