"""Column expressions shared by the operators. All are built-in Spark SQL
functions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "week_start", "zero_if_null", "null_if_zero", "safe_div", "clamp0",
    "need_fraction", "is_true", "is_false_or_null", "fc_code", "prefix",
    "supplier_vendor", "date_from_parts", "round_half_up",
]


def week_start(c: Column | str) -> Column:
    """Monday of the week (date), like date_trunc('week', d)::date."""
    return F.date_trunc("week", F.col(c) if isinstance(c, str) else c).cast("date")


def zero_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def null_if_zero(c: Column) -> Column:
    return F.nullif(c, F.lit(0))


def safe_div(n: Column, d: Column) -> Column:
    """n / d with null for a zero or null divisor (never an error, never inf)."""
    return F.try_divide(n, null_if_zero(d))


def clamp0(c: Column) -> Column:
    """greatest(0, c); a null c gives 0 (greatest skips nulls)."""
    return F.greatest(F.lit(0), c)


def need_fraction(need_left: Column, qty: Column) -> Column:
    """Share of a proposal that is still needed after the running regional total:
    1 while need is left, the covering part when the order crosses zero, else 0
    (null need or null quantity give 0)."""
    return (
        F.when(need_left >= 0, F.lit(1.0))
        .when(qty >= -need_left, F.try_divide(qty + need_left, qty))
        .otherwise(F.lit(0.0))
    )


def is_true(c: Column) -> Column:
    """SQL `c is true`: null-safe."""
    return F.coalesce(c, F.lit(False))


def is_false_or_null(c: Column) -> Column:
    """SQL `coalesce(c, false) is false`."""
    return ~F.coalesce(c, F.lit(False))


def fc_code(key: Column) -> Column:
    return F.concat(F.lit("F"), F.lpad(key.cast("string"), 3, "0"))


def prefix(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def supplier_vendor(supplier: Column) -> Column:
    """Vendor number = part of the supplier code before the first '-'."""
    return F.split_part(supplier, F.lit("-"), F.lit(1))


def date_from_parts(year: Column, month: Column, day: Column) -> Column:
    """Date from unpadded text parts; unparsable parts give null."""
    return F.try_to_date(F.concat_ws("-", year, month, day), "y-M-d")


def round_half_up(c: Column, scale: int) -> Column:
    return F.round(c, scale)
