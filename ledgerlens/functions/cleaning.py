"""Typing of untyped extract text, all JVM-side expressions.

Extract columns arrive as text. Typing uses ``try_cast`` so a bad value
becomes null instead of failing the job (ANSI mode would raise on ``cast``).
Dates are guarded by a shape test first: Spark accepts ``2026-03`` and
``2026`` as dates (first of the month / year), which would silently invent a
day; only ``yyyy-m-d`` shaped text is typed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_SHAPE = r"^\s*\d{4}-\d{1,2}-\d{1,2}"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """trim, and turn the empty string into null."""
    return F.nullif(F.trim(_c(c)), F.lit(""))


def norm_upper(c: Column | str) -> Column:
    return F.upper(F.trim(_c(c)))


def try_date(c: Column | str) -> Column:
    col = _c(c)
    return F.when(col.rlike(DATE_SHAPE), F.trim(col).try_cast("date"))


def try_date_sql(expr: str) -> str:
    """SQL-string form of :func:`try_date` for mapping declarations."""
    pattern = DATE_SHAPE.replace("\\", "\\\\")
    return (f"case when {expr} rlike '{pattern}' "
            f"then try_cast(trim({expr}) as date) end")


def try_money(c: Column | str) -> Column:
    return _c(c).try_cast("decimal(20,2)")


def try_rate(c: Column | str) -> Column:
    return _c(c).try_cast("decimal(9,4)")


def yn_flag(c: Column | str) -> Column:
    """'Y' -> true, anything else -> false, null stays null."""
    return _c(c) == F.lit("Y")
