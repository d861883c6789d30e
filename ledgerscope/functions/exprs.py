"""Column expressions shared by the operators. All are built-in Spark
functions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import SUM_MONEY


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_div(num, den) -> Column:
    """num / den as DOUBLE, NULL when den is 0 or NULL (ANSI-safe NULLIF)."""
    den = c(den)
    return c(num).cast("double") / F.when(den != 0, den.cast("double"))


def rate(num, den, digits: int) -> Column:
    """ROUND(num / NULLIF(den, 0), digits)."""
    return F.round(safe_div(num, den), digits)


def pct(num, den, digits: int) -> Column:
    """ROUND(num / NULLIF(den, 0) * 100, digits)."""
    return F.round(safe_div(num, den) * 100, digits)


def count_if(cond) -> Column:
    """COUNT(*) FILTER (WHERE cond)."""
    return F.count(F.when(c(cond), F.lit(1)))


def sum_if(value, cond) -> Column:
    """SUM(value) FILTER (WHERE cond): NULL when no row qualifies."""
    return F.sum(F.when(c(cond), c(value)))


def money_sum(value) -> Column:
    return F.sum(c(value)).cast(SUM_MONEY)


def double_avg(value) -> Column:
    """Mean as SUM(x)::DOUBLE / COUNT(x): exact decimal sum, one division."""
    return F.sum(c(value)).cast("double") / F.count(c(value))


def flag(cond) -> Column:
    """CASE WHEN cond THEN 1 ELSE 0 END (NULL counts as false)."""
    return F.when(c(cond), F.lit(1)).otherwise(F.lit(0))


def normalize_type(col) -> Column:
    """UPPER(TRIM(type))."""
    return F.upper(F.trim(c(col)))


def account_type(ref) -> Column:
    """'M' for merchant refs (prefix M), else 'C'."""
    return F.when(c(ref).startswith("M"), F.lit("M")).otherwise(F.lit("C"))
