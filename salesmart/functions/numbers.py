"""Numeric expressions with fixed, engine-independent semantics.

Conventions used throughout the models:

* money stays DECIMAL; sums are exact;
* a ratio of two decimals keeps 18 decimals (``ratio``), so that averaging ratios
  is an exact decimal sum;
* an average is ``double(exact sum) / count`` (``avg_double``);
* the average of an integer truncates, as in T-SQL (``int_avg``);
* percentages are doubles: ``double(num) / den * 100`` behind a zero guard.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RATIO_TYPE = "decimal(38,18)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num, den) -> Column:
    """``num / nullif(den, 0)`` of two money values, rounded half-up once, to 18 decimals (NULL when den = 0)."""
    den = _c(den)
    # of decimal(20,4) by decimal(19,4) the quotient has just these 18 decimals
    return (_c(num).cast("decimal(20,4)") / F.when(den != 0, den.cast("decimal(19,4)"))).cast(RATIO_TYPE)


def div_money(num, den) -> Column:
    """Decimal division kept at scale 6 (half-up); NULL when den = 0."""
    den = _c(den)
    return (_c(num) / F.when(den != 0, den)).cast("decimal(38,6)")


def avg_double(c) -> Column:
    """Aggregate: double(sum(c)) / count(c); NULL for no non-null input."""
    c = _c(c)
    return F.sum(c).cast("double") / F.count(c)


def int_div(a, b) -> Column:
    """Integer division truncating toward zero (T-SQL int / int, Spark ``div``)."""
    a, b = _c(a).cast("long"), _c(b).cast("long")
    return F.call_function("div", a, F.when(b != 0, b))


def int_avg(c) -> Column:
    """Aggregate: integer average that truncates (T-SQL ``avg`` of an int)."""
    c = _c(c)
    return int_div(F.sum(c), F.count(c))


def pct(num, den) -> Column:
    """``double(num) / den * 100`` when den > 0, else 0."""
    den = _c(den)
    return F.when(den > 0, _c(num).cast("double") / den * 100).otherwise(F.lit(0.0))


def per(num, den) -> Column:
    """``double(num) / den`` when den > 0, else 0 (velocity-type ratios)."""
    den = _c(den)
    return F.when(den > 0, _c(num).cast("double") / den).otherwise(F.lit(0.0))


def cents_to_dollars(c, scale: int = 2) -> Column:
    """MAC-1: a reusable column macro — integer cents as a fixed-point dollar amount."""
    return (_c(c).cast("decimal(38,0)") / 100).cast(f"decimal(16,{scale})")
