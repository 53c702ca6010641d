"""Text expressions (STR-F1..F6, NUL-1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the placeholder the surrogate-key convention substitutes for NULL.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"


# Fixed value: compares as the source database's default does, case and trailing blanks ignored.
COLLATION = "UTF8_LCASE_RTRIM"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c, default: str | None = None) -> Column:
    """``trim(coalesce(c, default))``; plain ``trim(c)`` when no default."""
    c = _c(c)
    return F.trim(F.coalesce(c, F.lit(default)) if default is not None else c)


def clean_upper(c) -> Column:
    """``trim(upper(c))`` for codes and numbers."""
    return F.trim(F.upper(_c(c)))


def full_name(first, middle, last) -> Column:
    """First, optional middle, last: NULL parts count as '' (T-SQL ``concat``)."""
    middle = _c(middle)
    mid = F.when(middle.isNotNull() & (middle != ""), F.concat(F.lit(" "), F.trim(middle))).otherwise("")
    return F.concat_ws("", F.trim(F.coalesce(_c(first), F.lit(""))), mid, F.lit(" "),
                      F.trim(F.coalesce(_c(last), F.lit(""))))


def surrogate_key(*cols) -> Column:
    """md5 over '-'-joined string forms, NULL replaced by a fixed placeholder."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def varchar(c, length: int) -> Column:
    """``cast(c as varchar(n))``: Spark keeps no string length, so truncate explicitly."""
    return F.substring(_c(c).cast("string"), 1, length)


def collated(df: DataFrame, *columns: str, collation: str = COLLATION) -> DataFrame:
    """``df`` with a collation on text columns: grouping, joins, distinct counts and sets then compare by it."""
    return df.withColumns({c: F.collate(F.col(c), collation) for c in columns})


def is_collated(df: DataFrame, column: str) -> bool:
    t = df.schema[column].dataType
    return isinstance(t, T.StringType) and t.collation != "UTF8_BINARY"


def plain(c) -> Column:
    """The text without its collation, spelled as it is."""
    return F.collate(_c(c), "UTF8_BINARY")
