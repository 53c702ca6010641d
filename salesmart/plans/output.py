"""Output projection shared with the SQL oracle: plain, engine-neutral types.

Integers → bigint, decimals/floats → double, dates → 'yyyy-MM-dd' text,
timestamps → 'yyyy-MM-dd HH:mm:ss' text; strings (without collation) and booleans unchanged.
Decimal values convert exactly as long as their unscaled value is below 2^52,
which holds for every money column at the checked scale.  Ratios, which the
models keep with 18 decimals, and averages of them are rounded to 8 here, and
here only: engines differ in the last bit when such long decimals become doubles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.functions.text import plain


#: Averages of ratios; the ratios themselves are known by their scale.
RATIO_AVERAGES = {"avg_profit_margin_pct", "avg_discount_from_list_pct", "avg_discount_pct", "avg_margin_ratio"}


def _is_ratio(f: T.StructField) -> bool:
    return f.name in RATIO_AVERAGES or isinstance(f.dataType, T.DecimalType) and f.dataType.scale > 8


def comparable(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.DecimalType, T.FloatType, T.DoubleType)):
            c = (c.cast("decimal(38,8)") if _is_ratio(f) else c).cast("double")
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (T.TimestampNTZType, T.TimestampType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(t, T.StringType) and t.collation != "UTF8_BINARY":
            c = plain(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def kinds(df: DataFrame) -> str:
    """The oracle projection spec ("name:kind ...") matching ``comparable``."""
    out = []
    for f in df.schema.fields:
        t = f.dataType
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            k = "i"
        elif isinstance(t, (T.DecimalType, T.FloatType, T.DoubleType)):
            k = "r" if _is_ratio(f) else "d"
        elif isinstance(t, T.DateType):
            k = "dt"
        elif isinstance(t, (T.TimestampNTZType, T.TimestampType)):
            k = "ts"
        elif isinstance(t, T.BooleanType):
            k = "b"
        else:
            k = "s"
        out.append(f"{f.name}:{k}")
    return " ".join(out)
