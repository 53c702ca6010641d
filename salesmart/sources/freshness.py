"""Source freshness (SRC-3/4, DQ-9): age of the newest ``loaded_at`` value per source.

One one-row aggregate per source (a max over one column — a pruned scan),
unioned into one lazy result: ``(source, table_name, max_loaded_at,
age_hours, warn_after_hours, error_after_hours, status)``.  An empty source
(no max) is an error.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.dates import as_of_ts
from salesmart.sources.specs import DEFAULT_ERROR_HOURS, DEFAULT_WARN_HOURS


@dataclass(frozen=True)
class Freshness:
    warn_hours: float | None = DEFAULT_WARN_HOURS
    error_hours: float | None = DEFAULT_ERROR_HOURS

    def override(self, warn_hours=None, error_hours=None) -> "Freshness":
        """A table-level rule on top of the source default (SRC-4)."""
        return Freshness(self.warn_hours if warn_hours is None else warn_hours,
                         self.error_hours if error_hours is None else error_hours)


def status_expr(age_hours, warn_hours, error_hours):
    age = age_hours
    st = F.when(age.isNull(), "error")
    if error_hours is not None:
        st = st.when(age > F.lit(float(error_hours)), "error")
    if warn_hours is not None:
        st = st.when(age > F.lit(float(warn_hours)), "warn")
    return st.otherwise("pass")


def freshness(tables: dict[str, tuple[str, DataFrame, str, Freshness]], as_of=None) -> DataFrame:
    """``tables``: table name → (source name, DataFrame, loaded_at column, rule)."""
    now = as_of_ts(as_of)
    parts = []
    for name, (source, df, loaded_at, rule) in tables.items():
        newest = F.max(F.col(loaded_at).cast("timestamp_ntz"))
        one = df.agg(newest.alias("max_loaded_at"))
        age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), now).cast("double") / 3600.0
        parts.append(one.select(
            F.lit(source).alias("source"), F.lit(name).alias("table_name"), "max_loaded_at",
            age.alias("age_hours"),
            F.lit(rule.warn_hours).cast("double").alias("warn_after_hours"),
            F.lit(rule.error_hours).cast("double").alias("error_after_hours"),
            status_expr(age, rule.warn_hours, rule.error_hours).alias("status")))
    return reduce(DataFrame.unionByName, parts)


# Which logical source each table belongs to.
SOURCE_OF = {
    "customer": "sales", "sales_order_header": "sales", "sales_order_detail": "sales",
    "product": "production", "product_subcategory": "production", "product_category": "production",
    "person": "person",
}

# The guide's override example — default 24/48 h, customer 12/24 h, header 6/12 h.
GUIDE_DEFAULT = Freshness(24, 48)
GUIDE_OVERRIDES = {"customer": (12, 24), "sales_order_header": (6, 12)}


def freshness_rules(sources: dict[str, DataFrame], rule: Freshness) -> dict:
    """The same rule for every source."""
    return {n: (SOURCE_OF[n], df, "ModifiedDate", rule) for n, df in sources.items()}


def declared_freshness(sources: dict[str, DataFrame]) -> dict:
    """All seven sources under the declared rule (warn 12 h, error 24 h)."""
    return freshness_rules(sources, Freshness())


def spec_freshness(specs: dict, sources: dict[str, DataFrame]) -> dict:
    """Rules from the source specs (SRC-4): a spec's thresholds are its table's override of the default."""
    return {n: (s.source, sources[n], s.loaded_at, Freshness(s.warn_hours, s.error_hours))
            for n, s in specs.items() if s.loaded_at and n in sources}


def guide_freshness(sources: dict[str, DataFrame]) -> dict:
    out = {}
    for n, df in sources.items():
        rule = GUIDE_DEFAULT.override(*GUIDE_OVERRIDES[n]) if n in GUIDE_OVERRIDES else GUIDE_DEFAULT
        out[n] = (SOURCE_OF[n], df, "ModifiedDate", rule)
    return out
