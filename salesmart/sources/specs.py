"""Source specifications (SRC-1, SRC-4): logical name → location + freshness rule."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

# Freshness thresholds in hours (warn, error) declared for every source.
DEFAULT_WARN_HOURS = 12
DEFAULT_ERROR_HOURS = 24


@dataclass(frozen=True)
class SourceSpec:
    """One source table: where it lives and how fresh it must be."""

    source: str                      # logical source (database.schema)
    name: str                        # table name
    path: str | None = None          # parquet/ORC/CSV path, or None for a catalog table
    fmt: str = "parquet"
    loaded_at: str | None = "ModifiedDate"
    warn_hours: float | None = DEFAULT_WARN_HOURS
    error_hours: float | None = DEFAULT_ERROR_HOURS
    options: dict = field(default_factory=dict)

    def with_override(self, **kw) -> "SourceSpec":
        """Per-table override of the source default (SRC-4)."""
        return replace(self, **kw)

    def read(self, spark: SparkSession) -> DataFrame:
        """parquet/orc/csv/json by path, JDBC by options (``dbtable``/``query``), else a catalog table."""
        reader = spark.read.format(self.fmt).options(**self.options)
        if self.fmt == "jdbc":
            return reader.load()
        if self.path is None:
            return spark.table(f"{self.source}.{self.name}")
        return reader.load(self.path)


# The seven logical sources the models read (three source groups).
SOURCE_TABLES = (
    ("sales", "customer"),
    ("sales", "sales_order_header"),
    ("sales", "sales_order_detail"),
    ("production", "product"),
    ("production", "product_subcategory"),
    ("production", "product_category"),
    ("person", "person"),
)


def default_specs(root: str, fmt: str = "parquet") -> dict[str, SourceSpec]:
    """Specs for sources stored as ``<root>/<name>.<fmt>`` folders or files."""
    return {name: SourceSpec(src, name, f"{root}/{name}.{fmt}", fmt) for src, name in SOURCE_TABLES}


def load_sources(spark: SparkSession, specs: dict[str, SourceSpec]) -> dict[str, DataFrame]:
    """Read every source of ``specs`` (lazy DataFrames keyed by table name)."""
    return {name: spec.read(spark) for name, spec in specs.items()}
