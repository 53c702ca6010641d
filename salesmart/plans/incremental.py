"""Partition-pruned refresh of the daily sales summary.

The build stores ``int_product_sales`` partitioned by ``order_year``.  A day's
row of ``fct_sales_summary`` depends only on that day's lines, and its month
context only on days of the same month, so the mart can be refreshed for
recent years alone: the filter on ``order_year`` prunes the scan to those
partitions (``PartitionFilters`` in the plan), and older rows are carried
over from the previous version unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.plans import marts

PARTITION_COLUMN = "order_year"


def with_partition_column(product_sales: DataFrame) -> DataFrame:
    return product_sales.withColumn(PARTITION_COLUMN, F.year("order_date"))


def refresh_sales_summary(previous: DataFrame, product_sales: DataFrame, since_year: int) -> DataFrame:
    """Rows of ``previous`` before ``since_year`` ∪ the summary recomputed from ``since_year`` on."""
    recent = product_sales.filter(F.col(PARTITION_COLUMN) >= since_year)
    kept = previous.filter(F.col("order_year") < since_year)
    return kept.unionByName(marts.fct_sales_summary(recent))
