"""Incremental refresh of MOD-6 and MOD-8 from stored states by order year.

Sums, counts and extremes of a year's lines are kept by customer and by
product, and so are the years' counts of distinct orders and dates: an order
and a date lie in one year.  Customers of a product and products of a customer
come again in other years; they are kept as distinct rows of
(key, year, value), which are counted once over all years.  A row costs what
its value does; bitmaps cost up to 4 KB a value where keys are spread thinly.

A refresh computes the states of the changed years only.  They are published as
parts beside the other years' parts, which are named again unread; the marts
are then the merged states.  The result equals a rebuild, also when orders of
these years were changed or taken away.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions import business as B
from salesmart.functions.text import full_name
from salesmart.operators import publish
from salesmart.plans import marts

YEAR = "order_year"


#: The columns of MOD-4 and MOD-5 that the states are computed from (``_earlier`` tables and refreshes need no others).
ORDER_COLUMNS = ["customer_id", "sales_order_id", "order_date", "total_line_total", "total_gross_line_total",
                 "total_discount_amount", "total_order_quantity", "order_channel", "order_status_name",
                 "shipping_performance", "has_discount_flag"]
SALES_COLUMNS = ["product_id", "customer_id", "sales_order_id", "order_date", "order_quantity", "line_total",
                 "gross_line_total", "sale_unit_price", "discount_from_list_pct", "discount_amount", "line_profit",
                 "net_line_profit", "unit_profit", "profit_margin_pct", "order_channel", "order_status_name"]


def _pairs(lines: DataFrame, key: str, value: str) -> DataFrame:
    """(key, order_year, value): the distinct values of a key in a year, a row each; a hot key is spread by value."""
    return lines.where(F.col(value).isNotNull()).select(key, YEAR, value).distinct()


def _distinct(pairs: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """(key, name): distinct values over all years; the first exchange is by (key, value), so a hot key is spread."""
    return pairs.groupBy(key).agg(F.countDistinct(value).alias(name))


def states(customer_orders: DataFrame, product_sales: DataFrame) -> dict[str, DataFrame]:
    """The states of all years in the two intermediate tables (MOD-4, MOD-5)."""
    orders = customer_orders.withColumn(YEAR, F.year("order_date"))
    lines = product_sales.withColumn(YEAR, F.year("order_date"))
    return {
        "state_customer_orders": orders.groupBy("customer_id", YEAR).agg(
            F.countDistinct("order_date").alias("unique_order_dates"), *marts.parts(marts.CUSTOMER_MEASURES)),
        "state_customer_lines": lines.groupBy("customer_id", YEAR).agg(*marts.parts(marts.CUSTOMER_LINE_MEASURES)),
        "state_customer_products": _pairs(lines, "customer_id", "product_id"),
        "state_product": lines.groupBy("product_id", YEAR).agg(*marts.parts(marts.PRODUCT_MEASURES)),
        "state_product_counts": lines.select("product_id", YEAR, "sales_order_id", "order_date").groupBy("product_id", YEAR).agg(
            F.countDistinct("sales_order_id").alias("total_orders"), F.countDistinct("order_date").alias("days_sold")),
        "state_product_customers": _pairs(lines, "product_id", "customer_id"),
    }


def store(spark: SparkSession, root: str, run: str, found: dict[str, DataFrame], years: list[int] | None = None) -> None:
    """Publish states as one run; with ``years`` only these years' parts are replaced, the others stay as they are.

    The states given must hold rows of the replaced years only.
    """
    live = publish.state_of(spark, root)
    kept = {t: [p for p in live.get(t, []) if years is not None and p.name.partition("/")[2] not in map(str, years)]
            for t in found}
    for table, rows in found.items():
        publish.write_table(rows, publish.folder(root, table, run), [YEAR])
    publish.swap(spark, root, run, {t: rows.schema for t, rows in found.items()}, {t: YEAR for t in found}, kept)


def customer_metrics(state: dict[str, DataFrame], customers: DataFrame, as_of=None) -> DataFrame:
    """MOD-6 from the states and the customers as they are now (MOD-1)."""
    orders = state["state_customer_orders"].groupBy("customer_id").agg(
        F.sum("unique_order_dates").alias("unique_order_dates"), *marts.merged(marts.CUSTOMER_MEASURES))
    attributes = customers.select(*[c for c in marts.CUSTOMER_KEYS if c != "full_name"],
                                  full_name("first_name", "middle_name", "last_name").alias("full_name"))
    lines = (state["state_customer_lines"].groupBy("customer_id").agg(*marts.merged(marts.CUSTOMER_LINE_MEASURES))
             .join(_distinct(state["state_customer_products"], "customer_id", "product_id", "unique_products_purchased"), "customer_id", "left"))
    return marts.customer_metrics(orders.join(attributes, "customer_id"), lines, as_of)


def product_performance(state: dict[str, DataFrame], products: DataFrame, as_of=None) -> DataFrame:
    """MOD-8 from the states and the products as they are now (MOD-2)."""
    counts = state["state_product_counts"].groupBy("product_id").agg(
        F.sum("total_orders").alias("total_orders"), F.sum("days_sold").alias("days_sold"))
    status = products.select("product_id", B.lifecycle_status("discontinued_date", "sell_end_date", "sell_start_date", as_of)
                             .alias("product_lifecycle_status"))
    sales = (state["state_product"].groupBy("product_id").agg(*marts.merged(marts.PRODUCT_MEASURES))
             .join(counts, "product_id", "left")
             .join(_distinct(state["state_product_customers"], "product_id", "customer_id", "unique_customers"), "product_id", "left")
             .join(status, "product_id"))
    return marts.product_performance(sales, products)


def refresh(spark: SparkSession, root: str, run: str, customer_orders: DataFrame, product_sales: DataFrame,
            years: list[int]) -> dict[str, DataFrame]:
    """Replace the states of ``years`` by those of the given tables, and return all states.

    The tables may be whole: only rows of these years are read, by a filter
    that prunes year partitions where they are stored that way.
    """
    here = F.year("order_date").isin(years)

    def some(df: DataFrame) -> DataFrame:
        return (df.where(F.col(YEAR).isin(years)).drop(YEAR) if YEAR in df.columns else df).where(here)

    store(spark, root, run, states(some(customer_orders), some(product_sales)), years)
    return publish.snapshot(spark, root)
