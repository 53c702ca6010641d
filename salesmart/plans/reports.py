"""Operator-level queries: one business rule or aggregate pattern each (§2.4-2.7).

Each function takes the model dict (``plans.models``) and returns a DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions import business as B
from salesmart.functions.numbers import avg_double, div_money, int_avg


def order_status_mix(m) -> DataFrame:
    """BUS-1: orders and revenue per decoded status."""
    return m["int_customer_orders"].groupBy("order_status_code", "order_status_name").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("total_line_total").alias("revenue"))


def channel_split(m) -> DataFrame:
    """BUS-2: orders, customers and revenue per channel."""
    return m["int_customer_orders"].groupBy("order_channel").agg(
        F.count(F.lit(1)).alias("orders"), F.countDistinct("customer_id").alias("customers"),
        F.sum("total_line_total").alias("revenue"))


def shipping_performance_mix(m) -> DataFrame:
    """BUS-3: orders per shipping class with the (double) average days to ship."""
    return m["int_customer_orders"].groupBy("shipping_performance").agg(
        F.count(F.lit(1)).alias("orders"), avg_double("days_to_ship").alias("avg_days_to_ship"),
        F.min("days_until_due").alias("min_days_until_due"))


def margin_by_product(m) -> DataFrame:
    """BUS-4..7: gross, discount, profit and net profit per product."""
    return m["int_product_sales"].groupBy("product_id").agg(
        F.sum("gross_line_total").alias("gross"), F.sum("discount_amount").alias("discount"),
        F.sum("line_profit").alias("profit"), F.sum("net_line_profit").alias("net_profit"),
        avg_double("profit_margin_pct").alias("avg_margin_ratio"),
        F.min("unit_profit").alias("min_unit_profit"))


def discount_profile(m) -> DataFrame:
    """BUS-5/22: lines per discount rate; recomputed vs source line totals."""
    so = m["stg_sales_orders"]
    return so.groupBy("unit_price_discount").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(B.discount_flag("unit_price_discount")).alias("discounted_lines"),
        F.sum("line_total").alias("line_total"), F.sum("calculated_line_total").alias("calculated_line_total"),
        F.sum(F.when(F.col("line_total") != F.col("calculated_line_total"), 1).otherwise(0)).alias("mismatches"))


def lifecycle_counts(m, as_of=None) -> DataFrame:
    """BUS-8: products per lifecycle status."""
    p = m["stg_products"]
    status = B.lifecycle_status("discontinued_date", "sell_end_date", "sell_start_date", as_of)
    return p.groupBy(status.alias("product_lifecycle_status")).agg(F.count(F.lit(1)).alias("products"))


def rfm_scores(m) -> DataFrame:
    """BUS-9..12: customers per score combination."""
    return m["dim_customer_metrics"].groupBy("recency_score", "frequency_score", "monetary_score",
                                              "rfm_score").agg(F.count(F.lit(1)).alias("customers"))


def customer_segments(m) -> DataFrame:
    """BUS-13/14: customers per segment and channel preference."""
    return m["dim_customer_metrics"].groupBy("customer_segment", "channel_preference").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("total_lifetime_revenue").alias("revenue"))


def performance_categories(m) -> DataFrame:
    """BUS-19: products and revenue per performance band."""
    return m["fct_product_performance"].groupBy("performance_category").agg(
        F.count(F.lit(1)).alias("products"), F.sum("total_revenue").alias("revenue"))


def monthly_sales(m) -> DataFrame:
    """AGG-4: the daily summary re-aggregated by month (sums of daily values)."""
    d = m["fct_sales_summary"]
    return d.groupBy("order_year", "order_month", "order_month_name").agg(
        F.countDistinct("order_date").alias("days_with_orders"),
        *[F.sum(c).alias(c) for c in (
            "total_orders", "unique_customers", "unique_products_sold", "total_quantity_sold",
            "total_revenue", "total_gross_revenue", "total_discount_amount", "total_profit",
            "total_net_profit", "online_orders", "offline_orders", "online_revenue", "offline_revenue",
            "shipped_orders", "cancelled_orders", "orders_with_discount", "total_discounts_applied")],
        avg_double("avg_order_value").alias("avg_order_value"))


def daily_product_grain(m) -> DataFrame:
    """AGG-19: quantity and amount per (date, product)."""
    return m["int_product_sales"].groupBy("order_date", "product_id").agg(
        F.sum("order_quantity").alias("quantity"), F.sum("line_total").alias("amount"))


def month_share(m) -> DataFrame:
    """BUS-20: each day's share of its month's revenue."""
    return m["fct_sales_summary"].select("order_date", "total_revenue", "monthly_total_revenue",
                                         "daily_revenue_pct_of_month")


def integer_avg_quantity(m) -> DataFrame:
    """AGG-8: truncating integer average of line quantities per product."""
    return m["int_product_sales"].groupBy("product_id").agg(
        int_avg("order_quantity").alias("avg_quantity"), F.sum("order_quantity").alias("quantity"),
        F.count("order_quantity").alias("lines"))


def conditional_distinct(m) -> DataFrame:
    """AGG-10/14: conditional distinct counts per day, and revenue per distinct order."""
    ps, order = m["int_product_sales"], F.col("sales_order_id")
    return ps.groupBy("order_date").agg(
        F.countDistinct(F.when(F.col("order_channel") == "Online", order)).alias("online_orders"),
        F.countDistinct(F.when(F.col("order_status_name") == "Shipped", order)).alias("shipped_orders"),
        F.countDistinct(F.when(F.col("unit_price_discount") > 0, order)).alias("orders_with_discount"),
        div_money(F.sum("line_total"), F.countDistinct(order)).alias("avg_order_value"))


def latest_orders_top100(m) -> DataFrame:
    """SRT-1: the 100 most recently modified orders (ties broken by order id)."""
    so = m["stg_sales_orders"]
    orders = so.groupBy("sales_order_id").agg(F.max("header_modified_date").alias("header_modified_date"),
                                              F.max("customer_id").alias("customer_id"))
    return orders.orderBy(F.col("header_modified_date").desc(), F.col("sales_order_id").desc()).limit(100)


REPORTS = {
    "order_status_mix": order_status_mix,
    "channel_split": channel_split,
    "shipping_performance_mix": shipping_performance_mix,
    "margin_by_product": margin_by_product,
    "discount_profile": discount_profile,
    "lifecycle_counts": lifecycle_counts,
    "rfm_scores": rfm_scores,
    "customer_segments": customer_segments,
    "performance_categories": performance_categories,
    "monthly_sales": monthly_sales,
    "daily_product_grain": daily_product_grain,
    "month_share": month_share,
    "integer_avg_quantity": integer_avg_quantity,
    "conditional_distinct": conditional_distinct,
    "latest_orders_top100": latest_orders_top100,
}


# Fixed value: the run-time variable of the parameterised report below.
DEFAULT_START_DATE = "2000-01-01"


def revenue_since(spark, m, start_date: str = DEFAULT_START_DATE) -> DataFrame:
    """MAC-2 + SNK-1: a view queried through SQL with a run-time named parameter."""
    import datetime as _dt
    m["fct_sales_summary"].createOrReplaceTempView("fct_sales_summary")
    return spark.sql(
        "SELECT order_year, order_month, sum(total_revenue) AS revenue, sum(total_orders) AS orders "
        "FROM fct_sales_summary WHERE order_date >= :start_date GROUP BY order_year, order_month",
        args={"start_date": _dt.date.fromisoformat(start_date)})


def event_value_dollars(spark, events: DataFrame) -> DataFrame:
    """MAC-1: daily event value summed in integer cents, shown in dollars by the macro."""
    from salesmart.functions.numbers import cents_to_dollars
    cents = F.round(F.col("value") * 100).cast("bigint")
    return (events.groupBy(F.to_date("ts").alias("event_date"))
            .agg(F.sum(cents).alias("value_cents"))
            .select("event_date", cents_to_dollars("value_cents").alias("value_dollars")))
