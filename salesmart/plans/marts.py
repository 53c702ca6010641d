"""Mart models (MOD-6..8).

Plan notes (see README "Plans"):

* ``fct_sales_summary`` has eight distinct counts in one GROUP BY.  Spark would
  expand every line nine times before the shuffle.  Instead one pass sums the
  measures straight to the day (a row a day and task is shuffled), and one takes
  the distinct (day, order), (day, customer) and (day, product) as grouping sets
  of narrow keys; an order's marks travel as the bits of one number, so that
  every order-level distinct count becomes a sum of 0/1 flags.  Its exchange is
  keyed by (day, key), so one hot day is spread over all reducers.  The two
  day-level results are joined on the date (tiny), and the month context is a
  window over (year, month) instead of a second aggregation + join.
* ``fct_product_performance`` groups by 17 product attributes in the reference;
  all are fixed by ``product_id`` (unique in ``stg_products``), so it groups by
  the product key and takes the attributes from the product join the reference
  already does for inventory columns.  Its decomposable measures aggregate
  straight to the product grain; its three distinct counts come from narrow
  (product, key) distincts instead of an Expand of every line.
* ``dim_customer_metrics`` aggregates the order-grain table by customer; its
  only distinct count (order dates) is planned as a two-phase aggregation
  whose first exchange is keyed by (customer, date) when the input is read
  from storage (in a lazy chain it reuses the customer partitioning of the
  join before it; AQE then splits a skewed join partition, see session.py).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions import business as B
from salesmart.functions.dates import as_of_date, day_name, days_between, month_name
from salesmart.functions.numbers import RATIO_TYPE, avg_double, div_money, int_avg, int_div, pct, per

FCT_SALES_SUMMARY_COLUMNS = [
    "order_date", "order_year", "order_month", "order_day", "order_month_name", "order_day_name",
    "total_orders", "unique_customers", "unique_products_sold", "total_quantity_sold",
    "total_revenue", "total_gross_revenue", "total_discount_amount", "total_profit",
    "total_net_profit", "avg_profit_margin_pct", "avg_order_value", "online_orders",
    "offline_orders", "online_revenue", "offline_revenue", "online_order_pct", "shipped_orders",
    "cancelled_orders", "shipment_rate_pct", "orders_with_discount", "total_discounts_applied",
    "avg_discount_pct", "discount_order_pct", "monthly_total_orders", "monthly_total_revenue",
    "monthly_avg_order_value", "daily_revenue_pct_of_month",
]

#: The columns of the product sales that MOD-7 reads.
SUMMARY_COLUMNS = [
    "order_date", "sales_order_id", "customer_id", "product_id", "order_channel", "order_status_name",
    "unit_price_discount", "discount_from_list_pct", "order_quantity", "line_total", "gross_line_total",
    "discount_amount", "line_profit", "net_line_profit", "profit_margin_pct",
]

DIM_CUSTOMER_METRICS_COLUMNS = [
    "customer_id", "person_id", "account_number", "full_name", "first_name", "last_name",
    "email_promotion", "territory_id", "store_id", "total_orders", "unique_order_dates",
    "first_order_date", "last_order_date", "customer_lifetime_days", "orders_per_month",
    "days_since_last_order", "total_lifetime_revenue", "total_gross_revenue",
    "total_discounts_received", "avg_order_value", "max_order_value", "min_order_value",
    "total_items_purchased", "avg_items_per_order", "unique_products_purchased",
    "total_products_quantity", "total_profit_generated", "total_net_profit_generated",
    "avg_profit_margin_pct", "online_orders", "offline_orders", "online_revenue",
    "offline_revenue", "channel_preference", "online_order_pct", "shipped_orders",
    "cancelled_orders", "on_time_orders", "late_orders", "on_time_shipment_pct",
    "orders_with_discount", "total_discounts_used", "discount_usage_pct", "recency_score",
    "frequency_score", "monetary_score", "rfm_score", "customer_segment",
]

FCT_PRODUCT_PERFORMANCE_COLUMNS = [
    "product_id", "product_number", "product_name", "product_subcategory_id", "subcategory_name",
    "product_category_id", "product_model_id", "color", "size", "product_line", "product_class",
    "product_style", "make_flag", "finished_goods_flag", "product_lifecycle_status",
    "standard_cost", "list_price", "avg_sale_price", "min_sale_price", "max_sale_price",
    "avg_price_vs_list_pct", "avg_discount_from_list_pct", "total_orders", "unique_customers",
    "days_sold", "first_sale_date", "last_sale_date", "sales_period_days", "total_quantity_sold",
    "avg_quantity_per_order", "max_quantity_per_order", "units_sold_per_day", "total_revenue",
    "total_gross_revenue", "total_discount_amount", "avg_line_total", "max_line_total",
    "min_line_total", "revenue_per_day", "total_profit", "total_net_profit", "avg_unit_profit",
    "avg_profit_margin_pct", "overall_profit_margin_pct", "profit_margin_pct", "markup_pct",
    "online_orders", "offline_orders", "online_revenue", "offline_revenue", "online_order_pct",
    "online_revenue_pct", "shipped_orders", "cancelled_orders", "shipment_rate_pct",
    "customers_per_order", "performance_category", "safety_stock_level", "reorder_point",
    "days_to_manufacture",
]


def _flag(cond):
    return F.when(cond, 1).otherwise(0)


def _if(cond, value):
    return F.when(cond, value).otherwise(F.lit(0))


def _date_parts(df: DataFrame) -> DataFrame:
    d = F.col("order_date")
    return df.select(
        "*",
        F.year(d).alias("order_year"), F.month(d).alias("order_month"),
        F.dayofmonth(d).alias("order_day"),
        month_name(d).alias("order_month_name"), day_name(d).alias("order_day_name"))


def _with_month_context(daily: DataFrame) -> DataFrame:
    """Monthly totals beside each day: a window over the day rows of the month."""
    m = Window.partitionBy("order_year", "order_month")
    monthly_revenue = F.sum("total_revenue").over(m)
    return daily.select(
        "*",
        F.sum("total_orders").over(m).alias("monthly_total_orders"),
        monthly_revenue.alias("monthly_total_revenue"),
        (F.sum("avg_order_value").over(m).cast("double")
         / F.count("avg_order_value").over(m)).alias("monthly_avg_order_value"),
        F.when(monthly_revenue > 0,
               F.col("total_revenue").cast("double") / monthly_revenue.cast("double") * 100)
        .otherwise(F.lit(0.0)).alias("daily_revenue_pct_of_month"),
    )


def _daily_ratios(df: DataFrame) -> DataFrame:
    return df.select(
        "*",
        pct("online_orders", "total_orders").alias("online_order_pct"),
        pct("shipped_orders", "total_orders").alias("shipment_rate_pct"),
        pct("orders_with_discount", "total_orders").alias("discount_order_pct"),
    )


#: Grouping ids of (order_date, key) among order_date and the three keys, for orders, customers and products.
_KEY_SETS = (0b0011, 0b0101, 0b0110)


def fct_sales_summary(product_sales: DataFrame) -> DataFrame:
    """MOD-7: one row per order date (rewritten plan, see module notes)."""
    ps = product_sales
    disc = F.col("unit_price_discount") > 0
    avg_disc_value = F.when(disc, F.col("discount_from_list_pct")).otherwise(F.lit(0).cast(RATIO_TYPE))
    online, offline = F.col("order_channel") == "Online", F.col("order_channel") == "Offline"
    sums = ps.groupBy("order_date").agg(
        F.sum("order_quantity").alias("total_quantity_sold"),
        F.sum("line_total").alias("total_revenue"),
        F.sum("gross_line_total").cast("decimal(38,4)").alias("total_gross_revenue"),
        F.sum("discount_amount").alias("total_discount_amount"),
        F.sum("line_profit").cast("decimal(38,4)").alias("total_profit"),
        F.sum("net_line_profit").alias("total_net_profit"),
        avg_double("profit_margin_pct").alias("avg_profit_margin_pct"),
        F.sum(_if(online, F.col("line_total"))).alias("online_revenue"),
        F.sum(_if(offline, F.col("line_total"))).alias("offline_revenue"),
        F.sum("discount_amount").alias("total_discounts_applied"),
        avg_double(avg_disc_value).alias("avg_discount_pct"),
    )
    marks = reduce(Column.__add__, [F.when(cond, 1 << i).otherwise(0) for i, cond in enumerate((
        online, offline, F.col("order_status_name") == "Shipped", F.col("order_status_name") == "Cancelled", disc))])
    keys = ["sales_order_id", "customer_id", "product_id"]
    found = (ps.select("order_date", *keys, marks.alias("marks"))
             .groupingSets([["order_date", k] for k in keys], "order_date", *keys)
             .agg(F.grouping_id().alias("g"), F.bit_or("marks").alias("marks")))

    def marked(i: int) -> Column:
        return F.sum(_flag((F.col("g") == _KEY_SETS[0]) & (F.col("marks").bitwiseAND(1 << i) != 0)))

    def kinds(i: int) -> Column:  # as before a join on the date, days without a date have none
        return F.when(F.col("order_date").isNotNull(), F.count(F.when(F.col("g") == _KEY_SETS[i], F.col(keys[i]))))
    counts = found.groupBy("order_date").agg(
        F.sum(_flag(F.col("g") == _KEY_SETS[0])).alias("total_orders"),
        kinds(1).alias("unique_customers"), kinds(2).alias("unique_products_sold"),
        *[marked(i).alias(n) for i, n in enumerate((
            "online_orders", "offline_orders", "shipped_orders", "cancelled_orders", "orders_with_discount"))],
    ).withColumnRenamed("order_date", "_date")
    day = (sums.join(counts, F.col("order_date").eqNullSafe(F.col("_date"))).drop("_date")
           .withColumn("avg_order_value", div_money("total_revenue", "total_orders")))
    return _with_month_context(_daily_ratios(_date_parts(day))).select(*FCT_SALES_SUMMARY_COLUMNS)


#: How a measure is computed whole, kept as a mergeable part, and merged.
_WHOLE = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "avg": avg_double, "int_avg": int_avg}
_MERGED = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def whole(measures: list) -> list[Column]:
    """The measures (name, kind, SQL of the value) as one aggregation."""
    return [_WHOLE[kind](F.expr(value)).alias(name) for name, kind, value in measures]


def parts(measures: list) -> list[Column]:
    """The same as a state that can be merged: an average is kept as sum and count."""
    out = []
    for name, kind, value in measures:
        v = F.expr(value)
        out += ([F.sum(v).alias(f"{name}__sum"), F.count(v).alias(f"{name}__n")] if kind.endswith("avg")
                else [_WHOLE[kind](v).alias(name)])
    return out


def merged(measures: list) -> list[Column]:
    """The measures from states; equal to ``whole`` over all their rows, as every sum is exact."""
    out = []
    for name, kind, _ in measures:
        total, n = F.sum(f"{name}__sum"), F.sum(f"{name}__n")
        out.append((total.cast("double") / n if kind == "avg" else int_div(total, n)) if kind.endswith("avg")
                   else _MERGED[kind](name))
    return [c.alias(name) for c, (name, _, _) in zip(out, measures)]


def _one(test: str) -> str:
    return f"CASE WHEN {test} THEN 1 ELSE 0 END"


def _when(test: str, value: str) -> str:
    return f"CASE WHEN {test} THEN {value} ELSE 0 END"


_ONLINE, _OFFLINE = "order_channel = 'Online'", "order_channel = 'Offline'"

#: Measures of a customer's orders and lines.
CUSTOMER_MEASURES = [
    ("total_orders", "count", "sales_order_id"),
    ("first_order_date", "min", "order_date"), ("last_order_date", "max", "order_date"),
    ("total_lifetime_revenue", "sum", "total_line_total"),
    ("total_gross_revenue", "sum", "total_gross_line_total"),
    ("total_discounts_received", "sum", "total_discount_amount"),
    ("avg_order_value", "avg", "total_line_total"),
    ("max_order_value", "max", "total_line_total"), ("min_order_value", "min", "total_line_total"),
    ("total_items_purchased", "sum", "total_order_quantity"),
    ("avg_items_per_order", "int_avg", "total_order_quantity"),
    ("online_orders", "sum", _one(_ONLINE)), ("offline_orders", "sum", _one(_OFFLINE)),
    ("online_revenue", "sum", _when(_ONLINE, "total_line_total")),
    ("offline_revenue", "sum", _when(_OFFLINE, "total_line_total")),
    ("shipped_orders", "sum", _one("order_status_name = 'Shipped'")),
    ("cancelled_orders", "sum", _one("order_status_name = 'Cancelled'")),
    ("on_time_orders", "sum", _one("shipping_performance = 'On Time'")),
    ("late_orders", "sum", _one("shipping_performance = 'Late'")),
    ("orders_with_discount", "sum", _one("has_discount_flag = 1")),
    ("total_discounts_used", "sum", _when("has_discount_flag = 1", "total_discount_amount")),
]
CUSTOMER_LINE_MEASURES = [
    ("total_products_quantity", "sum", "order_quantity"),
    ("total_profit_generated", "sum", "line_profit"),
    ("total_net_profit_generated", "sum", "net_line_profit"),
    ("avg_profit_margin_pct", "avg", "profit_margin_pct"),
]
#: Measures of a product's lines.
PRODUCT_MEASURES = [
    ("first_sale_date", "min", "order_date"), ("last_sale_date", "max", "order_date"),
    ("total_quantity_sold", "sum", "order_quantity"),
    ("avg_quantity_per_order", "int_avg", "order_quantity"),
    ("max_quantity_per_order", "max", "order_quantity"),
    ("total_revenue", "sum", "line_total"), ("total_gross_revenue", "sum", "gross_line_total"),
    ("avg_line_total", "avg", "line_total"),
    ("max_line_total", "max", "line_total"), ("min_line_total", "min", "line_total"),
    ("avg_sale_price", "avg", "sale_unit_price"),
    ("min_sale_price", "min", "sale_unit_price"), ("max_sale_price", "max", "sale_unit_price"),
    ("avg_discount_from_list_pct", "avg", "discount_from_list_pct"),
    ("total_discount_amount", "sum", "discount_amount"),
    ("total_profit", "sum", "line_profit"), ("total_net_profit", "sum", "net_line_profit"),
    ("avg_unit_profit", "avg", "unit_profit"), ("avg_profit_margin_pct", "avg", "profit_margin_pct"),
    ("online_orders", "sum", _one(_ONLINE)), ("offline_orders", "sum", _one(_OFFLINE)),
    ("online_revenue", "sum", _when(_ONLINE, "line_total")), ("offline_revenue", "sum", _when(_OFFLINE, "line_total")),
    ("shipped_orders", "sum", _one("order_status_name = 'Shipped'")),
    ("cancelled_orders", "sum", _one("order_status_name = 'Cancelled'")),
]

CUSTOMER_KEYS = ["customer_id", "person_id", "account_number", "full_name", "first_name",
                  "last_name", "email_promotion", "territory_id", "store_id"]


def dim_customer_metrics(customer_orders: DataFrame, product_sales: DataFrame, as_of=None) -> DataFrame:
    """MOD-6: one row per customer with RFM scores and a segment.

    ``customer_orders`` is unique per (customer, order) — its surrogate key is
    tested unique — so the distinct order count is a row count.
    """
    c = customer_orders.groupBy(*CUSTOMER_KEYS).agg(
        F.countDistinct("order_date").alias("unique_order_dates"), *whole(CUSTOMER_MEASURES))
    p = product_sales.groupBy("customer_id").agg(
        F.countDistinct("product_id").alias("unique_products_purchased"), *whole(CUSTOMER_LINE_MEASURES))
    return customer_metrics(c, p, as_of)


def customer_metrics(orders: DataFrame, lines: DataFrame, as_of=None) -> DataFrame:
    """MOD-6 from its two aggregates, by customer: of the orders (with the customer's attributes) and of the lines."""
    span = days_between("first_order_date", "last_order_date")
    c = orders.withColumns({
        "customer_lifetime_days": span,
        "days_since_last_order": days_between("last_order_date", as_of_date(as_of)),
        "orders_per_month": F.when(span > 0, F.col("total_orders").cast("double") / span * 30).otherwise(F.lit(0.0))})
    rec, freq, mon = (B.recency_score("days_since_last_order"), B.frequency_score("orders_per_month"),
                      B.monetary_score("total_lifetime_revenue"))
    return c.join(lines, "customer_id", "left").select(
        "*",
        rec.alias("recency_score"), freq.alias("frequency_score"), mon.alias("monetary_score"),
        (rec + freq + mon).alias("rfm_score"),
        B.customer_segment("total_lifetime_revenue", "orders_per_month", "days_since_last_order",
                           "total_orders").alias("customer_segment"),
        B.channel_preference("online_orders", "offline_orders").alias("channel_preference"),
        pct("online_orders", "total_orders").alias("online_order_pct"),
        pct("on_time_orders", "shipped_orders").alias("on_time_shipment_pct"),
        pct("orders_with_discount", "total_orders").alias("discount_usage_pct"),
    ).select(*DIM_CUSTOMER_METRICS_COLUMNS)


def _product_ratios(j: DataFrame) -> DataFrame:
    gross = F.col("total_gross_revenue")
    j = j.withColumns({
        "sales_period_days": days_between("first_sale_date", "last_sale_date"),
        "overall_profit_margin_pct": F.when(gross != 0, F.col("total_profit").cast("double") / gross.cast("double") * 100)})
    cost, lst = F.col("standard_cost"), F.col("list_price")
    avg_price = F.col("avg_sale_price")
    return j.select(
        "*",
        per("total_quantity_sold", "sales_period_days").alias("units_sold_per_day"),
        per("total_revenue", "sales_period_days").alias("revenue_per_day"),
        per("unique_customers", "total_orders").alias("customers_per_order"),
        F.when(lst > 0, avg_price / lst.cast("double") * 100).otherwise(F.lit(0.0)).alias("avg_price_vs_list_pct"),
        F.when(F.col("total_revenue") > 0,
               F.col("total_profit").cast("double") / F.col("total_revenue").cast("double") * 100)
        .otherwise(F.lit(0.0)).alias("profit_margin_pct"),
        F.when(cost > 0, (avg_price - cost.cast("double")) / cost.cast("double") * 100)
        .otherwise(F.lit(0.0)).alias("markup_pct"),
        pct("online_orders", "total_orders").alias("online_order_pct"),
        F.when(F.col("total_revenue") > 0,
               F.col("online_revenue").cast("double") / F.col("total_revenue").cast("double") * 100)
        .otherwise(F.lit(0.0)).alias("online_revenue_pct"),
        B.performance_category("total_revenue", "avg_profit_margin_pct").alias("performance_category"),
        pct("shipped_orders", "total_orders").alias("shipment_rate_pct"),
    ).select(*FCT_PRODUCT_PERFORMANCE_COLUMNS)


_PRODUCT_ATTRS = ["product_id", "product_number", "product_name", "product_subcategory_id", "subcategory_name",
                  "product_category_id", "product_model_id", "color", "size", "product_line", "product_class",
                  "product_style", "make_flag", "finished_goods_flag", "standard_cost", "list_price"]
_INVENTORY = ["safety_stock_level", "reorder_point", "days_to_manufacture"]


def fct_product_performance(product_sales: DataFrame, products: DataFrame, as_of=None) -> DataFrame:
    """MOD-8: one row per product (× lifecycle status) with sales, price and profit metrics.

    Every line measure is decomposable, so it is aggregated straight to the
    product grain (map-side partial aggregation: only one row per product and
    task is shuffled).  The three distinct counts take a second scan of five
    narrow columns, so that only those are expanded and exchanged by (product,
    value); both results are partitioned by the product key, so joining them
    needs no further exchange.  The line fact is scanned twice in all.
    """
    ps = product_sales
    grain = ["product_id", "product_lifecycle_status"]
    a = ps.groupBy(*grain).agg(*whole(PRODUCT_MEASURES))
    distinct = ps.select(*grain, "sales_order_id", "customer_id", "order_date").groupBy(*grain).agg(
        F.countDistinct("sales_order_id").alias("total_orders"),
        F.countDistinct("customer_id").alias("unique_customers"),
        F.countDistinct("order_date").alias("days_sold"))
    return product_performance(a.join(distinct, grain, "left"), products)


def product_performance(sales: DataFrame, products: DataFrame) -> DataFrame:
    """MOD-8 from its aggregates by product and lifecycle status."""
    return _product_ratios(sales.join(products.select(*_PRODUCT_ATTRS, *_INVENTORY), "product_id", "left"))
