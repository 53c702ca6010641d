"""Intermediate models (MOD-4, MOD-5).

``int_customer_orders`` groups order lines by 22 columns in the reference;
all of them are fixed by (order header, customer) because ``customer_id`` is
unique in ``stg_customers`` (a tested invariant).  So lines are first reduced
to the order grain on the seven header-level keys — an aggregation that
reuses the ``sales_order_id`` partitioning of the header × detail join, i.e.
no extra exchange — and only the much smaller order rows are joined to
customers.  If ``customer_id`` repeats in ``stg_customers`` (its unique check
fails then), the result is still that of the 22 columns: customer rows that
differ give an order a row each, equal ones count its lines as often.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.functions import business as B
from salesmart.functions.dates import days_between
from salesmart.functions.numbers import ratio
from salesmart.functions.text import full_name, surrogate_key

_ORDER_KEYS = ["sales_order_id", "customer_id", "order_date", "due_date", "ship_date",
               "order_status", "is_online_order"]

#: The columns of the order lines (MOD-3) that MOD-4 and MOD-5 read.
LINE_COLUMNS = [*_ORDER_KEYS, "sales_order_detail_id", "product_id", "order_quantity", "unit_price", "unit_price_discount",
                "line_total", "calculated_line_total", "order_subtotal", "order_tax_amount", "order_freight",
                "order_total_due", "sales_person_id", "territory_id", "header_modified_date", "detail_modified_date"]

#: Those that MOD-5 reads.
SOLD_COLUMNS = [*_ORDER_KEYS, "sales_order_detail_id", "product_id", "order_quantity", "unit_price", "unit_price_discount",
                "line_total", "calculated_line_total", "territory_id", "sales_person_id", "detail_modified_date"]

_CUSTOMER_KEYS = ["customer_id", "person_id", "account_number", "first_name", "last_name", "middle_name",
                  "email_promotion", "territory_id", "store_id"]
_SUMS = ["total_order_quantity", "total_line_total", "total_calculated_line_total", "total_gross_line_total",
         "total_discount_amount"]

INT_CUSTOMER_ORDERS_COLUMNS = [
    "customer_order_surrogate_key", "customer_id", "person_id", "account_number", "first_name",
    "last_name", "middle_name", "full_name", "email_promotion", "territory_id", "store_id",
    "sales_order_id", "order_date", "due_date", "ship_date", "order_status_name",
    "order_status_code", "order_channel", "is_online_order", "days_until_due", "days_to_ship",
    "shipping_performance", "total_order_quantity", "total_line_total",
    "total_calculated_line_total", "total_gross_line_total", "total_discount_amount",
    "has_discount_flag", "order_subtotal", "order_tax_amount", "order_freight", "order_total_due",
    "sales_person_id", "order_territory_id", "header_modified_date", "customer_modified_date",
]


def _gross(q="order_quantity", p="unit_price"):
    return F.col(q) * F.col(p)


def _discount_amount():
    return F.col("order_quantity") * F.col("unit_price") * F.col("unit_price_discount")


def _order_measures(order_territory: str = "territory_id"):
    return [
        F.sum("order_quantity").alias("total_order_quantity"),
        F.sum("line_total").alias("total_line_total"),
        F.sum("calculated_line_total").alias("total_calculated_line_total"),
        F.sum(_gross()).alias("total_gross_line_total"),
        F.sum(_discount_amount()).alias("total_discount_amount"),
        F.max(B.discount_flag("unit_price_discount")).alias("has_discount_flag"),
        F.max("order_subtotal").alias("order_subtotal"),
        F.max("order_tax_amount").alias("order_tax_amount"),
        F.max("order_freight").alias("order_freight"),
        F.max("order_total_due").alias("order_total_due"),
        F.max("sales_person_id").alias("sales_person_id"),
        F.max(order_territory).alias("order_territory_id"),
        F.max("header_modified_date").alias("header_modified_date"),
    ]


def _times(df: DataFrame, name: str):
    """A sum over an order's lines, as often as the customer's row is there; its type and scale stay."""
    c, n, t = F.col(name), F.col("_copies"), df.schema[name].dataType
    if isinstance(t, T.DecimalType):  # 27 + 10 + 1 digits: the product keeps the scale
        product = c.cast(T.DecimalType(27, t.scale)) * n.cast("decimal(10,0)")
    else:
        product = c * n
    return F.when(n > 1, product.cast(t)).otherwise(c)


def _order_attributes():
    return [
        surrogate_key("customer_id", "sales_order_id", "order_date").alias("customer_order_surrogate_key"),
        full_name("first_name", "middle_name", "last_name").alias("full_name"),
        B.order_status_name("order_status").alias("order_status_name"),
        F.col("order_status").alias("order_status_code"),
        B.order_channel("is_online_order").alias("order_channel"),
        days_between("order_date", "due_date").alias("days_until_due"),
        days_between("order_date", "ship_date").alias("days_to_ship"),
        B.shipping_performance("ship_date", "due_date").alias("shipping_performance"),
    ]


def int_customer_orders(sales_orders: DataFrame, customers: DataFrame) -> DataFrame:
    """MOD-4: one row per (customer, order), measures summed over the order's lines."""
    orders = sales_orders.groupBy(*_ORDER_KEYS).agg(*_order_measures())
    cust = customers.groupBy(*_CUSTOMER_KEYS).agg(F.max("modified_date").alias("customer_modified_date"),
                                                  F.count(F.lit(1)).alias("_copies"))
    joined = orders.join(cust, "customer_id", "inner")
    joined = joined.withColumns({c: _times(joined, c) for c in _SUMS})
    return joined.select("*", *_order_attributes()).select(*INT_CUSTOMER_ORDERS_COLUMNS)


def int_product_sales(sales_orders: DataFrame, products: DataFrame, as_of=None) -> DataFrame:
    """MOD-5: one row per order line with product attributes, profit and lifecycle."""
    return int_product_sales_joined(with_products(sales_orders, products), as_of)


def with_products(sales_orders: DataFrame, products: DataFrame) -> DataFrame:
    """The order lines with their products' attributes, from which MOD-5 is computed row by row."""
    p = products.select(
        "product_id", "product_number", "product_name", "product_subcategory_id", "subcategory_name",
        "product_category_id", "product_model_id", "color", "size", "product_line", "product_class",
        "product_style", "make_flag", "finished_goods_flag", "standard_cost", "list_price",
        "sell_start_date", "sell_end_date", "discontinued_date", "safety_stock_level",
        "reorder_point", "days_to_manufacture", F.col("modified_date").alias("product_modified_date"))
    return sales_orders.join(p, "product_id", "inner")


def int_product_sales_joined(j: DataFrame, as_of=None) -> DataFrame:
    price, cost, qty = F.col("unit_price"), F.col("standard_cost"), F.col("order_quantity")
    return j.select(
        surrogate_key("product_id", "order_date", "sales_order_id").alias("product_sale_surrogate_key"),
        "product_id", "product_number", "product_name", "product_subcategory_id", "subcategory_name",
        "product_category_id", "product_model_id", "color", "size", "product_line", "product_class",
        "product_style", "make_flag", "finished_goods_flag", "standard_cost", "list_price",
        price.alias("sale_unit_price"),
        (price - cost).alias("unit_profit"),
        ratio(price - cost, cost).alias("profit_margin_pct"),
        ratio(price, F.col("list_price")).alias("discount_from_list_pct"),
        "sales_order_id", "sales_order_detail_id", "order_date", "due_date", "ship_date", "customer_id",
        B.order_status_name("order_status").alias("order_status_name"),
        F.col("order_status").alias("order_status_code"),
        B.order_channel("is_online_order").alias("order_channel"),
        "order_quantity", "unit_price", "unit_price_discount", "line_total", "calculated_line_total",
        _gross().alias("gross_line_total"),
        _discount_amount().alias("discount_amount"),
        (qty * (price - cost)).alias("line_profit"),
        (qty * (price - cost) * (F.lit(1) - F.col("unit_price_discount"))).alias("net_line_profit"),
        "sell_start_date", "sell_end_date", "discontinued_date",
        B.lifecycle_status("discontinued_date", "sell_end_date", "sell_start_date", as_of)
        .alias("product_lifecycle_status"),
        "safety_stock_level", "reorder_point", "days_to_manufacture", "territory_id", "sales_person_id",
        "detail_modified_date", "product_modified_date",
    )
