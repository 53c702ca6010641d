"""Plain one-pass SQL for the parts of the models whose plans are rewritten."""

ORDERS = """
SELECT l.sales_order_id, c.customer_id, sum(order_quantity) AS total_order_quantity, sum(line_total) AS total_line_total,
       sum(order_quantity * unit_price) AS total_gross_line_total, max(order_total_due) AS order_total_due,
       max(int(unit_price_discount > 0)) AS has_discount_flag
FROM lines l JOIN customers c ON l.customer_id = c.customer_id GROUP BY l.sales_order_id, c.customer_id"""

DAYS = """
SELECT order_date, count(DISTINCT sales_order_id) AS total_orders, count(DISTINCT customer_id) AS unique_customers,
       count(DISTINCT product_id) AS unique_products_sold, sum(line_total) AS total_revenue, sum(line_profit) AS total_profit,
       count(DISTINCT sales_order_id) FILTER (WHERE order_channel = 'Online') AS online_orders,
       count(DISTINCT sales_order_id) FILTER (WHERE order_status_name = 'Shipped') AS shipped_orders,
       count(DISTINCT sales_order_id) FILTER (WHERE unit_price_discount > 0) AS orders_with_discount,
       double(sum(profit_margin_pct)) / count(profit_margin_pct) AS avg_profit_margin_pct
FROM lines GROUP BY order_date"""

PRODUCTS = """
SELECT product_id, product_lifecycle_status, count(DISTINCT sales_order_id) AS total_orders,
       count(DISTINCT customer_id) AS unique_customers, count(DISTINCT order_date) AS days_sold,
       sum(line_total) AS total_revenue, sum(order_quantity) AS total_quantity_sold, max(line_total) AS max_line_total,
       count(IF(order_channel = 'Online', 1, NULL)) AS online_orders
FROM lines GROUP BY product_id, product_lifecycle_status"""


def same(spark, model, sql, **tables):
    """The model has the SQL's rows in the SQL's columns, and no other row."""
    from salesmart.plans.output import comparable
    want = comparable(spark.sql(" ".join(sql.split()).replace("FROM lines", "FROM {lines}").replace("JOIN customers", "JOIN {customers}"),
                                **tables))
    got = comparable(model).select(*want.columns)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
