"""SQL twins of the operator-level report queries."""

from __future__ import annotations

from oracle_sql.base import AS_OF, avg, div6, int_avg, project, with_models
from oracle_sql.marts import CUSTOMER, DAILY, PRODUCT

_R = {
    "order_status_mix": ("""SELECT order_status_code, order_status_name, count(*) AS orders,
        sum(total_line_total) AS revenue FROM int_customer_orders GROUP BY 1, 2""",
                         "order_status_code:i order_status_name:s orders:i revenue:d"),
    "channel_split": ("""SELECT order_channel, count(*) AS orders, count(DISTINCT customer_id) AS customers,
        sum(total_line_total) AS revenue FROM int_customer_orders GROUP BY 1""",
                      "order_channel:s orders:i customers:i revenue:d"),
    "shipping_performance_mix": (f"""SELECT shipping_performance, count(*) AS orders,
        {avg("days_to_ship")} AS avg_days_to_ship, min(days_until_due) AS min_days_until_due
        FROM int_customer_orders GROUP BY 1""",
                                 "shipping_performance:s orders:i avg_days_to_ship:d min_days_until_due:i"),
    "margin_by_product": (f"""SELECT product_id, sum(gross_line_total) AS gross, sum(discount_amount) AS discount,
        sum(line_profit) AS profit, sum(net_line_profit) AS net_profit,
        {avg("profit_margin_pct")} AS avg_margin_ratio, min(unit_profit) AS min_unit_profit
        FROM int_product_sales GROUP BY 1""",
                          "product_id:i gross:d discount:d profit:d net_profit:d avg_margin_ratio:r min_unit_profit:d"),
    "discount_profile": ("""SELECT unit_price_discount, count(*) AS lines,
        sum(CASE WHEN unit_price_discount > 0 THEN 1 ELSE 0 END) AS discounted_lines,
        sum(line_total) AS line_total, sum(calculated_line_total) AS calculated_line_total,
        sum(CASE WHEN line_total <> calculated_line_total THEN 1 ELSE 0 END) AS mismatches
        FROM stg_sales_orders GROUP BY 1""",
                         "unit_price_discount:d lines:i discounted_lines:i line_total:d calculated_line_total:d mismatches:i"),
    "lifecycle_counts": (f"""SELECT CASE WHEN discontinued_date IS NOT NULL THEN 'Discontinued'
              WHEN sell_end_date IS NOT NULL AND CAST(sell_end_date AS TIMESTAMP) < TIMESTAMP '{AS_OF} 00:00:00' THEN 'Ended'
              WHEN CAST(sell_start_date AS TIMESTAMP) > TIMESTAMP '{AS_OF} 00:00:00' THEN 'Not Started'
              ELSE 'Active' END AS product_lifecycle_status, count(*) AS products
        FROM stg_products GROUP BY 1""", "product_lifecycle_status:s products:i"),
    "rfm_scores": ("""SELECT recency_score, frequency_score, monetary_score, rfm_score, count(*) AS customers
        FROM dim_customer_metrics GROUP BY 1, 2, 3, 4""",
                   "recency_score:i frequency_score:i monetary_score:i rfm_score:i customers:i"),
    "customer_segments": ("""SELECT customer_segment, channel_preference, count(*) AS customers,
        sum(total_lifetime_revenue) AS revenue FROM dim_customer_metrics GROUP BY 1, 2""",
                          "customer_segment:s channel_preference:s customers:i revenue:d"),
    "performance_categories": ("""SELECT performance_category, count(*) AS products, sum(total_revenue) AS revenue
        FROM fct_product_performance GROUP BY 1""", "performance_category:s products:i revenue:d"),
    "monthly_sales": (f"""SELECT order_year, order_month, order_month_name,
        count(DISTINCT order_date) AS days_with_orders, sum(total_orders) AS total_orders,
        sum(unique_customers) AS unique_customers, sum(unique_products_sold) AS unique_products_sold,
        sum(total_quantity_sold) AS total_quantity_sold, sum(total_revenue) AS total_revenue,
        sum(total_gross_revenue) AS total_gross_revenue, sum(total_discount_amount) AS total_discount_amount,
        sum(total_profit) AS total_profit, sum(total_net_profit) AS total_net_profit,
        sum(online_orders) AS online_orders, sum(offline_orders) AS offline_orders,
        sum(online_revenue) AS online_revenue, sum(offline_revenue) AS offline_revenue,
        sum(shipped_orders) AS shipped_orders, sum(cancelled_orders) AS cancelled_orders,
        sum(orders_with_discount) AS orders_with_discount, sum(total_discounts_applied) AS total_discounts_applied,
        {avg("avg_order_value")} AS avg_order_value
        FROM fct_sales_summary GROUP BY 1, 2, 3""",
                      "order_year:i order_month:i order_month_name:s days_with_orders:i total_orders:i "
                      "unique_customers:i unique_products_sold:i total_quantity_sold:i total_revenue:d "
                      "total_gross_revenue:d total_discount_amount:d total_profit:d total_net_profit:d "
                      "online_orders:i offline_orders:i online_revenue:d offline_revenue:d shipped_orders:i "
                      "cancelled_orders:i orders_with_discount:i total_discounts_applied:d avg_order_value:d"),
    "daily_product_grain": ("""SELECT order_date, product_id, sum(order_quantity) AS quantity, sum(line_total) AS amount
        FROM int_product_sales GROUP BY 1, 2""", "order_date:dt product_id:i quantity:i amount:d"),
    "month_share": ("""SELECT order_date, total_revenue, monthly_total_revenue, daily_revenue_pct_of_month
        FROM fct_sales_summary""", "order_date:dt total_revenue:d monthly_total_revenue:d daily_revenue_pct_of_month:d"),
    "integer_avg_quantity": (f"""SELECT product_id, {int_avg("order_quantity")} AS avg_quantity,
        sum(order_quantity) AS quantity, count(order_quantity) AS lines FROM int_product_sales GROUP BY 1""",
                             "product_id:i avg_quantity:i quantity:i lines:i"),
    "conditional_distinct": (f"""SELECT order_date,
        count(DISTINCT CASE WHEN order_channel = 'Online' THEN sales_order_id END) AS online_orders,
        count(DISTINCT CASE WHEN order_status_name = 'Shipped' THEN sales_order_id END) AS shipped_orders,
        count(DISTINCT CASE WHEN unit_price_discount > 0 THEN sales_order_id END) AS orders_with_discount,
        {div6("sum(line_total)", "count(DISTINCT sales_order_id)")} AS avg_order_value
        FROM int_product_sales GROUP BY 1""",
                             "order_date:dt online_orders:i shipped_orders:i orders_with_discount:i avg_order_value:d"),
    "latest_orders_top100": ("""SELECT sales_order_id, max(header_modified_date) AS header_modified_date,
        max(customer_id) AS customer_id FROM stg_sales_orders GROUP BY 1
        ORDER BY header_modified_date DESC, sales_order_id DESC LIMIT 100""",
                             "sales_order_id:i header_modified_date:ts customer_id:i"),
}


def report_sql() -> dict[str, str]:
    out = {
        "revenue_since": project(with_models(DAILY, "q AS (SELECT order_year, order_month, "
                                             "sum(total_revenue) AS revenue, sum(total_orders) AS orders "
                                             "FROM fct_sales_summary WHERE order_date >= DATE '2000-01-01' "
                                             "GROUP BY 1, 2)"), "order_year:i order_month:i revenue:d orders:i"),
        "event_value_dollars": project(
            "WITH q AS (SELECT CAST(ts AS DATE) AS event_date, "
            "CAST(CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DECIMAL(38,0)) / 100 AS DECIMAL(16,2)) "
            "AS value_dollars FROM events GROUP BY 1)", "event_date:dt value_dollars:d"),
    }
    for name, (sql, kinds) in _R.items():
        body = with_models(DAILY, CUSTOMER, PRODUCT, f"q AS ({sql})")
        out[name] = project(body, kinds)
    return out
