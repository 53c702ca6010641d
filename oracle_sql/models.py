"""Oracle SQL for the eight models."""

from __future__ import annotations

from oracle_sql import kinds as K
from oracle_sql.base import project, with_models
from oracle_sql.marts import CUSTOMER, DAILY, PRODUCT


def _model(name: str, extra: str = "") -> str:
    return project(with_models(extra), getattr(K, name.upper()), source=name)


def model_sql() -> dict[str, str]:
    return {
        "stg_customers": _model("stg_customers"),
        "stg_products": _model("stg_products"),
        "stg_sales_orders": _model("stg_sales_orders"),
        "int_customer_orders": _model("int_customer_orders"),
        "int_product_sales": _model("int_product_sales"),
        "fct_sales_summary": _model("fct_sales_summary", DAILY),
        "dim_customer_metrics": _model("dim_customer_metrics", CUSTOMER),
        "fct_product_performance": _model("fct_product_performance", PRODUCT),
        # the state of the second run: recent days, all customers and products
        "publish_rollback": project(with_models(DAILY, CUSTOMER, PRODUCT) + """, q AS (
            SELECT 'fct_sales_summary' AS table_name, count(*) AS n_rows, sum(total_orders) AS orders
            FROM fct_sales_summary WHERE order_date >= DATE '2000-01-01'
            UNION ALL SELECT 'dim_customer_metrics', count(*), sum(total_orders) FROM dim_customer_metrics
            UNION ALL SELECT 'fct_product_performance', count(*), sum(total_orders) FROM fct_product_performance)""",
            "table_name:s n_rows:i orders:i"),
        "customers_by_name": _model("stg_customers"),
        # refreshed marts equal the full ones
        "customer_metrics_refresh": _model("dim_customer_metrics", CUSTOMER),
        "product_performance_refresh": _model("fct_product_performance", PRODUCT),
        # a refresh of recent years merged with older rows equals the full mart
        "sales_summary_refresh": project(with_models(DAILY), K.FCT_SALES_SUMMARY, source="fct_sales_summary"),
    }
