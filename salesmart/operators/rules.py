"""The declared tests of the eight models (218 checks), as data.

Fixed values: every column test and model-level test exactly as declared for
each model, in declaration order.  Entry forms:

  (column, "not_null") | (column, "unique") | (column, "is_positive")
  (column, "no_future_dates")
  (column, "accepted_values", [values])
  (column, "accepted_range", min, max)          # None = unbounded
  (column, "relationships", to_model, to_field)
  ("valid_date_range", start_column, end_column)   # model-level
"""

from __future__ import annotations

from salesmart.operators.quality import Check

STATUS_NAMES = ["In Process", "Approved", "Backordered", "Rejected", "Shipped", "Cancelled", "Unknown"]
CHANNELS = ["Online", "Offline"]
LIFECYCLE = ["Active", "Discontinued", "Ended", "Not Started"]

# ---- fixed values: declared tests ----------------------------------------------
RULES = {
    "stg_customers": [
        ("customer_id", "not_null"), ("customer_id", "unique"),
        ("person_id", "not_null"),
        ("account_number", "not_null"), ("account_number", "unique"),
        ("email_promotion", "accepted_values", [0, 1, 2]),
        ("modified_date", "no_future_dates"),
    ],
    "stg_products": [
        ("product_id", "not_null"), ("product_id", "unique"),
        ("product_number", "not_null"), ("product_number", "unique"),
        ("product_name", "not_null"),
        ("make_flag", "accepted_values", [0, 1]),
        ("finished_goods_flag", "accepted_values", [0, 1]),
        ("product_line", "accepted_values", ["R", "M", "T", "S", ""]),
        ("product_class", "accepted_values", ["H", "M", "L", ""]),
        ("product_style", "accepted_values", ["U", "M", "W", ""]),
        ("safety_stock_level", "not_null"), ("safety_stock_level", "is_positive"),
        ("reorder_point", "not_null"), ("reorder_point", "is_positive"),
        ("days_to_manufacture", "not_null"), ("days_to_manufacture", "accepted_range", 0, None),
        ("standard_cost", "not_null"), ("standard_cost", "accepted_range", 0, None),
        ("list_price", "not_null"), ("list_price", "accepted_range", 0, None),
        ("sell_start_date", "not_null"), ("sell_start_date", "no_future_dates"),
        ("sell_end_date", "no_future_dates"),
        ("discontinued_date", "no_future_dates"),
        ("modified_date", "no_future_dates"),
        ("valid_date_range", "sell_start_date", "sell_end_date"),
    ],
    "stg_sales_orders": [
        ("sales_order_id", "not_null"),
        ("sales_order_detail_id", "not_null"), ("sales_order_detail_id", "unique"),
        ("order_date", "not_null"), ("order_date", "no_future_dates"),
        ("due_date", "not_null"), ("due_date", "no_future_dates"),
        ("ship_date", "no_future_dates"),
        ("order_status", "not_null"), ("order_status", "accepted_values", [1, 2, 3, 4, 5, 6]),
        ("is_online_order", "accepted_values", [0, 1]),
        ("sales_order_number", "not_null"),
        ("customer_id", "not_null"), ("customer_id", "relationships", "stg_customers", "customer_id"),
        ("product_id", "not_null"), ("product_id", "relationships", "stg_products", "product_id"),
        ("order_quantity", "not_null"), ("order_quantity", "is_positive"),
        ("unit_price", "not_null"), ("unit_price", "is_positive"),
        ("unit_price_discount", "accepted_range", 0, 1),
        ("line_total", "is_positive"),
        ("order_subtotal", "is_positive"),
        ("order_tax_amount", "is_positive"),
        ("order_freight", "is_positive"),
        ("order_total_due", "is_positive"),
        ("header_modified_date", "no_future_dates"),
        ("detail_modified_date", "no_future_dates"),
        ("valid_date_range", "order_date", "due_date"),
        ("valid_date_range", "order_date", "ship_date"),
    ],
    "int_customer_orders": [
        ("customer_order_surrogate_key", "not_null"), ("customer_order_surrogate_key", "unique"),
        ("customer_id", "not_null"), ("customer_id", "relationships", "stg_customers", "customer_id"),
        ("account_number", "not_null"),
        ("full_name", "not_null"),
        ("sales_order_id", "not_null"),
        ("order_date", "not_null"), ("order_date", "no_future_dates"),
        ("due_date", "not_null"), ("due_date", "no_future_dates"),
        ("ship_date", "no_future_dates"),
        ("order_status_name", "not_null"), ("order_status_name", "accepted_values", STATUS_NAMES),
        ("order_status_code", "not_null"), ("order_status_code", "accepted_range", 1, 6),
        ("order_channel", "not_null"), ("order_channel", "accepted_values", CHANNELS),
        ("shipping_performance", "accepted_values", ["On Time", "Late", "Not Shipped"]),
        ("total_order_quantity", "not_null"), ("total_order_quantity", "is_positive"),
        ("total_line_total", "not_null"), ("total_line_total", "is_positive"),
        ("order_subtotal", "is_positive"),
        ("order_tax_amount", "is_positive"),
        ("order_freight", "is_positive"),
        ("order_total_due", "not_null"), ("order_total_due", "is_positive"),
        ("header_modified_date", "no_future_dates"),
        ("customer_modified_date", "no_future_dates"),
        ("valid_date_range", "order_date", "due_date"),
        ("valid_date_range", "order_date", "ship_date"),
    ],
    "int_product_sales": [
        ("product_sale_surrogate_key", "not_null"), ("product_sale_surrogate_key", "unique"),
        ("product_id", "not_null"), ("product_id", "relationships", "stg_products", "product_id"),
        ("product_number", "not_null"),
        ("product_name", "not_null"),
        ("standard_cost", "not_null"), ("standard_cost", "is_positive"),
        ("list_price", "not_null"), ("list_price", "is_positive"),
        ("sale_unit_price", "not_null"), ("sale_unit_price", "is_positive"),
        ("sales_order_id", "not_null"),
        ("sales_order_detail_id", "not_null"),
        ("order_date", "not_null"), ("order_date", "no_future_dates"),
        ("due_date", "no_future_dates"),
        ("ship_date", "no_future_dates"),
        ("customer_id", "not_null"), ("customer_id", "relationships", "stg_customers", "customer_id"),
        ("order_status_name", "not_null"), ("order_status_name", "accepted_values", STATUS_NAMES),
        ("order_status_code", "not_null"),
        ("order_channel", "not_null"), ("order_channel", "accepted_values", CHANNELS),
        ("order_quantity", "not_null"), ("order_quantity", "is_positive"),
        ("unit_price", "not_null"),
        ("sell_start_date", "no_future_dates"),
        ("sell_end_date", "no_future_dates"),
        ("discontinued_date", "no_future_dates"),
        ("product_lifecycle_status", "not_null"), ("product_lifecycle_status", "accepted_values", LIFECYCLE),
        ("detail_modified_date", "no_future_dates"),
        ("product_modified_date", "no_future_dates"),
        ("valid_date_range", "sell_start_date", "sell_end_date"),
        ("valid_date_range", "order_date", "due_date"),
        ("valid_date_range", "order_date", "ship_date"),
    ],
    "fct_sales_summary": [
        ("order_date", "not_null"), ("order_date", "no_future_dates"),
        ("order_year", "not_null"),
        ("order_month", "not_null"), ("order_month", "accepted_range", 1, 12),
        ("total_orders", "not_null"), ("total_orders", "accepted_range", 0, None),
        ("unique_customers", "not_null"), ("unique_customers", "accepted_range", 0, None),
        ("unique_products_sold", "not_null"), ("unique_products_sold", "accepted_range", 0, None),
        ("total_quantity_sold", "not_null"), ("total_quantity_sold", "is_positive"),
        ("total_revenue", "not_null"), ("total_revenue", "is_positive"),
        ("total_gross_revenue", "not_null"), ("total_gross_revenue", "is_positive"),
        ("total_discount_amount", "accepted_range", 0, None),
        ("avg_order_value", "accepted_range", 0, None),
        ("online_orders", "accepted_range", 0, None),
        ("offline_orders", "accepted_range", 0, None),
        ("online_revenue", "accepted_range", 0, None),
        ("offline_revenue", "accepted_range", 0, None),
        ("online_order_pct", "accepted_range", 0, 100),
        ("shipped_orders", "accepted_range", 0, None),
        ("cancelled_orders", "accepted_range", 0, None),
        ("shipment_rate_pct", "accepted_range", 0, 100),
        ("orders_with_discount", "accepted_range", 0, None),
        ("discount_order_pct", "accepted_range", 0, 100),
        ("daily_revenue_pct_of_month", "accepted_range", 0, 100),
    ],
    "dim_customer_metrics": [
        ("customer_id", "not_null"), ("customer_id", "unique"),
        ("account_number", "not_null"),
        ("full_name", "not_null"),
        ("total_orders", "not_null"), ("total_orders", "is_positive"),
        ("first_order_date", "not_null"), ("first_order_date", "no_future_dates"),
        ("last_order_date", "not_null"), ("last_order_date", "no_future_dates"),
        ("orders_per_month", "accepted_range", 0, None),
        ("days_since_last_order", "accepted_range", 0, None),
        ("total_lifetime_revenue", "not_null"), ("total_lifetime_revenue", "is_positive"),
        ("avg_order_value", "accepted_range", 0, None),
        ("total_items_purchased", "is_positive"),
        ("channel_preference", "accepted_values", ["Online Preferred", "Offline Preferred", "Mixed"]),
        ("online_order_pct", "accepted_range", 0, 100),
        ("on_time_shipment_pct", "accepted_range", 0, 100),
        ("discount_usage_pct", "accepted_range", 0, 100),
        ("recency_score", "accepted_range", 1, 5),
        ("frequency_score", "accepted_range", 1, 5),
        ("monetary_score", "accepted_range", 1, 5),
        ("rfm_score", "accepted_range", 3, 15),
        ("customer_segment", "not_null"),
        ("customer_segment", "accepted_values",
         ["Champion", "Loyal Customer", "Potential Loyalist", "At Risk", "Lost", "New Customer", "Regular"]),
        ("valid_date_range", "first_order_date", "last_order_date"),
    ],
    "fct_product_performance": [
        ("product_id", "not_null"), ("product_id", "unique"),
        ("product_id", "relationships", "stg_products", "product_id"),
        ("product_number", "not_null"),
        ("product_name", "not_null"),
        ("product_lifecycle_status", "not_null"), ("product_lifecycle_status", "accepted_values", LIFECYCLE),
        ("standard_cost", "not_null"), ("standard_cost", "is_positive"),
        ("list_price", "not_null"), ("list_price", "is_positive"),
        ("avg_sale_price", "accepted_range", 0, None),
        ("total_orders", "not_null"), ("total_orders", "accepted_range", 0, None),
        ("unique_customers", "not_null"), ("unique_customers", "accepted_range", 0, None),
        ("first_sale_date", "no_future_dates"),
        ("last_sale_date", "no_future_dates"),
        ("total_quantity_sold", "not_null"), ("total_quantity_sold", "is_positive"),
        ("total_revenue", "not_null"), ("total_revenue", "is_positive"),
        ("online_order_pct", "accepted_range", 0, 100),
        ("online_revenue_pct", "accepted_range", 0, 100),
        ("shipment_rate_pct", "accepted_range", 0, 100),
        ("performance_category", "not_null"),
        ("performance_category", "accepted_values",
         ["Star Product", "High Performer", "Regular Performer", "Low Performer", "Underperformer"]),
        ("valid_date_range", "first_sale_date", "last_sale_date"),
    ],
}
# --------------------------------------------------------------------------------


def to_check(model: str, entry: tuple) -> Check:
    if entry[0] == "valid_date_range":
        return Check(model, "valid_date_range", None, {"start": entry[1], "end": entry[2]})
    col, kind = entry[0], entry[1]
    if kind == "accepted_values":
        return Check(model, kind, col, {"values": list(entry[2])})
    if kind == "accepted_range":
        return Check(model, kind, col, {"min": entry[2], "max": entry[3]})
    if kind == "relationships":
        return Check(model, kind, col, {"to": entry[2], "field": entry[3]})
    return Check(model, kind, col)


def declared_checks(models=None, kinds=None) -> list[Check]:
    out = []
    for model, entries in RULES.items():
        if models and model not in models:
            continue
        for e in entries:
            c = to_check(model, e)
            if kinds is None or c.kind in kinds:
                out.append(c)
    return out


# ---- guide-level checks (written out only in the guides), applied to our models ----
# Fixed values chosen for the test data; each check kind mirrors one guide check.
def guide_checks() -> dict[str, list[Check]]:
    models = ("stg_customers", "stg_products", "stg_sales_orders", "int_customer_orders",
              "int_product_sales", "dim_customer_metrics", "fct_sales_summary", "fct_product_performance")
    return {
        "recency": [
            Check("fct_sales_summary", "recency", "order_date", {"count": 30, "period": "day"}),
            Check("stg_sales_orders", "recency", "header_modified_date", {"count": 1, "period": "day"}),
            Check("dim_customer_metrics", "recency", "last_order_date", {"count": 168, "period": "hour"}),
        ],
        "equal_rowcount": [
            Check("int_product_sales", "equal_rowcount", None, {"to": "stg_sales_orders"}),
            Check("dim_customer_metrics", "equal_rowcount", None, {"to": "stg_customers"}),
        ],
        "unique_combination": [
            Check("int_product_sales", "unique_combination", None,
                  {"columns": ["product_id", "order_date", "sales_order_id"]}),
            Check("stg_sales_orders", "unique_combination", None,
                  {"columns": ["sales_order_id", "sales_order_detail_id"]}),
        ],
        "regex": [
            Check("stg_customers", "regex", "account_number", {"pattern": "^CUSTOMER#[0-9]+$"}),
            Check("stg_sales_orders", "regex", "sales_order_number", {"pattern": "^SO[0-9]+$"}),
            Check("src_person", "regex", "EmailAddress",
                  {"pattern": "^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}$"}),
        ],
        "between": [
            Check("stg_sales_orders", "between", "unit_price_discount", {"min": 0, "max": 0.05}),
            Check("stg_sales_orders", "between", "order_date", {"min": "1995-01-01", "max": "2001-06-30"}),
        ],
        "in_set": [
            Check("stg_products", "in_set", "color",
                  {"values": ["economy", "promo", "large", "standard", "medium", "Unknown"]}),
            Check("int_customer_orders", "in_set", "order_status_code", {"values": [1, 2, 5]}),
            # the source database compares text ignoring case and trailing blanks
            Check("src_product", "in_set", "ProductLine",
                  {"values": ["r", "m", "t", "s"], "case_insensitive": True}),
        ],
        "row_count": [Check(m, "row_count_between", None, {"min": 1, "max": None}) for m in models]
        + [Check("stg_products", "row_count_between", None, {"min": 1, "max": 1000, "name": "at_most_1000"})],
        "mean": [
            Check("stg_sales_orders", "mean_between", "unit_price_discount", {"min": 0, "max": 0.1}),
            Check("fct_sales_summary", "mean_between", "total_orders", {"min": 10, "max": None}),
        ],
        "non_negative": [
            Check("int_product_sales", "non_negative", "unit_profit"),
            Check("int_product_sales", "non_negative", "line_profit"),
            Check("stg_sales_orders", "non_negative", "order_freight"),
        ],
        "email": [Check("src_person", "like", "EmailAddress", {"pattern": "%_@__%.__%"})],
        "orphans": [
            Check("int_product_sales", "orphans", None,
                  {"columns": ["sales_order_id", "customer_id"], "to": "int_customer_orders"}),
        ],
        "smoke": smoke_checks(),
        "contract": expand_contract(CONTRACT)[0],
    }


def smoke_checks() -> list[Check]:
    """DQ-24: each mart exists, has rows, has no NULL key, and is recent enough."""
    out = []
    for model, key, newest, hours in (
            ("fct_sales_summary", "order_date", "order_date", 24),
            ("dim_customer_metrics", "customer_id", "last_order_date", 168),
            ("fct_product_performance", "product_id", "last_sale_date", 24)):
        out += [Check(model, "table_exists"),
                Check(model, "row_count_between", None, {"min": 1, "max": None}),
                Check(model, "not_null", key),
                Check(model, "recency", newest, {"count": hours, "period": "hour"})]
    return out


def release_checks() -> list[Check]:
    """What a staged build must pass to go live: the smoke checks but recency, and unique mart keys."""
    return [c for c in smoke_checks() if c.kind != "recency"] + [
        Check("dim_customer_metrics", "unique", "customer_id"), Check("fct_sales_summary", "unique", "order_date")]


# DQ-25: a data contract — per column type, required, unique, min/max, allowed
# values — plus table freshness and completeness (values of the guide's example).
CONTRACT = {
    "model": "dim_customer_metrics",
    "freshness": {"column": "last_order_date", "hours": 24},
    "completeness": 0.99,
    "columns": {
        "customer_id": {"type": "bigint", "required": True, "unique": True},
        "account_number": {"type": "string", "required": True, "unique": True},
        "total_lifetime_revenue": {"type": "decimal(38,6)", "required": True, "min": 0},
        "rfm_score": {"type": "int", "required": True, "min": 3, "max": 15},
        "customer_segment": {"type": "string", "required": True,
                             "allowed": ["Champion", "Loyal Customer", "Potential Loyalist", "At Risk",
                                         "Lost", "New Customer", "Regular"]},
        "avg_profit_margin_pct": {"type": "double"},
    },
}


def expand_contract(contract: dict) -> tuple[list[Check], list[Check]]:
    """Contract → (data checks, schema checks)."""
    m = contract["model"]
    data, schema = [], []
    for col, spec in contract["columns"].items():
        schema.append(Check(m, "column_exists", col))
        if "type" in spec:
            schema.append(Check(m, "column_type", col, {"type": spec["type"]}))
        if spec.get("required"):
            data.append(Check(m, "not_null", col))
        if spec.get("unique"):
            data.append(Check(m, "unique", col))
        if "min" in spec or "max" in spec:
            data.append(Check(m, "accepted_range", col, {"min": spec.get("min"), "max": spec.get("max")}))
        if "allowed" in spec:
            data.append(Check(m, "accepted_values", col, {"values": spec["allowed"]}))
        if contract.get("completeness") is not None:
            data.append(Check(m, "completeness", col, {"min_share": contract["completeness"]}))
    f = contract.get("freshness")
    if f:
        data.append(Check(m, "recency", f["column"], {"count": f["hours"], "period": "hour"}))
    return data, schema


# DQ-26: the guide's two expectation suites, as named check lists on the sources
# (fixed values: thresholds as written in the guide).
SUITES = {
    "customer_quality_suite": [
        Check("src_customer", "row_count_between", None, {"min": 100, "max": 100000}),
        Check("src_customer", "column_exists", "CustomerID"),
        Check("src_customer", "unique", "CustomerID"),
        Check("src_customer", "not_null", "CustomerID"),
        Check("src_customer", "not_null", "AccountNumber"),
    ],
    "sales_order_quality_suite": [
        Check("src_header", "unique", "SalesOrderID"),
        Check("src_header", "not_null", "SalesOrderID"),
        Check("src_header", "between", "TotalDue", {"min": 0, "max": 1000000}),
        Check("src_header", "not_null", "OrderDate"),
    ],
}
