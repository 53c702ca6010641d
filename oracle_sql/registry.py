"""All oracle SQL strings, keyed like ``queries()``."""

from __future__ import annotations

from oracle_sql.checks import results_sql
from oracle_sql.models import model_sql
from oracle_sql.guide import guide_sql
from oracle_sql.history import history_sql
from oracle_sql.streaming import streaming_sql
from oracle_sql.reports import report_sql

DQ_KINDS = ("not_null", "unique", "accepted_values", "relationships", "accepted_range",
            "is_positive", "no_future_dates", "valid_date_range")


def dq_sql() -> dict[str, str]:
    from salesmart.operators.rules import declared_checks
    out = {f"dq_{k}": results_sql(declared_checks(kinds={k})) for k in DQ_KINDS}
    out["dq_declared"] = results_sql(declared_checks())
    out["dq_summary"] = (
        "WITH r AS (" + results_sql(declared_checks()) + ") "
        "SELECT status, CAST(count(*) AS BIGINT) AS checks, CAST(sum(failures) AS BIGINT) AS failing_rows "
        "FROM r GROUP BY status")
    return out


def publish_sql() -> dict[str, str]:
    """The staged build's result: every declared check, plus the run row with the publish decision."""
    from salesmart.operators.rules import declared_checks
    r = results_sql(declared_checks())
    return {"blue_green_publish": (
        f"WITH r AS ({r}), f AS (SELECT count(*) FILTER (WHERE status = 'fail') AS n FROM r) "
        "SELECT check_id, model, kind, column_name, severity, failures, status FROM r UNION ALL "
        "SELECT 'run.v1', 'run', 'run', CAST(NULL AS VARCHAR), CASE WHEN n > 0 THEN 'error' ELSE 'info' END, "
        "CAST(n AS BIGINT), CASE WHEN n > 0 THEN 'kept_previous' ELSE 'published' END FROM f")}


_KEYS = {"fct_sales_summary": "order_date", "dim_customer_metrics": "customer_id", "fct_product_performance": "product_id"}
_SOURCES = {"customer": "src_customer", "sales_order_header": "src_header", "sales_order_detail": "src_detail",
            "product": "src_product", "product_subcategory": "src_subcategory", "product_category": "src_category",
            "person": "src_person"}


def publish_run_sql() -> str:
    """The run that goes live: smoke, key and freshness rows counted directly, then the run row."""
    from oracle_sql.base import AS_OF, with_models
    from oracle_sql.marts import CUSTOMER, DAILY, PRODUCT
    found = []
    for m, k in _KEYS.items():
        found += [(f"{m}.table_exists", m, "table_exists", None, "0"),
                  (f"{m}.row_count_between", m, "row_count_between", None, f"SELECT (count(*) = 0)::INT FROM {m}"),
                  (f"{m}.not_null.{k}", m, "not_null", k, f"SELECT count(*) FILTER (WHERE {k} IS NULL) FROM {m}")]
        if m != "fct_product_performance":
            found.append((f"{m}.unique.{k}", m, "unique", k,
                          f"SELECT count(*) FROM (SELECT 1 FROM {m} WHERE {k} IS NOT NULL GROUP BY {k} HAVING count(*) > 1)"))
    rows = [f"SELECT '{i}' AS check_id, '{m}' AS model, '{kind}' AS kind, {repr(c) if c else 'NULL'}::VARCHAR AS column_name, "
            f"'error' AS severity, ({n})::BIGINT AS failures" for i, m, kind, c, n in found]
    rows += [f"SELECT 'source.{t}.freshness', '{t}', 'freshness', 'loaded_at', CASE WHEN age > 12 AND age <= 24 * 3650 THEN 'warn' "
             f"ELSE 'error' END, (age IS NULL OR age > 12)::BIGINT FROM (SELECT date_diff('second', max(ModifiedDate)::TIMESTAMP, "
             f"TIMESTAMP '{AS_OF} 00:00:00') / 3600 AS age FROM {src})" for t, src in _SOURCES.items()]
    return (with_models(DAILY, CUSTOMER, PRODUCT) + ", r AS (" + " UNION ALL ".join(rows) + "), s AS (SELECT *, CASE WHEN failures = 0 "
            "THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status FROM r) SELECT * FROM s UNION ALL "
            "SELECT 'run.v1', 'run', 'run', NULL, CASE WHEN n > 0 THEN 'error' ELSE 'info' END, n, "
            "CASE WHEN n > 0 THEN 'kept_previous' ELSE 'published' END FROM (SELECT count(*) FILTER (WHERE status = 'fail') AS n FROM s)")


_TYPES = {"customer_id": "BIGINT", "account_number": "VARCHAR", "total_lifetime_revenue": "DECIMAL(38,6)",
          "rfm_score": "INTEGER", "customer_segment": "VARCHAR", "avg_profit_margin_pct": "DOUBLE"}


def schema_sql() -> str:
    """The contract's columns by the types that the mart's SQL has."""
    from oracle_sql.base import with_models
    from oracle_sql.marts import CUSTOMER
    m = "dim_customer_metrics"
    rows = []
    for c, kind in _TYPES.items():
        rows += [f"SELECT '{m}.{k}.{c}' AS check_id, '{m}' AS model, '{k}' AS kind, '{c}' AS column_name, 'error' AS severity, "
                 f"({bad})::BIGINT AS failures FROM (SELECT any_value({c}) AS v FROM {m})"
                 for k, bad in (("column_exists", "0"), ("column_type", f"typeof(v) <> '{kind}'"))]
    return (with_models(CUSTOMER) + ", r AS (" + " UNION ALL ".join(rows)
            + ") SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM r")


_ROW_KEYS = _KEYS | {"stg_customers": "customer_id", "stg_products": "product_id", "stg_sales_orders": "sales_order_detail_id",
                     "int_customer_orders": "sales_order_id", "int_product_sales": "sales_order_detail_id"}


def failing_rows_sql() -> str:
    """The rows that break each declared check, selected directly."""
    from oracle_sql.base import with_models
    from oracle_sql.checks import failing_sql
    from oracle_sql.marts import CUSTOMER, DAILY, PRODUCT
    from salesmart.operators.rules import declared_checks
    return with_models(DAILY, CUSTOMER, PRODUCT) + " " + " UNION ALL ".join(
        f"SELECT '{c.check_id}' AS check_id, k::VARCHAR AS row_key FROM ({failing_sql(c, _ROW_KEYS[c.model])})"
        for c in declared_checks())


def isolated_sql() -> str:
    """Counts of the checks that can be evaluated, and the fixed results of the others."""
    from oracle_sql.base import with_models
    rows = [("stg_customers", "not_null", "customer_id", "error", "(SELECT count(*) FROM stg_customers WHERE customer_id IS NULL)"),
            ("stg_customers", "not_null", "fax_number", "error", "NULL"), ("stg_customers", "unique", "fax_number", "error", "NULL"),
            ("stg_customers", "unique", "customer_id", "error",
             "(SELECT count(*) FROM (SELECT 1 FROM stg_customers WHERE customer_id IS NOT NULL GROUP BY customer_id HAVING count(*) > 1))"),
            ("int_product_sales", "unique", "product_sale_surrogate_key", "error",
             "(SELECT count(*) - count(DISTINCT k) FROM (SELECT product_sale_surrogate_key AS k, row_number() OVER (PARTITION BY "
             "product_sale_surrogate_key) AS n FROM int_product_sales QUALIFY n <= 2))"),
            ("int_product_sales", "is_positive", "line_profit", "warn", "(SELECT count(*) FROM int_product_sales WHERE line_profit <= 0)"),
            ("stg_products", "table_exists", None, "error", "1"), ("no_such_model", "table_exists", None, "error", "1")]
    parts = [f"SELECT '{'.'.join(x for x in (m, k, c) if x)}' AS check_id, '{m}' AS model, '{k}' AS kind, "
             f"{repr(c) if c else 'NULL'}::VARCHAR AS column_name, '{sev}' AS severity, ({n})::BIGINT AS failures"
             for m, k, c, sev, n in rows]
    return (with_models() + ", r AS (" + " UNION ALL ".join(parts) + ") SELECT *, CASE WHEN failures IS NULL THEN 'error' "
            "WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status FROM r")


def history_sql_of_checks() -> str:
    """The four checks counted on all lines, and on the lines without every third order since 2000."""
    from oracle_sql.base import with_models
    counts = {"is_positive.line_profit": "count(*) FILTER (WHERE line_profit <= 0)",
              "not_null.color": "count(*) FILTER (WHERE color IS NULL)", "not_null.ship_date": "count(*) FILTER (WHERE ship_date IS NULL)",
              "unique.product_sale_surrogate_key": "0"}
    old = "(SELECT * FROM int_product_sales WHERE order_date < DATE '2000-01-01' OR sales_order_id % 3 <> 0)"
    repeated = ("(SELECT count(*) FROM (SELECT 1 FROM {0} GROUP BY product_sale_surrogate_key HAVING count(*) > 1))")
    parts = []
    for name, count in counts.items():
        a, b = ((repeated.format(t) for t in (old, "int_product_sales")) if name.startswith("unique")
                else (f"(SELECT {count} FROM {t})" for t in (old, "int_product_sales")))
        parts.append(f"SELECT 'int_product_sales.{name}' AS check_id, {a}::BIGINT AS a, {b}::BIGINT AS b")
    state = "CASE WHEN {0} = 0 THEN 'pass' ELSE 'fail' END"
    return (with_models() + ", n AS (" + " UNION ALL ".join(parts) + ") SELECT 'r1' AS run, '2001-08-14 00:00:00' AS run_at, check_id, "
            f"{state.format('a')} AS status, a AS failures, NULL::BIGINT AS previous_failures, NULL::BIGINT AS change, 'first' AS trend FROM n "
            f"UNION ALL SELECT 'r2', '2001-08-15 00:00:00', check_id, {state.format('b')}, b, a, b - a, CASE WHEN a > 0 AND b = 0 THEN 'fixed' "
            "WHEN a = 0 AND b > 0 THEN 'broken' WHEN b < a THEN 'better' WHEN b > a THEN 'worse' ELSE 'same' END FROM n")


def publish_declared_sql() -> str:
    """Every declared check and source passes, the run is published, and the clean lines are live."""
    from oracle_sql.base import with_models
    from salesmart.operators.rules import declared_checks
    rows = [f"SELECT '{c.check_id}' AS check_id, '{c.model}' AS model, '{c.kind}' AS kind, "
            f"{repr(c.column) if c.column else 'NULL'}::VARCHAR AS column_name, '{c.severity}' AS severity, 0::BIGINT AS failures, "
            "'pass' AS status" for c in declared_checks()]
    rows += [f"SELECT 'source.{t}.freshness', '{t}', 'freshness', 'loaded_at', 'error', 0, 'pass'" for t in _SOURCES]
    rows.append("SELECT 'run.v1', 'run', 'run', NULL, 'info', 0, 'published'")
    at = "TIMESTAMP '2001-08-14 18:00:00'"
    rows.append(
        "SELECT 'live.int_product_sales', 'int_product_sales', 'live', NULL, 'info', (SELECT count(*) FROM (SELECT DISTINCT "
        "d.SalesOrderID, d.ProductID FROM src_detail d JOIN src_header h USING (SalesOrderID) JOIN src_customer c USING (CustomerID) "
        "JOIN src_product p USING (ProductID) WHERE c.PersonID IS NOT NULL AND h.Status = 5 AND h.TaxAmt > 0 "
        f"AND h.DueDate <= {at} AND h.ShipDate <= {at} AND p.SellStartDate <= {at})), 'rows'")
    return with_models() + " " + " UNION ALL ".join(rows)


def collation_sql() -> dict[str, str]:
    """Text compared in small letters; a product's spelling does not matter, nor does an account's."""
    from oracle_sql.base import project, with_models
    again = "(SELECT count(*) FROM (SELECT 1 FROM stg_products WHERE {0} IS NOT NULL GROUP BY lower({0}) HAVING count(*) > 1))"
    no_account = "(customer_id % 5 = 0 OR customer_id NOT IN (SELECT CustomerID FROM src_customer))"
    found = [("stg_products", "unique", c, again.format(c)) for c in ("product_name", "product_number", "color")]
    found += [("stg_products", "accepted_values", "color", "(SELECT count(DISTINCT lower(color)) FROM stg_products WHERE lower(color) <> 'unknown')"),
              ("stg_sales_orders", "relationships", "account_number", f"(SELECT count(*) FROM stg_sales_orders WHERE {no_account})")]
    rows = [f"SELECT '{m}.{k}.{c}' AS check_id, '{m}' AS model, '{k}' AS kind, '{c}' AS column_name, 'error' AS severity, ({n})::BIGINT "
            "AS failures" for m, k, c, n in found]
    return {"dq_collation": with_models() + ", r AS (" + " UNION ALL ".join(rows) + ") SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE "
            "'fail' END AS status FROM r",
            "color_sales": project(with_models(f"""q AS (SELECT lower(color) AS color, count(*) AS n_lines, sum(line_total) AS revenue
              FROM int_product_sales WHERE NOT {no_account} GROUP BY 1)"""), "color:s n_lines:i revenue:d")}


def all_sql() -> dict[str, str]:
    out = {}
    out.update(model_sql())
    out.update(dq_sql())
    out.update(report_sql())
    out.update(guide_sql())
    out.update(history_sql())
    out.update(streaming_sql())
    out.update(publish_sql())
    out["publish_run"] = publish_run_sql()
    out["publish_declared"] = publish_declared_sql()
    out["dq_schema"] = schema_sql()
    out["dq_failing_rows"] = failing_rows_sql()
    out["dq_isolated"] = isolated_sql()
    out.update(collation_sql())
    out["dq_history"] = history_sql_of_checks()
    return out
