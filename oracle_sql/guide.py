"""SQL twins of the guide-level checks, freshness and duplicates."""

from __future__ import annotations

from oracle_sql.base import AS_OF, project, with_models
from oracle_sql.checks import results_sql
from oracle_sql.marts import CUSTOMER, DAILY, PRODUCT

CTE_OF = {"customer": "src_customer", "person": "src_person", "sales_order_header": "src_header",
          "sales_order_detail": "src_detail", "product": "src_product",
          "product_subcategory": "src_subcategory", "product_category": "src_category"}


def freshness_sql(rules: dict[str, tuple[str, float, float]]) -> str:
    """rules: table → (source, warn_hours, error_hours)."""
    parts = []
    for table, (source, warn, err) in rules.items():
        age = f"(CAST(date_diff('second', max(ModifiedDate), TIMESTAMP '{AS_OF} 00:00:00') AS DOUBLE) / 3600.0)"
        parts.append(
            f"SELECT '{source}' AS source, '{table}' AS table_name, max(ModifiedDate) AS max_loaded_at, "
            f"{age} AS age_hours, CAST({warn} AS DOUBLE) AS warn_after_hours, "
            f"CAST({err} AS DOUBLE) AS error_after_hours, "
            f"CASE WHEN max(ModifiedDate) IS NULL THEN 'error' WHEN {age} > {float(err)} THEN 'error' "
            f"WHEN {age} > {float(warn)} THEN 'warn' ELSE 'pass' END AS status FROM {CTE_OF[table]}")
    body = with_models(f"q AS ({' UNION ALL '.join(parts)})")
    return project(body, "source:s table_name:s max_loaded_at:ts age_hours:d warn_after_hours:d "
                         "error_after_hours:d status:s")


def guide_sql() -> dict[str, str]:
    from salesmart.operators.rules import guide_checks
    from salesmart.sources.freshness import GUIDE_DEFAULT, GUIDE_OVERRIDES, SOURCE_OF
    out = {f"dq_{g}": results_sql(cs) for g, cs in guide_checks().items()}
    from salesmart.operators.rules import SUITES
    out["dq_suite"] = " UNION ALL ".join(
        f"SELECT *, '{name}' AS suite, count(*) FILTER (WHERE status = 'fail') OVER () = 0 AS suite_passed FROM ({results_sql(checks)})" for name, checks in SUITES.items())
    out["dq_freshness"] = freshness_sql({t: (SOURCE_OF[t], 12, 24) for t in SOURCE_OF})
    out["dq_freshness_override"] = freshness_sql(
        {t: (SOURCE_OF[t], *GUIDE_OVERRIDES.get(t, (GUIDE_DEFAULT.warn_hours, GUIDE_DEFAULT.error_hours)))
         for t in SOURCE_OF})
    out["dq_duplicates"] = project(
        with_models(DAILY, CUSTOMER, PRODUCT,
                    "q AS (SELECT product_id, order_date, sales_order_id, count(*) AS dup_count "
                    "FROM int_product_sales GROUP BY 1, 2, 3 HAVING count(*) > 1)"),
        "product_id:i order_date:dt sales_order_id:i dup_count:i")
    return out
