"""SQL rendering of data-quality checks (each check = one failing-rows count)."""

from __future__ import annotations

from oracle_sql.base import AS_OF, with_models
from oracle_sql.marts import CUSTOMER, DAILY, PRODUCT

BOOL_COLUMNS = {"make_flag", "finished_goods_flag", "is_online_order"}


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def _in_list(col: str, values, case_insensitive: bool = False) -> str:
    c = f"CAST({col} AS INTEGER)" if col in BOOL_COLUMNS else col
    if case_insensitive:
        vals = ", ".join(_lit(str(v).rstrip().upper()) for v in values)
        return f"upper(rtrim({c})) IN ({vals})"
    return f"{c} IN ({', '.join(_lit(v) for v in values)})"


def fail_sql(chk) -> str:
    p, k, c = chk.params, chk.kind, chk.column
    if k == "not_null":
        return f"{c} IS NULL"
    if k in ("accepted_range", "between"):
        parts = []
        if p.get("min") is not None:
            parts.append(f"{c} < {_lit(p['min'])}")
        if p.get("max") is not None:
            parts.append(f"{c} > {_lit(p['max'])}")
        return " OR ".join(parts) or "FALSE"
    if k == "is_positive":
        return f"{c} <= 0"
    if k == "non_negative":
        return f"{c} < 0"
    if k == "no_future_dates":
        return f"{c} > DATE '{AS_OF}'"
    if k == "valid_date_range":
        s, e = p["start"], p["end"]
        return f"{s} IS NOT NULL AND {e} IS NOT NULL AND CAST({s} AS DATE) > CAST({e} AS DATE)"
    if k == "regex":
        return f"NOT regexp_matches({c}, {_lit(p['pattern'])})"
    if k == "like":
        return f"NOT ({c} LIKE {_lit(p['pattern'])})"
    if k == "in_set":
        return f"NOT ({_in_list(c, p['values'], p.get('case_insensitive', False))})"
    raise ValueError(k)


def count_sql(chk) -> str:
    """SQL returning one number: the failures of ``chk``."""
    p, k, m, c = chk.params, chk.kind, chk.model, chk.column
    if k in ("not_null", "accepted_range", "between", "is_positive", "non_negative",
             "no_future_dates", "valid_date_range", "regex", "like", "in_set"):
        return f"SELECT count(*) FROM {m} WHERE {fail_sql(chk)}"
    if k == "unique":
        return (f"SELECT count(*) FROM (SELECT {c} FROM {m} WHERE {c} IS NOT NULL "
                f"GROUP BY {c} HAVING count(*) > 1)")
    if k in ("unique_combination", "duplicates"):
        cols = ", ".join(p["columns"])
        return f"SELECT count(*) FROM (SELECT {cols} FROM {m} GROUP BY {cols} HAVING count(*) > 1)"
    if k == "accepted_values":
        return (f"SELECT count(*) FROM (SELECT {c} FROM {m} WHERE {c} IS NOT NULL "
                f"AND NOT ({_in_list(c, p['values'], p.get('case_insensitive', False))}) GROUP BY {c})")
    if k == "relationships":
        return (f"SELECT count(*) FROM {m} child LEFT JOIN (SELECT DISTINCT {p['field']} AS k FROM {p['to']}) par "
                f"ON child.{c} = par.k WHERE child.{c} IS NOT NULL AND par.k IS NULL")
    if k == "orphans":
        cols, fields = p["columns"], p.get("fields", p["columns"])
        sel = ", ".join(f"{f} AS k{i}" for i, f in enumerate(fields))
        on = " AND ".join(f"child.{col} = par.k{i}" for i, col in enumerate(cols))
        nn = " AND ".join(f"child.{col} IS NOT NULL" for col in cols)
        return (f"SELECT count(*) FROM {m} child LEFT JOIN (SELECT DISTINCT {sel} FROM {p['to']}) par "
                f"ON {on} WHERE {nn} AND par.k0 IS NULL")
    if k == "row_count_between":
        conds = []
        if p.get("min") is not None:
            conds.append(f"count(*) < {p['min']}")
        if p.get("max") is not None:
            conds.append(f"count(*) > {p['max']}")
        return f"SELECT CASE WHEN {' OR '.join(conds)} THEN 1 ELSE 0 END FROM {m}"
    if k == "column_exists":
        return f"SELECT count(*) * 0 FROM (SELECT {c} FROM {m} LIMIT 0)"
    if k == "table_exists":
        return f"SELECT 0 FROM (SELECT count(*) FROM {m})"
    if k == "mean_between":
        mean = f"(CAST(SUM({c}) AS DOUBLE) / COUNT({c}))"
        conds = []
        if p.get("min") is not None:
            conds.append(f"{mean} < {p['min']}")
        if p.get("max") is not None:
            conds.append(f"{mean} > {p['max']}")
        return f"SELECT CASE WHEN {' OR '.join(conds)} THEN 1 ELSE 0 END FROM {m}"
    if k == "recency":
        period = p.get("period", "day").upper()
        return (f"SELECT CASE WHEN max({c}) IS NULL OR CAST(max({c}) AS TIMESTAMP) < "
                f"TIMESTAMP '{AS_OF} 00:00:00' - INTERVAL {int(p['count'])} {period} THEN 1 ELSE 0 END FROM {m}")
    if k == "completeness":
        return (f"SELECT CASE WHEN count(*) = 0 OR CAST(count({c}) AS DOUBLE) / count(*) < {p['min_share']} "
                f"THEN 1 ELSE 0 END FROM {m}")
    if k == "equal_rowcount":
        return f"SELECT CASE WHEN (SELECT count(*) FROM {m}) <> (SELECT count(*) FROM {p['to']}) THEN 1 ELSE 0 END"
    raise ValueError(k)


def failing_sql(chk, key: str) -> str:
    """SQL returning the key of each failing row of ``chk``; none for checks of a whole table."""
    p, k, m, c = chk.params, chk.kind, chk.model, chk.column
    if k in ("unique", "unique_combination", "duplicates"):
        by = c if k == "unique" else ", ".join(p["columns"])
        seen = f" AND {c} IS NOT NULL" if k == "unique" else ""
        return f"SELECT {key} AS k FROM (SELECT *, count(*) OVER (PARTITION BY {by}) AS n FROM {m}) WHERE n > 1{seen}"
    if k == "accepted_values":
        return f"SELECT {key} AS k FROM {m} WHERE {c} IS NOT NULL AND NOT ({_in_list(c, p['values'], p.get('case_insensitive', False))})"
    if k == "relationships":
        return f"SELECT {key} AS k FROM {m} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {p['field']} FROM {p['to']} WHERE {p['field']} IS NOT NULL)"
    return f"SELECT {key} AS k FROM {m} WHERE {fail_sql(chk)}"


def results_sql(checks, extra_ctes: str = "") -> str:
    """All checks as rows (check_id, model, kind, column_name, severity, failures, status)."""
    rows = []
    for chk in checks:
        rows.append(
            f"SELECT {_lit(chk.check_id)} AS check_id, {_lit(chk.model)} AS model, {_lit(chk.kind)} AS kind, "
            f"CAST({_lit(chk.column)} AS VARCHAR) AS column_name, {_lit(chk.severity)} AS severity, "
            f"CAST(({count_sql(chk)}) AS BIGINT) AS failures")
    body = with_models(DAILY, CUSTOMER, PRODUCT, extra_ctes)
    union = "\nUNION ALL\n".join(rows)
    return (f"{body}, results AS (\n{union}\n)\n"
            "SELECT check_id, model, kind, column_name, severity, failures, "
            "CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status "
            "FROM results")
