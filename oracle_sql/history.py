"""SQL twins of the history (SCD) and incremental queries."""

from __future__ import annotations

from oracle_sql.base import project, with_models

SNAPS = """
snap1 AS (
  SELECT c_custkey AS customer_id, c_name AS name, 'customer' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
         c_mktsegment AS segment, TIMESTAMP '2001-01-01 00:00:00' AS updated_at
  FROM customer WHERE c_custkey % 10 <> 9
),
snap2 AS (
  SELECT c_custkey AS customer_id, c_name AS name,
         CASE WHEN c_custkey % 5 = 0 THEN 'customer' || CAST(c_custkey AS VARCHAR) || '@new.example.com'
              ELSE 'customer' || CAST(c_custkey AS VARCHAR) || '@example.com' END AS email,
         CASE WHEN c_custkey % 4 = 0 THEN 'AUTOMOBILE' ELSE c_mktsegment END AS segment,
         CASE WHEN c_custkey % 10 = 9 OR c_custkey % 5 = 0 OR (c_custkey % 4 = 0 AND c_mktsegment <> 'AUTOMOBILE')
              THEN TIMESTAMP '2001-06-01 00:00:00' ELSE TIMESTAMP '2001-01-01 00:00:00' END AS updated_at
  FROM customer WHERE c_custkey % 10 <> 8
)"""

SNAP_KINDS = "customer_id:i name:s email:s segment:s updated_at:ts"
SCD2_KINDS = "customer_id:i name:s email:s segment:s valid_from:ts valid_to:ts is_current:b"

SCD2 = """
versions AS (SELECT DISTINCT * FROM (SELECT * FROM snap1 UNION ALL SELECT * FROM snap2)),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY updated_at) AS rn,
         lag(name) OVER (PARTITION BY customer_id ORDER BY updated_at) AS p_name,
         lag(email) OVER (PARTITION BY customer_id ORDER BY updated_at) AS p_email,
         lag(segment) OVER (PARTITION BY customer_id ORDER BY updated_at) AS p_segment
  FROM versions
),
kept AS (
  SELECT * FROM ordered
  WHERE rn = 1 OR name IS DISTINCT FROM p_name OR email IS DISTINCT FROM p_email
        OR segment IS DISTINCT FROM p_segment
),
q AS (
  SELECT customer_id, name, email, segment, updated_at AS valid_from,
         lead(updated_at) OVER (PARTITION BY customer_id ORDER BY updated_at) AS valid_to,
         lead(updated_at) OVER (PARTITION BY customer_id ORDER BY updated_at) IS NULL AS is_current
  FROM kept
)"""

#: Case by case: a customer is in the first snapshot, changed by the second, in the late one, or any of these.
SCD2_LATE = """
state AS (
  SELECT c_custkey AS customer_id, c_custkey % 10 <> 9 AS early, c_custkey % 10 <> 9 AND c_custkey % 6 = 0 AS late,
         c_custkey % 10 <> 8 AND (c_custkey % 10 = 9 OR c_custkey % 5 = 0 OR (c_custkey % 4 = 0 AND c_mktsegment <> 'AUTOMOBILE'))
           AS second,
         c_name AS name, 'customer' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email, c_mktsegment AS segment,
         CASE WHEN c_custkey % 5 = 0 THEN 'customer' || CAST(c_custkey AS VARCHAR) || '@new.example.com'
              ELSE 'customer' || CAST(c_custkey AS VARCHAR) || '@example.com' END AS email2,
         CASE WHEN c_custkey % 4 = 0 THEN 'AUTOMOBILE' ELSE c_mktsegment END AS segment2
  FROM customer
),
q AS (
  SELECT customer_id, name, email, segment, TIMESTAMP '2001-01-01 00:00:00' AS valid_from,
         CASE WHEN late THEN TIMESTAMP '2001-03-01 00:00:00' WHEN second THEN TIMESTAMP '2001-06-01 00:00:00' END AS valid_to,
         NOT (late OR second) AS is_current FROM state WHERE early
  UNION ALL
  SELECT customer_id, name, email, 'LATE', TIMESTAMP '2001-03-01 00:00:00',
         CASE WHEN second THEN TIMESTAMP '2001-06-01 00:00:00' END, NOT second FROM state WHERE late
  UNION ALL
  SELECT customer_id, name, email2, segment2, TIMESTAMP '2001-06-01 00:00:00', NULL, true FROM state WHERE second
)"""

_CHANGED = ("(o.name IS DISTINCT FROM n.name OR o.email IS DISTINCT FROM n.email "
            "OR o.segment IS DISTINCT FROM n.segment)")


def history_sql() -> dict[str, str]:
    def w(*ctes):
        return "WITH " + ",".join((SNAPS,) + ctes)

    out = {
        "scd0": project(w("q AS (SELECT * FROM snap1 UNION ALL SELECT * FROM snap2 "
                          "WHERE customer_id NOT IN (SELECT customer_id FROM snap1))"), SNAP_KINDS),
        "scd1": project(w("q AS (SELECT * FROM snap2 UNION ALL SELECT * FROM snap1 "
                          "WHERE customer_id NOT IN (SELECT customer_id FROM snap2))"), SNAP_KINDS),
        "scd2": project(w(SCD2), SCD2_KINDS),
        "scd2_merge": project(w(SCD2_LATE), SCD2_KINDS),
        "scd2_blocks": project("""WITH v AS (
            SELECT user_id, event_type, ts FROM events UNION ALL SELECT -1, event_type, ts FROM events),
          i AS (SELECT user_id, ts, max(event_type) AS last_event FROM v GROUP BY 1, 2),
          c AS (SELECT *, lag(last_event) OVER w IS NOT DISTINCT FROM last_event AND row_number() OVER w > 1 AS same
                FROM i WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
          q AS (SELECT user_id, last_event, ts AS valid_from, lead(ts) OVER w AS valid_to, lead(ts) OVER w IS NULL AS is_current
                FROM c WHERE NOT same WINDOW w AS (PARTITION BY user_id ORDER BY ts))""",
            "user_id:i last_event:s valid_from:ts valid_to:ts is_current:b"),
        "scd3": project(w("""q AS (
            SELECT COALESCE(n.customer_id, o.customer_id) AS customer_id,
                   COALESCE(n.email, o.email) AS current_email,
                   CASE WHEN n.customer_id IS NOT NULL AND o.customer_id IS NOT NULL
                             AND n.email IS DISTINCT FROM o.email THEN o.email END AS previous_email
            FROM snap1 o FULL OUTER JOIN snap2 n ON o.customer_id = n.customer_id)"""),
            "customer_id:i current_email:s previous_email:s"),
        "scd4_current": project(w("q AS (SELECT * FROM snap2 UNION ALL SELECT * FROM snap1 "
                                  "WHERE customer_id NOT IN (SELECT customer_id FROM snap2))"), SNAP_KINDS),
        "scd4_history": project(w(f"""q AS (
            SELECT o.customer_id, o.name, o.email, o.segment, o.updated_at AS valid_from, n.updated_at AS valid_to
            FROM snap1 o JOIN snap2 n ON o.customer_id = n.customer_id WHERE {_CHANGED})"""),
            "customer_id:i name:s email:s segment:s valid_from:ts valid_to:ts"),
    }
    # the end state of every order, without any merge
    final = with_models("""h AS (
          SELECT *, year(OrderDate) AS y, ModifiedDate <= TIMESTAMP '1999-12-31 00:00:00' AS loaded FROM src_header),
        q AS (
          SELECT SalesOrderID, TotalDue,
                 CASE WHEN loaded AND SalesOrderID % 14 = 0 THEN 3 WHEN loaded AND SalesOrderID % 7 = 0 THEN 6 ELSE Status END AS Status,
                 CASE WHEN loaded AND SalesOrderID % 14 = 0 THEN TIMESTAMP '2002-02-01 00:00:00'
                      WHEN loaded AND SalesOrderID % 7 = 0 THEN TIMESTAMP '2002-01-01 00:00:00' ELSE ModifiedDate END AS ModifiedDate,
                 CASE WHEN loaded AND SalesOrderID % 21 = 0 THEN y + 1 ELSE y END AS order_year
          FROM h)""")
    for name in ("incremental_merge", "incremental_partitioned"):
        out[name] = project(final, "SalesOrderID:i Status:i TotalDue:d ModifiedDate:ts order_year:i")
    return out
