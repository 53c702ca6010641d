"""SQL twins of the streaming queries (the batch aggregate they must equal)."""

from __future__ import annotations

from oracle_sql.base import project

_DAILY = """WITH q AS (
  SELECT CAST(ts AS DATE) AS event_date, event_type, count(*) AS events,
         CAST(round(CAST(sum(CAST(value AS DECIMAL(18,6))) AS DECIMAL(24,6)) * 100) AS BIGINT) AS value_cents, max(value) AS max_value
  FROM events GROUP BY 1, 2)"""
_USERS = _DAILY.replace("max(value) AS max_value",
                        "max(value) AS max_value, count(DISTINCT user_id) AS users, true AS within_bound")
_KINDS = "event_date:dt event_type:s events:i value_cents:i max_value:d"


def streaming_sql() -> dict[str, str]:
    return {
        "speed_view": project(_DAILY, _KINDS),
        "speed_view_approx": project(_USERS, _KINDS + " users:i within_bound:b"),
        "serving_view": project(_DAILY + """, served AS (
          SELECT *, CASE WHEN event_date <= DATE '2024-01-15' THEN 'batch' ELSE 'speed' END AS layer FROM q)""",
                                _KINDS + " layer:s", source="served"),
        # the last of four files brings every seventh event of the first third of the days
        "late_events_report": project("""WITH d AS (
          SELECT min(CAST(ts AS DATE)) AS first_day, max(CAST(ts AS DATE)) - min(CAST(ts AS DATE)) AS days FROM events),
        q AS (SELECT CAST(ts AS DATE) AS event_date, event_type, count(*) AS late, true AS explained FROM events, d
          WHERE event_id % 7 = 0 AND CAST(ts AS DATE) < first_day + CAST(days // 3 AS INTEGER) GROUP BY 1, 2)""",
            "event_date:dt event_type:s late:i explained:b"),
        "users_by_range": project("""WITH q AS (
          SELECT date_trunc('month', ts)::DATE AS first_date, last_day(ts) AS last_date, count(DISTINCT user_id) AS users,
                 true AS within_bound FROM events GROUP BY 1, 2
          UNION ALL SELECT min(ts)::DATE, max(ts)::DATE, count(DISTINCT user_id), true FROM events)""",
            "first_date:dt last_date:dt users:i within_bound:b"),
        "dedup_events": project(
            "WITH q AS (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts) = 1)",
            "event_id:i ts:ts user_id:i event_type:s value:d props:s"),
    }
