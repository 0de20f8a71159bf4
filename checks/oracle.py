"""DuckDB SQL for the registered queries, written on the tables alone."""

from __future__ import annotations

HALF_HOUR = 1800
DAY = 86_400

RAW_SQL = """
raw AS (
  SELECT event_id,
         CASE WHEN event_id % 97 = 0 THEN 'not-a-time'
              ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') || ' UTC' END AS event_time,
         event_type,
         json_extract_string(props, '$.k') AS product_id,
         CASE WHEN event_id % 83 = 0 THEN ''
              ELSE CAST(event_id % 25 AS VARCHAR) END AS category_id,
         CASE WHEN event_id % 5 <> 0
              THEN 'cat.' || CAST(event_id % 7 AS VARCHAR) END AS category_code,
         CASE WHEN event_id % 3 <> 0
              THEN 'brand' || CAST(event_id % 11 AS VARCHAR) END AS brand,
         value AS price,
         CASE WHEN event_id % 89 = 0 THEN 'u' ELSE '' END
           || CAST(user_id AS VARCHAR) AS user_id,
         CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y-%m-%d') AS user_session
  FROM events)"""

TYPED_SQL = f"""{RAW_SQL},
typed AS (
  SELECT event_id, event_type, category_code, brand, price,
         user_session AS source_user_session,
         TRY_CAST(replace(event_time, ' UTC', '') AS TIMESTAMP) AS event_time_utc,
         TRY_CAST(product_id AS BIGINT) AS product_id,
         TRY_CAST(category_id AS BIGINT) AS category_id,
         TRY_CAST(user_id AS BIGINT) AS user_id
  FROM raw)"""

CLEAN_SQL = f"""{TYPED_SQL},
clean AS (
  SELECT *, event_time_utc + INTERVAL 9 HOUR AS event_time_kst,
         CAST(event_time_utc + INTERVAL 9 HOUR AS DATE) AS event_date_kst
  FROM typed WHERE event_time_utc IS NOT NULL AND user_id IS NOT NULL)"""


def _exact(user: str = "user_id") -> str:
    return f"""
clean AS (
  SELECT event_id, ts AS event_time_utc, event_type,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id,
         {user} AS user_id, CAST(ts + INTERVAL 9 HOUR AS DATE) AS event_date_kst
  FROM events)"""


EXACT_SQL = _exact()
HEAVY_SQL = _exact("CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END")

_ORDER = (
    "PARTITION BY user_id ORDER BY event_time_utc, event_type NULLS FIRST, "
    "product_id NULLS FIRST, event_id"
)


def _whole(column: str) -> str:
    return f"epoch_us({column}) // 1000000"


def _cut(source: str, gap: int, rows: str = "TRUE") -> str:
    """``source`` plus the session columns of each event, as ``cut``."""
    return f"""{source},
paced AS (
  SELECT *, lag(event_time_utc) OVER ({_ORDER}) AS before FROM clean WHERE {rows}),
opened AS (
  SELECT *, CASE WHEN {_whole('event_time_utc')} - {_whole('before')} < {gap}
                 THEN NULL ELSE event_time_utc END AS opening FROM paced),
cut AS (
  SELECT *, max(opening) OVER ({_ORDER} ROWS UNBOUNDED PRECEDING) AS session_start_utc,
         count(opening) OVER ({_ORDER} ROWS UNBOUNDED PRECEDING) AS session_seq
  FROM opened),
named AS (
  SELECT *, CAST(user_id AS VARCHAR) || '_'
            || CAST({_whole('session_start_utc')} AS VARCHAR) AS session_id
  FROM cut)"""


_SILVER = (
    "event_id, event_time_utc, event_time_kst, event_type, product_id, category_id, "
    "category_code, brand, price, user_id, source_user_session, session_id, "
    "session_start_utc, event_date_kst"
)
_KEYED = "event_id, user_id, session_id, session_start_utc, event_date_kst"
_STORED = _SILVER.removeprefix("event_id, ")
_ALL_SILVER = f"WITH {_cut(CLEAN_SQL, HALF_HOUR)} SELECT {_STORED} FROM named"
_UTC_DAY = "CAST(TRY_CAST(replace(event_time, ' UTC', '') AS TIMESTAMP) AS DATE)"
_BRONZE_ROWS = (
    f"WITH {RAW_SQL} SELECT {_UTC_DAY} AS event_date_utc, count(*) AS rows "
    "FROM raw GROUP BY ALL"
)
_STORED_BRONZE = (
    f"WITH {RAW_SQL} SELECT event_time, event_type, product_id, "
    "nullif(category_id, '') AS category_id, category_code, brand, price, user_id, "
    f"user_session, {_UTC_DAY} AS event_date_utc FROM raw"
)
_WEEK = "date_trunc('week', event_date_kst)"


def _weekly(gap: int, week: str = f"CAST({_WEEK} AS DATE)", counts: str = "us") -> str:
    chosen = {
        "u": "count(DISTINCT user_id) AS wau_by_user",
        "s": "count(DISTINCT session_id) AS wau_by_session",
    }
    return (
        f"WITH {_cut(CLEAN_SQL, gap)} SELECT {week} AS week_start_date, "
        + ", ".join(chosen[c] for c in counts)
        + " FROM named GROUP BY ALL ORDER BY week_start_date"
    )


_TS_WEEK = f"CAST({_WEEK} AS TIMESTAMP)"

ORACLE: dict[str, str] = {
    "csv_scan": f"""WITH {RAW_SQL}
SELECT event_id, event_time, event_type, product_id,
       nullif(category_id, '') AS category_id, category_code, brand, price, user_id,
       user_session FROM raw""",
    "raw_events_view": f"""WITH {RAW_SQL}
SELECT event_type, brand, count(*) AS rows FROM raw GROUP BY ALL""",
    "bronze_partition_date": f"""WITH {RAW_SQL}
SELECT event_id, event_time, {_UTC_DAY} AS event_date_utc FROM raw""",
    "bronze_roundtrip": _STORED_BRONZE,
    "bronze_incremental": _STORED_BRONZE,
    "bronze_ledger": _STORED_BRONZE,
    "bronze_range_scan": f"""SELECT * FROM ({_BRONZE_ROWS})
WHERE event_date_utc BETWEEN DATE '2024-01-08' AND DATE '2024-01-20'""",
    "typed_events": f"WITH {TYPED_SQL} SELECT * FROM typed",
    "typed_events_strict": f"WITH {TYPED_SQL} SELECT * FROM typed",
    "clean_events_kst": f"""WITH {CLEAN_SQL}
SELECT event_id, event_time_utc, event_time_kst, event_date_kst FROM clean""",
    "previous_event": f"""WITH {_cut(EXACT_SQL, HALF_HOUR)}
SELECT event_id, before AS prev_event_time_utc FROM cut""",
    "previous_event_heavy": f"""WITH {_cut(HEAVY_SQL, HALF_HOUR)}
SELECT event_id, before AS prev_event_time_utc FROM cut""",
    "session_flags": f"""WITH {_cut(EXACT_SQL, HALF_HOUR)}
SELECT event_id, CAST(opening IS NOT NULL AS INTEGER) AS is_new_session FROM cut""",
    "session_numbers": f"""WITH {_cut(EXACT_SQL, HALF_HOUR)}
SELECT event_id, CAST(session_seq AS BIGINT) AS session_seq FROM cut""",
    "session_starts": f"""WITH {_cut(EXACT_SQL, HALF_HOUR)}
SELECT event_id, session_start_utc FROM cut""",
    "sessionize": f"WITH {_cut(CLEAN_SQL, 300)} SELECT {_SILVER} FROM named",
    "sessionize_30m": f"WITH {_cut(CLEAN_SQL, HALF_HOUR)} SELECT {_SILVER} FROM named",
    "sessionize_subsecond": f"WITH {_cut(EXACT_SQL, 300)} SELECT {_KEYED} FROM named",
    "sessionize_subsecond_30m": f"""WITH {_cut(EXACT_SQL, HALF_HOUR)}
SELECT {_KEYED} FROM named""",
    "sessionize_heavy": f"""WITH {_cut(HEAVY_SQL, HALF_HOUR)}
SELECT {_KEYED} FROM named""",
    "sessionize_gap1": f"WITH {_cut(HEAVY_SQL, 1)} SELECT {_KEYED} FROM named",
    "session_numbers_gap1": f"""WITH {_cut(HEAVY_SQL, 1)}
SELECT event_id, CAST(session_seq AS BIGINT) AS session_seq FROM cut""",
    "session_window_sessions": f"""WITH {_cut(EXACT_SQL, HALF_HOUR)}
SELECT user_id, session_start_utc, count(*) AS events FROM cut GROUP BY ALL""",
    "sessionize_range": f"""WITH {_cut(
        CLEAN_SQL, DAY,
        "CAST(event_time_utc AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-20'"
    )}
SELECT {_SILVER} FROM named
WHERE event_date_kst BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'""",
    "sessionize_carry": f"""WITH {_cut(CLEAN_SQL, DAY)}
SELECT {_SILVER} FROM named WHERE event_date_kst >= DATE '2024-01-16'""",
    "silver_rerun_idempotent": _ALL_SILVER,
    "silver_no_buffer": f"""WITH {_cut(
        CLEAN_SQL, HALF_HOUR,
        "CAST(event_time_utc AS DATE) BETWEEN DATE '2024-01-09' AND DATE '2024-01-20'"
    )}
SELECT {_STORED} FROM named
WHERE event_date_kst BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'""",
    "silver_partial_overwrite": f"""
SELECT * FROM ({_ALL_SILVER}) WHERE event_date_kst <> DATE '2024-01-10'
UNION ALL
SELECT * FROM (WITH {_cut(
        CLEAN_SQL, HALF_HOUR, "event_date_kst = DATE '2024-01-10' AND event_type = 'view'"
    )}
SELECT {_STORED} FROM named)""",
    "silver_empty_batch": _ALL_SILVER,
    "silver_onward_weekly": f"""WITH {_cut(CLEAN_SQL, DAY)}
SELECT user_id, event_time_utc, event_type, session_id, session_start_utc,
       event_date_kst FROM named""",
    "silver_clustered": f"WITH {_cut(CLEAN_SQL, DAY)} SELECT {_STORED} FROM named",
    "silver_published": f"WITH {_cut(CLEAN_SQL, DAY)} SELECT {_STORED} FROM named",
    "silver_late_day": f"WITH {_cut(CLEAN_SQL, DAY)} SELECT {_STORED} FROM named",
    "external_table_silver": _ALL_SILVER,
    "stream_sessions": f"""WITH {_cut(CLEAN_SQL, HALF_HOUR)}
SELECT user_id, session_start_utc, max(event_time_utc) AS session_end_utc, count(*) AS events,
       CAST(session_start_utc + INTERVAL 9 HOUR AS DATE) AS event_date_kst
FROM named GROUP BY ALL""",
    "stream_silver": _ALL_SILVER,
    "wau_by_user": _weekly(300, _TS_WEEK, "u"),
    "wau_by_session": _weekly(300, _TS_WEEK, "s"),
    "wau_across_weeks": _weekly(DAY, _TS_WEEK, "s"),
    "wau_top200": _weekly(300) + " LIMIT 200",
    "wau_gold": _weekly(HALF_HOUR),
    "wau_report": _weekly(HALF_HOUR, _TS_WEEK),
    "wau_incremental": _weekly(HALF_HOUR),
    "wau_from_state": _weekly(DAY),
    "activity_by_third": _weekly(
        DAY,
        "CAST(date_trunc('month', event_date_kst) AS DATE) "
        "+ CAST(least((day(event_date_kst) - 1) // 10, 2) * 10 AS INTEGER)",
    ).replace("week_start_date", "first_day"),
    "activity_of_range": f"""WITH {_cut(CLEAN_SQL, DAY)}
SELECT count(DISTINCT user_id) AS users, count(DISTINCT session_id) AS sessions FROM named
WHERE event_date_kst BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'""",
    "run_audit_latest": f"""
SELECT 'bronze' AS run_id, 'SUCCESS' AS status, count(*) AS row_count FROM events
UNION ALL
SELECT 'silver', 'SUCCESS', (WITH {CLEAN_SQL} SELECT count(*) FROM clean)
UNION ALL
SELECT 'gold', 'SUCCESS',
       (WITH {CLEAN_SQL} SELECT count(DISTINCT {_WEEK}) FROM clean)""",
    "run_audit_days": f"""WITH {CLEAN_SQL},
ends AS (SELECT max(CAST(TRY_CAST(replace(event_time, ' UTC', '') AS TIMESTAMP) AS DATE)) + 1 AS last_day,
                min(CAST(TRY_CAST(replace(event_time, ' UTC', '') AS TIMESTAMP) AS DATE)) AS first_day FROM raw),
asked AS (
  SELECT 'all' AS run_id, unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS day FROM ends
  UNION ALL
  SELECT 'past the end', unnest(generate_series(last_day, last_day + 3, INTERVAL 1 DAY)) FROM ends)
SELECT run_id, CAST(day AS DATE) AS day FROM asked
WHERE CAST(day AS DATE) NOT IN (SELECT event_date_kst FROM clean)""",
    "lost_values": f"""WITH {TYPED_SQL},
both_forms AS (SELECT raw.*, t.event_time_utc, t.product_id AS p, t.category_id AS c, t.user_id AS u
               FROM raw JOIN typed t USING (event_id)),
counted AS (SELECT
  count(*) FILTER (event_time IS NULL) AS "event_time:missing",
  count(*) FILTER (event_time IS NOT NULL AND event_time_utc IS NULL) AS "event_time:unreadable",
  count(*) FILTER (user_id IS NULL) AS "user_id:missing",
  count(*) FILTER (user_id IS NOT NULL AND u IS NULL) AS "user_id:unreadable",
  count(*) FILTER (product_id IS NULL) AS "product_id:missing",
  count(*) FILTER (product_id IS NOT NULL AND p IS NULL) AS "product_id:unreadable",
  count(*) FILTER (category_id IS NULL) AS "category_id:missing",
  count(*) FILTER (category_id IS NOT NULL AND c IS NULL) AS "category_id:unreadable",
  count(*) FILTER (price IS NULL) AS "price:missing",
  CAST(0 AS BIGINT) AS "price:unreadable" FROM both_forms)
SELECT lost, rows FROM (UNPIVOT counted ON COLUMNS(*) INTO NAME lost VALUE rows)""",
}
