"""DuckDB SQL equal to each registered query, over the pre-registered tables.

``ev`` adapts the synthetic ``events`` table exactly like ``sources.fixtures``;
``epoch_us(ts) // 1000`` floors like Spark's ``unix_millis`` (``epoch_ms`` rounds).
Sums are cast back to BIGINT (DuckDB widens them to HUGEINT).
"""

EV = """ev AS (
  SELECT epoch_us(ts) // 1000 AS "timestamp",
         CAST(user_id AS VARCHAR) AS visitorid,
         CASE event_type WHEN 'view' THEN 'view' WHEN 'click' THEN 'addtocart'
                         WHEN 'purchase' THEN 'transaction' ELSE event_type END AS event,
         json_extract_string(props, '$.k') AS itemid,
         CASE WHEN event_type = 'purchase' THEN CAST(event_id AS VARCHAR) END AS transactionid
  FROM events)"""

# Batch time: seconds truncated toward zero, then UTC date.
ENR = """enr AS (
  SELECT *, make_timestamp(("timestamp" // 1000) * 1000000) AS event_time,
         CAST(make_timestamp(("timestamp" // 1000) * 1000000) AS DATE) AS event_date
  FROM ev)"""

# The 1-minute metric.
MET = """met AS (
  SELECT date_trunc('minute', make_timestamp("timestamp" * 1000)) AS window_start,
         date_trunc('minute', make_timestamp("timestamp" * 1000)) + INTERVAL 1 MINUTE AS window_end,
         event, count(*) AS event_count
  FROM ev GROUP BY 1, 2, 3)"""

WIDE = """wide AS (
  SELECT window_start,
         CAST(coalesce(sum(CASE WHEN event = 'view' THEN event_count END), 0) AS BIGINT) AS "view",
         CAST(coalesce(sum(CASE WHEN event = 'addtocart' THEN event_count END), 0) AS BIGINT) AS addtocart,
         CAST(coalesce(sum(CASE WHEN event = 'transaction' THEN event_count END), 0) AS BIGINT) AS "transaction",
         CAST(coalesce(sum(CASE WHEN event = 'error' THEN event_count END), 0) AS BIGINT) AS "error",
         CAST(coalesce(sum(CASE WHEN event = 'signup' THEN event_count END), 0) AS BIGINT) AS signup
  FROM met WHERE event IS NOT NULL GROUP BY window_start
  ORDER BY window_start DESC LIMIT 60)"""


def _funnel(src: str, count_col: str) -> str:
    return f"""SELECT view_count, addtocart_count, transaction_count,
  CASE WHEN view_count > 0 THEN CAST(addtocart_count AS DOUBLE) / CAST(view_count AS DOUBLE) * 100.0 ELSE 0.0 END AS view_to_cart,
  CASE WHEN addtocart_count > 0 THEN CAST(transaction_count AS DOUBLE) / CAST(addtocart_count AS DOUBLE) * 100.0 ELSE 0.0 END AS cart_to_tx,
  CASE WHEN view_count > 0 THEN CAST(transaction_count AS DOUBLE) / CAST(view_count AS DOUBLE) * 100.0 ELSE 0.0 END AS overall
FROM (SELECT
  CAST(coalesce(sum(CASE WHEN event = 'view' THEN {count_col} END), 0) AS BIGINT) AS view_count,
  CAST(coalesce(sum(CASE WHEN event = 'addtocart' THEN {count_col} END), 0) AS BIGINT) AS addtocart_count,
  CAST(coalesce(sum(CASE WHEN event = 'transaction' THEN {count_col} END), 0) AS BIGINT) AS transaction_count
  FROM {src}) f"""


DIST = """dist AS (SELECT event, count(*) AS "count" FROM ev GROUP BY event)"""

# Naive UTC ISO text of epoch ms, Python ``isoformat`` style.
def _iso(ms: str) -> str:
    return (f"CASE WHEN {ms} % 1000 = 0 THEN strftime(make_timestamp({ms} * 1000), '%Y-%m-%dT%H:%M:%S') "
            f"ELSE strftime(make_timestamp({ms} * 1000), '%Y-%m-%dT%H:%M:%S.%f') END")


KPIS = """SELECT max(window_start) AS latest_window,
       CAST(coalesce(sum(CASE WHEN window_start = (SELECT max(window_start) FROM met) THEN event_count END), 0) AS BIGINT) AS events_latest,
       CAST(coalesce(sum(event_count), 0) AS BIGINT) AS total_events,
       count(DISTINCT event) AS event_types
FROM met"""

# Append mode emits a window once the watermark (max event time - 2 minutes) has
# passed its end.
FIN = """fin AS (SELECT * FROM met
  WHERE window_end <= (SELECT make_timestamp(max("timestamp") * 1000) - INTERVAL 2 MINUTE FROM ev))"""

# The late-data run: ``half`` splits the time span; the second part's rows are late if
# their window ended by the watermark of the first part.
LATE = """half AS (SELECT (epoch_us(min(ts)) // 1000 + epoch_us(max(ts)) // 1000) // 2 AS h FROM events),
parted AS (
  SELECT epoch_us(ts) // 1000 AS "timestamp", epoch_us(ts) // 1000 < h AND event_id % 10 <> 0 AS early,
         CASE event_type WHEN 'click' THEN 'addtocart' WHEN 'purchase' THEN 'transaction' ELSE event_type END AS event
  FROM events, half),
wm AS (SELECT make_timestamp(max("timestamp") * 1000) - INTERVAL 2 MINUTE AS w FROM parted WHERE early),
placed AS (SELECT *, date_trunc('minute', make_timestamp("timestamp" * 1000)) AS window_start FROM parted),
counted AS (
  SELECT window_start, window_start + INTERVAL 1 MINUTE AS window_end, event, count(*) AS event_count
  FROM placed, wm WHERE early OR window_start + INTERVAL 1 MINUTE > w GROUP BY 1, 2, 3)"""

# The replay in four equal ranges of event time: the batch of each row.
SLICED = """span AS (SELECT min("timestamp") AS lo, max("timestamp") - min("timestamp") + 1 AS width FROM ev),
sliced AS (SELECT ev.*, CAST((("timestamp" - lo) * 4) // width AS INTEGER) AS slice FROM ev, span)"""

JUNK = """junked AS (SELECT event_id, epoch_us(ts) // 1000 AS ms,
    CASE event_type WHEN 'click' THEN 'addtocart' WHEN 'purchase' THEN 'transaction' ELSE event_type END AS event
  FROM events)"""

# Event names that no column could have, counted per minute; the last 60 windows by all types.
ODD = """named AS (
  SELECT date_trunc('minute', ts) AS window_start, event_id,
         CASE event_type WHEN 'click' THEN 'addtocart' WHEN 'purchase' THEN 'transaction' ELSE event_type END AS base
  FROM events),
odd AS (
  SELECT window_start,
         CASE event_id % 7 WHEN 0 THEN 'page.' || base || (event_id % 500) WHEN 1 THEN upper(base[1]) || base[2:]
              WHEN 2 THEN base WHEN 3 THEN 'window_start' WHEN 4 THEN 'other' WHEN 5 THEN 'a `quoted` name' ELSE '' END AS event
  FROM named WHERE base IS NOT NULL OR event_id % 7 IN (3, 4, 5, 6)),
cnt AS (SELECT window_start, event, count(*) AS n FROM odd GROUP BY 1, 2),
lastw AS (SELECT DISTINCT window_start FROM cnt ORDER BY 1 DESC LIMIT 60),
grid AS (
  SELECT lastw.window_start, t.event, coalesce(n, 0) AS event_count
  FROM lastw CROSS JOIN (SELECT DISTINCT event FROM cnt) t LEFT JOIN cnt ON cnt.window_start = lastw.window_start AND cnt.event = t.event)"""

ORACLE_SQL: dict[str, str] = {
    "top_items": f"""WITH {EV}
SELECT itemid, count(*) AS view_count FROM ev WHERE event = 'view'
GROUP BY itemid ORDER BY view_count DESC, itemid ASC NULLS FIRST LIMIT 20""",
    "event_distribution": f"""WITH {EV}, {DIST}
SELECT event, "count" FROM dist ORDER BY "count" DESC, event ASC NULLS FIRST""",
    "event_share": f"""WITH {EV}, {DIST}
SELECT event, "count",
       CAST("count" AS DOUBLE) * 100.0 / CAST((SELECT count(*) FROM ev) AS DOUBLE) AS share_pct
FROM dist""",
    "daily_visitors": f"""WITH {EV}, {ENR}
SELECT event_date, count(DISTINCT visitorid) AS active_visitors FROM enr
GROUP BY event_date ORDER BY event_date NULLS FIRST""",
    "total_events": f"""WITH {EV} SELECT count(*) AS total_events FROM ev""",
    "derive_event_time": f"""WITH {EV}, {ENR}
SELECT "timestamp", event_time, event_date FROM enr""",
    "dataset_coverage": f"""WITH {EV}
SELECT make_timestamp(min("timestamp") * 1000) AS min_ts,
       make_timestamp(max("timestamp") * 1000) AS max_ts,
       count("timestamp") AS n_events,
       CASE WHEN count("timestamp") > 0 THEN 'parquet' ELSE 'empty' END AS source
FROM ev""",
    "dataset_coverage_labels": f"""WITH {EV}
SELECT coalesce(strftime(make_timestamp(min("timestamp") * 1000), '%A, %d %B %Y'), '-') AS earliest,
       coalesce(strftime(make_timestamp(max("timestamp") * 1000), '%A, %d %B %Y'), '-') AS latest
FROM ev""",
    "batch_date_window": f"""WITH {EV}, {ENR},
daily AS (SELECT event_date, count(DISTINCT visitorid) AS active_visitors FROM enr GROUP BY event_date)
SELECT min(event_date) AS first_day, max(event_date) AS last_day,
       count(DISTINCT event_date) AS n_days FROM daily""",
    "batch_date_window_labels": f"""WITH {EV}, {ENR},
daily AS (SELECT event_date, count(DISTINCT visitorid) AS active_visitors FROM enr GROUP BY event_date)
SELECT coalesce(strftime(min(event_date), '%A, %d %B %Y'), '-') AS first_label,
       coalesce(strftime(max(event_date), '%A, %d %B %Y'), '-') AS last_label,
       count(DISTINCT event_date) AS n_days FROM daily""",
    "events_per_minute": f"""WITH {EV}, {MET} SELECT * FROM met""",
    "live_kpis": f"""WITH {EV}, {MET} {KPIS}""",
    "latest_window_breakdown": f"""WITH {EV}, {MET}
SELECT window_start, window_end, event, event_count FROM met
WHERE window_start = (SELECT max(window_start) FROM met)""",
    "last_n_windows_wide": f"""WITH {EV}, {MET}, {WIDE}
SELECT * FROM wide""",
    "last_n_windows_long": f"""WITH {EV}, {MET}, {WIDE}
UNPIVOT wide ON "view", addtocart, "transaction", "error", signup INTO NAME event VALUE event_count""",
    "last_n_windows_odd_names": f"""WITH {ODD} SELECT * FROM grid""",
    "last_n_windows_maps": f"""WITH {ODD}
SELECT window_start, CAST(count(*) AS INTEGER) AS n_types,
       string_agg(event || '=' || event_count, ';' ORDER BY encode(event)) AS counts
FROM grid GROUP BY window_start""",
    "event_totals_from_windows": f"""WITH {EV}, {MET}
SELECT event, CAST(sum(event_count) AS BIGINT) AS event_count FROM met
WHERE event IS NOT NULL GROUP BY event""",
    "live_labels": f"""WITH {EV}, {MET}, k AS ({KPIS}), f AS ({_funnel("met", "event_count")})
SELECT format('{{:,}}', events_latest) AS events_latest, format('{{:,}}', total_events) AS total_events,
       CAST(event_types AS VARCHAR) AS event_types,
       printf('%.2f %%', view_to_cart) AS view_to_cart, printf('%.2f %%', cart_to_tx) AS cart_to_tx,
       printf('%.2f %%', overall) AS overall
FROM k, f""",
    "funnel_live": f"""WITH {EV}, {MET} {_funnel("met", "event_count")}""",
    "funnel_batch": f"""WITH {EV}, {DIST} {_funnel("dist", '"count"')}""",
    "normalize_events": f"""WITH {EV}
SELECT "timestamp", {_iso('"timestamp"')} AS event_time, visitorid, event, itemid, transactionid,
       false AS ts_defaulted
FROM ev""",
    "to_json_envelope": f"""WITH {EV}
SELECT visitorid AS "key",
       CAST(json_object('timestamp', "timestamp", 'event_time', {_iso('"timestamp"')},
                        'visitorid', visitorid, 'event', event, 'itemid', itemid,
                        'transactionid', transactionid, 'ingest_time', {_iso('"timestamp"')}) AS VARCHAR) AS "value"
FROM ev""",
    "parse_json_events": f"""WITH {EV}
SELECT "timestamp", visitorid, event, itemid, transactionid,
       make_timestamp("timestamp" * 1000) AS kafka_ts, make_timestamp("timestamp" * 1000) AS event_ts
FROM ev""",
    "json_message_files": f"""WITH {EV}
SELECT "timestamp", visitorid, event, itemid, transactionid, {_iso('"timestamp"')} AS event_time,
       make_timestamp("timestamp" * 1000) AS event_ts
FROM ev""",
    "csv_scan_count": f"""WITH {EV}
SELECT count(*) AS total_events, count("timestamp") AS n_timestamps,
       count(DISTINCT visitorid) AS n_visitors, count(transactionid) AS n_transactionids
FROM ev""",
    "csv_roundtrip_results": f"""WITH {EV}
SELECT itemid, count(*) AS view_count FROM ev WHERE event = 'view'
GROUP BY itemid ORDER BY view_count DESC, itemid ASC NULLS FIRST LIMIT 20""",
    "csv_roundtrip_daily": f"""WITH {EV}, {ENR}
SELECT event_date, count(DISTINCT visitorid) AS active_visitors FROM enr GROUP BY event_date""",
    "dashboard_batch_funnel": f"""WITH {EV}, {DIST} {_funnel("dist", '"count"')}""",
    "batch_job_after_failed_run": f"""WITH {EV}, {ENR}, {DIST},
top AS (SELECT itemid, count(*) AS view_count FROM ev WHERE event = 'view'
  GROUP BY itemid ORDER BY view_count DESC, itemid ASC NULLS FIRST LIMIT 20),
daily AS (SELECT event_date, count(DISTINCT visitorid) AS active_visitors FROM enr GROUP BY event_date),
results AS (
  SELECT 'top_items' AS result, itemid AS "key", view_count AS n FROM top
  UNION ALL SELECT 'event_distribution', event, "count" FROM dist
  UNION ALL SELECT 'daily_visitors', CAST(event_date AS VARCHAR), active_visitors FROM daily)
SELECT f.format, results.* FROM results CROSS JOIN (VALUES ('parquet'), ('csv')) f(format)""",
    "parquet_roundtrip_results": f"""WITH {EV}, {DIST} SELECT event, "count" FROM dist""",
    "batch_job_total": f"""WITH {EV} SELECT count(*) AS total_events FROM ev""",
    "stream_snapshot_complete": f"""WITH {EV}, {MET} SELECT * FROM met""",
    # Append mode emits a window once the watermark (max event time - 2 minutes)
    # has passed its end.
    "stream_windows_append": f"""WITH {EV}, {MET}
SELECT * FROM met
WHERE window_end <= (SELECT make_timestamp(max("timestamp") * 1000) - INTERVAL 2 MINUTE FROM ev)""",
    "stream_windows_update": f"""WITH {EV}, {MET} SELECT * FROM met""",
    "stream_live_kpis": f"""WITH {EV}, {MET}, {FIN} {KPIS.replace("FROM met", "FROM fin")}""",
    "stream_funnel_live": f"""WITH {EV}, {MET}, {FIN} {_funnel("fin", "event_count")}""",
    "stream_late_append": f"""WITH {EV}, {LATE}
SELECT * FROM counted
WHERE window_end <= (SELECT make_timestamp(max("timestamp") * 1000) - INTERVAL 2 MINUTE FROM ev)""",
    "stream_late_update": f"""WITH {EV}, {LATE} SELECT * FROM counted""",
    "stream_late_complete": f"""WITH {EV}, {MET} SELECT * FROM met""",
    "stream_replay_sliced": f"""WITH {EV}, {MET}, {FIN} SELECT * FROM fin""",
    "stream_snapshot_days": f"""WITH {EV}, {MET} SELECT * FROM met""",
    "stream_batch_rows": f"""WITH {EV}, {SLICED}
SELECT 'rows' AS query, CAST(dense_rank() OVER (ORDER BY slice) - 1 AS BIGINT) AS batch_id, count(*) AS rows,
       make_timestamp(min("timestamp") * 1000) AS first_event, make_timestamp(max("timestamp") * 1000) AS last_event
FROM sliced GROUP BY slice""",
    "stream_recovered": f"""WITH {EV}, {MET} SELECT * FROM met""",
    "stream_resumed": f"""WITH {EV}, {SLICED}
SELECT slice AS batch_id, event, count(*) AS n FROM sliced GROUP BY 1, 2""",
    "stream_publish_messages": """SELECT CASE WHEN event_id % 8 = 1 THEN '' ELSE CAST(user_id AS VARCHAR) END AS "key",
       epoch_us(ts) // 1000 AS "timestamp",
       CASE WHEN event_id % 8 = 1 THEN '' ELSE CAST(user_id AS VARCHAR) END AS visitorid,
       CASE event_type WHEN 'click' THEN 'addtocart' WHEN 'purchase' THEN 'transaction' ELSE event_type END
         || CASE WHEN event_id % 8 = 2 THEN ',x' ELSE '' END AS event,
       CASE WHEN event_id % 8 <> 3 THEN json_extract_string(props, '$.k') END AS itemid,
       CASE WHEN event_id % 8 <> 3 AND event_type = 'purchase' THEN CAST(event_id AS VARCHAR) END AS transactionid
FROM events WHERE event_id % 8 <> 0""",
    "stream_publish_rejected": """SELECT 'x' || (epoch_us(ts) // 1000) AS "timestamp", CAST(user_id AS VARCHAR) AS visitorid,
       CASE event_type WHEN 'click' THEN 'addtocart' WHEN 'purchase' THEN 'transaction' ELSE event_type END AS event,
       json_extract_string(props, '$.k') AS itemid,
       CASE WHEN event_type = 'purchase' THEN CAST(event_id AS VARCHAR) ELSE '' END AS transactionid
FROM events WHERE event_id % 8 = 0""",
    "quarantined_records": f"""WITH {JUNK}
SELECT 'not json ' || event_id AS json_str, make_timestamp(ms * 1000) AS kafka_ts FROM junked WHERE event_id % 7 = 0""",
    "landed_distribution": f"""WITH {JUNK}
SELECT event, count(*) AS "count" FROM junked WHERE event_id % 7 <> 0 GROUP BY event""",
    "count_policy_windows": f"""WITH {JUNK}
SELECT date_trunc('minute', make_timestamp(ms * 1000)) AS window_start,
       date_trunc('minute', make_timestamp(ms * 1000)) + INTERVAL 1 MINUTE AS window_end,
       CASE WHEN event_id % 7 <> 0 THEN event END AS event, count(*) AS event_count
FROM junked GROUP BY 1, 2, 3""",
    "csv_coverage": f"""WITH {EV}
SELECT make_timestamp(min("timestamp") * 1000) AS min_ts, make_timestamp(max("timestamp") * 1000) AS max_ts,
       count("timestamp") AS n_events, CASE WHEN count("timestamp") > 0 THEN 'csv' ELSE 'empty' END AS source
FROM ev""",
    "csv_coverage_states": """SELECT 'good' AS input, count(ts) AS n_events, 'csv' AS source FROM events
UNION ALL VALUES ('empty', 0, 'empty'), ('other', 0, 'error'), ('none', 0, 'missing')""",
    "batch_job_input_choice": "SELECT count(*) AS total_events, 2 AS taken FROM events",
    "csv_text_messages": """SELECT CASE WHEN event_id % 8 <> 0 THEN epoch_us(ts) // 1000 END AS "timestamp",
       CASE WHEN event_id % 8 = 1 THEN '' ELSE CAST(user_id AS VARCHAR) END AS visitorid,
       CASE event_type WHEN 'click' THEN 'addtocart' WHEN 'purchase' THEN 'transaction' ELSE event_type END
         || CASE WHEN event_id % 8 = 2 THEN ',x' ELSE '' END AS event,
       CASE WHEN event_id % 8 <> 3 THEN json_extract_string(props, '$.k') END AS itemid,
       CASE WHEN event_id % 8 <> 3 AND event_type = 'purchase' THEN CAST(event_id AS VARCHAR) END AS transactionid,
       event_id % 8 = 0 AS ts_defaulted
FROM events""",
    "null_event_distribution": f"""WITH {JUNK}
SELECT CASE WHEN event_id % 5 <> 0 THEN event END AS event, count(*) AS "count" FROM junked GROUP BY 1""",
    "null_daily_visitors": """SELECT
       CASE WHEN event_id % 11 <> 0 THEN CAST(make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS DATE) END AS event_date,
       count(DISTINCT CASE WHEN event_id % 3 <> 0 THEN CAST(user_id AS VARCHAR) END) AS active_visitors
FROM events GROUP BY 1""",
    "archive_replay_distribution": f"""WITH {EV}, {DIST} SELECT event, "count" FROM dist""",
}
