"""DuckDB SQL giving the same rows as each query in ``catalog``."""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"


def _t(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S.%f')"


BASE = f"""
WITH ev AS (
  SELECT *, CAST(user_id % 30 AS VARCHAR) AS store_id, ts + INTERVAL 8 HOUR AS lts FROM events
), blocks AS (
  SELECT *, CAST(lts AS DATE) AS ld,
         CASE WHEN hour(lts) BETWEEN 4 AND 11 THEN 'AM'
              WHEN hour(lts) BETWEEN 16 AND 23 THEN 'PM'
              WHEN hour(lts) < 4 THEN 'N' ELSE 'M' END AS blk
  FROM ev
), shifts AS (
  SELECT store_id || '/' || strftime(ld, '%Y-%m-%d') || '/' || blk AS shift_number, store_id, blk,
         min(ts) AS opened_at,
         CASE WHEN ld >= DATE '2024-01-30' THEN NULL ELSE max(ts) END AS closed_at,
         sum(value) AS total_sales
  FROM blocks GROUP BY store_id, ld, blk
), stores AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS store_id, n_name AS store_name FROM nation
), fact AS (
  SELECT s.shift_number, s.opened_at + INTERVAL 8 HOUR AS opening, s.closed_at, s.store_id,
         s.total_sales,
         CAST(dayofweek(s.opened_at + INTERVAL 8 HOUR) + 1 AS BIGINT) AS day_of_week,
         CAST(hour(s.opened_at + INTERVAL 8 HOUR) AS BIGINT) AS hour_of_day,
         coalesce(d.store_name, 'Unknown Store') AS store_name,
         strftime(s.opened_at + INTERVAL 8 HOUR, '%a') AS day_name, s.blk AS time_slot,
         strftime(s.opened_at + INTERVAL 8 HOUR, '%a') || '-' || s.blk AS shift_slot,
         s.opened_at >= {AS_OF} - INTERVAL 7 DAY AS recent
  FROM shifts s LEFT JOIN stores d ON s.store_id = d.store_id
  WHERE s.blk IN ('AM', 'PM') AND s.opened_at >= {AS_OF} - INTERVAL 90 DAY
)
"""

FACT_SELECT = f"""
  shift_number, {_t('opening')} AS shift_opening_time, {_t('closed_at')} AS shift_closing_time,
  store_id, round(total_sales, 6) AS total_sales, day_of_week, hour_of_day, store_name, day_name,
  time_slot, shift_slot
"""

DIP = """
, base AS (
  SELECT store_name, shift_slot, avg(total_sales) AS avg_sales,
         coalesce(stddev_samp(total_sales), 0) AS std_sales
  FROM fact GROUP BY store_name, shift_slot
), judged AS (
  SELECT *, avg_sales - {k} * std_sales AS anomaly_threshold,
         total_sales < avg_sales - {k} * std_sales AND std_sales > 0 AS is_stat_anomaly,
         total_sales < avg_sales * 0.6 AS is_hard_rule_anomaly
  FROM fact JOIN base USING (store_name, shift_slot) WHERE recent
)
"""

DIP_TAIL = """
  round(avg_sales, 6) AS avg_sales, round(std_sales, 6) AS std_sales,
  round(anomaly_threshold, 6) AS anomaly_threshold, is_stat_anomaly, is_hard_rule_anomaly,
  is_stat_anomaly OR is_hard_rule_anomaly AS is_suspicious
FROM judged WHERE is_stat_anomaly OR is_hard_rule_anomaly
"""


def _dip(k: str) -> str:
    return BASE + DIP.format(k=k) + f"SELECT {FACT_SELECT}, {DIP_TAIL}"


ITEMS = f"""
, sold AS (
  SELECT s.shift_number, s.opened_at, s.store_id,
         CASE e.event_type WHEN 'click' THEN 'Americano' ELSE 'Spanish Latte' END AS name,
         CAST(json_extract_string(e.props, '$.k') AS DOUBLE) AS quantity
  FROM ev e JOIN shifts s ON e.store_id = s.store_id
   AND e.ts BETWEEN s.opened_at AND coalesce(s.closed_at, {AS_OF})
  WHERE e.event_type IN ('click', 'purchase') AND s.blk IN ('AM', 'PM')
    AND s.opened_at >= {AS_OF} - INTERVAL 90 DAY AND e.ts >= {AS_OF} - INTERVAL 90 DAY
), pivoted AS (
  SELECT shift_number, opened_at, store_id,
         coalesce(sum(CASE WHEN name = 'Americano' THEN quantity END), 0) AS americano,
         coalesce(sum(CASE WHEN name = 'Spanish Latte' THEN quantity END), 0) AS latte
  FROM sold GROUP BY shift_number, opened_at, store_id
)
"""


def _ratio(k: str) -> str:
    return (
        BASE
        + ITEMS
        + f"""
, named AS (
  SELECT p.*, p.opened_at + INTERVAL 8 HOUR AS opening,
         coalesce(d.store_name, 'Unknown Store') AS store_name,
         strftime(p.opened_at + INTERVAL 8 HOUR, '%a') AS day_name,
         CASE WHEN hour(p.opened_at + INTERVAL 8 HOUR) < 12 THEN 'AM' ELSE 'PM' END AS time_slot
  FROM pivoted p LEFT JOIN stores d ON p.store_id = d.store_id
), slotted AS (
  SELECT *, day_name || '-' || time_slot AS shift_slot FROM named
), base AS (
  SELECT store_name, shift_slot, avg(americano) AS avg_americano,
         stddev_samp(americano) AS americano_std, avg(latte) AS avg_spanish_latte,
         coalesce(stddev_samp(latte), 0) AS std_spanish_latte
  FROM slotted GROUP BY store_name, shift_slot
), judged AS (
  SELECT *, CASE WHEN latte > 0 THEN americano / latte WHEN americano > 0 THEN 9.99 END AS pct,
         avg_spanish_latte - {k} * std_spanish_latte AS threshold
  FROM slotted JOIN base USING (store_name, shift_slot)
  WHERE opened_at >= {AS_OF} - INTERVAL 7 DAY
), flagged AS (
  SELECT *, coalesce(pct > 0.6, false) AS high_ratio,
         latte < threshold AND std_spanish_latte > 0 AS low_latte
  FROM judged
)
SELECT shift_number, {_t('opening')} AS shift_opening_time, store_id,
       round(americano, 6) AS "Americano", round(latte, 6) AS "Spanish Latte", store_name,
       day_name, time_slot, shift_slot, round(avg_americano, 6) AS avg_americano,
       round(americano_std, 6) AS "Americano_std",
       round(avg_spanish_latte, 6) AS avg_spanish_latte,
       round(std_spanish_latte, 6) AS std_spanish_latte,
       round(pct, 6) AS americano_vs_spanish_latte_pct, high_ratio AS is_ratio_anomaly,
       round(threshold, 6) AS latte_anomaly_threshold, low_latte AS is_latte_dip_anomaly,
       CASE WHEN high_ratio AND low_latte THEN 'High Americano Ratio, Low Spanish Latte Sales'
            WHEN high_ratio THEN 'High Americano Ratio' ELSE 'Low Spanish Latte Sales' END
         AS "Reason"
FROM flagged WHERE high_ratio OR low_latte
"""
    )


MERGE = """
WITH history AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
batch AS (
  SELECT * REPLACE (o_totalprice + 1 AS o_totalprice) FROM orders
  WHERE o_orderdate >= TIMESTAMP '1999-01-01'
)
"""
ORDER_SELECT = f"""
  o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice,
  {_t('o_orderdate')} AS o_orderdate, o_orderpriority
"""
UPSERT = (
    MERGE
    + f"""
SELECT {ORDER_SELECT} FROM history h
WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.o_orderkey = h.o_orderkey)
UNION ALL SELECT {ORDER_SELECT} FROM batch
"""
)

LINES = """
WITH numbered AS (
  SELECT *, string_split(text, chr(10)) AS lines FROM conversations
), records AS (
  SELECT conv_id, turn, role, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM numbered
), named AS (
  SELECT *, conv_id || '-' || turn || '-' || i AS receipt_number FROM records
)
"""
STAGED = (
    LINES
    + """
SELECT receipt_number, CAST(NULL AS VARCHAR) AS receipt_type,
       '2024-01-01 00:00:' || lpad(CAST(turn AS VARCHAR), 2, '0') || '.000000' AS created_at,
       CAST(NULL AS VARCHAR) AS updated_at, CAST(length(line) AS DOUBLE) AS total_money,
       CAST(NULL AS BIGINT) AS points_earned, {customer} AS customer_id, line AS note, CAST(1 AS BIGINT) AS items,
       CAST(0 AS BIGINT) AS payments, line AS item_name, true AS keeps_null
FROM named
"""
)

PAYLOAD = """
WITH texts AS (
  SELECT event_id, ts,
         CASE event_id % 3 WHEN 0 THEN strftime(ts, '%Y-%m-%d') WHEN 1 THEN strftime(ts, '%d/%m/%Y')
              ELSE 'junk' || event_id END AS date_text,
         CASE WHEN event_id % 3 < 2 THEN CAST(ts AS DATE) END AS day,
         CASE WHEN event_id % 50 <> 0
              THEN 'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') END AS full_name,
         event_type AS entry_type, strftime(ts, '%H:%M:%S.%f') AS time_text,
         CASE WHEN event_id % 7 <> 0
              THEN CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS BIGINT) END AS seconds,
         CASE WHEN event_id % 4 <> 0 THEN 'K' || (event_id % 9) END AS kiosk
  FROM events
), parsed AS (
  SELECT *,
         sha256(date_text || '|' || full_name || '|' || entry_type || '|' || time_text || '|'
                || coalesce(kiosk, '')) AS attn_id,
         CASE WHEN day IS NOT NULL THEN ts - INTERVAL 8 HOUR END AS time_ts,
         CASE WHEN event_id % 2 = 0 THEN date_trunc('second', ts)
              ELSE date_trunc('second', ts) - INTERVAL 8 HOUR END AS updated_at
  FROM texts
)
"""


def _attendance(activity: str) -> str:
    return f"""
  attn_id, strftime(day, '%Y-%m-%d') AS date, full_name, 'Floor' AS "group", entry_type,
  {_t('time_ts')} AS time_ts, seconds AS duration_sec, {activity} AS activity,
  kiosk AS kiosk_name, {_t('updated_at')} AS updated_at
"""


WINDOWS = {
    "morning run": ("2024-01-14 16:00:00", "2024-01-16 01:30:00"),
    "evening run": ("2024-01-14 16:00:00", "2024-01-16 14:00:00"),
    "previous day": ("2024-01-14 16:00:00", "2024-01-15 15:59:59"),
    "day range": ("2024-01-04 16:00:00", "2024-01-09 15:59:59.999999"),
}

MIXED = """
WITH lists AS (
  SELECT conv_id, turn, role, length(text) AS chars FROM conversations
)
"""

ENTRY = """
WITH entries AS (
  SELECT *, ts + INTERVAL 8 HOUR AS lts,
         CAST(json_extract_string(props, '$.k') AS BIGINT) * 613 AS secs FROM events
)
"""


def _hms(seconds: str) -> str:
    return (
        f"lpad(CAST({seconds} // 3600 AS VARCHAR), CAST(greatest(2, length(CAST({seconds} // 3600 AS"
        f" VARCHAR))) AS INTEGER), '0') || ':' || lpad(CAST({seconds} % 3600 // 60 AS VARCHAR), 2, '0')"
        f" || ':' || lpad(CAST({seconds} % 60 AS VARCHAR), 2, '0')"
    )


SHARDS = """
WITH shard AS (
  SELECT 'S' || user_id AS id, CAST(user_id % 30 AS VARCHAR) AS store_id,
         event_type AS pos_device_id, ts, value, event_id, CAST(ts AS DATE) AS ds,
         json_extract_string(props, '$.k') AS k
  FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'
)
"""

ORACLE: dict[str, str] = {
    "shift_fact": BASE + f"SELECT {FACT_SELECT} FROM fact",
    "shift_fact_sql": BASE + f"SELECT {FACT_SELECT} FROM fact",
    "slot_baseline": BASE
    + """
SELECT store_name, shift_slot, round(avg(total_sales), 6) AS avg_sales,
       round(coalesce(stddev_samp(total_sales), 0), 6) AS std_sales
FROM fact GROUP BY store_name, shift_slot
""",
    "sales_dip_anomalies": _dip("1.8"),
    "sales_dip_anomalies_k1": _dip("1.0"),
    "sales_dip_window": _dip("1.0"),
    "summary_sales": BASE
    + """
, sums AS (
  SELECT store_name, sum(CASE WHEN recent THEN total_sales END) AS late,
         sum(CASE WHEN NOT recent THEN total_sales END) AS early, bool_or(recent) AS seen
  FROM fact GROUP BY store_name
)
SELECT store_name AS "Branch", round(late, 6) AS "Sales Amount (Past 7 Days)",
       round(early / (83 / 7.0::DOUBLE), 6) AS "Sales Average per 7 Days"
FROM sums WHERE seen
""",
    "granular_sales": BASE
    + """
, usual AS (
  SELECT store_name, shift_slot, avg(total_sales) AS usual FROM fact WHERE NOT recent
  GROUP BY store_name, shift_slot
)
SELECT f.store_name AS "Branch Name", f.shift_slot AS "Shift",
       round(f.total_sales, 6) AS "Actual Sales", round(u.usual, 6) AS "Average Historic Sales"
FROM fact f LEFT JOIN usual u ON f.store_name = u.store_name AND f.shift_slot = u.shift_slot
WHERE f.recent
""",
    "shift_item_join": BASE
    + ITEMS
    + f"""
SELECT shift_number, {_t('opened_at')} AS shift_opening_time, store_id, name, quantity FROM sold
""",
    "item_pivot": BASE
    + ITEMS
    + f"""
SELECT shift_number, {_t('opened_at')} AS shift_opening_time, store_id,
       round(americano, 6) AS "Americano", round(latte, 6) AS "Spanish Latte" FROM pivoted
""",
    "ratio_anomalies": _ratio("1.8"),
    "ratio_anomalies_k1": _ratio("1.0"),
    "report_format": BASE
    + DIP.format(k="1.8")
    + f"""
SELECT * REPLACE (substr(shift_opening_time, 1, 19) AS shift_opening_time,
                  substr(shift_closing_time, 1, 19) AS shift_closing_time)
FROM (SELECT {FACT_SELECT}, {DIP_TAIL})
""",
    "json_array_sum": BASE
    + "SELECT shift_number, round(total_sales, 6) AS total_sales FROM shifts",
    "dim_lookup_default": BASE
    + """
SELECT e.event_id, e.store_id, coalesce(d.store_name, 'Unknown Store') AS store_name
FROM ev e LEFT JOIN stores d ON e.store_id = d.store_id
""",
    "local_slot_label": f"""
WITH l AS (
  SELECT event_id, ts + INTERVAL 8 HOUR AS lts FROM events
), s AS (
  SELECT *, strftime(lts, '%a') AS day_name,
         CASE WHEN hour(lts) BETWEEN 4 AND 11 THEN 'AM'
              WHEN hour(lts) BETWEEN 16 AND 23 THEN 'PM' ELSE 'Other' END AS time_slot
  FROM l
)
SELECT event_id, {_t('lts')} AS local_ts, CAST(dayofweek(lts) + 1 AS BIGINT) AS day_of_week,
       CAST(hour(lts) AS BIGINT) AS hour_of_day, day_name, time_slot,
       day_name || '-' || time_slot AS shift_slot
FROM s
""",
    "upsert_by_key": UPSERT,
    "stream_upsert": UPSERT,
    "insert_only_by_key": MERGE
    + f"""
SELECT {ORDER_SELECT} FROM history
UNION ALL
SELECT {ORDER_SELECT} FROM batch b
WHERE NOT EXISTS (SELECT 1 FROM history h WHERE h.o_orderkey = b.o_orderkey)
""",
    "load_metrics": MERGE
    + """
, sizes AS (
  SELECT (SELECT count(*) FROM history) AS t, (SELECT count(*) FROM batch) AS s,
         (SELECT count(*) FROM history h
          WHERE EXISTS (SELECT 1 FROM batch b WHERE b.o_orderkey = h.o_orderkey)) AS m
)
SELECT 'target_rows' AS metric, t AS n FROM sizes UNION ALL
SELECT 'source_rows', s FROM sizes UNION ALL
SELECT 'matched_rows', m FROM sizes UNION ALL
SELECT 'rows_after', t + s - m FROM sizes
""",
    "merge_cast_arrays": SHARDS
    + f"""
, known AS (
  SELECT 'S' || (c_custkey * 3) AS id, c_name FROM customer
), firsts AS (
  SELECT id, min(ds) AS ds FROM shard GROUP BY id
)
SELECT id, c_name AS pos_device_id, CAST(NULL AS VARCHAR) AS store_id,
       CAST(NULL AS VARCHAR) AS opened_at, CAST(NULL AS DOUBLE) AS net_sales,
       CAST(0 AS BIGINT) AS movements, '' AS taxes, CAST(0 AS DOUBLE) AS moved
FROM known
UNION ALL
SELECT s.id, s.pos_device_id, s.store_id, {_t('s.ts')}, round(s.value + 10, 6),
       2, s.k || ',' || s.event_id, round(s.value * 3, 6)
FROM shard s JOIN firsts f ON s.id = f.id AND s.ds = f.ds
WHERE s.id NOT IN (SELECT id FROM known)
""",
    "sharded_backfill": SHARDS
    + f"""
SELECT strftime(ds, '%Y-%m-%d') AS ds, id, {_t('ts')} AS opened_at,
       round(value, 6) AS starting_cash, round(value + 12, 6) AS surcharge,
       'PAY_IN' AS first_type, true AS keeps_null, round(value * 3, 6) AS moved
FROM shard
""",
    "backfill_mixed_shards": SHARDS
    + f"""
, firsts AS (
  SELECT id, min(ds) AS ds FROM shard GROUP BY id
)
SELECT s.id, {_t('s.ts')} AS opened_at, round(s.value * 3, 6) AS moved,
       CASE day(s.ds) % 3 WHEN 0 THEN k || ',' || event_id
            WHEN 1 THEN '{{"rate":' || k || '}},{{"rate":' || event_id || '}}'
            ELSE '"' || k || '","' || event_id || '"' END AS taxes
FROM shard s JOIN firsts f ON s.id = f.id AND s.ds = f.ds
""",
    "shard_replace": f"""
SELECT 'S' || event_id AS id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS ds,
       {_t('ts')} AS opened_at,
       CAST(CASE event_type WHEN 'error' THEN 0 ELSE 2 END AS BIGINT) AS movements,
       CASE event_type WHEN 'error' THEN 0 ELSE
         round(value + CASE WHEN ts < TIMESTAMP '2024-01-14 16:00:00' THEN 0 ELSE 1 END, 6)
         END AS moved,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS tax
FROM events
""",
    "json_envelope_explode": LINES + "SELECT receipt_number, line AS note FROM named",
    "struct_flatten": LINES
    + """
SELECT receipt_number, CAST(conv_id AS VARCHAR) AS customer_id, role AS customer_group_kind,
       CAST(1 AS BIGINT) AS line_items FROM named
""",
    "schema_project": STAGED.format(customer="CAST(NULL AS VARCHAR)"),
    "ingest_stage": STAGED.format(customer="CAST(conv_id AS VARCHAR)"),
    "backfill_then_ingest": f"""
SELECT 'S' || event_id AS id, CAST(user_id % 30 AS VARCHAR) AS store_id, {_t('ts')} AS opened_at,
       round(CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN value + 1
                  WHEN event_type = 'error' THEN 0 ELSE value END, 6) AS moved
FROM events
""",
    "upsert_moved_day": f"""
WITH moved AS (
  SELECT *, ts >= TIMESTAMP '2024-01-20' AS late FROM events
), placed AS (
  SELECT *, CASE WHEN late AND event_type = 'error' THEN NULL
                 WHEN late AND event_type = 'click' THEN ts + INTERVAL 1 DAY ELSE ts END AS moment
  FROM moved
)
SELECT 'R' || event_id AS receipt_number, {_t('moment')} AS created_at,
       round(value + CASE WHEN late THEN 1 ELSE 0 END, 6) AS total_money
FROM placed
""",
    "stream_envelopes": f"""
SELECT 'R' || event_id AS receipt_number, {_t('ts')} AS created_at,
       round(value + CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 0 ELSE 1 END, 6) AS total_money,
       CAST(user_id AS VARCHAR) AS customer_id
FROM events
""",
    "attendance_pipeline": ENTRY
    + f"""
, named AS (
  SELECT *, strftime(lts, '%Y-%m-%d') AS day, CAST(user_id % 30 AS VARCHAR) AS store,
         date_trunc('second', ts) AS moment,
         CASE WHEN event_id % 50 <> 0
              THEN 'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') END AS who
  FROM entries
), keyed AS (
  SELECT *, sha256(day || '|' || who || '|' || event_type || '|' || strftime(lts, '%H:%M:%S')
                   || '|') AS attn_id
  FROM named
), nameless AS (
  SELECT * FROM keyed WHERE who IS NULL AND ts < TIMESTAMP '2024-01-20' UNION ALL
  SELECT * FROM keyed WHERE who IS NULL AND ts >= TIMESTAMP '2024-01-15'
)
SELECT attn_id, day AS date, who AS full_name, max(store) AS "group", {_t('moment')} AS time_ts,
       max(secs) AS duration_sec
FROM keyed WHERE who IS NOT NULL GROUP BY attn_id, day, who, moment
UNION ALL
SELECT attn_id, day, who, store, {_t('moment')}, secs FROM nameless
""",
    "pos_ingest": f"""
SELECT 'R' || event_id AS receipt_number, CAST(user_id % 30 AS VARCHAR) AS store_id,
       {_t('ts')} AS created_at,
       round(value + CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 0 ELSE 1 END, 6) AS total_money,
       CAST(user_id AS VARCHAR) AS customer_id, event_type AS item_name
FROM events
""",
    "repeat_after_later_pull": f"""
SELECT 'R' || event_id AS receipt_number, {_t('ts')} AS created_at,
       round(value + CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 0
                          WHEN ts < TIMESTAMP '2024-01-18' THEN 1 ELSE 2 END, 6) AS total_money
FROM events
""",
    "repeat_stream_batch": f"""
SELECT 'R' || event_id AS receipt_number, {_t('ts')} AS created_at,
       round(value + CASE WHEN ts < TIMESTAMP '2024-01-18' THEN 0 ELSE 2 END, 6) AS total_money
FROM events WHERE ts >= TIMESTAMP '2024-01-10'
""",
    "array_to_json_strings": """
SELECT conv_id, turn, replace(text, chr(10), '|') AS lines, true AS keeps_null,
       turn || ',' || conv_id AS numbers, CAST(0 AS BIGINT) AS from_document,
       CAST(len(string_split(text, chr(10))) AS BIGINT) AS from_list
FROM conversations
""",
    "array_int_or_empty": MIXED
    + """
SELECT conv_id, turn, CAST(CASE WHEN role = 'user' THEN 2 ELSE 0 END AS BIGINT) AS n,
       CAST(CASE WHEN role = 'user' THEN chars + turn ELSE 0 END AS BIGINT) AS total
FROM lists
""",
    "array_struct_or_empty": MIXED
    + """
SELECT conv_id, turn, CAST(CASE WHEN turn % 4 < 2 THEN 2 ELSE 0 END AS BIGINT) AS n,
       CAST(CASE WHEN turn % 4 < 2 THEN chars + turn ELSE 0 END AS DOUBLE) AS total
FROM lists
""",
    "ingest_window_filter": " UNION ALL ".join(
        f"SELECT event_id, {_t('ts')} AS ts, '{label}' AS pull FROM events "
        f"WHERE ts BETWEEN TIMESTAMP '{start}' AND TIMESTAMP '{end}'"
        for label, (start, end) in WINDOWS.items()
    ),
    "time_entry_normalize": ENTRY
    + f"""
SELECT strftime(lts, '%Y-%m-%d') AS date,
       CASE WHEN event_id % 50 <> 0
            THEN 'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') END AS full_name,
       CAST(user_id % 30 AS VARCHAR) AS group_name, event_type AS entry_type,
       strftime(lts, '%H:%M:%S') AS time, {_hms('secs')} AS duration,
       CAST(NULL AS VARCHAR) AS activity_name, CAST(NULL AS VARCHAR) AS kiosk_name,
       strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS created_on,
       CASE WHEN event_id % 3 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS last_edited_on,
       strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS raw_payload
FROM entries
""",
    "append_raw": ENTRY
    + f"""
, loads AS (
  SELECT * FROM entries WHERE ts < TIMESTAMP '2024-01-20' UNION ALL
  SELECT * FROM entries WHERE ts >= TIMESTAMP '2024-01-15'
)
SELECT strftime(lts, '%Y-%m-%d') AS date, strftime(lts, '%H:%M:%S') AS time,
       CASE WHEN event_id % 50 <> 0
            THEN 'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') END AS full_name,
       event_type AS entry_type, {_hms('secs')} AS duration
FROM loads
""",
    "attendance_upsert": PAYLOAD
    + f"""
SELECT {_attendance("'Earlier'")} FROM parsed
WHERE ts < TIMESTAMP '2024-01-20' AND (attn_id IS NULL OR ts < TIMESTAMP '2024-01-15')
UNION ALL
SELECT {_attendance("'Shift'")} FROM parsed WHERE ts >= TIMESTAMP '2024-01-15'
""",
    "attendance_upsert_latest": PAYLOAD
    + f"""
, twice AS (
  SELECT *, 'Shift' AS activity FROM parsed UNION ALL SELECT *, 'Again' AS activity FROM parsed
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY attn_id ORDER BY updated_at DESC,
    substr(md5(concat_ws(chr(31), coalesce(strftime(day, '%Y-%m-%d'), chr(30)),
      coalesce(full_name, chr(30)), 'Floor', coalesce(entry_type, chr(30)),
      coalesce(regexp_replace(strftime(time_ts, '%Y-%m-%d %H:%M:%S.%f'), '\\.?0+$', ''), chr(30)),
      coalesce(CAST(seconds AS VARCHAR), chr(30)), activity, coalesce(kiosk, chr(30)))), 1, 15) DESC) AS r
  FROM twice
)
SELECT {_attendance("'Shift'")} FROM parsed
WHERE ts < TIMESTAMP '2024-01-20' AND attn_id IS NULL
UNION ALL
SELECT {_attendance('activity')} FROM ranked WHERE attn_id IS NULL OR r = 1
""",
    "sha_key": PAYLOAD + "SELECT event_id, attn_id FROM parsed",
    "multi_format_date": PAYLOAD
    + "SELECT event_id, strftime(day, '%Y-%m-%d') AS date FROM parsed",
    "local_ts_parse": PAYLOAD + f"SELECT event_id, {_t('time_ts')} AS time_ts FROM parsed",
    "hms_to_seconds": PAYLOAD + "SELECT event_id, seconds AS duration_sec FROM parsed",
    "sql_functions": PAYLOAD
    + f"""
SELECT event_id, {_t('time_ts')} AS time_ts, seconds AS duration_sec FROM parsed
""",
    "seconds_to_hms": f"""
WITH s AS (
  SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) * 3671 AS secs FROM events
)
SELECT event_id, {_hms('secs')} AS duration FROM s
""",
    "ts_coerce": f"""
SELECT event_id, CASE event_id % 4
         WHEN 0 THEN {_t("date_trunc('second', ts)")}
         WHEN 1 THEN {_t("date_trunc('second', ts) - INTERVAL 8 HOUR")}
         WHEN 2 THEN {_t("date_trunc('second', ts)")} END AS moment
FROM events
""",
}
ORACLE["repeat_attendance_pull"] = ORACLE["attendance_pipeline"]
_MOVED = """, moved AS (
  SELECT * REPLACE (opened_at + CASE WHEN CAST(opened_at AS DATE) = DATE '2024-01-24'
                                     THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END AS opened_at) FROM shifts
), stores AS ("""
ORACLE["kept_baseline"] = (
    ORACLE["slot_baseline"].replace(", stores AS (", _MOVED).replace("FROM shifts s LEFT", "FROM moved s LEFT")
)
ORACLE["sales_dip_kept"] = ORACLE["sales_dip_anomalies_k1"]
ORACLE["summary_kept"] = ORACLE["summary_sales"]
ORACLE["granular_kept"] = ORACLE["granular_sales"]
ORACLE["quarantine_ingest"] = ORACLE["quarantine_stream"] = r"""
SELECT 'table' AS place, 'R' || event_id AS content FROM events WHERE event_type <> 'error'
UNION ALL
SELECT 'quarantine', '{"receipts": [cut ' || regexp_replace(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '\.?0+$', '')
FROM events WHERE event_type = 'error'
"""
ORACLE["stream_insert_seen"] = f"""
SELECT 'R' || event_id AS receipt_number, {_t('ts')} AS created_at,
       round(value + CASE WHEN ts < TIMESTAMP '2024-01-20' THEN 0 ELSE 1 END, 6) AS total_money
FROM events
"""
ORACLE["schema_drift"] = """
WITH first AS (
  SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-20'
), second AS (
  SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-15'
)
SELECT 'first' AS pull, 'customer_vip' AS field, 'BOOLEAN' AS landed_type, 'none' AS expected_type,
       count(*) AS records FROM first HAVING count(*) > 0
UNION ALL SELECT 'first', 'loyalty', 'OBJECT<level: BIGINT>', 'none', count(*) FROM first
WHERE event_type = 'click' HAVING count(*) > 0
UNION ALL SELECT 'second', 'total_money', 'STRING', 'double', count(*) FROM second
WHERE event_type = 'error' HAVING count(*) > 0
UNION ALL SELECT 'second', 'points_earned', 'BOOLEAN', 'bigint', count(*) FROM second HAVING count(*) > 0
UNION ALL SELECT 'second', 'store_id', 'BIGINT', 'string', count(*) FROM second HAVING count(*) > 0
"""
