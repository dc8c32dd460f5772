"""SQL over the given tables that each query must agree with.

Written from the flat tables, not from the nested or written ones, so that both
sides are independent. Placeholders name the common table expressions below.
"""

from __future__ import annotations

import re

from ..staging import CATEGORIES, COLORS, CURRENCIES, DEVICES, POLICY_DETAILS
from ..staging import POLICY_TYPES, REASONS, REGIONS, RISK_LEVELS


def _pick(values: list[str], index: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"([{listed}])[CAST(({index}) % {len(values)} AS INTEGER) + 1]"


def _ts(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def _day(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def _dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def _merchant(key: str) -> str:
    return (
        f"CASE WHEN {key} IS NULL THEN NULL WHEN {key} % 4 = 0 THEN 'MCH-A' || {key} "
        f"ELSE 'MCH-' || {key} END"
    )


def _quoted(v: str | None) -> str:
    return "NULL" if v is None else f"'{v}'"


_POLICY_ROWS = ", ".join(
    f"('POL-{i}', 'Policy {i}', '{POLICY_TYPES[i % 4]}', {i % 5 != 4}, "
    f"'2024-01-{i + 1:02d}', {_quoted(POLICY_DETAILS[i])})"
    for i in range(10)
)

# Views by name; a view may use the ones before it.
VIEWS = {
    "tx": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, 'USR-' || o_custkey AS user_id,
               {_merchant('sk')} AS merchant_id,
               CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
               {_pick(CURRENCIES, 'o_orderkey')} AS currency,
               CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN 'REFUNDED'
                    WHEN o_orderstatus = 'F' THEN 'APPROVED'
                    WHEN o_orderstatus = 'O' THEN 'PENDING' ELSE 'DECLINED' END AS status,
               o_orderdate AS event_time,
               CASE WHEN o_orderkey % 2 = 0 THEN 'POL-' || (o_custkey % 10) END AS policy_id,
               o_orderkey AS k, o_custkey AS ck
        FROM orders LEFT JOIN
             (SELECT l_orderkey, min(l_suppkey) AS sk FROM lineitem GROUP BY l_orderkey)
             ON l_orderkey = o_orderkey""",
    "st": """
        SELECT p || k AS statement_id,
               CAST(CASE WHEN k % 5 = 0 THEN k + 1000000000 ELSE k END AS VARCHAR)
                   AS transaction_id,
               posting_date,
               CAST(CASE WHEN k % 3 = 0 THEN amount ELSE items_total END AS DECIMAL(18,2))
                   AS amount_posted,
               CAST(fee AS DECIMAL(18,2)) AS fee_charged
        FROM (SELECT o_orderkey AS k, any_value(CAST(o_totalprice AS DECIMAL(18,2))) AS amount,
                     SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS items_total,
                     SUM(CAST(l_tax AS DECIMAL(6,2))) AS fee,
                     CAST(max(l_shipdate) AS DATE) AS posting_date
              FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey),
             (VALUES ('S'), ('D')) AS v(p)
        WHERE p = 'S' OR k % 50 = 1""",
    "sig": """
        SELECT CAST(event_id AS VARCHAR) AS fraud_signal_id,
               CAST(event_id AS VARCHAR) AS transaction_id,
               least(value / 500, 1.0) AS fraud_score, least(value, 100.0) AS fraud_score_100,
               'v' || (event_id % 3 + 1) AS model_version, ts AS inference_time,
               'RULE_' || (event_id % 3 + 1) AS reason_code, event_id AS ek
        FROM events""",
    "pol": f"""
        SELECT * FROM (VALUES {_POLICY_ROWS}) AS p(policy_id, policy_name, policy_type,
               active_flag, effective_date, policy_details)""",
    "mer": f"""
        SELECT {_merchant('s_suppkey')} AS merchant_id, s_name AS merchant_name,
               {_pick(CATEGORIES, 's_suppkey')} AS category,
               {_pick(RISK_LEVELS, 's_suppkey')} AS risk_level
        FROM supplier""",
    "usr": """
        SELECT 'USR-' || c_custkey AS user_id, c_name AS user_name,
               CASE WHEN c_custkey % 97 = 0 THEN NULL WHEN c_custkey % 89 = 0 THEN ''
                    WHEN c_custkey % 5 = 0 THEN strftime(day, '%Y-%m-%d')
                    WHEN c_custkey % 5 = 1 THEN strftime(day, '%b %d, %Y')
                    WHEN c_custkey % 5 = 2 THEN strftime(day, '%B %-d, %Y')
                    WHEN c_custkey % 5 = 3 THEN strftime(day, '%m/%d/%Y')
                    ELSE 'some day' END AS signup_date,
               CASE WHEN c_custkey % 97 = 0 OR c_custkey % 89 = 0 THEN 'UNKNOWN'
                    WHEN c_custkey % 5 = 4 THEN 'INVALID_DATE'
                    ELSE strftime(day, '%Y-%m-%d') END AS iso_date
        FROM (SELECT *, DATE '2020-01-01' + CAST(c_custkey % 1500 AS INTEGER) AS day
              FROM customer)""",
    "batch": """
        SELECT tx.transaction_id, merchant_id, user_id, amount, currency, status, statement_id,
               posting_date, amount_posted, fee_charged,
               coalesce(amount_posted - amount, 0) AS discrepancy,
               CASE WHEN statement_id IS NULL THEN 'UNMATCHED' ELSE 'MATCHED' END
                   AS reconciliation_status,
               '2025-01-19T00:00:00' AS batch_run_timestamp, k
        FROM tx LEFT JOIN st ON st.transaction_id = tx.transaction_id""",
    "fin": """
        SELECT batch.transaction_id, batch.merchant_id, batch.user_id, batch.amount,
               batch.currency, batch.status, discrepancy, reconciliation_status,
               fraud_signal_id, fraud_score, inference_time,
               seen.event_time + INTERVAL 5 SECONDS AS processed_at,
               '2025-01-19T00:00:00' AS final_index_ts
        FROM batch LEFT JOIN sig ON sig.transaction_id = batch.transaction_id
                   LEFT JOIN tx seen ON seen.transaction_id = batch.transaction_id""",
    "flags": """
        SELECT transaction_id,
               coalesce(string_agg(DISTINCT policy_type, ',' ORDER BY policy_type), '')
                   AS policy_flags
        FROM tx LEFT JOIN (SELECT * FROM pol WHERE active_flag) a ON a.policy_id = tx.policy_id
        GROUP BY transaction_id""",
    "sched": """
        SELECT tx.transaction_id, tx.merchant_id, statement_id, posting_date, amount_posted,
               posting_date + 2 AS payout_due_date,
               CASE WHEN DATE '1998-07-01' < posting_date + 2 THEN 'Pending'
                    WHEN DATE '1998-07-01' > posting_date + 32 THEN 'Completed'
                    ELSE 'Delayed' END AS payout_status
        FROM tx JOIN (SELECT DISTINCT ON (transaction_id) * FROM st
                      ORDER BY transaction_id, posting_date DESC, statement_id DESC) s
             ON s.transaction_id = tx.transaction_id""",
    "rep": """
        SELECT fin.*, e.event_time, p.payout_due_date, policy_flags,
               CASE WHEN coalesce(fraud_score, 0) > 0.8 OR policy_flags LIKE '%BLACKLIST%'
                        THEN 'HIGH_RISK'
                    WHEN policy_flags LIKE '%KYC%' THEN 'REQUIRES_KYC' ELSE 'OK' END AS risk_label
        FROM fin
        LEFT JOIN (SELECT transaction_id, max(event_time) AS event_time FROM tx GROUP BY 1) e
             ON e.transaction_id = fin.transaction_id
        LEFT JOIN flags ON flags.transaction_id = fin.transaction_id
        LEFT JOIN (SELECT transaction_id, max(payout_due_date) AS payout_due_date FROM sched
                   GROUP BY 1) p ON p.transaction_id = fin.transaction_id""",
    # The items of nested transactions, straight from the line items.
    "ntx": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id,
               'USR-' || o_custkey AS user_id, {_merchant('sk')} AS merchant_id,
               {_pick(REGIONS, 'o_custkey')} AS region,
               year(o_orderdate) || '-01-01' AS dt,
               {_pick(['CARD', 'PAYPAL', 'CRYPTO'], 'o_orderkey')} AS payment_method,
               CASE WHEN o_orderkey % 4 = 0 THEN 'PROMO' || (o_orderkey % 100) END AS promo_code,
               CAST(o_custkey % 180 - 90 AS DOUBLE) AS lat,
               CAST(o_custkey % 360 - 180 AS DOUBLE) AS lon, value
        FROM orders LEFT JOIN
             (SELECT l_orderkey, min(l_suppkey) AS sk,
                     SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_quantity AS INTEGER))
                         AS value
              FROM lineitem GROUP BY ALL) ON l_orderkey = o_orderkey""",
    "item": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id,
               {_pick(REGIONS, 'o_custkey')} AS region, year(o_orderdate) || '-01-01' AS dt,
               CAST(l_partkey AS VARCHAR) AS sku, l_extendedprice AS price,
               CAST(l_quantity AS BIGINT) AS quantity,
               CASE WHEN l_linenumber <> 1 THEN {_pick(COLORS, 'l_partkey')} END AS color
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey""",
    "nusr": """
        SELECT 'USR-' || c_custkey AS user_id, string_split(c_name, '#')[1] AS first_name,
               string_split(c_name, '#')[2] AS last_name,
               CASE WHEN c_custkey % 4 < 2 THEN 'dark' ELSE 'light' END AS theme,
               CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN 'ACTIVE'
                    WHEN c_mktsegment = 'AUTOMOBILE' THEN 'SUSPENDED' ELSE 'PENDING' END AS status,
               strftime(DATE '2024-01-01' + CAST(c_custkey % 30 AS INTEGER), '%Y-%m-%d') AS dt,
               CASE WHEN c_custkey % 2 = 0 THEN 'PROD' ELSE 'DEV' END AS environment,
               c_custkey AS ck
        FROM customer""",
    "nev": f"""
        SELECT CAST(event_id AS VARCHAR) AS event_id, 'USR-' || user_id AS user_id,
               ts AS event_time,
               CASE event_type WHEN 'signup' THEN 'LOGIN' WHEN 'purchase' THEN 'PURCHASE'
                    WHEN 'error' THEN 'LOGOUT' ELSE 'BROWSE' END AS event_type,
               {_pick(DEVICES, 'event_id')} AS device,
               'agent/' || json_extract_string(props, '$.k') AS user_agent,
               CASE WHEN event_id % 3 <> 0
                    THEN 'https://ref.example/' || (event_id % 7) END AS referrer,
               strftime(ts, '%Y-%m-%d') AS dt,
               CASE WHEN user_id % 2 = 0 THEN 'PROD' ELSE 'DEV' END AS environment
        FROM events""",
    "nmer": f"""
        SELECT {_merchant('s_suppkey')} AS merchant_id, s_name AS name, s_suppkey AS sk,
               CASE WHEN s_suppkey % 10 <> 9 THEN {_pick(CATEGORIES, 's_suppkey')} END AS cat1,
               CASE WHEN s_suppkey % 10 <> 9 THEN {_pick(CATEGORIES, 's_suppkey + 1')} END AS cat2,
               '+1-555-' || s_suppkey AS phone, 'City-' || s_nationkey AS city,
               lpad(CAST(s_suppkey % 100000 AS VARCHAR), 5, '0') AS postal_code,
               CAST(floor(s_acctbal / 2500) + 1 AS DOUBLE) AS rating,
               (s_suppkey % 7 + 1995) || '-01-01' AS dt,
               {_pick(REGIONS, 's_suppkey // 7')} AS region
        FROM supplier""",
    "nsig": f"""
        SELECT CAST(event_id AS VARCHAR) AS signal_id, CAST(event_id AS VARCHAR) AS transaction_id,
               CASE WHEN value >= 90 THEN 'HIGH' WHEN value >= 70 THEN 'MEDIUM' ELSE 'LOW' END
                   AS risk_level,
               {_pick(REASONS, 'event_id')} AS reason1,
               CASE WHEN event_id % 5 = 0 THEN {_pick(REASONS, 'event_id + 1')} END AS reason2,
               '10.0.' || (event_id % 256) || '.' || (user_id % 256) AS ip_address,
               strftime(ts, '%Y-%m-%d') AS dt,
               CASE WHEN user_id % 2 = 0 THEN 'PROD' ELSE 'DEV' END AS environment
        FROM events""",
    "nloc": f"""
        SELECT 'LOC-' || c_custkey AS location_id, 'Place ' || c_custkey AS name,
               CAST(c_custkey % 180 - 90 AS DOUBLE) AS lat,
               CAST(c_custkey % 360 - 180 AS DOUBLE) AS lon,
               'UTC+' || (c_nationkey % 12) AS timezone_attr,
               CASE WHEN c_custkey % 4 <> 3
                    THEN {_pick(['en', 'de', 'fr', 'ja'], 'c_nationkey')} END AS local_lang,
               strftime(DATE '2024-01-01' + CAST(c_custkey % 3 AS INTEGER), '%Y-%m-%d') AS dt,
               CASE WHEN (c_custkey // 3) % 2 = 0 THEN 'PROD' ELSE 'DEV' END AS environment
        FROM customer""",
}


def _with_views(body: str) -> str:
    """Put the views a statement uses, directly or not, in front of it."""
    needed, pending = set(), [body]
    while pending:
        text = pending.pop()
        for name, sql in VIEWS.items():
            if name not in needed and re.search(rf"(?<![\w.']){name}(?![\w'])", text):
                needed.add(name)
                pending.append(sql)
    if not needed:
        return body
    views = ",\n".join(f"{n} AS ({sql})" for n, sql in VIEWS.items() if n in needed)
    return f"WITH {views}\n{body}"


TX_PART = "dt = '1996-01-01' AND region = "
DAY_DEV = "dt = '2024-01-02' AND environment = 'DEV'"
DAY_PROD = "dt = '2024-01-02' AND environment = 'PROD'"
TX_FIELDS = f"transaction_id, merchant_id, user_id, {_dbl('amount')} AS amount, currency, status"
TX_ALL = (
    f"transaction_id, user_id, merchant_id, {_dbl('amount')} AS amount, currency, status, "
    f"{_ts('event_time')} AS event_time, policy_id"
)
ISO_MS = "strftime(event_time, '%Y-%m-%dT%H:%M:%S.%g')"
BATCH_ALL = (
    f"transaction_id, merchant_id, user_id, {_dbl('amount')} AS amount, currency, status, "
    f"statement_id, {_day('posting_date')} AS posting_date, {_dbl('amount_posted')} "
    f"AS amount_posted, {_dbl('fee_charged')} AS fee_charged, {_dbl('discrepancy')} "
    "AS discrepancy, reconciliation_status, batch_run_timestamp"
)
REPORT = (
    f"transaction_id, merchant_id, user_id, {_dbl('amount')} AS amount, fraud_signal_id"
)
MERCHANT_SUMMARY = (
    "SELECT merchant_id, count(*) AS transaction_count, "
    "count(*) FILTER (status = 'REFUNDED') AS refund_count, "
    f"{_dbl('coalesce(sum(amount), 0)')} AS total_volume, "
    f"{_dbl('coalesce(sum(amount), 0)')} / count(*) AS average_tx FROM rep"
)
MERCHANT_AGGREGATE = (
    f"SELECT merchant_id, {_dbl('coalesce(sum(amount), 0)')} AS total_volume, "
    "count(transaction_id) AS tx_count, CASE WHEN count(transaction_id) > 0 THEN "
    f"{_dbl('coalesce(sum(amount), 0)')} / count(transaction_id) ELSE 0.0 END AS average_tx "
    "FROM rep GROUP BY merchant_id"
)
SIGNAL_FIELDS = (
    "fraud_signal_id AS fraud_id, transaction_id, model_version, "
    "fraud_score_100 AS fraud_score, reason_code"
)
NAMED_ITEMS = "CASE WHEN reason2 IS NULL THEN reason1 ELSE reason1 || ',' || reason2 END"


def _ops(bucket: str, sizes: str, n: int) -> str:
    return f"""
        SELECT {_ts('w')} AS window_start, {_ts(f"w + INTERVAL {n} MINUTES")} AS window_end,
               count(*) AS throughput, count(*) FILTER (event_type = 'error') AS errors,
               CAST(count(*) FILTER (event_type = 'error') AS DOUBLE) / count(*) AS error_rate,
               CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean_latency
        FROM (SELECT {bucket} AS w, * FROM events{sizes}) GROUP BY w"""


QUERIES = {
    "scan_parquet": f"SELECT o_orderkey, o_custkey, o_totalprice, {_ts('o_orderdate')} "
    "AS o_orderdate FROM orders",
    "stream_json_source": "SELECT transaction_id, status FROM tx",
    "publish_json": f"SELECT {TX_FIELDS} FROM tx",
    "ingest_signals": """
        SELECT fraud_signal_id || s AS fraud_signal_id,
               CASE WHEN ek % 10 <> 0 THEN transaction_id END AS transaction_id,
               CASE WHEN ek % 10 > 1 THEN fraud_score END AS fraud_score,
               CASE WHEN ek % 10 <> 0 THEN model_version END AS model_version,
               CASE WHEN ek % 10 = 0 THEN 'Missing field: fraud_score' ELSE 'accepted' END
                   AS outcome
        FROM sig, (VALUES (''), ('-b')) AS v(s) WHERE s = '' OR ek % 10 = 2""",
    "snapshot_signals": """
        SELECT fraud_signal_id || s AS fraud_signal_id, transaction_id,
               CASE WHEN ek % 10 > 1 THEN fraud_score END AS fraud_score, model_version
        FROM sig, (VALUES (''), ('-b')) AS v(s)
        WHERE ek % 10 <> 0 AND (s = '' OR ek % 10 = 2)""",
    "write_overwrite": f"SELECT {TX_ALL} FROM tx",
    "write_partitioned": f"SELECT {TX_ALL} FROM tx",
    "register_tables": """
        SELECT 'transactions' AS dataset, count(*) AS row_count FROM ntx
        UNION ALL SELECT 'users', count(*) FROM customer
        UNION ALL SELECT 'user_events', count(*) FROM events
        UNION ALL SELECT 'merchants', count(*) FROM supplier
        UNION ALL SELECT 'fraud_signals', count(*) FROM events
        UNION ALL SELECT 'locations', count(*) FROM customer""",
    "repair_partitions": """
        SELECT 'transactions' AS dataset, CAST(0 AS BIGINT) AS rows_before,
               count(DISTINCT (dt, region)) AS partitions, count(*) AS rows_after FROM ntx
        UNION ALL SELECT 'users', 0, count(DISTINCT (dt, environment)), count(*) FROM nusr
        UNION ALL SELECT 'user_events', 0, count(DISTINCT (dt, environment)), count(*) FROM nev
        UNION ALL SELECT 'merchants', 0, count(DISTINCT (dt, region)), count(*) FROM nmer
        UNION ALL SELECT 'fraud_signals', 0, count(DISTINCT (dt, environment)), count(*) FROM nsig
        UNION ALL SELECT 'locations', 0, count(DISTINCT (dt, environment)), count(*) FROM nloc""",
    "typed_rows": f"""
        SELECT event_id AS fraud_id, CASE WHEN event_id % 11 <> 0 THEN value END AS fraud_score,
               CASE WHEN event_id % 13 <> 0 THEN {_ts('ts')} END AS inference_time,
               CAST(NULL AS VARCHAR) AS reason_code
        FROM events""",
    "preview_head": f"""
        SELECT transaction_id, merchant_id, user_id, {_dbl('amount')} AS amount, currency, status,
               {_dbl('discrepancy')} AS discrepancy, reconciliation_status, fraud_signal_id,
               fraud_score, {_ts('processed_at')} AS processed_at, final_index_ts
        FROM fin ORDER BY transaction_id, fraud_signal_id NULLS LAST LIMIT 50""",
    "reload_counts": """
        SELECT 'orders' AS dataset, count(*) AS row_count FROM orders
        UNION ALL SELECT 'lineitem', count(*) FROM lineitem
        UNION ALL SELECT 'events', count(*) FROM events""",
    "project_columns": f"""
        SELECT transaction_id, merchant_id, user_id, {_dbl('amount')} AS amount, currency, status,
               {_dbl('discrepancy')} AS discrepancy, reconciliation_status FROM batch""",
    "flatten_struct_star": f"SELECT {TX_FIELDS} FROM tx",
    "stamp_run": f"SELECT transaction_id, {_dbl('amount')} AS amount, "
    "'2025-01-19T00:00:00' AS batch_run_timestamp FROM tx",
    "stamp_processing_time": "SELECT transaction_id, true AS is_stamped FROM tx",
    "cast_payload": "SELECT transaction_id AS json FROM tx",
    "rename_drop": f"SELECT transaction_id, user_id, merchant_id, {_dbl('amount')} "
    "AS total_volume, currency, status FROM tx",
    "filter_partition_eq": f"SELECT transaction_id, user_id, dt, region FROM ntx "
    f"WHERE {TX_PART} 'EU'",
    "stream_parquet_sink": f"SELECT {SIGNAL_FIELDS}, "
    "strftime(inference_time, '%Y-%m-%dT%H:%M:%S.%g') AS inference_time FROM sig",
    "fraud_alerts": f"SELECT {REPORT}, fraud_score FROM rep WHERE fraud_score > 0.8",
    "discrepancies": f"SELECT {REPORT}, {_dbl('discrepancy')} AS discrepancy, "
    "reconciliation_status FROM rep WHERE discrepancy IS NULL OR discrepancy <> 0",
    "compliance_cases": f"SELECT {REPORT}, risk_label FROM rep "
    "WHERE risk_label IN ('HIGH_RISK', 'REQUIRES_KYC', 'BLACKLISTED')",
    "settlements_due": f"SELECT {REPORT}, {_day('payout_due_date')} AS payout_due_date FROM rep "
    "WHERE payout_due_date IS NOT NULL",
    "column_guard": (
        "SELECT user_id, CAST(0 AS DOUBLE) AS total_spend, "
        "count(DISTINCT merchant_id) AS unique_merchants FROM rep GROUP BY user_id"
    ),
    "merchant_rows": f"SELECT {REPORT} FROM rep WHERE merchant_id = 'MCH-A4'",
    "user_rows": f"SELECT {REPORT} FROM rep WHERE user_id = 'USR-7'",
    "literal_tag": "SELECT transaction_id, 'transactions' AS source FROM tx",
    "case_status": "SELECT transaction_id, statement_id, reconciliation_status FROM batch",
    "star_enrich": f"""
        SELECT tx.user_id, tx.merchant_id, tx.policy_id, transaction_id, {_dbl('amount')} AS amount,
               currency, status, {_ts('event_time')} AS event_time, policy_name, effective_date,
               policy_details, merchant_name, category, risk_level, user_name, signup_date
        FROM tx LEFT JOIN pol ON pol.policy_id = tx.policy_id
                LEFT JOIN mer ON mer.merchant_id = tx.merchant_id
                LEFT JOIN usr ON usr.user_id = tx.user_id""",
    "match_statements": f"SELECT {BATCH_ALL} FROM batch",
    "match_statements_deduped": f"""
        SELECT {BATCH_ALL} FROM batch WHERE statement_id IS NULL OR statement_id =
            (SELECT arg_max(statement_id, (posting_date, statement_id)) FROM st
             WHERE st.transaction_id = batch.transaction_id)""",
    "final_index": f"""
        SELECT transaction_id, merchant_id, user_id, {_dbl('amount')} AS amount, currency, status,
               {_dbl('discrepancy')} AS discrepancy, reconciliation_status, fraud_signal_id,
               fraud_score, {_ts('inference_time')} AS inference_time,
               {_ts('processed_at')} AS processed_at, final_index_ts FROM fin""",
    "stream_static_enrich": f"""
        SELECT sig.transaction_id, fraud_signal_id AS fraud_id, model_version,
               fraud_score_100 AS fraud_score, reason_code, user_id, merchant_id,
               {_dbl('amount')} AS amount
        FROM sig LEFT JOIN tx ON tx.transaction_id = sig.transaction_id""",
    "join_partition_aligned": """
        SELECT user_id, dt, environment, event_id, status
        FROM nev JOIN nusr USING (user_id, dt, environment)""",
    "join_signals_tx": """
        SELECT transaction_id, signal_id, risk_level, user_id
        FROM nsig JOIN ntx USING (transaction_id)""",
    "cross_join_unnest": "SELECT transaction_id, sku, quantity FROM item",
    "count_by_status": "SELECT status, count(*) AS total_users FROM nusr GROUP BY status",
    "count_by_device": "SELECT device AS device_type, count(*) AS total_events FROM nev "
    "GROUP BY device",
    "order_value_top5": f"""
        SELECT transaction_id, {_dbl('value')} AS total_order_value FROM ntx
        WHERE value IS NOT NULL ORDER BY value DESC, transaction_id LIMIT 5""",
    "fraud_value_having": f"""
        SELECT signal_id, risk_level, transaction_id, {_dbl('sum(value)')} AS total_value
        FROM nsig JOIN ntx USING (transaction_id) WHERE value IS NOT NULL
        GROUP BY ALL HAVING sum(value) > 100""",
    "distinct_colors": "SELECT DISTINCT color AS unique_color FROM item WHERE color IS NOT NULL",
    "merchant_aggregate": MERCHANT_AGGREGATE,
    "merchant_summary": f"{MERCHANT_SUMMARY} GROUP BY merchant_id",
    "merchant_summary_one": f"{MERCHANT_SUMMARY} WHERE merchant_id = 'MCH-A4' "
    "GROUP BY merchant_id",
    "user_spend": f"""
        SELECT user_id, {_dbl('coalesce(sum(amount), 0)')} AS total_spend,
               count(DISTINCT merchant_id) AS unique_merchants,
               {_ts('max(event_time)')} AS last_tx_time FROM rep GROUP BY user_id""",
    "row_counts": """
        SELECT 'batch_index' AS dataset, count(*) AS row_count FROM batch
        UNION ALL SELECT 'final_index', count(*) FROM fin
        UNION ALL SELECT 'stream_index', count(*) FROM tx""",
    "top5_merchants": f"""
        SELECT coalesce(nullif(merchant_id, ''), 'UNKNOWN') AS merchant,
               {_dbl('sum(coalesce(amount, 0))')} AS volume
        FROM rep GROUP BY 1 ORDER BY volume DESC, merchant LIMIT 5""",
    "latest_per_transaction": f"""
        SELECT DISTINCT ON (transaction_id) statement_id, transaction_id,
               {_day('posting_date')} AS posting_date, {_dbl('amount_posted')} AS amount_posted,
               {_dbl('fee_charged')} AS fee_charged
        FROM st ORDER BY transaction_id, st.posting_date DESC, statement_id DESC""",
    "number_user_events": f"""
        SELECT user_id, {_ts('event_time')} AS event_time,
               row_number() OVER (PARTITION BY user_id ORDER BY event_time, event_id) AS row_num
        FROM nev""",
    "top5_merchants_by_rating": "SELECT merchant_id, name, rating FROM nmer "
    "ORDER BY rating DESC, merchant_id LIMIT 5",
    "coords_first10": "SELECT transaction_id, lat, lon FROM ntx ORDER BY transaction_id LIMIT 10",
    "order_partitions": "SELECT dt, environment, count(*) AS n FROM nev GROUP BY ALL",
    "merchant_ranking": f"SELECT merchant_id, total_volume FROM ({MERCHANT_AGGREGATE})",
    "merge_indexes": f"""
        SELECT transaction_id, user_id, merchant_id,
               CASE WHEN k % 7 <> 0 AND k % 3 = 1
                    THEN strftime(event_time + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S')
                    ELSE strftime(event_time, '%Y-%m-%d %H:%M:%S') END AS "timestamp",
               {_dbl('amount')} AS amount, currency, status,
               CASE WHEN k % 3 <> 0 AND k % 7 <> 0 THEN 'stream' END AS reason_code,
               CASE WHEN NOT (k % 3 <> 0 AND k % 7 <> 0) THEN 'batch' END AS policy_name
        FROM tx""",
    "merge_indexes_incremental": f"""
        SELECT transaction_id, user_id, merchant_id,
               CASE WHEN k % 7 <> 0 AND k % 3 = 1
                    THEN strftime(event_time + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S')
                    ELSE strftime(event_time, '%Y-%m-%d %H:%M:%S') END AS "timestamp",
               {_dbl('amount')} AS amount, currency, status,
               CASE WHEN k % 3 <> 0 AND k % 7 <> 0 THEN 'stream' END AS reason_code,
               CASE WHEN NOT (k % 3 <> 0 AND k % 7 <> 0) THEN 'batch' END AS policy_name
        FROM tx""",
    "union_coords": "SELECT lat, lon, 'transactions' AS source FROM ntx "
    "UNION ALL SELECT lat, lon, 'locations' FROM nloc",
    "label_fraud_score": "SELECT risk_level, count(*) AS signals FROM nsig GROUP BY risk_level",
    "mask_user_names": "SELECT user_id, user_name[1] || repeat('*', length(user_name) - 1) "
    "AS user_name FROM usr",
    "policy_region": """
        SELECT tx.policy_id, transaction_id,
               CASE WHEN pol.policy_id IS NULL THEN NULL
                    WHEN coalesce(policy_details, '') = '' THEN 'UNKNOWN'
                    WHEN NOT json_valid(policy_details)
                      OR json_type(policy_details) <> 'OBJECT' THEN 'INVALID_JSON'
                    WHEN json_exists(policy_details, '$.region')
                      THEN json_extract_string(policy_details, '$.region')
                    ELSE 'UNKNOWN' END AS policy_region
        FROM tx LEFT JOIN pol ON pol.policy_id = tx.policy_id""",
    "amount_usd": f"""
        SELECT transaction_id, {_dbl('amount')} AS amount, currency,
               CAST(CASE currency WHEN 'USD' THEN amount
                    WHEN 'EUR' THEN round(amount * 1.07, 2) WHEN 'GBP' THEN round(amount * 1.24, 2)
                    WHEN 'CAD' THEN round(amount * 0.80, 2)
                    WHEN 'JPY' THEN round(amount * 0.0075, 2) ELSE amount END AS DOUBLE)
                   AS amount_usd
        FROM tx""",
    "round_amounts": """
        SELECT tx.transaction_id,
               CAST(coalesce(CAST(floor((CAST(CAST(fraud_score_100 AS DECIMAL(18,2)) * 100 AS BIGINT)
                    + 4) / 8.0) AS BIGINT), 0) AS DOUBLE) / 100 AS amount
        FROM tx LEFT JOIN sig ON sig.transaction_id = tx.transaction_id""",
    "normalize_dates": "SELECT user_id, iso_date AS signup_date FROM usr",
    "discrepancy": f"""
        SELECT transaction_id, {_dbl('amount')} AS amount, statement_id,
               {_dbl('amount_posted')} AS amount_posted, {_dbl('discrepancy')} AS discrepancy
        FROM batch""",
    "risk_label": "SELECT transaction_id, fraud_signal_id, fraud_score, risk_label FROM rep",
    "mask_ids": "SELECT transaction_id, user_id, "
    "user_id[1:2] || repeat('*', length(user_id) - 2) AS masked_user_id FROM tx",
    "derive_status": """
        SELECT transaction_id, statement_id, status, reconciliation_status,
               CASE WHEN statement_id IS NULL THEN 'DISCREPANCY' ELSE status END AS final_status
        FROM batch""",
    "merchant_kpi": f"""
        SELECT merchant_id, {_day('event_time')} AS day, {_dbl('sum(amount)')} AS daily_value,
               CAST(CASE WHEN merchant_id LIKE 'MCH-A%' THEN round(sum(amount) * 1.1, 2)
                    ELSE sum(amount) END AS DOUBLE) AS kpi
        FROM tx GROUP BY merchant_id, {_day('event_time')}""",
    "stream_index_tx": f"SELECT {TX_FIELDS}, {ISO_MS} AS event_time FROM tx",
    "stream_index_fraud": f"""
        SELECT sig.transaction_id, fraud_signal_id AS fraud_id, model_version,
               fraud_score_100 AS fraud_score, reason_code, user_id, merchant_id,
               {_dbl('amount')} AS amount, currency, status, policy_id,
               strftime(event_time, '%Y-%m-%d %H:%M:%S') AS "timestamp"
        FROM sig LEFT JOIN tx ON tx.transaction_id = sig.transaction_id""",
    "stream_enrich_changing": f"""
        SELECT sig.transaction_id, fraud_signal_id, fraud_score, {_dbl('amount')} AS amount, status
        FROM sig LEFT JOIN tx ON tx.transaction_id = sig.transaction_id
                             AND (ek % 2 = 1 OR k % 3 <> 0)""",
    "stream_checkpoint": f"SELECT transaction_id, {_dbl('amount')} AS amount, status FROM tx",
    "stream_append_mode": "SELECT transaction_id, 2 * count(*) AS arrivals FROM tx GROUP BY 1",
    "stream_triggers": "SELECT transaction_id, status FROM tx",
    "stream_dedup": f"SELECT DISTINCT {TX_FIELDS}, {_ts('event_time')} AS event_time FROM tx",
    "stream_stream_enrich": """
        SELECT tx.transaction_id, fraud_signal_id, fraud_score
        FROM tx LEFT JOIN sig ON sig.transaction_id = tx.transaction_id AND ek % 90 <= 60""",
    "ops_index": _ops("time_bucket(INTERVAL 5 MINUTES, ts)", "", 5),
    "ops_index_sliding": _ops(
        "time_bucket(INTERVAL 5 MINUTES, ts) - s * INTERVAL 5 MINUTES",
        ", (VALUES (0), (1)) AS v(s)", 10,
    ),
    "ops_latency_tails": f"""
        SELECT {_ts("date_trunc('hour', ts)")} AS window_start, count(*) AS "values",
               true AS within_one_percent
        FROM events GROUP BY ALL""",
    "ops_index_stream": f"""
        SELECT {_ts('w')} AS window_start, count(*) AS throughput,
               count(*) FILTER (event_type = 'error') AS errors
        FROM (SELECT time_bucket(INTERVAL 5 MINUTES, ts) AS w, * FROM events)
        GROUP BY w
        HAVING w + INTERVAL 5 MINUTES <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
    "broadcast_dims": f"""
        SELECT tx.merchant_id, transaction_id, {_dbl('amount')} AS amount, merchant_name, category,
               risk_level FROM tx LEFT JOIN mer ON mer.merchant_id = tx.merchant_id""",
    "salted_join": "SELECT user_id, event_id, value, c_name FROM events "
    "LEFT JOIN customer ON c_custkey = user_id",
    "unmatched_both_sides": f"""
        SELECT coalesce(tx.transaction_id, st.transaction_id) AS transaction_id,
               {_dbl('amount')} AS amount, statement_id, {_dbl('amount_posted')} AS amount_posted,
               CASE WHEN tx.transaction_id IS NULL THEN 'ORPHAN'
                    WHEN statement_id IS NULL THEN 'UNMATCHED'
                    WHEN amount_posted > 0 AND amount_posted < amount THEN 'PARTIAL'
                    ELSE 'MATCHED' END AS reconciled_status,
               {_dbl('coalesce(amount_posted - amount, 0)')} AS difference
        FROM tx FULL JOIN st ON st.transaction_id = tx.transaction_id""",
    "merchant_daily_kpi": f"""
        SELECT merchant_id, {_day('event_time')} AS day, count(*) AS transactions,
               {_dbl('coalesce(sum(amount), 0)')} AS volume,
               count(*) FILTER (status = 'REFUNDED') AS refunds,
               count(*) FILTER (risk_label = 'HIGH_RISK') AS high_risk,
               {_dbl('coalesce(sum(amount), 0)')} / count(*) AS average_size,
               CAST(count(*) FILTER (status = 'REFUNDED') AS DOUBLE) / count(*) AS refund_rate,
               CAST(count(*) FILTER (risk_label = 'HIGH_RISK') AS DOUBLE) / count(*)
                   AS risk_exposure
        FROM rep GROUP BY merchant_id, {_day('event_time')}""",
    "user_profile": f"""
        SELECT user_id, strftime(event_time, '%Y-%m') AS "month", count(*) AS transactions,
               {_dbl('sum(amount)')} AS monthly_spend,
               {_dbl('sum(amount)')} / count(*) AS typical_amount,
               count(*) FILTER (status = 'DECLINED') AS declines,
               count(*) FILTER (status = 'DECLINED') >= 2 AS repeated_declines,
               any_value(favourite) AS frequent_merchant
        FROM tx JOIN (
            SELECT user_id, strftime(event_time, '%Y-%m') AS mon, merchant_id AS favourite
            FROM tx GROUP BY user_id, strftime(event_time, '%Y-%m'), merchant_id
            QUALIFY row_number() OVER (PARTITION BY user_id, strftime(event_time, '%Y-%m')
                ORDER BY count(*) DESC, coalesce(merchant_id, '') DESC) = 1) f
          USING (user_id)
        WHERE mon = strftime(event_time, '%Y-%m')
        GROUP BY ALL""",
    "user_decline_runs": f"""
        SELECT user_id, declines, coalesce(n, 0) AS longest_decline_run,
               {_ts('b')} AS run_begin, {_ts('e')} AS run_end
        FROM (SELECT user_id, count(*) FILTER (status = 'DECLINED') AS declines
              FROM tx GROUP BY user_id)
        LEFT JOIN (
            SELECT user_id, n, b, e FROM (
                SELECT user_id, count(*) AS n, min(event_time) AS b, max(event_time) AS e
                FROM (SELECT *, row_number() OVER (PARTITION BY user_id
                                                   ORDER BY event_time, transaction_id)
                        - row_number() OVER (PARTITION BY user_id, status = 'DECLINED'
                                             ORDER BY event_time, transaction_id) AS island
                      FROM tx)
                WHERE status = 'DECLINED' GROUP BY user_id, island)
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, b) = 1) r
          USING (user_id)""",
    "user_typical_amounts": """
        SELECT user_id, strftime(event_time, '%Y-%m') AS "month", count(*) AS transactions,
               round(quantile_cont(CAST(CAST(amount * 100 AS BIGINT) AS DOUBLE), 0.5) / 100, 4)
                   AS median_amount,
               round(quantile_cont(CAST(CAST(amount * 100 AS BIGINT) AS DOUBLE), 0.95) / 100, 4)
                   AS p95_amount
        FROM tx GROUP BY ALL""",
    "user_spikes": f"""
        SELECT transaction_id, user_id, {_dbl('amount')} AS amount, mean_amount, deviation,
               round((CAST(amount AS DOUBLE) - mean_amount) / deviation, 6) AS z_score
        FROM tx JOIN (
            SELECT user_id, m AS mean_amount, sqrt(greatest(q - m * m, 0.0)) AS deviation
            FROM (SELECT user_id, CAST(sum(amount) AS DOUBLE) / count(*) AS m,
                         CAST(sum(amount * amount) AS DOUBLE) / count(*) AS q
                  FROM tx GROUP BY user_id)) USING (user_id)
        WHERE deviation > 0 AND (CAST(amount AS DOUBLE) - mean_amount) / deviation > 1.5""",
    "settlement_schedule": f"""
        SELECT transaction_id, merchant_id, statement_id, {_day('posting_date')} AS posting_date,
               {_dbl('amount_posted')} AS amount_posted,
               {_day('payout_due_date')} AS payout_due_date, payout_status FROM sched""",
    "settlements_by_merchant": f"""
        SELECT merchant_id, {_day('payout_due_date')} AS payout_due_date, payout_status,
               count(*) AS payouts, {_dbl('sum(amount_posted)')} AS amount_due
        FROM sched GROUP BY merchant_id, sched.payout_due_date, payout_status""",
    "compliance_index": """
        SELECT flags.transaction_id, policy_flags, s.fraud_score,
               CASE WHEN coalesce(s.fraud_score, 0) > 0.8 OR policy_flags LIKE '%BLACKLIST%'
                        THEN 'HIGH_RISK'
                    WHEN policy_flags LIKE '%KYC%' THEN 'REQUIRES_KYC' ELSE 'OK' END AS risk_label
        FROM flags LEFT JOIN (SELECT transaction_id, max(fraud_score) AS fraud_score FROM sig
                              GROUP BY 1) s ON s.transaction_id = flags.transaction_id""",
    "quality_report": """
        SELECT 'transactions' AS dataset, count(*) AS row_count, count(*) - count(transaction_id)
               AS null_keys, count(transaction_id) - count(DISTINCT transaction_id)
               AS duplicate_keys, count(*) FILTER (NOT coalesce(amount > 0
               AND merchant_id IS NOT NULL, false)) AS invalid_rows,
               count(*) FILTER (user_id NOT IN (SELECT user_id FROM usr)) AS orphans FROM tx
        UNION ALL
        SELECT 'statements', count(*), count(*) - count(transaction_id),
               count(transaction_id) - count(DISTINCT transaction_id),
               count(*) FILTER (NOT coalesce(amount_posted >= fee_charged, false)),
               count(*) FILTER (transaction_id NOT IN (SELECT transaction_id FROM tx)) FROM st
        UNION ALL
        SELECT 'fraud_signals', count(*), count(*) - count(model_version),
               count(model_version) - count(DISTINCT model_version),
               count(*) FILTER (NOT coalesce(fraud_score BETWEEN 0 AND 1, false)),
               count(*) FILTER (transaction_id NOT IN (SELECT transaction_id FROM tx)) FROM sig""",
    "fraud_score_anomalies": f"""
        SELECT model_version, {_ts('h')} AS "hour", signals, CAST(mean AS DOUBLE) / 1e6 AS mean_score,
               s / n / 1e6 AS baseline
        FROM (SELECT *, CAST(count(mean) OVER w AS DOUBLE) AS n,
                     CAST(sum(mean) OVER w AS DOUBLE) AS s,
                     CAST(sum(mean * mean) OVER w AS DOUBLE) AS q
              FROM (SELECT model_version, date_trunc('hour', inference_time) AS h,
                           count(*) AS signals,
                           CAST(sum(CAST(fraud_score AS DECIMAL(18,6))) * 1000000 AS BIGINT)
                               // count(*) AS mean
                    FROM sig GROUP BY ALL)
              WINDOW w AS (PARTITION BY model_version ORDER BY h
                           ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING))
        WHERE n = 24 AND mean > s / n + 1.0 * sqrt(greatest(q / n - (s / n) * (s / n), 0.0))""",
    "fraud_score_baselines": f"""
        SELECT * FROM (WITH seen AS (
            SELECT model_version, date_trunc('hour', inference_time) AS h, count(*) AS n,
                   CAST(sum(CAST(fraud_score AS DECIMAL(18,6))) * 1000000 AS BIGINT) AS t
            FROM sig GROUP BY ALL),
        hours AS (
            SELECT model_version, unnest(generate_series(min(h), max(h), INTERVAL 1 HOUR)) AS h
            FROM seen GROUP BY model_version),
        grid AS (
            SELECT model_version, h, coalesce(n, 0) AS n, coalesce(t, 0) AS t,
                   row_number() OVER (PARTITION BY model_version ORDER BY h) AS i
            FROM hours LEFT JOIN seen USING (model_version, h)),
        past AS (
            SELECT *, CAST(sum(n) OVER w AS DOUBLE) AS s, CAST(sum(n * n) OVER w AS DOUBLE) AS q,
                   CAST(sum(t) OVER w AS DOUBLE) AS st
            FROM grid WINDOW w AS (PARTITION BY model_version ORDER BY h
                                   ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING))
        SELECT model_version, {_ts('h')} AS "hour", n AS signals, s / 24 AS usual_signals,
               n > s / 24 + 1.0 * sqrt(greatest(q / 24 - (s / 24) * (s / 24), 0.0)) AS burst,
               CASE WHEN n > 0 THEN CAST(t AS DOUBLE) / n / 1e6 END AS mean_score,
               CASE WHEN s > 0 THEN st / s / 1e6 END AS baseline
        FROM past WHERE i > 24)""",
    "q01_flatten_items": f"SELECT transaction_id, sku, price, quantity FROM item "
    f"WHERE {TX_PART} 'US'",
    "q02_item_color": f"SELECT transaction_id, sku, price, color AS color_used FROM item "
    f"WHERE {TX_PART} 'EU'",
    "q03_order_value_top5": f"SELECT transaction_id, {_dbl('value')} AS total_order_value FROM ntx "
    f"WHERE {TX_PART} 'APAC' AND value IS NOT NULL ORDER BY value DESC, transaction_id LIMIT 5",
    "q04_coords_first10": f"SELECT transaction_id, region AS country_code, lat AS latitude, "
    f"lon AS longitude FROM ntx WHERE {TX_PART} 'US' ORDER BY transaction_id LIMIT 10",
    "q05_crypto_payments": f"SELECT transaction_id, payment_method FROM ntx "
    f"WHERE {TX_PART} 'EU' AND payment_method = 'CRYPTO'",
    "q06_promo_codes": f"SELECT transaction_id, promo_code FROM ntx WHERE {TX_PART} 'US'",
    "q07_distinct_colors": f"SELECT DISTINCT color AS unique_color FROM item "
    f"WHERE {TX_PART} 'APAC' AND color IS NOT NULL",
    "q08_user_names": f"SELECT user_id, first_name, last_name FROM nusr WHERE {DAY_DEV}",
    "q09_emails": f"""
        SELECT user_id, 'u' || ck || '@example.' || s AS email
        FROM nusr, (VALUES ('com'), ('org')) AS v(s)
        WHERE {DAY_DEV} AND (s = 'com' OR ck % 3 = 0)""",
    "q10_dark_theme": f"SELECT user_id, theme AS theme_selected FROM nusr "
    f"WHERE {DAY_DEV} AND theme = 'dark'",
    "q11_users_by_status": f"SELECT status, count(*) AS total_users FROM nusr WHERE {DAY_DEV} "
    "GROUP BY status",
    "q12_purchases": f"SELECT event_id, user_id, event_type, {_ts('event_time')} AS event_time "
    f"FROM nev WHERE {DAY_DEV} AND event_type = 'PURCHASE'",
    "q13_user_agent": f"SELECT event_id, user_agent FROM nev WHERE {DAY_PROD}",
    "q14_events_by_device": f"SELECT device AS device_type, count(*) AS total_events FROM nev "
    f"WHERE {DAY_DEV} GROUP BY device",
    "q15_events_users": f"""
        SELECT event_id, event_type, first_name AS user_first_name, last_name AS user_last_name
        FROM nev JOIN nusr USING (user_id, dt, environment) WHERE {DAY_DEV}""",
    "q16_fashion_merchants": f"""
        SELECT merchant_id, name, cat1 || ',' || cat2 AS categories FROM nmer
        WHERE {TX_PART} 'US' AND 'Fashion' IN (cat1, cat2)""",
    "q17_merchant_categories": f"""
        SELECT merchant_id, cat1 AS category FROM nmer WHERE {TX_PART} 'EU' AND cat1 IS NOT NULL
        UNION ALL
        SELECT merchant_id, cat2 FROM nmer WHERE {TX_PART} 'EU' AND cat2 IS NOT NULL""",
    "q18_merchant_contact": f"""
        SELECT merchant_id, phone AS phone_number, city AS city_in_address,
               postal_code AS zip_code FROM nmer WHERE {TX_PART} 'APAC'""",
    "q19_top5_rating": f"SELECT merchant_id, name, rating FROM nmer WHERE {TX_PART} 'US' "
    "ORDER BY rating DESC, merchant_id LIMIT 5",
    "q20_geo_mismatch": f"""
        SELECT signal_id, transaction_id, risk_level, {NAMED_ITEMS} AS reasons FROM nsig
        WHERE {DAY_PROD} AND (reason1 = 'GeoMismatch' OR reason2 = 'GeoMismatch')""",
    "q21_signals_by_risk": f"SELECT risk_level, count(*) AS total_signals FROM nsig "
    f"WHERE {DAY_DEV} GROUP BY risk_level",
    "q22_high_risk_ip": f"SELECT signal_id, ip_address FROM nsig WHERE {DAY_PROD} "
    "AND risk_level = 'HIGH'",
    "q23_locations": f"SELECT location_id, name AS location_name, lat AS latitude, "
    f"lon AS longitude FROM nloc WHERE {DAY_DEV}",
    "q24_location_attrs": f"SELECT location_id, timezone_attr, local_lang FROM nloc "
    f"WHERE {DAY_PROD}",
    "q25_signals_tx": f"""
        SELECT signal_id, risk_level, transaction_id, payment_method AS pay_method
        FROM (SELECT * FROM nsig WHERE {DAY_DEV})
        JOIN (SELECT * FROM ntx WHERE {TX_PART} 'US') USING (transaction_id)""",
    "q26_fraud_value": f"""
        SELECT signal_id, risk_level, transaction_id, {_dbl('sum(value)')} AS total_value
        FROM (SELECT * FROM nsig WHERE {DAY_PROD}) JOIN (SELECT transaction_id, value FROM ntx)
             USING (transaction_id) WHERE value IS NOT NULL GROUP BY ALL HAVING sum(value) > 100""",
    "q27_event_profile": f"""
        SELECT event_id, {_ts('event_time')} AS event_time, first_name, device,
               referrer AS ref_url
        FROM nev JOIN nusr USING (user_id, dt, environment) WHERE {DAY_DEV}""",
    "q28_union_coords": f"""
        SELECT lat, lon, 'transactions' AS source FROM ntx WHERE {TX_PART} 'US'
        UNION ALL SELECT lat, lon, 'locations' FROM nloc WHERE {DAY_DEV}""",
    "q29_event_row_number": f"""
        SELECT user_id, {_ts('event_time')} AS event_time,
               row_number() OVER (PARTITION BY user_id ORDER BY event_time, event_id) AS row_num
        FROM nev WHERE {DAY_PROD}""",
    "q30_missing_promo": f"""
        SELECT transaction_id, '{{"payment_method":"' || payment_method || '"}}' AS extra_info,
               promo_code AS maybe_promo
        FROM ntx WHERE {TX_PART} 'EU' AND promo_code IS NULL""",
    "partitions_metadata": "SELECT DISTINCT dt, region FROM ntx",
    "latest_partition": "SELECT region, max(dt) AS latest_dt FROM ntx GROUP BY region",
    "latest_partition_missing_dt": """
        SELECT region, max(CASE WHEN region <> 'APAC' AND CAST(transaction_id AS BIGINT) % 5 <> 0
                                THEN dt END) AS latest_dt
        FROM ntx GROUP BY region""",
    "pruning_ledger": f"""
        SELECT scan, count(DISTINCT dt || '/' || region) AS partitions, count(*) AS "rows",
               true AS a_file_each, true AS read
        FROM ntx, (VALUES ('full'), ('pruned')) AS v(scan)
        WHERE scan = 'full' OR ({TX_PART} 'EU') GROUP BY scan""",
    "pruning_by_partition": f"""
        SELECT scan, dt, region, count(*) AS "rows"
        FROM ntx, (VALUES ('full'), ('pruned')) AS v(scan)
        WHERE scan = 'full' OR ({TX_PART} 'EU') GROUP BY ALL""",
    "prune_two_columns": f"SELECT transaction_id, user_id FROM ntx WHERE {TX_PART} 'APAC'",
    "prune_vs_full": f"""
        SELECT transaction_id, 'full' AS scan FROM ntx WHERE payment_method = 'CARD'
        UNION ALL SELECT transaction_id, 'pruned' FROM ntx
        WHERE payment_method = 'CARD' AND {TX_PART} 'US'""",
    "show_partitions": "SELECT DISTINCT 'dt=' || dt || '/region=' || region AS partition FROM ntx",
    "prune_locations": f"SELECT location_id, lat, lon FROM nloc WHERE {DAY_DEV}",
    "users_per_day": "SELECT dt, count(*) AS total_users FROM nusr GROUP BY dt",
    "join_on_partitions": f"""
        SELECT transaction_id, merchant_id, name FROM ntx JOIN nmer USING (merchant_id, dt, region)
        WHERE {TX_PART} 'US'""",
}


def all_sql() -> dict[str, str]:
    return {name: _with_views(body.strip()) for name, body in QUERIES.items()}
