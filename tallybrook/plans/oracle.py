"""What the catalogue's queries must return, in SQL over the raw tables; each query restates the layers that it needs."""

from __future__ import annotations

import re


def _m(x: str) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(18,6)), 2) AS DECIMAL(15,2))"


def _r(x: str, k: int) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(18,6)), {k}) AS DOUBLE)"


#: Layers by name; a query gets those it mentions and those that they mention.
LAYERS = {
    "inv": "SELECT CAST(event_id AS VARCHAR) AS invoice_id, event_id, event_type AS po_no, CAST(user_id AS VARCHAR) AS vendor_id, user_id, CAST(value AS DECIMAL(15,2)) AS invoice_amount, ts AS invoice_timestamp, props FROM events",
    "bronze": """SELECT 'erp-' || event_id AS event_uuid, 'ERP' AS source_system, 'INVOICE' AS event_type, invoice_timestamp AS event_timestamp, invoice_timestamp + to_seconds(event_id % 120) AS ingested_at, invoice_id, vendor_id, invoice_amount FROM inv
        UNION ALL SELECT 'wms-' || o_orderkey, 'WMS', 'RECEIVING', o_orderdate, o_orderdate + to_seconds(o_orderkey % 120), NULL, CAST(o_custkey AS VARCHAR), NULL FROM orders""",
    "silver": "SELECT *, invoice_timestamp + to_seconds(event_id % 120 + 5) AS ingested_at FROM inv QUALIFY row_number() OVER (PARTITION BY invoice_id ORDER BY invoice_timestamp, vendor_id, invoice_amount) = 1",
    "base": f"""SELECT vendor_id, {_m("CAST(sum(invoice_amount) AS DOUBLE) / count(*)")} AS avg_invoice_amount, {_m("stddev_pop(CAST(invoice_amount AS DOUBLE))")} AS stddev_invoice_amount,
        {_m("quantile_cont(CAST(invoice_amount AS DOUBLE), 0.99)")} AS p99_invoice_amount, CAST(floor(count(*) / count(DISTINCT CAST(invoice_timestamp AS DATE))) AS BIGINT) AS avg_daily_invoice_cnt
        FROM inv WHERE CAST(invoice_timestamp AS DATE) > DATE '2023-11-02' AND CAST(invoice_timestamp AS DATE) <= DATE '2024-01-31' GROUP BY vendor_id""",
    "resent": "SELECT * FROM silver UNION ALL SELECT * REPLACE (invoice_timestamp + INTERVAL 30 SECOND AS invoice_timestamp) FROM silver WHERE event_id % 61 = 0 UNION ALL SELECT * REPLACE (invoice_timestamp + INTERVAL 95 SECOND AS invoice_timestamp) FROM silver WHERE event_id % 183 = 0",
    "history": f"""SELECT vendor_id, {_m("CAST(sum(invoice_amount) AS DOUBLE) / count(*)")} AS avg_invoice_amount, {_m("stddev_pop(CAST(invoice_amount AS DOUBLE))")} AS stddev_invoice_amount
        FROM inv WHERE CAST(invoice_timestamp AS DATE) <= DATE '2024-01-02' AND CAST(invoice_timestamp AS DATE) > DATE '2023-10-04' GROUP BY vendor_id""",
    "scored": """SELECT inv.*, avg_invoice_amount AS baseline_avg, stddev_invoice_amount AS baseline_stddev, (CAST(invoice_amount AS DOUBLE) - CAST(avg_invoice_amount AS DOUBLE)) / nullif(CAST(stddev_invoice_amount AS DOUBLE), 0) AS z,
        CASE WHEN history.vendor_id IS NULL THEN 'No baseline available' WHEN stddev_invoice_amount <= 0 THEN 'Degenerate stddev' END AS fallback_reason FROM inv LEFT JOIN history USING (vendor_id)""",
    "anomaly": f"""SELECT invoice_id, vendor_id, 'ANOMALY' AS rule_name, CASE WHEN abs(z) >= 5 THEN 'CRITICAL' ELSE 'HIGH' END AS severity, CAST(least(100, floor(abs(z) * 10)) AS BIGINT) AS fraud_score, invoice_amount AS amount, baseline_avg, baseline_stddev,
        'Invoice $' || format('{{:,.2f}}', CAST(invoice_amount AS DOUBLE)) || ' is ' || format('{{:.1f}}', abs(z)) || 'σ from vendor avg $' || format('{{:,.2f}}', CAST(baseline_avg AS DOUBLE)) AS reason,
        {_r("z", 3)} AS z_score, {_r("(CAST(invoice_amount AS DOUBLE) - CAST(baseline_avg AS DOUBLE)) / CAST(baseline_avg AS DOUBLE) * 100", 2)} AS deviation_pct, 'anomaly_check' AS alert_source, invoice_timestamp AS detected_at
        FROM scored WHERE fallback_reason IS NULL AND abs(z) >= 3""",
    "fallback": "SELECT invoice_id, vendor_id, 'FALLBACK' AS rule_name, 'MEDIUM' AS severity, CAST(25 AS BIGINT) AS fraud_score, 'Review Required - Fallback Mode: ' || fallback_reason AS reason, invoice_amount AS amount, fallback_reason, 'fallback_path' AS alert_source, invoice_timestamp AS detected_at FROM scored WHERE fallback_reason IS NOT NULL",
    "placed": "SELECT invoice_id, vendor_id, invoice_timestamp, CAST(floor(invoice_amount / 10) * 10 AS DECIMAL(15,2)) AS amount, make_timestamp((epoch_us(invoice_timestamp) // 3600000000 - i) * 3600000000) AS window_start FROM inv, range(24) AS r(i)",
    "velocity": """SELECT invoice_id, vendor_id, 'VELOCITY' AS rule_name, 'HIGH' AS severity, window_start, window_start + INTERVAL 1 DAY AS window_end, amount, n AS occurrences, CAST(least(100, n * 10) AS BIGINT) AS fraud_score, 'velocity_check' AS alert_source, invoice_timestamp AS detected_at
        FROM (SELECT *, count(*) OVER (PARTITION BY window_start, vendor_id, amount) AS n FROM placed) WHERE n >= 3""",
    "gold": """SELECT invoice_id, vendor_id, rule_name, severity, fraud_score, window_start, window_end, alert_source, detected_at, amount, occurrences, NULL::DECIMAL(15,2) AS baseline_avg, NULL::DOUBLE AS z_score, 'rapid_duplicate_amounts' AS fraud_pattern, NULL AS fallback_reason FROM velocity
        UNION ALL SELECT invoice_id, vendor_id, rule_name, severity, fraud_score, NULL, NULL, alert_source, detected_at, amount, NULL, baseline_avg, z_score, 'statistical_outlier', NULL FROM anomaly
        UNION ALL SELECT invoice_id, vendor_id, rule_name, severity, fraud_score, NULL, NULL, alert_source, detected_at, amount, NULL, NULL, NULL, 'unknown_vendor', fallback_reason FROM fallback""",
    "recent": "SELECT * FROM gold WHERE CAST(detected_at AS DATE) >= DATE '2024-01-24'",
    "fresh": "SELECT * FROM gold WHERE detected_at >= TIMESTAMP '2024-01-30 00:00:00'",
    "behave": f"""SELECT vendor_id, feature_date, n AS invoice_count, CAST(total AS DECIMAL(15,2)) AS total_invoice_amount, {_m("CAST(total AS DOUBLE) / n")} AS avg_invoice_amount, low AS min_invoice_amount, high AS max_invoice_amount,
        CASE WHEN n <= 1 THEN CAST(0 AS DECIMAL(15,2)) ELSE {_m("sd")} END AS stddev_invoice_amount, {_r("CASE WHEN n <= 1 THEN 0.0::DOUBLE WHEN hours = 0 THEN CAST(n AS DOUBLE) ELSE n / hours END", 2)} AS avg_invoices_per_hour, latest_invoice_timestamp
        FROM (SELECT vendor_id, CAST(invoice_timestamp AS DATE) AS feature_date, count(*) AS n, sum(invoice_amount) AS total, min(invoice_amount) AS low, max(invoice_amount) AS high, stddev_pop(CAST(invoice_amount AS DOUBLE)) AS sd,
        CAST(epoch_us(max(invoice_timestamp)) - epoch_us(min(invoice_timestamp)) AS DOUBLE) / 1000000.0::DOUBLE / 3600 AS hours, max(invoice_timestamp) AS latest_invoice_timestamp FROM inv GROUP BY ALL)""",
    "risk": "SELECT vendor_id, CAST(detected_at AS DATE) AS feature_date, count(*) FILTER (rule_name = 'ANOMALY') AS anomaly_alert_count, count(*) FILTER (rule_name = 'VELOCITY') AS velocity_alert_count, count(*) FILTER (rule_name = 'DUPLICATE') AS duplicate_alert_count, count(*) AS total_alert_count FROM gold GROUP BY ALL",
    "feats": """SELECT b.*, coalesce(anomaly_alert_count, 0) AS anomaly_alert_count, coalesce(velocity_alert_count, 0) AS velocity_alert_count, coalesce(duplicate_alert_count, 0) AS duplicate_alert_count, coalesce(total_alert_count, 0) AS total_alert_count
        FROM behave b LEFT JOIN risk USING (vendor_id, feature_date)""",
    "rollb": f"""SELECT vendor_id, feature_date, invoice_count, CAST(sum(invoice_count) OVER w7 AS BIGINT) AS invoice_count_7d, {_m("avg(CAST(avg_invoice_amount AS DOUBLE)) OVER w7")} AS avg_invoice_amount_7d, CAST(sum(invoice_count) OVER w30 AS BIGINT) AS invoice_count_30d, {_m("avg(CAST(avg_invoice_amount AS DOUBLE)) OVER w30")} AS avg_invoice_amount_30d
        FROM behave WHERE feature_date BETWEEN DATE '2023-11-02' AND DATE '2024-01-31' WINDOW w7 AS (PARTITION BY vendor_id ORDER BY feature_date ROWS 6 PRECEDING), w30 AS (PARTITION BY vendor_id ORDER BY feature_date ROWS 29 PRECEDING)""",
    "rollr": """SELECT vendor_id, feature_date, CAST(sum(anomaly_alert_count) OVER w AS BIGINT) AS anomaly_alert_count_30d, CAST(sum(velocity_alert_count) OVER w AS BIGINT) AS velocity_alert_count_30d, CAST(sum(total_alert_count) OVER w AS BIGINT) AS total_alert_count_30d
        FROM risk WHERE feature_date BETWEEN DATE '2023-11-02' AND DATE '2024-01-31' WINDOW w AS (PARTITION BY vendor_id ORDER BY feature_date ROWS 29 PRECEDING)""",
    "ratio": "SELECT vendor_id, feature_date, total_alert_count, invoice_count, total_alert_count / invoice_count AS ratio FROM risk JOIN behave USING (vendor_id, feature_date) WHERE feature_date BETWEEN DATE '2023-11-02' AND DATE '2024-01-31'",
    "trust": """SELECT vendor_id, feature_date AS score_date, greatest(0, 100 - p) AS trust_score, CASE WHEN 100 - p >= 90 THEN 'EXCELLENT' WHEN 100 - p >= 70 THEN 'GOOD' WHEN 100 - p >= 50 THEN 'MODERATE' ELSE 'HIGH' END AS risk_level,
        CAST(0 AS BIGINT) AS behavioral_penalty, p AS risk_penalty, p AS total_penalty, anomaly_alert_count, velocity_alert_count, duplicate_alert_count, total_alert_count, invoice_count
        FROM (SELECT *, CAST(anomaly_alert_count * 15 + velocity_alert_count * 10 + duplicate_alert_count * 5 AS BIGINT) AS p FROM feats)""",
    "ranked": "SELECT score_date AS ranking_date, vendor_id, trust_score, risk_level, row_number() OVER (PARTITION BY score_date ORDER BY trust_score, vendor_id) AS risk_rank FROM trust",
    "ranks": "SELECT r.ranking_date, r.vendor_id, r.trust_score, r.risk_rank, r.risk_level, r.risk_rank - p.risk_rank AS rank_change FROM ranked r LEFT JOIN ranked p ON p.vendor_id = r.vendor_id AND p.ranking_date + 1 = r.ranking_date",
    "today": "SELECT * FROM trust WHERE score_date = DATE '2024-01-30'",
    "last_trust": "SELECT * FROM trust WHERE score_date = (SELECT max(score_date) FROM trust)",
    "last_ranks": "SELECT * FROM ranks WHERE ranking_date = (SELECT max(ranking_date) FROM ranks)",
    "day_ranks": "SELECT * FROM ranks WHERE ranking_date = DATE '2024-01-30'",
    "lines": "SELECT l_orderkey || '-' || l_linenumber AS invoice_id, CAST(l_suppkey AS VARCHAR) AS vendor_id, CAST(l_extendedprice AS DECIMAL(15,2)) AS invoice_amount, l_shipdate AS invoice_timestamp, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, CAST(l_suppkey AS VARCHAR), l_partkey, l_quantity, CAST(l_extendedprice AS DECIMAL(15,2))) AS occurrence FROM lineitem",
}

_BY_RULE = "SELECT rule_name, severity, count(*) AS alert_count, count(DISTINCT vendor_id) AS unique_vendors, count(DISTINCT invoice_id) AS unique_invoices, {avg} AS avg_fraud_score, min(detected_at) AS first_alert, max(detected_at) AS last_alert FROM {of} GROUP BY rule_name, severity"
_MEAN_SCORE = _r("avg(fraud_score)", 2)
_MEAN_SCORE1 = _r("avg(fraud_score)", 1)
_TIER = "CASE WHEN risk_rank <= 10 THEN 'Top 10 (Highest Risk)' WHEN risk_rank <= 50 THEN 'Top 50' WHEN risk_rank <= 100 THEN 'Top 100' ELSE 'Beyond Top 100' END"
_SHOULD = "CAST(greatest(0, 100 - (anomaly_alert_count * 15 + velocity_alert_count * 10 + duplicate_alert_count * 5)) AS BIGINT)"

QUERIES = {
    "bronze_union": "SELECT source_system, event_type, count(*) AS events, count(DISTINCT event_uuid) AS uuids, min(event_timestamp) AS first_event, max(event_timestamp) AS last_event FROM bronze GROUP BY ALL",
    "silver_dedup": "SELECT invoice_id, vendor_id, invoice_amount, invoice_timestamp FROM lines WHERE occurrence = 1",
    "dedup_duplicates": "SELECT invoice_id, vendor_id, invoice_amount, invoice_timestamp, occurrence FROM lines WHERE occurrence > 1",
    "dedup_invariant": "SELECT invoice_id, vendor_id, invoice_amount, count(*) AS occurrence_count, min(invoice_timestamp) AS first_seen, max(invoice_timestamp) AS last_seen, date_diff('second', min(invoice_timestamp), max(invoice_timestamp)) AS seconds_between FROM resent WHERE CAST(invoice_timestamp AS DATE) >= DATE '2024-01-24' GROUP BY ALL HAVING count(*) > 1",
    "baseline_90d": "SELECT * FROM base",
    "anomaly_alerts": "SELECT invoice_id, vendor_id, severity, fraud_score, amount, baseline_avg, z_score, deviation_pct FROM anomaly",
    "fallback_alerts": "SELECT invoice_id, vendor_id, severity, fraud_score, reason, amount, fallback_reason FROM fallback",
    "velocity_groups": "SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, vendor_id, amount, count(*) AS occurrences, string_agg(invoice_id, ',' ORDER BY invoice_id) AS invoice_ids FROM placed GROUP BY window_start, vendor_id, amount HAVING count(*) >= 3",
    "velocity_alerts": "SELECT invoice_id, vendor_id, severity, fraud_score, window_start, window_end, amount, occurrences FROM velocity",
    "gold_alerts": "SELECT invoice_id, vendor_id, rule_name, severity, fraud_score, window_start, window_end, alert_source, detected_at, amount FROM gold",
    "behavioral_daily": "SELECT * FROM behave",
    "risk_daily": "SELECT * FROM risk",
    "features_view": "SELECT vendor_id, feature_date, invoice_count, total_invoice_amount, anomaly_alert_count, velocity_alert_count, duplicate_alert_count, total_alert_count FROM feats",
    "risk_tier_days": "SELECT vendor_id, feature_date, CASE WHEN r > 0.5 THEN 'CRITICAL' WHEN r > 0.2 THEN 'HIGH' WHEN r > 0 THEN 'MEDIUM' ELSE 'CLEAN' END AS risk_tier, CAST(r > 0 AS INTEGER) AS is_risky FROM (SELECT *, total_alert_count / invoice_count AS r FROM feats)",
    "rolling_behavioral": "SELECT * FROM rollb",
    "rolling_risk": "SELECT * FROM rollr",
    "alert_ratio": f"SELECT vendor_id, feature_date, total_alert_count, invoice_count, {_r('ratio', 4)} AS high_risk_alert_ratio FROM ratio",
    "trust_scores": "SELECT vendor_id, score_date, trust_score, risk_level, behavioral_penalty, risk_penalty, total_penalty, anomaly_alert_count, velocity_alert_count, duplicate_alert_count, total_alert_count, NULL::DOUBLE AS ml_fraud_probability, NULL::VARCHAR AS ml_model_version FROM trust",
    "trust_explanation_fields": "SELECT vendor_id, score_date, CAST(100 AS BIGINT) AS base_score, anomaly_alert_count * 15 AS anomaly_penalty, velocity_alert_count * 10 AS velocity_penalty, trust_score AS final_score, risk_level, invoice_count FROM trust",
    "risk_rankings": "SELECT * FROM ranks",
    "layer_health": """SELECT layer, row_count, CASE WHEN row_count > 0 THEN good ELSE 'No data' END AS status FROM (SELECT 'bronze' AS layer, 'Data ingested' AS good, count(*) AS row_count FROM bronze WHERE CAST(event_timestamp AS DATE) >= DATE '2024-01-24'
        UNION ALL SELECT 'silver', 'Deduplication working', count(*) FROM silver WHERE CAST(invoice_timestamp AS DATE) >= DATE '2024-01-24' UNION ALL SELECT 'gold', 'Fraud detection active', count(*) FROM recent)""",
    "alerts_by_rule": _BY_RULE.format(avg=_MEAN_SCORE, of="recent"),
    "anomaly_fallback_by_rule": _BY_RULE.format(avg=_MEAN_SCORE, of="gold WHERE rule_name <> 'VELOCITY'"),
    "alerts_top50": "SELECT invoice_id, vendor_id, rule_name, severity, fraud_score, amount, z_score, occurrences, fraud_pattern, alert_source, window_start, window_end, detected_at FROM recent ORDER BY fraud_score DESC, detected_at DESC, invoice_id, rule_name, window_start NULLS FIRST LIMIT 50",
    "velocity_deep_dive": "SELECT vendor_id, amount AS repeated_amount, occurrences AS occurrence_count, CAST(86400 AS BIGINT) AS window_seconds, count(DISTINCT invoice_id) AS unique_flagged_invoices, min(window_start) AS burst_start, max(window_end) AS burst_end, string_agg(DISTINCT severity, ',' ORDER BY severity) AS severities FROM recent WHERE rule_name = 'VELOCITY' GROUP BY vendor_id, amount, occurrences",
    "anomaly_deep_dive": "SELECT vendor_id, invoice_id, severity, fraud_score, amount AS invoice_amount, baseline_avg, baseline_stddev, z_score, deviation_pct, reason, detected_at FROM anomaly WHERE CAST(detected_at AS DATE) >= DATE '2024-01-24' ORDER BY abs(z_score) DESC, invoice_id LIMIT 20",
    "fallback_analysis": f"SELECT vendor_id, fallback_reason AS reason, count(*) AS fallback_count, {_r('avg(CAST(amount AS DOUBLE))', 2)} AS avg_amount, min(amount) AS min_amount, max(amount) AS max_amount, min(detected_at) AS first_seen, max(detected_at) AS last_seen FROM recent WHERE rule_name = 'FALLBACK' GROUP BY ALL",
    "top_risky_vendors": f"""SELECT vendor_id, count(*) AS total_alerts, count(*) FILTER (rule_name = 'VELOCITY') AS velocity_alerts, count(*) FILTER (rule_name = 'ANOMALY') AS anomaly_alerts, count(*) FILTER (rule_name = 'FALLBACK') AS fallback_alerts, count(*) FILTER (severity = 'CRITICAL') AS critical_count,
        count(*) FILTER (severity = 'HIGH') AS high_count, count(*) FILTER (severity = 'MEDIUM') AS medium_count, {_MEAN_SCORE1} AS avg_fraud_score, max(fraud_score) AS max_fraud_score FROM recent GROUP BY vendor_id HAVING count(*) >= 3 ORDER BY avg_fraud_score DESC, total_alerts DESC, vendor_id LIMIT 10""",
    "funnel": f"""SELECT stage, event_count, unique_invoices, {_r("100.0::DOUBLE * unique_invoices / nullif(event_count, 0)", 2)} AS dedup_effectiveness_pct, before AS prev_stage_count, {_r("100.0::DOUBLE * event_count / nullif(before, 0)", 2)} AS conversion_pct FROM (SELECT *, lag(event_count) OVER (ORDER BY k) AS before FROM (
        SELECT 1 AS k, 'bronze_erp' AS stage, count(*) AS event_count, count(DISTINCT invoice_id) AS unique_invoices FROM bronze WHERE source_system = 'ERP' AND CAST(event_timestamp AS DATE) >= DATE '2024-01-24'
        UNION ALL SELECT 2, 'silver_invoices', count(*), count(DISTINCT invoice_id) FROM silver WHERE CAST(invoice_timestamp AS DATE) >= DATE '2024-01-24' UNION ALL SELECT 3, 'gold_alerts', count(*), count(DISTINCT invoice_id) FROM recent))""",
    "hourly_pattern": f"SELECT CAST(date_trunc('hour', detected_at) AS TIMESTAMP) AS hour_bucket, rule_name, count(*) AS alert_count, count(DISTINCT vendor_id) AS vendor_count, {_MEAN_SCORE1} AS avg_score, array_to_string(list_sort(list(DISTINCT severity))[1:3], ',') AS severities FROM recent GROUP BY ALL",
    "kpi_summary": f"""SELECT 'SUMMARY' AS category, metric, value FROM (SELECT 'Total Fraud Alerts' AS metric, CAST(count(*) AS DOUBLE) AS value FROM recent UNION ALL SELECT 'Velocity Alerts', count(*) FROM recent WHERE rule_name = 'VELOCITY' UNION ALL SELECT 'Anomaly Alerts', count(*) FROM recent WHERE rule_name = 'ANOMALY'
        UNION ALL SELECT 'Critical Severity', count(*) FROM recent WHERE severity = 'CRITICAL' UNION ALL SELECT 'Avg Fraud Score', {_MEAN_SCORE1} FROM recent UNION ALL SELECT 'Flagged Vendors', count(DISTINCT vendor_id) FROM recent UNION ALL SELECT 'Total Invoices Processed', count(*) FROM silver WHERE CAST(invoice_timestamp AS DATE) >= DATE '2024-01-24')""",
    "streaming_health": """SELECT *, CAST(floor((epoch_us(latest) - epoch_us(earliest)) / 1000000) AS BIGINT) AS span_seconds FROM (SELECT 'bronze' AS layer, count(*) AS row_count, min(event_timestamp) AS earliest, max(event_timestamp) AS latest FROM bronze WHERE event_timestamp >= TIMESTAMP '2024-01-30 00:00:00'
        UNION ALL SELECT 'silver', count(*), min(invoice_timestamp), max(invoice_timestamp) FROM silver WHERE invoice_timestamp >= TIMESTAMP '2024-01-30 00:00:00' UNION ALL SELECT 'gold', count(*), min(detected_at), max(detected_at) FROM fresh)""",
    "streaming_lag": """SELECT *, CAST(floor((epoch_us(latest_ingest_time) - epoch_us(latest_event_time)) / 1000000) AS BIGINT) AS processing_lag_seconds FROM (SELECT 'bronze' AS layer, count(*) AS events, max(event_timestamp) AS latest_event_time, max(ingested_at) AS latest_ingest_time FROM bronze WHERE ingested_at >= TIMESTAMP '2024-01-30 00:00:00'
        UNION ALL SELECT 'silver', count(*), max(invoice_timestamp), max(ingested_at) FROM silver WHERE ingested_at >= TIMESTAMP '2024-01-30 00:00:00')""",
    "streaming_last_alerts": "SELECT detected_at, invoice_id, vendor_id, rule_name, severity, fraud_score, amount, z_score, occurrences, alert_source FROM fresh ORDER BY detected_at DESC, fraud_score DESC, invoice_id, rule_name, window_start NULLS FIRST LIMIT 20",
    "streaming_by_rule": _BY_RULE.format(avg=_MEAN_SCORE1, of="fresh"),
    "schema_columns": "SELECT 'gold_fraud_alerts' AS table_name, * FROM (VALUES ('invoice_id', 1, 'string'), ('vendor_id', 2, 'string'), ('rule_name', 3, 'string'), ('severity', 4, 'string'), ('reason', 5, 'string'), ('evidence', 6, 'string'), ('window_start', 7, 'timestamp_ntz'), ('window_end', 8, 'timestamp_ntz'), ('fraud_score', 9, 'bigint'), ('alert_source', 10, 'string'), ('detected_at', 11, 'timestamp_ntz')) AS t(column_name, ordinal_position, data_type)",
    "streaming_duplicates": "SELECT invoice_id, count(*) AS occurrence_count, min(invoice_timestamp) AS first_seen, max(invoice_timestamp) AS last_seen, date_diff('second', min(invoice_timestamp), max(invoice_timestamp)) AS seconds_apart FROM resent WHERE CAST(invoice_timestamp AS DATE) >= DATE '2024-01-30' GROUP BY ALL HAVING count(*) > 1",
    "json_payload_extract": "SELECT event_uuid, source_system, event_type, invoice_id AS invoice_id_from_payload, vendor_id AS vendor_id_from_payload, invoice_amount AS amount_from_payload FROM bronze WHERE source_system = 'ERP' AND event_timestamp >= TIMESTAMP '2024-01-30 00:00:00' ORDER BY event_uuid LIMIT 50",
    "props_json": "SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n, count(DISTINCT vendor_id) AS vendors FROM inv GROUP BY ALL",
    "json_evidence_extract": "SELECT invoice_id, vendor_id, rule_name, amount, baseline_avg, z_score, occurrences, fraud_pattern FROM fresh ORDER BY invoice_id, rule_name, window_start NULLS FIRST LIMIT 50",
    "window_validation": "SELECT invoice_id, vendor_id, rule_name, window_start, window_end, CAST((epoch_us(window_end) - epoch_us(window_start)) // 1000000 AS BIGINT) AS window_duration_seconds, detected_at, CASE WHEN window_start IS NULL THEN 'No window (anomaly/fallback)' WHEN window_start > TIMESTAMP '2024-01-30 04:00:00' THEN 'Future timestamp!' WHEN window_start < TIMESTAMP '2024-01-23 04:00:00' THEN 'Very old' ELSE 'Valid' END AS window_validation FROM gold WHERE detected_at BETWEEN TIMESTAMP '2024-01-30 03:00:00' AND TIMESTAMP '2024-01-30 04:00:00' ORDER BY detected_at DESC, invoice_id, rule_name, window_start NULLS FIRST LIMIT 20",
    "score_distribution_all": f"SELECT rule_name, min(fraud_score) AS min_score, max(fraud_score) AS max_score, {_MEAN_SCORE1} AS avg_score, quantile_disc(fraud_score, 0.5) AS median_score, quantile_disc(fraud_score, 0.9) AS p90_score, count(*) AS alert_count, count(*) FILTER (fraud_score < 0 OR fraud_score > 100) AS invalid_scores FROM gold GROUP BY rule_name",
    "score_distribution": f"SELECT rule_name, min(fraud_score) AS min_score, max(fraud_score) AS max_score, {_MEAN_SCORE1} AS avg_score, quantile_disc(fraud_score, 0.5) AS median_score, quantile_disc(fraud_score, 0.9) AS p90_score, count(*) AS alert_count, count(*) FILTER (fraud_score < 0 OR fraud_score > 100) AS invalid_scores FROM gold WHERE detected_at BETWEEN TIMESTAMP '2024-01-30 03:00:00' AND TIMESTAMP '2024-01-30 04:00:00' GROUP BY rule_name",
    "score_distribution_sketched": f"SELECT rule_name, min(fraud_score) AS min_score, max(fraud_score) AS max_score, {_MEAN_SCORE1} AS avg_score, count(*) AS alert_count, count(*) FILTER (fraud_score < 0 OR fraud_score > 100) AS invalid_scores, true AS median_holds, true AS p90_holds FROM gold GROUP BY rule_name",
    "baseline_sketched": "SELECT vendor_id, n, avg_invoice_amount, stddev_invoice_amount, avg_daily_invoice_cnt, true AS p99_holds FROM base JOIN (SELECT vendor_id, count(*) AS n FROM inv WHERE CAST(invoice_timestamp AS DATE) > DATE '2023-11-02' AND CAST(invoice_timestamp AS DATE) <= DATE '2024-01-31' GROUP BY 1) USING (vendor_id)",
    "dedup_holds": "SELECT count(DISTINCT invoice_id) AS ids, count(*) - count(DISTINCT invoice_id) AS repeated_ids FROM silver",
    "random_sample": f"SELECT vendor_id, trust_score, anomaly_alert_count, velocity_alert_count, duplicate_alert_count, {_SHOULD} AS calculated_score, CASE WHEN trust_score = {_SHOULD} THEN 'PASS' ELSE 'FAIL' END AS verification FROM last_trust ORDER BY sha256('7/' || vendor_id), vendor_id LIMIT 20",
    "ingest_receipts": """SELECT 'WH-' || (o_orderkey % 7) AS wh_id, CAST(o_orderkey AS VARCHAR) AS po_no, CAST(o_custkey AS VARCHAR) AS vendor_id, CAST(o_orderkey % 40 AS VARCHAR) AS upc_no, CAST(o_custkey % 90 + 1 AS BIGINT) AS qty_received,
        CAST(date_trunc('second', o_orderdate) AS TIMESTAMP) AS received_timestamp FROM orders WHERE o_orderkey % 40 > 3""",
    "ingest_receipt_dead_letters": "SELECT 'WMS' AS feed, CASE o_orderkey % 40 WHEN 0 THEN 'not a JSON object' WHEN 1 THEN 'missing vendor_id' WHEN 2 THEN 'bad qty_received' ELSE 'bad received_timestamp' END AS err, count(*) AS n_lines, count(DISTINCT o_orderkey) AS n_ids FROM orders WHERE o_orderkey % 40 <= 3 GROUP BY o_orderkey % 40",
    "throughput_per_minute": "SELECT CAST(date_trunc('minute', ingested_at) AS TIMESTAMP) AS minute_bucket, count(*) AS messages_per_minute, count(DISTINCT vendor_id) AS unique_vendors FROM bronze WHERE ingested_at >= TIMESTAMP '2024-01-30 00:00:00' GROUP BY ALL ORDER BY minute_bucket DESC LIMIT 60",
    "e2e_latency": """SELECT b.invoice_id, count(*) AS alerts, CAST(floor((epoch_us(s.ingested_at) - epoch_us(b.ingested_at)) / 1000000) AS BIGINT) AS bronze_to_silver_sec, CAST(floor((epoch_us(g.detected_at) - epoch_us(s.ingested_at)) / 1000000) AS BIGINT) AS silver_to_gold_sec, CAST(floor((epoch_us(g.detected_at) - epoch_us(b.ingested_at)) / 1000000) AS BIGINT) AS total_latency_sec
        FROM (SELECT * FROM bronze WHERE source_system = 'ERP' AND ingested_at >= TIMESTAMP '2024-01-30 00:00:00') b LEFT JOIN (SELECT * FROM silver WHERE ingested_at >= TIMESTAMP '2024-01-30 00:00:00') s ON s.invoice_id = b.invoice_id JOIN fresh g ON g.invoice_id = b.invoice_id GROUP BY b.invoice_id, b.ingested_at, s.ingested_at, g.detected_at""",
    "rolling_coverage": """SELECT 'behavioral_features' AS table_name, count(*) AS total_rows, count(invoice_count_7d) AS rows_with_7d, count(invoice_count_30d) AS rows_with_30d, CAST(100.0 AS DOUBLE) * count(invoice_count_7d) / nullif(count(*), 0) AS pct_7d_coverage, CAST(100.0 AS DOUBLE) * count(invoice_count_30d) / nullif(count(*), 0) AS pct_30d_coverage FROM rollb
        UNION ALL SELECT 'risk_features', count(*), NULL, count(anomaly_alert_count_30d), NULL, CAST(100.0 AS DOUBLE) * count(anomaly_alert_count_30d) / nullif(count(*), 0) FROM rollr""",
    "ratio_validity": f"SELECT CASE WHEN ratio IS NULL THEN 'MISSING' WHEN ratio > 1 THEN 'INVALID (>1.0)' WHEN ratio < 0 THEN 'INVALID (<0.0)' ELSE 'VALID' END AS validation_status, count(*) AS vendor_days, {_r('max(ratio)', 4)} AS largest_ratio FROM ratio GROUP BY 1",
    "spike_ratio": f"SELECT vendor_id, feature_date, invoice_count AS today_count, invoice_count_7d AS rolling_7d, invoice_count_30d AS rolling_30d, {_r('invoice_count / (invoice_count_7d / 7.0::DOUBLE)', 2)} AS vs_7d_avg_ratio FROM rollb WHERE feature_date >= DATE '2024-01-24' ORDER BY vs_7d_avg_ratio DESC, vendor_id, feature_date LIMIT 10",
    "trust_row_counts": "SELECT 'behavioral_features' AS table_name, count(*) AS row_count, min(feature_date) AS earliest_date, max(feature_date) AS latest_date FROM behave UNION ALL SELECT 'risk_features', count(*), min(feature_date), max(feature_date) FROM risk UNION ALL SELECT 'trust_scores', count(*), min(score_date), max(score_date) FROM trust UNION ALL SELECT 'vendor_rankings', count(*), min(ranking_date), max(ranking_date) FROM ranks",
    "data_quality": """SELECT 'trust_score_range_violation' AS violation_type, count(*) AS violation_count FROM trust WHERE trust_score < 0 OR trust_score > 100 UNION ALL SELECT 'invalid_risk_level', count(*) FROM trust WHERE risk_level NOT IN ('EXCELLENT', 'GOOD', 'MODERATE', 'HIGH')
        UNION ALL SELECT 'negative_alert_count', count(*) FROM trust WHERE least(anomaly_alert_count, velocity_alert_count, duplicate_alert_count) < 0 UNION ALL SELECT 'penalty_mismatch', count(*) FROM trust WHERE total_penalty <> behavioral_penalty + risk_penalty
        UNION ALL SELECT 'ranking_gap', count(*) FROM (SELECT risk_rank - lag(risk_rank) OVER (PARTITION BY ranking_date ORDER BY risk_rank) AS gap FROM ranks) WHERE gap <> 1""",
    "score_ranges": f"SELECT CASE WHEN trust_score >= 90 THEN '90-100 (EXCELLENT)' WHEN trust_score >= 70 THEN '70-89 (GOOD)' WHEN trust_score >= 50 THEN '50-69 (MODERATE)' ELSE '0-49 (HIGH)' END AS score_range, count(*) AS vendor_count, {_r('avg(trust_score)', 1)} AS avg_score, min(trust_score) AS min_score, max(trust_score) AS max_score FROM last_trust GROUP BY 1",
    "rank_tiers": f"SELECT {_TIER} AS rank_tier, count(*) AS vendor_count, min(trust_score) AS min_trust_score, max(trust_score) AS max_trust_score, {_r('avg(trust_score)', 1)} AS avg_trust_score, count(*) FILTER (risk_level = 'HIGH') AS high_risk_count, count(*) FILTER (risk_level = 'MODERATE') AS moderate_risk_count, count(*) FILTER (risk_level = 'GOOD') AS good_risk_count, count(*) FILTER (risk_level = 'EXCELLENT') AS excellent_risk_count FROM last_ranks GROUP BY 1",
    "rank_tiers_of_day": "SELECT CASE WHEN risk_rank <= 10 THEN 'Top 10 (Highest Risk)' WHEN risk_rank <= 50 THEN 'Top 50' WHEN risk_rank <= 100 THEN 'Top 100' ELSE 'Below Top 100' END AS rank_tier, count(*) AS vendor_count, count(*) FILTER (risk_level = 'HIGH') AS high_risk_count, count(*) FILTER (risk_level = 'MODERATE') AS moderate_risk_count, count(*) FILTER (risk_level = 'GOOD') AS good_risk_count, count(*) FILTER (risk_level = 'EXCELLENT') AS excellent_risk_count FROM day_ranks GROUP BY 1",
    "ingest_parsed": "SELECT CAST(event_id AS VARCHAR) AS invoice_id, event_type AS po_no, CAST(user_id AS VARCHAR) AS vendor_id, CAST(value AS DECIMAL(15,2)) AS invoice_amount, ts AS invoice_timestamp, sha256('DE00 1234') AS bank_account_hash FROM events WHERE event_id % 50 > 3",
    "ingest_dead_letters": "SELECT 'ERP' AS feed, CASE event_id % 50 WHEN 0 THEN 'not a JSON object' WHEN 1 THEN 'missing vendor_id' WHEN 2 THEN 'bad invoice_amount' ELSE 'bad invoice_timestamp' END AS err, count(*) AS n_lines, count(*) AS n_ids, CAST(0 AS BIGINT) AS n_unmasked FROM events WHERE event_id % 50 <= 3 GROUP BY event_id % 50",
    "ingest_upsert": "SELECT vendor_id, feature_date, invoice_count, total_invoice_amount, avg_invoice_amount, min_invoice_amount, max_invoice_amount FROM behave",
    "trend_categories": f"SELECT CASE WHEN span = 0 THEN 'No change' WHEN span <= 10 THEN 'Minor change' WHEN span <= 30 THEN 'Moderate change' ELSE 'Major change' END AS trend_category, count(*) AS vendor_count, {_r('avg(days)', 1)} AS avg_days_tracked, {_r('avg(span)', 1)} AS avg_score_range FROM (SELECT vendor_id, count(DISTINCT score_date) AS days, max(trust_score) - min(trust_score) AS span FROM trust GROUP BY vendor_id) GROUP BY 1",
    "explainability": "SELECT count(*) AS total_scores, count(*) AS explanations_exist, count(*) AS has_base_score, count(*) AS has_final_score, count(*) AS has_risk_level, count(*) AS has_reasoning FROM last_trust",
    "top10_riskiest": "SELECT risk_rank, vendor_id, trust_score, risk_level, CASE WHEN rank_change IS NULL THEN 'NEW' WHEN rank_change < 0 THEN 'up ' || abs(rank_change) WHEN rank_change > 0 THEN 'down ' || rank_change ELSE '=' END AS rank_movement FROM last_ranks ORDER BY risk_rank LIMIT 10",
    "formula_check": f"SELECT vendor_id, trust_score, anomaly_alert_count, velocity_alert_count, duplicate_alert_count, {_SHOULD} AS calculated_score, CASE WHEN trust_score = {_SHOULD} THEN 'PASS' ELSE 'FAIL' END AS verification FROM last_trust",
    "ml_readiness": "SELECT count(*) AS total_records, count(*) AS ml_prob_null_count, count(*) AS ml_version_null_count FROM last_trust",
    "overall_status": "SELECT 'Trust scores' AS component, CASE WHEN (SELECT count(*) FROM trust) > 0 AND (SELECT count(*) FROM ranks) > 0 AND (SELECT count(*) FROM trust WHERE trust_score NOT BETWEEN 0 AND 100) = 0 THEN 'PASS' ELSE 'FAIL' END AS status",
    "vendors_processed": f"SELECT count(*) AS vendors, min(trust_score) AS min_score, max(trust_score) AS max_score, {_r('avg(trust_score)', 2)} AS avg_score FROM today",
    "risk_level_distribution": "SELECT risk_level, count(*) AS vendor_count FROM today GROUP BY 1",
    "lowest_trust10": "SELECT vendor_id, trust_score, risk_level, total_alert_count FROM today ORDER BY trust_score, vendor_id LIMIT 10",
    "score_degradation": "SELECT c.vendor_id, c.trust_score, p.trust_score AS prev_trust_score, c.trust_score - p.trust_score AS score_change FROM today c JOIN trust p ON p.vendor_id = c.vendor_id AND p.score_date = DATE '2024-01-23' WHERE c.trust_score - p.trust_score < -20",
    "vendor_explanation": "SELECT vendor_id, trust_score, risk_level, total_penalty AS explained_penalty FROM today WHERE vendor_id = '1'",
    "rank_movers_up": "SELECT vendor_id, trust_score, risk_rank, rank_change, 'up by ' || abs(rank_change) AS movement FROM day_ranks WHERE rank_change < 0 ORDER BY rank_change, vendor_id LIMIT 20",
    "rank_movers_down": "SELECT vendor_id, trust_score, risk_rank, rank_change, 'down by ' || rank_change AS movement FROM day_ranks WHERE rank_change > 0 ORDER BY rank_change DESC, vendor_id LIMIT 20",
    "rank_top10": "SELECT risk_rank, vendor_id, trust_score, risk_level FROM day_ranks ORDER BY risk_rank LIMIT 10",
    "rank_new_vendors": "SELECT vendor_id, trust_score, risk_rank, risk_level FROM day_ranks WHERE rank_change IS NULL",
    "persistent_top20": "SELECT f.vendor_id, f.days_in_top_20, d.risk_rank AS current_rank, d.trust_score AS current_trust_score FROM (SELECT vendor_id, count(*) AS days_in_top_20 FROM ranks WHERE risk_rank <= 20 AND ranking_date BETWEEN DATE '2024-01-23' AND DATE '2024-01-30' GROUP BY 1 HAVING count(*) >= 2) f JOIN day_ranks d USING (vendor_id)",
}


def _with(sql: str) -> str:
    """The query behind a WITH of the layers that it needs, in order."""
    needed, todo = set(), [sql]
    while todo:
        text = todo.pop()
        for name in LAYERS:
            if name not in needed and re.search(rf"(?:FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                todo.append(LAYERS[name])
    held = ",\n".join(f"{n} AS ({s})" for n, s in LAYERS.items() if n in needed)
    return f"WITH {held}\n{sql}" if held else sql


#: Folding an id's accepted times in order takes recursion: one step to the next row at least 60 days after the last accepted one.
DEDUP_TTL = """WITH RECURSIVE r AS (SELECT CAST(l_partkey AS VARCHAR) AS invoice_id, l_shipdate AS t FROM lineitem),
    acc AS (SELECT invoice_id, min(t) AS t FROM r GROUP BY 1 UNION ALL SELECT a.invoice_id, (SELECT min(r.t) FROM r WHERE r.invoice_id = a.invoice_id AND r.t >= a.t + INTERVAL 60 DAY) FROM acc a WHERE a.t IS NOT NULL),
    n AS (SELECT invoice_id, count(t) AS accepted FROM acc GROUP BY 1)
    SELECT invoice_id, n_rows, accepted FROM (SELECT invoice_id, count(*) AS n_rows FROM r GROUP BY 1) JOIN n USING (invoice_id)"""


def oracle_sql() -> dict[str, str]:
    return {name: _with(sql) for name, sql in QUERIES.items()} | {"dedup_ttl": DEDUP_TTL}
