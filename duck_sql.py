"""SQL counterparts of the registered queries, written independently of the Spark plans.

``_VIEWS`` holds named building blocks; each statement carries those it needs as CTEs.
"""

from __future__ import annotations

import re

_START = "TIMESTAMP '2024-01-01 00:00:00'"
_APPLIED = f"({_START} + to_minutes((k % 30) * 1440 + k % 1380))"

_VIEWS: dict[str, str] = {
    # --- bronze: the four inputs ---
    "keyed": "SELECT *, o_orderkey // 10 AS k FROM orders",
    "b_visits": f"""
        SELECT CAST(user_id AS VARCHAR) AS visitor_id,
               CASE event_type WHEN 'view' THEN 'landing' WHEN 'click' THEN 'scroll'
                    WHEN 'purchase' THEN 'apply_click' WHEN 'signup' THEN 'view_pricing' ELSE event_type END AS event_type,
               CASE WHEN event_id % 13 = 0 THEN NULL ELSE 'CMP' || (event_id % 100) END AS campaign_id,
               CASE WHEN event_id % 25 = 0 THEN 'kiosk' WHEN event_id % 3 = 0 THEN 'mobile'
                    WHEN event_id % 3 = 1 THEN 'desktop' ELSE 'tablet' END AS device_type,
               CASE user_id % 5 WHEN 0 THEN 'USA' WHEN 1 THEN 'UK' WHEN 2 THEN 'IND' WHEN 3 THEN 'CA' ELSE 'FR' END AS geo,
               ts AS timestamp, value AS session_duration, ts + to_hours(event_id % 9) AS _load_timestamp
        FROM events
        UNION ALL
        SELECT CAST(o_custkey AS VARCHAR), 'apply_click',
               CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE 'CMP' || (o_orderkey % 100) END,
               CASE o_orderkey % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END,
               CASE o_custkey % 4 WHEN 0 THEN 'USA' WHEN 1 THEN 'UK' WHEN 2 THEN 'IND' ELSE 'CA' END,
               {_APPLIED} - to_minutes(1 + k % 14), CAST(30 AS DOUBLE),
               {_APPLIED} - to_minutes(1 + k % 14) + to_hours(o_orderkey % 9)
        FROM keyed""",
    "b_apps": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS app_id, CAST(o_custkey AS VARCHAR) AS visitor_id,
               CASE WHEN k % 97 = 0 THEN NULL ELSE 10 + k % 60 END AS applicant_age,
               o_totalprice AS annual_income,
               CASE WHEN k % 41 = 0 THEN 'retired' WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'salaried'
                    WHEN o_orderpriority = '5-LOW' THEN 'unemployed' ELSE 'self-employed' END AS employment_status,
               o_totalprice * CASE WHEN k % 19 = 0 THEN CAST(1.75 AS DOUBLE) WHEN k % 23 = 0 THEN CAST(0.75 AS DOUBLE)
                    ELSE CAST(0.125 AS DOUBLE) END AS req_credit_limit,
               {_APPLIED} AS timestamp,
               CASE o_orderstatus WHEN 'F' THEN 'approved' WHEN 'O' THEN 'submitted' ELSE 'rejected' END AS application_status,
               {_APPLIED} + to_hours(k % 9) AS _load_timestamp
        FROM (SELECT * FROM keyed UNION ALL SELECT * FROM keyed WHERE k % 37 = 0)""",
    "b_accounts": f"""
        SELECT CAST(1000000 + o_orderkey AS VARCHAR) AS account_id, CAST(o_orderkey AS VARCHAR) AS app_id,
               CASE WHEN k % 53 = 0 THEN 0 ELSE CAST(floor(o_totalprice * (1 + k % 4) / 4) AS BIGINT) END AS approved_limit,
               4.5::DOUBLE + (k % 64) * 0.5::DOUBLE AS interest_rate,
               {_APPLIED} + to_hours(2 + k % 22) AS account_open_timestamp, 'active' AS account_status,
               {_APPLIED} + to_hours(3 + k % 22) AS _load_timestamp
        FROM keyed WHERE o_orderstatus <> 'P'""",
    "b_txns": f"""
        SELECT CAST(l_orderkey * 1000000 + l_partkey * 10 + l_linenumber AS VARCHAR) AS txn_id,
               CAST(1000000 + l_orderkey AS VARCHAR) AS account_id, l_extendedprice AS amount,
               '5411' AS merchant_cat_code, 'N' || (l_suppkey % 25) AS location, 'NA' AS state, 'none' AS merchant_city,
               {_START} + to_minutes(((l_orderkey // 10) % 30 + l_linenumber % 3) * 1440 + (l_orderkey + l_partkey) % 1440) AS timestamp,
               {_START} + to_minutes(((l_orderkey // 10) % 30 + l_linenumber % 3) * 1440 + (l_orderkey + l_partkey) % 1440)
                   + to_hours(l_linenumber) AS _load_timestamp
        FROM lineitem""",
    # --- rule outcomes: one 0/1 column per rule, NULL counts as failed ---
    "r_visits": """
        SELECT *, CASE WHEN visitor_id IS NOT NULL THEN 0 ELSE 1 END AS tdq_id_not_null,
               CASE WHEN timestamp > TIMESTAMP '2023-12-01 00:00:00' THEN 0 ELSE 1 END AS tdq_freshness_check,
               CASE WHEN event_type IN ('landing', 'scroll', 'apply_click') THEN 0 ELSE 1 END AS tdq_valid_event_type,
               CASE WHEN device_type IN ('mobile', 'desktop', 'tablet') THEN 0 ELSE 1 END AS tdq_valid_device,
               CASE WHEN geo IN ('USA', 'UK', 'IND', 'CA') THEN 0 ELSE 1 END AS tdq_valid_geo
        FROM b_visits""",
    "r_apps": """
        SELECT *, CASE WHEN app_id IS NOT NULL THEN 0 ELSE 1 END AS tdq_app_id_not_null,
               CASE WHEN applicant_age >= 0 AND applicant_age <= 100 THEN 0 ELSE 1 END AS tdq_age_numeric_range,
               CASE WHEN annual_income > 0 THEN 0 ELSE 1 END AS tdq_income_positive,
               CASE WHEN employment_status IN ('salaried', 'self-employed', 'unemployed') THEN 0 ELSE 1 END AS tdq_valid_employment,
               CASE WHEN application_status IN ('submitted', 'approved', 'rejected', 'rejected - under age') THEN 0 ELSE 1 END
                   AS tdq_valid_app_status
        FROM b_apps""",
    "r_accounts": """
        SELECT *, CASE WHEN account_id IS NOT NULL THEN 0 ELSE 1 END AS tdq_account_id_not_null,
               CASE WHEN approved_limit > 0 THEN 0 ELSE 1 END AS tdq_limit_positive,
               CASE WHEN interest_rate >= 5 AND interest_rate <= 35 THEN 0 ELSE 1 END AS tdq_interest_rate_range
        FROM b_accounts""",
    "r_txns": """
        SELECT *, CASE WHEN txn_id IS NOT NULL THEN 0 ELSE 1 END AS tdq_txn_id_not_null,
               CASE WHEN amount > 0 THEN 0 ELSE 1 END AS tdq_amount_positive
        FROM b_txns""",
    "r_gold_apps": """
        SELECT *, CASE WHEN applicant_age >= 18 THEN 0 ELSE 1 END AS bdq_age_rule,
               CASE WHEN req_credit_limit <= annual_income * 1.5::DOUBLE THEN 0 ELSE 1 END AS bdq_limit_range
        FROM s_apps""",
    # --- silver ---
    "s_visits": """
        SELECT visitor_id, event_type, campaign_id, device_type, geo, timestamp, session_duration, _load_timestamp,
               _load_timestamp AS tdq_processed_at
        FROM r_visits
        WHERE tdq_id_not_null + tdq_freshness_check + tdq_valid_event_type + tdq_valid_device + tdq_valid_geo = 0""",
    "s_apps": """
        SELECT app_id, visitor_id, applicant_age, annual_income, employment_status, req_credit_limit, timestamp,
               application_status, _load_timestamp, _load_timestamp AS tdq_processed_at
        FROM r_apps
        WHERE tdq_app_id_not_null + tdq_age_numeric_range + tdq_income_positive + tdq_valid_employment + tdq_valid_app_status = 0""",
    "s_accounts": """
        SELECT account_id, app_id, approved_limit, interest_rate, account_open_timestamp, account_status, _load_timestamp,
               _load_timestamp AS tdq_processed_at
        FROM r_accounts WHERE tdq_account_id_not_null + tdq_limit_positive + tdq_interest_rate_range = 0""",
    "s_txns": """
        SELECT txn_id, account_id, amount, timestamp, location, 'unknown' AS transaction_status,
               _load_timestamp AS tdq_processed_at
        FROM r_txns WHERE tdq_txn_id_not_null + tdq_amount_positive = 0""",
    # --- gold ---
    "g_apps": """
        SELECT s_apps.*, req_credit_limit / annual_income AS req_income_ratio
        FROM s_apps WHERE applicant_age >= 18 AND req_credit_limit <= annual_income * 1.5::DOUBLE""",
    # --- applications in two runs, those of even days first; a day of the second that ended 2 hours before the last of them is late ---
    "late_apps": """
        SELECT *, day(timestamp) % 2 = 1 AND date_trunc('day', timestamp) + INTERVAL 1 DAY
               <= (SELECT max(timestamp) FROM g_apps WHERE day(timestamp) % 2 = 0) - INTERVAL 2 HOUR AS late
        FROM g_apps WHERE req_income_ratio > 0.6::DOUBLE""",
    "g_txns": """
        SELECT t.txn_id, t.account_id, t.amount, t.timestamp, t.location, a.approved_limit,
               t.amount / a.approved_limit AS txn_limit_ratio
        FROM s_txns t JOIN s_accounts a ON t.account_id = a.account_id
        WHERE t.amount <= a.approved_limit * 1.5::DOUBLE""",
    # --- daily metrics: separate aggregates, then outer joins ---
    "d_visits": """
        SELECT CAST(timestamp AS DATE) AS date, count(visitor_id) AS visits,
               count(CASE WHEN event_type = 'apply_click' THEN 1 END) AS apply_clicks
        FROM s_visits GROUP BY 1""",
    "d_apps": """
        SELECT CAST(timestamp AS DATE) AS date, count(app_id) AS applications,
               count(CASE WHEN application_status = 'approved' THEN 1 END) AS approvals
        FROM g_apps GROUP BY 1""",
    "d_txns": """
        SELECT CAST(timestamp AS DATE) AS date, count(txn_id) AS transactions, avg(amount) AS avg_amount
        FROM g_txns GROUP BY 1""",
    "metrics": """
        SELECT date, coalesce(visits, 0) AS total_visits, coalesce(applications, 0) AS applications_count,
               coalesce(approvals, 0) AS approvals_count, coalesce(transactions, 0) AS total_transactions,
               coalesce(avg_amount, 0) AS avg_txn_amount,
               coalesce(applications / nullif(visits, 0), 0) AS conversion_rate,
               coalesce(approvals / nullif(applications, 0), 0) AS approval_rate,
               coalesce(apply_clicks, 0) AS apply_clicks
        FROM d_visits FULL JOIN d_apps USING (date) FULL JOIN d_txns USING (date)""",
    "a_apps": """
        SELECT CAST(timestamp AS DATE) AS date, count(*) AS app_anomalies_count
        FROM g_apps WHERE req_income_ratio > 0.6::DOUBLE GROUP BY 1""",
    "a_txns": """
        SELECT CAST(timestamp AS DATE) AS date, count(*) AS txn_anomalies_count
        FROM g_txns WHERE txn_limit_ratio > 0.75::DOUBLE GROUP BY 1""",
    # --- quality log, one branch per rule ---
    "log": "\nUNION ALL\n".join(
        f"""SELECT CAST({ts} AS DATE) AS date, '{table}' AS table_name, '{rule}' AS rule, 'drop' AS action,
                   'checked' AS status, count(*) AS checked_rows, CAST(sum({rule}) AS BIGINT) AS failed_rows
            FROM {view} GROUP BY 1"""
        for view, table, ts, rules in (
            ("r_visits", "silver_visitor_events", "timestamp",
             ("tdq_id_not_null", "tdq_freshness_check", "tdq_valid_event_type", "tdq_valid_device", "tdq_valid_geo")),
            ("r_apps", "silver_applications", "timestamp",
             ("tdq_app_id_not_null", "tdq_age_numeric_range", "tdq_income_positive", "tdq_valid_employment",
              "tdq_valid_app_status")),
            ("r_accounts", "silver_accounts", "account_open_timestamp",
             ("tdq_account_id_not_null", "tdq_limit_positive", "tdq_interest_rate_range")),
            ("r_txns", "silver_transactions", "timestamp", ("tdq_txn_id_not_null", "tdq_amount_positive")),
            ("r_gold_apps", "gold_applications", "timestamp", ("bdq_age_rule", "bdq_limit_range")),
        )
        for rule in rules
    ),
    "skipped_log": """
        SELECT CAST(timestamp AS DATE) AS date, 'silver_transactions' AS table_name, 'tdq_valid_txn_status' AS rule,
               'drop' AS action, 'skipped' AS status, 0 AS checked_rows, 0 AS failed_rows
        FROM b_txns GROUP BY 1""",
    "d_failed": "SELECT date, CAST(sum(failed_rows) AS BIGINT) AS failed FROM log WHERE failed_rows > 0 GROUP BY 1",
    "d_compliance": """
        SELECT date, 100.0::DOUBLE * sum(ok) / count(*) AS schema_compliance_pct
        FROM (
            SELECT CAST(timestamp AS DATE) AS date, CASE WHEN tdq_id_not_null + tdq_freshness_check + tdq_valid_event_type
                   + tdq_valid_device + tdq_valid_geo = 0 THEN 1 ELSE 0 END AS ok FROM r_visits
            UNION ALL
            SELECT CAST(timestamp AS DATE), CASE WHEN tdq_app_id_not_null + tdq_age_numeric_range + tdq_income_positive
                   + tdq_valid_employment + tdq_valid_app_status = 0 THEN 1 ELSE 0 END FROM r_apps
            UNION ALL
            SELECT CAST(account_open_timestamp AS DATE), CASE WHEN tdq_account_id_not_null + tdq_limit_positive
                   + tdq_interest_rate_range = 0 THEN 1 ELSE 0 END FROM r_accounts
            UNION ALL
            SELECT CAST(timestamp AS DATE), CASE WHEN tdq_txn_id_not_null + tdq_amount_positive = 0 THEN 1 ELSE 0 END FROM r_txns
        ) GROUP BY 1""",
    "d_lag": """
        SELECT CAST(timestamp AS DATE) AS date,
               avg((epoch_us(tdq_processed_at) - epoch_us(timestamp)) / 3600000000.0::DOUBLE) AS avg_freshness_lag_hours
        FROM (
            SELECT timestamp, tdq_processed_at FROM s_visits
            UNION ALL SELECT timestamp, tdq_processed_at FROM s_apps
            UNION ALL SELECT timestamp, tdq_processed_at FROM s_txns
        ) GROUP BY 1""",
    "d_campaign": """
        SELECT CAST(timestamp AS DATE) AS date,
               100.0::DOUBLE * count(CASE WHEN campaign_id IS NULL THEN 1 END) / count(*) AS campaign_id_null_pct
        FROM b_visits GROUP BY 1""",
    "metrics_full": """
        SELECT metrics.*, coalesce(failed, 0) AS detected_tdq_bdq_anomalies_count,
               coalesce(app_anomalies_count, 0) + coalesce(txn_anomalies_count, 0) AS ml_anomalies_count,
               avg_freshness_lag_hours, schema_compliance_pct, campaign_id_null_pct
        FROM metrics LEFT JOIN d_failed USING (date) LEFT JOIN a_apps USING (date) LEFT JOIN a_txns USING (date)
             LEFT JOIN d_lag USING (date) LEFT JOIN d_compliance USING (date) LEFT JOIN d_campaign USING (date)""",
}

_DAY = "strftime(date, '%Y-%m-%d')"

_TXN_FEATURES = """
    SELECT txn_id, account_id, amount, timestamp, location, approved_limit, txn_limit_ratio
    FROM g_txns"""

_METRICS_BASE = f"""
    SELECT {_DAY} AS date, total_visits, applications_count, approvals_count, total_transactions,
           round(avg_txn_amount, 6) AS avg_txn_amount, round(conversion_rate, 6) AS conversion_rate,
           round(approval_rate, 6) AS approval_rate"""

_APP_ANOMALIES = f"SELECT {_DAY} AS date, app_anomalies_count FROM a_apps"
_TXN_ANOMALIES = f"SELECT {_DAY} AS date, txn_anomalies_count FROM a_txns"

_GOLD_ACCOUNTS = """
    SELECT a.account_id, a.app_id, a.approved_limit, a.interest_rate, a.account_open_timestamp,
           p.applicant_age, p.annual_income
    FROM s_accounts a JOIN g_apps p ON a.app_id = p.app_id WHERE p.application_status = 'approved'"""

_QUERIES: dict[str, str] = {
    "silver_visitor_events": "SELECT * FROM s_visits WHERE timestamp > TIMESTAMP '2024-01-29 00:00:00'",
    "silver_visitor_events_replay": "SELECT * FROM s_visits",
    "silver_applications": "SELECT * FROM s_apps",
    "silver_accounts": "SELECT * FROM s_accounts",
    "silver_transactions": "SELECT * FROM s_txns",
    "silver_transactions_all_columns": """
        SELECT txn_id, account_id, amount, merchant_cat_code, location, state, merchant_city, timestamp, _load_timestamp,
               _load_timestamp AS tdq_processed_at
        FROM r_txns WHERE tdq_txn_id_not_null + tdq_amount_positive = 0""",
    "rule_violations_by_rule": """
        SELECT table_name, rule, CAST(sum(failed_rows) AS BIGINT) AS failed_rows
        FROM (SELECT * FROM log UNION ALL SELECT * FROM skipped_log) GROUP BY 1, 2""",
    "quality_log": f"""
        SELECT {_DAY} AS date, table_name, rule, action, status, checked_rows, failed_rows
        FROM (SELECT * FROM log UNION ALL SELECT * FROM skipped_log)""",
    "rejected_daily": f"SELECT {_DAY} AS date, failed AS tdq_bdq_anomalies_count FROM d_failed",
    "rejected_applications": """
        SELECT app_id, timestamp, concat_ws(',',
                   CASE WHEN tdq_app_id_not_null = 1 THEN 'tdq_app_id_not_null' END,
                   CASE WHEN tdq_age_numeric_range = 1 THEN 'tdq_age_numeric_range' END,
                   CASE WHEN tdq_income_positive = 1 THEN 'tdq_income_positive' END,
                   CASE WHEN tdq_valid_employment = 1 THEN 'tdq_valid_employment' END,
                   CASE WHEN tdq_valid_app_status = 1 THEN 'tdq_valid_app_status' END) AS failed_rules
        FROM r_apps
        WHERE tdq_app_id_not_null + tdq_age_numeric_range + tdq_income_positive + tdq_valid_employment + tdq_valid_app_status > 0""",
    "landed_counts": """
        SELECT 'events' AS "table", count(*) AS rows FROM events
        UNION ALL SELECT 'orders', count(*) FROM orders
        UNION ALL SELECT 'lineitem', count(*) FROM lineitem""",
    "landed_rows_by_date": """
        SELECT 'visitor_events' AS "table", strftime(timestamp, '%Y-%m-%d') AS date, count(*) AS rows FROM b_visits GROUP BY 1, 2
        UNION ALL SELECT 'applications', strftime(timestamp, '%Y-%m-%d'), count(*) FROM b_apps GROUP BY 1, 2
        UNION ALL SELECT 'accounts', strftime(account_open_timestamp, '%Y-%m-%d'), count(*) FROM b_accounts GROUP BY 1, 2
        UNION ALL SELECT 'transactions', strftime(timestamp, '%Y-%m-%d'), count(*) FROM b_txns GROUP BY 1, 2""",
    "gold_applications": "SELECT * FROM g_apps",
    "gold_accounts": _GOLD_ACCOUNTS,
    "gold_accounts_all_columns": """
        SELECT a.*, p.applicant_age, p.annual_income, p.req_credit_limit
        FROM s_accounts a JOIN g_apps p ON a.app_id = p.app_id WHERE p.application_status = 'approved'""",
    "gold_transaction_features": _TXN_FEATURES,
    "gold_transaction_features_salted": _TXN_FEATURES,
    "gold_transaction_features_bounded": """
        SELECT t.txn_id, t.account_id, t.amount, t.timestamp, t.location, a.approved_limit,
               t.amount / a.approved_limit AS txn_limit_ratio
        FROM s_txns t JOIN s_accounts a ON t.account_id = a.account_id
        WHERE t.amount <= a.approved_limit * 1.5::DOUBLE AND t.timestamp >= a.account_open_timestamp
          AND t.timestamp <= a.account_open_timestamp + INTERVAL 5 DAY""",
    "gold_transaction_features_strict_cap": """
        SELECT t.*, a.approved_limit, t.amount / a.approved_limit AS txn_limit_ratio
        FROM s_txns t JOIN s_accounts a ON t.account_id = a.account_id WHERE t.amount <= a.approved_limit * 1.1::DOUBLE""",
    "daily_metrics_base": f"""{_METRICS_BASE},
           CAST(0 AS BIGINT) AS detected_tdq_bdq_anomalies_count, CAST(0 AS BIGINT) AS ml_anomalies_count FROM metrics""",
    "daily_metrics_full": f"""{_METRICS_BASE}, apply_clicks,
           detected_tdq_bdq_anomalies_count, ml_anomalies_count, round(avg_freshness_lag_hours, 6) AS avg_freshness_lag_hours,
           round(schema_compliance_pct, 6) AS schema_compliance_pct, round(campaign_id_null_pct, 6) AS campaign_id_null_pct
        FROM metrics_full""",
    "app_anomalies_daily": _APP_ANOMALIES,
    "txn_anomalies_daily": _TXN_ANOMALIES,
    "orphans_by_edge": """
        SELECT 'application -> visit' AS edge, count(*) AS child_rows,
               count(CASE WHEN NOT EXISTS (SELECT 1 FROM s_visits v WHERE v.visitor_id = c.visitor_id) THEN 1 END) AS orphan_rows
        FROM s_apps c
        UNION ALL
        SELECT 'account -> application', count(*),
               count(CASE WHEN NOT EXISTS (SELECT 1 FROM s_apps p WHERE p.app_id = c.app_id) THEN 1 END) FROM s_accounts c
        UNION ALL
        SELECT 'transaction -> account', count(*),
               count(CASE WHEN NOT EXISTS (SELECT 1 FROM s_accounts a WHERE a.account_id = c.account_id) THEN 1 END) FROM s_txns c""",
    "volume_outliers": f"""
        SELECT {_DAY} AS date, metric, volume, history, round(mean, 6) AS mean, round(spread, 6) AS spread,
               CASE WHEN history >= 7 THEN round((volume - mean) / nullif(spread, 0), 6) END AS z_score,
               CASE WHEN history >= 7 AND abs((volume - mean) / nullif(spread, 0)) > 3 THEN 1 ELSE 0 END AS is_outlier
        FROM (
            SELECT date, metric, volume, count(volume) OVER past AS history, avg(volume) OVER past AS mean,
                   stddev_samp(volume) OVER past AS spread
            FROM (
                SELECT date, 'total_visits' AS metric, total_visits AS volume FROM metrics
                UNION ALL SELECT date, 'applications_count', applications_count FROM metrics
                UNION ALL SELECT date, 'total_transactions', total_transactions FROM metrics
            )
            WINDOW past AS (PARTITION BY metric ORDER BY date RANGE BETWEEN INTERVAL 14 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)
        )""",
    "change_points": f"""
        SELECT {_DAY} AS date, metric, round(value, 6) AS value, round(mean, 6) AS mean, round(rise, 6) AS rise, round(fall, 6) AS fall,
               CASE WHEN rise > 5 THEN 'rise' WHEN fall > 5 THEN 'fall' END AS change
        FROM (
            SELECT *, rise_sum - least(0::DOUBLE, min(rise_sum) OVER past) AS rise, fall_sum - least(0::DOUBLE, min(fall_sum) OVER past) AS fall
            FROM (
                SELECT *, coalesce(sum(score - 0.5::DOUBLE) OVER past, 0::DOUBLE) AS rise_sum,
                       coalesce(sum(-score - 0.5::DOUBLE) OVER past, 0::DOUBLE) AS fall_sum
                FROM (
                    SELECT *, CASE WHEN day > 7 THEN coalesce((value - mean) / nullif(greatest(coalesce(deviation, 0), abs(mean) * 0.05::DOUBLE), 0), 0)
                              END AS score
                    FROM (
                        SELECT *, avg(value) FILTER (WHERE day <= 7) OVER (PARTITION BY metric) AS mean,
                               stddev_samp(value) FILTER (WHERE day <= 7) OVER (PARTITION BY metric) AS deviation
                        FROM (
                            SELECT *, row_number() OVER (PARTITION BY metric ORDER BY date) AS day
                            FROM (
                                SELECT date, 'conversion_rate' AS metric, conversion_rate AS value FROM metrics_full
                                UNION ALL SELECT date, 'campaign_id_null_pct', campaign_id_null_pct FROM metrics_full
                            ) WHERE value IS NOT NULL
                        )
                    )
                )
                WINDOW past AS (PARTITION BY metric ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            )
            WINDOW past AS (PARTITION BY metric ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        )""",
    "trust_score_today": f"""
        SELECT {_DAY} AS date_label, round(
                   (100 - least(detected_tdq_bdq_anomalies_count / applications_count * 100, 100::DOUBLE)) * 0.4::DOUBLE
                   + CASE WHEN avg_freshness_lag_hours <= 1 THEN 100 WHEN avg_freshness_lag_hours > 6 THEN 0
                          ELSE 100 - (avg_freshness_lag_hours - 1) * 20 END * 0.3::DOUBLE
                   + least(100 - ml_anomalies_count * 0.5::DOUBLE, 100::DOUBLE) * 0.3::DOUBLE, 6)
                   AS overall_data_trust_score_composite_pct
        FROM metrics_full WHERE date = DATE '2024-01-30' AND applications_count > 0""",
    "time_since_last_anomaly": """
        SELECT abs(s) AS time_elapsed_seconds,
               CASE WHEN abs(s) < 3600 THEN (abs(s) // 60) || ' min ago' WHEN abs(s) < 86400 THEN (abs(s) // 3600) || ' hr ago'
                    ELSE (abs(s) // 86400) || ' days ago' END AS time_since_last_anomaly_label,
               s AS signed_seconds
        FROM (
            SELECT (epoch_us(TIMESTAMP '2024-01-30 12:00:00') - epoch_us(max(timestamp))) // 1000000 AS s
            FROM (
                SELECT timestamp FROM g_apps WHERE req_income_ratio > 0.6::DOUBLE
                UNION ALL SELECT timestamp FROM g_txns WHERE txn_limit_ratio > 0.75::DOUBLE
            )
        )""",
    "freshness_trend": f"SELECT {_DAY} AS date_label, round(avg_freshness_lag_hours, 6) AS avg_freshness_lag_hours FROM metrics_full",
    "trust_score_trend": f"""
        SELECT {_DAY} AS date, total_daily_volume, total_anomalies, q AS quality_score_pct, f AS freshness_score_pct,
               c AS completeness_score_pct,
               round(schema_compliance_pct * 0.4::DOUBLE + q * 0.3::DOUBLE + f * 0.2::DOUBLE + c * 0.1::DOUBLE, 2)
                   AS final_data_trust_score
        FROM (
            SELECT date, schema_compliance_pct, v AS total_daily_volume, n AS total_anomalies,
                   round(100 * (1 - n / nullif(v, 0)), 2) AS q,
                   round(100 * greatest(0::DOUBLE, 1 - avg_freshness_lag_hours / 6::DOUBLE), 2) AS f,
                   round(100 * least(1::DOUBLE, total_transactions / 10000::DOUBLE), 2) AS c
            FROM (
                SELECT *, total_visits + applications_count + total_transactions AS v,
                       detected_tdq_bdq_anomalies_count + ml_anomalies_count AS n FROM metrics_full
            )
        )""",
    "null_rate_trend": f'SELECT {_DAY} AS date_label, round(campaign_id_null_pct, 6) AS "Null_Rate" FROM metrics_full',
    "conversion_trend": f"""
        SELECT {_DAY} AS date_label, round(conversion_rate * 100, 6) AS "Visitor_to_App_Rate",
               round(approval_rate * 100, 6) AS "App_to_Approval_Rate" FROM metrics""",
    "age_mix_trend": f"""
        SELECT {_DAY} AS "Time (Daily)", age_group AS "Applicant Age Group",
               ((n * 20000 + total) // (2 * total)) / 100.0::DOUBLE AS "Percent of Total (%)"
        FROM (
            SELECT CAST(timestamp AS DATE) AS date,
                   CASE WHEN applicant_age BETWEEN 18 AND 25 THEN '1. Youth (18-25)'
                        WHEN applicant_age BETWEEN 26 AND 35 THEN '2. Young Adult (26-35)'
                        WHEN applicant_age BETWEEN 36 AND 55 THEN '3. Adult (36-55)' ELSE '4. Senior (56+)' END AS age_group,
                   count(app_id) AS n
            FROM s_apps GROUP BY 1, 2
        ) JOIN (SELECT date, applications_count AS total FROM metrics WHERE applications_count > 0) USING (date)""",
    "age_mix_trend_strict": f"""
        SELECT {_DAY} AS "Time (Daily)", age_group AS "Applicant Age Group",
               ((n * 20000 + total) // (2 * total)) / 100.0::DOUBLE AS "Percent of Total (%)"
        FROM (
            SELECT date, age_group, n, CAST(sum(n) OVER (PARTITION BY date) AS BIGINT) AS total
            FROM (
                SELECT CAST(timestamp AS DATE) AS date,
                       CASE WHEN applicant_age < 18 THEN '0. Under 18' WHEN applicant_age <= 25 THEN '1. Youth (18-25)'
                            WHEN applicant_age <= 35 THEN '2. Young Adult (26-35)'
                            WHEN applicant_age <= 55 THEN '3. Adult (36-55)' ELSE '4. Senior (56+)' END AS age_group,
                       count(app_id) AS n
                FROM s_apps GROUP BY 1, 2
            )
        )""",
    "visits_with_anomaly_marker": f"""
        SELECT {_DAY} AS date_label, total_visits AS "Actual Visitor Count",
               CASE WHEN ml_anomalies_count > 0 THEN total_visits END AS "ML_Anomaly_Marker" FROM metrics_full""",
    "txn_anomaly_trend": f"""
        SELECT {_DAY} AS "Time (Daily)", txn_anomalies_count AS "Daily Transaction Anomaly Count" FROM a_txns""",
    "lineage_completeness": f"""
        SELECT {_DAY} AS date_label, n AS total_bronze_input, total_gold_output,
               n - total_gold_output AS total_records_dropped
        FROM (SELECT date, applications_count + total_visits + total_transactions AS total_gold_output FROM metrics)
        JOIN (
            SELECT date, count(*) AS n FROM (
                SELECT CAST(timestamp AS DATE) AS date FROM b_apps
                UNION ALL SELECT CAST(timestamp AS DATE) FROM b_visits
                UNION ALL SELECT CAST(timestamp AS DATE) FROM b_txns
            ) GROUP BY 1
        ) USING (date)""",
    "duplicate_app_ids": f"""
        SELECT {_DAY} AS "Violation_Date", CAST(sum(n - 1) AS BIGINT) AS "Total_Duplicate_Records_Count"
        FROM (SELECT CAST(timestamp AS DATE) AS date, app_id, count(*) AS n FROM s_apps GROUP BY 1, 2)
        WHERE n > 1 GROUP BY 1""",
    "stream_app_anomalies_daily": _APP_ANOMALIES,
    "stream_txn_features": _TXN_FEATURES,
    "stream_txn_anomalies_daily": _TXN_ANOMALIES,
    "stream_gold_accounts": _GOLD_ACCOUNTS,
    "stream_app_anomalies_replayed": f"""
        SELECT {_DAY} AS date, count(*) AS app_anomalies_count, CAST(sum(CASE WHEN late THEN 1 ELSE 0 END) AS BIGINT) AS late_app_anomalies_count
        FROM (SELECT CAST(timestamp AS DATE) AS date, late FROM late_apps) GROUP BY date""",
    "stream_app_anomalies_late_rows": """
        SELECT app_id, strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS applied, req_income_ratio FROM late_apps WHERE late""",
}


_QUERIES["ledger_counts"] = _QUERIES["landed_counts"]
_QUERIES["landed_daily_metrics"] = _QUERIES["landed_stream_daily_metrics"] = _QUERIES["daily_metrics_full"]


def _needed(sql: str) -> list[str]:
    """Views that ``sql`` uses, directly or through others, in definition order."""
    used, texts = set(), [sql]
    while texts:
        text = texts.pop()
        for name, body in _VIEWS.items():
            if name not in used and re.search(rf"\b{name}\b", text):
                used.add(name)
                texts.append(body)
    order: list[str] = []

    def place(name: str) -> None:
        for other in _VIEWS:
            if other in used and other != name and other not in order and re.search(rf"\b{other}\b", _VIEWS[name]):
                place(other)
        if name not in order:
            order.append(name)

    for name in _VIEWS:
        if name in used:
            place(name)
    return order


def statements() -> dict[str, str]:
    done = {}
    for key, sql in _QUERIES.items():
        ctes = ", ".join(f"{name} AS ({_VIEWS[name]})" for name in _needed(sql))
        done[key] = f"WITH {ctes} {sql.strip()}" if ctes else sql.strip()
    return done
