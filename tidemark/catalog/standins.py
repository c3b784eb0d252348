"""The given tables in the shape of the domain extracts, as DataFrames and as SQL.

``customer`` plays practitioners, bank customers and machines; ``orders`` interactions,
support cases and payments; ``lineitem`` prescriptions; ``supplier`` sites and merchants;
``nation`` institutions and territories; ``events`` readings, card payments, device events,
failures and work orders. Whole tables are used. The SQL constants are common table
expressions for the checking queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.catalog.base import EVENTS_RUN, ORDERS_RUN, Tables
from tidemark.plans import asset, provider, risk
from tidemark.sources.bronze import with_lineage

LIMITS = (1.0, 225.0, 5.0, 115.0)


# Provider targeting


def hcp_master(t: Tables) -> DataFrame:
    raw = t.customer.selectExpr(
        "c_custkey AS hcp_id",
        "lpad(CAST(c_custkey AS STRING), CASE WHEN c_custkey % 40 = 0 THEN 9 ELSE 10 END, '0') AS npi",
        "CASE WHEN c_custkey % 97 = 0 THEN '' ELSE concat(' ', lower(c_mktsegment)) END AS first_name",
        "lower(c_name) AS last_name",
        "concat(' ', c_name, ' ') AS full_name",
        "CASE WHEN c_custkey % 101 > 0 THEN substr(lower(c_mktsegment), 1, 3) END AS specialty_code",
        "concat(c_mktsegment, ' ') AS specialty_name",
        "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'A' WHEN 'BUILDING' THEN 'B' "
        "WHEN 'FURNITURE' THEN 'C' ELSE 'D' END AS specialty_tier",
        "concat('st', CAST(c_nationkey AS STRING)) AS state",
        "concat('TER_', CAST(c_nationkey AS STRING)) AS territory_id",
        "CASE WHEN c_custkey % 2 = 0 THEN 'MD' ELSE 'DO' END AS degree",
        "CAST(c_custkey % 40 AS INT) AS years_in_practice",
        "c_acctbal > 8000 AS is_key_opinion_leader",
        "c_acctbal > 5000 AS is_investigator",
        "'2015-01-01' AS created_date",
        "'2020-06-01' AS updated_date",
    )
    return with_lineage(raw, ORDERS_RUN, "hcp_master.csv")


def hco_master(t: Tables) -> DataFrame:
    raw = t.nation.selectExpr(
        "n_nationkey AS hco_id",
        "concat(' ', n_name) AS hco_name",
        "'Hospital ' AS hco_type",
        "lower(n_name) AS state",
        "'City ' AS city",
        "CAST(n_nationkey * 10 AS DOUBLE) AS bed_count",
        "n_regionkey > 1 AS is_teaching",
        "n_regionkey = 4 AS is_nci_designated",
        "'2010-01-01' AS created_date",
    )
    return with_lineage(raw, ORDERS_RUN, "hco_master.csv")


def hcp_interactions(t: Tables) -> DataFrame:
    return t.orders.selectExpr(
        "o_orderkey AS interaction_id",
        "o_custkey AS hcp_id",
        "o_orderkey % 50 AS rep_id",
        "o_orderpriority AS product",
        "'Visit' AS interaction_type",
        "o_orderdate AS interaction_date",
        "CAST(o_orderkey % 60 AS DOUBLE) AS duration_minutes",
        "CASE o_orderstatus WHEN 'O' THEN 'Positive' WHEN 'F' THEN 'Neutral' ELSE 'Negative' END AS outcome",
        "CAST(o_orderkey % 5 AS INT) AS samples_dropped",
        "'CRM' AS source_system",
    )


def rx(t: Tables) -> DataFrame:
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.selectExpr(
        "l_orderkey * 10 + l_linenumber AS rx_id",
        "o_custkey AS hcp_id",
        "l_returnflag AS product",
        "month(l_shipdate) AS period_month",
        "year(l_shipdate) AS period_year",
        "CAST(l_quantity AS INT) AS total_rx_count",
        "l_linenumber AS new_patient_starts",
        "l_discount AS market_share_pct",
        "'RX' AS source_system",
    )


def patient_support(t: Tables) -> DataFrame:
    return t.orders.selectExpr(
        "o_orderkey AS case_id",
        "o_custkey AS hcp_id",
        "o_orderstatus AS product",
        "o_orderpriority AS case_type",
        "o_orderdate AS case_date",
        "CASE WHEN o_orderkey % 5 = 0 THEN 'Escalated' ELSE 'Closed' END AS case_status",
        "CASE WHEN o_orderkey % 7 > 0 THEN CAST(o_orderkey % 30 AS DOUBLE) END AS resolution_days",
        "'40-49' AS patient_age_band",
        "CASE o_orderkey % 3 WHEN 0 THEN 'Medicare' WHEN 1 THEN 'Medicaid' ELSE 'Commercial' END AS payer_type",
    )


def trial_sites(t: Tables) -> DataFrame:
    return t.supplier.selectExpr(
        "s_suppkey AS site_id",
        "s_nationkey AS hco_id",
        "s_suppkey % 12 AS trial_id",
        "'2000-01-01' AS activation_date",
        "CAST(floor(abs(s_acctbal) / 200) AS INT) AS enrolled_patients",
        "CAST(s_suppkey % 20 AS INT) AS screen_failures",
        "(s_suppkey % 30) / 100.0D AS query_rate",
        "CAST(s_suppkey % 7 AS INT) AS protocol_deviations",
        "CASE s_suppkey % 4 WHEN 0 THEN 'Excellent' WHEN 1 THEN 'Good' WHEN 2 THEN 'Acceptable' "
        "ELSE 'Poor' END AS site_rating",
        "'US' AS country",
        "s_suppkey AS pi_hcp_id",
        "s_acctbal > 0 AS is_active",
    )


def provider_bronze(t: Tables) -> dict[str, DataFrame]:
    return {
        "bronze_hcp_master": hcp_master(t),
        "bronze_hco_master": hco_master(t),
        "bronze_hcp_interactions": hcp_interactions(t),
        "bronze_rx_aggregates": rx(t),
        "bronze_patient_support": patient_support(t),
        "bronze_trial_sites": trial_sites(t),
    }


def provider_silver(t: Tables) -> dict[str, DataFrame]:
    return {
        "silver_hcp_standardized": provider.hcp_standardized(hcp_master(t)),
        "silver_hco_standardized": provider.hco_standardized(hco_master(t)),
        "silver_interactions_clean": provider.interactions_clean(hcp_interactions(t), ORDERS_RUN),
        "silver_rx_aggregates": provider.rx_aggregates(rx(t)),
        "silver_patient_support_agg": provider.support_by_month(patient_support(t)),
        "silver_trial_sites_clean": provider.trial_sites_clean(trial_sites(t)),
    }


HCP_SQL = """
hcp AS (
  SELECT CAST(c_custkey AS VARCHAR) AS hcp_id,
         lpad(CAST(c_custkey AS VARCHAR), CASE WHEN c_custkey % 40 = 0 THEN 9 ELSE 10 END, '0') AS npi,
         CASE WHEN c_custkey % 97 = 0 THEN '' ELSE c_mktsegment END AS first_name,
         upper(c_name) AS last_name, c_name AS full_name,
         CASE WHEN c_custkey % 101 > 0 THEN substr(c_mktsegment, 1, 3) END AS specialty_code,
         c_mktsegment AS specialty_name,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'A' WHEN 'BUILDING' THEN 'B'
              WHEN 'FURNITURE' THEN 'C' ELSE 'D' END AS specialty_tier,
         'ST' || c_nationkey AS state, 'TER_' || c_nationkey AS territory_id,
         CASE WHEN c_custkey % 2 = 0 THEN 'MD' ELSE 'DO' END AS degree,
         CAST(c_custkey % 40 AS INTEGER) AS years_in_practice,
         c_acctbal > 8000 AS is_kol, c_acctbal > 5000 AS is_investigator,
         CAST(CASE WHEN c_custkey % 40 = 0 THEN 0 ELSE 1 END AS INTEGER) AS dq_npi_valid,
         CAST(CASE WHEN c_custkey % 97 = 0 THEN 0 ELSE 1 END AS INTEGER) AS dq_name_complete,
         CAST(CASE WHEN c_custkey % 101 = 0 THEN 0 ELSE 1 END AS INTEGER) AS dq_specialty_present,
         '20010802_060000' AS _batch_id
  FROM customer)"""

SUPPORT_SQL = """
support AS (
  SELECT CAST(o_custkey AS VARCHAR) AS hcp_id, o_orderstatus AS product,
         o_orderpriority AS case_type,
         CASE o_orderkey % 3 WHEN 0 THEN 'Medicare' WHEN 1 THEN 'Medicaid' ELSE 'Commercial' END AS payer_type,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS case_month,
         COUNT(*) AS case_count,
         AVG(CASE WHEN o_orderkey % 7 > 0 THEN CAST(o_orderkey % 30 AS DOUBLE) END) AS avg_resolution_days,
         CAST(COUNT(*) FILTER (WHERE o_orderkey % 5 = 0) AS BIGINT) AS escalated_count
  FROM orders GROUP BY ALL)"""

HCP_360_SQL = (
    HCP_SQL
    + ","
    + SUPPORT_SQL
    + """,
calls AS (
  SELECT CAST(o_custkey AS VARCHAR) AS hcp_id, COUNT(*) AS total_interactions_12m,
         COUNT(*) FILTER (WHERE o_orderdate >= DATE '2001-05-04') AS interactions_90d,
         CAST(MAX(o_orderdate) AS DATE) AS last_interaction_date,
         COUNT(*) FILTER (WHERE o_orderstatus = 'O') AS positive_outcomes
  FROM orders
  WHERE o_orderdate BETWEEN DATE '2000-08-02' AND DATE '2001-08-02' GROUP BY 1),
scripts AS (
  SELECT CAST(o_custkey AS VARCHAR) AS hcp_id,
         CAST(SUM(CAST(l_quantity AS INTEGER)) AS BIGINT) AS total_rx_12m,
         CAST(SUM(l_linenumber) AS BIGINT) AS total_new_starts_12m,
         AVG(l_discount) AS avg_market_share
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE year(l_shipdate) >= 2000 AND l_quantity >= 0 GROUP BY 1),
cases AS (
  SELECT hcp_id, CAST(SUM(case_count) AS BIGINT) AS total_psp_cases,
         CAST(SUM(escalated_count) AS BIGINT) AS total_psp_escalations
  FROM support GROUP BY 1),
signals AS (
  SELECT hcp.*, last_interaction_date,
         COALESCE(total_interactions_12m, 0) AS total_interactions_12m,
         COALESCE(interactions_90d, 0) AS interactions_90d,
         COALESCE(positive_outcomes, 0) AS positive_outcomes,
         COALESCE(total_rx_12m, 0) AS total_rx_12m,
         COALESCE(total_new_starts_12m, 0) AS total_new_starts_12m,
         COALESCE(avg_market_share, 0) AS avg_market_share,
         COALESCE(total_psp_cases, 0) AS total_psp_cases,
         COALESCE(total_psp_escalations, 0) AS total_psp_escalations
  FROM hcp LEFT JOIN calls USING (hcp_id) LEFT JOIN scripts USING (hcp_id)
       LEFT JOIN cases USING (hcp_id)),
view360 AS (
  SELECT *, CAST(least(100, interactions_90d * 8 + positive_outcomes * 5
         + CASE specialty_tier WHEN 'A' THEN 20 WHEN 'B' THEN 15 WHEN 'C' THEN 10 ELSE 5 END
         + CASE WHEN is_kol THEN 15 ELSE 0 END) AS BIGINT) AS engagement_score
  FROM signals),
targeting AS (
  SELECT *, CASE
         WHEN specialty_tier = 'A' AND engagement_score >= 60 AND total_rx_12m >= 50 THEN 'A'
         WHEN specialty_tier <= 'B' AND engagement_score >= 40 THEN 'B'
         WHEN greatest(engagement_score, total_rx_12m) >= 20 THEN 'C' ELSE 'D' END AS targeting_priority,
         CAST(COALESCE(date_diff('day', last_interaction_date, DATE '2001-08-02'), 999) AS INTEGER)
           AS days_since_last_interaction
  FROM view360)"""
)

SITES_SQL = """
sites AS (
  SELECT s.*, n.n_name, n.n_regionkey,
         CAST(floor(abs(s_acctbal) / 200) AS INTEGER) AS enrolled,
         CAST(s_suppkey % 20 AS INTEGER) AS failed,
         CASE s_suppkey % 4 WHEN 0 THEN 'Excellent' WHEN 1 THEN 'Good' WHEN 2 THEN 'Acceptable'
              ELSE 'Poor' END AS rating
  FROM supplier s JOIN nation n ON s_nationkey = n_nationkey)"""


# Transaction risk


def customers(t: Tables) -> DataFrame:
    raw = t.customer.selectExpr(
        "c_custkey AS customer_id",
        "lower(c_mktsegment) AS first_name",
        "lower(c_name) AS last_name",
        "CAST(15 + c_custkey % 80 AS INT) AS age",
        "concat(' st', CAST(c_nationkey AS STRING)) AS state",
        "CASE WHEN c_acctbal > 5000 THEN 'HIGH' ELSE 'LOW' END AS income_band",
        "date_add(date'1990-01-01', CAST(c_custkey % 3000 AS INT)) AS customer_since",
        "c_mktsegment AS risk_segment",
        "'example.com' AS email_domain",
    )
    return with_lineage(raw, EVENTS_RUN, "customers.csv")


def bureau(t: Tables) -> DataFrame:
    return t.customer.selectExpr(
        "CASE WHEN c_acctbal >= 0 THEN c_custkey ELSE -c_custkey END AS customer_id",
        "CAST(300 + floor(abs(c_acctbal) / 20) AS INT) AS bureau_score",
        "CAST(c_custkey % 9 AS INT) AS num_open_accounts",
        "CAST(c_custkey % 4 AS INT) AS num_derogatory_marks",
        "abs(c_acctbal) AS total_debt_usd",
        "(c_custkey % 50) / 50.0D AS payment_history_pct",
        "(c_custkey % 100) / 100.0D AS credit_utilization_pct",
        "CAST(c_custkey % 25 AS INT) AS oldest_account_years",
    )


def merchants(t: Tables) -> DataFrame:
    return t.supplier.selectExpr(
        "s_suppkey AS merchant_id",
        "s_name AS merchant_name",
        "'Retail' AS category",
        "CAST(s_nationkey AS STRING) AS state",
        "s_suppkey % 2 = 0 AS is_online",
        "abs(s_acctbal) AS avg_transaction_size",
        "s_acctbal < 0 AS risk_flag",
    )


def transactions(t: Tables) -> DataFrame:
    raw = t.events.filter("event_type = 'purchase'").selectExpr(
        "event_id AS transaction_id",
        "user_id AS customer_id",
        "user_id * 10 + event_id % 2 AS account_id",
        "event_id % 120 AS merchant_id",
        "CAST(ts AS DATE) AS transaction_date",
        "hour(ts) AS transaction_hour",
        "'Purchase' AS transaction_type",
        "value AS amount",
        "'USD' AS currency",
        "concat('S', CAST(event_id % 7 AS STRING)) AS transaction_state",
        "event_id % 2 = 0 AS is_online",
        "event_id % 11 = 0 AS is_international",
        "value > 200 AS is_fraud",
        "'Approved' AS status",
    )
    return with_lineage(raw, EVENTS_RUN, "transactions.csv")


def device_events(t: Tables) -> DataFrame:
    return t.events.filter("event_type IN ('signup', 'error')").selectExpr(
        "event_id",
        "user_id AS customer_id",
        "CAST(ts AS DATE) AS event_date",
        "CASE event_type WHEN 'signup' THEN 'New Device' ELSE 'Failed Login' END AS event_type",
        "'phone' AS device_type",
        "event_type = 'signup' AS is_new_device",
        "event_type = 'error' AND value > 50 AS vpn_detected",
    )


def risk_silver(t: Tables) -> dict[str, DataFrame]:
    return {
        "silver_customers_clean": risk.customers_clean(customers(t)),
        "silver_transactions_clean": risk.transactions_clean(transactions(t), EVENTS_RUN),
        "silver_merchants_clean": risk.merchants_clean(merchants(t)),
        "silver_device_events_clean": risk.device_events_clean(device_events(t)),
    }


def orders_as_payments(t: Tables) -> DataFrame:
    return t.orders.selectExpr(
        "o_orderkey AS transaction_id",
        "o_custkey AS customer_id",
        "CAST(o_orderdate AS DATE) AS transaction_date",
        "o_totalprice AS amount",
        "o_orderstatus AS transaction_state",
        "o_orderpriority = '1-URGENT' AS is_fraud",
    )


def chargebacks(t: Tables) -> DataFrame:
    return t.orders.selectExpr(
        "o_orderkey AS transaction_id",
        "CASE WHEN o_orderpriority = '1-URGENT' THEN "
        "date_add(CAST(o_orderdate AS DATE), CAST(7 + o_orderkey % 54 AS INT)) END AS chargeback_date",
    )


CUSTOMER_360_SQL = """
bureau AS (
  SELECT CAST(CASE WHEN c_acctbal >= 0 THEN c_custkey ELSE -c_custkey END AS VARCHAR) AS customer_id,
         CAST(300 + floor(abs(c_acctbal) / 20) AS INTEGER) AS bureau_score,
         CAST(c_custkey % 9 AS INTEGER) AS num_open_accounts,
         CAST(c_custkey % 4 AS INTEGER) AS num_derogatory_marks,
         abs(c_acctbal) AS total_debt_usd,
         CAST(c_custkey % 50 AS DOUBLE) / 50 AS payment_history_pct,
         CAST(c_custkey % 100 AS DOUBLE) / 100 AS credit_utilization_pct,
         CAST(c_custkey % 25 AS INTEGER) AS oldest_account_years
  FROM customer),
cust360 AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, 'ST' || c_nationkey AS state,
         CAST(15 + c_custkey % 80 AS INTEGER) AS age,
         CASE WHEN c_acctbal > 5000 THEN 'HIGH' ELSE 'LOW' END AS income_band,
         c_mktsegment AS risk_segment,
         CAST(DATE '1990-01-01' + CAST(c_custkey % 3000 AS INTEGER) AS DATE) AS customer_since,
         CAST(date_diff('day', DATE '1990-01-01', DATE '2024-01-31') - c_custkey % 3000 AS INTEGER)
           AS customer_tenure_days,
         bureau_score, num_open_accounts, num_derogatory_marks, total_debt_usd,
         payment_history_pct, credit_utilization_pct, oldest_account_years
  FROM customer LEFT JOIN bureau ON customer_id = CAST(c_custkey AS VARCHAR))"""

RISK_FEATURES_SQL = (
    CUSTOMER_360_SQL
    + """,
tx AS (
  SELECT event_id, CAST(event_id AS VARCHAR) AS transaction_id,
         CAST(user_id AS VARCHAR) AS customer_id,
         CAST(user_id * 10 + event_id % 2 AS VARCHAR) AS account_id,
         event_id % 120 AS merchant, CAST(event_id % 120 AS VARCHAR) AS merchant_id,
         CAST(ts AS DATE) AS d, CAST(hour(ts) AS INTEGER) AS transaction_hour, value AS amount,
         'S' || (event_id % 7) AS transaction_state, event_id % 2 = 0 AS is_online,
         event_id % 11 = 0 AS is_international, value > 200 AS is_fraud
  FROM events WHERE event_type = 'purchase' AND value > 0),
history AS (
  SELECT t.event_id, COUNT(p.event_id) AS n30, COALESCE(AVG(p.amount), 0) AS mean30,
         COALESCE(MAX(p.amount), 0) AS max30, COALESCE(SUM(p.amount), 0) AS sum30,
         COUNT(*) FILTER (WHERE p.d >= t.d - 7) AS n7,
         CAST(COALESCE(MIN(t.d - p.d), 999) AS INTEGER) AS recency,
         COUNT(DISTINCT p.transaction_state) AS states30,
         COUNT(*) FILTER (WHERE p.is_fraud) AS frauds
  FROM tx t LEFT JOIN tx p ON p.customer_id = t.customer_id AND p.event_id <> t.event_id
       AND p.d <= t.d AND p.d >= t.d - 30
  GROUP BY t.event_id),
gadgets AS (
  SELECT t.event_id, COUNT(*) FILTER (WHERE e.event_type = 'signup') AS new_devices,
         COUNT(*) FILTER (WHERE e.event_type = 'error' AND e.value > 50) AS vpns
  FROM tx t JOIN events e ON CAST(e.user_id AS VARCHAR) = t.customer_id
       AND CAST(e.ts AS DATE) <= t.d AND CAST(e.ts AS DATE) >= t.d - 7
  GROUP BY t.event_id),
features AS (
  SELECT tx.*, n30, mean30, max30, sum30, n7, recency, states30, frauds,
         CASE WHEN mean30 > 0 THEN amount / mean30 ELSE 1.0 END AS ratio,
         CAST(CASE WHEN transaction_hour < 5 THEN 1 ELSE 0 END AS INTEGER) AS is_late_night,
         COALESCE(new_devices, 0) AS new_devices, COALESCE(vpns, 0) AS vpns,
         COALESCE(bureau_score, 650) AS bureau_score,
         COALESCE(credit_utilization_pct, 0.5) AS credit_utilization_pct,
         COALESCE(num_derogatory_marks, 0) AS num_derogatory_marks, customer_tenure_days,
         COALESCE(s_acctbal < 0, FALSE) AS merchant_risk_flag
  FROM tx JOIN history USING (event_id) LEFT JOIN gadgets USING (event_id)
       LEFT JOIN cust360 USING (customer_id) LEFT JOIN supplier ON s_suppkey = merchant)"""
)


# Asset maintenance

SENSOR_TYPES = (
    "CASE event_type WHEN 'view' THEN 'temperature' WHEN 'click' THEN 'vibration' "
    "WHEN 'purchase' THEN 'pressure' WHEN 'signup' THEN 'speed' ELSE 'current' END"
)


def readings(t: Tables) -> DataFrame:
    low, high, normal_low, normal_high = LIMITS
    raw = t.events.selectExpr(
        "event_id AS reading_id",
        "concat_ws('-', CAST(user_id AS STRING), event_type) AS sensor_id",
        "user_id AS asset_id",
        f"{SENSOR_TYPES} AS sensor_type",
        "ts AS reading_timestamp",
        "value AS reading_value",
        "'u' AS unit",
        f"{low}D AS expected_min",
        f"{high}D AS expected_max",
        f"{normal_low}D AS normal_low",
        f"{normal_high}D AS normal_high",
    )
    return with_lineage(raw, EVENTS_RUN, "sensor_readings.csv")


def assets(t: Tables) -> DataFrame:
    raw = t.customer.selectExpr(
        "c_custkey AS asset_id",
        "concat(' ', c_name) AS asset_name",
        "c_mktsegment AS asset_type",
        "c_mktsegment AS asset_type_name",
        "concat('LINE_', CAST(c_nationkey AS STRING)) AS production_line",
        "CASE WHEN c_acctbal > 6000 THEN 'HIGH' WHEN c_acctbal > 2000 THEN 'MEDIUM' ELSE 'LOW' END AS criticality",
        "date_add(date'2010-01-01', CAST(c_custkey % 3650 AS INT)) AS install_date",
        "(c_custkey % 200) / 10.0D AS age_years",
        "'Maker' AS manufacturer",
        "CAST(c_custkey % 20 AS INT) AS expected_lifespan_years",
        "CAST(4 + c_custkey % 30 AS INT) AS maintenance_interval_days",
        "true AS is_active",
    )
    return with_lineage(raw, EVENTS_RUN, "assets.csv")


def failures(t: Tables) -> DataFrame:
    return t.events.filter("event_type = 'error'").selectExpr(
        "event_id AS failure_id",
        "user_id AS asset_id",
        "'Wear' AS failure_type",
        "CAST(ts AS DATE) AS failure_date",
        "'Sensor' AS detection_method",
        "value AS downtime_hours",
        "value * 10 AS repair_cost_usd",
        "'MAJOR' AS severity",
        "'Unknown' AS root_cause",
        "false AS was_predicted",
    )


def work_orders(t: Tables) -> DataFrame:
    return t.events.filter("event_type = 'signup'").selectExpr(
        "event_id AS work_order_id",
        "user_id AS asset_id",
        "'Preventive' AS work_order_type",
        "CAST(ts AS DATE) AS created_date",
        "CASE WHEN event_id % 9 > 0 THEN date_add(CAST(ts AS DATE), CAST(event_id % 5 AS INT)) END AS completed_date",
        "CAST(1 + event_id % 8 AS INT) AS estimated_hours",
        "CAST(1 + event_id % 10 AS DOUBLE) AS actual_hours",
        "event_id % 20 AS technician_id",
        "'P1' AS priority",
        "value AS cost_usd",
        "'none' AS parts_replaced",
    )


def asset_silver(t: Tables) -> dict[str, DataFrame]:
    return {
        "silver_assets_clean": asset.assets_clean(assets(t)),
        "silver_sensors_clean": asset.readings_clean(readings(t), EVENTS_RUN),
        "silver_work_orders_clean": asset.work_orders_clean(work_orders(t)),
        "silver_failure_events_clean": asset.failures_clean(failures(t)),
    }


READINGS_SQL = """
readings AS (
  SELECT event_id, CAST(event_id AS VARCHAR) AS reading_id, user_id || '-' || event_type AS sensor_id,
         CAST(user_id AS VARCHAR) AS asset_id,
         CASE event_type WHEN 'view' THEN 'temperature' WHEN 'click' THEN 'vibration'
              WHEN 'purchase' THEN 'pressure' WHEN 'signup' THEN 'speed' ELSE 'current' END AS sensor_type,
         ts, date_trunc('hour', ts) AS reading_hour, value,
         CAST(ts <= TIMESTAMP '2024-01-31' AS INTEGER) AS not_future,
         CAST(ts >= TIMESTAMP '2022-01-01' AS INTEGER) AS not_ancient,
         CAST(value >= 1 AND value <= 225 AS INTEGER) AS in_range,
         CAST(value >= 5 AND value <= 115 AS INTEGER) AS in_normal,
         CAST((value < 5 OR value > 115) AND value >= 1 AND value <= 225 AS INTEGER) AS anomaly,
         CAST(value < 1 OR value > 225 AS INTEGER) AS outlier,
         CAST(value >= 1 AND value <= 225 AND ts <= TIMESTAMP '2024-01-31' AS INTEGER) AS valid
  FROM events)"""

SENSORS_SQL = (
    READINGS_SQL
    + """,
sensors AS (
  SELECT sensor_id, asset_id, sensor_type, COUNT(*) AS total_readings,
         CAST(SUM(valid) AS BIGINT) AS valid_readings,
         100.0 * SUM(valid) / COUNT(*) AS validity, CAST(SUM(outlier) AS BIGINT) AS hard_outlier_count,
         100.0 * SUM(outlier) / COUNT(*) AS outlier_rate, CAST(SUM(anomaly) AS BIGINT) AS anomaly_count,
         100.0 * SUM(anomaly) / COUNT(*) AS anomaly_rate,
         MIN(ts) AS first_reading_ts, MAX(ts) AS last_reading_ts,
         date_diff('hour', MIN(reading_hour), MAX(reading_hour)) + 1 AS expected_reading_count
  FROM readings GROUP BY 1, 2, 3),
scored AS (
  SELECT *, greatest(0, least(100, 0.6 * validity + 0.25 * (100 - outlier_rate)
         + 15 * (1 - least(1, anomaly_rate / 20)))) AS sensor_quality_score
  FROM sensors)"""
)

ASSETS_SQL = """
assets AS (
  SELECT CAST(c_custkey AS VARCHAR) AS asset_id, c_name AS asset_name, c_mktsegment AS asset_type,
         'LINE_' || c_nationkey AS production_line,
         CASE WHEN c_acctbal > 6000 THEN 'HIGH' WHEN c_acctbal > 2000 THEN 'MEDIUM' ELSE 'LOW' END AS criticality,
         CAST(DATE '2010-01-01' + CAST(c_custkey % 3650 AS INTEGER) AS DATE) AS install_date,
         CAST(c_custkey % 200 AS DOUBLE) / 10 AS age_years,
         CAST(c_custkey % 20 AS INTEGER) AS lifespan,
         CAST(4 + c_custkey % 30 AS INTEGER) AS maintenance_interval_days
  FROM customer),
failures AS (
  SELECT CAST(user_id AS VARCHAR) AS asset_id, CAST(ts AS DATE) AS failure_date, value AS downtime_hours
  FROM events WHERE event_type = 'error'),
work AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS asset_id, CAST(ts AS DATE) AS created_date,
         CASE WHEN event_id % 9 > 0 THEN CAST(CAST(ts AS DATE) + CAST(event_id % 5 AS INTEGER) AS DATE) END
           AS completed_date,
         value AS cost_usd, CAST(1 + event_id % 8 AS INTEGER) AS estimated_hours,
         CAST(1 + event_id % 10 AS DOUBLE) AS actual_hours
  FROM events WHERE event_type = 'signup')"""

HEALTH_SQL = (
    SENSORS_SQL
    + ","
    + ASSETS_SQL
    + """,
sensed AS (
  SELECT asset_id, AVG(sensor_quality_score) AS quality, AVG(round(validity, 2)) AS sensor_validity_rate,
         CAST(SUM(anomaly_count) AS BIGINT) AS total_sensor_anomalies FROM scored GROUP BY 1),
broken AS (
  SELECT asset_id, COUNT(*) AS failure_count_12m, SUM(CAST(downtime_hours AS DOUBLE)) AS downtime,
         MAX(failure_date) AS last_failure_date
  FROM failures WHERE failure_date >= DATE '2023-01-31' GROUP BY 1),
served AS (
  SELECT asset_id, COUNT(*) AS work_orders_12m, SUM(CAST(cost_usd AS DECIMAL(18, 2))) AS cost,
         MAX(completed_date) AS last_maintenance_date
  FROM work WHERE created_date >= DATE '2023-01-31' GROUP BY 1),
gathered AS (
  SELECT assets.*, quality, COALESCE(sensor_validity_rate, 0) AS sensor_validity_rate,
         COALESCE(total_sensor_anomalies, 0) AS total_sensor_anomalies,
         COALESCE(failure_count_12m, 0) AS failure_count_12m,
         CAST(COALESCE(downtime, 0) AS DOUBLE) AS total_downtime_hours_12m, last_failure_date,
         CAST(date_diff('day', COALESCE(last_failure_date, install_date), DATE '2024-01-31') AS INTEGER)
           AS days_since_last_failure,
         COALESCE(work_orders_12m, 0) AS work_orders_12m,
         CAST(COALESCE(cost, 0) AS DOUBLE) AS maintenance_cost_12m_usd, last_maintenance_date,
         CAST(date_diff('day', COALESCE(last_maintenance_date, install_date), DATE '2024-01-31') AS INTEGER)
           AS days_since_last_maintenance
  FROM assets LEFT JOIN sensed USING (asset_id) LEFT JOIN broken USING (asset_id)
       LEFT JOIN served USING (asset_id)),
health AS (
  SELECT *, greatest(0, least(100, 0.4 * COALESCE(quality, 50)
         + 0.3 * greatest(0, 100 - 20 * failure_count_12m)
         + 0.3 * greatest(0, 100 - 100 * age_years / nullif(lifespan, 0)))) AS asset_health_score,
         CASE WHEN days_since_last_maintenance > maintenance_interval_days THEN 'OVERDUE'
              WHEN days_since_last_maintenance > 0.8 * maintenance_interval_days THEN 'DUE_SOON'
              ELSE 'ON_SCHEDULE' END AS maintenance_urgency
  FROM gathered)"""
)
