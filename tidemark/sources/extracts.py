"""The raw extracts: file name and explicit schema of each. Types are those of the text files;
a whole-number column that may be empty is read as DOUBLE because exports write ``120.0``."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class SourceSpec:
    """One delimited extract with a header line."""

    table: str
    file: str
    schema: str


# Table names, file names and column names of the extracts.
PROVIDER = (
    SourceSpec(
        "bronze_hcp_master",
        "hcp_master.csv",
        "hcp_id STRING, npi STRING, first_name STRING, last_name STRING, full_name STRING, "
        "specialty_code STRING, specialty_name STRING, specialty_tier STRING, state STRING, "
        "territory_id STRING, degree STRING, years_in_practice INT, "
        "is_key_opinion_leader BOOLEAN, is_investigator BOOLEAN, created_date STRING, "
        "updated_date STRING",
    ),
    SourceSpec(
        "bronze_hco_master",
        "hco_master.csv",
        "hco_id STRING, hco_name STRING, hco_type STRING, state STRING, city STRING, "
        "bed_count DOUBLE, is_teaching BOOLEAN, is_nci_designated BOOLEAN, created_date STRING",
    ),
    SourceSpec(
        "bronze_hcp_hco_affiliations",
        "hcp_hco_affiliations.csv",
        "affiliation_id STRING, hcp_id STRING, hco_id STRING, affiliation_type STRING, "
        "is_primary BOOLEAN, start_date STRING",
    ),
    SourceSpec(
        "bronze_hcp_interactions",
        "hcp_interactions.csv",
        "interaction_id STRING, hcp_id STRING, rep_id STRING, product STRING, "
        "interaction_type STRING, interaction_date STRING, duration_minutes DOUBLE, "
        "outcome STRING, samples_dropped INT, source_system STRING",
    ),
    SourceSpec(
        "bronze_rx_aggregates",
        "rx_aggregates.csv",
        "rx_id STRING, hcp_id STRING, product STRING, period_month INT, period_year INT, "
        "total_rx_count INT, new_patient_starts INT, market_share_pct DOUBLE, "
        "source_system STRING",
    ),
    SourceSpec(
        "bronze_patient_support",
        "patient_support_cases.csv",
        "case_id STRING, hcp_id STRING, product STRING, case_type STRING, case_date STRING, "
        "case_status STRING, resolution_days DOUBLE, patient_age_band STRING, payer_type STRING",
    ),
    SourceSpec(
        "bronze_trial_sites",
        "trial_sites.csv",
        "site_id STRING, hco_id STRING, trial_id STRING, activation_date STRING, "
        "enrolled_patients INT, screen_failures INT, query_rate DOUBLE, "
        "protocol_deviations INT, site_rating STRING, country STRING, pi_hcp_id STRING, "
        "is_active BOOLEAN",
    ),
    SourceSpec(
        "bronze_territory_assignments",
        "territory_assignments.csv",
        "assignment_id STRING, hcp_id STRING, territory_id STRING, rep_id STRING, "
        "assignment_start STRING, assignment_end STRING, is_current BOOLEAN",
    ),
)

RISK = (
    SourceSpec(
        "bronze_customers",
        "customers.csv",
        "customer_id STRING, first_name STRING, last_name STRING, age INT, state STRING, "
        "income_band STRING, customer_since STRING, risk_segment STRING, email_domain STRING, "
        "phone_area_code INT",
    ),
    SourceSpec(
        "bronze_accounts",
        "accounts.csv",
        "account_id STRING, customer_id STRING, account_type STRING, open_date STRING, "
        "credit_limit DOUBLE, is_primary BOOLEAN, status STRING",
    ),
    SourceSpec(
        "bronze_merchants",
        "merchants.csv",
        "merchant_id STRING, merchant_name STRING, category STRING, state STRING, "
        "is_online BOOLEAN, avg_transaction_size DOUBLE, risk_flag BOOLEAN",
    ),
    SourceSpec(
        "bronze_transactions",
        "transactions.csv",
        "transaction_id STRING, customer_id STRING, account_id STRING, merchant_id STRING, "
        "transaction_date STRING, transaction_hour INT, transaction_type STRING, "
        "amount DOUBLE, currency STRING, transaction_state STRING, is_online BOOLEAN, "
        "is_international BOOLEAN, is_fraud BOOLEAN, status STRING",
    ),
    SourceSpec(
        "bronze_chargebacks",
        "chargebacks.csv",
        "chargeback_id STRING, transaction_id STRING, customer_id STRING, "
        "chargeback_date STRING, chargeback_amount DOUBLE, reason_code STRING, status STRING",
    ),
    SourceSpec(
        "bronze_device_events",
        "device_events.csv",
        "event_id STRING, customer_id STRING, event_date STRING, event_hour INT, "
        "event_type STRING, device_type STRING, os STRING, is_new_device BOOLEAN, "
        "vpn_detected BOOLEAN",
    ),
    SourceSpec(
        "bronze_bureau_attrs",
        "bureau_attributes.csv",
        "customer_id STRING, bureau_score INT, num_open_accounts INT, "
        "num_derogatory_marks INT, total_debt_usd DOUBLE, payment_history_pct DOUBLE, "
        "credit_utilization_pct DOUBLE, oldest_account_years INT, bureau_pull_date STRING",
    ),
)

ASSET = (
    SourceSpec(
        "bronze_assets",
        "assets.csv",
        "asset_id STRING, asset_name STRING, asset_type STRING, asset_type_name STRING, "
        "production_line STRING, criticality STRING, install_date STRING, age_years DOUBLE, "
        "manufacturer STRING, expected_lifespan_years INT, maintenance_interval_days INT, "
        "is_active BOOLEAN",
    ),
    SourceSpec(
        "bronze_sensor_readings",
        "sensor_readings.csv",
        "reading_id STRING, sensor_id STRING, asset_id STRING, sensor_type STRING, "
        "reading_timestamp STRING, reading_value DOUBLE, unit STRING, expected_min DOUBLE, "
        "expected_max DOUBLE, normal_low DOUBLE, normal_high DOUBLE, has_drift BOOLEAN, "
        "has_clock_skew BOOLEAN, is_outlier BOOLEAN",
    ),
    SourceSpec(
        "bronze_work_orders",
        "work_orders.csv",
        "work_order_id STRING, asset_id STRING, work_order_type STRING, description STRING, "
        "created_date STRING, completed_date STRING, estimated_hours INT, actual_hours DOUBLE, "
        "technician_id STRING, priority STRING, cost_usd DOUBLE, parts_replaced STRING",
    ),
    SourceSpec(
        "bronze_failure_events",
        "failure_events.csv",
        "failure_id STRING, asset_id STRING, failure_type STRING, failure_date STRING, "
        "detection_method STRING, downtime_hours DOUBLE, repair_cost_usd DOUBLE, "
        "severity STRING, root_cause STRING, was_predicted BOOLEAN",
    ),
    SourceSpec(
        "bronze_quality_inspections",
        "quality_inspections.csv",
        "inspection_id STRING, asset_id STRING, inspection_date STRING, defect_count INT, "
        "pass_rate DOUBLE, inspector_id STRING, production_volume INT, shift STRING, "
        "product_sku STRING",
    ),
)
