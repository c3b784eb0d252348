"""Queries: grouped aggregates and the eleven data products."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.catalog import standins as s
from tidemark.catalog.base import EVENTS_RUN, ORDERS_RUN, Tables, query
from tidemark.catalog.features import risk_features
from tidemark.functions.scoring import money_sum, rate
from tidemark.operators import aggregates, keyed
from tidemark.plans import asset, provider, risk


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# Aggregates


@query(
    "monthly_support_agg",
    "AGG-01 AGG-02 AGG-08 GLD-03",
    "WITH " + s.SUPPORT_SQL + """
    SELECT hcp_id, product, case_type, payer_type, case_month, case_count,
      round(avg_resolution_days, 8) AS avg_resolution_days, escalated_count FROM support""",
)
def monthly_support_agg(t: Tables) -> DataFrame:
    out = provider.support_by_month(s.patient_support(t))
    return rounded(out, 8, "avg_resolution_days")


SUMMARY_SQL = (
    "WITH " + s.SUPPORT_SQL + "," + s.HCP_SQL + """
    SELECT territory_id, product, case_type, CAST(date_trunc('quarter', case_month) AS DATE) AS case_quarter,
      CAST(SUM(case_count) AS BIGINT) AS total_cases, round({mean}, 8) AS avg_resolution_days,
      CAST(SUM(escalated_count) AS BIGINT) AS total_escalations,
      round(100.0 * SUM(escalated_count) / SUM(case_count), 2) AS escalation_rate_pct
    FROM support JOIN hcp USING (hcp_id) GROUP BY 1, 2, 3, 4"""
)
PLAIN_MEAN = "AVG(avg_resolution_days)"


def _summary(t: Tables, k: int, weighted: bool = False) -> DataFrame:
    tables = s.provider_silver(t)
    out = provider.support_summary(
        tables["silver_patient_support_agg"], tables["silver_hcp_standardized"], k, weighted
    )
    return rounded(out, 8, "avg_resolution_days")


@query("quarter_region_rollup", "AGG-05 AGG-09 JOI-02 GLD-03", SUMMARY_SQL.format(mean=PLAIN_MEAN))
def quarter_region_rollup(t: Tables) -> DataFrame:
    return _summary(t, k=0)


@query(
    "quarter_region_weighted",
    "AGG-09",
    SUMMARY_SQL.format(
        mean="SUM(avg_resolution_days * case_count) / "
        "SUM(CASE WHEN avg_resolution_days IS NOT NULL THEN case_count END)"
    ),
)
def quarter_region_weighted(t: Tables) -> DataFrame:
    return _summary(t, k=0, weighted=True)


@query(
    "cohort_suppressed",
    "AGG-19",
    SUMMARY_SQL.format(mean=PLAIN_MEAN) + " HAVING SUM(case_count) >= 10",
)
def cohort_suppressed(t: Tables) -> DataFrame:
    return _summary(t, k=provider.MIN_COHORT)


@query(
    "small_groups_hidden",
    "AGG-19",
    """SELECT user_id, event_type, COUNT(*) AS n_events, CAST(SUM(CAST(value AS DECIMAL(28, 6))) AS DOUBLE) AS total
    FROM events GROUP BY 1, 2 HAVING COUNT(*) >= 10""",
)
def small_groups_hidden(t: Tables) -> DataFrame:
    """Groups of a user's events, some below the smallest group that may be shown and some above."""
    groups = t.events.groupBy("user_id", "event_type").agg(
        F.count("*").alias("n_events"), money_sum(F.col("value")).alias("total")
    )
    return aggregates.suppress_small(groups, "n_events", 10)


@query(
    "two_level_rollup",
    "AGG-09 AGG-11",
    """SELECT c_nationkey, COUNT(*) AS customers, round(AVG(mean_price), 5) AS mean_of_means,
       round(MIN(mean_price), 6) AS lowest_mean FROM (
         SELECT c_nationkey, c_custkey, AVG(o_totalprice) AS mean_price
         FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2) GROUP BY 1""",
)
def two_level_rollup(t: Tables) -> DataFrame:
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return aggregates.rollup_two_level(
        joined,
        ["c_nationkey", "c_custkey"],
        [F.avg("o_totalprice").alias("mean_price")],
        ["c_nationkey"],
        [
            F.count("*").alias("customers"),
            F.round(F.avg("mean_price"), 5).alias("mean_of_means"),
            F.round(F.min("mean_price"), 6).alias("lowest_mean"),
        ],
    )


@query(
    "daily_sensor_stats",
    "AGG-03 AGG-06",
    "WITH " + s.READINGS_SQL + """
    SELECT asset_id, CAST(ts AS DATE) AS reading_date, sensor_type,
      round(AVG(value) FILTER (WHERE valid = 1), 8) AS daily_avg,
      MAX(value) FILTER (WHERE valid = 1) AS daily_max, MIN(value) FILTER (WHERE valid = 1) AS daily_min,
      round(stddev_samp(value) FILTER (WHERE valid = 1), 8) AS daily_std,
      COUNT(*) FILTER (WHERE valid = 1) AS valid_count, COUNT(*) AS total_count,
      CAST(SUM(anomaly) AS BIGINT) AS anomaly_count_day, CAST(SUM(outlier) AS BIGINT) AS outlier_count_day,
      round(100.0 * SUM(valid) / COUNT(*), 2) AS day_completeness_pct
    FROM readings GROUP BY 1, 2, 3""",
)
def daily_sensor_stats(t: Tables) -> DataFrame:
    out = asset.daily_sensor_stats(s.asset_silver(t)["silver_sensors_clean"])
    return rounded(out, 8, "daily_avg", "daily_std")


DAILY_SQL = """
daily AS (
  SELECT asset_id, CAST(ts AS DATE) AS reading_date, sensor_type,
    AVG(value) FILTER (WHERE valid = 1) AS davg, MAX(value) FILTER (WHERE valid = 1) AS dmax,
    stddev_samp(value) FILTER (WHERE valid = 1) AS dstd, SUM(anomaly) AS anomalies,
    SUM(outlier) AS outliers, round(100.0 * SUM(valid) / COUNT(*), 2) AS complete
  FROM readings GROUP BY 1, 2, 3),
wide AS (
  SELECT asset_id, reading_date,
    MAX(davg) FILTER (WHERE sensor_type = 'temperature') AS avg_temp,
    MAX(davg) FILTER (WHERE sensor_type = 'vibration') AS avg_vibration,
    MAX(davg) FILTER (WHERE sensor_type = 'pressure') AS avg_pressure,
    MAX(davg) FILTER (WHERE sensor_type = 'speed') AS avg_speed,
    MAX(dmax) FILTER (WHERE sensor_type = 'temperature') AS max_temp,
    MAX(dmax) FILTER (WHERE sensor_type = 'vibration') AS max_vibration,
    MAX(dstd) FILTER (WHERE sensor_type = 'temperature') AS std_temp,
    MAX(dstd) FILTER (WHERE sensor_type = 'vibration') AS std_vibration,
    CAST(SUM(anomalies) AS BIGINT) AS total_anomalies_day, CAST(SUM(outliers) AS BIGINT) AS total_outliers_day,
    AVG(complete) AS sensor_completeness_pct
  FROM daily GROUP BY 1, 2)"""
WIDE_SELECT = """asset_id, reading_date, round(avg_temp, 8) AS avg_temp, round(avg_vibration, 8) AS avg_vibration,
  round(avg_pressure, 8) AS avg_pressure, round(avg_speed, 8) AS avg_speed, max_temp, max_vibration,
  round(std_temp, 8) AS std_temp, round(std_vibration, 8) AS std_vibration, total_anomalies_day,
  total_outliers_day, round(sensor_completeness_pct, 8) AS sensor_completeness_pct"""
WIDE_ROUNDED = (
    "avg_temp", "avg_vibration", "avg_pressure", "avg_speed", "std_temp", "std_vibration",
    "sensor_completeness_pct",
)


@query(
    "daily_pivot",
    "AGG-10",
    "WITH " + s.READINGS_SQL + "," + DAILY_SQL + f" SELECT {WIDE_SELECT} FROM wide",
)
def daily_pivot(t: Tables) -> DataFrame:
    out = asset.daily_asset_features(s.asset_silver(t)["silver_sensors_clean"])
    return rounded(out, 8, *WIDE_ROUNDED)


@query(
    "distinct_counts",
    "AGG-04",
    """SELECT o_orderpriority, COUNT(DISTINCT o_custkey) AS customers,
       COUNT(DISTINCT o_orderstatus) AS states FROM orders GROUP BY 1""",
)
def distinct_counts(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderpriority").agg(
        F.countDistinct("o_custkey").alias("customers"),
        F.countDistinct("o_orderstatus").alias("states"),
    )


@query(
    "flag_rates",
    "AGG-05 AGG-06 AGG-07",
    """SELECT l_linestatus, round(100.0 * COUNT(*) FILTER (WHERE l_returnflag = 'R') / COUNT(*), 2) AS returned_pct,
       round(100.0 * COUNT(*) FILTER (WHERE l_quantity > 25) / nullif(COUNT(*) FILTER (WHERE l_tax > 9), 0), 2) AS undefined_pct
    FROM lineitem GROUP BY 1""",
)
def flag_rates(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_linestatus").agg(
        rate(F.count_if(F.col("l_returnflag") == "R"), F.count("*")).alias("returned_pct"),
        rate(F.count_if(F.col("l_quantity") > 25), F.count_if(F.col("l_tax") > 9)).alias(
            "undefined_pct"
        ),
    )


@query(
    "linkage_rate",
    "JOI-08 DQ-02",
    """SELECT COUNT(*) AS total_rows, COUNT(labels.doc_id) AS linked_rows,
       round(100.0 * COUNT(labels.doc_id) / COUNT(*), 4) AS linkage_pct
    FROM documents LEFT JOIN labels USING (doc_id)""",
)
def linkage_rate(t: Tables) -> DataFrame:
    return aggregates.linkage(t.documents, t.labels, "doc_id", "doc_id")


@query(
    "duplicate_keys",
    "AGG-12",
    """SELECT l_orderkey, l_linenumber, COUNT(*) AS row_count FROM lineitem
       GROUP BY 1, 2 HAVING COUNT(*) > 1""",
)
def duplicate_keys(t: Tables) -> DataFrame:
    return keyed.duplicate_keys(t.lineitem, "l_orderkey", "l_linenumber")


@query(
    "column_medians",
    "AGG-18",
    """SELECT 'l_quantity' AS feature, median(l_quantity) AS median FROM lineitem
       UNION ALL SELECT 'l_extendedprice', median(l_extendedprice) FROM lineitem
       UNION ALL SELECT 'l_tax', median(l_tax) FROM lineitem""",
)
def column_medians(t: Tables) -> DataFrame:
    return aggregates.exact_median(t.lineitem, ["l_quantity", "l_extendedprice", "l_tax"])


# Products


VIEW_COLUMNS = """hcp_id, npi, upper(first_name) AS first_name, last_name, full_name, specialty_code,
  specialty_name, specialty_tier, state, territory_id, degree, years_in_practice, is_kol, is_investigator,
  total_interactions_12m, interactions_90d, last_interaction_date, positive_outcomes, total_rx_12m,
  total_new_starts_12m, round(avg_market_share, 8) AS avg_market_share, {cases} engagement_score,
  dq_npi_valid, dq_name_complete, _batch_id"""


def _view(t: Tables, with_cases: bool = True) -> DataFrame:
    tables = s.provider_silver(t)
    return provider.hcp_360(
        tables["silver_hcp_standardized"],
        tables["silver_interactions_clean"],
        tables["silver_rx_aggregates"],
        tables["silver_patient_support_agg"] if with_cases else None,
        ORDERS_RUN,
    )


@query(
    "entity_360",
    "GLD-01 SCO-01 WIN-03 JOI-01",
    "WITH " + s.HCP_360_SQL + " SELECT "
    + VIEW_COLUMNS.format(cases="total_psp_cases, total_psp_escalations,") + " FROM view360",
)
def entity_360(t: Tables) -> DataFrame:
    return rounded(_view(t).drop("gold_created_ts"), 8, "avg_market_share")


@query(
    "entity_360_no_cases",
    "V-03",
    "WITH " + s.HCP_360_SQL + " SELECT " + VIEW_COLUMNS.format(cases="") + " FROM view360",
)
def entity_360_no_cases(t: Tables) -> DataFrame:
    return rounded(_view(t, with_cases=False).drop("gold_created_ts"), 8, "avg_market_share")


@query(
    "targeting_score",
    "GLD-02 SCO-02 WIN-05 FUN-05",
    "WITH " + s.HCP_360_SQL + """
    SELECT hcp_id, npi, specialty_tier, territory_id, state, total_interactions_12m, interactions_90d,
      days_since_last_interaction, positive_outcomes, total_rx_12m, total_new_starts_12m,
      round(avg_market_share * 100, 2) AS market_share_pct, total_psp_cases, engagement_score,
      CAST(is_kol AS INTEGER) AS is_kol_flag, CAST(is_investigator AS INTEGER) AS is_investigator_flag,
      years_in_practice, targeting_priority FROM targeting""",
)
def targeting_score(t: Tables) -> DataFrame:
    return provider.targeting_score(_view(t), ORDERS_RUN).drop("feature_ts", "_batch_id")


@query(
    "supplier_priority",
    "GLD-04 JOI-02 JOI-09",
    "WITH " + s.SITES_SQL + """
    SELECT CAST(s_suppkey AS VARCHAR) AS site_id, CAST(s_nationkey AS VARCHAR) AS hco_id, n_name AS hco_name,
      upper(n_name) AS state, CAST(s_suppkey % 12 AS VARCHAR) AS trial_id, enrolled AS enrolled_patients,
      failed AS screen_failures, CAST(s_suppkey % 30 AS DOUBLE) / 100 AS query_rate,
      CAST(s_suppkey % 7 AS INTEGER) AS protocol_deviations, rating AS site_rating, s_acctbal > 0 AS is_active,
      n_regionkey > 1 AS is_teaching, n_regionkey = 4 AS is_nci_designated,
      round(100.0 * enrolled / nullif(enrolled + failed, 0), 2) AS enrollment_success_pct,
      CAST(greatest(0, least(100, 2 * enrolled
        + CASE rating WHEN 'Excellent' THEN 30 WHEN 'Good' THEN 20 WHEN 'Acceptable' THEN 10 ELSE 0 END
        - 5 * (s_suppkey % 7) - s_suppkey % 30)) AS DOUBLE) AS site_quality_score,
      CASE WHEN enrolled >= 30 AND s_suppkey % 4 < 2 THEN 'HIGH' WHEN enrolled >= 15 THEN 'MEDIUM'
        ELSE 'LOW' END AS priority_tier FROM sites""",
)
def supplier_priority(t: Tables) -> DataFrame:
    tables = s.provider_silver(t)
    return provider.site_priority(
        tables["silver_trial_sites_clean"], tables["silver_hco_standardized"], ORDERS_RUN
    ).drop("gold_created_ts", "_batch_id")


@query(
    "customer_profile",
    "GLD-05",
    "WITH " + s.CUSTOMER_360_SQL + " SELECT * FROM cust360",
)
def customer_profile(t: Tables) -> DataFrame:
    return risk.customer_360(
        s.risk_silver(t)["silver_customers_clean"], s.bureau(t), EVENTS_RUN
    ).drop("gold_created_ts", "_batch_id")


RISK_PROFILE_SQL = (
    s.RISK_FEATURES_SQL + """,
profile AS (
  SELECT customer_id, COUNT(*) AS total_transactions,
    COUNT(*) FILTER (WHERE is_fraud) AS confirmed_fraud_count,
    round(100.0 * COUNT(*) FILTER (WHERE is_fraud) / COUNT(*), 3) AS fraud_rate_pct,
    round(CAST(SUM(CAST(amount AS DECIMAL(28, 6))) AS DOUBLE) / COUNT(amount), 7) AS avg_transaction_amount, MAX(amount) AS max_transaction_amount,
    round(CAST(SUM(CAST(ratio AS DECIMAL(28, 9))) AS DOUBLE) / COUNT(ratio), 3) AS avg_amount_deviation, MAX(states30) AS max_distinct_states,
    CAST(SUM(new_devices) AS BIGINT) AS total_new_device_events, CAST(SUM(vpns) AS BIGINT) AS total_vpn_events,
    round(CAST(SUM(bureau_score) AS DOUBLE) / COUNT(bureau_score), 7) AS avg_bureau_score,
    CASE WHEN bool_or(is_fraud) THEN 'CONFIRMED_FRAUD'
         WHEN CAST(SUM(CAST(ratio AS DECIMAL(28, 9))) AS DOUBLE) / COUNT(ratio) > 5 AND MAX(states30) > 3 THEN 'HIGH'
         WHEN CAST(SUM(CAST(credit_utilization_pct AS DECIMAL(28, 9))) AS DOUBLE) / COUNT(credit_utilization_pct) > 0.8::DOUBLE OR SUM(num_derogatory_marks) > 2 * COUNT(num_derogatory_marks) THEN 'MEDIUM'
         ELSE 'LOW' END AS risk_tier
  FROM features GROUP BY 1)"""
)


def risk_profile(t: Tables) -> DataFrame:
    out = risk.customer_risk_profile(risk_features(t), EVENTS_RUN).drop("gold_created_ts")
    return rounded(out, 7, "avg_transaction_amount", "avg_bureau_score")


query(
    "risk_profile", "GLD-07 AGG-07 SCO-02", "WITH " + RISK_PROFILE_SQL + " SELECT * FROM profile"
)(risk_profile)


SENSOR_COLUMNS = """sensor_id, asset_id, sensor_type, total_readings, valid_readings,
  round(validity, 2) AS validity_rate_pct, hard_outlier_count, round(outlier_rate, 2) AS outlier_rate_pct,
  anomaly_count, round(anomaly_rate, 2) AS anomaly_rate_pct, first_reading_ts, last_reading_ts,
  {expected} round(sensor_quality_score, 8) AS sensor_quality_score"""


def sensor_quality(t: Tables) -> DataFrame:
    out = asset.sensor_quality(s.asset_silver(t)["silver_sensors_clean"], EVENTS_RUN)
    return rounded(out.drop("gold_created_ts", "_batch_id"), 8, "sensor_quality_score")


query(
    "sensor_quality",
    "GLD-08 SCO-01 AGG-05 AGG-06 FUN-02",
    "WITH " + s.SENSORS_SQL + " SELECT "
    + SENSOR_COLUMNS.format(expected="expected_reading_count,") + " FROM scored",
)(sensor_quality)


@query(
    "sensor_quality_short",
    "V-05",
    "WITH " + s.SENSORS_SQL + " SELECT " + SENSOR_COLUMNS.format(expected="") + " FROM scored",
)
def sensor_quality_short(t: Tables) -> DataFrame:
    return sensor_quality(t).drop("expected_reading_count")


def failure_features(t: Tables) -> DataFrame:
    tables = s.asset_silver(t)
    return asset.failure_features(
        tables["silver_sensors_clean"],
        tables["silver_assets_clean"],
        tables["silver_failure_events_clean"],
        tables["silver_work_orders_clean"],
        EVENTS_RUN,
    )


FAILURE_SQL = (
    s.READINGS_SQL + "," + DAILY_SQL + "," + s.ASSETS_SQL + """,
labelled AS (
  SELECT wide.*, asset_type, age_years, criticality, maintenance_interval_days,
    CAST(EXISTS (SELECT 1 FROM failures f WHERE f.asset_id = wide.asset_id
      AND f.failure_date >= reading_date AND f.failure_date <= reading_date + 7) AS INTEGER) AS failure_in_next_7d,
    CAST(COALESCE((SELECT MIN(reading_date - w.completed_date) FROM work w WHERE w.asset_id = wide.asset_id
      AND w.completed_date <= reading_date), 999) AS INTEGER) AS days_since_last_maintenance,
    (SELECT COUNT(*) FROM failures f WHERE f.asset_id = wide.asset_id
      AND f.failure_date <= reading_date AND f.failure_date >= reading_date - 90) AS failures_last_90d,
    CAST(CASE criticality WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 ELSE 1 END AS INTEGER) AS criticality_num
  FROM wide LEFT JOIN assets USING (asset_id)
  WHERE avg_temp IS NOT NULL OR avg_vibration IS NOT NULL)"""
)


@query(
    "failure_features",
    "GLD-09 AGG-10 JOI-05 JOI-06 JOI-07 FUN-06",
    "WITH " + FAILURE_SQL + f""" SELECT {WIDE_SELECT}, asset_type, age_years, criticality,
      maintenance_interval_days, failure_in_next_7d, days_since_last_maintenance, failures_last_90d,
      criticality_num FROM labelled""",
)
def failure_features_query(t: Tables) -> DataFrame:
    return rounded(failure_features(t).drop("feature_ts", "_batch_id"), 8, *WIDE_ROUNDED)


def asset_health(t: Tables) -> DataFrame:
    tables = s.asset_silver(t)
    return asset.asset_health(
        tables["silver_assets_clean"],
        asset.sensor_quality(tables["silver_sensors_clean"], EVENTS_RUN),
        tables["silver_failure_events_clean"],
        tables["silver_work_orders_clean"],
        EVENTS_RUN,
    )


@query(
    "asset_health",
    "GLD-10 AGG-11 JOI-01 WIN-03 WIN-05",
    "WITH " + s.HEALTH_SQL + """
    SELECT asset_id, asset_name, asset_type, production_line, criticality, age_years,
      maintenance_interval_days, round(COALESCE(quality, 0), 8) AS avg_sensor_quality_score,
      round(sensor_validity_rate, 8) AS sensor_validity_rate, total_sensor_anomalies, failure_count_12m,
      total_downtime_hours_12m, last_failure_date, days_since_last_failure, work_orders_12m,
      maintenance_cost_12m_usd, last_maintenance_date, days_since_last_maintenance,
      round(asset_health_score, 8) AS asset_health_score, maintenance_urgency FROM health""",
)
def asset_health_query(t: Tables) -> DataFrame:
    out = asset_health(t).drop("gold_created_ts", "_batch_id")
    return rounded(
        out, 8, "avg_sensor_quality_score", "sensor_validity_rate", "asset_health_score"
    )


QUEUE_SQL = (
    s.HEALTH_SQL + """,
queue AS (
  SELECT *, CASE criticality WHEN 'HIGH' THEN 40 WHEN 'MEDIUM' THEN 25 ELSE 10 END
      + CASE maintenance_urgency WHEN 'OVERDUE' THEN 30 WHEN 'DUE_SOON' THEN 15 ELSE 0 END
      + 0.2 * greatest(0, 100 - asset_health_score) + least(5 * failure_count_12m, 20) AS priority,
    CASE WHEN asset_health_score < 30 AND criticality = 'HIGH' THEN 'EMERGENCY'
         WHEN asset_health_score < 50 OR maintenance_urgency = 'OVERDUE' THEN 'HIGH'
         WHEN maintenance_urgency = 'DUE_SOON' THEN 'MEDIUM' ELSE 'LOW' END AS recommended_action_tier
  FROM health)"""
)


@query(
    "maintenance_queue",
    "GLD-11 TOP-01",
    "WITH " + QUEUE_SQL + """
    SELECT asset_id, asset_name, criticality, maintenance_urgency, failure_count_12m,
      total_downtime_hours_12m, total_sensor_anomalies, round(priority, 1) AS maintenance_priority_score,
      recommended_action_tier FROM queue""",
)
def maintenance_queue(t: Tables) -> DataFrame:
    return asset.maintenance_queue(asset_health(t), EVENTS_RUN).select(
        "asset_id", "asset_name", "criticality", "maintenance_urgency", "failure_count_12m",
        "total_downtime_hours_12m", "total_sensor_anomalies", "maintenance_priority_score",
        "recommended_action_tier",
    )
