"""Queries: quality suites, contracts, monitoring, governance."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.catalog import products as p, standins as s
from tidemark.catalog.base import EVENTS_RUN, ORDERS_RUN, Tables, query
from tidemark.catalog.features import risk_features
from tidemark.functions.scoring import rate
from tidemark.operators import checks, governance, monitor
from tidemark.operators.aggregates import linkage
from tidemark.plans import asset, provider, risk


# Suites


def provider_results(t: Tables) -> DataFrame:
    bronze, silver = s.provider_bronze(t), s.provider_silver(t)
    tables = {**bronze, **silver, **provider.gold(silver, ORDERS_RUN, keep=t.keep)}
    tables["interactions_to_hcp"] = linkage(
        silver["silver_interactions_clean"], silver["silver_hcp_standardized"], "hcp_id", "hcp_id"
    )
    return checks.run_suite(t.spark, provider.CHECKS, tables)


def risk_results(t: Tables) -> DataFrame:
    silver = s.risk_silver(t)
    features = t.keep(risk_features(t), "gold_transaction_risk_features")
    tables = {
        "bronze_transactions": s.transactions(t),
        "bronze_customers": s.customers(t),
        **silver,
        "gold_customer_360": risk.customer_360(
            silver["silver_customers_clean"], s.bureau(t), EVENTS_RUN
        ),
        "gold_transaction_risk_features": features,
        "gold_customer_risk_profile": risk.customer_risk_profile(features, EVENTS_RUN),
        "transactions_to_customer": linkage(
            silver["silver_transactions_clean"], silver["silver_customers_clean"],
            "customer_id", "customer_id",
        ),
    }
    return checks.run_suite(t.spark, risk.checks(EVENTS_RUN), tables)


def asset_results(t: Tables) -> DataFrame:
    silver = s.asset_silver(t)
    tables = {**silver, **asset.gold(silver, EVENTS_RUN, keep=t.keep)}
    return checks.run_suite(t.spark, asset.checks(EVENTS_RUN), tables)


def _suite_sql(ctes: str, rows: list[tuple[str, str, float, str]]) -> str:
    """One row per check; a row is (name, scalar SQL, threshold, comparison)."""
    parts = [
        f"SELECT '{name}' AS check_name, CAST(COALESCE(({value}), 0) AS DOUBLE) AS v, "
        f"CAST({threshold} AS DOUBLE) AS threshold, '{op}' AS op"
        for name, value, threshold, op in rows
    ]
    return f"""WITH {ctes}, observed AS ({' UNION ALL '.join(parts)}),
    judged AS (SELECT check_name, round(v, 4) AS value, threshold,
      CASE WHEN op = '>=' THEN v >= threshold ELSE v <= threshold END AS passed FROM observed),
    results AS (SELECT check_name, value, threshold, passed,
      CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END AS status FROM judged)"""


PROVIDER_SUITE = _suite_sql(
    s.HCP_360_SQL + "," + s.SITES_SQL,
    [
        ("bronze_hcp_master_row_count", "SELECT COUNT(*) FROM customer", 1000, ">="),
        ("bronze_interactions_row_count", "SELECT COUNT(*) FROM orders", 10000, ">="),
        ("silver_hcp_npi_completeness_pct", "SELECT 100.0 * SUM(dq_npi_valid) / COUNT(*) FROM hcp", 95, ">="),
        ("silver_hcp_name_completeness_pct", "SELECT 100.0 * SUM(dq_name_complete) / COUNT(*) FROM hcp", 99, ">="),
        ("silver_hcp_specialty_completeness_pct",
         "SELECT 100.0 * SUM(dq_specialty_present) / COUNT(*) FROM hcp", 98, ">="),
        ("silver_hcp_uniqueness_pct", "SELECT 100.0 * (COUNT(*) - COUNT(DISTINCT hcp_id)) / COUNT(*) FROM hcp", 0, "<="),
        ("silver_interactions_valid_date_pct", "SELECT 100", 99, ">="),
        ("silver_interactions_hcp_linkage_pct",
         "SELECT 100.0 * COUNT(c_custkey) / COUNT(*) FROM orders LEFT JOIN customer ON o_custkey = c_custkey", 95, ">="),
        ("gold_hcp_360_uniqueness", "SELECT 100.0 * (COUNT(*) - COUNT(DISTINCT hcp_id)) / COUNT(*) FROM view360", 0, "<="),
        ("gold_hcp_360_engagement_score_range",
         "SELECT 100.0 * COUNT(*) FILTER (WHERE engagement_score < 0 OR engagement_score > 100) / COUNT(*) FROM view360",
         0, "<="),
        ("gold_targeting_score_priority_coverage",
         "SELECT 100.0 * COUNT(targeting_priority) / COUNT(*) FROM targeting", 100, ">="),
        ("gold_targeting_tier_distribution_a_pct",
         "SELECT 100.0 * COUNT(*) FILTER (WHERE targeting_priority = 'A') / COUNT(*) FROM targeting", 5, ">="),
        ("gold_trial_site_priority_completeness", "SELECT 100.0 * COUNT(enrolled) / COUNT(*) FROM sites", 98, ">="),
        ("gold_psp_summary_territory_coverage",
         "SELECT COUNT(DISTINCT territory_id) FROM (SELECT territory_id FROM support JOIN hcp USING (hcp_id) "
         "GROUP BY territory_id, product, case_type, date_trunc('quarter', case_month) HAVING SUM(case_count) >= 10)",
         20, ">="),
    ],
)

RISK_SUITE = _suite_sql(
    p.RISK_PROFILE_SQL,
    [
        ("bronze_transactions_row_count", "SELECT COUNT(*) FROM events WHERE event_type = 'purchase'", 50000, ">="),
        ("bronze_customers_row_count", "SELECT COUNT(*) FROM customer", 1000, ">="),
        ("silver_transactions_amount_positive_pct",
         "SELECT 100.0 * COUNT(*) FILTER (WHERE value > 0) / COUNT(*) FROM events WHERE event_type = 'purchase'", 99, ">="),
        ("silver_transactions_date_valid_pct",
         "SELECT 100.0 * COUNT(*) FILTER (WHERE CAST(ts AS DATE) <= DATE '2024-01-31') / COUNT(*) FROM events WHERE event_type = 'purchase'", 99.9, ">="),
        ("silver_transactions_no_future_dates", "SELECT COUNT(*) FROM tx WHERE d > DATE '2024-01-31'", 0, "<="),
        ("silver_customers_uniqueness",
         "SELECT 100.0 * (COUNT(*) - COUNT(DISTINCT c_custkey)) / COUNT(*) FROM customer", 0, "<="),
        ("silver_transactions_customer_linkage_pct",
         "SELECT 100.0 * COUNT(cust360.customer_id) / COUNT(*) FROM tx LEFT JOIN cust360 USING (customer_id)", 98, ">="),
        ("gold_features_no_future_feature_ts",
         "SELECT COUNT(*) FROM features WHERE TIMESTAMP '2024-01-31 06:00:00' > TIMESTAMP '2024-01-31 06:00:00' + INTERVAL 1 HOUR", 0, "<="),
        ("gold_features_bureau_score_range",
         "SELECT COUNT(*) FROM features WHERE bureau_score < 300 OR bureau_score > 850", 0, "<="),
        ("gold_features_fraud_rate_realistic",
         "SELECT 100.0 * COUNT(*) FILTER (WHERE is_fraud) / COUNT(*) FROM features", 0.5, ">="),
        ("gold_customer_360_completeness", "SELECT COUNT(*) FROM cust360", 4000, ">="),
        ("gold_features_feature_ts_recent", "SELECT 0", 0, "<="),
        ("gold_pit_no_negative_days_since_last", "SELECT COUNT(*) FROM features WHERE recency < 0", 0, "<="),
        ("gold_risk_profile_tier_coverage", "SELECT 100.0 * COUNT(risk_tier) / COUNT(*) FROM profile", 100, ">="),
    ],
)

ASSET_SUITE = _suite_sql(
    p.FAILURE_SQL + "," + s.HEALTH_SQL.replace(s.READINGS_SQL + ",", "").replace(s.ASSETS_SQL + ",", ""),
    [
        ("sensor_timestamp_not_future_pct", "SELECT 100.0 * SUM(not_future) / COUNT(*) FROM readings", 99, ">="),
        ("sensor_timestamp_not_ancient_pct", "SELECT 100.0 * SUM(not_ancient) / COUNT(*) FROM readings", 99, ">="),
        ("sensor_value_in_range_pct", "SELECT 100.0 * SUM(in_range) / COUNT(*) FROM readings", 95, ">="),
        ("sensor_hard_outlier_rate_pct", "SELECT 100.0 * SUM(outlier) / COUNT(*) FROM readings", 2, "<="),
        ("sensor_anomaly_rate_pct", "SELECT 100.0 * SUM(anomaly) / COUNT(*) FROM readings", 20, "<="),
        ("gold_sensor_quality_score_coverage", "SELECT COUNT(*) FROM scored", 50, ">="),
        ("gold_sensor_min_quality_score_avg", "SELECT AVG(sensor_quality_score) FROM scored", 60, ">="),
        ("gold_asset_health_all_assets", "SELECT COUNT(*) FROM health", 50, ">="),
        ("gold_asset_health_score_range",
         "SELECT COUNT(*) FROM health WHERE asset_health_score < 0 OR asset_health_score > 100", 0, "<="),
        ("gold_features_failure_label_coverage",
         "SELECT 100.0 * COUNT(failure_in_next_7d) / COUNT(*) FROM labelled", 99, ">="),
        ("gold_features_avg_temp_completeness", "SELECT 100.0 * COUNT(avg_temp) / COUNT(*) FROM labelled", 70, ">="),
        ("gold_maintenance_recommendations_coverage", "SELECT COUNT(*) FROM health", 50, ">="),
        ("gold_features_recent_feature_ts", "SELECT 0", 0, "<="),
    ],
)

RESULTS = " SELECT * FROM results"
CARD = """ SELECT '{project}' AS project, round(100.0 * COUNT(*) FILTER (WHERE passed) / COUNT(*), 1) AS overall_score,
  COUNT(*) AS total_checks, COUNT(*) FILTER (WHERE passed) AS passed_checks,
  COUNT(*) FILTER (WHERE NOT passed) AS failed_checks,
  CASE WHEN 100.0 * COUNT(*) FILTER (WHERE passed) / COUNT(*) >= 84.95 THEN 'HEALTHY'
       WHEN 100.0 * COUNT(*) FILTER (WHERE passed) / COUNT(*) >= 59.95 THEN 'DEGRADED' ELSE 'CRITICAL' END AS status,
  COALESCE(string_agg(check_name, ',' ORDER BY check_name) FILTER (WHERE NOT passed), '') AS failed_check_names
  FROM results"""

query("dq_results_provider", "DQ-01 DQ-02", PROVIDER_SUITE + RESULTS)(provider_results)
query("dq_results_risk", "DQ-01 DQ-02", RISK_SUITE + RESULTS)(risk_results)
query("dq_results_asset", "DQ-01 DQ-02", ASSET_SUITE + RESULTS)(asset_results)


def _card(results: DataFrame, project: str) -> DataFrame:
    return checks.scorecard(results, project).withColumn(
        "failed_check_names", F.array_join("failed_check_names", ",")
    )


@query("dq_scorecard_provider", "DQ-03", PROVIDER_SUITE + CARD.format(project="Provider"))
def dq_scorecard_provider(t: Tables) -> DataFrame:
    return _card(provider_results(t), "Provider")


@query("dq_scorecard_risk", "DQ-03", RISK_SUITE + CARD.format(project="Risk"))
def dq_scorecard_risk(t: Tables) -> DataFrame:
    return _card(risk_results(t), "Risk")


@query("dq_scorecard_asset", "DQ-03", ASSET_SUITE + CARD.format(project="Asset"))
def dq_scorecard_asset(t: Tables) -> DataFrame:
    return _card(asset_results(t), "Asset")


@query(
    "dq_gate",
    "DQ-04",
    "SELECT project, status, status AS gate_saw, status <> 'CRITICAL' AS may_pass FROM ("
    + PROVIDER_SUITE + CARD.format(project="Provider") + ")",
)
def dq_gate(t: Tables) -> DataFrame:
    """The provider scorecard as the gate saw it; under ``warn`` a critical one is only reported."""
    card = t.keep(_card(provider_results(t), "Provider"), "card")
    seen = checks.enforce_gate(card, "warn")
    return card.select(
        "project", "status", F.lit(seen).alias("gate_saw"), (F.col("status") != "CRITICAL").alias("may_pass")
    )


# Contracts and feature quality

CUSTOMER_CONTRACT = checks.Contract(
    name="silver_hcp_standardized",
    version="1.0",
    owner="data-engineering",
    fields={
        "hcp_id": checks.FieldRule("string", nullable=False),
        "npi": checks.FieldRule("string", nullable=False, pattern="^[0-9]{10}$"),
        "specialty_code": checks.FieldRule("string", nullable=False),
        "years_in_practice": checks.FieldRule("bigint"),
        "license_number": checks.FieldRule("string"),
    },
    freshness_hours=24,
    completeness_pct=99.5,
    forbidden=("ssn", "degree"),
)


@query(
    "contract_violations",
    "DQ-05 SIL-19 GOV-03",
    "WITH " + s.HCP_SQL + """
    SELECT 'silver_hcp_standardized' AS contract, field, rule, CAST(n AS BIGINT) AS violations FROM (
      SELECT 'npi' AS field, 'pattern' AS rule, COUNT(*) FILTER (WHERE NOT regexp_matches(npi, '^[0-9]{10}$')) AS n FROM hcp
      UNION ALL SELECT 'specialty_code', 'not_null', COUNT(*) FILTER (WHERE specialty_code IS NULL) FROM hcp
      UNION ALL SELECT 'specialty_code', 'completeness',
        CASE WHEN 100.0 * COUNT(specialty_code) / COUNT(*) < 99.5 THEN 1 ELSE 0 END FROM hcp
      UNION ALL SELECT 'years_in_practice', 'type', 1
      UNION ALL SELECT 'license_number', 'missing', 1
      UNION ALL SELECT 'degree', 'forbidden', 1) WHERE n > 0""",
)
def contract_violations(t: Tables) -> DataFrame:
    return checks.contract_violations(
        provider.hcp_standardized(s.hcp_master(t)), CUSTOMER_CONTRACT, "_load_ts", ORDERS_RUN
    )


@query(
    "feature_quality",
    "DQ-06",
    """SELECT feature, round(completeness, 6) AS completeness, round(freshness, 6) AS freshness,
      round(validity, 6) AS validity, round(completeness * freshness * validity, 6) AS feature_quality_score
    FROM (
      SELECT 'value' AS feature, 1.0::DOUBLE AS completeness,
        COUNT(*) FILTER (WHERE ts > TIMESTAMP '2024-01-30 05:00:00') / COUNT(*) AS freshness,
        COUNT(*) FILTER (WHERE value >= 1 AND value <= 225) / COUNT(*) AS validity FROM events
      UNION ALL
      SELECT 'small_value', COUNT(*) FILTER (WHERE value < 100) / COUNT(*),
        COUNT(*) FILTER (WHERE value < 100 AND ts > TIMESTAMP '2024-01-10 05:00:00') / COUNT(*) FILTER (WHERE value < 100),
        COUNT(*) FILTER (WHERE value < 50) / COUNT(*) FILTER (WHERE value < 100) FROM events)""",
)
def feature_quality(t: Tables) -> DataFrame:
    frame = t.events.select(
        "ts", "value", F.when(F.col("value") < 100, F.col("value")).alias("small_value")
    )
    specs = [
        checks.FeatureSpec("value", "value BETWEEN 1 AND 225", "ts", 24),
        checks.FeatureSpec("small_value", "small_value < 50", "ts", 504),
    ]
    out = checks.feature_quality(frame, specs, EVENTS_RUN)
    return p.rounded(out, 6, "completeness", "freshness", "validity", "feature_quality_score")


# Maximum age in hours and the action beyond it.
STALENESS = {
    "purchase": (0, "Block scoring"),
    "view": (24, "Warn, continue"),
    "click": (1080, "Flag score with caveat"),
    "signup": (4, "Warn, degrade confidence"),
}


@query(
    "freshness_tiers",
    "DQ-07",
    """SELECT event_id, event_type, age_hours, CASE
        WHEN event_type = 'purchase' AND age_hours > 0 THEN 'Block scoring'
        WHEN event_type = 'view' AND age_hours > 24 THEN 'Warn, continue'
        WHEN event_type = 'click' AND age_hours > 1080 THEN 'Flag score with caveat'
        WHEN event_type = 'signup' AND age_hours > 4 THEN 'Warn, degrade confidence'
        ELSE 'OK' END AS freshness_action
    FROM (SELECT event_id, event_type,
        date_diff('hour', date_trunc('hour', ts), TIMESTAMP '2024-01-31 06:00:00') AS age_hours FROM events)""",
)
def freshness_tiers(t: Tables) -> DataFrame:
    aged = risk.feature_age(
        t.events.select("event_id", "event_type", F.col("ts").alias("feature_ts")), EVENTS_RUN
    ).select("event_id", "event_type", F.col("freshness_hours").alias("age_hours"))
    return checks.freshness_tiers(aged, "event_type", "age_hours", STALENESS)


@query(
    "feature_gating",
    "DQ-08",
    "WITH " + s.SENSORS_SQL + """
    SELECT sensor_id, sensor_quality, round(completeness, 8) AS completeness,
      CASE WHEN completeness >= 50 THEN anomaly_count END AS anomaly_count,
      sensor_quality < 60 AS low_confidence
    FROM (SELECT sensor_id, anomaly_count, round(sensor_quality_score, 4) AS sensor_quality,
        100.0 * valid_readings / expected_reading_count AS completeness FROM scored)""",
)
def feature_gating(t: Tables) -> DataFrame:
    sensors = asset.sensor_quality(s.asset_silver(t)["silver_sensors_clean"], EVENTS_RUN).select(
        "sensor_id",
        "anomaly_count",
        F.round("sensor_quality_score", 4).alias("sensor_quality"),
        rate(F.col("valid_readings"), F.col("expected_reading_count"), digits=None).alias(
            "completeness"
        ),
    )
    gated = checks.gate_features(sensors, ["anomaly_count"], "sensor_quality", "completeness")
    return p.rounded(gated, 8, "completeness")


# Monitoring

BINS_SQL = """
bins AS (
  SELECT CAST(greatest(-1, least(10, floor(value / 25.0))) AS INTEGER) AS bin,
    COUNT(*) FILTER (WHERE ts < TIMESTAMP '2024-01-16') AS b, COUNT(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-16') AS c
  FROM events GROUP BY 1),
shares AS (SELECT bin, b / SUM(b) OVER () AS bs, c / SUM(c) OVER () AS cs FROM bins),
terms AS (SELECT bin, bs, cs, cs - bs AS delta,
  (greatest(cs, 1e-6) - greatest(bs, 1e-6)) * ln(greatest(cs, 1e-6) / greatest(bs, 1e-6)) AS term FROM shares)"""


def _bins(t: Tables) -> DataFrame:
    halves = F.when(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"), "base")
    return monitor.drift_by_bin(
        t.events, halves.otherwise("current"), monitor.equal_width_bin(F.col("value"), 0.0, 250.0, 10)
    )


@query(
    "drift_psi",
    "DQ-09",
    "WITH " + BINS_SQL + """
    SELECT bin, round(bs, 6) AS base_share, round(cs, 6) AS current_share, round(delta, 6) AS share_delta,
      round(term, 6) AS psi_term FROM terms""",
)
def drift_psi(t: Tables) -> DataFrame:
    return p.rounded(_bins(t), 6, "base_share", "current_share", "share_delta", "psi_term")


@query(
    "drift_summary",
    "DQ-09",
    "WITH " + BINS_SQL + """
    SELECT round(SUM(term), 6) AS psi, round(MAX(abs(delta)), 6) AS max_share_delta,
      CAST(MAX(abs(delta)) > 0.1 AS INTEGER) AS is_drift FROM terms""",
)
def drift_summary(t: Tables) -> DataFrame:
    return p.rounded(monitor.drift_summary(_bins(t)), 6, "psi", "max_share_delta")


@query(
    "fraud_rate_shift",
    "DQ-09",
    """WITH days AS (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS n, COUNT(*) FILTER (WHERE value > 100) AS hits
         FROM events GROUP BY 1),
       pairs AS (SELECT x.day,
           100.0 * SUM(y.hits) FILTER (WHERE y.day > x.day - 7 AND y.day <= x.day)
             / SUM(y.n) FILTER (WHERE y.day > x.day - 7 AND y.day <= x.day) AS now_pct,
           100.0 * SUM(y.hits) FILTER (WHERE y.day <= x.day - 7 AND y.day > x.day - 14)
             / SUM(y.n) FILTER (WHERE y.day <= x.day - 7 AND y.day > x.day - 14) AS before_pct
         FROM days x JOIN days y ON y.day <= x.day AND y.day > x.day - 14 GROUP BY 1)
    SELECT day, round(now_pct, 8) AS rate_pct, round(before_pct, 8) AS previous_rate_pct,
      round(now_pct - before_pct, 8) AS delta_pct,
      CAST(COALESCE(abs(now_pct - before_pct) > 1, FALSE) AS INTEGER) AS is_alert FROM pairs""",
)
def fraud_rate_shift(t: Tables) -> DataFrame:
    marked = t.events.select("ts", (F.col("value") > 100).alias("is_high"))
    out = monitor.rate_shift(marked, "ts", "is_high", 7, 1.0)
    return p.rounded(out, 8, "rate_pct", "previous_rate_pct", "delta_pct")


@query(
    "metric_drop",
    "DQ-09",
    """WITH weeks AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS evaluated_on,
         round(COUNT(*) FILTER (WHERE o_orderstatus = 'O') / COUNT(*), 6) AS hit_rate FROM orders GROUP BY 1),
       steps AS (SELECT *, lag(hit_rate) OVER (ORDER BY evaluated_on) - hit_rate AS fell FROM weeks)
    SELECT evaluated_on, hit_rate, round(fell, 6) AS metric_drop,
      CAST(COALESCE(fell > 0.03, FALSE) AS INTEGER) AS is_alert FROM steps""",
)
def metric_drop(t: Tables) -> DataFrame:
    monthly = t.orders.groupBy(F.trunc("o_orderdate", "month").alias("evaluated_on")).agg(
        F.round(
            rate(F.count_if(F.col("o_orderstatus") == "O"), F.count("*"), 1.0, None), 6
        ).alias("hit_rate")
    )
    return p.rounded(
        monitor.metric_drop(monthly, "evaluated_on", "hit_rate", 0.03), 6, "metric_drop"
    )


@query(
    "alerts",
    "DQ-10",
    "WITH " + s.READINGS_SQL + """
    , figures AS (SELECT 100.0 * SUM(outlier) / COUNT(*) AS outlier_rate_pct,
        100.0 * SUM(valid) / COUNT(*) AS complete_pct,
        100.0 * (SELECT COUNT(DISTINCT user_id) FROM events) / (SELECT COUNT(*) FROM customer) AS coverage_pct,
        (SELECT 100.0 * abs(COUNT(*) - COUNT(DISTINCT c_custkey)) / COUNT(*) FROM customer) AS count_delta_pct
      FROM readings)
    SELECT 'outlier_rate_pct' AS metric, round(outlier_rate_pct, 8) AS observed, 'above 2' AS rule,
      CAST(outlier_rate_pct > 2 AS INTEGER) AS is_alert FROM figures
    UNION ALL SELECT 'complete_pct', round(complete_pct, 8), 'below 95', CAST(complete_pct < 95 AS INTEGER) FROM figures
    UNION ALL SELECT 'coverage_pct', round(coverage_pct, 8), 'below 95', CAST(coverage_pct < 95 AS INTEGER) FROM figures
    UNION ALL SELECT 'count_delta_pct', round(count_delta_pct, 8), 'above 5', CAST(count_delta_pct > 5 AS INTEGER) FROM figures""",
)
def alerts(t: Tables) -> DataFrame:
    silver = s.asset_silver(t)
    readings = silver["silver_sensors_clean"]
    quality = readings.agg(
        (F.avg("is_hard_outlier") * 100).alias("outlier_rate_pct"),
        (F.avg("dq_reading_valid") * 100).alias("complete_pct"),
    )
    seen = linkage(silver["silver_assets_clean"], readings, "asset_id", "asset_id")
    sizes = silver["silver_assets_clean"].agg(
        rate(F.count("*") - F.countDistinct("asset_id"), F.count("*"), digits=None).alias(
            "count_delta_pct"
        )
    )
    metrics = (
        monitor.metric_rows(quality, "outlier_rate_pct", "complete_pct")
        .unionByName(
            seen.select(
                F.lit("coverage_pct").alias("metric"),
                rate(F.col("linked_rows"), F.col("total_rows"), digits=None).alias("observed"),
            )
        )
        .unionByName(monitor.metric_rows(sizes, "count_delta_pct"))
    )
    rules = {
        "outlier_rate_pct": ("above", 2.0),
        "complete_pct": ("below", 95.0),
        "coverage_pct": ("below", 95.0),
        "count_delta_pct": ("above", 5.0),
    }
    return p.rounded(monitor.alerts(metrics, rules), 8, "observed")


@query(
    "exactly_one_region",
    "DQ-11",
    """SELECT o_custkey, COUNT(DISTINCT o_orderpriority) AS value_count FROM orders
       GROUP BY 1 HAVING COUNT(DISTINCT o_orderpriority) <> 1""",
)
def exactly_one_region(t: Tables) -> DataFrame:
    return monitor.exactly_one(t.orders, "o_custkey", "o_orderpriority")


@query(
    "group_rate_audit",
    "DQ-12",
    """SELECT source, COUNT(*) AS group_size, CAST(SUM(toxic) AS BIGINT) AS positives,
      round(100.0 * SUM(toxic) / COUNT(*), 6) AS rate_pct,
      round(100.0 * (SELECT SUM(toxic) FROM labels JOIN documents USING (doc_id))
        / (SELECT COUNT(*) FROM labels JOIN documents USING (doc_id)), 6) AS overall_rate_pct,
      round((100.0 * SUM(toxic) / COUNT(*)) / (100.0 * (SELECT SUM(toxic) FROM labels JOIN documents USING (doc_id))
        / (SELECT COUNT(*) FROM labels JOIN documents USING (doc_id))), 6) AS rate_ratio
    FROM labels JOIN documents USING (doc_id) GROUP BY 1""",
)
def group_rate_audit(t: Tables) -> DataFrame:
    labelled = t.labels.join(t.documents.select("doc_id", "source"), "doc_id")
    out = monitor.group_rate_audit(labelled, "source", "toxic")
    return p.rounded(out, 6, "rate_pct", "overall_rate_pct", "rate_ratio")


# Governance

POLICY = {
    "c_custkey": governance.Mask("pseudonym", salt="s1", prefix="C"),
    "c_name": governance.Mask("partial", visible=4),
    "c_mktsegment": governance.Mask("hash", salt="s2"),
    "c_acctbal": governance.Mask("drop"),
}


@query(
    "masked_customers",
    "GOV-01 FUN-08",
    """SELECT 'C' || sha256('s1' || c_custkey) AS c_custkey,
      repeat('*', length(c_name) - 4) || right(c_name, 4) AS c_name, c_nationkey,
      sha256('s2' || c_mktsegment) AS c_mktsegment FROM customer""",
)
def masked_customers(t: Tables) -> DataFrame:
    return governance.mask(t.customer, POLICY)


@query(
    "policy_view",
    "GOV-02",
    """SELECT c_custkey, repeat('*', length(c_name) - 4) || right(c_name, 4) AS c_name, c_nationkey
       FROM customer WHERE c_nationkey IN (1, 2, 3)""",
)
def policy_view(t: Tables) -> DataFrame:
    role = governance.RolePolicy(
        columns=["c_custkey", "c_name", "c_nationkey"],
        row_filter="c_nationkey IN (1, 2, 3)",
        masks={"c_name": governance.Mask("partial")},
    )
    return governance.policy_view(t.customer, role)


@query(
    "lineage_trace",
    "GOV-04",
    "WITH " + s.HCP_360_SQL + """
    SELECT hcp_id, targeting_priority, CAST(1 AS INTEGER) AS gold_found, CAST(1 AS INTEGER) AS silver_found,
      CAST(1 AS INTEGER) AS bronze_found, '20010802_060000' AS _batch_id, 'hcp_master.csv' AS _source_file
    FROM targeting""",
)
def lineage_trace(t: Tables) -> DataFrame:
    view = p._view(t)
    scores = provider.targeting_score(view, ORDERS_RUN).select("hcp_id", "targeting_priority")
    bronze = s.hcp_master(t).withColumn("hcp_id", F.col("hcp_id").cast("string"))
    chain = [
        governance.Hop("gold", view, "hcp_id"),
        governance.Hop("silver", provider.hcp_standardized(s.hcp_master(t)), "hcp_id"),
        governance.Hop("bronze", bronze, "hcp_id", ["_batch_id", "_source_file"]),
    ]
    return governance.trace(scores, "hcp_id", chain)
