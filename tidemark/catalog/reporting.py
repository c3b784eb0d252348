"""Queries: KPIs and report aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.catalog import products as p, standins as s
from tidemark.catalog.base import EVENTS_RUN, ORDERS_RUN, Tables, query
from tidemark.functions.scoring import mean_of_flags, money_sum, rate
from tidemark.operators import ranking, reports
from tidemark.plans import asset, provider, risk


def _targeting(t: Tables) -> DataFrame:
    return provider.targeting_score(p._view(t), ORDERS_RUN)


# KPIs


@query(
    "kpi_coverage",
    "KPI-01",
    "WITH " + s.HCP_360_SQL + """
    SELECT territory_id, COUNT(*) AS priority_hcps, COUNT(*) FILTER (WHERE interactions_90d > 0) AS covered_hcps,
      round(100.0 * COUNT(*) FILTER (WHERE interactions_90d > 0) / COUNT(*), 4) AS coverage_pct
    FROM targeting WHERE targeting_priority IN ('A', 'B') GROUP BY 1""",
)
def kpi_coverage(t: Tables) -> DataFrame:
    return provider.coverage_index(_targeting(t))


@query(
    "kpi_chargeback_rate",
    "KPI-02",
    """SELECT DATE '2000-06-30' AS cutoff_date,
      COUNT(*) FILTER (WHERE o_orderdate <= DATE '2000-06-30') AS transaction_count,
      COUNT(*) FILTER (WHERE hit) AS chargeback_count,
      round(1000.0 * COUNT(*) FILTER (WHERE hit) / COUNT(*) FILTER (WHERE o_orderdate <= DATE '2000-06-30'), 4)
        AS chargebacks_per_1000
    FROM (SELECT *, o_orderpriority = '1-URGENT'
      AND CAST(o_orderdate AS DATE) + CAST(7 + o_orderkey % 54 AS INTEGER) <= DATE '2000-06-30' AS hit FROM orders)""",
)
def kpi_chargeback_rate(t: Tables) -> DataFrame:
    return risk.chargeback_rate(s.orders_as_payments(t), s.chargebacks(t), "2000-06-30")


@query(
    "kpi_missingness",
    "KPI-03",
    "WITH " + s.SENSORS_SQL + """
    SELECT sensor_id, expected_reading_count, valid_readings,
      round(100.0 * (expected_reading_count - valid_readings) / expected_reading_count, 4) AS missingness_pct
    FROM sensors""",
)
def kpi_missingness(t: Tables) -> DataFrame:
    return asset.missingness(
        asset.sensor_quality(s.asset_silver(t)["silver_sensors_clean"], EVENTS_RUN)
    )


@query(
    "kpi_mtbf",
    "KPI-04",
    "WITH " + s.ASSETS_SQL + """
    SELECT asset_id, n AS failure_count, CAST(hours AS INTEGER) AS operating_hours,
      round(CAST(hours AS DOUBLE) / nullif(n, 0), 4) AS mtbf_hours
    FROM (SELECT asset_id, COUNT(failure_date) AS n,
            24 * date_diff('day', install_date, DATE '2024-01-31') AS hours
          FROM assets LEFT JOIN failures USING (asset_id) GROUP BY asset_id, install_date)""",
)
def kpi_mtbf(t: Tables) -> DataFrame:
    tables = s.asset_silver(t)
    return asset.mtbf(
        tables["silver_assets_clean"], tables["silver_failure_events_clean"], EVENTS_RUN
    )


@query(
    "kpi_freshness",
    "KPI-05 FUN-02",
    """SELECT event_id, date_diff('hour', date_trunc('hour', ts), TIMESTAMP '2024-01-31 06:00:00') AS freshness_hours
       FROM events""",
)
def kpi_freshness(t: Tables) -> DataFrame:
    stamped = t.events.select("event_id", F.col("ts").alias("feature_ts"))
    return risk.feature_age(stamped, EVENTS_RUN).drop("feature_ts")


@query(
    "anomalies_per_day",
    "KPI-06",
    "WITH " + s.READINGS_SQL + """
    SELECT asset_id, CAST(ts AS DATE) AS reading_date, CAST(SUM(anomaly) AS BIGINT) AS anomaly_count
    FROM readings GROUP BY 1, 2""",
)
def anomalies_per_day(t: Tables) -> DataFrame:
    return asset.anomalies_per_day(s.asset_silver(t)["silver_sensors_clean"])


# Report aggregates


@query(
    "category_share",
    "AGG-14",
    "WITH " + p.QUEUE_SQL + """
    SELECT maintenance_urgency, COUNT(*) AS row_count,
      round(100.0 * COUNT(*) / (SELECT COUNT(*) FROM queue), 4) AS share_pct FROM queue GROUP BY 1""",
)
def category_share(t: Tables) -> DataFrame:
    return reports.category_share(p.asset_health(t), "maintenance_urgency")


@query(
    "histogram",
    "AGG-15",
    """SELECT CAST(least(50, greatest(-1, floor(o_totalprice / 10000.0))) AS INTEGER) AS bin,
      o_orderstatus, COUNT(*) AS row_count,
      CASE WHEN o_totalprice >= 0 THEN 10000.0::DOUBLE * CAST(least(50, floor(o_totalprice / 10000.0)) AS INTEGER) END AS bin_start
    FROM orders GROUP BY ALL""",
)
def histogram(t: Tables) -> DataFrame:
    return reports.histogram(t.orders, "o_totalprice", 0.0, 500000.0, 50, "o_orderstatus")


@query(
    "hour_label_counts",
    "AGG-13",
    """SELECT CAST(hour(ts) AS INTEGER) AS transaction_hour, value > 200 AS is_fraud, COUNT(*) AS row_count
       FROM events WHERE event_type = 'purchase' AND value > 0 GROUP BY ALL""",
)
def hour_label_counts(t: Tables) -> DataFrame:
    payments = s.risk_silver(t)["silver_transactions_clean"]
    return reports.grouped_counts(payments, "transaction_hour", "is_fraud")


@query(
    "territory_summary",
    "AGG-16",
    "WITH " + s.HCP_360_SQL + """
    SELECT territory_id, COUNT(*) AS hcp_count, COUNT(*) FILTER (WHERE targeting_priority = 'A') AS a_priority_count,
      round(AVG(engagement_score), 8) AS avg_engagement, CAST(SUM(total_rx_12m) AS BIGINT) AS total_rx,
      round(100.0 * COUNT(*) FILTER (WHERE targeting_priority = 'A') / COUNT(*), 1) AS a_priority_pct
    FROM targeting GROUP BY 1""",
)
def territory_summary(t: Tables) -> DataFrame:
    return p.rounded(provider.territory_summary(_targeting(t)), 8, "avg_engagement")


@query(
    "kpi_header",
    "AGG-17",
    "WITH " + s.HCP_360_SQL + """
    SELECT COUNT(*) AS total_hcps, COUNT(*) FILTER (WHERE targeting_priority = 'A') AS priority_a,
      round(AVG(engagement_score), 8) AS avg_engagement,
      COUNT(*) FILTER (WHERE days_since_last_interaction <= 90) AS recently_active FROM targeting""",
)
def kpi_header(t: Tables) -> DataFrame:
    return reports.kpi_header(
        _targeting(t),
        total_hcps=F.count("*"),
        priority_a=F.count_if(F.col("targeting_priority") == "A"),
        avg_engagement=F.round(F.avg("engagement_score"), 8),
        recently_active=F.count_if(F.col("days_since_last_interaction") <= 90),
    )


@query(
    "kpi_header_fraud",
    "AGG-17 KPI-06",
    """SELECT COUNT(*) AS total_transactions, COUNT(*) FILTER (WHERE value > 200) AS fraud_transactions,
      round(100.0 * COUNT(*) FILTER (WHERE value > 200) / COUNT(*), 4) AS fraud_rate_pct,
      round(CAST(SUM(CAST(value AS DECIMAL(18, 2))) FILTER (WHERE value > 200) AS DOUBLE)
        / COUNT(*) FILTER (WHERE value > 200), 7) AS avg_fraud_amount
    FROM events WHERE event_type = 'purchase' AND value > 0""",
)
def kpi_header_fraud(t: Tables) -> DataFrame:
    fraud = F.col("is_fraud")
    flag = fraud.cast("int")
    total = money_sum(F.when(fraud, F.col("amount")))
    return reports.kpi_header(
        s.risk_silver(t)["silver_transactions_clean"],
        total_transactions=F.count("*"),
        fraud_transactions=F.count_if(fraud),
        fraud_rate_pct=F.round(mean_of_flags(flag) * 100, 4),
        avg_fraud_amount=rate(total, F.count_if(fraud), 1.0, 7),
    )


@query(
    "kpi_header_assets",
    "AGG-17",
    "WITH " + p.QUEUE_SQL + """
    SELECT COUNT(*) AS total_assets, round(AVG(asset_health_score), 8) AS avg_health,
      COUNT(*) FILTER (WHERE maintenance_urgency = 'OVERDUE') AS overdue,
      COUNT(*) FILTER (WHERE criticality = 'HIGH') AS high_criticality,
      COUNT(*) FILTER (WHERE recommended_action_tier = 'EMERGENCY') AS emergencies FROM queue""",
)
def kpi_header_assets(t: Tables) -> DataFrame:
    return reports.kpi_header(
        asset.maintenance_queue(p.asset_health(t), EVENTS_RUN),
        total_assets=F.count("*"),
        avg_health=F.round(F.avg("asset_health_score"), 8),
        overdue=F.count_if(F.col("maintenance_urgency") == "OVERDUE"),
        high_criticality=F.count_if(F.col("criticality") == "HIGH"),
        emergencies=F.count_if(F.col("recommended_action_tier") == "EMERGENCY"),
    )


@query(
    "top_k",
    "TOP-03 TOP-01",
    "WITH " + p.RISK_PROFILE_SQL + """
    SELECT customer_id, total_transactions, confirmed_fraud_count, fraud_rate_pct, risk_tier FROM profile
    WHERE risk_tier IN ('HIGH', 'CONFIRMED_FRAUD') ORDER BY fraud_rate_pct DESC, customer_id LIMIT 25""",
)
def top_k(t: Tables) -> DataFrame:
    high = F.col("risk_tier").isin("HIGH", "CONFIRMED_FRAUD")
    return reports.top_k(p.risk_profile(t), "fraud_rate_pct", 25, "customer_id", high).select(
        "customer_id", "total_transactions", "confirmed_fraud_count", "fraud_rate_pct", "risk_tier"
    )


@query(
    "first_rows",
    "TOP-02",
    """SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 500""",
)
def first_rows(t: Tables) -> DataFrame:
    slim = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    return reports.top_k(slim, "o_orderdate", 500, "o_orderkey")


@query(
    "low_scorers",
    "TOP-04",
    "WITH " + s.HEALTH_SQL + """
    SELECT asset_id, asset_name, criticality, round(asset_health_score, 8) AS asset_health_score,
      maintenance_urgency FROM health WHERE asset_health_score < 50""",
)
def low_scorers(t: Tables) -> DataFrame:
    columns = [
        "asset_id", "asset_name", "criticality", "asset_health_score", "maintenance_urgency",
    ]
    low = reports.below(p.asset_health(t), "asset_health_score", 50, columns)
    return p.rounded(low, 8, "asset_health_score")


@query(
    "hash_sample",
    "TOP-05",
    """SELECT event_id, event_type, value FROM events
       ORDER BY md5(CAST(event_id AS VARCHAR)), event_id LIMIT 500""",
)
def hash_sample(t: Tables) -> DataFrame:
    return ranking.hash_sample(t.events.select("event_id", "event_type", "value"), "event_id", 500)


@query(
    "entity_lookup",
    "TOP-06",
    """SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer WHERE c_custkey = 42""",
)
def entity_lookup(t: Tables) -> DataFrame:
    return reports.lookup(t.customer, "c_custkey", 42).drop("c_nationkey")
