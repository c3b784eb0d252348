"""Queries: point-in-time features, windows around days, labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.catalog import standins as s
from tidemark.catalog.base import EVENTS_RUN, Tables, query
from tidemark.operators.pit import pit_rolling
from tidemark.operators.timeline import Signal, attach_signals
from tidemark.plans import risk

PIT_COLUMNS = (
    "tx_count", "avg_amount", "max_amount", "total_amount", "short_tx_count", "days_since_last",
    "distinct_categories", "prior_labels",
)


def _pit_sql(until: str) -> str:
    return f"""
    SELECT t.o_orderkey AS transaction_id, COUNT(h.o_orderkey) AS tx_count,
      round(COALESCE(AVG(h.o_totalprice), 0), 6) AS avg_amount,
      round(COALESCE(MAX(h.o_totalprice), 0), 6) AS max_amount,
      round(COALESCE(SUM(h.o_totalprice), 0), 6) AS total_amount,
      COUNT(*) FILTER (WHERE h.o_orderdate >= t.o_orderdate - INTERVAL 7 DAY) AS short_tx_count,
      CAST(COALESCE(date_diff('day', MAX(h.o_orderdate), t.o_orderdate), 999) AS INTEGER) AS days_since_last,
      COUNT(DISTINCT h.o_orderstatus) AS distinct_categories,
      COUNT(*) FILTER (WHERE h.o_orderpriority = '1-URGENT') AS prior_labels
    FROM orders t LEFT JOIN orders h ON h.o_custkey = t.o_custkey AND h.o_orderkey <> t.o_orderkey
      AND h.o_orderdate >= t.o_orderdate - INTERVAL 30 DAY AND h.o_orderdate <= {until}
    GROUP BY t.o_orderkey, t.o_orderdate"""


def _pit(t: Tables, strict: bool) -> DataFrame:
    rolled = pit_rolling(
        s.orders_as_payments(t), "customer_id", "transaction_date", "transaction_id", "amount",
        "transaction_state", "is_fraud", strict=strict,
    )
    money = ("avg_amount", "max_amount", "total_amount")
    return rolled.select(
        "transaction_id",
        *[F.round(c, 6).alias(c) if c in money else c for c in PIT_COLUMNS],
    )


@query("pit_rolling_30d", "WIN-02 JOI-03 AGG-04", _pit_sql("t.o_orderdate"))
def pit_rolling_30d(t: Tables) -> DataFrame:
    return _pit(t, strict=False)


@query("pit_rolling_strict", "JOI-10 WIN-02", _pit_sql("t.o_orderdate - INTERVAL 1 DAY"))
def pit_rolling_strict(t: Tables) -> DataFrame:
    return _pit(t, strict=True)


@query(
    "device_signals_7d",
    "JOI-04",
    """SELECT CAST(t.event_id AS VARCHAR) AS transaction_id,
      COUNT(*) FILTER (WHERE e.event_type = 'signup') AS new_device_events_7d,
      COUNT(*) FILTER (WHERE e.event_type = 'error' AND e.value > 50) AS vpn_events_7d
    FROM events t LEFT JOIN events e ON e.user_id = t.user_id
      AND CAST(e.ts AS DATE) <= CAST(t.ts AS DATE) AND CAST(e.ts AS DATE) >= CAST(t.ts AS DATE) - 7
    WHERE t.event_type = 'purchase' AND t.value > 0 GROUP BY t.event_id""",
)
def device_signals_7d(t: Tables) -> DataFrame:
    tables = s.risk_silver(t)
    return risk.device_signals(
        tables["silver_transactions_clean"], tables["silver_device_events_clean"]
    ).select("transaction_id", "new_device_events_7d", "vpn_events_7d")


ASSET_DAYS_SQL = (
    "SELECT DISTINCT user_id AS asset_id, CAST(ts AS DATE) AS d FROM events"
)


def _asset_days(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("user_id").alias("asset_id"), F.to_date("ts").alias("reading_date")
    ).distinct()


@query(
    "days_since_last_event",
    "JOI-06 WIN-05",
    f"""SELECT a.asset_id, a.d AS reading_date,
      CAST(COALESCE(date_diff('day', MAX(CAST(e.ts AS DATE)), a.d), 999) AS INTEGER) AS days_since_signup
    FROM ({ASSET_DAYS_SQL}) a LEFT JOIN events e ON e.user_id = a.asset_id
      AND e.event_type = 'signup' AND CAST(e.ts AS DATE) <= a.d GROUP BY 1, 2""",
)
def days_since_last_event(t: Tables) -> DataFrame:
    signups = t.events.filter("event_type = 'signup'").select(
        F.col("user_id").alias("asset_id"), F.to_date("ts").alias("d")
    )
    signal = Signal("days_since_signup", "days_since", before=None, default=999)
    return attach_signals(
        _asset_days(t), signups, "asset_id", "reading_date", "d", [signal], one_row_per_day=True
    )


@query(
    "failure_in_next_7d",
    "JOI-05 WIN-04",
    f"""SELECT a.asset_id, a.d AS reading_date, CAST(EXISTS (SELECT 1 FROM events e
        WHERE e.user_id = a.asset_id AND e.event_type = 'error'
          AND CAST(e.ts AS DATE) >= a.d AND CAST(e.ts AS DATE) <= a.d + 7) AS INTEGER) AS failure_in_next_7d
    FROM ({ASSET_DAYS_SQL}) a""",
)
def failure_in_next_7d(t: Tables) -> DataFrame:
    signal = Signal("failure_in_next_7d", "any", after=7)
    return attach_signals(
        _asset_days(t), s.failures(t), "asset_id", "reading_date", "failure_date", [signal]
    )


@query(
    "failures_last_90d",
    "JOI-07",
    f"""SELECT a.asset_id, a.d AS reading_date, COUNT(e.event_id) AS failures_last_90d
    FROM ({ASSET_DAYS_SQL}) a LEFT JOIN events e ON e.user_id = a.asset_id AND e.event_type = 'error'
      AND CAST(e.ts AS DATE) <= a.d AND CAST(e.ts AS DATE) >= a.d - 90
    GROUP BY 1, 2""",
)
def failures_last_90d(t: Tables) -> DataFrame:
    signal = Signal("failures_last_90d", "count", before=90)
    return attach_signals(
        _asset_days(t), s.failures(t), "asset_id", "reading_date", "failure_date", [signal],
        one_row_per_day=True,
    )


RISK_SELECT = """SELECT transaction_id, customer_id, account_id, merchant_id, d AS transaction_date,
  transaction_hour, amount, is_online, is_international, transaction_state,
  n30 AS customer_tx_count_30d, round(mean30, 7) AS customer_avg_amount_30d,
  round(max30, 7) AS customer_max_amount_30d, round(sum30, 7) AS customer_total_amount_30d,
  n7 AS customer_tx_count_7d, recency AS days_since_last_tx, states30 AS distinct_states_30d,
  frauds AS prior_fraud_count, round(ratio, 8) AS amount_vs_avg_ratio, is_late_night,
  {devices} bureau_score, credit_utilization_pct, num_derogatory_marks, customer_tenure_days,
  merchant_risk_flag, is_fraud FROM features"""
ROUNDED = {
    "customer_avg_amount_30d": 7, "customer_max_amount_30d": 7, "customer_total_amount_30d": 7,
    "amount_vs_avg_ratio": 8,
}


def risk_features(t: Tables, with_devices: bool = True) -> DataFrame:
    tables = s.risk_silver(t)
    profile = risk.customer_360(tables["silver_customers_clean"], s.bureau(t), EVENTS_RUN)
    return risk.risk_features(
        tables["silver_transactions_clean"],
        tables["silver_device_events_clean"] if with_devices else None,
        profile,
        tables["silver_merchants_clean"],
        EVENTS_RUN,
    )


def _rounded(features: DataFrame) -> DataFrame:
    out = features.drop("transaction_type", "feature_ts", "_batch_id")
    return out.withColumns({c: F.round(c, d) for c, d in ROUNDED.items()})


@query(
    "txn_risk_features",
    "GLD-06 JOI-01 JOI-09",
    "WITH " + s.RISK_FEATURES_SQL
    + RISK_SELECT.format(
        devices="new_devices AS new_device_events_7d, vpns AS vpn_events_7d,"
    ),
)
def txn_risk_features(t: Tables) -> DataFrame:
    return _rounded(risk_features(t))


@query(
    "txn_risk_features_no_devices",
    "V-04",
    "WITH " + s.RISK_FEATURES_SQL + RISK_SELECT.format(devices=""),
)
def txn_risk_features_no_devices(t: Tables) -> DataFrame:
    return _rounded(risk_features(t, with_devices=False))


@query(
    "late_labels",
    "JOI-11",
    """SELECT o_orderkey AS transaction_id, CAST(o_orderdate AS DATE) AS transaction_date,
      CASE WHEN known THEN back END AS first_chargeback_date,
      CAST(known AS INTEGER) AS label_known, DATE '2000-06-30' AS label_cutoff
    FROM (SELECT *, o_orderpriority = '1-URGENT' AND back <= DATE '2000-06-30' AS known FROM (
      SELECT *, CAST(CAST(o_orderdate AS DATE) + CAST(7 + o_orderkey % 54 AS INTEGER) AS DATE) AS back FROM orders))""",
)
def late_labels(t: Tables) -> DataFrame:
    return risk.labels_asof(
        s.orders_as_payments(t).select("transaction_id", "transaction_date"),
        s.chargebacks(t),
        "2000-06-30",
    )
