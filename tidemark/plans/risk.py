"""Transaction risk: customers, transactions, devices, bureau data and late fraud labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.context import RunContext
from tidemark.functions.flags import between_flag, flag
from tidemark.functions.scoring import exact_mean, mean_of_flags, rate, tier
from tidemark.operators.checks import Check, duplicate_pct, row_count, share_pct, violations
from tidemark.operators.keyed import cast_project, casts, dedup_latest, require
from tidemark.operators.pit import pit_rolling
from tidemark.operators.timeline import Signal, attach_signals
from tidemark.sources.bronze import Keep, as_is

LINEAGE = ("_batch_id", "_load_ts")

# Defaults where a customer or a history is unknown.
DEFAULT_BUREAU_SCORE = 650
DEFAULT_UTILIZATION = 0.5
DEFAULT_DEROGATORY = 0
RATIO_WITHOUT_HISTORY = 1.0
DEVICE_WINDOW_DAYS = 7
HISTORY_DAYS = 30


# Silver


def customers_clean(bronze: DataFrame) -> DataFrame:
    typed = cast_project(
        require(bronze, "customer_id"),
        casts(
            "customer_id STRING, first_name STRING, last_name STRING, age INT, state STRING,"
            "income_band STRING, customer_since DATE, risk_segment STRING, email_domain STRING",
            first_name="upper", last_name="upper", state="upper",
        ),
        flags={"dq_age_valid": between_flag(F.col("age"), 18, 120)},
        keep=LINEAGE,
    )
    return dedup_latest(
        typed, ["customer_id"], ["_load_ts"], ["customer_since", "last_name", "first_name"]
    )


def transactions_clean(bronze: DataFrame, run: RunContext) -> DataFrame:
    typed = cast_project(
        require(bronze, "transaction_id"),
        casts(
            "transaction_id STRING, customer_id STRING, account_id STRING, merchant_id STRING,"
            "transaction_date DATE, transaction_hour INT, transaction_type STRING,"
            "amount DOUBLE, currency STRING, transaction_state STRING, is_online BOOLEAN,"
            "is_international BOOLEAN, is_fraud BOOLEAN, status STRING"
        ),
        keep=LINEAGE,
    )
    positive, not_future = F.col("amount") > 0, F.col("transaction_date") <= run.today
    return (
        typed.filter(positive & not_future)
        .withColumn("dq_amount_positive", flag(positive))
        .withColumn("dq_date_valid", flag(not_future))
        .withColumn("amount", F.round("amount", 2))
    )


def merchants_clean(bronze: DataFrame) -> DataFrame:
    return cast_project(
        require(bronze, "merchant_id"),
        casts(
            "merchant_id STRING, merchant_name STRING, category STRING, state STRING,"
            "is_online BOOLEAN, avg_transaction_size DOUBLE, risk_flag BOOLEAN",
            merchant_name="trim", category="trim", state="upper",
        ),
    )


def device_events_clean(bronze: DataFrame) -> DataFrame:
    return cast_project(
        require(bronze, "customer_id"),
        casts(
            "event_id STRING, customer_id STRING, event_date DATE, event_type STRING,"
            "device_type STRING, is_new_device BOOLEAN, vpn_detected BOOLEAN"
        ),
    )


def silver(bronze: dict[str, DataFrame], run: RunContext) -> dict[str, DataFrame]:
    return {
        "silver_customers_clean": customers_clean(bronze["bronze_customers"]),
        "silver_transactions_clean": transactions_clean(bronze["bronze_transactions"], run),
        "silver_merchants_clean": merchants_clean(bronze["bronze_merchants"]),
        "silver_device_events_clean": device_events_clean(bronze["bronze_device_events"]),
    }


# Gold


def customer_360(customers: DataFrame, bureau: DataFrame, run: RunContext) -> DataFrame:
    """One row per customer with the latest bureau pull, so that several pulls multiply nothing."""
    columns = [c for c in bureau.columns if c not in ("customer_id", "bureau_pull_date")]
    dated = ["bureau_pull_date"] if "bureau_pull_date" in bureau.columns else []
    latest = dedup_latest(bureau, ["customer_id"], dated, tiebreak=columns)
    return customers.join(
        latest.select(
            F.col("customer_id").cast("string").alias("customer_id"),
            "bureau_score", "num_open_accounts", "num_derogatory_marks", "total_debt_usd",
            "payment_history_pct", "credit_utilization_pct", "oldest_account_years",
        ),
        "customer_id",
        "left",
    ).select(
        "customer_id", "state", "age", "income_band", "risk_segment", "customer_since",
        F.datediff(run.today, "customer_since").alias("customer_tenure_days"),
        "bureau_score", "num_open_accounts", "num_derogatory_marks", "total_debt_usd",
        "payment_history_pct", "credit_utilization_pct", "oldest_account_years",
        run.loaded.alias("gold_created_ts"),
        "_batch_id",
    )


def device_signals(transactions: DataFrame, devices: DataFrame) -> DataFrame:
    """Transactions plus new-device and VPN events of the last week, their own day included."""
    window = {"kind": "count", "before": DEVICE_WINDOW_DAYS}
    return attach_signals(
        transactions,
        devices,
        "customer_id",
        "transaction_date",
        "event_date",
        [
            Signal("new_device_events_7d", where=F.col("event_type") == "New Device", **window),
            Signal("vpn_events_7d", where=F.col("vpn_detected"), **window),
        ],
    )


def risk_features(
    transactions: DataFrame,
    devices: DataFrame | None,
    customers_360: DataFrame,
    merchants: DataFrame,
    run: RunContext,
    strict: bool = False,
) -> DataFrame:
    """One row per transaction with features known at its day. Without ``devices`` the device
    columns are left out."""
    history = pit_rolling(
        transactions,
        "customer_id",
        "transaction_date",
        "transaction_id",
        "amount",
        "transaction_state",
        "is_fraud",
        days=HISTORY_DAYS,
        strict=strict,
    )
    enriched = history if devices is None else device_signals(history, devices)
    signals = [] if devices is None else ["new_device_events_7d", "vpn_events_7d"]
    profile = customers_360.select(
        "customer_id", "bureau_score", "credit_utilization_pct", "num_derogatory_marks",
        "customer_tenure_days",
    )
    one_per_merchant = dedup_latest(merchants.select("merchant_id", "risk_flag"), ["merchant_id"], ["risk_flag"])
    mean = F.col("avg_amount")
    ratio = F.when(mean > 0, F.col("amount") / mean).otherwise(RATIO_WITHOUT_HISTORY)
    return (
        enriched.join(profile, "customer_id", "left")
        .join(one_per_merchant, "merchant_id", "left")
        .select(
            "transaction_id", "customer_id", "account_id", "merchant_id", "transaction_date",
            "transaction_hour", "transaction_type", "amount", "is_online", "is_international",
            "transaction_state",
            F.col("tx_count").alias("customer_tx_count_30d"),
            mean.alias("customer_avg_amount_30d"),
            F.col("max_amount").alias("customer_max_amount_30d"),
            F.col("total_amount").alias("customer_total_amount_30d"),
            F.col("short_tx_count").alias("customer_tx_count_7d"),
            F.col("days_since_last").alias("days_since_last_tx"),
            F.col("distinct_categories").alias("distinct_states_30d"),
            F.col("prior_labels").alias("prior_fraud_count"),
            ratio.alias("amount_vs_avg_ratio"),
            between_flag(F.col("transaction_hour"), 0, 4).alias("is_late_night"),
            *signals,
            F.coalesce("bureau_score", F.lit(DEFAULT_BUREAU_SCORE)).alias("bureau_score"),
            F.coalesce("credit_utilization_pct", F.lit(DEFAULT_UTILIZATION)).alias(
                "credit_utilization_pct"
            ),
            F.coalesce("num_derogatory_marks", F.lit(DEFAULT_DEROGATORY)).alias(
                "num_derogatory_marks"
            ),
            "customer_tenure_days",
            F.coalesce("risk_flag", F.lit(False)).alias("merchant_risk_flag"),
            "is_fraud",
            run.loaded.alias("feature_ts"),
            "_batch_id",
        )
    )


def customer_risk_profile(features: DataFrame, run: RunContext) -> DataFrame:
    fraud = F.col("is_fraud").cast("int")
    ratio = exact_mean(F.col("amount_vs_avg_ratio"))
    states = F.max("distinct_states_30d")
    utilization = exact_mean(F.col("credit_utilization_pct"))
    strained = (utilization > 0.8) | (mean_of_flags(F.col("num_derogatory_marks")) > 2)
    return features.groupBy("customer_id").agg(
        F.count("*").alias("total_transactions"),
        F.sum(fraud).alias("confirmed_fraud_count"),
        F.round(mean_of_flags(fraud) * 100, 3).alias("fraud_rate_pct"),
        exact_mean(F.col("amount"), 6).alias("avg_transaction_amount"),
        F.max("amount").alias("max_transaction_amount"),
        F.round(ratio, 3).alias("avg_amount_deviation"),
        states.alias("max_distinct_states"),
        F.sum("new_device_events_7d").alias("total_new_device_events"),
        F.sum("vpn_events_7d").alias("total_vpn_events"),
        mean_of_flags(F.col("bureau_score")).alias("avg_bureau_score"),
        tier(
            [
                ("CONFIRMED_FRAUD", F.sum(fraud) > 0),
                ("HIGH", (ratio > 5) & (states > 3)),
                ("MEDIUM", strained),
            ],
            "LOW",
        ).alias("risk_tier"),
        run.loaded.alias("gold_created_ts"),
    )


def gold(
    tables: dict[str, DataFrame], bureau: DataFrame, run: RunContext, keep: Keep = as_is
) -> dict[str, DataFrame]:
    """The three products. ``keep(df, name)`` may write a product that others read."""
    view = customer_360(tables["silver_customers_clean"], bureau, run)
    features = risk_features(
        tables["silver_transactions_clean"],
        tables["silver_device_events_clean"],
        view,
        tables["silver_merchants_clean"],
        run,
    )
    features = keep(features, "gold_transaction_risk_features")
    return {
        "gold_customer_360": view,
        "gold_transaction_risk_features": features,
        "gold_customer_risk_profile": customer_risk_profile(features, run),
    }


def labels_asof(
    transactions: DataFrame, chargebacks: DataFrame, cutoff: str, key: str = "transaction_id"
) -> DataFrame:
    """Transactions with the fraud label as it was known on the cutoff date.

    Chargebacks come weeks later; only those received by the cutoff count. Adds
    ``label_known``, ``first_chargeback_date`` and the cutoff itself.
    """
    until = F.lit(cutoff).cast("date")
    received = (
        chargebacks.filter(F.col("chargeback_date").cast("date") <= until)
        .groupBy(key)
        .agg(F.min(F.col("chargeback_date").cast("date")).alias("first_chargeback_date"))
    )
    return (
        transactions.join(received, key, "left")
        .withColumn("label_known", flag(F.col("first_chargeback_date").isNotNull()))
        .withColumn("label_cutoff", until)
    )


def chargeback_rate(
    transactions: DataFrame, chargebacks: DataFrame, cutoff: str, per: int = 1000
) -> DataFrame:
    """Chargebacks per thousand transactions up to the cutoff: one row."""
    until = F.lit(cutoff).cast("date")
    sold = transactions.select(
        F.col("transaction_date").cast("date").alias("day"), F.lit(1).alias("sale"), F.lit(0).alias("back")
    )
    returned = chargebacks.select(
        F.col("chargeback_date").cast("date").alias("day"), F.lit(0).alias("sale"), F.lit(1).alias("back")
    )
    return (
        sold.unionByName(returned)
        .filter(F.col("day") <= until)
        .agg(
            F.coalesce(F.sum("sale"), F.lit(0)).alias("transaction_count"),
            F.coalesce(F.sum("back"), F.lit(0)).alias("chargeback_count"),
        )
        .select(
            until.alias("cutoff_date"),
            "transaction_count",
            "chargeback_count",
            rate(F.col("chargeback_count"), F.col("transaction_count"), per, 4).alias(
                "chargebacks_per_1000"
            ),
        )
    )


def feature_age(features: DataFrame, run: RunContext) -> DataFrame:
    """Hours since each feature row was computed."""
    hours = F.timestamp_diff(
        "HOUR", F.date_trunc("hour", F.col("feature_ts")), F.date_trunc("hour", run.now)
    )
    return features.withColumn("freshness_hours", hours)


# Quality suite. Check names and thresholds.


def checks(run: RunContext) -> tuple[Check, ...]:
    now = f"timestamp_ntz'{run.clock.isoformat(sep=' ')}'"
    features = "gold_transaction_risk_features"
    return (
        row_count("bronze_transactions_row_count", "bronze_transactions", 50000),
        row_count("bronze_customers_row_count", "bronze_customers", 1000),
        Check(
            "silver_transactions_amount_positive_pct", "silver_transactions_clean",
            "avg(dq_amount_positive) * 100", 99.0,
        ),
        Check(
            "silver_transactions_date_valid_pct", "silver_transactions_clean",
            "avg(dq_date_valid) * 100", 99.9,
        ),
        violations(
            "silver_transactions_no_future_dates", "silver_transactions_clean",
            f"transaction_date > date'{run.as_of.isoformat()}'",
        ),
        duplicate_pct("silver_customers_uniqueness", "silver_customers_clean", "customer_id"),
        Check(
            "silver_transactions_customer_linkage_pct", "transactions_to_customer",
            "max(linkage_pct)", 98.0,
        ),
        violations(
            "gold_features_no_future_feature_ts", features,
            f"feature_ts > {now} + INTERVAL 1 HOUR",
        ),
        violations(
            "gold_features_bureau_score_range", features,
            "bureau_score < 300 OR bureau_score > 850",
        ),
        Check(
            "gold_features_fraud_rate_realistic", features,
            "try_divide(count_if(is_fraud), count(is_fraud)) * 100", 0.5,
        ),
        row_count("gold_customer_360_completeness", "gold_customer_360", 4000),
        violations(
            "gold_features_feature_ts_recent", features,
            f"feature_ts < {now} - INTERVAL 24 HOURS",
        ),
        violations("gold_pit_no_negative_days_since_last", features, "days_since_last_tx < 0"),
        share_pct(
            "gold_risk_profile_tier_coverage", "gold_customer_risk_profile",
            "risk_tier IS NOT NULL", 100.0,
        ),
    )


FEATURES = (
    "amount", "transaction_hour", "is_online", "is_international", "customer_tx_count_30d",
    "customer_avg_amount_30d", "customer_max_amount_30d", "customer_total_amount_30d",
    "customer_tx_count_7d", "days_since_last_tx", "distinct_states_30d", "prior_fraud_count",
    "amount_vs_avg_ratio", "is_late_night", "new_device_events_7d", "vpn_events_7d",
    "bureau_score", "credit_utilization_pct", "num_derogatory_marks", "customer_tenure_days",
    "merchant_risk_flag",
)
