"""Asset maintenance: sensors, failures, work orders, health and the maintenance queue."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.context import RunContext
from tidemark.functions.flags import classify_reading, flag, ts_quality
from tidemark.functions.scoring import mean_of_flags, money_sum, points, rate, score, tier
from tidemark.operators.aggregates import left_signals, pivot_measures
from tidemark.operators.checks import Check, flag_pct, row_count, share_pct, violations
from tidemark.operators.keyed import cast_project, casts, require
from tidemark.operators.series import hour_number
from tidemark.operators.timeline import Signal, attach_signals
from tidemark.sources.bronze import Keep, as_is

LINEAGE = ("_batch_id", "_load_ts")

# Weights, defaults and thresholds of the products.
NEVER_MAINTAINED_DAYS = 999
LABEL_DAYS_AHEAD = 7
FAILURE_LOOKBACK_DAYS = 90
UNKNOWN_SENSOR_QUALITY = 50
CRITICALITY_ORDINAL = {"HIGH": 3, "MEDIUM": 2}
CRITICALITY_POINTS = {"HIGH": 40, "MEDIUM": 25}
URGENCY_POINTS = {"OVERDUE": 30, "DUE_SOON": 15}
# output column: (sensor type, daily statistic, aggregate over the day's rows)
PIVOT = {
    "avg_temp": ("temperature", "daily_avg", "avg"),
    "avg_vibration": ("vibration", "daily_avg", "avg"),
    "avg_pressure": ("pressure", "daily_avg", "avg"),
    "avg_speed": ("speed", "daily_avg", "avg"),
    "max_temp": ("temperature", "daily_max", "max"),
    "max_vibration": ("vibration", "daily_max", "max"),
    "std_temp": ("temperature", "daily_std", "avg"),
    "std_vibration": ("vibration", "daily_std", "avg"),
}


# Silver


def assets_clean(bronze: DataFrame) -> DataFrame:
    return cast_project(
        require(bronze, "asset_id"),
        casts(
            "asset_id STRING, asset_name STRING, asset_type STRING, asset_type_name STRING,"
            "production_line STRING, criticality STRING, install_date DATE, age_years DOUBLE,"
            "manufacturer STRING, expected_lifespan_years INT, maintenance_interval_days INT,"
            "is_active BOOLEAN",
            asset_name="trim", asset_type="trim", asset_type_name="trim",
        ),
        keep=LINEAGE,
    )


def readings_clean(bronze: DataFrame, run: RunContext) -> DataFrame:
    typed = cast_project(
        require(bronze, "reading_id", "reading_timestamp"),
        casts(
            "reading_id STRING, sensor_id STRING, asset_id STRING, sensor_type STRING,"
            "reading_timestamp TIMESTAMP_NTZ, reading_value DOUBLE, unit STRING,"
            "expected_min DOUBLE, expected_max DOUBLE, normal_low DOUBLE, normal_high DOUBLE"
        ),
        keep=LINEAGE,
    )
    return flag_readings(typed, run)


def flag_readings(typed: DataFrame, run: RunContext) -> DataFrame:
    ts, value = F.col("reading_timestamp"), F.col("reading_value")
    low, high = F.col("expected_min"), F.col("expected_max")
    return typed.withColumns(
        {
            "reading_hour": F.date_trunc("hour", ts).cast("timestamp_ntz"),
            **ts_quality(ts, run),
            **classify_reading(value, low, high, F.col("normal_low"), F.col("normal_high")),
            "dq_reading_valid": flag(value.between(low, high) & (ts <= run.now)),
        }
    )


def work_orders_clean(bronze: DataFrame) -> DataFrame:
    typed = cast_project(
        require(bronze, "work_order_id", "created_date"),
        casts(
            "work_order_id STRING, asset_id STRING, work_order_type STRING, created_date DATE,"
            "completed_date DATE, estimated_hours INT, actual_hours DOUBLE,"
            "technician_id STRING, priority STRING, cost_usd DOUBLE, parts_replaced STRING"
        ),
    )
    return typed.withColumn("resolution_days", F.datediff("completed_date", "created_date"))


def order_status(work_orders: DataFrame, run: RunContext, due_days: int = 30) -> DataFrame:
    """Open and overdue marks: an order without completion that is older than ``due_days``."""
    is_open = F.col("completed_date").isNull()
    age = F.datediff(run.today, "created_date")
    return work_orders.withColumn("is_open", flag(is_open)).withColumn(
        "is_overdue", flag(is_open & (age > due_days))
    )


def failures_clean(bronze: DataFrame) -> DataFrame:
    return cast_project(
        require(bronze, "failure_id"),
        casts(
            "failure_id STRING, asset_id STRING, failure_type STRING, failure_date DATE,"
            "detection_method STRING, downtime_hours DOUBLE, repair_cost_usd DOUBLE,"
            "severity STRING, root_cause STRING, was_predicted BOOLEAN"
        ),
    )


def inspections_clean(bronze: DataFrame) -> DataFrame:
    return cast_project(
        require(bronze, "inspection_id"),
        casts(
            "inspection_id STRING, asset_id STRING, inspection_date DATE, defect_count INT,"
            "pass_rate DOUBLE, production_volume INT, shift STRING, product_sku STRING"
        ),
    )


def silver(bronze: dict[str, DataFrame], run: RunContext) -> dict[str, DataFrame]:
    return {
        "silver_assets_clean": assets_clean(bronze["bronze_assets"]),
        "silver_sensors_clean": readings_clean(bronze["bronze_sensor_readings"], run),
        "silver_work_orders_clean": work_orders_clean(bronze["bronze_work_orders"]),
        "silver_failure_events_clean": failures_clean(bronze["bronze_failure_events"]),
        "silver_quality_clean": inspections_clean(bronze["bronze_quality_inspections"]),
    }


# Gold


def sensor_quality(readings: DataFrame, run: RunContext) -> DataFrame:
    valid = mean_of_flags(F.col("dq_reading_valid"))
    outlier = mean_of_flags(F.col("is_hard_outlier"))
    anomaly = mean_of_flags(F.col("is_anomaly"))
    first, last = F.min("reading_timestamp"), F.max("reading_timestamp")
    return readings.groupBy("sensor_id", "asset_id", "sensor_type").agg(
        F.count("*").alias("total_readings"),
        F.sum("dq_reading_valid").alias("valid_readings"),
        F.round(valid * 100, 2).alias("validity_rate_pct"),
        F.sum("is_hard_outlier").alias("hard_outlier_count"),
        F.round(outlier * 100, 2).alias("outlier_rate_pct"),
        F.sum("is_anomaly").alias("anomaly_count"),
        F.round(anomaly * 100, 2).alias("anomaly_rate_pct"),
        first.alias("first_reading_ts"),
        last.alias("last_reading_ts"),
        (hour_number(last) - hour_number(first) + 1).alias("expected_reading_count"),
        score(
            [
                valid * 60,
                (F.lit(1) - outlier) * 25,
                (F.lit(1) - F.least(F.lit(1), anomaly * 5)) * 15,
            ]
        ).alias("sensor_quality_score"),
        run.loaded.alias("gold_created_ts"),
        *([F.max("_batch_id").alias("_batch_id")] if "_batch_id" in readings.columns else []),
    )


def daily_sensor_stats(readings: DataFrame) -> DataFrame:
    is_valid = F.col("dq_reading_valid") == 1
    value = F.when(is_valid, F.col("reading_value"))
    return readings.groupBy(
        "asset_id", F.col("reading_timestamp").cast("date").alias("reading_date"), "sensor_type"
    ).agg(
        F.avg(value).alias("daily_avg"),
        F.max(value).alias("daily_max"),
        F.min(value).alias("daily_min"),
        F.stddev(value).alias("daily_std"),
        F.count_if(is_valid).alias("valid_count"),
        F.count("*").alias("total_count"),
        F.sum("is_anomaly").alias("anomaly_count_day"),
        F.sum("is_hard_outlier").alias("outlier_count_day"),
        rate(F.count_if(is_valid), F.count("*")).alias("day_completeness_pct"),
    )


def daily_asset_features(readings: DataFrame) -> DataFrame:
    """One row per asset and day: sensor types side by side, counts, completeness."""
    return pivot_measures(
        daily_sensor_stats(readings),
        ["asset_id", "reading_date"],
        "sensor_type",
        PIVOT,
        [
            F.sum("anomaly_count_day").alias("total_anomalies_day"),
            F.sum("outlier_count_day").alias("total_outliers_day"),
            F.avg("day_completeness_pct").alias("sensor_completeness_pct"),
        ],
    )


def failure_features(
    readings: DataFrame,
    assets: DataFrame,
    failures: DataFrame,
    work_orders: DataFrame,
    run: RunContext,
) -> DataFrame:
    """Daily features per asset with the seven-day failure label; days without temperature and
    vibration are left out."""
    daily = daily_asset_features(readings).filter(
        "avg_temp IS NOT NULL OR avg_vibration IS NOT NULL"
    )
    happened = failures.select(
        "asset_id", F.col("failure_date").alias("event_day"), F.lit("failure").alias("kind")
    ).unionByName(
        work_orders.select(
            "asset_id", F.col("completed_date").alias("event_day"), F.lit("service").alias("kind")
        )
    )
    failure, service = F.col("kind") == "failure", F.col("kind") == "service"
    maintained = attach_signals(
        daily,
        happened,
        "asset_id",
        "reading_date",
        "event_day",
        [
            Signal("failure_in_next_7d", "any", after=LABEL_DAYS_AHEAD, where=failure),
            Signal(
                "days_since_last_maintenance", "days_since", before=None, where=service,
                default=NEVER_MAINTAINED_DAYS,
            ),
            Signal("failures_last_90d", "count", before=FAILURE_LOOKBACK_DAYS, where=failure),
        ],
        one_row_per_day=True,
    )
    about = assets.select(
        "asset_id", "asset_type", "age_years", "criticality", "maintenance_interval_days",
        *[c for c in ("_batch_id",) if c in assets.columns],
    )
    return (
        maintained.join(about, "asset_id", "left")
        .withColumn("criticality_num", points(F.col("criticality"), CRITICALITY_ORDINAL, 1))
        .withColumn("feature_ts", run.loaded)
    )


def asset_health(
    assets: DataFrame,
    sensors: DataFrame,
    failures: DataFrame,
    work_orders: DataFrame,
    run: RunContext,
) -> DataFrame:
    year_ago = run.days_ago(365)
    sensor_health = sensors.groupBy("asset_id").agg(
        F.avg("sensor_quality_score").alias("_quality"),
        F.avg("validity_rate_pct").alias("sensor_validity_rate"),
        F.sum("anomaly_count").alias("total_sensor_anomalies"),
    )
    broken = (
        failures.filter(F.col("failure_date") >= year_ago)
        .groupBy("asset_id")
        .agg(
            F.count("*").alias("failure_count_12m"),
            F.sum(F.col("downtime_hours").cast("double")).alias("total_downtime_hours_12m"),
            F.max("failure_date").alias("last_failure_date"),
        )
    )
    serviced = (
        work_orders.filter(F.col("created_date") >= year_ago)
        .groupBy("asset_id")
        .agg(
            F.count("*").alias("work_orders_12m"),
            money_sum(F.col("cost_usd")).alias("maintenance_cost_12m_usd"),
            F.max("completed_date").alias("last_maintenance_date"),
        )
    )
    joined = left_signals(
        assets,
        "asset_id",
        [
            (
                sensor_health,
                {"_quality": None, "sensor_validity_rate": 0.0, "total_sensor_anomalies": 0},
            ),
            (
                broken,
                {
                    "failure_count_12m": 0,
                    "total_downtime_hours_12m": 0.0,
                    "last_failure_date": None,
                },
            ),
            (
                serviced,
                {
                    "work_orders_12m": 0,
                    "maintenance_cost_12m_usd": 0.0,
                    "last_maintenance_date": None,
                },
            ),
        ],
    )

    def days_since(last: str):
        return F.datediff(run.today, F.coalesce(last, "install_date"))

    age_share = F.try_divide(
        F.col("age_years"), F.nullif(F.col("expected_lifespan_years"), F.lit(0)).cast("double")
    )
    health = score(
        [
            F.coalesce("_quality", F.lit(UNKNOWN_SENSOR_QUALITY)) * 0.4,
            F.greatest(F.lit(0), 100 - F.col("failure_count_12m") * 20) * 0.3,
            F.greatest(F.lit(0), 100 - age_share * 100) * 0.3,
        ]
    )
    waited = F.col("days_since_last_maintenance")
    interval = F.col("maintenance_interval_days")
    return (
        joined.withColumn("days_since_last_failure", days_since("last_failure_date"))
        .withColumn("days_since_last_maintenance", days_since("last_maintenance_date"))
        .select(
            "asset_id", "asset_name", "asset_type", "production_line", "criticality",
            "age_years", "maintenance_interval_days",
            F.coalesce("_quality", F.lit(0.0)).alias("avg_sensor_quality_score"),
            "sensor_validity_rate", "total_sensor_anomalies", "failure_count_12m",
            "total_downtime_hours_12m", "last_failure_date", "days_since_last_failure",
            "work_orders_12m", "maintenance_cost_12m_usd", "last_maintenance_date",
            "days_since_last_maintenance",
            health.alias("asset_health_score"),
            tier(
                [("OVERDUE", waited > interval), ("DUE_SOON", waited > interval * 0.8)],
                "ON_SCHEDULE",
            ).alias("maintenance_urgency"),
            run.loaded.alias("gold_created_ts"),
            *[c for c in ("_batch_id",) if c in assets.columns],
        )
    )


def maintenance_queue(health: DataFrame, run: RunContext) -> DataFrame:
    """Recommended action per asset. Order by the priority score when reading."""
    critical, urgency = F.col("criticality"), F.col("maintenance_urgency")
    worn = F.col("asset_health_score")
    priority = (
        points(critical, CRITICALITY_POINTS, 10)
        + points(urgency, URGENCY_POINTS, 0)
        + F.greatest(F.lit(0), 100 - worn) * 0.2
        + F.least(F.col("failure_count_12m") * 5, F.lit(20))
    )
    return health.select(
        "asset_id", "asset_name", "asset_type", "production_line", "criticality",
        "asset_health_score", "maintenance_urgency", "days_since_last_maintenance",
        "maintenance_interval_days", "failure_count_12m", "total_downtime_hours_12m",
        "avg_sensor_quality_score", "total_sensor_anomalies",
        F.round(priority, 1).alias("maintenance_priority_score"),
        tier(
            [
                ("EMERGENCY", (worn < 30) & (critical == "HIGH")),
                ("HIGH", (worn < 50) | (urgency == "OVERDUE")),
                ("MEDIUM", urgency == "DUE_SOON"),
            ],
            "LOW",
        ).alias("recommended_action_tier"),
        run.loaded.alias("gold_created_ts"),
        *[c for c in ("_batch_id",) if c in health.columns],
    )


def gold(
    tables: dict[str, DataFrame], run: RunContext, keep: Keep = as_is
) -> dict[str, DataFrame]:
    """The four products. ``keep(df, name)`` may write a product that others read."""
    quality = sensor_quality(tables["silver_sensors_clean"], run)
    sensors = keep(quality, "gold_sensor_quality_score")
    health = asset_health(
        tables["silver_assets_clean"],
        sensors,
        tables["silver_failure_events_clean"],
        tables["silver_work_orders_clean"],
        run,
    )
    health = keep(health, "gold_asset_health_summary")
    return {
        "gold_sensor_quality_score": sensors,
        "gold_failure_prediction_features": failure_features(
            tables["silver_sensors_clean"],
            tables["silver_assets_clean"],
            tables["silver_failure_events_clean"],
            tables["silver_work_orders_clean"],
            run,
        ),
        "gold_asset_health_summary": health,
        "gold_maintenance_recommendations": maintenance_queue(health, run),
    }


def missingness(sensors: DataFrame) -> DataFrame:
    """Share of expected readings that did not arrive as valid readings; negative when a
    sensor sends more than one valid reading an hour."""
    expected = F.col("expected_reading_count")
    return sensors.select(
        "sensor_id",
        "expected_reading_count",
        "valid_readings",
        rate(expected - F.col("valid_readings"), expected, digits=4).alias("missingness_pct"),
    )


def mtbf(assets: DataFrame, failures: DataFrame, run: RunContext) -> DataFrame:
    """Operating hours (install date to run date) per failure; NULL without failures."""
    counted = failures.groupBy("asset_id").agg(F.count("*").alias("failure_count"))
    hours = F.datediff(run.today, "install_date") * 24
    return left_signals(
        assets.select("asset_id", "install_date"), "asset_id", [(counted, {"failure_count": 0})]
    ).select(
        "asset_id",
        "failure_count",
        hours.alias("operating_hours"),
        F.round(
            F.try_divide(hours.cast("double"), F.nullif(F.col("failure_count"), F.lit(0))), 4
        ).alias("mtbf_hours"),
    )


def anomalies_per_day(readings: DataFrame) -> DataFrame:
    return readings.groupBy(
        "asset_id", F.col("reading_timestamp").cast("date").alias("reading_date")
    ).agg(F.sum("is_anomaly").alias("anomaly_count"))


# Quality suite. Check names and thresholds.


def checks(run: RunContext) -> tuple[Check, ...]:
    sensors, features = "silver_sensors_clean", "gold_failure_prediction_features"
    now = f"timestamp_ntz'{run.clock.isoformat(sep=' ')}'"
    return (
        flag_pct("sensor_timestamp_not_future_pct", sensors, "dq_timestamp_not_future", 99.0),
        flag_pct("sensor_timestamp_not_ancient_pct", sensors, "dq_timestamp_not_ancient", 99.0),
        flag_pct("sensor_value_in_range_pct", sensors, "dq_value_in_range", 95.0),
        flag_pct("sensor_hard_outlier_rate_pct", sensors, "is_hard_outlier", 2.0, higher=False),
        flag_pct("sensor_anomaly_rate_pct", sensors, "is_anomaly", 20.0, higher=False),
        row_count("gold_sensor_quality_score_coverage", "gold_sensor_quality_score", 50),
        Check(
            "gold_sensor_min_quality_score_avg", "gold_sensor_quality_score",
            "avg(sensor_quality_score)", 60.0,
        ),
        row_count("gold_asset_health_all_assets", "gold_asset_health_summary", 50),
        violations(
            "gold_asset_health_score_range", "gold_asset_health_summary",
            "asset_health_score < 0 OR asset_health_score > 100",
        ),
        share_pct(
            "gold_features_failure_label_coverage", features, "failure_in_next_7d IS NOT NULL",
            99.0,
        ),
        share_pct("gold_features_avg_temp_completeness", features, "avg_temp IS NOT NULL", 70.0),
        row_count(
            "gold_maintenance_recommendations_coverage", "gold_maintenance_recommendations", 50
        ),
        violations(
            "gold_features_recent_feature_ts", features,
            f"feature_ts < {now} - INTERVAL 24 HOURS",
        ),
    )


FEATURES = (
    "avg_temp", "avg_vibration", "avg_pressure", "avg_speed", "max_temp", "max_vibration",
    "std_temp", "std_vibration", "total_anomalies_day", "total_outliers_day",
    "sensor_completeness_pct", "age_years", "criticality_num", "maintenance_interval_days",
    "days_since_last_maintenance", "failures_last_90d",
)
