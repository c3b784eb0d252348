"""Provider targeting: practitioners, their interactions, prescriptions, support cases, sites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.context import RunContext
from tidemark.functions.flags import flag, len_flag, present_flag
from tidemark.functions.scoring import points, rate, score, tier
from tidemark.operators.aggregates import left_signals, suppress_small
from tidemark.operators.checks import (
    Check, duplicate_pct, flag_pct, row_count, share_pct,
)
from tidemark.operators.keyed import cast_project, casts, dedup_latest, require
from tidemark.sources.bronze import Keep, as_is

LINEAGE = ("_batch_id", "_load_ts")

# Weights, defaults and thresholds of the products.
TIER_POINTS = {"A": 20, "B": 15, "C": 10}
TIER_POINTS_DEFAULT = 5
KOL_POINTS = 15
POINTS_PER_RECENT_INTERACTION = 8
POINTS_PER_POSITIVE_OUTCOME = 5
NO_INTERACTION_DAYS = 999
SITE_RATING_POINTS = {"Excellent": 30, "Good": 20, "Acceptable": 10}
MIN_COHORT = 10
TIER_ORDINAL = {"A": 4, "B": 3, "C": 2, "D": 1}


# Silver


def hcp_standardized(bronze: DataFrame) -> DataFrame:
    typed = cast_project(
        require(bronze, "hcp_id"),
        casts(
            "hcp_id STRING, npi STRING, first_name STRING, last_name STRING, full_name STRING,"
            "specialty_code STRING, specialty_name STRING, specialty_tier STRING, state STRING,"
            "territory_id STRING, degree STRING, years_in_practice INT,"
            "is_kol BOOLEAN <- is_key_opinion_leader, is_investigator BOOLEAN,"
            "created_date DATE, updated_date DATE",
            npi="trim", full_name="trim", specialty_name="trim",
            first_name="upper", last_name="upper", specialty_code="upper", state="upper",
        ),
        flags={
            "dq_npi_valid": len_flag(F.col("npi"), 10),
            "dq_name_complete": present_flag(F.col("first_name")),
            "dq_specialty_present": present_flag(F.col("specialty_code"), allow_empty=True),
        },
        keep=LINEAGE,
    )
    return dedup_latest(typed, ["hcp_id"], ["_load_ts"], ["updated_date", "npi", "full_name"])


def hco_standardized(bronze: DataFrame) -> DataFrame:
    typed = cast_project(
        require(bronze, "hco_id"),
        casts(
            "hco_id STRING, hco_name STRING, hco_type STRING, state STRING, city STRING,"
            "bed_count INT, is_teaching BOOLEAN, is_nci_designated BOOLEAN, created_date DATE",
            hco_name="trim", hco_type="trim", city="trim", state="upper",
        ),
        keep=LINEAGE,
    )
    return dedup_latest(typed, ["hco_id"], ["_load_ts"], ["created_date", "hco_name", "city"])


def affiliations(bronze: DataFrame) -> DataFrame:
    return cast_project(
        require(bronze, "hcp_id", "hco_id"),
        casts(
            "affiliation_id STRING, hcp_id STRING, hco_id STRING, affiliation_type STRING,"
            "is_primary BOOLEAN, start_date DATE"
        ),
    )


def interactions_clean(bronze: DataFrame, run: RunContext) -> DataFrame:
    typed = cast_project(
        require(bronze, "hcp_id", "interaction_date"),
        casts(
            "interaction_id STRING, hcp_id STRING, rep_id STRING, product STRING,"
            "interaction_type STRING, interaction_date DATE, duration_minutes INT,"
            "outcome STRING, samples_dropped INT, source_system STRING"
        ),
    )
    not_future = F.col("interaction_date") <= run.today
    return typed.filter(not_future).withColumn("dq_date_valid", flag(not_future))


def rx_aggregates(bronze: DataFrame, bounded_share: bool = False) -> DataFrame:
    """``bounded_share`` also requires a market share between 0 and 1."""
    typed = cast_project(
        require(bronze, "hcp_id"),
        casts(
            "rx_id STRING, hcp_id STRING, product STRING, period_month INT, period_year INT,"
            "total_rx_count INT, new_patient_starts INT, market_share_pct DOUBLE,"
            "source_system STRING"
        ),
    ).filter("total_rx_count >= 0")
    return typed.filter("market_share_pct BETWEEN 0 AND 1") if bounded_share else typed


def support_by_month(bronze: DataFrame) -> DataFrame:
    """Case counts per practitioner, product, type, payer and month. Case ids and age bands
    are never projected: no single case survives this step."""
    return (
        require(bronze, "hcp_id")
        .groupBy(
            F.col("hcp_id").cast("string").alias("hcp_id"),
            "product",
            "case_type",
            "payer_type",
            F.trunc(F.col("case_date").cast("date"), "month").alias("case_month"),
        )
        .agg(
            F.count("*").alias("case_count"),
            F.avg(F.col("resolution_days").cast("double")).alias("avg_resolution_days"),
            F.sum(flag(F.col("case_status") == "Escalated")).alias("escalated_count"),
        )
    )


def trial_sites_clean(bronze: DataFrame) -> DataFrame:
    return cast_project(
        require(bronze, "site_id"),
        casts(
            "site_id STRING, hco_id STRING, trial_id STRING, activation_date DATE,"
            "enrolled_patients INT, screen_failures INT, query_rate DOUBLE,"
            "protocol_deviations INT, site_rating STRING, country STRING, pi_hcp_id STRING,"
            "is_active BOOLEAN"
        ),
    )


def current_territories(bronze: DataFrame) -> DataFrame:
    """Open territory assignments."""
    return cast_project(
        require(bronze, "hcp_id"),
        casts(
            "assignment_id STRING, hcp_id STRING, territory_id STRING, rep_id STRING,"
            "assignment_start DATE, assignment_end DATE, is_current BOOLEAN"
        ),
    ).filter("assignment_end IS NULL")


def silver(bronze: dict[str, DataFrame], run: RunContext) -> dict[str, DataFrame]:
    return {
        "silver_hcp_standardized": hcp_standardized(bronze["bronze_hcp_master"]),
        "silver_hco_standardized": hco_standardized(bronze["bronze_hco_master"]),
        "silver_hcp_hco_affiliations": affiliations(bronze["bronze_hcp_hco_affiliations"]),
        "silver_interactions_clean": interactions_clean(bronze["bronze_hcp_interactions"], run),
        "silver_rx_aggregates": rx_aggregates(bronze["bronze_rx_aggregates"]),
        "silver_patient_support_agg": support_by_month(bronze["bronze_patient_support"]),
        "silver_trial_sites_clean": trial_sites_clean(bronze["bronze_trial_sites"]),
    }


# Gold


def interaction_signals(interactions: DataFrame, run: RunContext) -> DataFrame:
    when = F.col("interaction_date")
    return (
        interactions.filter(when >= run.days_ago(365))
        .groupBy("hcp_id")
        .agg(
            F.count("*").alias("total_interactions_12m"),
            F.count_if(when >= run.days_ago(90)).alias("interactions_90d"),
            F.max(when).alias("last_interaction_date"),
            F.count_if(F.col("outcome") == "Positive").alias("positive_outcomes"),
            F.sum("samples_dropped").alias("total_samples_dropped"),
        )
    )


def rx_signals(rx: DataFrame, run: RunContext) -> DataFrame:
    return (
        rx.filter(F.col("period_year") >= run.as_of.year - 1)
        .groupBy("hcp_id")
        .agg(
            F.sum("total_rx_count").alias("total_rx_12m"),
            F.sum("new_patient_starts").alias("total_new_starts_12m"),
            F.avg("market_share_pct").alias("avg_market_share"),
        )
    )


def support_signals(support: DataFrame) -> DataFrame:
    return support.groupBy("hcp_id").agg(
        F.sum("case_count").alias("total_psp_cases"),
        F.sum("escalated_count").alias("total_psp_escalations"),
    )


def engagement_score() -> Column:
    return score(
        [
            F.col("interactions_90d") * POINTS_PER_RECENT_INTERACTION,
            F.col("positive_outcomes") * POINTS_PER_POSITIVE_OUTCOME,
            points(F.col("specialty_tier"), TIER_POINTS, TIER_POINTS_DEFAULT),
            F.when(F.col("is_kol"), KOL_POINTS).otherwise(0),
        ]
    )


def hcp_360(
    hcp: DataFrame,
    interactions: DataFrame,
    rx: DataFrame,
    support: DataFrame | None,
    run: RunContext,
) -> DataFrame:
    """One row per practitioner with twelve-month signals. Without ``support`` the case
    columns are left out."""
    signals = [
        (
            interaction_signals(interactions, run),
            {
                "total_interactions_12m": 0,
                "interactions_90d": 0,
                "last_interaction_date": None,
                "positive_outcomes": 0,
            },
        ),
        (
            rx_signals(rx, run),
            {"total_rx_12m": 0, "total_new_starts_12m": 0, "avg_market_share": 0.0},
        ),
    ]
    if support is not None:
        signals.append(
            (support_signals(support), {"total_psp_cases": 0, "total_psp_escalations": 0})
        )
    names = [c for _, defaults in signals for c in defaults]
    return (
        left_signals(hcp, "hcp_id", signals)
        .withColumn("engagement_score", engagement_score())
        .withColumn("gold_created_ts", run.loaded)
        .select(
            "hcp_id", "npi", "first_name", "last_name", "full_name", "specialty_code",
            "specialty_name", "specialty_tier", "state", "territory_id", "degree",
            "years_in_practice", "is_kol", "is_investigator", *names, "engagement_score",
            "dq_npi_valid", "dq_name_complete", "gold_created_ts", "_batch_id",
        )
    )


def targeting_score(gold_hcp_360: DataFrame, run: RunContext) -> DataFrame:
    tier_of, engaged = F.col("specialty_tier"), F.col("engagement_score")
    rx = F.col("total_rx_12m")
    priority = tier(
        [
            ("A", (tier_of == "A") & (engaged >= 60) & (rx >= 50)),
            ("B", tier_of.isin("A", "B") & (engaged >= 40)),
            ("C", (engaged >= 20) | (rx >= 20)),
        ],
        "D",
    )
    recency = F.coalesce(
        F.datediff(run.today, F.col("last_interaction_date")), F.lit(NO_INTERACTION_DAYS)
    )
    return gold_hcp_360.select(
        "hcp_id", "npi", "specialty_tier", "territory_id", "state", "total_interactions_12m",
        "interactions_90d",
        recency.alias("days_since_last_interaction"),
        "positive_outcomes", "total_rx_12m", "total_new_starts_12m",
        F.round(F.col("avg_market_share") * 100, 2).alias("market_share_pct"),
        "total_psp_cases", "engagement_score",
        F.col("is_kol").cast("int").alias("is_kol_flag"),
        F.col("is_investigator").cast("int").alias("is_investigator_flag"),
        "years_in_practice",
        priority.alias("targeting_priority"),
        run.loaded.alias("feature_ts"),
        "_batch_id",
    )


def support_summary(
    support: DataFrame, hcp: DataFrame, k: int = MIN_COHORT, weighted: bool = False
) -> DataFrame:
    """Quarterly cases per territory, product and type. Groups under ``k`` cases are not shown.

    ``avg_resolution_days`` is the plain mean of the monthly group means, or the mean weighted
    by cases.
    """
    mean = F.avg("avg_resolution_days")
    if weighted:
        weight = F.when(F.col("avg_resolution_days").isNotNull(), F.col("case_count"))
        mean = F.try_divide(F.sum(F.col("avg_resolution_days") * weight), F.sum(weight))
    out = (
        support.join(hcp.select("hcp_id", "territory_id"), "hcp_id")
        .groupBy(
            "territory_id",
            "product",
            "case_type",
            F.trunc("case_month", "quarter").alias("case_quarter"),
        )
        .agg(
            F.sum("case_count").alias("total_cases"),
            mean.alias("avg_resolution_days"),
            F.sum("escalated_count").alias("total_escalations"),
            rate(F.sum("escalated_count"), F.sum("case_count")).alias("escalation_rate_pct"),
        )
    )
    return suppress_small(out, "total_cases", k) if k else out


def site_priority(sites: DataFrame, hco: DataFrame, run: RunContext) -> DataFrame:
    enrolled, rating = F.col("enrolled_patients"), F.col("site_rating")
    return sites.join(
        hco.select("hco_id", "hco_name", "state", "is_teaching", "is_nci_designated", "_batch_id"),
        "hco_id",
    ).select(
        "site_id", "hco_id", "hco_name", "state", "trial_id", "enrolled_patients",
        "screen_failures", "query_rate", "protocol_deviations", "site_rating", "is_active",
        "is_teaching", "is_nci_designated",
        rate(enrolled, enrolled + F.col("screen_failures")).alias("enrollment_success_pct"),
        score(
            [
                enrolled * 2,
                points(rating, SITE_RATING_POINTS, 0),
                F.col("protocol_deviations") * -5,
                -F.round(F.col("query_rate") * 100),
            ]
        ).alias("site_quality_score"),
        tier(
            [
                ("HIGH", (enrolled >= 30) & rating.isin("Excellent", "Good")),
                ("MEDIUM", enrolled >= 15),
            ],
            "LOW",
        ).alias("priority_tier"),
        run.loaded.alias("gold_created_ts"),
        "_batch_id",
    )


def gold(
    tables: dict[str, DataFrame], run: RunContext, k: int = MIN_COHORT, keep: Keep = as_is
) -> dict[str, DataFrame]:
    """The four products. ``keep(df, name)`` may write a product that others read."""
    view = hcp_360(
        tables["silver_hcp_standardized"],
        tables["silver_interactions_clean"],
        tables["silver_rx_aggregates"],
        tables["silver_patient_support_agg"],
        run,
    )
    view = keep(view, "gold_hcp_360")
    return {
        "gold_hcp_360": view,
        "gold_hcp_targeting_score": targeting_score(view, run),
        "gold_patient_support_summary": support_summary(
            tables["silver_patient_support_agg"], tables["silver_hcp_standardized"], k
        ),
        "gold_trial_site_priority": site_priority(
            tables["silver_trial_sites_clean"], tables["silver_hco_standardized"], run
        ),
    }


def coverage_index(targeting: DataFrame) -> DataFrame:
    """Share of A and B practitioners per territory with an interaction in the last 90 days."""
    return (
        targeting.filter(F.col("targeting_priority").isin("A", "B"))
        .groupBy("territory_id")
        .agg(
            F.count("*").alias("priority_hcps"),
            F.count_if(F.col("interactions_90d") > 0).alias("covered_hcps"),
        )
        .withColumn("coverage_pct", rate(F.col("covered_hcps"), F.col("priority_hcps"), digits=4))
    )


def territory_summary(targeting: DataFrame) -> DataFrame:
    top = F.count_if(F.col("targeting_priority") == "A")
    return targeting.groupBy("territory_id").agg(
        F.count("hcp_id").alias("hcp_count"),
        top.alias("a_priority_count"),
        F.avg("engagement_score").alias("avg_engagement"),
        F.sum("total_rx_12m").alias("total_rx"),
        rate(top, F.count("hcp_id"), digits=1).alias("a_priority_pct"),
    )


# Quality suite. Check names and thresholds.

CHECKS = (
    row_count("bronze_hcp_master_row_count", "bronze_hcp_master", 1000),
    row_count("bronze_interactions_row_count", "bronze_hcp_interactions", 10000),
    flag_pct("silver_hcp_npi_completeness_pct", "silver_hcp_standardized", "dq_npi_valid", 95.0),
    flag_pct("silver_hcp_name_completeness_pct", "silver_hcp_standardized", "dq_name_complete", 99.0),
    flag_pct(
        "silver_hcp_specialty_completeness_pct", "silver_hcp_standardized",
        "dq_specialty_present", 98.0,
    ),
    duplicate_pct("silver_hcp_uniqueness_pct", "silver_hcp_standardized", "hcp_id"),
    flag_pct(
        "silver_interactions_valid_date_pct", "silver_interactions_clean", "dq_date_valid", 99.0
    ),
    Check(
        "silver_interactions_hcp_linkage_pct", "interactions_to_hcp", "max(linkage_pct)", 95.0
    ),
    duplicate_pct("gold_hcp_360_uniqueness", "gold_hcp_360", "hcp_id"),
    share_pct(
        "gold_hcp_360_engagement_score_range", "gold_hcp_360",
        "engagement_score < 0 OR engagement_score > 100", 0.0, higher=False,
    ),
    share_pct(
        "gold_targeting_score_priority_coverage", "gold_hcp_targeting_score",
        "targeting_priority IS NOT NULL", 100.0,
    ),
    share_pct(
        "gold_targeting_tier_distribution_a_pct", "gold_hcp_targeting_score",
        "targeting_priority = 'A'", 5.0,
    ),
    share_pct(
        "gold_trial_site_priority_completeness", "gold_trial_site_priority",
        "site_quality_score IS NOT NULL", 98.0,
    ),
    Check(
        "gold_psp_summary_territory_coverage", "gold_patient_support_summary",
        "count(DISTINCT territory_id)", 20,
    ),
)

FEATURES = (
    "total_interactions_12m", "interactions_90d", "days_since_last_interaction",
    "positive_outcomes", "total_rx_12m", "total_new_starts_12m", "market_share_pct",
    "total_psp_cases", "engagement_score", "is_kol_flag", "is_investigator_flag",
    "years_in_practice", "specialty_tier_num",
)
