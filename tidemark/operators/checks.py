"""Declarative quality checks, scorecards, contracts and feature quality."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.context import RunContext
from tidemark.functions.scoring import tier


@dataclass(frozen=True)
class Check:
    """An aggregate over one table compared with a threshold.

    ``value`` is a SQL aggregate expression, so a suite is plain data. A NULL result (empty
    table) counts as 0.
    """

    name: str
    table: str
    value: str
    threshold: float
    higher_is_better: bool = True


def row_count(name: str, table: str, threshold: float) -> Check:
    return Check(name, table, "count(*)", threshold)


def flag_pct(name: str, table: str, flag: str, threshold: float, higher: bool = True) -> Check:
    return Check(name, table, f"avg({flag}) * 100", threshold, higher)


def share_pct(name: str, table: str, condition: str, threshold: float, higher=True) -> Check:
    return Check(
        name, table, f"try_divide(count_if({condition}), count(*)) * 100", threshold, higher
    )


def violations(name: str, table: str, condition: str) -> Check:
    return Check(name, table, f"count_if({condition})", 0.0, False)


def duplicate_pct(name: str, table: str, key: str) -> Check:
    value = f"try_divide(count(*) - count(DISTINCT {key}), count(*)) * 100"
    return Check(name, table, value, 0.0, False)


def _result_columns(check: Check, value: Column) -> Column:
    observed = F.coalesce(value.cast("double"), F.lit(0.0))
    limit = F.lit(float(check.threshold))
    passed = observed >= limit if check.higher_is_better else observed <= limit
    return F.struct(
        F.lit(check.name).alias("check_name"),
        F.round(observed, 4).alias("value"),
        limit.alias("threshold"),
        passed.alias("passed"),
        F.when(passed, "PASS").otherwise("FAIL").alias("status"),
    )


def _error_row(spark: SparkSession, check: Check) -> DataFrame:
    return spark.range(1).select(
        F.lit(check.name).alias("check_name"),
        F.lit(None).cast("double").alias("value"),
        F.lit(float(check.threshold)).alias("threshold"),
        F.lit(False).alias("passed"),
        F.lit("ERROR").alias("status"),
    )


def run_suite(
    spark: SparkSession, checks: Sequence[Check], tables: Mapping[str, DataFrame]
) -> DataFrame:
    """(check_name, value, threshold, passed, status), one row per check.

    All checks on a table share one aggregation. A check that does not fit its table (missing
    table or column) becomes an ERROR row instead of stopping the suite.
    """
    parts: list[DataFrame] = []
    by_table: dict[str, list[Check]] = {}
    for check in checks:
        try:
            tables[check.table].agg(F.expr(check.value).alias("v")).schema
            by_table.setdefault(check.table, []).append(check)
        except (AnalysisException, KeyError):
            parts.append(_error_row(spark, check))
    for table, group in by_table.items():
        values = tables[table].agg(*[F.expr(c.value).alias(f"v{i}") for i, c in enumerate(group)])
        rows = F.array(*[_result_columns(c, F.col(f"v{i}")) for i, c in enumerate(group)])
        parts.append(values.select(F.inline(rows)))
    return reduce(DataFrame.unionByName, parts)


def scorecard(results: DataFrame, project: str) -> DataFrame:
    """One summary row over a suite's results (a suite has tens of checks, not rows of data)."""
    summed = results.agg(
        F.count("*").alias("total_checks"),
        F.count_if("passed").alias("passed_checks"),
        F.array_sort(F.collect_list(F.when(~F.col("passed"), F.col("check_name")))).alias("_failed"),
    )
    overall = F.round(F.try_divide(F.col("passed_checks") * 100.0, F.col("total_checks")), 1)
    return summed.withColumn("overall_score", F.coalesce(overall, F.lit(0.0))).select(
        F.lit(project).alias("project"),
        "overall_score",
        "total_checks",
        "passed_checks",
        (F.col("total_checks") - F.col("passed_checks")).alias("failed_checks"),
        tier(
            [("HEALTHY", F.col("overall_score") >= 85), ("DEGRADED", F.col("overall_score") >= 60)],
            "CRITICAL",
        ).alias("status"),
        F.col("_failed").alias("failed_check_names"),
    )


class QualityGateError(RuntimeError):
    """Raised when a gated data product is CRITICAL."""


def enforce_gate(card: DataFrame, policy: str = "warn") -> str:
    """Read the one-row scorecard's status; stop on CRITICAL when the policy is ``raise``."""
    status = card.select("status").first()["status"]
    if status == "CRITICAL" and policy == "raise":
        raise QualityGateError("quality status is CRITICAL")
    return status


@dataclass(frozen=True)
class FieldRule:
    type: str
    nullable: bool = True
    pattern: str | None = None


@dataclass(frozen=True)
class Contract:
    """The published promise of a data product."""

    name: str
    version: str
    owner: str
    fields: Mapping[str, FieldRule]
    freshness_hours: int | None = None
    completeness_pct: float | None = None
    quality_score_min: float | None = None
    forbidden: Sequence[str] = field(default_factory=tuple)


def contract_violations(
    df: DataFrame,
    contract: Contract,
    loaded_at: str | None = None,
    run: RunContext | None = None,
    quality_score: float | None = None,
) -> DataFrame:
    """(contract, field, rule, violations): every broken promise, none if all are kept.

    Schema rules are decided from the plan; all row rules share one aggregation.
    """
    spark = df.sparkSession
    types = dict(df.dtypes)
    static: list[tuple[str, str, int]] = []
    counts: list[tuple[str, str, Column]] = []
    for column, rule in contract.fields.items():
        if column not in types:
            static.append((column, "missing", 1))
            continue
        if types[column] != rule.type:
            static.append((column, "type", 1))
        if not rule.nullable:
            counts.append((column, "not_null", F.count_if(F.col(column).isNull())))
        if rule.pattern:
            bad = ~F.col(column).cast("string").rlike(rule.pattern)
            counts.append((column, "pattern", F.count_if(bad)))
        if contract.completeness_pct is not None:
            full = F.count(column) * 100.0
            short = F.coalesce(
                F.try_divide(full, F.count(F.lit(1))) < contract.completeness_pct, F.lit(False)
            )
            counts.append((column, "completeness", short.cast("long")))
    static += [(c, "forbidden", 1) for c in contract.forbidden if c in types]
    if contract.freshness_hours is not None and loaded_at and run:
        age = F.timestamp_diff("HOUR", F.max(loaded_at).cast("timestamp_ntz"), run.loaded)
        late = F.coalesce(age > contract.freshness_hours, F.lit(True))
        counts.append((loaded_at, "freshness", late.cast("long")))
    if contract.quality_score_min is not None and quality_score is not None:
        if quality_score < contract.quality_score_min:
            static.append(("*", "quality_score", 1))

    def row(column: str, rule: str, n: Column) -> Column:
        return F.struct(
            F.lit(contract.name).alias("contract"),
            F.lit(column).alias("field"),
            F.lit(rule).alias("rule"),
            n.cast("long").alias("violations"),
        )

    parts = []
    if counts:
        values = df.agg(*[value.alias(f"v{i}") for i, (_, _, value) in enumerate(counts)])
        rows = [row(c, r, F.col(f"v{i}")) for i, (c, r, _) in enumerate(counts)]
        parts.append(values.select(F.inline(F.array(*rows))))
    if static:
        rows = [row(c, r, F.lit(n)) for c, r, n in static]
        parts.append(spark.range(1).select(F.inline(F.array(*rows))))
    if not parts:
        empty = row("", "", F.lit(0))
        return spark.range(0).select(F.inline(F.array(empty)))
    return reduce(DataFrame.unionByName, parts).filter("violations > 0")


@dataclass(frozen=True)
class FeatureSpec:
    """A feature, its valid range, and the column and age limit that make it fresh."""

    name: str
    valid: str
    fresh_at: str
    max_age_hours: int


def feature_quality(df: DataFrame, specs: Sequence[FeatureSpec], run: RunContext) -> DataFrame:
    """Per feature: completeness, freshness, validity (0..1) and their product.

    Freshness and validity are shares of the rows that have a value. One aggregation.
    """

    def measures(i: int, s: FeatureSpec) -> list[Column]:
        present = F.col(s.name).isNotNull()
        age = F.timestamp_diff("HOUR", F.col(s.fresh_at).cast("timestamp_ntz"), run.now)
        return [
            F.count_if(present).alias(f"n{i}"),
            F.count_if(present & (age <= s.max_age_hours)).alias(f"f{i}"),
            F.count_if(present & F.expr(s.valid)).alias(f"v{i}"),
        ]

    totals = df.agg(
        F.count("*").alias("total"), *[m for i, s in enumerate(specs) for m in measures(i, s)]
    )

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))

    rows = [
        F.struct(
            F.lit(s.name).alias("feature"),
            share(F.col(f"n{i}"), F.col("total")).alias("completeness"),
            share(F.col(f"f{i}"), F.col(f"n{i}")).alias("freshness"),
            share(F.col(f"v{i}"), F.col(f"n{i}")).alias("validity"),
        )
        for i, s in enumerate(specs)
    ]
    return totals.select(F.inline(F.array(*rows))).withColumn(
        "feature_quality_score", F.col("completeness") * F.col("freshness") * F.col("validity")
    )


def freshness_tiers(
    df: DataFrame, feature: str, age_hours: str, limits: Mapping[str, tuple[int, str]]
) -> DataFrame:
    """Rows with the action to take when a feature is older than its limit, else ``OK``.

    ``limits`` maps a feature name to (maximum age in hours, action); it is a fixed rule list.
    """
    action = None
    for name, (limit, what) in limits.items():
        stale = (F.col(feature) == name) & (F.col(age_hours) > limit)
        action = F.when(stale, what) if action is None else action.when(stale, what)
    return df.withColumn("freshness_action", action.otherwise("OK"))


def gate_features(
    df: DataFrame,
    features: Sequence[str],
    quality: str,
    completeness: str,
    min_quality: float = 60.0,
    min_completeness: float = 50.0,
) -> DataFrame:
    """Mark rows built on poor sensors and blank features of incomplete windows."""
    enough = F.col(completeness) >= min_completeness
    gated = {f: F.when(enough, F.col(f)) for f in features}
    return df.withColumns(gated).withColumn(
        "low_confidence", F.coalesce(F.col(quality) < min_quality, F.lit(True))
    )
