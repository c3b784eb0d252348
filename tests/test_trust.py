import pytest
from pyspark.sql import functions as F

from helpers import one, rows, ts
from tidemark.context import RunContext
from tidemark.functions.scoring import points, rate, score, tier
from tidemark.operators import checks, governance, monitor, reports

RUN = RunContext.of("2024-01-31", "2024-01-31 06:00:00")


def test_suite_statuses(spark):
    df = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (3, 1)], "k int, f int")
    suite = [
        checks.flag_pct("at", "t", "f", 75.0),
        checks.flag_pct("under", "t", "f", 75.1),
        checks.flag_pct("low_ok", "t", "f", 75.0, higher=False),
        checks.duplicate_pct("dup", "t", "k"),
        checks.row_count("empty", "e", 1),
        checks.share_pct("empty_share", "e", "k > 0", 0.0, higher=False),
        checks.violations("bad_column", "t", "nothing > 1"),
        checks.row_count("no_table", "missing", 1),
    ]
    got = {r.check_name: (r.value, r.status) for r in checks.run_suite(spark, suite, {"t": df, "e": df.limit(0)}).collect()}
    assert got == {
        "at": (75.0, "PASS"), "under": (75.0, "FAIL"), "low_ok": (75.0, "PASS"), "dup": (25.0, "FAIL"),
        "empty": (0.0, "FAIL"), "empty_share": (0.0, "PASS"),
        "bad_column": (None, "ERROR"), "no_table": (None, "ERROR"),
    }
    card = one(checks.scorecard(checks.run_suite(spark, suite, {"t": df, "e": df.limit(0)}), "P"))
    assert (card["overall_score"], card["status"], card["passed_checks"]) == (37.5, "CRITICAL", 3)
    assert card["failed_check_names"] == ["bad_column", "dup", "empty", "no_table", "under"]


@pytest.mark.parametrize("passed,status", [(17, "HEALTHY"), (16, "DEGRADED"), (12, "DEGRADED"), (11, "CRITICAL")])
def test_scorecard_tiers_and_gate(spark, passed, status):
    results = spark.range(20).select(
        F.concat(F.lit("c"), "id").alias("check_name"), (F.col("id") < passed).alias("passed")
    )
    card = checks.scorecard(results, "P")
    assert checks.enforce_gate(card, "warn") == status
    if status == "CRITICAL":
        with pytest.raises(checks.QualityGateError):
            checks.enforce_gate(card, "raise")


def test_suite_runs_one_aggregation_per_table(spark):
    df = spark.range(10).selectExpr("id AS k", "CAST(id % 2 AS INT) AS f")
    suite = [checks.flag_pct("a", "t", "f", 1.0), checks.row_count("b", "t", 1)]
    plan = checks.run_suite(spark, suite, {"t": df})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1


def test_contract(spark):
    df = spark.createDataFrame(
        [("0123456789", 1, ts("2024-01-29 00:00:00")), ("12", None, ts("2024-01-29 00:00:00"))],
        "npi string, n int, _load_ts timestamp_ntz",
    )
    contract = checks.Contract(
        "c", "1", "o",
        {"npi": checks.FieldRule("string", False, "^[0-9]{10}$"), "n": checks.FieldRule("int", False)},
        freshness_hours=24, completeness_pct=60.0, quality_score_min=0.9,
    )
    got = rows(checks.contract_violations(df, contract, "_load_ts", RUN, 0.5), "field", "rule", "violations")
    assert got == [
        ("*", "quality_score", 1), ("_load_ts", "freshness", 1), ("n", "completeness", 1),
        ("n", "not_null", 1), ("npi", "pattern", 1),
    ]
    kept = checks.Contract("c", "1", "o", {"npi": checks.FieldRule("string")})
    assert checks.contract_violations(df, kept).count() == 0


def test_gating_and_freshness(spark):
    df = spark.createDataFrame([(59.9, 50.0, 1.0), (60.0, 49.9, 1.0), (None, None, 1.0)], "q double, c double, f double")
    got = [(r.f, r.low_confidence) for r in checks.gate_features(df, ["f"], "q", "c").collect()]
    assert got == [(1.0, True), (None, False), (None, True)]
    ages = spark.createDataFrame([("a", 24), ("a", 25), ("b", 999)], "n string, h int")
    got = checks.freshness_tiers(ages, "n", "h", {"a": (24, "Warn")})
    assert [r.freshness_action for r in got.collect()] == ["OK", "Warn", "OK"]


def test_scores_and_tiers_at_thresholds(spark):
    df = spark.createDataFrame([(-5.0,), (0.0,), (59.0,), (60.0,), (100.5,), (None,)], "v double")
    got = df.select(
        score([F.col("v"), F.lit(0.0)], 0.0, 100.0).alias("s"),
        tier([("HIGH", F.col("v") >= 60), ("MID", F.col("v") >= 0)], "LOW").alias("t"),
    )
    assert [tuple(r) for r in got.collect()] == [
        (0.0, "LOW"), (0.0, "MID"), (59.0, "MID"), (60.0, "HIGH"), (100.0, "HIGH"), (0.0, "LOW"),
    ]
    row = spark.range(1).select(
        rate(F.lit(1), F.lit(0)).alias("z"), rate(F.lit(1), F.lit(3)).alias("r"),
        points(F.lit(None).cast("string"), {"A": 1}, 9).alias("p"),
    ).first()
    assert (row.z, row.r, row.p) == (None, 33.33, 9)


def test_masks(spark):
    df = spark.createDataFrame([("abcdef", "x", "s", 1), ("abc", None, "s", 2)], "a string, b string, c string, d int")
    got = governance.mask(df, {
        "a": governance.Mask("partial", visible=4), "b": governance.Mask("pseudonym", salt="k"),
        "c": governance.Mask("drop"),
    })
    out = got.collect()
    assert got.columns == ["a", "b", "d"]
    assert [r.a for r in out] == ["**cdef", "***"] and out[1].b is None and out[0].b.startswith("P")
    with pytest.raises(ValueError):
        governance.mask(df, {"a": governance.Mask("nonsense")})


def test_trace_reports_broken_chains(spark):
    scores = spark.createDataFrame([("a",), ("b",)], "k string")
    silver = spark.createDataFrame([("a", "b1"), ("a", "b1")], "id string, batch string")
    got = governance.trace(scores, "k", [governance.Hop("silver", silver, "id", ["batch"])])
    assert rows(got, "k", "silver_found", "batch") == [("a", 1, "b1"), ("b", 0, None)]
    assert governance.forbidden_columns(silver.withColumnRenamed("id", "SSN"), ["ssn"]) == ["ssn"]


def test_drift_and_audit(spark):
    same = spark.range(100).selectExpr("id % 2 = 0 AS base", "CAST(id % 10 AS DOUBLE) AS v")
    period = F.when(F.col("base"), "base").otherwise("current")
    shifted = monitor.drift_summary(monitor.drift_by_bin(same, period, monitor.equal_width_bin(F.col("v"), 0, 10, 5)))
    assert one(shifted)["is_drift"] == 0
    moved = same.withColumn("v", F.when(F.col("base"), 0.0).otherwise(9.0))
    assert one(monitor.drift_summary(monitor.drift_by_bin(moved, period, monitor.equal_width_bin(F.col("v"), 0, 10, 5))))["is_drift"] == 1
    people = spark.createDataFrame([("x", 1), ("x", 0), ("y", 0), ("y", 0)], "g string, l int")
    assert rows(monitor.group_rate_audit(people, "g", "l"), "g", "rate_ratio") == [("x", 2.0), ("y", 0.0)]
    assert rows(monitor.exactly_one(spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, None)], "k int, v string"), "k", "v")) == [(1, 2), (3, 0)]


def test_reports(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(10)] + [(99, None)], "k int, v double")
    assert rows(reports.histogram(df, "v", 0.0, 9.0, 3), "bin", "row_count") == [(0, 3), (1, 3), (2, 3), (3, 1)]
    assert rows(reports.histogram(df, "v", 1.0, 9.0, 2), "bin", "row_count", "bin_start") == [(-1, 1, None), (0, 4, 1.0), (1, 4, 5.0), (2, 1, 9.0)]
    assert rows(reports.top_k(df, "v", 2, "k"), "k") == [(8,), (9,)]
    plan = reports.top_k(df, "v", 2, "k")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_metric_drop_per_model(spark):
    df = spark.createDataFrame([("a", 1, 0.9), ("b", 2, 0.5), ("a", 3, 0.8), ("b", 4, 0.5)], "m string, at int, auc double")
    got = monitor.metric_drop(df, "at", "auc", 0.05, model="m")
    assert rows(got.filter("is_alert = 1"), "m", "at") == [("a", 3)]
