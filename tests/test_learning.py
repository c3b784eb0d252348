import pytest
from pyspark.sql import functions as F

from helpers import one, rows
from tidemark.catalog import models
from tidemark.catalog.base import Tables
from tidemark.context import RunContext
from tidemark.operators import learning
from tidemark.operators.learning import ForestSpec

SPEC = ForestSpec(("x", "noise"), "y", trees=10, depth=3, min_leaf=1)


@pytest.fixture(scope="module")
def frame(spark):
    base = spark.range(200).selectExpr(
        "id", "CAST(id % 10 AS DOUBLE) AS x", "CAST((id * 7919) % 13 AS DOUBLE) AS noise",
        "CAST(id % 10 >= 7 AS INT) AS y",
    )
    return learning.split_stratified(base, "id", "y").cache()


@pytest.fixture(scope="module")
def model(frame):
    return learning.fit_forest(frame.filter("split = 'train'"), SPEC)


def test_split_has_exact_shares(frame):
    assert rows(frame.groupBy("y", "split").count()) == [
        (0, "test", 28), (0, "train", 112), (1, "test", 12), (1, "train", 48),
    ]


def test_weights_resampling_and_small_classes(spark):
    df = spark.createDataFrame([(i, "a") for i in range(7)] + [(100, "b"), (101, "b"), (102, "c")], "id int, y string")
    assert rows(learning.class_weights(df, "y"), "y", F.round("class_weight", 4)) == [
        ("a", 0.4762), ("b", 1.6667), ("c", 3.3333),
    ]
    again = learning.resample_balanced(df, "id", "y")
    assert rows(again.groupBy("y").agg(F.sum("copies"))) == [("a", 7), ("b", 7), ("c", 7)]
    assert again.count() == 10
    assert rows(learning.class_weights(again, "y", "copies"), "y", F.round("class_weight", 4)) == [
        ("a", 1.0), ("b", 1.0), ("c", 1.0),
    ]
    rare = spark.range(100_000).selectExpr("id", "id = 7 AS y")
    assert learning.resample_balanced(rare, "id", "y").filter("y").first().copies == 99_999


def test_curve_areas(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.8, 1), (0.1, 0), (None, 1)], "s double, y int")
    got = learning.curve_areas(df, "y", "s").first()
    assert got.auc_roc == 0.875 and round(got.auc_pr, 6) == round((1 + 2 / 3) / 2, 6)


def test_imputation_uses_training_rows_only(spark):
    df = spark.createDataFrame([(1.0, "train"), (3.0, "train"), (None, "test"), (100.0, "test")], "x double, split string")
    medians = learning.fit_medians(df.filter("split = 'train'"), ["x"])
    got = learning.impute(df, ["x"], medians)
    assert rows(got, "x") == [(1.0,), (100.0,), (2.0,), (3.0,)]


def test_forest_scores_and_reports(frame, model):
    test = learning.score_rows(model, frame.filter("split = 'test'"), SPEC)
    matrix = learning.confusion(test, "y", "predicted")
    overall = one(learning.overall_report(matrix))
    assert overall["test_set_size"] == 40 and overall["accuracy"] == 1.0
    assert learning.binary_areas(test, "y", "probability_positive") == {"auc_roc": 1.0, "auc_pr": 1.0}
    assert test.filter("confidence < 0.5 OR confidence > 1").count() == 0


def test_importance_finds_the_signal(frame, model):
    ranked = learning.importances(model, SPEC)
    assert list(ranked)[0] == "x"
    drops = {r.feature: r.accuracy_drop for r in learning.permutation_importance(model, frame, SPEC, "id").collect()}
    assert drops["x"] > drops["noise"] >= 0


def test_audit_rows_and_card(frame, model):
    scored = learning.score_rows(model, frame, SPEC)
    ranked = learning.importances(model, SPEC)
    audit = learning.audit_rows(scored, ranked, ["id"], "gold", "silver > gold", top=2)
    assert audit.count() == 200
    first = one(audit, id=8)
    assert first["top_risk_drivers"][0]["feature"] == "x" and first["top_risk_drivers"][0]["value"] == 8.0
    card = one(learning.model_card(frame, "m", SPEC, ranked, {"auc": 1.0}, {"use": "test"}, RunContext.of("2024-01-01")))
    assert card["features"] == ["x", "noise"] and card["metrics"]["auc"] == 1.0


def test_named_classes_and_cross_validation(spark):
    spec = ForestSpec(("x",), "y", trees=5, depth=2, min_leaf=1, classes=("A", "B", "C"))
    df = spark.range(60).selectExpr("id", "CAST(id % 6 AS DOUBLE) AS x", "CASE WHEN id % 6 < 3 THEN 'A' ELSE 'B' END AS y")
    df = df.unionByName(spark.createDataFrame([(999, 9.0, "C")], "id long, x double, y string"))
    mean, deviation = learning.cross_validate(df, spec, "id", folds=3)
    assert 0.9 <= mean <= 1.0 and deviation < 0.1
    model = learning.fit_forest(df, spec)
    scored = learning.score_rows(model, df, spec)
    assert scored.filter("predicted = y").count() >= 60


def test_forests_are_fitted_in_parts_that_do_not_hang_on_the_files(spark, monkeypatch):
    df = spark.range(3000).selectExpr(
        "id", "CAST(id * 7919 % 101 AS DOUBLE) AS x", "CAST(id * 104729 % 97 AS DOUBLE) AS noise",
        "CAST(id * 31 % 7 >= 4 AS INT) AS y", "map('id', id) AS note",
    )
    cores = spark.sparkContext.defaultParallelism
    whole = learning.dealt_rows(df.coalesce(1))
    assert whole.rdd.getNumPartitions() == cores and whole.count() == 3000
    assert min(whole.groupBy(F.spark_partition_id()).count().toPandas()["count"]) > 3000 / cores / 3
    monkeypatch.setattr(learning, "PART_ROWS", 3000 / cores / 2)
    assert learning.dealt_rows(df).rdd.getNumPartitions() == 2 * cores
    monkeypatch.undo()
    trees = [learning.fit_forest(d, SPEC).stages[-1].toDebugString.split("\n", 1)[1] for d in (df.coalesce(1), df.repartition(7))]
    assert trees[0] == trees[1]
    figures = [learning.cross_validate(d, SPEC, "id", folds=3) for d in (df.drop("note").coalesce(1), df.drop("note").repartition(7))]
    assert figures[0] == figures[1]


def test_rows_keep_their_place_in_every_tree(spark, frame):
    train = learning.with_class_weight(frame.filter("split = 'train'"), "y").cache()
    pipeline = learning.forest_pipeline(SPEC)
    forest = pipeline.getStages()[-1]
    assert forest.getCacheNodeIds()
    kept = pipeline.fit(train).stages[-1].toDebugString.split("\n", 1)[1]
    forest.setCacheNodeIds(False)
    assert pipeline.fit(train).stages[-1].toDebugString.split("\n", 1)[1] == kept


def test_areas_do_not_hang_on_how_rows_lie(spark):
    df = spark.range(6000).selectExpr(
        "CAST(id * 7919 % 6007 AS DOUBLE) / 10000 AS s", "CAST(id * 7919 % 6007 + id * 31 % 5000 > 5500 AS INT) AS y"
    )
    exact = round(learning.curve_areas(df, "y", "s").first().auc_roc, 4)
    areas = [learning.binary_areas(d, "y", "s") for d in (df.coalesce(1), df.repartition(5), df.repartition(16))]
    assert areas[0] == areas[1] == areas[2] and areas[0]["auc_roc"] == exact


def test_failure_report_scores_rows_once(spark, sf_dir, monkeypatch):
    read, areas = [], learning.binary_areas
    monkeypatch.setattr(learning, "binary_areas", lambda df, *names: read.append(df) or areas(df, *names))
    report = models.rf_failure_report(Tables(spark, sf_dir))
    for df in (read[0], report):
        assert "UDF" not in df._jdf.queryExecution().executedPlan().toString()
    assert report.agg(F.sum("support")).first()[0] == read[0].count() > 0


def test_zero_division_in_reports(spark):
    matrix = spark.createDataFrame([("a", "a", 3), ("b", "a", 1), ("a", "z", 1)], "actual string, predicted string, row_count long")
    got = {r["class"]: (r.support, r.precision, r.recall, r.f1) for r in learning.class_report(matrix).collect()}
    assert got == {"a": (4, 0.75, 0.75, 0.75), "b": (1, 0.0, 0.0, 0.0), "z": (0, 0.0, 0.0, 0.0)}
