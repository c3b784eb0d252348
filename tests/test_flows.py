"""Whole domain runs: files in, layers, reports and a model out."""

import warnings
from dataclasses import replace

import pytest

from helpers import one
from test_domains import ASSET_FILES, PROVIDER_FILES, RISK_FILES, RUN, write
from tidemark.catalog import Tables, features, standins
from tidemark.catalog.base import EVENTS_RUN
from tidemark.operators.checks import QualityGateError
from tidemark.plans.flows import DOMAINS, build, check, train


@pytest.mark.parametrize(
    "name,files,products",
    [("provider", PROVIDER_FILES, 4), ("risk", RISK_FILES, 3), ("asset", ASSET_FILES, 4)],
)
def test_build_and_check(spark, tmp_path, name, files, products):
    (tmp_path / "raw").mkdir()
    raw, root, domain = write(tmp_path / "raw", files), str(tmp_path / "out"), DOMAINS[name]
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        tables = build(spark, domain, raw, root, RUN)
    assert len([t for t in tables if t.startswith("gold_")]) == products
    status = check(spark, domain, tables, root, RUN)
    card = one(spark.read.json(f"{root}/reports/quality_report"))
    assert card["status"] == status and card["total_checks"] == len(domain.checks(RUN))
    assert "ERROR" not in {r.status for r in spark.read.json(f"{root}/reports/quality_results").collect()}
    if status == "CRITICAL":
        with pytest.raises(QualityGateError):
            check(spark, domain, tables, root, RUN, policy="raise")


def test_train_writes_model_and_reports(spark, sf_dir, tmp_path):
    t, root = Tables(spark, sf_dir), str(tmp_path)
    tables = {"gold_transaction_risk_features": features.risk_features(t)}
    domain = DOMAINS["risk"]
    spec = replace(domain.forest, trees=5, depth=3)
    metrics = train(spark, domain, tables, root, EVENTS_RUN, spec=spec)
    assert set(metrics) >= {"accuracy", "f1_macro", "auc_roc", "auc_pr", "test_set_size"}
    scores = spark.read.parquet(f"{root}/gold/predictions")
    assert scores.count() == standins.risk_silver(t)["silver_transactions_clean"].count()
    assert scores.filter("split = 'test'").count() == metrics["test_set_size"]
    audit = spark.read.json(f"{root}/reports/audit_rows")
    assert audit.count() == scores.count()
    assert audit.filter("size(top_risk_drivers) = 3 AND _batch_id IS NOT NULL").count() == audit.count()
    assert one(spark.read.json(f"{root}/reports/model_card"))["model_name"] == domain.model_name
