"""End-to-end runs of a domain: build the layers, check them, train and evaluate its model."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.context import RunContext
from tidemark.functions.scoring import points
from tidemark.operators import checks as quality, learning
from tidemark.operators.aggregates import linkage
from tidemark.operators.learning import ForestSpec
from tidemark.operators.quarantine import Parent
from tidemark.plans import asset, provider, risk
from tidemark.plans.refresh import DAY, Calendar, Lake, Reach, keep_rejects
from tidemark.sources import bronze
from tidemark.sources.extracts import ASSET, PROVIDER, RISK, SourceSpec
from tidemark.sources.snapshots import SnapshotTable

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Link:
    """A linkage figure the suite reads: share of ``facts`` whose key is known in ``dim``."""

    name: str
    facts: str
    dim: str
    key: str


@dataclass(frozen=True)
class Domain:
    name: str
    sources: Sequence[SourceSpec]
    silver: Callable[[Tables, RunContext], dict[str, DataFrame]]
    gold: Callable[[Tables, RunContext, bronze.Keep], dict[str, DataFrame]]
    checks: Callable[[RunContext], Sequence[quality.Check]]
    links: Sequence[Link]
    model_name: str
    forest: ForestSpec
    identifier: str
    frame: Callable[[Tables, ForestSpec], DataFrame]
    feature_table: str
    fill: str = "zero"
    oversample: bool = False
    calendar: Calendar = Calendar({})
    parents: Sequence[Link] = ()


def _provider_frame(tables: Tables, spec: ForestSpec) -> DataFrame:
    ordinal = points(F.col("specialty_tier"), provider.TIER_ORDINAL, 1)
    rows = tables["gold_hcp_targeting_score"].withColumn("specialty_tier_num", ordinal)
    return learning.assemble(rows, spec.features, spec.label, keep=["hcp_id", "_batch_id"])


def _risk_frame(tables: Tables, spec: ForestSpec) -> DataFrame:
    frame = learning.assemble(
        tables["gold_transaction_risk_features"], spec.features, spec.label,
        keep=["transaction_id", "customer_id", "_batch_id", "feature_ts"],
    )
    return frame.withColumn(spec.label, F.col(spec.label).cast("int"))


def _asset_frame(tables: Tables, spec: ForestSpec) -> DataFrame:
    rows = tables["gold_failure_prediction_features"].withColumn(
        "row_id", F.concat_ws("@", "asset_id", F.col("reading_date").cast("string"))
    )
    keep = ["row_id", "asset_id", "reading_date", "_batch_id"]
    return learning.assemble(rows, spec.features, spec.label, keep=keep, fill=None)


# Rules that the silver tables apply to a received row; what breaks one is kept in the quarantine.
def _rules(run: RunContext) -> dict[str, dict[str, str]]:
    today = f"date'{run.as_of.isoformat()}'"
    present = lambda *keys: {f"{k}_present": f"{k} IS NOT NULL" for k in keys}
    not_future = lambda day: {f"{day}_not_future": f"try_cast({day} AS DATE) <= {today}"}
    return {
        "bronze_hcp_master": present("hcp_id"),
        "bronze_hco_master": present("hco_id"),
        "bronze_hcp_hco_affiliations": present("hcp_id", "hco_id"),
        "bronze_hcp_interactions": present("hcp_id", "interaction_date") | not_future("interaction_date"),
        "bronze_rx_aggregates": present("hcp_id") | {"total_rx_count_not_negative": "total_rx_count >= 0"},
        "bronze_patient_support": present("hcp_id"),
        "bronze_trial_sites": present("site_id"),
        "bronze_customers": present("customer_id"),
        "bronze_transactions": present("transaction_id")
        | {"amount_positive": "amount > 0"}
        | not_future("transaction_date"),
        "bronze_merchants": present("merchant_id"),
        "bronze_device_events": present("customer_id"),
        "bronze_assets": present("asset_id"),
        "bronze_sensor_readings": present("reading_id", "reading_timestamp"),
        "bronze_work_orders": present("work_order_id", "created_date"),
        "bronze_failure_events": present("failure_id"),
        "bronze_quality_inspections": present("inspection_id"),
    }


# Tables of events by day and what a day of a product reads.
PROVIDER_DAYS = Calendar(
    day={"bronze_hcp_interactions": "interaction_date", "silver_interactions_clean": "interaction_date"},
    reads={"silver_interactions_clean": {"bronze_hcp_interactions": Reach()}},
)
RISK_DAYS = Calendar(
    day={
        "bronze_transactions": "transaction_date", "silver_transactions_clean": "transaction_date",
        "bronze_device_events": "event_date", "silver_device_events_clean": "event_date",
        "gold_transaction_risk_features": "transaction_date",
    },
    reads={
        "silver_transactions_clean": {"bronze_transactions": Reach()},
        "silver_device_events_clean": {"bronze_device_events": Reach()},
        "gold_transaction_risk_features": {
            "silver_transactions_clean": Reach(back=risk.HISTORY_DAYS),
            "silver_device_events_clean": Reach(back=risk.DEVICE_WINDOW_DAYS),
        },
    },
    keyed={
        "gold_transaction_risk_features": {
            "silver_customers_clean": "customer_id", "bronze_bureau_attrs": "customer_id",
            "silver_merchants_clean": "merchant_id",
        }
    },
)
ASSET_DAYS = Calendar(
    day={
        "bronze_sensor_readings": "reading_timestamp", "silver_sensors_clean": "reading_timestamp",
        "gold_failure_prediction_features": "reading_date",
    },
    reads={
        "silver_sensors_clean": {"bronze_sensor_readings": Reach()},
        "gold_failure_prediction_features": {"silver_sensors_clean": Reach()},
    },
    keyed={
        # A failure or service can be seen from any day of its asset, so the asset's days are touched.
        "gold_failure_prediction_features": {
            "silver_assets_clean": "asset_id", "silver_failure_events_clean": "asset_id",
            "silver_work_orders_clean": "asset_id",
        }
    },
)

# Model names, trees, depth and smallest leaf.
DOMAINS = {
    "provider": Domain(
        "Provider",
        PROVIDER,
        provider.silver,
        lambda t, run, keep: provider.gold(t, run, keep=keep),
        lambda run: provider.CHECKS,
        (Link("interactions_to_hcp", "silver_interactions_clean", "silver_hcp_standardized", "hcp_id"),),
        "HCP Targeting Priority Classifier",
        ForestSpec(
            provider.FEATURES, "targeting_priority", 200, 8, 5, classes=("A", "B", "C", "D")
        ),
        "hcp_id",
        _provider_frame,
        "gold_hcp_targeting_score",
        calendar=PROVIDER_DAYS,
        parents=(Link("unknown_hcp", "bronze_hcp_interactions", "bronze_hcp_master", "hcp_id"),),
    ),
    "risk": Domain(
        "Risk",
        RISK,
        risk.silver,
        lambda t, run, keep: risk.gold(t, t["bronze_bureau_attrs"], run, keep=keep),
        risk.checks,
        (
            Link(
                "transactions_to_customer", "silver_transactions_clean", "silver_customers_clean",
                "customer_id",
            ),
        ),
        "Fraud Detection Classifier",
        ForestSpec(risk.FEATURES, "is_fraud", 300, 10, 3),
        "transaction_id",
        _risk_frame,
        "gold_transaction_risk_features",
        oversample=True,
        calendar=RISK_DAYS,
        parents=(Link("unknown_customer", "bronze_transactions", "bronze_customers", "customer_id"),),
    ),
    "asset": Domain(
        "Asset",
        ASSET,
        asset.silver,
        lambda t, run, keep: asset.gold(t, run, keep=keep),
        asset.checks,
        (),
        "Equipment Failure Prediction Model",
        ForestSpec(asset.FEATURES, "failure_in_next_7d", 200, 8, 5),
        "row_id",
        _asset_frame,
        "gold_failure_prediction_features",
        fill="median",
        calendar=ASSET_DAYS,
        parents=(Link("unknown_asset", "bronze_sensor_readings", "bronze_assets", "asset_id"),),
    ),
}


def build(
    spark: SparkSession, domain: Domain, raw: str, root: str, run: RunContext
) -> dict[str, DataFrame]:
    """Whole extracts to bronze, silver and gold: every table gets a new version made from nothing else."""
    return refresh(spark, domain, raw, root, run, full=True)


def refresh(
    spark: SparkSession, domain: Domain, raw: str, root: str, run: RunContext, full: bool = False,
    hold_orphans: bool = False,
) -> dict[str, DataFrame]:
    """One batch of extracts through the layers; returns all tables of the domain by name.

    Bronze keeps every batch; a batch that is loaded again replaces itself. Rows that a rule refuses go
    to the quarantine of their table, and refused rows that pass by now are taken back with it. Event
    tables are built again for the days that the batch touches, others whole. ``full`` starts from this
    batch alone and builds everything. With ``hold_orphans`` events wait in the quarantine until the
    master record that they name has arrived.
    """
    lake = Lake(spark, root, domain.calendar)
    replayed = load(lake, domain, raw, run, full, hold_orphans)
    return derive(lake, domain, run, replayed, full)


def load(
    lake: Lake, domain: Domain, raw: str, run: RunContext, full: bool = False, hold_orphans: bool = False
) -> dict[str, set]:
    """Publish a batch to bronze and settle the quarantine; returns the days of replayed rows by table."""
    batch = bronze.ingest(lake.spark, domain.sources, raw, run)
    damaged = bronze.ingest_damaged(lake.spark, domain.sources, raw, run) if batch else {}
    for name, df in batch.items():
        lake.publish_batch(name, df, run, full)
    parents: dict[str, list[Parent]] = {}
    for link in domain.parents if hold_orphans else ():
        if {link.facts, link.dim} <= set(lake.names("bronze")):
            parent = Parent(link.name, link.key, lake.read(link.dim), link.key)
            parents.setdefault(link.facts, []).append(parent)
    lake.held = parents
    days = {}
    for name, rules in _rules(run).items():
        if name in batch or (lake.table(name).latest() and not full):
            rows = lake.table(name).read().filter(F.col("_batch_id") == run.batch_id).drop(DAY)
            days[name] = keep_rejects(
                lake, name, rows, rules, run, full, parents.get(name, ()), damaged.get(name)
            )
    return days


def derive(
    lake: Lake, domain: Domain, run: RunContext, replayed: Mapping[str, set] | None = None, full: bool = False
) -> dict[str, DataFrame]:
    """Silver and gold from what bronze holds, days that are not touched left alone unless ``full``."""
    tables = {n: lake.read(n) for n in lake.names("bronze")}
    for name, df in domain.silver(tables, run).items():
        if name in domain.calendar.reads:
            extra = {d for source in domain.calendar.reads[name] for d in (replayed or {}).get(source, ())}
            _days_or_all(lake, name, tables, lambda t, n=name: domain.silver(t, run)[n], run, extra, full)
        else:
            lake.publish_whole(name, df, run)
    tables |= {n: lake.read(n) for n in lake.names("silver")}

    def keep(df: DataFrame, name: str) -> DataFrame:
        if name not in tables:
            if name in domain.calendar.reads:
                alone = lambda t: domain.gold(t, run, bronze.as_is)[name]
                _days_or_all(lake, name, tables, alone, run, (), full)
            else:
                lake.publish_whole(name, df, run)
            tables[name] = lake.read(name)
        return tables[name]

    for name, df in domain.gold(dict(tables), run, keep).items():
        keep(df, name)
    return tables


def _days_or_all(lake: Lake, name: str, tables: Tables, build, run: RunContext, replayed, full: bool) -> None:
    if full:
        sources = (*lake.calendar.reads[name], *lake.calendar.keyed.get(name, {}))
        lake.publish_whole(name, build(dict(tables)), run, sources)
    else:
        lake.refresh_days(name, tables, build, run, replayed)


def open_tables(spark: SparkSession, root: str, names: Mapping[str, str]) -> dict[str, DataFrame]:
    """Tables of an earlier build by name, as last published; ``names`` maps a table to its layer."""
    return {n: SnapshotTable(spark, f"{root.rstrip('/')}/{layer}/{n}").read().drop(DAY) for n, layer in names.items()}


def check(
    spark: SparkSession, domain: Domain, tables: Tables, root: str, run: RunContext,
    policy: str = "warn",
) -> str:
    """Run the suite, write results and scorecard as JSON, apply the gate; returns the status."""
    linked = {
        link.name: linkage(tables[link.facts], tables[link.dim], link.key, link.key)
        for link in domain.links
    }
    results = quality.run_suite(spark, domain.checks(run), {**tables, **linked})
    bronze.write_json(results, f"{root}/reports/quality_results")
    results = spark.read.schema(results.schema).json(f"{root}/reports/quality_results")
    card = quality.scorecard(results, domain.name).withColumn("report_generated_at", run.loaded)
    bronze.write_json(card, f"{root}/reports/quality_report")
    return quality.enforce_gate(card, policy)


def train(
    spark: SparkSession, domain: Domain, tables: Tables, root: str, run: RunContext,
    spec: ForestSpec | None = None, version: str = "v1.0",
) -> dict[str, float]:
    """Split, fit, score every row, evaluate the held-out rows, and write the model, the
    predictions, the evaluation, the model card and the audit rows. Returns the metrics."""
    spec = spec or domain.forest
    split = learning.split_stratified(
        domain.frame(tables, spec), domain.identifier, spec.label
    )
    bronze.write_table(split, root, "models", "split")
    frame = spark.read.parquet(f"{root}/models/split")
    if domain.fill == "median":
        medians = learning.fit_medians(frame.filter("split = 'train'"), spec.features)
        frame = learning.impute(frame, spec.features, medians)
    rows = frame.filter("split = 'train'")
    if domain.oversample:
        rows = learning.resample_balanced(rows, domain.identifier, spec.label)
    bronze.write_table(rows, root, "models", "training_rows")
    model = learning.fit_forest(spark.read.parquet(f"{root}/models/training_rows"), spec)
    model.write().overwrite().save(f"{root}/models/forest")

    scored = learning.score_rows(model, frame, spec, version)
    bronze.write_table(scored, root, "gold", "predictions")
    scored = spark.read.parquet(f"{root}/gold/predictions")
    held_out = scored.filter("split = 'test'")
    matrix = learning.confusion(held_out, spec.label, "predicted")
    bronze.write_json(matrix, f"{root}/reports/confusion")
    matrix = spark.read.schema(matrix.schema).json(f"{root}/reports/confusion")
    bronze.write_json(learning.class_report(matrix), f"{root}/reports/class_report")
    overall = learning.overall_report(matrix)
    metrics = overall.first().asDict()
    if not spec.classes:
        metrics |= learning.binary_areas(held_out, spec.label, "probability_positive")

    ranked = learning.importances(model, spec)
    bronze.write_json(
        overall.withColumns({k: F.lit(v) for k, v in metrics.items()}),
        f"{root}/reports/evaluation",
    )
    bronze.write_json(learning.importance_table(frame, ranked), f"{root}/reports/top_features")
    notes = {
        "training_data": domain.feature_table,
        "explainability": "Feature importances per model, top drivers per row",
        "auditability": "Prediction to row id to _batch_id",
    }
    card = learning.model_card(frame, domain.model_name, spec, ranked, metrics, notes, run)
    bronze.write_json(card, f"{root}/reports/model_card")
    score = "confidence" if spec.classes else "probability_positive"
    audit = learning.audit_rows(
        scored, ranked, [domain.identifier, score, "_batch_id"], domain.feature_table,
        f"bronze > silver > {domain.feature_table}",
    )
    bronze.write_json(audit, f"{root}/reports/audit_rows")
    return metrics
