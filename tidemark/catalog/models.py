"""Queries: feature frames, splits, forests, evaluation, audit rows, streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.catalog import products as p, standins as s
from tidemark.catalog.base import EVENTS_RUN, ORDERS_RUN, Tables, query
from tidemark.catalog.features import risk_features
from tidemark.functions.scoring import points
from tidemark.operators import learning
from tidemark.operators.learning import ForestSpec
from tidemark.plans import asset, provider, risk
from tidemark.session import work_dir
from tidemark.sources.bronze import write_table
from tidemark.streaming import jobs

# Trees, depth and smallest leaf of the three models.
TARGETING = ForestSpec(provider.FEATURES, "targeting_priority", 200, 8, 5, classes=("A", "B", "C", "D"))
FRAUD = ForestSpec(risk.FEATURES, "is_fraud", 300, 10, 3)
FAILURE = ForestSpec(asset.FEATURES, "failure_in_next_7d", 200, 8, 5)

SPLIT_SQL = """
placed AS (SELECT o_orderkey, o_orderstatus,
    row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey) AS place,
    COUNT(*) OVER (PARTITION BY o_orderstatus) AS size FROM orders)"""


@query(
    "ml_frame",
    "ML-01 FUN-06 FUN-07",
    "WITH " + s.CUSTOMER_360_SQL + """
    SELECT customer_id, CAST(COALESCE(bureau_score, 0) AS DOUBLE) AS bureau_score,
      CAST(COALESCE(num_open_accounts, 0) AS DOUBLE) AS num_open_accounts,
      COALESCE(credit_utilization_pct, 0) AS credit_utilization_pct,
      CAST(customer_tenure_days AS DOUBLE) AS customer_tenure_days, income_band FROM cust360""",
)
def ml_frame(t: Tables) -> DataFrame:
    profile = risk.customer_360(s.risk_silver(t)["silver_customers_clean"], s.bureau(t), EVENTS_RUN)
    columns = [
        "bureau_score", "num_open_accounts", "credit_utilization_pct", "customer_tenure_days",
    ]
    return learning.assemble(profile, columns, "income_band", keep=["customer_id"])


@query(
    "ml_imputed",
    "ML-01 AGG-18",
    "WITH " + s.CUSTOMER_360_SQL + """
    SELECT customer_id,
      COALESCE(CAST(bureau_score AS DOUBLE), (SELECT median(bureau_score) FROM cust360)) AS bureau_score,
      COALESCE(credit_utilization_pct, (SELECT median(credit_utilization_pct) FROM cust360)) AS credit_utilization_pct,
      income_band FROM cust360""",
)
def ml_imputed(t: Tables) -> DataFrame:
    profile = risk.customer_360(s.risk_silver(t)["silver_customers_clean"], s.bureau(t), EVENTS_RUN)
    columns = ["bureau_score", "credit_utilization_pct"]
    frame = learning.assemble(profile, columns, "income_band", keep=["customer_id"], fill=None)
    return learning.impute(frame, columns, learning.fit_medians(frame, columns))


@query(
    "ml_split",
    "ML-02",
    "WITH " + SPLIT_SQL + """
    SELECT o_orderkey, o_orderstatus,
      CASE WHEN place <= ceil(size * 0.2) THEN 'test' ELSE 'train' END AS split FROM placed""",
)
def ml_split(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    return learning.split_stratified(rows, "o_orderkey", "o_orderstatus")


@query(
    "ml_oot_split",
    "ML-13",
    """SELECT o_orderkey, CASE WHEN o_orderdate >= DATE '2000-01-01' THEN 'test' ELSE 'train' END AS split
       FROM orders""",
)
def ml_oot_split(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_orderdate")
    return learning.split_by_time(rows, "o_orderdate", "2000-01-01").select("o_orderkey", "split")


@query(
    "class_weights",
    "ML-03",
    """SELECT event_type, COUNT(*) AS class_count,
      round((SELECT COUNT(*) FROM events) / (5.0 * COUNT(*)), 6) AS class_weight FROM events GROUP BY 1""",
)
def class_weights(t: Tables) -> DataFrame:
    return p.rounded(learning.class_weights(t.events, "event_type"), 6, "class_weight")


@query(
    "ml_resampled",
    "ML-12",
    """WITH sized AS (SELECT event_id, value > 100 AS is_high,
        row_number() OVER (PARTITION BY value > 100 ORDER BY md5(CAST(event_id AS VARCHAR)), event_id) AS place,
        COUNT(*) OVER (PARTITION BY value > 100) AS n FROM events),
      wanted AS (SELECT *, (SELECT MAX(n) FROM sized) AS most FROM sized)
    SELECT event_id, is_high, CAST(most // n + CASE WHEN place <= most % n THEN 1 ELSE 0 END AS BIGINT) AS copies
    FROM wanted""",
)
def ml_resampled(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", (F.col("value") > 100).alias("is_high"))
    return learning.resample_balanced(rows, "event_id", "is_high")


MATRIX_SQL = """
matrix AS (SELECT l_returnflag AS actual,
    CASE WHEN l_quantity > 40 THEN 'R' WHEN l_quantity > 20 THEN 'A' ELSE 'N' END AS predicted,
    COUNT(*) AS row_count FROM lineitem GROUP BY 1, 2)"""


def _matrix(t: Tables) -> DataFrame:
    guess = F.when(F.col("l_quantity") > 40, "R").when(F.col("l_quantity") > 20, "A").otherwise("N")
    return learning.confusion(
        t.lineitem.select("l_returnflag", guess.alias("guess")), "l_returnflag", "guess"
    )


query("ml_confusion", "ML-07", "WITH " + MATRIX_SQL + " SELECT * FROM matrix")(_matrix)

REPORT_SQL = MATRIX_SQL + """,
classes AS (SELECT actual AS class FROM matrix UNION SELECT predicted FROM matrix),
counts AS (SELECT class,
    COALESCE((SELECT SUM(row_count) FROM matrix WHERE actual = class), 0) AS support,
    COALESCE((SELECT SUM(row_count) FROM matrix WHERE predicted = class), 0) AS guessed,
    COALESCE((SELECT SUM(row_count) FROM matrix WHERE actual = class AND predicted = class), 0) AS hits FROM classes),
report AS (SELECT class, CAST(support AS BIGINT) AS support,
    COALESCE(CAST(hits AS DOUBLE) / nullif(guessed, 0), 0) AS prec,
    COALESCE(CAST(hits AS DOUBLE) / nullif(support, 0), 0) AS rec,
    COALESCE(2.0 * hits / nullif(support + guessed, 0), 0) AS f1 FROM counts)"""


@query(
    "ml_class_report",
    "ML-07",
    "WITH " + REPORT_SQL + """
    SELECT class, support, round(prec, 6) AS precision, round(rec, 6) AS recall, round(f1, 6) AS f1 FROM report""",
)
def ml_class_report(t: Tables) -> DataFrame:
    return p.rounded(learning.class_report(_matrix(t)), 6, "precision", "recall", "f1")


@query(
    "ml_overall_report",
    "ML-07",
    "WITH " + REPORT_SQL + """
    SELECT (SELECT CAST(SUM(row_count) AS BIGINT) FROM matrix) AS test_set_size,
      round((SELECT CAST(SUM(row_count) AS DOUBLE) FROM matrix WHERE actual = predicted)
        / (SELECT SUM(row_count) FROM matrix), 4) AS accuracy,
      round(AVG(prec), 4) AS precision_macro, round(AVG(rec), 4) AS recall_macro, round(AVG(f1), 4) AS f1_macro
    FROM report""",
)
def ml_overall_report(t: Tables) -> DataFrame:
    return learning.overall_report(_matrix(t))


@query(
    "ml_curve_areas",
    "ML-07",
    """WITH scores AS (SELECT round(value / 250, 4) AS s, CAST(event_type = 'purchase' AS INTEGER) AS y FROM events),
    steps AS (SELECT s, SUM(y) AS p, COUNT(*) - SUM(y) AS n FROM scores GROUP BY s),
    sums AS (SELECT *, SUM(p) OVER (ORDER BY s DESC) AS tp, SUM(n) OVER (ORDER BY s DESC) AS fp FROM steps)
    SELECT round(SUM(n * (tp - p / 2.0)) / (SUM(p) * SUM(n)), 9) AS auc_roc,
      round(SUM(p * CAST(tp AS DOUBLE) / (tp + fp)) / SUM(p), 9) AS auc_pr FROM sums""",
)
def ml_curve_areas(t: Tables) -> DataFrame:
    rows = t.events.select(
        (F.col("value") / 250).alias("score"), (F.col("event_type") == "purchase").alias("bought")
    )
    return p.rounded(learning.curve_areas(rows, "bought", "score"), 9, "auc_roc", "auc_pr")


@query(
    "ml_predictions_sink",
    "SRC-06",
    """SELECT event_id, CASE WHEN value > 200 THEN 'A' WHEN value > 100 THEN 'B' ELSE 'C' END AS predicted,
      round(least(1, value / 250), 4) AS confidence, 'v1.0' AS model_version FROM events""",
)
def ml_predictions_sink(t: Tables) -> DataFrame:
    """Scored rows written to the predictions table and read back as a caller would."""
    value = F.col("value")
    scored = t.events.select(
        "event_id", F.when(value > 200, "A").when(value > 100, "B").otherwise("C").alias("predicted"),
        F.round(F.least(F.lit(1.0), value / 250), 4).alias("confidence"),
        F.lit("v1.0").alias("model_version"),
    )
    root = work_dir(t.spark, "predictions")
    return t.spark.read.parquet(write_table(scored, root, "gold", "hcp_predictions"))


@query(
    "ml_folds",
    "ML-06 ML-10",
    """SELECT event_id, event_type, CAST((row_number() OVER (PARTITION BY event_type
      ORDER BY md5(CAST(event_id AS VARCHAR)), event_id) - 1) % 5 AS INTEGER) AS fold FROM events""",
)
def ml_folds(t: Tables) -> DataFrame:
    dealt = learning.deal_folds(t.events.select("event_id", "event_type"), "event_id", "event_type")
    return dealt.select("event_id", "event_type", F.col("_fold").alias("fold"))


@query(
    "ml_permuted",
    "ML-11",
    """WITH ranked AS (SELECT *, row_number() OVER (ORDER BY md5(CAST(event_id AS VARCHAR)), event_id) AS r,
      COUNT(*) OVER () AS n FROM events),
    paired AS (SELECT a.event_id, a.event_type, a.value, a.user_id, b.value AS v, b.user_id AS u
      FROM ranked a JOIN ranked b ON a.r = b.r % b.n + 1)
    SELECT event_id, event_type, 'none' AS changed, value, user_id FROM paired
    UNION ALL SELECT event_id, event_type, 'value', v, user_id FROM paired
    UNION ALL SELECT event_id, event_type, 'user_id', value, u FROM paired""",
)
def ml_permuted(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "event_type", "value", "user_id")
    found = learning.permuted_rows(rows, ["value", "user_id"], "event_type", "event_id")
    return found.withColumnRenamed("_changed", "changed")


# A fixed linear score of a high value, and what is asked of it.
SCORED = ("value", "user_id")
IS_HIGH, SAYS_HIGH = "value > 100", "value * 10 + user_id > 1050"
DROPS_SQL = """ranked AS (SELECT *, row_number() OVER (ORDER BY md5(CAST(event_id AS VARCHAR)), event_id) AS r,
      COUNT(*) OVER () AS n FROM events WHERE value IS NOT NULL),
    paired AS (SELECT a.value > 100 AS high, a.value, a.user_id, b.value AS v, b.user_id AS u
      FROM ranked a JOIN ranked b ON a.r = b.r % b.n + 1),
    hits AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (high = (value * 10 + user_id > 1050)) AS plain,
      COUNT(*) FILTER (high = (v * 10 + user_id > 1050)) AS by_value, COUNT(*) FILTER (high = (value * 10 + u > 1050)) AS by_user FROM paired),
    drops AS (SELECT 'value' AS feature, n, by_value AS h, plain - by_value AS lost FROM hits
      UNION ALL SELECT 'user_id', n, by_user, plain - by_user FROM hits),
    importance AS (SELECT feature, n AS row_count, round(h::DOUBLE / n, 4) AS accuracy, round(lost::DOUBLE / n, 4) AS importance,
      CAST(row_number() OVER (ORDER BY round(lost::DOUBLE / n, 4) DESC, feature) AS INTEGER) AS rank FROM drops)"""


def linear_drops(t: Tables) -> DataFrame:
    """What the score loses when one of its inputs is taken from another row."""
    rows = t.events.filter("value IS NOT NULL").select("event_id", *SCORED, F.expr(IS_HIGH).alias("is_high"))
    permuted = learning.permuted_rows(rows, SCORED, "is_high", "event_id")
    return learning.accuracy_drops(permuted, F.expr(SAYS_HIGH) == F.col("is_high"))


@query(
    "ml_importance_rows",
    "ML-08",
    f"WITH {DROPS_SQL} SELECT feature, row_count, accuracy, importance, rank FROM importance",
)
def ml_importance_rows(t: Tables) -> DataFrame:
    """Features ranked by the accuracy that their permutation costs."""
    drops = t.keep(linear_drops(t), "drops")
    ranked = learning.importance_table(t.events, learning.ranked_drops(drops), top=2)
    return ranked.join(drops.drop("accuracy_drop"), "feature")


@query(
    "ml_audit_rows",
    "ML-09",
    f"""WITH {DROPS_SQL}, first AS (SELECT * FROM importance WHERE rank = 1), second AS (SELECT * FROM importance WHERE rank = 2),
    one AS (SELECT e.*, f.feature AS f1, f.importance AS w1, s.feature AS f2, s.importance AS w2
      FROM events e, first f, second s WHERE e.value IS NOT NULL)
    SELECT event_id, CASE f1 WHEN 'value' THEN value ELSE CAST(user_id AS DOUBLE) END AS first_value, f1 AS first_feature, w1 AS first_weight,
      CASE f2 WHEN 'value' THEN value ELSE CAST(user_id AS DOUBLE) END AS second_value, f2 AS second_feature, w2 AS second_weight,
      'v1.0' AS model_version, 'events' AS feature_source, 'events > scores' AS data_lineage FROM one""",
)
def ml_audit_rows(t: Tables) -> DataFrame:
    """Every scored row with its two strongest inputs, as measured on the rows themselves."""
    ranked = learning.ranked_drops(linear_drops(t))
    scored = t.events.filter("value IS NOT NULL").withColumn("model_version", F.lit("v1.0"))
    found = learning.audit_rows(scored, ranked, ["event_id"], "events", "events > scores", top=2)
    driver = lambda i, part: F.col("top_risk_drivers")[i][part]
    return found.select(
        "event_id", driver(0, "value").alias("first_value"), driver(0, "feature").alias("first_feature"),
        driver(0, "importance").alias("first_weight"), driver(1, "value").alias("second_value"),
        driver(1, "feature").alias("second_feature"), driver(1, "importance").alias("second_weight"),
        "audit_trail.*",
    )


@query(
    "ml_model_card",
    "ML-10",
    f"""WITH {DROPS_SQL},
    cells AS (SELECT value > 100 AS a, value * 10 + user_id > 1050 AS p FROM events WHERE value IS NOT NULL),
    c AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (a = p) AS hits, COUNT(*) FILTER (a AND p) AS tp, COUNT(*) FILTER (NOT a AND NOT p) AS tn,
      COUNT(*) FILTER (a) AS pos, COUNT(*) FILTER (NOT a) AS neg, COUNT(*) FILTER (p) AS ppos, COUNT(*) FILTER (NOT p) AS pneg FROM cells)
    SELECT 'Linear score of high values' AS model_name, 'is_high' AS target, 'value,user_id' AS features,
      n AS test_set_size, round(hits::DOUBLE / n, 4) AS accuracy,
      round((COALESCE(2.0 * tp / (pos + ppos), 0) + COALESCE(2.0 * tn / (neg + pneg), 0)) / 2, 4) AS f1_macro,
      (SELECT feature FROM importance WHERE rank = 1) AS strongest, (SELECT importance FROM importance WHERE rank = 1) AS strongest_weight,
      TIMESTAMP '2024-01-31 06:00:00' AS trained_at FROM c""",
)
def ml_model_card(t: Tables) -> DataFrame:
    """The card of the score: its figures over the table and its strongest input."""
    rows = t.events.filter("value IS NOT NULL").select(F.expr(IS_HIGH).cast("int").alias("is_high"), F.expr(SAYS_HIGH).cast("int").alias("says"))
    metrics = learning.overall_report(t.keep(learning.confusion(rows, "is_high", "says"), "cells")).first().asDict()
    spec = ForestSpec(SCORED, "is_high")
    card = learning.model_card(
        t.events, "Linear score of high values", spec, learning.ranked_drops(linear_drops(t)), metrics,
        {"training_data": "events"}, EVENTS_RUN,
    )
    strongest = F.col("feature_importances")[0]
    return card.select(
        "model_name", "target", F.array_join("features", ",").alias("features"),
        F.col("metrics.test_set_size").cast("bigint").alias("test_set_size"),
        "metrics.accuracy", "metrics.f1_macro", strongest["feature"].alias("strongest"),
        strongest["importance"].alias("strongest_weight"), "trained_at",
    )


# One tree of one split over a feature with few values, so that SQL can find the split too.
STUMP = ForestSpec(("bucket",), "is_high", trees=1, depth=1, min_leaf=1, bootstrap=False)


@query(
    "ml_score_contract",
    "ML-04 ML-05",
    """WITH e AS (SELECT event_id, CAST(LEAST(floor(value / 10), 30) AS DOUBLE) AS bucket, (value > 57)::INTEGER AS y FROM events WHERE value IS NOT NULL),
    n AS (SELECT COUNT(*)::DOUBLE AS n, COUNT(*) FILTER (y = 1)::DOUBLE AS n1, COUNT(*) FILTER (y = 0)::DOUBLE AS n0 FROM e),
    b AS (SELECT bucket, COUNT(*) FILTER (y = 0) * n / (2 * n0) AS w0, COUNT(*) FILTER (y = 1) * n / (2 * n1) AS w1 FROM e, n GROUP BY bucket, n, n0, n1),
    cuts AS (SELECT a.bucket AS cut, SUM(b.w0) FILTER (b.bucket <= a.bucket) AS l0, SUM(b.w1) FILTER (b.bucket <= a.bucket) AS l1,
      COALESCE(SUM(b.w0) FILTER (b.bucket > a.bucket), 0) AS r0, COALESCE(SUM(b.w1) FILTER (b.bucket > a.bucket), 0) AS r1 FROM b a, b GROUP BY 1),
    best AS (SELECT * FROM cuts WHERE r0 + r1 > 0
      ORDER BY (l0 + l1) * (1 - (l0 * l0 + l1 * l1) / ((l0 + l1) * (l0 + l1))) + (r0 + r1) * (1 - (r0 * r0 + r1 * r1) / ((r0 + r1) * (r0 + r1))), cut LIMIT 1),
    p AS (SELECT event_id, y, CASE WHEN bucket <= cut THEN l1 / (l0 + l1) ELSE r1 / (r0 + r1) END AS p1 FROM e, best)
    SELECT event_id, y AS is_high, (p1 > 0.5)::INTEGER AS predicted, round(GREATEST(p1, 1 - p1), 4) AS confidence,
      round(p1, 4) AS probability_positive, 'v1.0' AS model_version FROM p""",
)
def ml_score_contract(t: Tables) -> DataFrame:
    """A forest of one split: the split, both leaves and every row's score must be those of SQL."""
    rows = t.events.filter("value IS NOT NULL").select(
        "event_id", F.least(F.floor(F.col("value") / 10), F.lit(30)).cast("double").alias("bucket"),
        (F.col("value") > 57).cast("int").alias("is_high"),
    )
    model = learning.fit_forest(rows, STUMP)
    return learning.score_rows(model, rows, STUMP).drop("bucket")


# Models. Fitting runs jobs while the query is built; results have no SQL twin. The frames are
# written once because a forest reads its input many times, the features before that because the
# split reads them twice.

asset_label = "failure_in_next_7d"


def _targeting_frame(t: Tables) -> DataFrame:
    scores = provider.targeting_score(p._view(t), ORDERS_RUN).withColumn(
        "specialty_tier_num", points(F.col("specialty_tier"), provider.TIER_ORDINAL, 1)
    )
    frame = t.keep(
        learning.assemble(scores, provider.FEATURES, "targeting_priority", keep=["hcp_id"]), "features-targeting"
    )
    return t.keep(learning.split_stratified(frame, "hcp_id", "targeting_priority"), "frame-targeting")


def _fraud_frame(t: Tables) -> DataFrame:
    frame = learning.assemble(
        risk_features(t), risk.FEATURES, "is_fraud",
        keep=["transaction_id", "customer_id", "_batch_id"],
    ).withColumn("is_fraud", F.col("is_fraud").cast("int"))
    frame = t.keep(frame, "features-fraud")
    return t.keep(learning.split_stratified(frame, "transaction_id", "is_fraud"), "frame-fraud")


def _failure_frame(t: Tables) -> DataFrame:
    rows = p.failure_features(t).withColumn(
        "row_id", F.concat_ws("@", "asset_id", F.col("reading_date").cast("string"))
    )
    frame = t.keep(
        learning.assemble(rows, asset.FEATURES, asset_label, keep=["row_id"], fill=None), "features-failure"
    )
    split = t.keep(learning.split_stratified(frame, "row_id", asset_label), "split-failure")
    medians = learning.fit_medians(split.filter("split = 'train'"), asset.FEATURES)
    whole = learning.impute(split, asset.FEATURES, medians)
    return t.keep(whole, "frame-failure")


def _train(frame: DataFrame) -> DataFrame:
    return frame.filter("split = 'train'")


@query("rf_targeting_scores", "ML-04 ML-05")
def rf_targeting_scores(t: Tables) -> DataFrame:
    frame = _targeting_frame(t)
    model = learning.fit_forest(_train(frame), TARGETING)
    return learning.score_rows(model, frame, TARGETING).select(
        "hcp_id", "targeting_priority", "split", "predicted", "confidence", "model_version"
    )


@query("rf_fraud_scores", "ML-04 ML-05")
def rf_fraud_scores(t: Tables) -> DataFrame:
    frame = _fraud_frame(t)
    balanced = learning.resample_balanced(_train(frame), "transaction_id", "is_fraud")
    model = learning.fit_forest(balanced, FRAUD)
    return learning.score_rows(model, frame, FRAUD).select(
        "transaction_id", "is_fraud", "split", "predicted",
        F.col("probability_positive").alias("fraud_probability"), "model_version",
    )


@query("rf_failure_report", "ML-04 ML-07")
def rf_failure_report(t: Tables) -> DataFrame:
    """Held-out report of the failure model, per class."""
    frame = _failure_frame(t)
    model = learning.fit_forest(_train(frame), FAILURE)
    scored = learning.score_rows(model, frame.filter("split = 'test'"), FAILURE)
    # Two areas and the counts read the scores: the forest goes over the rows once.
    scored = t.keep(scored.select(asset_label, "predicted", "probability_positive"), "scored-failure")
    areas = learning.binary_areas(scored, asset_label, "probability_positive")
    report = learning.class_report(learning.confusion(scored, asset_label, "predicted"))
    return report.withColumns({k: F.lit(v) for k, v in areas.items()})


@query("rf_importance", "ML-08")
def rf_importance(t: Tables) -> DataFrame:
    frame = _targeting_frame(t)
    model = learning.fit_forest(_train(frame), TARGETING)
    return learning.importance_table(frame, learning.importances(model, TARGETING))


@query("rf_permutation", "ML-11")
def rf_permutation(t: Tables) -> DataFrame:
    frame = _targeting_frame(t)
    model = learning.fit_forest(_train(frame), TARGETING)
    held_out = frame.filter("split = 'test'")
    return learning.permutation_importance(model, held_out, TARGETING, "hcp_id")


@query("rf_audit", "ML-09 GOV-04")
def rf_audit(t: Tables) -> DataFrame:
    frame = _fraud_frame(t)
    model = learning.fit_forest(_train(frame), FRAUD)
    scored = learning.score_rows(model, frame, FRAUD)
    return learning.audit_rows(
        scored,
        learning.importances(model, FRAUD),
        ["transaction_id", "customer_id", "amount", "probability_positive", "_batch_id"],
        source="gold_transaction_risk_features",
        lineage="silver_transactions_clean > gold_transaction_risk_features",
    )


@query("rf_cv", "ML-06 ML-10")
def rf_cv(t: Tables) -> DataFrame:
    """Model card of the targeting model with its cross-validated accuracy on training rows."""
    frame = _targeting_frame(t)
    train = _train(frame)
    mean, deviation = learning.cross_validate(train, TARGETING, "hcp_id")
    model = learning.fit_forest(train, TARGETING)
    return learning.model_card(
        frame,
        "HCP Targeting Priority Classifier",
        TARGETING,
        learning.importances(model, TARGETING),
        {"cv_accuracy_mean": mean, "cv_accuracy_std": deviation},
        {"intended_use": "Rank providers for field teams", "training_data": "gold_hcp_targeting_score"},
        ORDERS_RUN,
    )


# Streams run to the end of the available input and are read back from the shared folder.


@query(
    "stream_bronze",
    "STR-01 SRC-08",
    """SELECT event_id, ts, user_id, event_type, value, props, '20240131_060000' AS _batch_id,
      TIMESTAMP '2024-01-31 06:00:00' AS _load_ts, 'sensor_events.parquet' AS _source_file,
      'SENSOR' AS _source_system FROM events""",
)
def stream_bronze(t: Tables) -> DataFrame:
    root = work_dir(t.spark, "stream-bronze")
    stream = jobs.table_stream(t.spark, t.path("events"), t.events.schema)
    jobs.ingest_stream(
        stream, EVENTS_RUN, "sensor_events.parquet", f"{root}/bronze", f"{root}/checkpoint"
    ).awaitTermination()
    return t.spark.read.parquet(f"{root}/bronze")


@query(
    "stream_validated",
    "STR-02 SIL-21",
    """SELECT user_id, date_trunc('hour', ts) AS reading_hour, COUNT(*) AS reading_count,
      COUNT(*) FILTER (WHERE value >= 1 AND value <= 225) AS valid_count,
      COUNT(*) FILTER (WHERE (value >= 1 AND value < 5) OR (value > 115 AND value <= 225)) AS anomaly_count,
      COUNT(*) FILTER (WHERE value < 1 OR value > 225) AS outlier_count
    FROM events WHERE date_trunc('hour', ts) + INTERVAL 3 HOUR <= (SELECT MAX(ts) FROM events) GROUP BY 1, 2""",
)
def stream_validated(t: Tables) -> DataFrame:
    """Hours the watermark (2 hours behind the newest reading) has closed."""
    root = work_dir(t.spark, "stream-validated")
    stream = jobs.table_stream(t.spark, t.path("events"), t.events.schema)
    hourly = jobs.validate_stream(
        stream, EVENTS_RUN, "event_id", "user_id", "ts", "value", s.LIMITS
    )
    (
        hourly.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{root}/hourly")
        .awaitTermination()
    )
    return t.spark.read.schema(hourly.schema).parquet(f"{root}/hourly")
