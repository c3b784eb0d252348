"""Feature frames, splits, class balance, random forests, evaluation and audit rows."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.context import RunContext
from tidemark.operators.aggregates import exact_median
from tidemark.operators.ranking import hash_rank

#: Rows of a part of the table a forest is fitted on, at most: what a task holds of it in memory.
PART_ROWS = 250_000


def assemble(
    df: DataFrame, features: Sequence[str], label: str, keep: Sequence[str] = (), fill: float = 0.0
) -> DataFrame:
    """Numeric feature frame: flags become 0/1, NULL features ``fill``, rows without a label go.

    ``fill=None`` leaves NULLs for :func:`impute_median`.
    """
    numeric = [F.col(f).cast("double").alias(f) for f in features]
    frame = df.filter(F.col(label).isNotNull()).select(*keep, *numeric, label)
    return frame if fill is None else frame.fillna(fill, subset=list(features))


def fit_medians(df: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """Median per feature of the rows given (the training rows): one number per column."""
    return {r["feature"]: r["median"] for r in exact_median(df, features).collect()}


def impute(df: DataFrame, features: Sequence[str], values: Mapping[str, float]) -> DataFrame:
    """Replace NULL features by fitted values; a feature without a value gets 0."""
    filled = {f: F.coalesce(F.col(f), F.lit(float(values.get(f, 0.0)))) for f in features}
    return df.withColumns(filled)


def split_stratified(
    df: DataFrame, identifier: str, label: str, test_share: float = 0.2
) -> DataFrame:
    """Add ``split`` (``train``/``test``): the exact share of each class, chosen by md5 of the id.

    The split is a column of the data and does not depend on partitioning or a seed.
    """
    ranked = hash_rank(df, identifier, [label])
    test_rows = F.ceil(F.col("stratum_size") * F.lit(test_share))
    return ranked.withColumn(
        "split", F.when(F.col("hash_rank") <= test_rows, "test").otherwise("train")
    ).drop("hash_rank", "stratum_size")


def split_by_time(df: DataFrame, day: str, cutoff: str) -> DataFrame:
    """Out-of-time split: rows from the cutoff date on are the test rows."""
    after = F.col(day).cast("date") >= F.lit(cutoff).cast("date")
    return df.withColumn("split", F.when(after, "test").otherwise("train"))


def class_weights(df: DataFrame, label: str, copies: str | None = None) -> DataFrame:
    """(label, class_count, class_weight) with weight n / (classes * class count).

    ``copies`` names a column that says how many times a row counts.
    """
    size = F.count("*") if copies is None else F.sum(copies)
    counts = df.groupBy(label).agg(size.alias("class_count"))
    everything = Window.partitionBy(F.lit(0))
    total = F.sum("class_count").over(everything)
    classes = F.count("*").over(everything)
    return counts.withColumn("class_weight", total / (classes * F.col("class_count")))


def with_class_weight(df: DataFrame, label: str, copies: str | None = None) -> DataFrame:
    weights = class_weights(df, label, copies).select(label, "class_weight")
    weighed = df.join(weights, label)
    if copies is None:
        return weighed
    return weighed.withColumn("class_weight", F.col("class_weight") * F.col(copies))


def resample_balanced(df: DataFrame, identifier: str, label: str) -> DataFrame:
    """Weigh rows of the smaller classes until every class weighs as much as the largest.

    Row r of a class with c rows gets ``copies`` floor(m / c), one more for the first m mod c
    rows in md5 order: the table that repeats would give, without the repeats. No rows are
    dropped or made up, and the table does not grow with the imbalance.
    """
    sizes = df.groupBy(label).agg(F.count("*").alias("_n"))
    target = sizes.withColumn("_max", F.max("_n").over(Window.partitionBy(F.lit(0))))
    ranked = hash_rank(df, identifier, [label]).join(target, label)
    extra = F.when(F.col("hash_rank") <= F.col("_max") % F.col("_n"), 1).otherwise(0)
    copies = F.expr("_max div _n") + extra
    return ranked.withColumn("copies", copies.cast("long")).select(*df.columns, "copies")


@dataclass(frozen=True)
class ForestSpec:
    """Random-forest settings and the features they are for."""

    features: Sequence[str]
    label: str
    trees: int = 200
    depth: int = 8
    min_leaf: int = 5
    seed: int = 42
    classes: Sequence[str] = field(default_factory=tuple)
    #: Whether every tree takes its own sample of the rows; without it one tree is the whole table's.
    bootstrap: bool = True


def forest_pipeline(spec: ForestSpec) -> Pipeline:
    stages = [VectorAssembler(inputCols=list(spec.features), outputCol="features")]
    label = spec.label
    if spec.classes:
        label = "_label_index"
        # The class list is part of the definition, so a class missing from a sample (a small
        # fold, say) keeps its number.
        stages.append(
            StringIndexerModel.from_labels(
                list(spec.classes), inputCol=spec.label, outputCol=label, handleInvalid="error"
            )
        )
    stages.append(
        RandomForestClassifier(
            featuresCol="features",
            labelCol=label,
            weightCol="class_weight",
            numTrees=spec.trees,
            maxDepth=spec.depth,
            minInstancesPerNode=spec.min_leaf,
            seed=spec.seed,
            bootstrap=spec.bootstrap,
            # A level moves every row on by one node; otherwise every row walks down every tree
            # again at each level. The trees are the same. Levels are few: no checkpoint is needed.
            cacheNodeIds=True,
            checkpointInterval=-1,
        )
    )
    return Pipeline(stages=stages)


def dealt_rows(train: DataFrame) -> DataFrame:
    """``train`` in as many parts as the cluster has cores, or a multiple if they get too long.

    A forest passes over its rows once per level in the parts it is given, and small tables come
    out of joins in a single one. Every part costs a full set of node statistics per pass, so
    there are no more than needed. Rows are dealt and ordered by their values (maps have no
    order), so the trees' samples do not depend on how the table was written.
    """
    cores = train.sparkSession.sparkContext.defaultParallelism
    rounds = max(1, math.ceil(train.count() / (PART_ROWS * cores)))
    by = [name for name, kind in train.dtypes if "map<" not in kind and "variant" not in kind]
    return train.repartition(cores * rounds, *by).sortWithinPartitions(*by)


def fit_forest(train: DataFrame, spec: ForestSpec) -> PipelineModel:
    """Fit on class-balanced weights. ``train`` needs the label as text if classes are named,
    else as a number; its column ``copies``, if it has one, says how often a row counts."""
    copies = "copies" if "copies" in train.columns else None
    # Bins, classes and samples are each taken in a pass of their own.
    rows = dealt_rows(with_class_weight(train, spec.label, copies)).persist()
    try:
        return forest_pipeline(spec).fit(rows)
    finally:
        rows.unpersist()


def score_rows(
    model: PipelineModel, df: DataFrame, spec: ForestSpec, version: str = "v1.0"
) -> DataFrame:
    """``df`` plus ``predicted``, ``confidence`` (largest class probability, 4 digits),
    ``probability_positive`` for two classes, and ``model_version``."""
    assembled = model.stages[0].transform(df)
    scored = model.stages[-1].transform(assembled)
    probabilities = vector_to_array("probability")
    out = scored.withColumn("_p", probabilities)
    labels = list(spec.classes)
    predicted = F.col("prediction").cast("int")
    if labels:
        predicted = F.element_at(F.array(*[F.lit(c) for c in labels]), predicted + 1)
    out = out.withColumn("predicted", predicted).withColumn(
        "confidence", F.round(F.array_max("_p"), 4)
    )
    if not labels:
        out = out.withColumn("probability_positive", F.round(F.element_at("_p", 2), 4))
    extra = ["predicted", "confidence"] + ([] if labels else ["probability_positive"])
    return out.select(*df.columns, *extra, F.lit(version).alias("model_version"))


def confusion(df: DataFrame, label: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count("*").alias("row_count")
    )


def _per_class(matrix: DataFrame) -> DataFrame:
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("row_count")).otherwise(0)
    # Each confusion cell counts once for its actual and once for its predicted class.
    sides = F.array(
        F.struct(
            F.col("actual").alias("class"), F.col("row_count").alias("support"),
            F.lit(0).cast("long").alias("guessed"), hit.cast("long").alias("hits"),
        ),
        F.struct(
            F.col("predicted").alias("class"), F.lit(0).cast("long").alias("support"),
            F.col("row_count").alias("guessed"), F.lit(0).cast("long").alias("hits"),
        ),
    )
    counts = matrix.select(F.inline(sides)).groupBy("class").agg(
        *[F.sum(c).alias(c) for c in ("support", "guessed", "hits")]
    )

    def ratio(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))

    return counts.select(
        "class",
        "support",
        "hits",
        ratio(F.col("hits"), F.col("guessed")).alias("precision"),
        ratio(F.col("hits"), F.col("support")).alias("recall"),
        ratio(F.col("hits") * 2, F.col("support") + F.col("guessed")).alias("f1"),
    )


def class_report(matrix: DataFrame) -> DataFrame:
    """Per class: support, precision, recall, f1 (0 where undefined), from confusion counts."""
    return _per_class(matrix).drop("hits")


def overall_report(matrix: DataFrame) -> DataFrame:
    """One row: test size, accuracy and the unweighted class means of precision, recall, f1."""
    accuracy = F.try_divide(F.sum("hits").cast("double"), F.sum("support").cast("double"))
    return _per_class(matrix).agg(
        F.sum("support").alias("test_set_size"),
        F.round(accuracy, 4).alias("accuracy"),
        *[F.round(F.avg(c), 4).alias(f"{c}_macro") for c in ("precision", "recall", "f1")],
    )


def binary_areas(scored: DataFrame, label: str, probability: str) -> dict[str, float]:
    """Areas under the ROC and the precision-recall curve, through every distinct score.

    Fewer points would be taken part by part, so the areas would hang on how the rows lie.
    """
    frame = scored.select(
        F.col(label).cast("double").alias("label"), F.col(probability).alias("score")
    )

    def area(metric: str) -> float:
        evaluator = BinaryClassificationEvaluator(
            rawPredictionCol="score", labelCol="label", metricName=metric, numBins=0
        )
        return round(evaluator.evaluate(frame), 4)

    return {"auc_roc": area("areaUnderROC"), "auc_pr": area("areaUnderPR")}


def curve_areas(scored: DataFrame, label: str, score: str, digits: int = 4) -> DataFrame:
    """One row: the exact areas under the ROC curve and the precision-recall steps.

    Rows are first counted per score, rounded to ``digits``; a score between 0 and 1 then has at
    most 10^digits + 1 values, over which the running sums go. Ties count as half in ``auc_roc``;
    ``auc_pr`` is the average precision. NULL labels and scores are left out.
    """
    counts = (
        scored.select(F.round(F.col(score).cast("double"), digits).alias("s"), F.col(label).cast("int").alias("y"))
        .dropna()
        .groupBy("s")
        .agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("n"))
    )
    above = Window.orderBy(F.col("s").desc()).rowsBetween(Window.unboundedPreceding, 0)
    steps = counts.select(
        "p", "n", F.sum("p").over(above).alias("tp"), F.sum("n").over(above).alias("fp")
    )
    whole = [F.sum("p").cast("double"), F.sum("n").cast("double")]
    won = F.sum(F.col("n") * (F.col("tp") - F.col("p") / 2))
    precise = F.sum(F.col("p") * F.col("tp") / (F.col("tp") + F.col("fp")))
    return steps.agg(
        F.try_divide(won, whole[0] * whole[1]).alias("auc_roc"), F.try_divide(precise, whole[0]).alias("auc_pr")
    )


def deal_folds(train: DataFrame, identifier: str, label: str, folds: int = 5) -> DataFrame:
    """``train`` plus ``_fold``: rows are dealt in md5 order of the id within each class."""
    ranked = hash_rank(train, identifier, [label])
    return ranked.withColumn("_fold", ((F.col("hash_rank") - 1) % folds).cast("int"))


def cross_validate(
    train: DataFrame, spec: ForestSpec, identifier: str, folds: int = 5
) -> tuple[float, float]:
    """Mean and standard deviation of accuracy over stratified folds of the training rows.

    Class weights are those of all training rows: within a class, stratified folds leave the
    same share out, so the weights of a fold's training part differ by rounding only.
    """
    label = "_label_index" if spec.classes else spec.label
    dealt = deal_folds(train, identifier, spec.label, folds)
    validator = CrossValidator(
        estimator=forest_pipeline(spec),
        estimatorParamMaps=ParamGridBuilder().build(),
        evaluator=MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy"),
        numFolds=folds,
        foldCol="_fold",
    )
    # Every fold reads the rows twice: they are ranked, joined and dealt once.
    rows = dealt_rows(with_class_weight(dealt, spec.label)).persist()
    try:
        fitted = validator.fit(rows)
    finally:
        rows.unpersist()
    return round(fitted.avgMetrics[0], 4), round(fitted.stdMetrics[0], 4)


def importances(model: PipelineModel, spec: ForestSpec) -> dict[str, float]:
    """Feature importances, largest first."""
    values = model.stages[-1].featureImportances.toArray().tolist()
    return dict(sorted(zip(spec.features, values), key=lambda pair: (-pair[1], pair[0])))


def importance_table(df: DataFrame, ranked: Mapping[str, float], top: int = 5) -> DataFrame:
    rows = [
        F.struct(
            F.lit(name).alias("feature"),
            F.lit(round(value, 4)).alias("importance"),
            F.lit(place).alias("rank"),
        )
        for place, (name, value) in enumerate(list(ranked.items())[:top], start=1)
    ]
    return df.sparkSession.range(1).select(F.inline(F.array(*rows)))


def permuted_rows(df: DataFrame, features: Sequence[str], label: str, identifier: str) -> DataFrame:
    """Every row once as it is and once per feature with that feature of another row.

    Rows are paired along the md5 order of the id (row r takes values from row r - 1, the first
    from the last), so one join serves all features. ``_changed`` names the feature, or ``none``.
    """
    ranked = hash_rank(df, identifier)
    donor = ranked.select(
        (F.col("hash_rank") % F.col("stratum_size") + 1).alias("_taker"),
        F.struct(*features).alias("_donor"),
    )
    # Donor r serves the row after it in the order; ranks are unique, so this is one to one.
    paired = ranked.join(donor, F.col("hash_rank") == F.col("_taker"))

    def version(changed: str | None) -> Column:
        values = [(F.col(f"_donor.{f}") if f == changed else F.col(f)).alias(f) for f in features]
        return F.struct(F.lit(changed or "none").alias("_changed"), *values)

    versions = F.array(version(None), *[version(f) for f in features])
    return paired.select(F.col(identifier), F.col(label), F.inline(versions))


def permutation_importance(
    model: PipelineModel, df: DataFrame, spec: ForestSpec, identifier: str
) -> DataFrame:
    """(feature, accuracy, accuracy_drop): how much accuracy is lost when one feature of every
    row is taken from another row. The model scores all ``permuted_rows`` in a single pass.
    """
    scored = score_rows(model, permuted_rows(df, spec.features, spec.label, identifier), spec)
    hit = F.col("predicted").cast("string") == F.col(spec.label).cast("string")
    return accuracy_drops(scored, hit).drop("row_count")


def accuracy_drops(scored: DataFrame, hit: Column) -> DataFrame:
    """(feature, row_count, accuracy, accuracy_drop) from scored ``permuted_rows``; ``hit`` is true
    where the score is right. Rows are counted, so the figures do not depend on order."""
    counted = scored.groupBy("_changed").agg(F.count("*").alias("row_count"), F.count_if(hit).alias("_hits"))
    untouched = F.max(F.when(F.col("_changed") == "none", F.col("_hits"))).over(Window.partitionBy(F.lit(0)))
    share = lambda part: F.round(part.cast("double") / F.col("row_count"), 4)
    return (
        counted.withColumn("_lost", untouched - F.col("_hits"))
        .filter("_changed <> 'none'")
        .select(
            F.col("_changed").alias("feature"), "row_count", share(F.col("_hits")).alias("accuracy"),
            share(F.col("_lost")).alias("accuracy_drop"),
        )
    )


def ranked_drops(drops: DataFrame) -> dict[str, float]:
    """Features by what their permutation costs, most first: one number per feature."""
    found = {r.feature: r.accuracy_drop for r in drops.select("feature", "accuracy_drop").collect()}
    return dict(sorted(found.items(), key=lambda pair: (-pair[1], pair[0])))


def audit_rows(
    scored: DataFrame,
    ranked: Mapping[str, float],
    keep: Sequence[str],
    source: str,
    lineage: str,
    top: int = 3,
) -> DataFrame:
    """Every scored row with its top drivers (the model's strongest features and this row's
    values) and where its features came from."""
    drivers = F.array(
        *[
            F.struct(
                F.lit(name).alias("feature"),
                F.col(name).cast("double").alias("value"),
                F.lit(round(weight, 6)).alias("importance"),
            )
            for name, weight in list(ranked.items())[:top]
        ]
    )
    return scored.select(
        *keep,
        drivers.alias("top_risk_drivers"),
        F.struct(
            F.col("model_version"),
            F.lit(source).alias("feature_source"),
            F.lit(lineage).alias("data_lineage"),
        ).alias("audit_trail"),
    )


def model_card(
    df: DataFrame,
    name: str,
    spec: ForestSpec,
    ranked: Mapping[str, float],
    metrics: Mapping[str, float],
    notes: Mapping[str, str],
    run: RunContext,
) -> DataFrame:
    """One row describing a model, ready to be written as JSON."""
    features = [
        F.struct(F.lit(f).alias("feature"), F.lit(round(v, 6)).alias("importance"))
        for f, v in ranked.items()
    ]
    return df.sparkSession.range(1).select(
        F.lit(name).alias("model_name"),
        F.lit("RandomForestClassifier").alias("model_type"),
        run.loaded.alias("trained_at"),
        F.array(*[F.lit(f) for f in spec.features]).alias("features"),
        F.lit(spec.label).alias("target"),
        F.struct(*[F.lit(v).alias(k) for k, v in metrics.items()]).alias("metrics"),
        F.array(*features).alias("feature_importances"),
        F.struct(*[F.lit(v).alias(k) for k, v in notes.items()]).alias("model_card"),
    )
