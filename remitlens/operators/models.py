"""Classifiers: candidates, cross-validation, tuning, final fit, scoring and importances.

Boosted candidates of all folds and grid points grow side by side (``boosting``); the others are MLlib. All of them see
the full data. Scores of every model and fold go into one table and are evaluated in one pass.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, replace

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel, RandomForestClassifier
from pyspark.ml.common import _py2java
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remitlens import constants as C
from remitlens.functions import scalars as S
from remitlens.operators import boosting, claims_api, encoding, evaluation, splits
from remitlens.operators.boosting import Boost, Boosted, Fit
from remitlens.operators.ordering import global_rank
from remitlens.session import materialize

LABEL, BALANCED, POSITIVE = "label", "w_balanced", "w_positive"
KEYS = splits.SPLIT_KEYS
SIDE_BY_SIDE = 2_000_000  # rows that fits which run at the same time hold together


@dataclass(frozen=True)
class FeatureSpec:
    """What a model was trained on; saved with it so scoring rebuilds the same columns."""

    numerics: list[str]
    vocab: dict[str, list[str]]

    @property
    def names(self) -> list[str]:
        return [*self.numerics, *encoding.onehot_names(self.vocab)]

    def encode(self, df: DataFrame) -> DataFrame:
        return encoding.apply_onehot(df, self.vocab)

    def vectors(self, df: DataFrame) -> DataFrame:
        return encoding.assemble(self.encode(df), self.names)


def fit_features(df: DataFrame) -> FeatureSpec:
    return FeatureSpec(encoding.model_features(df), encoding.fit_onehot(df))


def training_table(df: DataFrame, spec: FeatureSpec, keys: Sequence[str] = tuple(KEYS), target: str = C.TARGET, stored: bool = True) -> DataFrame:
    """Key, label, weights and the feature vector, stored once for the many passes of a fit. Folds store their own rows and need no copy here."""
    weights = evaluation.class_weights(df, target).first()
    positive = F.col(target) == 1
    balanced = F.when(positive, F.lit(weights["weight_positive"])).otherwise(F.lit(weights["weight_negative"]))
    tilted = F.when(positive, F.lit(weights["scale_pos_weight"])).otherwise(F.lit(1.0))
    table = spec.vectors(df).select(
        *keys, F.col(target).cast("double").alias(LABEL), balanced.cast("double").alias(BALANCED),
        tilted.cast("double").alias(POSITIVE), "features",
    )
    return materialize(table, "training") if stored else table


class RowScaledLogistic(LogisticRegression):
    """Logistic regression whose ``regParam`` is 1/C; each fit divides it by the rows that it sees."""

    def _fit(self, dataset: DataFrame) -> Model:
        own = self.copy({self.regParam: self.getRegParam() / max(dataset.count(), 1)})
        return super(RowScaledLogistic, own)._fit(dataset)


def candidates(seed: int = 42) -> dict[str, Estimator | Boost]:
    """The five compared models."""
    scaled = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    logistic = RowScaledLogistic(
        featuresCol="scaled", labelCol=LABEL, weightCol=BALANCED, maxIter=1000, regParam=1.0, standardization=False,
    )
    return {
        "Logistic_Regression": Pipeline(stages=[scaled, logistic]),
        "Random_Forest": RandomForestClassifier(
            labelCol=LABEL, weightCol=BALANCED, numTrees=150, maxDepth=12, seed=seed),
        "Hist_Gradient_Boosting": Boost(rounds=150, step=0.08, leaves=31, depth=8, weight=BALANCED, patience=10),
        "Gradient_Boosting": Boost(rounds=100, step=0.1, leaves=32, depth=5, min_rows=1),
        "Weighted_Gradient_Boosting": Boost(rounds=150, step=0.1, leaves=31, depth=8, weight=POSITIVE),
    }


def grids(name: str, est: Estimator | Boost) -> list:
    """Search grid of each candidate: parameter maps, or the boosted variants themselves."""
    if name == "Hist_Gradient_Boosting":
        return boosting.grid(est, rounds=[100, 200], step=[0.05, 0.1], leaves=[31, 63], l2=[0.0, 0.1])
    if name == "Weighted_Gradient_Boosting":
        return boosting.grid(est, rounds=[100, 200], depth=[6, 10], step=[0.05, 0.1])
    if name == "Gradient_Boosting":
        return [replace(s, leaves=2 ** s.depth) for s in boosting.grid(est, rounds=[100, 150], depth=[4, 6])]
    grid = ParamGridBuilder()
    if name == "Logistic_Regression":
        grid = grid.addGrid(est.getStages()[-1].regParam, [1.0 / c for c in (0.01, 0.1, 1.0, 10.0)])
    else:
        # 30 is MLlib's deepest tree, standing in for "no limit"
        grid = grid.addGrid(est.numTrees, [100, 200]).addGrid(est.maxDepth, [10, 15, 30])
    return grid.build()


def probability(df: DataFrame) -> DataFrame:
    """The positive-class probability of a model's output as ``probability_1``."""
    return df.withColumn("probability_1", vector_to_array("probability")[1])


def cross_validate(table: DataFrame, models: dict[str, Estimator | Boost], k: int = 5, parallelism: int = 5) -> DataFrame:
    """Held-out scores (Model, fold, label, score) of every model and fold, stored. Boosted models of all folds are fitted in one scan.

    The others see all rows of the other folds too. Each holds its rows in memory while it fits, so at most ``parallelism`` run side by
    side, and only while they hold up to ``SIDE_BY_SIDE`` rows together. Every row is held out and scored once.
    """
    folded = splits.stratified_folds(table, LABEL, k, KEYS)  # stored in hash order; the fold is an expression over it
    boosted = [Fit(name, fold, est) for name, est in models.items() if isinstance(est, Boost) for fold in range(k)]
    models = {name: est for name, est in models.items() if not isinstance(est, Boost)}
    scored = boosting.fit_many(folded, boosted, LABEL)[1] if boosted else None
    if not models:
        return materialize(scored, "cv")

    seen = {fold: folded.where(F.col("fold") != fold) for fold in range(k)}
    at_once = max(1, min(parallelism, SIDE_BY_SIDE // max(folded.count(), 1)))

    def held_out(job: tuple[str, int]) -> DataFrame:
        name, fold = job
        model = models[name].fit(seen[fold])
        held = probability(model.transform(folded.where(F.col("fold") == fold)))
        return held.select(F.lit(name).alias("Model"), "fold", F.col(LABEL).cast("int").alias(LABEL), F.col("probability_1").alias("score"))

    with ThreadPoolExecutor(at_once) as pool:  # fits wait for the cluster, not for this process
        parts = list(pool.map(held_out, [(name, fold) for name in models for fold in range(k)]))
    for p in parts:
        scored = p if scored is None else scored.unionByName(p)
    return materialize(scored, "cv")


def compare_models(table: DataFrame, models: dict[str, Estimator], k: int = 5, parallelism: int = 5) -> DataFrame:
    """Mean and sd of average precision, mean ROC-AUC and F1 over k folds, best model first."""
    return cv_table(cross_validate(table, models, k, parallelism))


def cv_table(scored: DataFrame) -> DataFrame:
    """The comparison table from held-out scores (Model, fold, label, score)."""
    groups = ["Model", "fold"]
    curve = evaluation.pr_curve(scored, LABEL, "score", groups)
    hit, positive = F.col("score") >= 0.5, F.col(LABEL) == 1
    f1 = scored.groupBy(*groups).agg(F.coalesce(
        F.try_divide(2.0 * F.count_if(hit & positive), F.count_if(hit) + F.count_if(positive)), F.lit(0.0)
    ).alias("f1"))
    per_fold = (
        evaluation.average_precision(curve, groups).join(evaluation.roc_auc(curve, groups), groups).join(f1, groups)
    )
    return per_fold.groupBy("Model").agg(
        S.round_even(F.avg("average_precision"), 4).alias("Mean_PR_AUC"),
        S.round_even(F.stddev_pop("average_precision"), 4).alias("Std_PR_AUC"),
        S.round_even(F.avg("roc_auc"), 4).alias("Mean_ROC_AUC"),
        S.round_even(F.avg("f1"), 4).alias("Mean_F1"),
    ).orderBy(F.col("Mean_PR_AUC").desc(), "Model")


class AveragePrecisionEvaluator(Evaluator):
    """Exact step-wise average precision for CrossValidator."""

    def _evaluate(self, dataset: DataFrame) -> float:
        scored = probability(dataset).select(F.col(LABEL).cast("int").alias(LABEL), F.col("probability_1").alias("score"))
        return float(evaluation.average_precision(evaluation.pr_curve(scored, LABEL, "score")).first()[0])

    def isLargerBetter(self) -> bool:
        return True


@dataclass
class Tuned:
    """A finished search: the best variant, and the mean average precision of each point of the grid."""

    best: Estimator | Boost
    points: list[str]
    scores: list[float]

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(p, float(s), s == max(self.scores)) for p, s in zip(self.points, self.scores)]
        return spark.createDataFrame(rows, "Parameters string, Mean_PR_AUC double, best boolean").orderBy(F.col("Mean_PR_AUC").desc(), "Parameters")


def tune(table: DataFrame, est: Estimator | Boost, grid: list, k: int = 3, parallelism: int = 4) -> Tuned:
    """Grid search by average precision over k folds; the first of the best points wins."""
    folded = splits.stratified_folds(table, LABEL, k, KEYS, seed=11)  # stored in hash order; the fold is an expression over it
    if isinstance(est, Boost):
        fits = [Fit(str(i), fold, spec) for i, spec in enumerate(grid) for fold in range(k)]
        scored = materialize(boosting.fit_many(folded, fits, LABEL)[1], "tuning")
        groups = ["Model", "fold"]
        found = evaluation.average_precision(evaluation.pr_curve(scored, LABEL, "score", groups), groups).groupBy("Model").agg(F.avg("average_precision").alias("ap")).collect()
        scores = {int(r["Model"]): r["ap"] for r in found}
        points, scores = [json.dumps(asdict(s)) for s in grid], [scores[i] for i in range(len(grid))]
        return Tuned(grid[scores.index(max(scores))], points, scores)
    model = CrossValidator(
        estimator=est, estimatorParamMaps=grid, evaluator=AveragePrecisionEvaluator(), numFolds=k,
        foldCol="fold", parallelism=parallelism,
    ).fit(folded)
    scores = [float(x) for x in model.avgMetrics]
    points = [json.dumps({p.name: v for p, v in g.items()}) for g in grid]
    best = grid[scores.index(max(scores))]
    if isinstance(est, Pipeline):  # the parameters belong to a stage
        return Tuned(Pipeline(stages=[s.copy({p: v for p, v in best.items() if p.parent == s.uid}) for s in est.getStages()]), points, scores)
    return Tuned(est.copy(best), points, scores)


@dataclass
class Trained:
    """A fitted model with the features it expects."""

    name: str
    model: Model | Boosted
    spec: FeatureSpec
    threshold: float = C.BUSINESS_THRESHOLD

    @property
    def has_importances(self) -> bool:
        return hasattr(_last(self.model), "featureImportances")


def fixed_logistic(spark: SparkSession, spec: FeatureSpec, weights: Sequence[float], intercept: float, name: str = "Fixed_Logistic") -> Trained:
    """A logistic model with given coefficients: published weights, or scoring without a fit."""
    sc = spark.sparkContext
    java = sc._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(name, _py2java(sc, Vectors.dense(list(weights))), float(intercept))
    return Trained(name, LogisticRegressionModel(java), spec)


def fit_final(df: DataFrame, name: str, est: Estimator | Boost, spec: FeatureSpec | None = None, test: float = 0.2) -> tuple[Trained, DataFrame]:
    """Fit on the training split; returns the model and the scored hold-out rows."""
    spec = spec or fit_features(df)
    train, held = splits.stratified_split(df, C.TARGET, test, KEYS)
    model = est.fit(training_table(train, spec))
    trained = Trained(name, model, spec)
    scored = score_rows(held, trained).select(
        *KEYS, F.col(C.TARGET).cast("int").alias(LABEL), F.col("probability_1").alias("score")
    )
    return trained, materialize(scored, "holdout")


@dataclass
class Chosen:
    """The outcome of a whole training: comparison, search, final model and its scored hold-out rows."""

    trained: Trained
    held: DataFrame
    comparison: DataFrame
    tuning: DataFrame


def choose(df: DataFrame, models: dict[str, Estimator | Boost], grid_of=grids) -> Chosen:
    """Compare the candidates, search around the best one and fit it with the parameters found; the operating threshold is the reference point."""
    spec = fit_features(df)
    table = training_table(df, spec, stored=False)
    comparison = materialize(compare_models(table, models), "comparison")
    winner = comparison.orderBy(F.col("Mean_PR_AUC").desc(), "Model").first()["Model"]
    found = tune(table, models[winner], grid_of(winner, models[winner]))
    trained, held = fit_final(df, winner, found.best, spec)
    return Chosen(trained, held, comparison, found.table(df.sparkSession))


def score_rows(df: DataFrame, trained: Trained) -> DataFrame:
    """Input columns plus ``probability_1``; plain task-parallel transform, no chunks."""
    out = probability(trained.model.transform(trained.spec.vectors(df)))
    return out.select(*[F.col(f"`{c}`") for c in df.columns], "probability_1")


def score(df: DataFrame, trained: Trained | None) -> DataFrame:
    """``collection_probability`` from the model, or NULL (rule fallback) without one."""
    if trained is None:
        return df.withColumn("collection_probability", F.lit(None).cast("double"))
    return score_rows(df, trained).withColumnRenamed("probability_1", "collection_probability")


def score_claims(records: DataFrame, trained: Trained, threshold: float | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Batch claim scoring: partial records in, probability, tier, action and factors out."""
    threshold = trained.threshold if threshold is None else threshold
    ready = trained.spec.encode(claims_api.complete_claims(records))
    absent = [n for n in trained.spec.names if n not in ready.columns]
    ready = ready.withColumns({n: F.lit(0.0) for n in absent}) if absent else ready
    vectors = encoding.assemble(ready, trained.spec.names)
    return claims_api.describe_scores(
        probability(trained.model.transform(vectors)), trained.spec.names, threshold, trained.name, keep
    )


def save_model(trained: Trained, path: str) -> None:
    boosted = isinstance(trained.model, Boosted)
    if boosted:
        boosting.save(trained.model, f"{path}/model")
    else:
        model = trained.model if isinstance(trained.model, PipelineModel) else PipelineModel(stages=[trained.model])
        model.write().overwrite().save(f"{path}/model")
    text = json.dumps({"name": trained.name, "threshold": trained.threshold, "boosted": boosted, "spec": asdict(trained.spec)})
    spark = SparkSession.active()
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/features")


def load_model(spark: SparkSession, path: str) -> Trained:
    saved = json.loads(spark.read.text(f"{path}/features", wholetext=True).first()["value"])
    model = boosting.load(spark, f"{path}/model") if saved.get("boosted") else PipelineModel.load(f"{path}/model")
    return Trained(saved["name"], model, FeatureSpec(**saved["spec"]), saved["threshold"])


def retune(spark: SparkSession, path: str, df: DataFrame, test: float = 0.2) -> DataFrame:
    """Threshold table of a saved model on its hold-out rows, without refitting."""
    trained = load_model(spark, path)
    _, held = splits.stratified_split(df, C.TARGET, test, KEYS)
    scored = materialize(score_rows(held, trained).select(
        F.col(C.TARGET).cast("int").alias(LABEL), F.col("probability_1").alias("score")), "retune")
    return evaluation.threshold_table(scored, evaluation.pr_curve(scored))


def _last(model: Model) -> Model:
    return model.stages[-1] if isinstance(model, PipelineModel) else model


def _weights_table(spark: SparkSession, names: Sequence[str], values: Sequence[float], value: str) -> DataFrame:
    schema = T.StructType([T.StructField("Feature", T.StringType()), T.StructField(value, T.DoubleType())])
    return spark.createDataFrame([(n, float(v)) for n, v in zip(names, values)], schema)


def coefficients(trained: Trained) -> DataFrame:
    """Signed logistic coefficients, largest magnitude first."""
    table = _weights_table(SparkSession.active(), trained.spec.names, _last(trained.model).coefficients.toArray(), "Coefficient")
    return table.orderBy(F.abs("Coefficient").desc(), "Feature")


def importances(trained: Trained) -> DataFrame:
    """Built-in tree importances, largest first."""
    table = _weights_table(SparkSession.active(), trained.spec.names, _last(trained.model).featureImportances.toArray(), "Importance")
    return table.orderBy(F.col("Importance").desc(), "Feature")


def permutation_importance(trained: Trained, df: DataFrame, n_repeats: int = 5, seed: int = 42, target: str = C.TARGET) -> DataFrame:
    """Mean drop of average precision when one feature is shuffled, over all rows of ``df``.

    Rows are put in a random (hash) order once, and a repeat shuffles by rotating that order: each row is stored
    beside the rows it takes values from. One pass per feature then exchanges a single entry and collapses to
    counts per distinct score on the map side. Features the model never uses cannot change a score and are skipped.
    """
    table = trained.spec.vectors(df).select(*KEYS, F.col(target).cast("int").alias(LABEL), vector_to_array("features").alias("x"))
    hashed = table.withColumn("_h", S.row_hash(KEYS, seed + 1))
    ranked = materialize(global_rank(hashed, [F.col("_h"), *[F.col(k) for k in KEYS]], "r").select("r", LABEL, "x"), "permuted")
    n, names = ranked.count(), trained.spec.names
    if n == 0:
        return _weights_table(df.sparkSession, [], [], "Importance")
    beside = ranked
    for rep in range(n_repeats):
        by = 1 + (7919 * (rep + 1) + seed) % max(n - 1, 1)
        other = ranked.select((F.pmod(F.col("r") - 1 + by, F.lit(n)) + 1).alias("r"), F.col("x").alias(f"y{rep}"))
        beside = beside.join(other, "r")
    beside = materialize(beside, "shuffled")

    def counted(rows: DataFrame, j: int) -> DataFrame:
        """rows (label, rep, x) -> positives and negatives per distinct score."""
        scored = probability(trained.model.transform(rows.select(LABEL, "rep", array_to_vector("x").alias("features"))))
        return scored.groupBy("rep", F.lit(j).alias("j"), F.col("probability_1").alias("threshold")).agg(
            F.count_if(F.col(LABEL) == 1).alias("pos"), F.count_if(F.col(LABEL) == 0).alias("neg"))

    weights = _last(trained.model)
    weights = (weights.featureImportances if hasattr(weights, "featureImportances") else weights.coefficients).toArray()
    used = [j for j in range(len(names)) if weights[j] != 0.0]
    counts = [counted(beside.select(LABEL, F.lit(-1).alias("rep"), "x"), -1)]
    for j in used:
        swapped = F.array(*[F.struct(F.lit(rep).alias("rep"), F.col(f"y{rep}")[j].alias("v")) for rep in range(n_repeats)])
        one = beside.select(LABEL, "x", F.inline(swapped))
        vec = F.concat(F.slice("x", 1, j), F.array("v"), F.slice("x", j + 2, max(len(names) - j - 1, 0)))
        counts.append(counted(one.select(LABEL, "rep", vec.alias("x")), j))
    stored = materialize(counts[0], "permuted-counts")
    for part in counts[1:]:
        stored = stored.unionByName(materialize(part, "permuted-counts"))
    ap = evaluation.average_precision(evaluation.curve_of_counts(stored, ["rep", "j"]), ["rep", "j"])
    base = ap.where(F.col("j") == -1).agg(F.max("average_precision").alias("b")).scalar()
    found = ap.where(F.col("j") >= 0).groupBy("j").agg(F.avg("average_precision").alias("mean_ap"))
    every = df.sparkSession.createDataFrame([(j, c) for j, c in enumerate(names)], "j int, Feature string")
    return every.join(found, "j", "left").select(
        "Feature", F.when(F.col("mean_ap").isNull(), 0.0).otherwise(base - F.col("mean_ap")).alias("Importance")
    ).orderBy(F.col("Importance").desc(), "Feature")
