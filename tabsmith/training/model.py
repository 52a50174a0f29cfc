"""Train, score and explain boosted trees."""

from __future__ import annotations

import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field, replace

from pyspark import inheritable_thread_target
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.operators import evaluate
from tabsmith.session import shared_dir, ship_package
from tabsmith.training import boosting, objectives

# Objectives by task, and the metrics each task reports when none are named.
OBJECTIVES = {
    "binary": ["binary:logistic", "binary"],
    "multiclass": ["multi:softmax", "multi:softprob", "multiclass", "multiclassova"],
    "regression": ["reg:squarederror", "regression", "regression_l2", "l2", "mse", "rmse"],
    "ranking": ["rank:pairwise", "rank:ndcg", "rank:map", "lambdarank", "rank_xendcg"],
}
# Further objectives that histogram boosting trains, by task, and those that nothing here trains.
OBJECTIVES["binary"] += ["binary:logitraw", "binary:hinge"]
OBJECTIVES["regression"] += [
    "reg:logistic", "cross_entropy", "reg:squaredlogerror", "reg:pseudohubererror", "reg:absoluteerror", "reg:quantileerror", "reg:gamma",
    "reg:tweedie", "count:poisson", "poisson", "gamma", "tweedie", "huber", "fair", "quantile", "regression_l1", "l1",
]
SPARK_ML_OBJECTIVES = {"binary:logistic", "binary", "multi:softmax", "multi:softprob", "multiclass", "multiclassova",
                       "reg:squarederror", "regression", "regression_l2", "l2", "mse", "rmse"}
UNTRAINED = {"cross_entropy_lambda", "survival:cox", "survival:aft", "mape"}
DEFAULT_METRICS = {"binary": ["logloss", "auc"], "multiclass": ["mlogloss"], "regression": ["rmse"]}
# Names of metrics that are columns of the reports under another name.
METRIC_NAMES = {
    "auc": "auc_roc", "auc-roc": "auc_roc", "aucpr": "auc_pr", "auc-pr": "auc_pr", "average_precision": "auc_pr",
    "binary_logloss": "logloss", "multi_logloss": "mlogloss", "l2_root": "rmse", "l1": "mae",
}
LARGER_IS_BETTER = {
    "auc", "map", "ndcg", "aucpr", "pre", "auc_mu", "average_precision",
    "auc_roc", "auc_pr", "accuracy", "precision", "recall", "f1", "f1_macro", "f1_weighted", "r2",
}

# Missing features (a ratio without a denominator) sort below every number, so a split can part them.
MISSING = -1e30


def task_type(objective: str) -> str:
    """'binary', 'multiclass' or 'regression'; ranking needs groups that the table does not have."""
    for task, names in OBJECTIVES.items():
        if objective in names:
            if task == "ranking":
                raise ValueError(f"{objective}: ranking objectives are not supported")
            return task
    known = "it is not trained here" if objective in UNTRAINED else "unknown objective"
    raise ValueError(f"{objective}: {known}")


def larger_is_better(metric: str) -> bool:
    return metric in LARGER_IS_BETTER


def report_column(metric: str) -> str:
    """The report's column for a metric's name in any of the usual spellings."""
    plain = metric.strip().lower()
    return METRIC_NAMES.get(plain, plain.replace("-", "_"))


@dataclass
class TreeParams:
    objective: str = "binary:logistic"
    num_rounds: int = 500
    early_stopping: int = 20  # 0 trains all rounds
    stop_rule: str = "patience"  # stop after early_stopping rounds that are no better; "library": at the first one
    max_depth: int = 7
    learning_rate: float = 0.1
    subsample: float = 0.8
    colsample: float = 0.8
    min_child: int = 5
    max_bins: int = 256
    threshold: float = 0.5
    seed: int = 42
    engine: str = "histogram"  # boosting over binned columns; "spark_ml": Spark's own trees
    reg_lambda: float = 1.0  # this and what follows: "histogram" only
    min_child_weight: float = 0.0
    min_split_gain: float = 0.0
    quantile_alpha: float = 0.5
    tweedie_power: float = 1.5
    huber_delta: float = 1.0
    eval_metric: tuple[str, ...] = ()  # metrics to report besides the task's own; none: all of them

    @property
    def task(self) -> str:
        return task_type(self.objective)


@dataclass
class OneVsRest:
    """A tree model per class, each with rounds of its own."""

    models: list[Model]


@dataclass
class Trained:
    model: Model | OneVsRest | boosting.Boosted
    params: TreeParams
    label: str
    features: list[str]
    rounds: int
    val_losses: list[float] = field(default_factory=list)  # by round: log-loss or RMSE
    seconds: float = 0.0

    @property
    def best_round(self) -> int:
        return self.rounds - 1


def feature_names(df: DataFrame, label: str) -> list[str]:
    return [c for c in df.columns if c != label]


def assemble(df: DataFrame, label: str, features: Sequence[str], weight: float = 1.0) -> DataFrame:
    """(label, features, weight); `weight` is that of the positive class."""
    numbers = [F.coalesce(F.col(c).cast("double"), F.lit(MISSING)).alias(c) for c in features]
    rows = df.select(F.col(label).cast("double").alias(label), *numbers)
    vectors = VectorAssembler(inputCols=list(features), outputCol="features").transform(rows)
    positive = F.when(F.col(label) == 1, F.lit(float(weight))).otherwise(1.0)
    return vectors.select(label, "features", positive.alias("weight"))


def _estimator(p: TreeParams, label: str, rounds: int, validate: bool = False):
    trees = dict(
        featuresCol="features", labelCol=label, maxIter=rounds, maxDepth=p.max_depth,
        stepSize=p.learning_rate, subsamplingRate=p.subsample, featureSubsetStrategy=str(p.colsample),
        minInstancesPerNode=p.min_child, maxBins=p.max_bins, seed=p.seed,
        checkpointInterval=10, maxMemoryInMB=512,
    )
    if validate:
        # the library's rule: a round that is worse than the best so far ends the run, which keeps the best
        trees |= dict(validationIndicatorCol=IS_VAL, validationTol=0.0)
    if p.task == "regression":
        return GBTRegressor(lossType="squared", **trees)
    return GBTClassifier(**trees, **({"weightCol": "weight"} if p.task == "binary" else {}))


IS_VAL = "is_val_row"


def _losses(model: Model, val: DataFrame, task: str) -> list[float]:
    if task == "regression":
        return [x**0.5 for x in model.evaluateEachIteration(val, "squared")]
    # the loss of the library is twice the log-loss of its probability
    return [x / 2 for x in model.evaluateEachIteration(val)]


def first_trees(model: Model, n: int) -> Model:
    """The model that a run of `n` rounds would have given."""
    if n >= model.getNumTrees:
        return model
    java, context = model._java_obj, SparkSession.active().sparkContext
    package = context._jvm.org.apache.spark.ml
    trees = context._gateway.new_array(package.regression.DecisionTreeRegressionModel, n)
    weights = context._gateway.new_array(context._jvm.double, n)
    for i, (tree, weight) in enumerate(zip(java.trees()[:n], java.treeWeights()[:n])):
        trees[i], weights[i] = tree, weight
    if isinstance(model, GBTClassificationModel):
        cut = package.classification.GBTClassificationModel(java.uid(), trees, weights, java.numFeatures(), java.numClasses())
    else:
        cut = package.regression.GBTRegressionModel(java.uid(), trees, weights, java.numFeatures())
    java.copyValues(cut, package.param.ParamMap.empty())
    return type(model)(cut)


def stop_round(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """(best round, whether `patience` rounds passed without a better one)."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            return best, True
    return best, False


def _fit_until_worse(p: TreeParams, label: str, train: DataFrame, val: DataFrame):
    """Fit in growing runs until `early_stopping` rounds bring no better validation loss.

    A run with the same seed repeats the trees of a shorter run, so the first trees
    of the last run are the model that one endless run had at its best round.
    """
    rounds = min(p.num_rounds, 2 * p.early_stopping)
    while True:
        model = _estimator(p, label, rounds).fit(train)
        losses = _losses(model, val, p.task)
        best, stopped = stop_round(losses, p.early_stopping)
        if stopped or rounds == p.num_rounds:
            return first_trees(model, best + 1), losses
        rounds = min(p.num_rounds, 2 * rounds)


def _fit_one(p: TreeParams, label: str, train: DataFrame, val: DataFrame | None) -> tuple[Model, list[float]]:
    """A model and the validation loss of each round that it keeps or looked at."""
    if val is None or not p.early_stopping:
        return _estimator(p, label, p.num_rounds).fit(train), []
    if p.stop_rule == "patience":
        return _fit_until_worse(p, label, train, val)
    if p.stop_rule != "library":
        raise ValueError(f"stop_rule {p.stop_rule}: use library or patience")
    both = train.withColumn(IS_VAL, F.lit(False)).unionByName(val.withColumn(IS_VAL, F.lit(True)))
    model = _estimator(p, label, p.num_rounds, validate=True).fit(both)
    return model, _losses(model, val, p.task)


def _fit_classes(p: TreeParams, label: str, train: DataFrame, val: DataFrame | None, parallel: int) -> OneVsRest:
    """One binary fit per class, side by side as jobs of one application."""
    classes = int(evaluate.class_count(train, label).first()["num_class"])

    def fit(k: int) -> Model:
        own = lambda df: df if df is None else df.withColumn(label, (F.col(label) == k).cast("double"))
        return _fit_one(p, label, own(train), own(val))[0]

    with ThreadPoolExecutor(parallel) as pool:
        jobs = [pool.submit(inheritable_thread_target(train.sparkSession)(fit), k) for k in range(classes)]
        return OneVsRest([j.result() for j in jobs])


def train(
    train_df: DataFrame,
    val_df: DataFrame | None,
    label: str,
    params: TreeParams | None = None,
    positive_weight: float | None = None,
    parallel: int = 4,
) -> Trained:
    """Fit trees; positives of a binary label are weighted by negatives / positives.

    With validation rows the fit stops early by `stop_rule`. The histogram engine boosts all classes
    against one softmax; Spark's own trees fit one model per class, each with its own stop.
    """
    p = params or TreeParams()
    task = p.task
    start = time.time()
    spark = ship_package(train_df.sparkSession)
    if p.engine not in ("histogram", "spark_ml"):
        raise ValueError(f"engine {p.engine}: use histogram or spark_ml")
    if p.stop_rule not in ("library", "patience"):
        raise ValueError(f"stop_rule {p.stop_rule}: use library or patience")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    features = feature_names(train_df, label)
    weight = 1.0
    if task == "binary":
        weight = positive_weight
        if weight is None:
            weight = evaluate.class_balance(train_df, label).first()["weight"]
    if p.engine == "histogram" and p.objective != "multiclassova":
        settings = replace(p, early_stopping=min(p.early_stopping, 1)) if p.stop_rule == "library" else p
        boosted = boosting.fit(train_df, val_df, label, features, settings, float(weight))
        return Trained(boosted, p, label, features, len(boosted.rounds), boosted.val_losses or [], time.time() - start)
    if p.objective not in SPARK_ML_OBJECTIVES:
        raise ValueError(f"{p.objective}: only the histogram engine trains it")
    # not persisted: the fit makes a binned copy of its own in a few passes and boosts on that
    rows = assemble(train_df, label, features, weight)
    val = None if val_df is None else assemble(val_df, label, features)
    if task == "multiclass":
        model, losses = _fit_classes(p, label, rows, val, parallel), []
        rounds = max(m.getNumTrees for m in model.models)
    else:
        model, losses = _fit_one(p, label, rows, val)
        rounds = model.getNumTrees
    return Trained(model, p, label, features, rounds, losses, time.time() - start)


def _score_boosted(trained: Trained, df: DataFrame) -> DataFrame:
    predicted = boosting.predict(trained.model, df)
    value = F.col(predicted.columns[-1])
    if trained.params.task == "multiclass":
        return predicted.select(*df.columns, value.alias("probabilities"), evaluate.argmax(value).alias("predicted"))
    scored = predicted.select(*df.columns, value[0].alias("score"))
    if trained.params.task == "binary":
        # raw margins have no threshold of their own: a margin of 0 is a probability of one half
        at = 0.0 if trained.params.objective == "binary:logitraw" else trained.params.threshold
        scored = scored.withColumn("predicted", evaluate.predict_label(F.col("score"), at))
    return scored


def trees(trained: Trained) -> DataFrame:
    """Every node of a boosted model: round, class, node, parent, place, feature, threshold, sides, value, gain, cover, rows."""
    return SparkSession.active().createDataFrame(boosting.tree_rows(trained.model), boosting.TREE_TABLE)


#: Kinds of importance: splits of a feature, their mean and total gain, their mean and total weight.
IMPORTANCE = {
    "weight": F.count, "gain": F.avg, "total_gain": F.sum, "cover": F.avg, "total_cover": F.sum,
}


def importance_of_trees(nodes: DataFrame, features: Sequence[str], kind: str = "total_gain") -> DataFrame:
    """(feature, importance), highest first, from a table of trees. Unused features have 0."""
    column = "cover" if "cover" in kind else "gain"
    used = nodes.filter("feature is not null").groupBy("feature").agg(IMPORTANCE[kind](column).cast("double").alias("importance"))
    names = nodes.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    return names.join(used, "feature", "left").select(
        "feature", F.coalesce("importance", F.lit(0.0)).alias("importance")).orderBy(F.desc("importance"), "feature")


def score(trained: Trained, df: DataFrame) -> DataFrame:
    """`df` with `score` (binary probability or predicted number) or `predicted` and `probabilities`."""
    if isinstance(trained.model, boosting.Boosted):
        return _score_boosted(trained, df)
    names = [F.coalesce(F.col(c).cast("double"), F.lit(MISSING)) for c in trained.features]
    inputs = [f"_x{i}" for i in range(len(names))]
    wide = df.withColumns(dict(zip(inputs, names)))
    vectors = VectorAssembler(inputCols=inputs, outputCol="features").transform(wide).drop(*inputs)
    task = trained.params.task
    if task == "multiclass":
        out = vectors
        for k, one in enumerate(trained.model.models):
            margins = one.copy().setRawPredictionCol(f"_raw{k}").setPredictionCol(f"_pre{k}").setProbabilityCol(f"_pro{k}")
            out = margins.transform(out)
        raw = F.array(*[vector_to_array(f"_raw{k}")[1] for k in range(len(trained.model.models))])
        chances = F.transform(raw, lambda m: 1 / (1 + F.exp(-2 * m)))
        with_chances = out.select(*df.columns, chances.alias("_chances"))
        total = F.aggregate("_chances", F.lit(0.0), lambda a, x: a + x)
        return with_chances.select(
            *df.columns,
            F.transform("_chances", lambda x: x / total).alias("probabilities"),
            evaluate.argmax(F.col("_chances")).alias("predicted"),
        )
    out = trained.model.transform(vectors)
    if task == "binary":
        p = vector_to_array("probability")[1]
        return out.select(*df.columns, p.alias("score")).withColumn(
            "predicted", evaluate.predict_label(F.col("score"), trained.params.threshold))
    return out.select(*df.columns, F.col("prediction").alias("score"))


def report(trained: Trained, scored: DataFrame) -> DataFrame:
    """The metrics of the task in one row; `eval_metric` chooses among them."""
    if trained.params.task == "binary":
        row = evaluate.binary_report(scored, trained.label, "score", trained.params.threshold)
    elif trained.params.task == "multiclass":
        row = evaluate.multiclass_report(scored, trained.label, "predicted", "probabilities")
    else:
        row = evaluate.regression_report(scored, trained.label, "score")
    wanted = [report_column(m) for m in trained.params.eval_metric]
    unknown = [m for m in wanted if m not in row.columns]
    if unknown:
        raise ValueError(f"no such metric of a {trained.params.task} model: {', '.join(unknown)}")
    facts = [c for c in row.columns if c in ("task_type", "threshold", "confusion_matrix")]
    return row.select(*facts, *[c for c in row.columns if c in wanted and c not in facts]) if wanted else row


def round_losses(trained: Trained) -> DataFrame:
    """(round, loss): the validation loss after each round that was looked at, in the objective's own metric."""
    rows = [(i, float(x)) for i, x in enumerate(trained.val_losses)]
    return SparkSession.active().createDataFrame(rows, "round int, loss double")


def scores_by_round(trained: Trained, df: DataFrame) -> DataFrame:
    """(label, round, score or probabilities): one row per row of `df` and round."""
    predicted = boosting.predict(trained.model, df, by_round=True)
    rows = predicted.select(F.col(trained.label).alias("label"), F.posexplode(predicted.columns[-1]).alias("round", "p"))
    return rows.select("label", "round", F.col("p").alias("probabilities") if trained.params.task == "multiclass" else F.col("p")[0].alias("score"))


def metric_curves(trained: Trained, parts: dict[str, DataFrame]) -> DataFrame:
    """(part, round, metric, value): the task's metrics after every round, on the rows of each part.

    Binary: logloss and auc_roc, regression: rmse and mae, multiclass: mlogloss and accuracy. One pass scores a row for
    all rounds; the AUC goes by totals along (round, score), so no round is sorted in one task.
    """
    out = None
    for part, df in parts.items():
        rows = scores_by_round(trained, df)
        if trained.params.task == "binary":
            curve = evaluate.binary_curves(rows)
        elif trained.params.task == "multiclass":
            p = F.get("probabilities", F.col("label").cast("int"))
            curve = rows.groupBy("round").agg(
                F.avg(-F.ln(F.greatest(p, F.lit(1e-15)))).alias("mlogloss"),
                F.avg((evaluate.argmax(F.col("probabilities")) == F.col("label")).cast("double")).alias("accuracy"))
        else:
            gap = F.col("score") - F.col("label")
            curve = rows.groupBy("round").agg(F.sqrt(F.avg(gap * gap)).alias("rmse"), F.avg(F.abs(gap)).alias("mae"))
        names = [c for c in curve.columns if c != "round"]
        long = curve.unpivot("round", names, "metric", "value").select(F.lit(part).alias("part"), "round", "metric", "value")
        out = long if out is None else out.unionByName(long)
    return out


def run_report(trained: Trained, scored: DataFrame, train_rows: int, val_rows: int, total_seconds: float) -> DataFrame:
    """`report` with the facts of the run: rounds, rows, times and the best validation loss."""
    context = scored.sparkSession.sparkContext
    row = report(trained, scored).withColumns({
        "best_round": F.lit(trained.best_round).cast("bigint"),
        "train_rows": F.lit(train_rows).cast("bigint"),
        "val_rows": F.lit(val_rows).cast("bigint"),
        "n_features": F.lit(len(trained.features)).cast("bigint"),
        "distributed": F.lit(not context.master.startswith("local")),
        "num_workers": F.lit(context.defaultParallelism).cast("bigint"),
        "training_time_s": F.lit(round(trained.seconds, 1)),
        "total_time_s": F.lit(round(total_seconds, 1)),
    })
    if trained.val_losses:
        name = "best_val_" + DEFAULT_METRICS[trained.params.task][0]
        if isinstance(trained.model, boosting.Boosted) and trained.params.task != "multiclass":
            name = "best_val_" + objectives.metric_of(trained.params.objective)
        row = row.withColumn(name, F.lit(float(min(trained.val_losses))))
    return row


def params_row(trained: Trained) -> dict:
    return {**asdict(trained.params), "actual_rounds": trained.rounds}


def importance(trained: Trained, kind: str | None = None) -> DataFrame:
    """(feature, importance), highest first; the share of the total gain, or a `kind` of IMPORTANCE. Unused features have 0."""
    spark = SparkSession.active()
    if isinstance(trained.model, boosting.Boosted):
        found = importance_of_trees(trees(trained), trained.features, kind or "total_gain")
        if kind:
            return found
        total = found.agg(F.sum("importance")).scalar()
        return found.select("feature", F.coalesce(F.try_divide("importance", total), F.lit(0.0)).alias("importance")).orderBy(
            F.desc("importance"), "feature")
    if kind:
        raise ValueError("kinds of importance need the histogram engine")
    models = trained.model.models if trained.params.task == "multiclass" else [trained.model]
    totals = [sum(m.featureImportances[i] for m in models) / len(models) for i in range(len(trained.features))]
    pairs = [(name, float(x)) for name, x in zip(trained.features, totals)]
    return spark.createDataFrame(pairs, "feature string, importance double").orderBy(
        F.desc("importance"), "feature")


def compare_models(reports: dict[str, DataFrame], metric: str) -> DataFrame:
    """The metric rows of several models under their names, best first."""
    rows = None
    for name, row in reports.items():
        named = row.withColumn("model", F.lit(name))
        rows = named if rows is None else rows.unionByName(named, allowMissingColumns=True)
    order = F.desc(metric) if larger_is_better(metric) else F.asc(metric)
    return rows.select("model", *[c for c in rows.columns if c != "model"]).orderBy(order, "model")
