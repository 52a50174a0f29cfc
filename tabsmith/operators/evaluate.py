"""Exact evaluation of predictions. Labels and scores stay distributed; results are a few rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.functions.numeric import clip, ratio_or_zero
from tabsmith.operators.ordering import running_totals
from tabsmith.session import stage

_COUNT = "decimal(38,0)"  # products of row counts do not fit a bigint at scale


def class_balance(df: DataFrame, label: str, sample_rows: int | None = None) -> DataFrame:
    """Rows of label 1 and 0, and the weight that evens them out. `sample_rows` counts that many only."""
    rows = df.select(label)
    if sample_rows is not None:
        rows = rows.limit(sample_rows)
    counts = rows.agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    return counts.withColumn("weight", F.col("neg") / F.greatest(F.col("pos"), F.lit(1)))


def class_count(df: DataFrame, label: str) -> DataFrame:
    return df.agg((F.max(label) + 1).cast("bigint").alias("num_class"))


def predict_label(score: Column, threshold: float) -> Column:
    return (score >= threshold).cast("int")


def argmax(values: Column) -> Column:
    """Position of the largest entry of an array, from 0; the first one on a tie."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def confusion(df: DataFrame, label: str, predicted: str) -> DataFrame:
    y, p = F.col(label) == 1, F.col(predicted) == 1
    return df.agg(
        F.count_if(~y & ~p).alias("tn"), F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"), F.count_if(y & p).alias("tp"),
    )


def rates(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 of a confusion row; 0 where a rate has no rows."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return counts.withColumns({
        "accuracy": ratio_or_zero(tn + tp, tn + fp + fn + tp),
        "precision": ratio_or_zero(tp, tp + fp),
        "recall": ratio_or_zero(tp, tp + fn),
        "f1": ratio_or_zero(2 * tp, 2 * tp + fp + fn),
    })


def score_counts(df: DataFrame, label: str, score: str, digits: int | None = None) -> DataFrame:
    """(score, pos, neg), one row per distinct score, written once and read by the steps that need it.

    `digits` rounds the scores first: fewer rows, slightly different results.
    """
    value = F.col(score).cast("double") if digits is None else F.round(F.col(score).cast("double"), digits)
    counts = df.groupBy(value.alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    return stage(counts, "score-counts")


def ranking_metrics(counts: DataFrame) -> DataFrame:
    """AUC-ROC (ties count one half) and average precision (step sum) of a score_counts table.

    With only one class the AUC is NULL; without positives the average precision is 0.
    """
    ordered = running_totals(counts, ["score"], ["pos", "neg"])
    all_pos = counts.agg(F.sum("pos").cast(_COUNT)).scalar()
    all_neg = counts.agg(F.sum("neg").cast(_COUNT)).scalar()
    pos, neg = F.col("pos").cast(_COUNT), F.col("neg").cast(_COUNT)
    # rows at or above this score
    true_above = all_pos - F.col("pos_before")
    above = true_above + all_neg - F.col("neg_before")
    sums = ordered.select(
        "pos", "neg",
        # twice the number of (positive, negative) pairs in the right order
        (pos * (2 * F.col("neg_before") + neg)).cast(_COUNT).alias("twice"),
        (F.col("pos") * (true_above.cast("double") / above.cast("double"))).alias("precision"),
    ).agg(
        F.sum("twice").cast("double").alias("twice"), F.sum("precision").alias("precision"),
        F.sum("pos").cast("double").alias("pos"), F.sum("neg").cast("double").alias("neg"),
    )
    return sums.select(
        F.try_divide(F.col("twice"), 2 * F.col("pos") * F.col("neg")).alias("auc_roc"),
        ratio_or_zero(F.col("precision"), F.col("pos")).alias("auc_pr"),
    )


def binary_curves(rows: DataFrame) -> DataFrame:
    """(round, logloss, auc_roc) of rows (label, round, score)."""
    counts = stage(rows.groupBy("round", "score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")), "round-score-counts")
    ordered = running_totals(counts, ["round", "score"], ["pos", "neg"])
    p = clip(F.col("score"), 1e-15, 1 - 1e-15)
    pos, neg = F.col("pos").cast(_COUNT), F.col("neg").cast(_COUNT)
    # what lies before a round is taken off at the end: twice (pairs) = sum pos * (2 * neg before + neg)
    sums = ordered.groupBy("round").agg(
        F.sum((pos * (2 * F.col("neg_before") + neg)).cast(_COUNT)).alias("twice"), F.min("neg_before").alias("before"),
        F.sum(pos).alias("pos"), F.sum(neg).alias("neg"),
        (-(F.sum(F.col("pos") * F.ln(p)) + F.sum(F.col("neg") * F.ln(1 - p)))).alias("loss"))
    pairs = (F.col("twice") - (2 * F.col("before") * F.col("pos")).cast(_COUNT)).cast("double")
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    return sums.select(
        "round", F.try_divide("loss", pos + neg).alias("logloss"), F.try_divide(pairs, 2 * pos * neg).alias("auc_roc"))


def binary_report(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """All binary metrics in one row; the scored table is read once."""
    counts = score_counts(df, label, score)
    high = F.col("score") >= threshold
    matrix = counts.agg(*[
        F.coalesce(F.sum(F.when(side, F.col(c))), F.lit(0)).alias(name)
        for name, side, c in (
            ("tn", ~high, "neg"), ("fp", high, "neg"), ("fn", ~high, "pos"), ("tp", high, "pos"))
    ])
    ranking = ranking_metrics(counts).select(F.struct("auc_roc", "auc_pr")).scalar()
    return rates(matrix).select(
        F.lit("binary").alias("task_type"),
        ranking["auc_roc"].alias("auc_roc"), ranking["auc_pr"].alias("auc_pr"),
        "accuracy", "precision", "recall", "f1", F.lit(float(threshold)).alias("threshold"),
        log_loss_of_counts(counts).scalar().alias("logloss"),
        F.struct("tn", "fp", "fn", "tp").alias("confusion_matrix"),
    )


def log_loss_of_counts(counts: DataFrame, margin: float = 1e-15) -> DataFrame:
    """log_loss of a score_counts table."""
    p = clip(F.col("score"), margin, 1 - margin)
    total = -(F.sum(F.col("pos") * F.ln(p)) + F.sum(F.col("neg") * F.ln(1 - p)))
    return counts.agg(F.try_divide(total, F.sum(F.col("pos") + F.col("neg"))).alias("logloss"))


def log_loss(df: DataFrame, label: str, probability: str, margin: float = 1e-15) -> DataFrame:
    """Mean negative log-likelihood of a 0/1 label."""
    p = clip(F.col(probability), margin, 1 - margin)
    return df.agg(F.avg(-F.when(F.col(label) == 1, F.ln(p)).otherwise(F.ln(1 - p))).alias("log_loss"))


def multiclass_log_loss(df: DataFrame, label: str, probabilities: str, margin: float = 1e-15) -> DataFrame:
    """Mean negative log-probability of the right class; `probabilities` is an array by class."""
    p = F.element_at(F.col(probabilities), F.col(label).cast("int") + 1)
    return df.agg(F.avg(-F.ln(clip(p, margin, 1 - margin))).alias("mlogloss"))


def class_counts(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """(class, support, predicted, correct); the table is combined to pairs of classes first."""
    pairs = df.groupBy(F.col(label).alias("y"), F.col(predicted).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(0).cast("bigint")
    hit = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(none)
    roles = F.array(
        F.struct(F.col("y").alias("class"), F.col("n").alias("support"), none.alias("predicted"), hit.alias("correct")),
        F.struct(F.col("p").alias("class"), none.alias("support"), F.col("n").alias("predicted"), none.alias("correct")),
    )
    return pairs.select(F.inline(roles)).groupBy("class").agg(
        *[F.sum(c).alias(c) for c in ("support", "predicted", "correct")]
    )


def class_rates(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 per class; 0 where a rate has no rows."""
    hit, support, predicted = F.col("correct"), F.col("support"), F.col("predicted")
    return counts.select(
        "class",
        ratio_or_zero(hit, predicted).alias("precision"),
        ratio_or_zero(hit, support).alias("recall"),
        ratio_or_zero(2 * hit, predicted + support).alias("f1"),
        "support", "correct",
    )


def multiclass_report(df: DataFrame, label: str, predicted: str, probabilities: str | None = None) -> DataFrame:
    """Accuracy, plain and support-weighted mean F1, and mlogloss where there are probabilities, in one row."""
    per_class = class_rates(class_counts(df, label, predicted))
    row = per_class.agg(
        F.lit("multiclass").alias("task_type"),
        ratio_or_zero(F.sum("correct"), F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("f1_macro"),
        ratio_or_zero(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("f1_weighted"),
    )
    if probabilities is None:
        return row
    return row.withColumn("mlogloss", multiclass_log_loss(df, label, probabilities).scalar())


def class_report(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """One row per class, then accuracy (in f1), macro and weighted means."""
    per_class = class_rates(class_counts(df, label, predicted))
    names = ("precision", "recall", "f1")
    total = F.sum("support")
    means = per_class.agg(
        *[F.avg(c).alias(f"macro_{c}") for c in names],
        *[ratio_or_zero(F.sum(F.col(c) * F.col("support")), total).alias(f"weighted_{c}") for c in names],
        ratio_or_zero(F.sum("correct"), total).alias("accuracy"),
        total.alias("support"),
    )
    missing = F.lit(None).cast("double")

    def line(name: str, *values: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"), *[v.alias(n) for n, v in zip(names, values)], F.col("support"))

    summary = means.select(F.inline(F.array(
        line("accuracy", missing, missing, F.col("accuracy")),
        line("macro avg", *[F.col(f"macro_{c}") for c in names]),
        line("weighted avg", *[F.col(f"weighted_{c}") for c in names]),
    )))
    return per_class.select(F.col("class").cast("string"), *names, "support").unionByName(summary)


def regression_report(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """RMSE, MAE and R2; R2 of a constant label is 1 for perfect predictions, else 0."""
    y, p = F.col(label).cast("double"), F.col(predicted).cast("double")
    sums = df.agg(
        F.sum((y - p) * (y - p)).alias("sse"), F.avg(F.abs(y - p)).alias("mae"),
        (F.var_pop(y) * F.count(y)).alias("sst"), F.count(y).alias("n"),
    )
    sse, sst = F.col("sse"), F.col("sst")
    return sums.select(
        F.lit("regression").alias("task_type"),
        F.sqrt(F.try_divide(sse, F.col("n"))).alias("rmse"),
        "mae",
        F.when(sst > 0, 1 - sse / sst).when(sse == 0, 1.0).otherwise(0.0).alias("r2"),
    )


def group_ranking(
    df: DataFrame, group: str, label: str, score: str, k: int = 10, ties: tuple[str, ...] = (), without_hits: float = 1.0,
) -> DataFrame:
    """(groups, ndcg, map, precision) at `k`, the mean over groups, in one row.

    Rows rank by score within their group, the highest first, then by `ties`. The gain of a label is 2^label - 1; a label above 0 is a
    hit. Groups without a hit count with `without_hits` in ndcg and map. Only a group's first k rows by score and by label
    are shuffled from each task, so a hot group costs k rows per task. Rows without a group are left out.
    """
    rows = df.filter(F.col(group).isNotNull()).select(F.col(group).alias("g"), F.col(label).cast("double").alias("y"), F.col(score).alias("s"), *[F.col(c).alias(f"t{i}") for i, c in enumerate(ties)])
    tied = [f"t{i}" for i in range(len(ties))]
    at = lambda *order: F.row_number().over(Window.partitionBy("g").orderBy(*order))
    discount = 1.0 / F.log2(F.col("at") + 1)
    gain = (F.pow(F.lit(2.0), F.col("y")) - 1) * discount
    hit = (F.col("y") > 0).cast("double")
    best = rows.withColumn("at", at(F.desc("s"), *tied)).filter(F.col("at") <= k)
    hits_upto = F.sum(hit).over(Window.partitionBy("g").orderBy("at"))
    found = best.withColumn("upto", hits_upto).groupBy("g").agg(
        F.sum(gain).alias("dcg"), F.sum(hit).alias("hits"), F.sum(hit * F.col("upto") / F.col("at")).alias("precisions"))
    ideal = rows.select("g", "y").withColumn("at", at(F.desc("y"))).filter(F.col("at") <= k).groupBy("g").agg(
        F.sum(gain).alias("most"), F.sum(hit).alias("possible"))  # hits up to k
    joined = found.join(ideal, "g")
    none = F.lit(float(without_hits))
    return joined.agg(
        F.count(F.lit(1)).alias("groups"),
        F.avg(F.when(F.col("most") > 0, F.col("dcg") / F.col("most")).otherwise(none)).alias("ndcg"),
        F.avg(F.when(F.col("possible") > 0, F.col("precisions") / F.col("possible")).otherwise(none)).alias("map"),
        F.avg(F.col("hits") / k).alias("precision"))
