"""Exact metrics, on the label of the loans and the score they were drawn from, and on lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.loans import loans, with_loans
from checks.registry import query
from tabsmith.operators import evaluate
from tabsmith.plans import loan_features
from tabsmith.session import work_path
from tabsmith.sources import tables

THRESHOLD = 0.2
RISK_SQL = (
    "least(greatest(15e-2 + least(greatest((650e0 - coalesce(credit_score, 600e0)) / 1000e0, -1e-1), 25e-2) "
    "+ least(greatest((50000e0 - coalesce(annual_income, 50000e0)) / 500000e0, -5e-2), 15e-2), 2e-2), 6e-1)"
)
SCORED = (
    f"scored as (select src_ord, case when loan_status = 'Default' then 1 else 0 end as target, "
    f"{RISK_SQL} as score, case when {RISK_SQL} >= 2e-1 then 1 else 0 end as predicted from loans)"
)
CONFUSION = """confusion as (select
  count(*) filter (target = 0 and predicted = 0) as tn, count(*) filter (target = 0 and predicted = 1) as fp,
  count(*) filter (target = 1 and predicted = 0) as fn, count(*) filter (target = 1 and predicted = 1) as tp
  from scored)"""
RATES = """rates as (select *, (tn + tp) / (tn + fp + fn + tp) as accuracy, coalesce(tp / nullif(tp + fp, 0), 0) as precision,
  coalesce(tp / nullif(tp + fn, 0), 0) as recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) as f1 from confusion)"""
CURVE = """curve as (select score, sum(target) as pos, sum(1 - target) as neg from scored group by score),
running as (select *, sum(neg) over (order by score) - neg as neg_before,
  sum(pos) over (order by score desc) as true_above, sum(pos + neg) over (order by score desc) as above from curve),
ranking as (select
  round(cast(sum(pos * (2 * neg_before + neg)) as double) / (2e0 * sum(pos) * sum(neg)), 9) as auc_roc,
  round(sum(cast(pos as double) * cast(true_above as double) / cast(above as double)) / sum(pos), 9) as auc_pr
  from running)"""


def scored(spark, sf_dir):
    df = loans(spark, sf_dir)
    score = loan_features.risk_score(F.col("credit_score"), F.col("annual_income"))
    return df.select("src_ord", loan_features.target_column().alias("target"), score.alias("score"))


@query("risk_score", with_loans("select src_ord, score from scored", SCORED))
def risk_score(spark, sf_dir):
    return scored(spark, sf_dir).select("src_ord", "score")


@query("threshold_labels", with_loans("select src_ord, predicted from scored", SCORED))
def threshold_labels(spark, sf_dir):
    return scored(spark, sf_dir).select(
        "src_ord", evaluate.predict_label(F.col("score"), THRESHOLD).alias("predicted"))


def _predicted(spark, sf_dir):
    return scored(spark, sf_dir).withColumn("predicted", evaluate.predict_label(F.col("score"), THRESHOLD))


@query("class_weight", with_loans("""
select count(*) filter (target = 1) as pos, count(*) filter (target = 0) as neg,
  count(*) filter (target = 0) / greatest(count(*) filter (target = 1), 1) as weight from scored""", SCORED))
def class_weight(spark, sf_dir):
    return evaluate.class_balance(scored(spark, sf_dir), "target")


@query("num_class", "select cast(max(label) + 1 as bigint) as num_class from embeddings")
def num_class(spark, sf_dir):
    return evaluate.class_count(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "label")


@query("argmax_class", "select vec_id, label, list_position(embedding, list_max(embedding)) - 1 as predicted from embeddings")
def argmax_class(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return df.select("vec_id", "label", evaluate.argmax(F.col("embedding")).alias("predicted"))


@query("confusion_matrix", with_loans("select * from confusion", SCORED, CONFUSION))
def confusion_matrix(spark, sf_dir):
    return evaluate.confusion(_predicted(spark, sf_dir), "target", "predicted")


@query("binary_metrics", with_loans("select * from rates", SCORED, CONFUSION, RATES))
def binary_metrics(spark, sf_dir):
    return evaluate.rates(evaluate.confusion(_predicted(spark, sf_dir), "target", "predicted"))


@query("auc_roc", with_loans("select auc_roc from ranking", SCORED, CURVE))
def auc_roc(spark, sf_dir):
    counts = evaluate.score_counts(scored(spark, sf_dir), "target", "score")
    return evaluate.ranking_metrics(counts).select(F.round("auc_roc", 9).alias("auc_roc"))


@query("avg_precision", with_loans("select auc_pr from ranking", SCORED, CURVE))
def avg_precision(spark, sf_dir):
    counts = evaluate.score_counts(scored(spark, sf_dir), "target", "score")
    return evaluate.ranking_metrics(counts).select(F.round("auc_pr", 9).alias("auc_pr"))


@query("metrics_json", with_loans("""
select 'binary' as task_type, auc_roc, auc_pr, accuracy, precision, recall, f1, 2e-1 as threshold, tn, fp, fn, tp
from rates, ranking""", SCORED, CONFUSION, RATES, CURVE))
def metrics_json(spark, sf_dir):
    report = evaluate.binary_report(scored(spark, sf_dir), "target", "score", THRESHOLD)
    path = work_path(spark, "metrics")
    tables.write_json_row(report, path)
    read = spark.read.schema(report.schema).json(path)
    return read.select(
        "task_type", F.round("auc_roc", 9).alias("auc_roc"), F.round("auc_pr", 9).alias("auc_pr"),
        "accuracy", "precision", "recall", "f1", "threshold", "confusion_matrix.*")


@query("log_loss", with_loans("""
select round(avg(-case when target = 1 then ln(score) else ln(1 - score) end), 9) as log_loss from scored""", SCORED))
def log_loss(spark, sf_dir):
    loss = evaluate.log_loss(scored(spark, sf_dir), "target", "score")
    return loss.select(F.round("log_loss", 9).alias("log_loss"))


# three classes, with chances that both engines compute alike
_CHANCES = "cast(l_linenumber % 3 as int) as y, (1 + l_quantity % 5) as a, (1 + l_orderkey % 7) as b, (1 + l_suppkey % 4) as c"


@query("mlogloss", f"""
select round(avg(-ln(case y when 0 then a when 1 then b else c end / cast(a + b + c as double))), 9) as mlogloss
from (select {_CHANCES} from lineitem)""")
def mlogloss(spark, sf_dir):
    parts = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(*_CHANCES.split(", "))
    total = F.col("a") + F.col("b") + F.col("c")
    chances = F.array(*[(F.col(x) / total).cast("double") for x in "abc"])
    loss = evaluate.multiclass_log_loss(parts.withColumn("chances", chances), "y", "chances")
    return loss.select(F.round("mlogloss", 9).alias("mlogloss"))


_ITEMS = "items as (select l_linenumber as y, cast(l_quantity as int) % 7 + 1 as p from lineitem)"
_CLASSES = f"""with {_ITEMS}, classes as (select y as class from items union select p from items),
per_class as (select class, count(*) filter (y = class) as support, count(*) filter (p = class) as predicted,
  count(*) filter (y = class and p = class) as correct from classes, items where y = class or p = class group by class),
rated as (select class, coalesce(correct / nullif(predicted, 0), 0) as precision,
  coalesce(correct / nullif(support, 0), 0) as recall,
  coalesce(2 * correct / nullif(predicted + support, 0), 0) as f1, support, correct from per_class)
"""


def _items(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return df.select(F.col("l_linenumber").alias("y"), (F.col("l_quantity").cast("int") % 7 + 1).alias("p"))


@query("multiclass_metrics", _CLASSES + """
select 'multiclass' as task_type, cast(sum(correct) as double) / sum(support) as accuracy,
  round(avg(f1), 9) as f1_macro, round(sum(f1 * support) / sum(support), 9) as f1_weighted from rated""")
def multiclass_metrics(spark, sf_dir):
    report = evaluate.multiclass_report(_items(spark, sf_dir), "y", "p")
    return report.select("task_type", "accuracy", F.round("f1_macro", 9).alias("f1_macro"),
                         F.round("f1_weighted", 9).alias("f1_weighted"))


@query("class_report", _CLASSES + """
select cast(class as varchar) as class, round(precision, 9) as precision, round(recall, 9) as recall,
  round(f1, 9) as f1, support from rated
union all select 'accuracy', null, null, round(cast(sum(correct) as double) / sum(support), 9), cast(sum(support) as bigint) from rated
union all select 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9), cast(sum(support) as bigint) from rated
union all select 'weighted avg', round(sum(precision * support) / sum(support), 9), round(sum(recall * support) / sum(support), 9),
  round(sum(f1 * support) / sum(support), 9), cast(sum(support) as bigint) from rated""")
def class_report(spark, sf_dir):
    report = evaluate.class_report(_items(spark, sf_dir), "y", "p")
    return report.select("class", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("regression_metrics", """
with fitted as (select l_extendedprice as y, l_quantity * 1500 as p from lineitem)
select 'regression' as task_type, round(sqrt(sum((y - p) * (y - p)) / count(*)), 6) as rmse,
  round(avg(abs(y - p)), 6) as mae, round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 9) as r2 from fitted""")
def regression_metrics(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    fitted = df.select(F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1500).alias("p"))
    report = evaluate.regression_report(fitted, "y", "p")
    return report.select("task_type", F.round("rmse", 6).alias("rmse"), F.round("mae", 6).alias("mae"),
                         F.round("r2", 9).alias("r2"))


@query("group_ranking", """
with r as (
    select l_orderkey as g, 2 * (l_returnflag = 'R')::int + (l_linestatus = 'F')::int as y,
        row_number() over (partition by l_orderkey order by l_discount desc, l_linenumber, l_partkey, l_suppkey, l_extendedprice) as pos,
        row_number() over (partition by l_orderkey order by 2 * (l_returnflag = 'R')::int + (l_linestatus = 'F')::int desc) as ideal
    from lineitem),
p as (select *, sum((y > 0)::int) over (partition by g order by pos) as upto from r),
per_group as (
    select g, sum((pow(2, y) - 1) / log2(pos + 1)) filter (where pos <= 3) as dcg, sum((pow(2, y) - 1) / log2(ideal + 1)) filter (where ideal <= 3) as most,
        sum((y > 0)::int) filter (where pos <= 3) as hits, sum((y > 0)::int * upto / pos) filter (where pos <= 3) as precisions,
        least(sum((y > 0)::int), 3) as possible
    from p group by g)
select count(*) as groups, round(avg(case when most > 0 then dcg / most else 1 end), 9) as ndcg,
    round(avg(case when possible > 0 then precisions / possible else 1 end), 9) as map, round(avg(hits / 3), 9) as precision
from per_group""")
def group_ranking(spark, sf_dir):
    """Orders as groups, their items ranked by discount."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").withColumn(
        "relevance", 2 * (F.col("l_returnflag") == "R").cast("int") + (F.col("l_linestatus") == "F").cast("int"))
    row = evaluate.group_ranking(items, "l_orderkey", "relevance", "l_discount", 3, ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))
    return row.select("groups", *[F.round(c, 9).alias(c) for c in ("ndcg", "map", "precision")])
