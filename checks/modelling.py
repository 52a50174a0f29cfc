"""Training, scoring and tuning on the loan features.

What SQL cannot know (a loss, an AUC) is held against its bounds; rows, classes, features and
trials are compared exactly.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import functions as F

from checks import sql_parts as sql
from checks.fitting import staged_and_fitted
from checks.registry import query
from tabsmith.operators import split
from tabsmith.plans import loan_features, loan_preset as preset
from tabsmith.session import stage
from tabsmith.training import model, tune

# the searches and comparisons fit several models: the rounds are few, the rows are all
SHORT = model.TreeParams(num_rounds=5, early_stopping=0, max_depth=3, max_bins=64)
_PARTS = """parts as (select *, cast('0x' || substr(md5(loan_id), 1, 8) as bigint) % 1000 < 200 as is_val,
  case when loan_status = 'Default' then 1 else 0 end as target from cleaned)"""


def _parts_sql(text: str) -> str:
    return sql.cleaned_sql(text).replace("\nselect", f", {_PARTS}\nselect", 1)


@lru_cache(maxsize=4)
def _train_val(spark, sf_dir):
    """(train, val) of the feature table, written once per session and folder."""
    df, state = staged_and_fitted(spark, sf_dir)
    both = split.parts(split.hash_split(df, "loan_id", 0.2))
    return tuple(stage(loan_features.transform(part, state), "features") for part in both)


def _trained(spark, sf_dir, params=SHORT):
    train, val = _train_val(spark, sf_dir)
    return model.train(train, val, preset.TARGET, params), val


@query("train_binary", _parts_sql(f"""
select count_if(not is_val) as train_rows, count_if(is_val) as val_rows, cast({len(preset.FEATURES)} as bigint) as n_features,
  count_if(is_val and target = 1) as positives, true as better_than_chance, true as stops_early from parts"""))
def train_binary(spark, sf_dir):
    """The shipped settings."""
    trained, val = _trained(spark, sf_dir, model.TreeParams())
    row = model.run_report(
        trained, model.score(trained, val), _train_val(spark, sf_dir)[0].count(), val.count(), trained.seconds)
    return row.select(
        "train_rows", "val_rows", "n_features", (F.col("confusion_matrix.fn") + F.col("confusion_matrix.tp")).alias("positives"),
        (F.col("auc_roc") > 0.5).alias("better_than_chance"), (F.col("best_round") < 499).alias("stops_early"))


@query("score_batch", _parts_sql("""
select target, count(*) as rows, true as in_range, true as follows_threshold from parts where is_val group by target"""))
def score_batch(spark, sf_dir):
    trained, val = _trained(spark, sf_dir)
    scored = model.score(trained, val)
    return scored.groupBy(F.col(preset.TARGET).cast("int").alias("target")).agg(
        F.count(F.lit(1)).alias("rows"), F.every(F.col("score").between(0, 1)).alias("in_range"),
        F.every((F.col("score") >= 0.5) == (F.col("predicted") == 1)).alias("follows_threshold"))


_NAMES = ", ".join(f"('{c}')" for c in preset.FEATURES)


# orders stands for the table that the trained features come from
@query("feature_importance", f"select f as feature, true as in_range from (values {_NAMES}) v(f) where (select count(*) from orders) > 0")
def feature_importance(spark, sf_dir):
    found = model.importance(_trained(spark, sf_dir)[0])
    return found.select("feature", F.col("importance").between(0, 1).alias("in_range"))


@query("model_compare", _parts_sql("""
select m as model, (select count_if(is_val) from parts) as rows, true as in_range from (values ('shallow'), ('deep')) v(m)"""))
def model_compare(spark, sf_dir):
    train, val = _train_val(spark, sf_dir)
    reports = {}
    for name, depth in (("shallow", 2), ("deep", 4)):
        trained = model.train(train, val, preset.TARGET, model.TreeParams(
            num_rounds=3, early_stopping=0, max_depth=depth, max_bins=64))
        reports[name] = model.report(trained, model.score(trained, val))
    matrix = F.col("confusion_matrix")
    return model.compare_models(reports, "auc_roc").select(
        "model", (matrix["tn"] + matrix["fp"] + matrix["fn"] + matrix["tp"]).alias("rows"),
        F.col("auc_roc").between(0, 1).alias("in_range"))


@query("train_multiclass", """
select count(*) as rows, true as in_range, true as has_loss from embeddings
where cast('0x' || substr(md5(cast(vec_id as varchar)), 1, 8) as bigint) % 1000 < 200""")
def train_multiclass(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    size = df.select(F.size("embedding")).first()[0]
    wide = df.select("label", "vec_id", *[F.col("embedding")[i].alias(f"e{i}") for i in range(size)])
    train, val = split.parts(split.hash_split(wide, "vec_id", 0.2))
    train, val = stage(train.drop("vec_id"), "train"), stage(val.drop("vec_id"), "val")
    trained = model.train(train, val, "label", model.TreeParams(
        objective="multi:softprob", num_rounds=10, max_depth=3, max_bins=32))
    row = model.report(trained, model.score(trained, val))
    return row.select(
        F.lit(val.count()).alias("rows"), F.col("accuracy").between(0, 1).alias("in_range"), (F.col("mlogloss") > 0).alias("has_loss"))


@query("train_regression", """
select count(*) as rows, true as has_error, true as r2_in_range from lineitem
where cast('0x' || substr(md5(concat_ws('-', l_orderkey, l_linenumber)), 1, 8) as bigint) % 1000 < 200""")
def train_regression(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    rows = df.select(
        "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_linenumber",
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("key"))
    train, val = split.parts(split.hash_split(rows, "key", 0.2))
    train, val = stage(train.drop("key"), "train"), stage(val.drop("key"), "val")
    trained = model.train(train, val, "l_extendedprice", model.TreeParams(
        objective="reg:squarederror", num_rounds=30, max_depth=4, max_bins=64, learning_rate=0.3))
    row = model.report(trained, model.score(trained, val))
    return row.select(
        F.lit(val.count()).alias("rows"), ((F.col("rmse") > 0) & (F.col("mae") <= F.col("rmse"))).alias("has_error"),
        (F.col("r2") <= 1).alias("r2_in_range"))


_TRIAL_ROWS = _parts_sql("""
select cast(t as int) as trial, a as algorithm, p as params, true as in_range
from (values {}) v(t, a, p) where (select count_if(is_val) from parts) > 0""")


@query("tune_single", _TRIAL_ROWS.replace("{}",
    """(0, 'depthwise', '{"max_depth": 2}'), (1, 'depthwise', '{"learning_rate": 0.3, "max_depth": 4}')"""))
def tune_single(spark, sf_dir):
    train, val = _train_val(spark, sf_dir)
    points = [{"max_depth": 2}, {"max_depth": 4, "learning_rate": 0.3}]
    return _plain(tune.tune(train, val, preset.TARGET, {"depthwise": (SHORT, points)}, "auc-roc"))


def _plain(trials):
    return trials.select("trial", "algorithm", "params", F.col("objective").between(0, 1).alias("in_range"))


@query("tune_multi", _TRIAL_ROWS.replace("{}", ", ".join([
    """(0, 'depthwise', '{"max_depth": 2}')""", """(1, 'leafwise', '{"learning_rate": 0.1, "min_child": 5}')""",
    """(2, 'leafwise', '{"learning_rate": 0.1, "min_child": 50}')""", """(3, 'leafwise', '{"learning_rate": 0.3, "min_child": 5}')""",
    """(4, 'leafwise', '{"learning_rate": 0.3, "min_child": 50}')"""])))
def tune_multi(spark, sf_dir):
    train, val = _train_val(spark, sf_dir)
    space = tune.space_from_config({
        "learning-rate": {"type": "continuous", "min": 0.1, "max": 0.3}, "min-child-samples": {"type": "integer", "min": 5, "max": 50}})
    trials = tune.tune(train, val, preset.TARGET, {
        "depthwise": (SHORT, [{"max_depth": 2}]), "leafwise": (SHORT, tune.grid_trials(space, 4, per_axis=2))})
    return _plain(tune.top_trials(trials, 5, "Maximize"))


@query("param_space", """
with r as (select min(l_discount) as d0, max(l_discount) as d1, min(l_linenumber) as n0, max(l_linenumber) as n1 from lineitem)
select d0 + (d1 - d0) * i / 2 as subsample, cast(n0 + (n1 - n0) * j // 2 as bigint) as max_depth
from r, (values (0), (1), (2)) a(i), (values (0), (1), (2)) b(j)""")
def param_space(spark, sf_dir):
    """The whole grid of the ranges that two columns span."""
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    low_d, high_d, low_n, high_n = lineitem.agg(
        F.min("l_discount"), F.max("l_discount"), F.min("l_linenumber"), F.max("l_linenumber")).first()
    space = tune.space_from_config({
        "bagging-fraction": {"type": "Continuous", "min": low_d, "max": high_d}, "max-depth": {"type": "Integer", "min": low_n, "max": high_n}})
    return spark.createDataFrame(
        [(p["subsample"], p["max_depth"]) for p in tune.grid_trials(space)], "subsample double, max_depth bigint")


# every supplier and return flag stands for a trial of an algorithm
_TRIALS = """select l_returnflag as algorithm, cast(l_suppkey as bigint) as trial, round(avg(l_discount), 9) as objective
from {0} group by l_returnflag, l_suppkey"""


@query("trial_ranking", f"""
with trials as ({_TRIALS.format('lineitem')}),
by_algorithm as (select *, row_number() over (partition by algorithm order by objective desc, trial) as rn from trials)
select algorithm, trial, objective from by_algorithm where rn = 1""")
def trial_ranking(spark, sf_dir):
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    trials = spark.sql(_TRIALS.format("{lineitem}"), lineitem=lineitem)
    return tune.best_by_algorithm(trials, "maximize")


@query("top_trials", f"""
select algorithm, trial, objective from ({_TRIALS.format('lineitem')}) order by objective, trial, algorithm limit 10""")
def top_trials(spark, sf_dir):
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    trials = spark.sql(_TRIALS.format("{lineitem}"), lineitem=lineitem)
    return tune.top_trials(trials, 10, "minimize")
