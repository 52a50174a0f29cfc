import pytest
from pyspark.sql import functions as F

from tabsmith.operators import split
from tabsmith.training import model, tune


@pytest.fixture(scope="module")
def data(spark):
    row = F.col("id")
    u = lambda n: F.pmod(F.xxhash64(row, F.lit(n)), F.lit(1_000_003)) / 1_000_003.0
    df = spark.range(0, 3000, 1, 4).select(
        row, u("a").alias("a"), u("b").alias("b"), F.when(u("gap") > 0.1, u("c")).alias("c"), u("y").alias("_y"))
    df = df.withColumn("target", (F.col("_y") < 0.1 + 0.6 * (F.col("a") > 0.6).cast("int")).cast("int"))
    train, val = split.parts(split.hash_split(df.drop("_y"), "id", 0.25))
    return train.drop("id").cache(), val.drop("id").cache()


SPARK_ML = dict(engine="spark_ml", stop_rule="library")
SMALL = model.TreeParams(num_rounds=6, early_stopping=0, max_depth=2, max_bins=32, colsample=1.0, **SPARK_ML)


def test_task_types():
    assert model.task_type("binary:logistic") == model.task_type("binary") == "binary"
    assert model.task_type("multi:softprob") == model.task_type("multiclass") == "multiclass"
    assert model.task_type("reg:squarederror") == model.task_type("regression") == "regression"
    with pytest.raises(ValueError, match="ranking"):
        model.task_type("rank:ndcg")
    with pytest.raises(ValueError, match="unknown objective"):
        model.task_type("binary:logistc")
    assert model.task_type("count:poisson") == "regression" and model.task_type("binary:hinge") == "binary"
    for name in ("survival:cox", "survival:aft", "cross_entropy_lambda"):
        with pytest.raises(ValueError, match="not trained"):
            model.task_type(name)
    assert model.larger_is_better("auc") and not model.larger_is_better("rmse")


def test_stop_round():
    assert model.stop_round([5, 4, 3, 3.5, 3.2, 3.1], 3) == (2, True)
    assert model.stop_round([5, 4, 3, 3.5], 3) == (2, False)
    assert model.stop_round([1.0], 1) == (0, False)


def test_binary(data):
    train, val = data
    trained = model.train(train, val, "target", SMALL)
    scored = model.score(trained, val).cache()
    row = model.report(trained, scored).first()
    assert row["auc_roc"] > 0.7 and sum(row["confusion_matrix"]) == val.count()
    shares = {r["feature"]: r["importance"] for r in model.importance(trained).collect()}
    assert sum(shares.values()) == pytest.approx(1) and max(shares, key=shares.get) == "a"
    again = model.score(model.train(train, val, "target", SMALL), val)
    assert scored.exceptAll(again).count() == 0


def test_patience_gives_the_model_of_the_best_round(data):
    train, val = data
    p = model.TreeParams(num_rounds=40, early_stopping=2, stop_rule="patience", engine="spark_ml", max_depth=4, max_bins=32, learning_rate=0.4)
    trained = model.train(train, val, "target", p)
    assert trained.rounds < 40 and trained.model.getNumTrees == trained.rounds
    assert min(trained.val_losses) == trained.val_losses[trained.rounds - 1]
    scored = model.score(trained, val)
    loss = model.evaluate.log_loss(scored, "target", "score").first()[0]
    assert loss == pytest.approx(min(trained.val_losses), rel=1e-6)
    assert [r["loss"] for r in model.round_losses(trained).orderBy("round").collect()] == trained.val_losses
    # the cut model is the one that so many rounds give
    short = model.TreeParams(num_rounds=trained.rounds, early_stopping=0, max_depth=4, max_bins=32, learning_rate=0.4, engine="spark_ml")
    again = model.score(model.train(train, val, "target", short), val)
    assert scored.exceptAll(again).count() == 0


def test_the_library_stops_in_one_run(data):
    train, val = data
    trained = model.train(train, val, "target", model.TreeParams(num_rounds=60, max_depth=4, max_bins=32, learning_rate=0.4, **SPARK_ML))
    assert 1 <= trained.rounds < 60 and len(trained.val_losses) == trained.rounds
    with pytest.raises(ValueError):
        model.train(train, val, "target", model.TreeParams(num_rounds=2, stop_rule="never"))


def test_eval_metrics(data):
    train, val = data
    p = model.TreeParams(num_rounds=2, early_stopping=0, max_depth=2, max_bins=16, eval_metric=("auc", "binary_logloss"))
    row = model.report(model.train(train, val, "target", p), model.score(model.train(train, val, "target", p), val)).first()
    assert set(row.asDict()) == {"task_type", "threshold", "confusion_matrix", "auc_roc", "logloss"}
    with pytest.raises(ValueError, match="rmse"):
        trained = model.train(train, val, "target", model.TreeParams(num_rounds=1, early_stopping=0, eval_metric=("rmse",)))
        model.report(trained, model.score(trained, val))


def test_regression_and_multiclass(data):
    train, val = data
    p = model.TreeParams(objective="reg:squarederror", num_rounds=4, early_stopping=2, max_depth=2, max_bins=16, **SPARK_ML, colsample=1.0)
    numbers = train.withColumn("y", F.col("a") * 3).select("y", "a", "b")
    trained = model.train(numbers, numbers, "y", p)
    assert model.report(trained, model.score(trained, numbers)).first()["r2"] > 0.7
    classes = train.withColumn("k", F.floor(F.col("a") * 3).cast("int")).select("k", "a", "b")
    p = model.TreeParams(objective="multi:softprob", num_rounds=2, early_stopping=0, max_depth=2, max_bins=16, **SPARK_ML, colsample=1.0)
    stopped = model.train(classes, classes, "k", model.TreeParams(objective="multi:softprob", num_rounds=3, max_depth=2, max_bins=16, **SPARK_ML))
    assert all(1 <= m.getNumTrees <= 3 for m in stopped.model.models)
    trained = model.train(classes, None, "k", p)
    scored = model.score(trained, classes)
    assert model.report(trained, scored).first()["accuracy"] > 0.9 and model.report(trained, scored).first()["mlogloss"] > 0
    sums = scored.select(F.aggregate("probabilities", F.lit(0.0), lambda s, x: s + x).alias("s"))
    assert sums.filter("abs(s - 1) > 1e-9").count() == 0
    assert model.importance(trained).first()["feature"] == "a"


def test_spaces():
    space = tune.space_from_config({
        "learning-rate": {"type": "continuous", "min": 0.01, "max": 0.3}, "max-depth": {"type": "integer", "min": 3, "max": 10}})
    assert space == {"learning_rate": tune.Continuous(0.01, 0.3), "max_depth": tune.Integer(3, 10)}
    drawn = tune.random_trials(space, 50, seed=1)
    assert drawn == tune.random_trials(space, 50, seed=1)
    assert all(0.01 <= t["learning_rate"] <= 0.3 and 3 <= t["max_depth"] <= 10 for t in drawn)
    grid = tune.grid_trials(space, 100, per_axis=3)
    assert len(grid) == 9 and {t["max_depth"] for t in grid} == {3, 6, 10}
    assert tune.grid_trials(space) == grid
    with pytest.raises(ValueError, match="9 points"):
        tune.grid_trials(space, 4, per_axis=3)


def test_spaces_in_other_spellings():
    numbers = {"type": "Continuous", "min": "0.5", "max": "1"}
    space = tune.space_from_config({
        "colsample-bytree": numbers, "min-child-weight": {"type": "Integer", "min": "1", "max": "10"}, "subsample": numbers})
    assert space == {"colsample": tune.Continuous(0.5, 1), "min_child": tune.Integer(1, 10), "subsample": tune.Continuous(0.5, 1)}
    assert tune.space_from_config({"min-child-samples": {"type": "integer", "min": 5, "max": 50}}) == {"min_child": tune.Integer(5, 50)}
    with pytest.raises(ValueError, match="level by level"):
        tune.space_from_config({"num-leaves": {"type": "integer", "min": 5, "max": 50}})
    with pytest.raises(ValueError, match="no such setting"):
        tune.space_from_config({"depht": numbers})
    assert model.report_column("auc-roc") == "auc_roc" and tune.direction_of("auc-roc") == "maximize"


def test_search(data):
    train, val = data
    trials = tune.tune(train, val, "target", {
        "x": (SMALL, [{"max_depth": 1}, {"max_depth": 3}]), "y": (SMALL, [{"learning_rate": 0.3}])}, parallel=3)
    rows = trials.orderBy("trial").collect()
    assert [(r["trial"], r["algorithm"], r["params"]) for r in rows] == [
        (0, "x", '{"max_depth": 1}'), (1, "x", '{"max_depth": 3}'), (2, "y", '{"learning_rate": 0.3}')]
    best = tune.top_trials(trials, 1).first()
    assert best["objective"] == max(r["objective"] for r in rows)
    assert tune.best_by_algorithm(trials).count() == 2


def test_ranking_of_trials(spark):
    trials = spark.createDataFrame(
        [("x", 0, 0.5), ("x", 1, 0.7), ("y", 2, 0.7), ("y", 3, None)], "algorithm string, trial int, objective double")
    assert [r["trial"] for r in tune.top_trials(trials, 4).collect()] == [1, 2, 0, 3]
    assert [r["trial"] for r in tune.top_trials(trials, 2, "minimize").collect()] == [0, 1]
    assert {r["algorithm"]: r["trial"] for r in tune.best_by_algorithm(trials, "minimize").collect()} == {"x": 0, "y": 2}
    assert tune.top_trials(trials, 1, "Maximize").first()["trial"] == 1
    nan = trials.unionByName(spark.sql("select 'x' as algorithm, 9 as trial, double('NaN') as objective"))
    assert tune.top_trials(nan, 1).first()["trial"] == 1
    assert {r["algorithm"]: r["trial"] for r in tune.best_by_algorithm(nan).collect()} == {"x": 1, "y": 2}
    with pytest.raises(ValueError):
        tune.top_trials(trials, 1, "up")


def test_a_failed_trial_costs_itself_only(data):
    train, val = data
    trials = tune.tune(train, val, "target", {"x": (SMALL, [{"max_depth": 1}, {"max_depth": -3}])})
    rows = trials.orderBy("trial").collect()
    assert rows[0]["objective"] > 0.5 and rows[1]["objective"] is None and rows[1]["error"]
    with pytest.raises(RuntimeError):
        tune.tune(train, val, "target", {"x": (SMALL, [{"max_depth": -3}])})


def test_model_comparison(spark):
    a = spark.createDataFrame([(0.6, 0.3)], "auc_roc double, rmse double")
    b = spark.createDataFrame([(0.7,)], "auc_roc double")
    assert [r["model"] for r in model.compare_models({"a": a, "b": b}, "auc_roc").collect()] == ["b", "a"]
