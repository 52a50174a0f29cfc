"""Histogram boosting against a plain booster that searches every value of every feature, row by row."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabsmith.training import boosting, model, objectives

FACTS = objectives.Facts(0.4, 2.0, 0.0, 5.0)


@pytest.mark.parametrize("name", sorted(set(objectives.KINDS) - {"multi:softmax", "multi:softprob", "multiclass"}))
def test_gradients_are_those_of_the_loss(name):
    made = objectives.objective(name, FACTS, alpha=0.3, power=1.4, delta=0.7)
    y = np.array([0.0, 1.0, 1.0, 0.0]) if objectives.KINDS[name] in ("logistic", "raw", "hinge") else np.array([0.5, 1.0, 2.5, 4.0])
    m = np.array([0.31, -0.47, 1.93, 0.2])
    step = 1e-5
    g, h = made.gradient(y, m)
    assert np.allclose(g, (made.loss(y, m + step) - made.loss(y, m - step)) / (2 * step), atol=1e-6)
    assert (h > 0).all() and np.isfinite(made.start(FACTS))
    if objectives.KINDS[name] in ("logistic", "raw", "squared", "poisson", "gamma", "tweedie", "pseudo_huber", "squared_log"):
        second = (made.gradient(y, m + step)[0] - made.gradient(y, m - step)[0]) / (2 * step)
        close = np.isclose(h, second, atol=1e-4) | (h == objectives.LEAST_WEIGHT)
        assert close.all()


def plain_tree(x, g, h, depth, least, reg, rate):
    """Leaf values per row, by trying every value of every feature; missing values on either side."""
    values = np.zeros(len(g))

    def grow(rows, level):
        G, H = g[rows].sum(), h[rows].sum()
        best = (1e-12, None)
        for f in range(x.shape[1]) if level < depth else ():
            own = x[rows, f]
            for cut in [-np.inf, *np.unique(own[~np.isnan(own)])]:
                for missing_left in (True, False):
                    left = np.where(np.isnan(own), missing_left, own <= cut)
                    if left.sum() < least or (~left).sum() < least:
                        continue
                    gl, hl = g[rows][left].sum(), h[rows][left].sum()
                    gain = (gl**2 / (hl + reg) + (G - gl) ** 2 / (H - hl + reg) - G**2 / (H + reg)) / 2
                    if gain > best[0] * (1 + 1e-9):
                        best = (gain, left)
        if best[1] is None:
            values[rows] = -rate * G / (H + reg)
        else:
            grow(rows[best[1]], level + 1)
            grow(rows[~best[1]], level + 1)

    grow(np.arange(len(g)), 0)
    return values


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(1000, 3)), 1)
    x[:, 2] = rng.integers(0, 4, 1000)
    x[rng.random(1000) < 0.1, 1] = np.nan
    lean = x[:, 0] + np.where(np.isnan(x[:, 1]), 0.8, 0.3 * x[:, 1]) + (x[:, 2] == 2)
    label = (lean + rng.normal(size=1000) > 0.5).astype(int)
    classes = np.digitize(lean, [0.0, 1.0])
    data = [(int(y), int(k), *[None if math.isnan(v) else float(v) for v in r]) for y, k, r in zip(label, classes, x)]
    df = spark.createDataFrame(data, "y int, k int, a double, b double, c double").repartition(5).cache()
    df.count()
    return df, x, label, classes


PLAIN = dict(num_rounds=4, early_stopping=0, max_depth=3, learning_rate=0.3, min_child=5, subsample=1.0, colsample=1.0)


def test_binary_model_equals_a_plain_booster(rows):
    df, x, y, _ = rows
    trained = model.train(df.drop("k"), None, "y", model.TreeParams(**PLAIN), 2.0)
    w = np.where(y == 1, 2.0, 1.0)
    p0 = (w * y).sum() / w.sum()
    m = np.full(len(y), math.log(p0 / (1 - p0)))
    for _ in range(4):
        p = 1 / (1 + np.exp(-m))
        m = m + plain_tree(x, (p - y) * w, p * (1 - p) * w, 3, 5, 1.0, 0.3)
    got = {(r["y"], r["a"], r["b"], r["c"]): r["score"] for r in model.score(trained, df).collect()}
    for yi, r, margin in zip(y, x, m):
        key = (int(yi), float(r[0]), None if math.isnan(r[1]) else float(r[1]), float(r[2]))
        assert got[key] == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-4)


def test_classes_share_one_softmax(rows):
    df, x, _, k = rows
    trained = model.train(df.drop("y"), None, "k", model.TreeParams(objective="multi:softprob", **PLAIN))
    m = np.zeros((len(k), 3))
    for _ in range(4):
        p = objectives.softmax(m)
        m = m + np.array([plain_tree(x, p[:, c] - (k == c), 2 * p[:, c] * (1 - p[:, c]), 3, 5, 1.0, 0.3) for c in range(3)]).T
    p = objectives.softmax(m)
    scored = model.score(trained, df).collect()
    want = {tuple("nan" if math.isnan(v) else float(v) for v in r): q for r, q in zip(x, p)}
    for r in scored:
        key = tuple("nan" if r[c] is None else r[c] for c in "abc")
        assert np.allclose(r["probabilities"], want[key], atol=1e-4) and r["predicted"] == int(np.argmax(r["probabilities"]))
    curve = [r["value"] for r in model.metric_curves(trained, {"t": df}).filter("metric = 'mlogloss'").orderBy("round").collect()]
    assert len(curve) == 4 and all(b < a for a, b in zip(curve, curve[1:]))
    assert np.allclose(curve, trained.model.train_losses, rtol=1e-9)


def test_patience_trains_so_many_rounds_more(rows):
    df = rows[0].drop("k")
    train, val = df.filter("xxhash64(a, b, c) % 3 <> 0"), df.filter("xxhash64(a, b, c) % 3 = 0")
    p = model.TreeParams(num_rounds=200, early_stopping=6, max_depth=5, learning_rate=0.5)
    trained = model.train(train, val, "y", p)
    assert trained.rounds < 100
    assert trained.model.trained_rounds == trained.rounds + 6 == len(trained.val_losses)
    assert min(trained.val_losses) == trained.val_losses[trained.rounds - 1]
    loss = model.evaluate.log_loss(model.score(trained, val), "y", "score").first()[0]
    assert loss == pytest.approx(min(trained.val_losses), rel=1e-9)
    first = model.train(train, val, "y", model.TreeParams(**{**vars(p), "stop_rule": "library"}))
    worse = [i for i in range(1, len(trained.val_losses)) if trained.val_losses[i] >= min(trained.val_losses[:i])]
    assert first.rounds == worse[0] and first.val_losses == trained.val_losses[:worse[0] + 1]


def test_checkpoints_and_the_number_of_tasks_change_nothing(rows, monkeypatch):
    df = rows[0].drop("k")
    p = model.TreeParams(num_rounds=7, early_stopping=0, max_depth=3, subsample=1.0, colsample=0.7)
    want = boosting.tree_rows(model.train(df, None, "y", p).model)
    monkeypatch.setattr(boosting, "CHECKPOINT_ROUNDS", 2)
    monkeypatch.setattr(boosting, "TASK_ROWS", 10)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 64)
    monkeypatch.setattr(boosting, "FLAT_TASKS", 2)
    assert boosting.tree_rows(model.train(df.repartition(3), None, "y", p).model) == want


def test_draws_depend_on_the_seed(rows):
    df = rows[0].drop("k")
    p = dict(num_rounds=3, early_stopping=0, max_depth=3)
    nodes = [boosting.tree_rows(model.train(df, None, "y", model.TreeParams(seed=s, **p)).model) for s in (1, 1, 2)]
    assert nodes[0] == nodes[1] != nodes[2]
    drawn = boosting._draw(0, 100_000, 3, 7, 0.8)
    assert abs(drawn.mean() - 0.8) < 0.01 and (boosting._draw(50, 100, 3, 7, 0.8) == drawn[50:150]).all()


def test_trees_as_a_table(rows):
    df = rows[0].drop("k")
    trained = model.train(df, None, "y", model.TreeParams(**PLAIN))
    nodes = model.trees(trained)
    leaves = nodes.filter("feature is null")
    assert leaves.groupBy("round").agg(F.sum("rows").alias("n")).filter("n <> 1000").count() == 0
    inner = nodes.alias("p").join(nodes.alias("c"), F.expr("p.round = c.round and p.node = c.parent"))
    assert inner.groupBy("p.round", "p.node", "p.rows").agg(F.sum("c.rows").alias("n")).filter("n <> rows").count() == 0
    by_kind = {kind: {r["feature"]: r["importance"] for r in model.importance(trained, kind).collect()} for kind in model.IMPORTANCE}
    for f in "abc":
        assert by_kind["total_gain"][f] == pytest.approx(by_kind["gain"][f] * by_kind["weight"][f])
    assert sum(by_kind["weight"].values()) == nodes.filter("feature is not null").count()
    shares = model.importance(trained).collect()
    assert sum(r["importance"] for r in shares) == pytest.approx(1) and [r["importance"] for r in shares] == sorted([r["importance"] for r in shares], reverse=True)


def test_curves_equal_reports_of_shorter_models(rows):
    df = rows[0].drop("k")
    trained = model.train(df, None, "y", model.TreeParams(**PLAIN))
    curves = {(r["round"], r["metric"]): r["value"] for r in model.metric_curves(trained, {"all": df}).collect()}
    for n in (1, 3, 4):
        shorter = model.Trained(trained.model.first(n), trained.params, "y", trained.features, n)
        row = model.report(shorter, model.score(shorter, df)).first()
        assert curves[n - 1, "logloss"] == pytest.approx(row["logloss"]) and curves[n - 1, "auc_roc"] == pytest.approx(row["auc_roc"])


@pytest.mark.parametrize("name,least", [
    ("reg:squarederror", 0.6), ("reg:absoluteerror", 0.5), ("reg:pseudohubererror", 0.3), ("huber", 0.3), ("fair", 0.3),
    ("reg:squaredlogerror", 0.2), ("count:poisson", 0.5), ("reg:gamma", 0.5), ("reg:tweedie", 0.5)])
def test_other_objectives_learn(spark, name, least):
    df = spark.range(2000).select(
        ((F.col("id") * 7919) % 101 / 101).alias("a"), ((F.col("id") * 104729) % 97 / 97).alias("b")).withColumn("y", 0.5 + 3 * F.col("a") + F.col("b"))
    trained = model.train(df, df, "y", model.TreeParams(objective=name, num_rounds=60, max_depth=3, learning_rate=0.3))
    assert model.report(trained, model.score(trained, df)).first()["r2"] > least
    assert trained.val_losses[-1] < trained.val_losses[0]


def test_quantiles_and_hinge(spark):
    df = spark.range(3000).select(((F.col("id") * 7919) % 1009 / 1009).alias("y"), (F.col("id") % 5).alias("a"))
    p = dict(num_rounds=60, early_stopping=0, max_depth=2, learning_rate=0.3)
    trained = model.train(df, None, "y", model.TreeParams(objective="reg:quantileerror", quantile_alpha=0.9, **p))
    below = model.score(trained, df).agg(F.avg((F.col("y") <= F.col("score")).cast("double"))).first()[0]
    assert 0.85 < below < 0.95
    labels = df.withColumn("t", (F.col("a") >= 2).cast("int")).drop("y")
    hinge = model.score(model.train(labels, None, "t", model.TreeParams(objective="binary:hinge", **p)), labels)
    assert hinge.filter("score <> t").count() == 0
    raw = model.score(model.train(labels, None, "t", model.TreeParams(objective="binary:logitraw", **p)), labels)
    assert raw.filter("predicted <> t").count() == 0 and raw.filter("score < 0").count() > 0


def test_bins(spark):
    assert boosting._shares(np.array([1.0, 2.0]), np.ones(2), 255).tolist() == [1.0]
    edges = boosting.bin_edges(spark.range(100_000).selectExpr("id % 10 as few", "id as many", "cast(null as double) as none"), ["few", "many", "none"])
    assert edges[0].tolist() == list(range(9)) and len(edges[2]) == 0
    assert 200 <= len(edges[1]) <= 254
    shares = np.searchsorted(np.sort(edges[1]), np.arange(100_000), "left")
    assert np.bincount(shares).max() < 3 * 100_000 / 255
    bins = boosting.binned(np.array([[0.0, 0.5, 1.0, np.nan, 99.0]]), [np.array([0.0, 1.0])])
    assert bins.tolist() == [[1, 2, 2, 0, 3]]


def test_labels_and_settings_that_cannot_be(rows, spark):
    df = rows[0].drop("k")
    with pytest.raises(ValueError, match="range"):
        model.train(df.withColumn("y", F.lit(-1)), None, "y", model.TreeParams(objective="count:poisson", num_rounds=1))
    with pytest.raises(ValueError, match="no row"):
        model.train(df.limit(0), None, "y", model.TreeParams(num_rounds=1))
    with pytest.raises(ValueError, match="engine"):
        model.train(df, None, "y", model.TreeParams(engine="other"))
    with pytest.raises(ValueError, match="histogram"):
        model.train(df, None, "y", model.TreeParams(objective="binary:hinge", engine="spark_ml"))
    constant = model.train(df.withColumn("y", F.lit(1)), None, "y", model.TreeParams(num_rounds=2, early_stopping=0))
    assert model.score(constant, df).filter("score < 0.99").count() == 0


def test_a_saved_model_scores_alike(rows, spark, tmp_path):
    df = rows[0].drop("y")
    trained = model.train(df, None, "k", model.TreeParams(objective="multi:softprob", **{**PLAIN, "num_rounds": 2}))
    boosting.save(trained.model, spark, str(tmp_path / "m"))
    back = boosting.load(spark, str(tmp_path / "m"))
    assert boosting.tree_rows(back) == boosting.tree_rows(trained.model)
    again = model.Trained(back, trained.params, "k", back.features, 2)
    assert model.score(again, df).exceptAll(model.score(trained, df)).count() == 0


def test_fits_on_the_same_frames_bin_them_once(rows, monkeypatch):
    df = rows[0].drop("k")
    train, val = df.filter("xxhash64(a, b, c) % 3 <> 0"), df.filter("xxhash64(a, b, c) % 3 = 0")
    params = [model.TreeParams(**{**PLAIN, "max_depth": d}) for d in (2, 3)]
    want = [boosting.tree_rows(model.train(train.select("*"), val.select("*"), "y", p).model) for p in params]
    made = []
    sketch = boosting.bin_edges
    monkeypatch.setattr(boosting, "bin_edges", lambda *a, **k: made.append(1) or sketch(*a, **k))
    got = [boosting.tree_rows(model.train(train, val, "y", p).model) for p in params]
    assert got == want and len(made) == 1


@pytest.mark.parametrize("label", ["y", "k"])
def test_tasks_that_keep_their_blocks_grow_the_same_trees(rows, monkeypatch, label):
    df = rows[0].drop("k" if label == "y" else "y")
    train, val = df.filter("xxhash64(a, b, c) % 3 <> 0"), df.filter("xxhash64(a, b, c) % 3 = 0")
    monkeypatch.setattr(boosting, "STAGED_ROWS", 32)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 64)
    monkeypatch.setattr(boosting, "TASK_ROWS", 100)
    monkeypatch.setattr(boosting, "HELD_ROUNDS", 5)
    p = model.TreeParams(
        objective="binary:logistic" if label == "y" else "multi:softprob", num_rounds=40, early_stopping=4, max_depth=4, learning_rate=0.4, colsample=0.7)
    held = model.train(train, val, label, p).model
    monkeypatch.setattr(boosting, "HELD_BYTES", 0)
    jobs = model.train(train, val, label, p).model
    assert boosting.tree_rows(held) == boosting.tree_rows(jobs) and 5 < held.trained_rounds == jobs.trained_rounds
    assert np.allclose(held.val_losses, jobs.val_losses, rtol=1e-12) and np.allclose(held.train_losses, jobs.train_losses, rtol=1e-12)


def test_many_rounds_take_few_jobs(rows, spark):
    df = rows[0].drop("k")
    context = spark.sparkContext
    context.setJobGroup("few-jobs", "rounds")
    trained = model.train(df, None, "y", model.TreeParams(num_rounds=30, early_stopping=0, max_depth=5))
    context.setLocalProperty("spark.jobGroup.id", None)
    assert trained.rounds == 30 and len(context.statusTracker().getJobIdsForGroup("few-jobs")) < 30


def test_best_splits_are_those_of_each_node_alone():
    settings = model.TreeParams(min_child=3, min_child_weight=0.5)
    rng = np.random.default_rng(3)
    sizes = [1, 4, 7, 2]
    starts = np.repeat(np.cumsum([0, *sizes])[:-1], sizes)
    for missing in (True, False):
        sums = rng.integers(0, 6, (150, 3, sum(sizes))).astype(float)
        sums[:, 0] -= 2
        if not missing:
            sums[:, :, np.unique(starts)] = 0
        totals = np.full((150, 3), 40.0)
        for own, whole, (gain, cell, left_side, left) in zip(sums, totals, boosting.best_splits(sums, totals, starts, settings)):
            best = (-np.inf, None, True, None)
            for side in (True, False):
                for c in range(sum(sizes)):
                    g, h, n = part = own[:, starts[c]:c + 1].sum(axis=1) - (0 if side else own[:, starts[c]])
                    if min(n, whole[2] - n) >= 3 and min(h, whole[1] - h) >= 0.5:
                        found = g**2 / (h + 1) + (whole[0] - g) ** 2 / (whole[1] - h + 1)
                        found = (found - whole[0] ** 2 / (whole[1] + 1)) / 2
                        if found > best[0]:
                            best = (found, c, side, part.tolist())
            assert (gain, cell, left_side, left) == best if best[1] is not None else gain == -np.inf
