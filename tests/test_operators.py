import math
import os
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabsmith.operators import counts, evaluate, fit, logs, ordering, rows, split
from tabsmith.operators.selection import exact_medians, select_ranks


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_first_per_key(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z")], "k string, o int, v string")
    out = rows.first_per_key(df, ["k"], ["o"])
    assert sorted(map(tuple, out.collect())) == [("a", 1, "y"), ("b", 5, "z")]


def test_hot_keys_are_cut_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("if(id < 900, 0, id) as k", "id as o")
    out = rows.first_per_key(df, ["k"], ["o"])
    out.collect()
    plan = plan_of(out)
    assert "row_number(), 1, Partial" in plan and "row_number(), 1, Final" in plan
    assert out.count() == 101


def test_row_helpers(spark):
    df = spark.createDataFrame([("a", 1.5), (None, 2.5)], "k string, v double")
    assert rows.drop_null_keys(df, ["k"]).count() == 1
    assert rows.keep_values(df, "k", ["a"]).count() == 1
    with pytest.raises(ValueError, match="missing columns: z"):
        rows.require_columns(df, ["k", "z"])
    ids = spark.range(5000).withColumnRenamed("id", "k")
    drawn = rows.sample_by_key(ids, "k", 0.3)
    assert abs(drawn.count() - 1500) < 150 and drawn.exceptAll(rows.sample_by_key(ids.repartition(7), "k", 0.3)).count() == 0
    assert rows.sample_by_key(ids, "k", 1.0).count() == 5000 and rows.sample_by_key(ids, "k", 0.0).count() == 0
    with pytest.raises(ValueError):
        rows.sample_by_key(ids, "k", 1.5)


def test_medians_edges(spark):
    df = spark.createDataFrame(
        [(1.0, None, 5.0), (2.0, None, 5.0), (4.0, None, 5.0), (8.0, None, 5.0), (None, None, 5.0)],
        "a double, b double, c double")
    assert exact_medians(df, ["a", "b", "c"]) == {"a": 3.0, "b": None, "c": 5.0}
    assert fit.medians(df, ["a", "b", "c"]) == {"a": 3.0, "b": 0.0, "c": 5.0}
    inf = spark.sql("select double(x) as x from values ('-Infinity'), ('1'), ('2'), ('Infinity'), ('Infinity') v(x)")
    assert exact_medians(inf, ["x"]) == {"x": 2.0}
    assert exact_medians(inf.filter("x > 1"), ["x"]) == {"x": float("inf")}


@pytest.mark.parametrize("seed", range(6))
def test_medians_match_sorting(spark, seed):
    rng = random.Random(seed)
    n = rng.choice([1, 2, 7, 200, 1001])
    hot = rng.choice([0.0, 0.4, 0.9])  # share of rows with one value
    data = [
        (0.25 if rng.random() < hot else rng.lognormvariate(5, 4), float(rng.randint(-3, 3)),
         None if rng.random() < 0.3 else rng.gauss(0, 1) * 10 ** rng.randint(-9, 9))
        for _ in range(n)]
    df = spark.createDataFrame(data, "a double, b double, c double").repartition(5)
    got = exact_medians(df, ["a", "b", "c"], accuracy=rng.choice([10, 100, 2000]))
    for i, c in enumerate("abc"):
        present = [r[i] for r in data if r[i] is not None]
        assert got[c] == (statistics.median(present) if present else None)


def test_select_ranks_counts_below_and_equal(spark):
    df = spark.createDataFrame([(v,) for v in [1, 5, 5, 5, 9, 2**60]], "h bigint")
    got = select_ranks(df, ["h"], lambda n: (3, 3))["h"]
    assert (got.low, got.below, got.equal, got.n) == (5, 1, 3, 6)


def test_medians_take_three_passes_whatever_the_spread(spark):
    """Every pass is one action; the values span all magnitudes that a double has."""
    df = spark.range(20_001).selectExpr("pow(10, (id - 10000) * 0.03) as x").repartition(4).cache()
    df.count()
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("medians", "medians")
    assert exact_medians(df, ["x"]) == {"x": 1.0}
    plans = len(tracker.getJobIdsForGroup("medians"))
    spark.sparkContext.setJobGroup("one pass", "one pass")
    df.agg(F.percentile_approx("x", 0.5)).first()
    one = max(1, len(tracker.getJobIdsForGroup("one pass")))
    spark.sparkContext._jsc.clearJobGroup()
    assert plans <= 3 * (one + 2)  # adaptive stages and the sort of the last pass are jobs of their own


def test_modes_and_counts(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("b", None), ("a", None), (None, None)], "x string, y string")
    assert [tuple(r) for r in fit.modes(fit.value_counts(df, ["x", "y"])).collect()] == [("x", "a")]


def test_fit_state(spark, tmp_path):
    df = spark.createDataFrame(
        [("b", "q", None, 1.0), ("a", "q", None, None), ("b", None, None, 3.0)], "x string, y string, z string, n double")
    state = fit.fit(df, ["n", "absent"], ["x", "y", "z"], ["x", "z"], unknown="unknown")
    assert state.medians == {"n": 2.0}
    assert state.modes == {"x": "b", "y": "q", "z": "unknown"}
    listed = lambda s: sorted(map(tuple, s.codes.collect()))
    assert listed(state) == [("x", "a", 0), ("x", "b", 1), ("z", "unknown", 0)]
    state.save(spark, str(tmp_path / "state"))
    again = fit.FitState.load(spark, str(tmp_path / "state"))
    assert (again.medians, again.modes, again.sizes, listed(again)) == (state.medians, state.modes, state.sizes, listed(state))
    filled = fit.fill_missing(df, state.fill_values())
    assert filled.filter("x is null or y is null or z is null or n is null").count() == 0
    encoded = fit.encode_labels(filled, state)
    assert sorted(tuple(r) for r in encoded.select("x", "x_encoded", "z_encoded").collect()) == [
        ("a", 0.0, 0.0), ("b", 1.0, 0.0), ("b", 1.0, 0.0)]
    unseen = spark.createDataFrame([("c",)], "x string")
    assert fit.encode_labels(unseen, state).first()["x_encoded"] is None


def test_a_saved_state_outlives_the_work_folder(spark, tmp_path):
    from tabsmith.session import job_folder

    names = [f"v{i:04d}" for i in range(300)] + ["", "é", "Z"]
    df = spark.createDataFrame([(v, "w" if v else None) for v in names for _ in range(2)], "x string, y string").repartition(6)
    with job_folder(spark) as folder:
        fit.fit(df, encoded=["x", "y"]).save(spark, str(tmp_path / "state"))
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)
    state = fit.FitState.load(spark, str(tmp_path / "state"))
    assert state.sizes == {"x": 303, "y": 1}
    got = {r["x"]: r["x_encoded"] for r in fit.encode_labels(df, state).collect()}
    assert got == {v: float(i) for i, v in enumerate(sorted(names))}


def test_running_totals_over_ranges(spark):
    rng = random.Random(3)
    data = sorted({round(rng.gauss(0, 1), 5) for _ in range(700)})
    weights = [rng.randint(0, 9) for _ in data]
    df = spark.createDataFrame(list(zip(data, weights)), "s double, w bigint").repartition(4)
    up = {r["s"]: int(r["w_before"]) for r in ordering.running_totals(df, ["s"], ["w"]).collect()}
    down = {r["s"]: int(r["w_before"]) for r in ordering.running_totals(df, ["s"], ["w"], descending=True).collect()}
    for i, s in enumerate(data):
        assert up[s] == sum(weights[:i]) and down[s] == sum(weights[i + 1:])
    assert ordering.running_totals(df.limit(0), ["s"], ["w"]).count() == 0


def test_counts(spark):
    df = spark.createDataFrame(
        [("a", 1, "Paid"), ("a", 0, "Current"), ("b", 2, "Paid"), (None, 3, "Paid")], "k string, o int, l string")
    assert tuple(counts.stage_counts(df, "k", "o", "l", ["Paid"]).first()) == (4, 1, 3)
    report = [tuple(r) for r in counts.schema_report(df).orderBy("position").collect()]
    assert report == [(1, "k", 4, 3), (2, "o", 4, 4), (3, "l", 4, 4)]
    shares = {r["l"]: (r["n"], r["percent"]) for r in counts.value_shares(df, "l").collect()}
    assert shares == {"Paid": (3, 75.0), "Current": (1, 25.0)}
    watched, seen = counts.observe_rows(df, "rows")
    watched.collect()
    assert seen.get["rows"] == 4


@pytest.mark.parametrize("n,fraction", [(10, 0.2), (997, 0.2), (997, 0.5), (3, 0.9), (1, 0.2), (50, 0.0)])
def test_exact_split(spark, n, fraction):
    df = spark.range(n).selectExpr("concat('k', id) as k").repartition(3)
    marked = split.exact_split(df, "k", fraction)
    train, val = split.parts(marked)
    assert train.count() == int(n * (1 - fraction)) and train.count() + val.count() == n
    assert train.intersect(val).count() == 0
    again = split.exact_split(df.repartition(7), "k", fraction)
    assert marked.exceptAll(again).count() == 0


def test_exact_split_wants_unique_keys(spark):
    df = spark.createDataFrame([("a",)] * 10, "k string")
    with pytest.raises(ValueError, match="repeats"):
        split.exact_split(df, "k", 0.5)


def test_hash_split_keeps_a_keys_part(spark):
    small = split.hash_split(spark.range(500), "id", 0.3)
    large = split.hash_split(spark.range(5000), "id", 0.3)
    assert small.exceptAll(large).count() == 0
    assert 0.25 < large.filter("is_val").count() / 5000 < 0.35


def test_file_split_is_the_seeded_permutation():
    names = [f"f{i}" for i in range(10)]
    order = np.random.RandomState(42).permutation(10)
    assert split.file_split(names[::-1], 0.2) == ([names[i] for i in order[:8]], [names[i] for i in order[8:]])
    assert len(split.file_split(["a"], 0.9)[0]) == 1


def test_published_confusion_matrix(spark):
    matrix = spark.createDataFrame([(905995, 689475, 80383, 180615)], "tn bigint, fp bigint, fn bigint, tp bigint")
    row = evaluate.rates(matrix).first()
    assert row["accuracy"] == pytest.approx(0.5853103850968614, abs=1e-15)
    assert row["precision"] == pytest.approx(0.2075819742785229, abs=1e-15)
    assert row["recall"] == pytest.approx(0.692016797063579, abs=1e-15)
    assert row["f1"] == pytest.approx(0.3193650715063726, abs=1e-15)


def test_no_positive_prediction(spark):
    df = spark.createDataFrame([(1, 0.1), (0, 0.2)], "y int, s double")
    row = evaluate.binary_report(df, "y", "s", 0.5).first()
    assert (row["precision"], row["recall"], row["f1"]) == (0, 0, 0)
    assert row["confusion_matrix"].asDict() == {"tn": 1, "fp": 0, "fn": 1, "tp": 0}


def brute_auc(y, s):
    pairs = [(a, b) for a, ya in zip(s, y) if ya for b, yb in zip(s, y) if not yb]
    return sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in pairs) / len(pairs)


def brute_average_precision(y, s):
    total, out, last = sum(y), 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        hit = [yy for yy, ss in zip(y, s) if ss >= t]
        recall = sum(hit) / total
        out += (recall - last) * sum(hit) / len(hit)
        last = recall
    return out


@pytest.mark.parametrize("seed,digits", [(0, 1), (1, 2), (2, 9)])
def test_ranking_metrics_against_all_pairs(spark, seed, digits):
    rng = random.Random(seed)
    y = [int(rng.random() < 0.3) for _ in range(300)]
    s = [round(min(max(rng.gauss(0.4 + 0.1 * v, 0.2), 0.0), 1.0), digits) for v in y]
    df = spark.createDataFrame(list(zip(y, s)), "y int, s double").repartition(5)
    row = evaluate.ranking_metrics(evaluate.score_counts(df, "y", "s")).first()
    assert row["auc_roc"] == pytest.approx(brute_auc(y, s), abs=1e-12)
    assert row["auc_pr"] == pytest.approx(brute_average_precision(y, s), abs=1e-12)


def test_ranking_metrics_of_one_class(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.2)], "y int, s double")
    assert tuple(evaluate.ranking_metrics(evaluate.score_counts(df, "y", "s")).first()) == (None, 0.0)


def test_multiclass(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 0)], "y int, p int")
    row = evaluate.multiclass_report(df, "y", "p").first()
    assert row["accuracy"] == 0.5
    assert row["f1_macro"] == pytest.approx((0.5 + 2 / 3 + 0) / 3)
    assert row["f1_weighted"] == pytest.approx((0.5 * 2 + 2 / 3 + 0) / 4)
    report = {r["class"]: r for r in evaluate.class_report(df, "y", "p").collect()}
    assert set(report) == {"0", "1", "2", "accuracy", "macro avg", "weighted avg"}
    assert report["accuracy"]["f1"] == 0.5 and report["accuracy"]["support"] == 4
    arrays = spark.createDataFrame([([0.1, 0.7, 0.7],), ([0.5, 0.2, 0.3],)], "a array<double>")
    assert [r[0] for r in arrays.select(evaluate.argmax(F.col("a"))).collect()] == [1, 0]


def test_regression(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (3.0, 2.0)], "y double, p double")
    row = evaluate.regression_report(df, "y", "p").first()
    assert row["rmse"] == pytest.approx((2 / 3) ** 0.5) and row["mae"] == pytest.approx(2 / 3) and row["r2"] == 0
    flat = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0)], "y double, p double")
    assert evaluate.regression_report(flat, "y", "p").first()["r2"] == 1.0


def test_losses_and_balance(spark):
    df = spark.createDataFrame([(1, 0.8), (0, 0.4), (0, 0.0)], "y int, s double")
    want = -(np.log(0.8) + np.log(0.6) + np.log(1 - 1e-15)) / 3
    assert evaluate.log_loss(df, "y", "s").first()[0] == pytest.approx(want)
    assert tuple(evaluate.class_balance(df, "y").first()) == (1, 2, 2.0)
    assert evaluate.class_balance(df, "y", 1).first()["weight"] in (0.0, 1.0)
    assert evaluate.class_count(df, "y").first()[0] == 2
    arrays = spark.createDataFrame([(1, [0.2, 0.8]), (0, [0.5, 0.5])], "y int, p array<double>")
    assert evaluate.multiclass_log_loss(arrays, "y", "p").first()[0] == pytest.approx(-(np.log(0.8) + np.log(0.5)) / 2)


def test_log_lines(spark):
    lines = [
        "  AUC-ROC:   0.680996", "  F1 (macro):  0.5", "  RMSE: 1.5e-3", "  R²:   -0.25", "  F1:        0.31",
        "[3]\teval-logloss:0.64\teval-auc:0.681", "  Loaded in 3.0s"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, value string")
    got = {(r["i"], r["name"], r["metric"]) for r in logs.extract_metrics(df, logs.XGB_PATTERNS).collect()}
    assert got == {
        # the pattern of r2 takes any two letters after the R, so it finds "ROC:" as well
        (0, "auc-roc", 0.680996), (0, "r2", 0.680996), (1, "f1-macro", 0.5), (2, "rmse", 0.0015), (3, "r2", -0.25), (4, "f1", 0.31),
        (5, "xgb:eval-logloss", 0.64), (5, "xgb:eval-auc", 0.681)}
    other = spark.createDataFrame([(0, "[1] eval's auc: 0.6 eval's l2: 0.2")], "i int, value string")
    got = {(r["name"], r["metric"]) for r in logs.extract_metrics(other, logs.LGBM_PATTERNS).collect()}
    assert got == {("lgbm:eval-auc", 0.6), ("lgbm:eval-l2", 0.2)}
    assert logs._literal_start("ab?c") == "a"


def test_group_ranking(spark):
    from tabsmith.operators.evaluate import group_ranking

    rows = [("a", 2, 0.9), ("a", 0, 0.8), ("a", 1, 0.7), ("b", 0, 0.5), ("b", 3, 0.4), ("c", 0, 0.1), (None, 1, 0.3)]
    df = spark.createDataFrame(rows, "g string, y int, s double")
    got = group_ranking(df, "g", "y", "s", 2).first()
    dcg = {"a": 3.0, "b": 7 / math.log2(3)}
    ideal = {"a": 3 + 1 / math.log2(3), "b": 7.0}
    assert got["groups"] == 3
    assert got["ndcg"] == pytest.approx((dcg["a"] / ideal["a"] + dcg["b"] / ideal["b"] + 1) / 3)
    assert got["map"] == pytest.approx((1 / 2 + 1 / 2 + 1) / 3)
    assert got["precision"] == pytest.approx((1 / 2 + 1 / 2 + 0) / 3)
    assert "WindowGroupLimit" in group_ranking(df, "g", "y", "s", 2)._jdf.queryExecution().toString()
    hot = spark.range(3000).selectExpr("if(id < 1000, 'hot', string(id)) as g", "int(id % 3) as y", "double(id % 7) as s")
    assert group_ranking(hot, "g", "y", "s", 5, ("y",)).first()["groups"] == 2001
    assert group_ranking(df.limit(0), "g", "y", "s").first()["groups"] == 0
