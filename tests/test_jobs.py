import json
import os

import pytest
from pyspark.sql import functions as F

from checks.loans import loans
from tabsmith import job
from tabsmith.operators import logs
from tabsmith.operators.fit import FitState
from tabsmith.plans import loan_features, loan_preset as preset, synthesis
from tabsmith.sources import tables
from tabsmith.streaming import streams


def test_config_merging():
    config = job.merge_config({"run": "train", "train": {"max_depth": 4}}, ["train.num_rounds=7", "features.format=csv"])
    assert config["run"] == ["train"] and config["train"]["max_depth"] == 4
    assert config["train"]["num_rounds"] == 7 and config["features"]["format"] == "csv"
    assert job.DEFAULTS["train"]["max_depth"] == 7
    for bad in ({"nope": {}}, {"train": {"nope": 1}}, {"run": ["nope"]}):
        with pytest.raises(ValueError):
            job.merge_config(bad)


def test_formats(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "cast(id % 7 as double) / 3 as x", "if(id % 5 = 0, null, 'a,\"b') as s")
    for kind, name in (("csv", "a.csv"), ("csv", "plain"), ("parquet", "b"), ("parquet", "c.parquet")):
        path = str(tmp_path / name)
        tables.write_table(df, path, kind, files=6)
        assert tables.detect_format(spark, path) == kind
        assert len(tables.list_files(spark, path)) == 6
        back = tables.read_table(spark, path, schema="id bigint, x double, s string")
        assert back.exceptAll(df).count() == 0 and back.count() == 100
    inferred = tables.read_table(spark, str(tmp_path / "a.csv"))
    assert [t for _, t in inferred.dtypes] == ["int", "double", "string"]
    with pytest.raises(ValueError):
        tables.read_table(spark, "x", format="orc")
    both = tables.read_table(spark, [str(tmp_path / "b"), str(tmp_path / "c.parquet")])
    assert both.count() == 200


def test_csv_quotes_as_the_standard_says(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b\n1,"a ""b"", c"\n2,"two\nlines"\n3," kept "\n')
    back = tables.read_table(spark, str(tmp_path / "x.csv"), schema="a int, b string", multiline=True)
    want = [(1, 'a "b", c'), (2, "two\nlines"), (3, " kept ")]
    assert [tuple(r) for r in back.orderBy("a").collect()] == want
    tables.write_table(back.coalesce(1), str(tmp_path / "y"), "csv")
    import csv

    (part,) = [p for p in (tmp_path / "y").iterdir() if p.name.startswith("part-")]
    with open(part, newline="") as f:
        assert sorted(map(tuple, list(csv.reader(f))[1:])) == [(str(a), b) for a, b in want]


def test_headerless_csv_and_label_choice(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5), (0, 3.5)], "target int, a double")
    tables.write_table(df, str(tmp_path / "n.csv"), "csv", header=False)
    back = tables.read_table(spark, str(tmp_path / "n.csv"), header=False)
    assert back.columns == ["_c0", "_c1"] and back.count() == 2
    assert tables.label_column(back) == "_c0" and tables.label_column(df.select("a", "target")) == "target"


def test_wrong_header_is_an_error(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5)], "target int, a double")
    tables.write_table(df, str(tmp_path / "h.csv"), "csv", header=True)
    with pytest.raises(Exception):
        tables.read_table(spark, str(tmp_path / "h.csv"), schema="target int, b double").collect()


def test_nan_is_null_on_reading(spark, tmp_path):
    spark.sql("select double('NaN') as x, float('NaN') as y, 1.0D as z").write.parquet(str(tmp_path / "nan"))
    assert tuple(tables.read_table(spark, str(tmp_path / "nan")).first()) == (None, None, 1.0)


def test_train_val_sources(spark, tmp_path):
    df = spark.range(200).selectExpr("id as target", "id as a")
    few, many = str(tmp_path / "few"), str(tmp_path / "many")
    tables.write_table(df, few, files=2)
    tables.write_table(df, many, files=10)
    train, val, label = tables.read_train_val(spark, few, many)
    assert (train.count(), val.count(), label) == (200, 200, "target")
    train, val, _ = tables.read_train_val(spark, few, val_fraction=0.25, key="a")
    assert (train.count(), val.count()) == (150, 50)
    train, val, _ = tables.read_train_val(spark, many, val_fraction=0.25, key="a")
    assert (train.count(), val.count()) == (150, 50)
    with pytest.raises(ValueError):
        tables.read_train_val(spark, many, by="days")
    train, val, _ = tables.read_train_val(spark, many, val_fraction=0.2, by="files")
    assert train.count() + val.count() == 200 and train.intersect(val).count() == 0
    assert len(val.inputFiles()) == 2


@pytest.fixture
def raw(spark, sf_dir):
    return loans(spark, sf_dir).select("src_ord", *preset.RAW_COLUMNS)


def test_job_from_raw_loans_to_metrics(spark, raw, tmp_path):
    at = lambda name: str(tmp_path / name)
    ordered = raw.repartitionByRange(3, "src_ord").sortWithinPartitions("src_ord").drop("src_ord")
    tables.write_table(synthesis.append_sentinels(ordered, 900_000_000), at("raw.csv"), "csv")
    os.makedirs(os.path.join(spark.conf.get("spark.checkpoint.dir"), "tabsmith"), exist_ok=True)  # nothing may be staged yet
    before = set(os.listdir(os.path.join(spark.conf.get("spark.checkpoint.dir"), "tabsmith")))
    config = job.merge_config({
        "run": ["features", "train", "tune"],
        "features": {"input": at("raw.csv"), "output": at("features"), "format": "csv", "header": False,
                     "files": 3, "state": at("state")},
        "train": {"input": at("features/train"), "val_input": at("features/val"), "header": False,
                  "model_dir": at("model"), "num_rounds": 4, "early_stopping": 2, "max_depth": 3, "max_bins": 32},
        "tune": {"max_jobs": 2, "parallel_jobs": 2, "output": at("trials"), "ranges": {
            "depthwise": {"learning-rate": {"type": "continuous", "min": 0.1, "max": 0.3}},
            "leafwise": {"max-depth": {"type": "integer", "min": 2, "max": 3}}}},
    })
    out = job.run(spark, config)
    f = out["features"]
    assert f["rows_in"] == raw.count() + 3 and f["rows_in"] - f["rows_out"] == f["rows_removed"]
    assert f["rows_train"] == int(f["rows_out"] * 0.8) and f["rows_train"] + f["rows_val"] == f["rows_out"]
    assert f["columns"] == ["target", *preset.FEATURES]
    assert len(tables.list_files(spark, at("features/train"))) == 3
    t = out["train"]
    assert t["train_rows"] == f["rows_train"] and t["n_features"] == 47 and 0 < t["auc_roc"] <= 1
    matrix = t["confusion_matrix"]
    assert sum(matrix.values()) == f["rows_val"]
    saved = spark.read.json(at("model/metrics")).first()
    assert saved["auc_roc"] == t["auc_roc"]
    assert json.loads(spark.read.text(at("model/params")).first()[0])["max_depth"] == 3
    assert spark.read.json(at("model/feature_importance")).count() == 47
    assert {r["algorithm"] for r in out["tune"]["by_algorithm"]} == {"depthwise", "leafwise"}
    assert spark.read.json(at("trials")).count() == 2
    assert spark.read.json(at("model/rounds")).count() >= 1
    # what the job staged is gone, and what it saved still works
    assert set(os.listdir(os.path.join(spark.conf.get("spark.checkpoint.dir"), "tabsmith"))) <= before
    state = FitState.load(spark, at("state"))
    assert state.medians.keys() == set(preset.NUMERIC_IMPUTED)
    cleaned = loan_features.clean(raw, ["src_ord"])
    assert loan_features.transform(cleaned, state).filter("city_encoded is not null").count() == f["rows_out"]


def test_feature_stream_equals_batch(spark, raw, tmp_path):
    raw = raw.filter("src_ord % 2 = 0").drop("src_ord")
    raw.write.parquet(str(tmp_path / "in"))
    cleaned = loan_features.clean(raw, ["city"])
    state = loan_features.fit(cleaned)
    stream = streams.feature_stream(streams.loan_stream(spark, str(tmp_path / "in")), state)
    query = streams.write_stream(stream, str(tmp_path / "out"), str(tmp_path / "progress"), available_now=True)
    query.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    want = loan_features.transform(cleaned, state)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_stream_drops_late_copies(spark, raw, tmp_path):
    raw = raw.filter("src_ord % 2 = 0").drop("src_ord").withColumn("at", F.lit("2024-01-01").cast("timestamp"))
    raw.unionByName(raw).write.parquet(str(tmp_path / "in"))
    state = loan_features.fit(loan_features.clean(raw.drop("at"), ["city"]))
    source = spark.readStream.schema(raw.schema).parquet(str(tmp_path / "in"))
    stream = streams.feature_stream(source, state, arrival="at")
    query = streams.write_stream(stream, str(tmp_path / "out"), str(tmp_path / "progress"), available_now=True)
    query.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == loan_features.clean(raw.drop("at"), ["city"]).count()


def test_metric_stream(spark, tmp_path):
    spark.createDataFrame([("  AUC-ROC:   0.68",), ("nothing",)], "value string").write.text(str(tmp_path / "logs"))
    stream = streams.metric_stream(spark, str(tmp_path / "logs"), logs.LGBM_PATTERNS)
    query = streams.write_stream(stream, str(tmp_path / "out"), str(tmp_path / "progress"), available_now=True)
    query.awaitTermination(60)
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [(r["name"], r["metric"]) for r in rows] == [("auc-roc", 0.68)]
