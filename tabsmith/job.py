"""One entry for spark-submit: spark-submit -m tabsmith.job <config.yaml> [section.key=value ...]

Steps, as the config's `run` lists them: features, train, tune. Tables that a job stages in the
shared folder are removed when it ends.
"""

from __future__ import annotations

import copy
import json
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.operators import counts, split
from tabsmith.operators.fit import FitState
from tabsmith.plans import loan_features, loan_preset as preset
from tabsmith.session import build_session, job_folder, stage
from tabsmith.sources import tables
from tabsmith.training import boosting, model, tune

# The settings of a run that names none.
DEFAULTS = {
    "run": ["features", "train"],
    "features": {
        "input": "raw_loans", "input_format": None, "output": "features", "format": "parquet",
        "header": True, "files": None, "val_split": 0.2, "fit_on": "all", "state": None, "order": None,
        "partitions": None, "multiline": False,
    },
    "train": {
        "input": "features/train", "val_input": "features/val", "val_split": 0.2, "split_by": "rows", "header": True,
        "input_format": None, "model_dir": "model", "objective": "binary:logistic",
        "engine": "histogram", "num_rounds": 500, "early_stopping": 20, "stop_rule": "patience", "eval_metric": (), "max_depth": 7, "learning_rate": 0.1,
        "subsample": 0.8, "colsample": 0.8, "min_child": 5, "max_bins": 256, "threshold": 0.5, "reg_lambda": 1.0,
        "min_child_weight": 0.0, "min_split_gain": 0.0, "quantile_alpha": 0.5, "tweedie_power": 1.5, "huber_delta": 1.0,
        "seed": 42, "class_weight_sample_rows": -1,
    },
    "tune": {
        "algorithms": {"depthwise": {}, "leafwise": {"objective": "binary", "min_child": 20}},
        "ranges": {}, "max_jobs": 20, "parallel_jobs": 4, "strategy": "random",
        "metric": "auc_roc", "direction": None, "output": "trials", "ledger": None, "seed": 42,
    },
}
TREE_KEYS = (
    "objective", "num_rounds", "early_stopping", "stop_rule", "eval_metric", "max_depth", "learning_rate", "subsample",
    "colsample", "min_child", "max_bins", "threshold", "seed", "engine", "reg_lambda", "min_child_weight", "min_split_gain",
    "quantile_alpha", "tweedie_power", "huber_delta",
)
STEPS = ("features", "train", "tune")


def merge_config(given: dict | None, overrides: list[str] = ()) -> dict:
    """Defaults, then the file, then `section.key=value`; an unknown name is an error."""
    config = copy.deepcopy(DEFAULTS)
    for section, values in (given or {}).items():
        if section not in config:
            raise ValueError(f"unknown section {section}")
        if section == "run":
            config["run"] = [values] if isinstance(values, str) else list(values)
            continue
        for key, value in values.items():
            _set(config, section, key, value)
    for text in overrides:
        name, _, value = text.partition("=")
        if name == "run":
            config["run"] = value.split(",")
            continue
        section, _, key = name.partition(".")
        if section not in config:
            raise ValueError(f"unknown section {section}")
        _set(config, section, key, _parse(value))
    unknown = [s for s in config["run"] if s not in STEPS]
    if unknown:
        raise ValueError(f"unknown steps: {', '.join(unknown)}")
    return config


def _set(config: dict, section: str, key: str, value) -> None:
    if key not in config[section]:
        raise ValueError(f"unknown setting {section}.{key}")
    config[section][key] = value


def _parse(text: str):
    try:
        return json.loads(text)
    except ValueError:
        return text


def load_config(path: str) -> dict:
    with open(path) as f:
        if path.endswith(".json"):
            return json.load(f)
        import yaml  # only a YAML config needs it

        return yaml.safe_load(f)


def run_features(spark: SparkSession, c: dict) -> dict:
    """Read, clean once into the shared folder, fit from it, then write the feature table."""
    kind = c["input_format"] or tables.detect_format(spark, c["input"])
    order = [c["order"]] if isinstance(c["order"], str) else c["order"]
    raw = tables.read_table(
        spark, c["input"], kind, preset.raw_schema() if kind == "csv" else None, multiline=c["multiline"], position=not order)
    if c["partitions"]:  # few or unsplittable files: deal the rows out
        raw = raw.repartition(c["partitions"])
    raw, seen_raw = counts.observe_rows(raw, "rows in")
    cleaned, seen_clean = counts.observe_rows(loan_features.clean(raw, order), "rows out")
    cleaned = stage(cleaned, "cleaned")
    rows_in, rows_out = seen_raw.get["rows"], seen_clean.get["rows"]
    marked = split.exact_split(cleaned, preset.KEY, c["val_split"]) if c["val_split"] else None
    if c["fit_on"] == "train" and marked is not None:
        state = loan_features.fit(split.parts(marked)[0])
    else:
        state = loan_features.fit(cleaned)
    if c["state"]:
        state.save(spark, c["state"])
    summary = {
        "rows_in": rows_in, "rows_out": rows_out, "rows_removed": rows_in - rows_out,
        "categories": state.sizes,
    }
    outputs = {"": cleaned} if marked is None else dict(zip(("/train", "/val"), split.parts(marked)))
    for suffix, part in outputs.items():
        features, seen = counts.observe_rows(loan_features.transform(part, state), f"written{suffix}")
        path = c["output"].rstrip("/") + suffix
        tables.write_table(features, path, c["format"], c["header"], c["files"])
        summary[f"rows{suffix.replace('/', '_')}"] = seen.get["rows"]
        summary["columns"] = features.columns
    return summary


def read_feature_tables(spark: SparkSession, c: dict) -> tuple[DataFrame, DataFrame, str]:
    kind = c["input_format"] or tables.detect_format(spark, c["input"])
    schema = None
    if kind == "csv" and c["objective"].startswith("binary"):
        schema = preset.feature_schema() if c["header"] else ", ".join(
            f"_c{i} {column.split()[1]}" for i, column in enumerate(preset.feature_schema().split(", ")))
    train, val, label = tables.read_train_val(
        spark, c["input"], c["val_input"], c["val_split"], c["seed"],
        format=kind, schema=schema, header=c["header"], by=c["split_by"])
    if kind == "csv":
        # a fit passes over its input several times; parse the text once
        train, val = stage(train, "train"), stage(val, "val")
    return train, val, label


def tree_params(settings: dict) -> model.TreeParams:
    metrics = settings.get("eval_metric") or ()
    return model.TreeParams(**{**settings, "eval_metric": tuple(metrics.split(",") if isinstance(metrics, str) else metrics)})


def run_train(spark: SparkSession, c: dict) -> dict:
    start = time.time()
    train, val, label = read_feature_tables(spark, c)
    params = tree_params({k: c[k] for k in TREE_KEYS})
    weight = None
    if params.task == "binary":
        sample = c["class_weight_sample_rows"]
        weight = model.evaluate.class_balance(train, label, None if sample < 0 else sample).first()["weight"]
    trained = model.train(train, val, label, params, weight)
    scored = model.score(trained, val)
    row = model.run_report(trained, scored, train.count(), val.count(), time.time() - start)
    row = stage(row, "metrics")
    folder = c["model_dir"].rstrip("/")
    model.round_losses(trained).coalesce(1).write.mode("overwrite").json(f"{folder}/rounds")
    tables.write_json_row(row, f"{folder}/metrics", "overwrite")
    tables.write_json_row(model.importance(trained), f"{folder}/feature_importance", "overwrite")
    params_json = json.dumps({**model.params_row(trained), "positive_weight": weight})
    spark.createDataFrame([(params_json,)], "params string").coalesce(1).write.mode("overwrite").text(f"{folder}/params")
    if isinstance(trained.model, boosting.Boosted):
        boosting.save(trained.model, spark, f"{folder}/model")
        curves = model.metric_curves(trained, {"train": train, "val": val})
        curves.coalesce(1).write.mode("overwrite").json(f"{folder}/curves")
        return row.first().asDict(recursive=True)
    models = {f"class={k}": m for k, m in enumerate(trained.model.models)} if params.task == "multiclass" else {"": trained.model}
    for name, one in models.items():
        one.write().overwrite().save("/".join(filter(None, [folder, "model", name])))
    return row.first().asDict(recursive=True)


def run_tune(spark: SparkSession, c: dict, base: dict) -> dict:
    train, val, label = read_feature_tables(spark, base)
    fixed = {k: base[k] for k in TREE_KEYS}
    spaces = {"depthwise": tune.DEPTHWISE_SPACE, "leafwise": tune.LEAFWISE_SPACE}
    in_turns = c["strategy"] == "bayesian"
    draw = {"random": lambda space, n: tune.random_trials(space, n, c["seed"]), "grid": tune.grid_trials,
            "bayesian": lambda space, n: (space, n)}[c["strategy"]]
    names = list(c["algorithms"])
    searches = {}
    for i, name in enumerate(names):
        # the budget is shared; the first algorithms take what is left over
        n = c["max_jobs"] // len(names) + (i < c["max_jobs"] % len(names))
        space = tune.space_from_config(c["ranges"][name]) if name in c["ranges"] else spaces[name]
        params = tree_params({**fixed, "eval_metric": (), **c["algorithms"][name]})
        searches[name] = (params, *draw(space, n)) if in_turns else (params, draw(space, n))
    if in_turns:
        found = tune.tune_in_turns(
            train, val, label, searches, c["metric"], c["parallel_jobs"], c["seed"], c["direction"], c["ledger"])
    else:
        found = tune.tune(train, val, label, searches, c["metric"], c["parallel_jobs"], c["ledger"])
    trials = stage(found, "trials")
    direction = c["direction"] or tune.direction_of(c["metric"])
    trials.coalesce(1).write.mode("overwrite").json(c["output"])
    return {
        "best": tune.top_trials(trials, 1, direction).first().asDict(),
        "by_algorithm": [r.asDict() for r in tune.best_by_algorithm(trials, direction).collect()],
    }


def run(spark: SparkSession, config: dict) -> dict:
    results = {}
    with job_folder(spark):
        for step in config["run"]:
            if step == "features":
                results[step] = run_features(spark, config[step])
            elif step == "train":
                results[step] = run_train(spark, config[step])
            else:
                results[step] = run_tune(spark, config[step], config["train"])
    return results


def main(argv: list[str]) -> None:
    given = load_config(argv[0]) if argv and "=" not in argv[0] else None
    config = merge_config(given, [a for a in argv if "=" in a])
    print(json.dumps(run(build_session("tabsmith"), config), indent=2, default=str))


if __name__ == "__main__":
    main(sys.argv[1:])
