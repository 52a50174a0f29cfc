"""Time the headline queries: prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from checks import all_queries
from checks.fitting import staged_and_fitted
from tabsmith.operators import split
from tabsmith.plans import loan_features, loan_preset as preset
from tabsmith.session import build_session, stage
from tabsmith.training import model

QUERIES = [
    "scan_parquet", "normalize_education", "parse_dates", "term_months", "dedup_first", "clean_table",
    "value_counts", "impute_medians", "impute_modes", "label_maps", "feature_table", "split_exact",
    "split_hash", "auc_roc", "avg_precision", "binary_metrics", "multiclass_metrics",
    "regression_metrics", "log_loss", "log_metrics", "stage_counts", "csv_quoting", "mlogloss", "trial_ranking",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
            "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = all_queries()
    run = lambda df: df.write.format("noop").mode("overwrite").save()
    run(queries["clean_table"](spark, sf_dir))  # start the JVM's threads and caches once
    seconds = {}
    for name in QUERIES:
        start = time.time()
        run(queries[name](spark, sf_dir))
        seconds[name] = round(time.time() - start, 3)

    df, state = staged_and_fitted(spark, sf_dir)
    train, val = (stage(loan_features.transform(p, state), "features") for p in split.parts(split.hash_split(df, "loan_id", 0.2)))
    rows = train.count()
    start = time.time()
    trained = model.train(train, val, preset.TARGET, model.TreeParams(num_rounds=20, early_stopping=0))
    seconds["train_20_rounds"] = round(time.time() - start, 3)
    at_20 = model.report(model.Trained(trained.model, trained.params, preset.TARGET, trained.features, 20), model.score(trained, val)).first()["auc_roc"]
    # the shipped settings but for the most rounds, which are 500
    start = time.time()
    trained = model.train(train, val, preset.TARGET, model.TreeParams(num_rounds=60))
    seconds["train_60_rounds"] = round(time.time() - start, 3)
    # the same rows twenty times over: jobs of a size at which their start no longer counts
    copies = stage(train.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(20)))).drop("copy").repartition(2 * int(cpus)), "copies")
    start = time.time()
    model.train(copies, None, preset.TARGET, model.TreeParams(num_rounds=20, early_stopping=0))
    seconds["train_20_rounds_20_copies"] = round(time.time() - start, 3)
    start = time.time()
    row = model.report(trained, model.score(trained, val)).first()
    seconds["score_and_report"] = round(time.time() - start, 3)
    print(json.dumps({
        "metric": "total query time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "train_rows": rows, "features": len(trained.features), "auc_roc": row["auc_roc"], "auc_roc_20_rounds": at_20,
        # rows x rounds a second and thread; the baseline's first run kept 201,000 of its own
        "row_rounds_per_thread": round(20 * rows / seconds["train_20_rounds"] / int(cpus)),
        "row_rounds_per_thread_20_copies": round(400 * rows / seconds["train_20_rounds_20_copies"] / int(cpus)), "baseline_row_rounds_per_thread": 201_000,
    }))


if __name__ == "__main__":
    main()
