"""Metrics out of training log lines. Works on a table and on a stream."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Metric names and the patterns of the lines that carry them.
NUMBER = r"([-+]?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?)"
FINAL_PATTERNS = {
    "auc-roc": r"AUC-ROC:\s+" + NUMBER,
    "auc-pr": r"AUC-PR:\s+" + NUMBER,
    "f1": r"F1:\s+" + NUMBER,
    "accuracy": r"Accuracy:\s+" + NUMBER,
    "f1-macro": r"F1 \(macro\):\s+" + NUMBER,
    "f1-weighted": r"F1 \(weight\):\s+" + NUMBER,
    "rmse": r"RMSE:\s+" + NUMBER,
    "mae": r"MAE:\s+" + NUMBER,
}
XGB_PATTERNS = {
    **FINAL_PATTERNS,
    "r2": r"R..?:\s+" + NUMBER,
    "xgb:eval-auc": r"eval-auc:" + NUMBER,
    "xgb:eval-logloss": r"eval-logloss:" + NUMBER,
    "xgb:eval-mlogloss": r"eval-mlogloss:" + NUMBER,
    "xgb:eval-rmse": r"eval-rmse:" + NUMBER,
    "xgb:eval-error": r"eval-error:" + NUMBER,
    "xgb:eval-merror": r"eval-merror:" + NUMBER,
}
LGBM_PATTERNS = {
    **FINAL_PATTERNS,
    "r2": r"R2:\s+" + NUMBER,
    "lgbm:eval-auc": r"eval's auc: " + NUMBER,
    "lgbm:eval-logloss": r"eval's binary_logloss: " + NUMBER,
    "lgbm:eval-mlogloss": r"eval's multi_logloss: " + NUMBER,
    "lgbm:eval-rmse": r"eval's rmse: " + NUMBER,
    "lgbm:eval-l2": r"eval's l2: " + NUMBER,
    "lgbm:eval-multi-error": r"eval's multi_error: " + NUMBER,
}


def _literal_start(pattern: str) -> str:
    """The plain text that every match begins with."""
    start = re.match(r"[A-Za-z0-9' :_-]*", pattern).group()
    return start[:-1] if pattern[len(start):len(start) + 1] in ("?", "*", "{") else start


def _found(line: Column, pattern: str) -> Column:
    # most lines hold none of the metrics; a text search rules them out faster than a pattern
    value = F.regexp_extract(line, pattern, 1)
    return F.when(line.contains(_literal_start(pattern)), value).otherwise("")


def extract_metrics(lines: DataFrame, patterns: Mapping[str, str], line: str = "value") -> DataFrame:
    """The columns of `lines` with (name, metric) for each metric that a line holds, instead of the line."""
    found = F.array(*[
        F.struct(F.lit(name).alias("name"), _found(F.col(line), p).alias("text"))
        for name, p in patterns.items()
    ])
    others = [c for c in lines.columns if c != line]
    hits = lines.select(*others, F.inline(found)).filter(F.col("text") != "")
    return hits.select(*others, "name", F.col("text").cast("double").alias("metric"))
