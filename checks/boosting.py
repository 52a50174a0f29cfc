"""Histogram boosting on line items, next to the same trees grown in SQL."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import boosted_sql as sql
from checks.registry import query
from tabsmith.operators import split
from tabsmith.session import stage
from tabsmith.training import model

#: Few rounds and levels, so that SQL can follow; all rows.
SMALL = dict(num_rounds=3, early_stopping=0, max_depth=2, learning_rate=0.3, min_child=20, subsample=1.0, colsample=1.0)
RETURNED = "(l_returnflag = 'R')::int"
FLAG = "case l_returnflag when 'A' then 0 when 'N' then 1 else 2 end"


@lru_cache(maxsize=8)
def _parts(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(train, val) of line items with their keys and three labels."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", F.year("l_shipdate").alias("ship_year"),
        (F.col("l_returnflag") == "R").cast("int").alias("returned"),
        F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2).alias("flag"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("key"))
    return tuple(stage(part.drop("key"), "items") for part in split.parts(split.hash_split(rows, "key", 0.2)))


@lru_cache(maxsize=8)
def _trained(spark, sf_dir, label: str, objective: str) -> tuple[model.Trained, DataFrame, DataFrame]:
    train, val = (part.select(label, *sql.FEATURES) for part in _parts(spark, sf_dir))
    return model.train(train, val, label, model.TreeParams(objective=objective, **SMALL)), train, val


def _nodes(trained: model.Trained) -> DataFrame:
    return model.trees(trained).select(
        "round", "class", "place", "feature", F.round("threshold", 6).alias("threshold"), F.round("gain", 4).alias("gain"),
        F.round("cover", 4).alias("cover"), "rows", F.round("value", 6).alias("value"))


@query("boosted_trees", sql.boosted(RETURNED, sql.NODES))
def boosted_trees(spark, sf_dir):
    return _nodes(_trained(spark, sf_dir, "returned", "binary:logistic")[0])


@query("boosted_scores", sql.boosted(RETURNED, sql.SCORES))
def boosted_scores(spark, sf_dir):
    trained = _trained(spark, sf_dir, "returned", "binary:logistic")[0]
    return model.score(trained, _parts(spark, sf_dir)[1]).select(
        "l_orderkey", "l_linenumber", F.round("score", 6).alias("score"), "predicted")


@query("boosted_importance", sql.boosted(RETURNED, sql.IMPORTANCE))
def boosted_importance(spark, sf_dir):
    trained = _trained(spark, sf_dir, "returned", "binary:logistic")[0]
    out = None
    for kind in model.IMPORTANCE:
        part = model.importance(trained, kind).select(F.lit(kind).alias("kind"), "feature", F.round("importance", 4).alias("importance"))
        out = part if out is None else out.unionByName(part)
    return out


def _curves(trained, train, val) -> DataFrame:
    return model.metric_curves(trained, {"train": train, "val": val}).withColumn("value", F.round("value", 6))


@query("boosted_curves", sql.boosted(RETURNED, sql.CURVES))
def boosted_curves(spark, sf_dir):
    return _curves(*_trained(spark, sf_dir, "returned", "binary:logistic"))


@query("boosted_classes", sql.boosted(FLAG, sql.NODES, "softmax", classes=3))
def boosted_classes(spark, sf_dir):
    """One softmax over three classes, a tree for each in every round."""
    return _nodes(_trained(spark, sf_dir, "flag", "multi:softprob")[0])


@query("boosted_class_curves", sql.boosted(FLAG, sql.CLASS_CURVES, "softmax", classes=3))
def boosted_class_curves(spark, sf_dir):
    return _curves(*_trained(spark, sf_dir, "flag", "multi:softprob"))


@query("boosted_poisson", sql.boosted(FLAG, sql.NODES, "poisson"))
def boosted_poisson(spark, sf_dir):
    return _nodes(_trained(spark, sf_dir, "flag", "count:poisson")[0])
