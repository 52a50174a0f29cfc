"""Dirt, copies and sentinel rows added to a given table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabsmith.plans import loan_preset as preset

SENTINEL_ROWS = 3


def inject_dirt(df: DataFrame, rates: Mapping[str, float], draws: Mapping[str, Column], values: Mapping[str, Column] | None = None) -> DataFrame:
    """Blank (or replace by `values`) each column in about `rates` of the rows.

    `draws` has a number in [0, 1) per column, each drawn by itself, so several columns of a row may be hit.
    """
    values = values or {}
    return df.withColumns({
        c: F.when(draws[c] < rate, values.get(c, F.lit(None))).otherwise(F.col(c)) for c, rate in rates.items()})


def inject_duplicates(df: DataFrame, copied: Column, blanks: Mapping[str, Column]) -> DataFrame:
    """Every row, and a second copy of those where `copied` holds; a copy's column is '' where `blanks` says so.

    The copies come out of the same pass as the rows. `copy` is 1 for a copy, 0 for an original.
    """
    numbers = F.when(copied, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    both = df.withColumn("copy", F.explode(numbers))
    return both.withColumns({
        c: F.when((F.col("copy") == 1) & blank, "").otherwise(F.col(c)) for c, blank in blanks.items()})


def append_sentinels(df: DataFrame, start: int, key: str = preset.KEY) -> DataFrame:
    """A few last rows that hold a key only; the label filter removes them."""
    empty = df.sparkSession.range(start, start + SENTINEL_ROWS).select(
        F.concat(F.lit("LN-"), F.lpad(F.col("id").cast("string"), 10, "0")).alias(key))
    return df.unionByName(empty, allowMissingColumns=True)
