"""Exact order statistics of large columns, in three passes whatever the values are.

The first pass sketches every column and takes two edges that surely enclose the wanted ranks;
the second counts what lies below them and sketches the rows between; the third counts
the few values that are left between the narrower edges and picks the rank from their counts.
Only the order of values matters, so infinities and any spread of values are fine. A task
sends one sketch per column, and in the last pass one row per value it has there.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType
from pyspark.sql.window import Window

#: Shares that a sketch is asked at.
_STEPS = 200
#: Items that a sketch keeps per level, and what it misses a rank by at most, as one in so many rows. The error of
#: 2.3 / 4096^0.9 holds with 99 % for one rank; three times as much is allowed for, and counts check it.
SKETCH_ITEMS, ACCURACY = 4_096, 260


@dataclass
class RankValue:
    """The values at the lower and upper wanted rank of one column."""

    n: int
    low: float | int | None
    high: float | int | None
    below: int = 0  # rows smaller than `low`
    equal: int = 0  # rows equal to `low`


def _enclosing(values: Sequence, first: float, last: float, n: int, accuracy: int) -> tuple:
    """Of a sketch's values at even shares, those that surely lie around ranks `first` to `last` of `n` rows."""
    slack = n / accuracy + 1
    low = max(0, math.floor((first - slack) / n * _STEPS))
    high = min(_STEPS, math.ceil((last + 1 + slack) / n * _STEPS))
    low, high = values[low], values[high]
    if isinstance(low, int):  # sketches hold numbers in double precision
        return low - (abs(low) >> 50) - 1, high + (abs(high) >> 50) + 1
    return low, high


def _at_shares(value: Column, whole: bool) -> Column:
    """The values at the shares, from one sketch; null if there is no value."""
    shares = F.lit(np.linspace(0.0, 1.0, _STEPS + 1))  # a numpy array becomes one literal, a list one per share
    if whole:
        found = F.kll_sketch_get_quantile_bigint(F.kll_sketch_agg_bigint(value, SKETCH_ITEMS), shares)
    else:
        found = F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(value, SKETCH_ITEMS), shares)
    return F.when(F.count(value) > 0, found)


def select_ranks(
    df: DataFrame,
    columns: Sequence[str],
    ranks: Callable[[int], tuple[int, int]],
    accuracy: int = ACCURACY,
) -> dict[str, RankValue]:
    """For each column, the values at ranks `ranks(non-null rows)`; the two are equal or neighbours.

    Columns must share one numeric type. NULL is skipped; NaN must be NULL already.
    """
    whole = {c: isinstance(df.schema[c].dataType, IntegralType) for c in columns}
    # which two are needed depends on the count
    counts = df.agg(
        *[F.count(c).alias(c) for c in columns],
        *[_at_shares(F.col(c), whole[c]).alias(f"{c}__at") for c in columns]).first()
    wanted, spans = {}, {}
    for c in columns:
        n = counts[c]
        if n:
            first, last = wanted[c] = ranks(n)
            spans[c] = _enclosing(counts[f"{c}__at"], first, last, n, accuracy)
    if not wanted:
        return {c: RankValue(0, None, None) for c in columns}

    # between the edges: how many rows lie below, how many inside, and a sketch of those inside
    inside = {c: F.col(c).between(*spans[c]) for c in spans}
    second = df.agg(
        *[F.count_if(F.col(c) < spans[c][0]).alias(f"{c}__below") for c in spans],
        *[F.count_if(inside[c]).alias(f"{c}__n") for c in spans],
        *[_at_shares(F.when(inside[c], F.col(c)), whole[c]).alias(f"{c}__at") for c in spans],
    ).first()
    narrow = {}
    for c, (first, last) in wanted.items():
        below, n = second[f"{c}__below"], second[f"{c}__n"]
        if not below <= first <= last < below + n:
            raise RuntimeError(f"{c}: a sketch is worse than its accuracy says")
        narrow[c] = _enclosing(second[f"{c}__at"], first - below, last - below, n, accuracy)

    # the values left, counted; what lies below them is one more row per column, without a value
    parts = F.array(*[
        F.struct(
            F.lit(i).alias("i"), (F.col(c) < narrow[c][0]).alias("under"),
            F.when(F.col(c).between(*narrow[c]), F.col(c)).alias("x"))
        for i, c in enumerate(narrow)])
    left = df.select(F.inline(parts)).filter(F.col("under") | F.col("x").isNotNull())
    counted = left.groupBy("i", "under", "x").agg(F.count(F.lit(1)).alias("n"))
    by_rank = Window.partitionBy("i").orderBy(F.col("under").desc(), "x")
    upto = counted.withColumn("upto", F.sum("n").over(by_rank))
    of_column = lambda at: F.element_at(F.array(*[F.lit(wanted[c][at]).cast("long") for c in narrow]), F.col("i") + 1)
    rows = upto.filter(~F.col("under") & (F.col("upto") > of_column(0)) & (F.col("upto") - F.col("n") <= of_column(1))).orderBy("i", "x").collect()
    done = {c: RankValue(0, None, None) for c in columns}
    for i, c in enumerate(narrow):
        own = [r for r in rows if r["i"] == i]  # one row per wanted rank at most
        if not own or own[0]["upto"] - own[0]["n"] > wanted[c][0] or own[-1]["upto"] <= wanted[c][1]:
            raise RuntimeError(f"{c}: a sketch is worse than its accuracy says")
        done[c] = RankValue(counts[c], own[0]["x"], own[-1]["x"], own[0]["upto"] - own[0]["n"], own[0]["n"])
    return done


def exact_medians(df: DataFrame, columns: Sequence[str], accuracy: int = ACCURACY) -> dict[str, float | None]:
    """Median of each column; the mean of the two middle values when the count is even."""
    if not columns:
        return {}
    typed = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    picked = select_ranks(typed, columns, lambda n: ((n - 1) // 2, n // 2), accuracy)
    return {c: None if v.n == 0 else v.low if v.low == v.high else (v.low + v.high) / 2 for c, v in picked.items()}
