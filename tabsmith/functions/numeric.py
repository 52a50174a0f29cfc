"""Guards, ratios and bins over numeric columns. NULL in gives NULL out unless stated."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(x: Column) -> Column:
    # NaN equals itself and sorts above every number in Spark, so it must go before any test
    return F.nullif(x, F.lit(float("nan")))


def in_range(x: Column, low: float, high: float) -> Column:
    """x where low <= x <= high, else NULL."""
    return F.when(x.between(low, high), x)


def above(x: Column, bound: float, inclusive: bool = False) -> Column:
    """x where it is greater than (or at) `bound`, else NULL."""
    return F.when(x >= bound if inclusive else x > bound, x)


def clip_upper(x: Column, bound: float) -> Column:
    # not least(): that would turn NULL into the bound
    return F.when(x > bound, F.lit(bound)).otherwise(x)


def clip(x: Column, low: float, high: float) -> Column:
    """x limited to [low, high]; x must not be NULL."""
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator where the denominator is positive, else NULL."""
    return F.when(denominator > 0, numerator / denominator)


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def right_closed_bin(x: Column, edges: Sequence[float]) -> Column:
    """Index of the bin (edge[i], edge[i+1]] that holds x; the first bin holds its left edge too."""
    bin_ = F.when((x < edges[0]) | (x > edges[-1]), F.lit(None))
    for i, edge in enumerate(edges[1:]):
        bin_ = bin_.when(x <= edge, F.lit(i))
    return bin_


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.when(condition, 1).otherwise(0)
