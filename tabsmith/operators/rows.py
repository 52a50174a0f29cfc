"""Choosing rows and columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in the given order.

    Filtering on row_number = 1 lets Spark cut every key to one row per input
    partition before the shuffle, so a key with a third of all rows arrives as
    one row per partition. Name enough columns in `order` to make it unique:
    a tie would be broken by arrival.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_row", F.row_number().over(window)).filter("_row = 1").drop("_row")


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    # unlike dropna, these tests reach a Parquet scan
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df


def keep_values(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    return df.filter(F.col(column).isin(*allowed))


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def sample_by_key(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """The rows whose key's hash falls below `fraction`: the same rows however the table is partitioned.

    The hash is the md5 of seed and key. Rows with a null key are left out.
    """
    if not 0 <= fraction <= 1:
        raise ValueError("fraction must lie between 0 and 1")
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), 1, 8)
    return df.filter(F.conv(digits, 16, 10).cast("bigint") < int(fraction * (1 << 32)))
