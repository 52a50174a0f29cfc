"""Training and validation parts. Apart from `random_split`, a row's part depends on its key only."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabsmith.operators.selection import select_ranks

PART = "is_val"


def key_hash(key: Column, hex_digits: int = 15) -> Column:
    """The first digits of the key's md5 as a whole number; 15 digits are 60 bits."""
    digits = F.substring(F.md5(key.cast("string")), 1, hex_digits)
    return F.conv(digits, 16, 10).cast("bigint")


def hash_split(df: DataFrame, key: str, val_fraction: float) -> DataFrame:
    """Mark about `val_fraction` of the rows; a key keeps its part in every run and every table."""
    return df.withColumn(PART, key_hash(F.col(key), 8) % 1000 < val_fraction * 1000)


def exact_split(df: DataFrame, key: str, val_fraction: float) -> DataFrame:
    """Mark all but the first floor(n * (1 - val_fraction)) rows in the order of the key's hash.

    The hash at the cut is found by counting, so no row is sorted or moved;
    the split itself is a comparison per row. Keys must be unique and not null.
    """
    hashed = df.select(key_hash(F.col(key)).alias("h"), F.col(key))

    def last_of_train(n: int) -> tuple[int, int]:
        at = max(int(n * (1 - val_fraction)) - 1, 0)
        return at, at

    found = select_ranks(hashed, ["h"], last_of_train)["h"]
    train = int(found.n * (1 - val_fraction))
    if train == 0:
        return df.withColumn(PART, F.lit(True))
    cut, room = found.low, train - found.below
    h = key_hash(F.col(key))
    if room == found.equal:
        return df.withColumn(PART, h > cut)
    # several keys share the hash at the cut: different keys by chance, a few at most
    ties = hashed.filter(F.col("h") == cut).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    repeated = ties.filter("n > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"{key} repeats ({repeated[0][0]!r}); deduplicate before an exact split")
    kept = [r[0] for r in ties.orderBy(key).limit(room).collect()]
    return df.withColumn(PART, (h > cut) | ((h == cut) & ~F.col(key).isin(*kept)))


def random_split(df: DataFrame, val_fraction: float, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, val) by a draw per row; sizes are approximate."""
    train, val = df.randomSplit([1 - val_fraction, val_fraction], seed)
    return train, val


def file_split(files: Sequence[str], val_fraction: float, seed: int = 42) -> tuple[list[str], list[str]]:
    """(train, val) file names: a seeded permutation of the sorted names, at least one for training."""
    names = sorted(files)
    order = np.random.RandomState(seed).permutation(len(names))
    train = max(1, int(len(names) * (1 - val_fraction)))
    return [names[i] for i in order[:train]], [names[i] for i in order[train:]]


def parts(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(train, val) of a marked table, without the mark."""
    return df.filter(~F.col(PART)).drop(PART), df.filter(PART).drop(PART)
