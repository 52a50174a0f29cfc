"""Fitted state of a table: medians, modes and label codes."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.operators.ordering import dense_codes
from tabsmith.operators.selection import exact_medians
from tabsmith.session import stage

CODE_SCHEMA = "name string, value string, code long"

def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(name, value, n) over the non-null values of text columns, in one aggregation.

    Values are counted before the shuffle, so a value with a third of all rows
    is one row per partition.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in columns])
    return (
        df.select(*columns)
        .select(F.inline(pairs))
        .filter(F.col("value").isNotNull())
        .groupBy("name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def modes(counts: DataFrame) -> DataFrame:
    """(name, mode): the most frequent value of each column, the smallest one on a tie."""
    best = F.min(F.struct((-F.col("n")).alias("rank"), F.col("value"))).alias("best")
    return counts.groupBy("name").agg(best).select("name", F.col("best.value").alias("mode"))


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact medians, 0.0 for a column without values."""
    return {c: 0.0 if v is None else float(v) for c, v in exact_medians(df, columns).items()}


@dataclass
class FitState:
    """What is learnt from a table: a number or text per column, and the label codes as a table (name, value, code)."""

    medians: dict[str, float] = field(default_factory=dict)
    modes: dict[str, str] = field(default_factory=dict)
    sizes: dict[str, int] = field(default_factory=dict)  # categories per encoded column
    codes: DataFrame | None = None

    def fill_values(self) -> dict:
        return {**self.medians, **self.modes}

    def save(self, spark: SparkSession, path: str) -> None:
        """Everything below `path`: the work folder may be cleared afterwards."""
        plain = {"medians": self.medians, "modes": self.modes, "sizes": self.sizes}
        root = path.rstrip("/")
        spark.createDataFrame([(json.dumps(plain),)], "state string").coalesce(1).write.mode("overwrite").text(f"{root}/numbers")
        codes = self.codes if self.codes is not None else spark.createDataFrame([], CODE_SCHEMA)
        codes.write.mode("overwrite").parquet(f"{root}/codes")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FitState:
        root = path.rstrip("/")
        plain = json.loads(spark.read.text(f"{root}/numbers").first()[0])
        return cls(**plain, codes=spark.read.schema(CODE_SCHEMA).parquet(f"{root}/codes"))


def fit(
    df: DataFrame,
    numeric: Sequence[str] = (),
    categorical: Sequence[str] = (),
    encoded: Sequence[str] = (),
    unknown: str = "unknown",
) -> FitState:
    """Medians of `numeric`, modes of `categorical`, sorted label codes of `encoded`.

    Columns that the table does not have are skipped. Modes and codes come from
    one count of values: filling in a mode never adds a category, unless a
    column has no value at all and its only category becomes `unknown`.
    """
    numeric = [c for c in numeric if c in df.columns]
    categorical = [c for c in categorical if c in df.columns]
    encoded = [c for c in encoded if c in df.columns]
    state = FitState(medians=medians(df, numeric) if numeric else {})
    texts = list(dict.fromkeys([*categorical, *encoded]))
    if not texts:
        return state
    counts = stage(value_counts(df, texts), "value-counts")
    summary = counts.groupBy("name").agg(
        F.count(F.lit(1)).alias("size"),
        F.min(F.struct((-F.col("n")).alias("rank"), F.col("value"))).alias("best"),
    )
    found = {r["name"]: r for r in summary.collect()}  # one row per column
    state.modes = {c: found[c]["best"]["value"] if c in found else unknown for c in categorical}
    state.sizes = {c: found[c]["size"] if c in found else int(c in categorical) for c in encoded}
    if encoded:
        values = counts.filter(F.col("name").isin(*encoded)).select("name", "value")
        empty = [c for c in encoded if c not in found and c in categorical]
        if empty:
            names = F.explode(F.array(*map(F.lit, empty)))
            values = values.unionByName(df.sparkSession.range(1).select(names.alias("name"), F.lit(unknown).alias("value")))
        state.codes = stage(dense_codes(values), "codes")
    return state


#: Categories of a column that are looked up without a join.
INLINE_CODES = 100


def fill_missing(df: DataFrame, values: dict) -> DataFrame:
    """Constants in place of NULL (and NaN), for the columns that exist."""
    return df.fillna({c: v for c, v in values.items() if c in df.columns})


def encode_labels(df: DataFrame, state: FitState, suffix: str = "_encoded") -> DataFrame:
    """A float code column for each fitted label column; a value not seen in the fit gives NULL.

    Columns of up to INLINE_CODES categories are looked up in a map within the projection. Codes of others are joined without a
    hint: Spark's own threshold decides on a broadcast; with a large table, values are unique in it, so a hot value is
    split by the adaptive skew join.
    """
    present = [c for c in state.sizes if c in df.columns]
    small = [c for c in present if state.sizes[c] <= INLINE_CODES]
    inline: dict[str, list] = {c: [] for c in small}
    if small:
        for r in state.codes.filter(F.col("name").isin(*small)).collect():  # INLINE_CODES rows per column at most
            inline[r["name"]] += [F.lit(r["value"]), F.lit(float(r["code"])).cast("float")]
    out = df
    for c in present:
        if c in inline:
            found = F.try_element_at(F.create_map(*inline[c]), F.col(c)) if inline[c] else F.lit(None)
            out = out.withColumn(c + suffix, found.cast("float"))
            continue
        table = state.codes.filter(F.col("name") == c).select(
            F.col("value").alias(c), F.col("code").cast("float").alias(c + suffix))
        out = out.join(table, c, "left")
    return out.select(*df.columns, *[c + suffix for c in present])
