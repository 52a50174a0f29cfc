"""Row counts, schema reports and value distributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def observe_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows as they pass, without another scan; read the result after an action."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def stage_counts(raw: DataFrame, key: str, order: str, label: str, allowed: Sequence[str]) -> DataFrame:
    """Rows in, rows left after deduplication and the label filter, and rows removed: one scan.

    Keys are combined before the shuffle, so a hot key costs one row per partition.
    """
    per_key = raw.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.min_by(label, order).alias("first_label")
    )
    kept = F.col(key).isNotNull() & F.col("first_label").isin(*allowed)
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_in"), F.count_if(kept).alias("rows_out")
    )
    return totals.withColumn("rows_removed", F.col("rows_in") - F.col("rows_out"))


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column, in order: position, name, rows of the table, rows with a value."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in df.columns])
    entries = F.array(*[
        F.struct(
            F.lit(i + 1).alias("position"), F.lit(c).alias("name"),
            F.col("_rows").alias("rows"), F.col(f"`{c}`").alias("present"),
        )
        for i, c in enumerate(df.columns)
    ])
    return counts.select(F.inline(entries))


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Count and percentage of each value of a low-cardinality column."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(column, "n", (F.col("n") * 100.0 / total).alias("percent"))
