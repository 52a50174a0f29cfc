"""New loans to features with a fitted state, and metrics out of growing training logs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tabsmith.operators import logs, rows
from tabsmith.operators.fit import FitState
from tabsmith.plans import loan_features, loan_preset as preset


def loan_stream(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """Raw loans from the Parquet files that arrive below `path`."""
    reader = spark.readStream.schema(preset.raw_schema()).option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def feature_stream(
    raw: DataFrame, state: FitState, arrival: str | None = None, delay: str = "1 hour"
) -> DataFrame:
    """The feature table of a stream of raw loans.

    With an `arrival` timestamp column, copies of a loan that come within
    `delay` of each other are dropped and their keys forgotten afterwards; an
    unbounded memory of keys would grow for ever.
    """
    known = rows.drop_null_keys(raw, [preset.KEY])
    if arrival is not None:
        known = known.withWatermark(arrival, delay).dropDuplicatesWithinWatermark([preset.KEY])
    cleaned = rows.keep_values(loan_features.clean_rows(known), preset.LABEL, preset.ALLOWED_LABELS)
    return loan_features.transform(cleaned, state)


def metric_stream(spark: SparkSession, path: str, patterns: Mapping[str, str]) -> DataFrame:
    """(file, name, metric) from the text files that arrive below `path`."""
    lines = spark.readStream.text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    return logs.extract_metrics(lines, patterns)


def write_stream(df: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Append to Parquet; files and progress are committed together, so a restart repeats nothing."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)
