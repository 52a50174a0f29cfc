"""CSV, Parquet and JSON tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.functions.numeric import nan_to_null
from tabsmith.operators import split as splitting

TARGET = "target"
#: Where a row was read: the file, the block in it, and a number that grows within the block.
POSITION = ["_file", "_block", "_row"]


def list_files(spark: SparkSession, path: str) -> list[str]:
    """The data files below a path, on any file system, without reading them."""
    return sorted(spark.read.format("binaryFile").load(path).inputFiles())


def detect_format(spark: SparkSession, path: str) -> str:
    """'parquet' or 'csv': by the name, or by the files below a name without extension."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    if name.endswith(".parquet"):
        return "parquet"
    if name.endswith(".csv"):
        return "csv"
    files = list_files(spark, path)
    return "parquet" if any(f.endswith(".parquet") for f in files) else "csv"


def read_table(
    spark: SparkSession,
    paths: str | Sequence[str],
    format: str | None = None,
    schema: str | None = None,
    header: bool = True,
    multiline: bool = False,
    position: bool = False,
) -> DataFrame:
    """A file, a directory or a list of either. NaN comes in as NULL.

    CSV quotes as the standard says: a quote inside a quoted field is doubled. Fields with line
    breaks need `multiline`, which keeps Spark from splitting files. `position` adds the columns
    of POSITION, by which rows have the order of the files, sorted by path.

    Without a header CSV columns are named _c0, _c1, … and the first is the
    label. Empty CSV text is NULL. Give a schema for CSV: without one Spark
    reads the data twice.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    kind = format or detect_format(spark, paths[0])
    reader = spark.read.schema(schema) if schema else spark.read
    if kind == "parquet":
        df = reader.parquet(*paths)
    elif kind == "csv":
        options = {"header": header, "inferSchema": schema is None, "enforceSchema": not header, "quote": '"', "escape": '"', "multiLine": multiline}
        df = reader.options(**options).csv(paths)
    else:
        raise ValueError(f"unknown format {kind}")
    if position:
        place = F.col("_metadata.row_index") if kind == "parquet" else F.monotonically_increasing_id()
        df = df.select(
            "*", F.col("_metadata.file_path").alias(POSITION[0]), F.col("_metadata.file_block_start").alias(POSITION[1]),
            place.alias(POSITION[2]))
    floats = {c: nan_to_null(F.col(c)) for c, t in df.dtypes if t in ("float", "double")}
    return df.withColumns(floats) if floats else df


def label_column(df: DataFrame, name: str = TARGET) -> str:
    """The label: the column of that name, or the first one."""
    return name if name in df.columns else df.columns[0]


def read_train_val(
    spark: SparkSession,
    train_path: str,
    val_path: str | None = None,
    val_fraction: float = 0.2,
    seed: int = 42,
    key: str | None = None,
    by: str = "rows",
    **options,
) -> tuple[DataFrame, DataFrame, str]:
    """(train, val, label) from two paths, or from one that is split by "rows" or by "files".

    A split by rows uses `key` for an exact size where there is one, else a draw per row; a split
    by files takes whole files, so sizes are as even as the files.
    """
    if by not in ("rows", "files"):
        raise ValueError(f"split by {by}: use rows or files")
    if val_path is not None:
        train, val = (read_table(spark, p, **options) for p in (train_path, val_path))
        return train, val, label_column(train)
    if by == "files":
        files = list_files(spark, train_path)
        options = {"format": detect_format(spark, train_path), **options}
        chosen = splitting.file_split(files, val_fraction, seed)
        train, val = (read_table(spark, names, **options) for names in chosen)
        return train, val, label_column(train)
    df = read_table(spark, train_path, **options)
    if key is not None:
        train, val = splitting.parts(splitting.exact_split(df, key, val_fraction))
    else:
        train, val = splitting.random_split(df, val_fraction, seed)
    return train, val, label_column(df)


def write_table(
    df: DataFrame,
    path: str,
    format: str = "parquet",
    header: bool = True,
    files: int | None = None,
    mode: str = "errorifexists",
) -> None:
    """Write CSV or snappy Parquet.

    `files` costs a shuffle of the whole table; left out, each task writes its own file.
    """
    writer = (df if files is None else df.repartition(files)).write.mode(mode)
    if format == "csv":
        writer.options(
            header=header, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    elif format == "parquet":
        writer.option("compression", "snappy").parquet(path)
    else:
        raise ValueError(f"unknown format {format}")


def write_json_row(row: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A one-row table (metrics, parameters, importances) as JSON."""
    row.coalesce(1).write.mode(mode).json(path)
