"""What several corpus operators share: row keys, word patterns, staging, Arrow helpers."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.session import stage  # noqa: F401 - the operators import it from here

#: The letters that are lower-cased, and only those.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it, unless their path names it already."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shielded(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """An operator whose own columns begin with two underscores, for tables that have such columns too.

    Those of the table go through it under other names, also where an argument names them, and come back under their own.
    """

    @wraps(operator)
    def run(df: DataFrame, *args, **settings) -> DataFrame:
        renamed: dict[str, str] = {}
        for c in df.columns:
            if c.startswith("__"):
                name = free_name(df, f"kept{c}")
                while name.lower() in {n.lower() for n in renamed.values()}:
                    name += "_"
                renamed[c] = name
        if not renamed:
            return operator(df, *args, **settings)
        own = lambda x: renamed.get(x, x) if isinstance(x, str) else [own(y) for y in x] if isinstance(x, list) else x
        out = operator(df.withColumnsRenamed(renamed), *map(own, args), **{k: own(v) for k, v in settings.items()})
        return out.withColumnsRenamed({name: c for c, name in renamed.items()})

    return run


#: Rows that become Python objects at once.
SLICE_ROWS = 1_000


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches hold up to 64 MB; parts of them keep a worker's Python objects few."""
    for b in batches:
        for at in range(0, b.num_rows, SLICE_ROWS):
            yield b.slice(at, SLICE_ROWS)


def map_rows(df: DataFrame, columns: Sequence[str], fn: Callable[..., Iterator[dict]], schema: str) -> DataFrame:
    """Run `fn` over lists of the given columns' values, one Arrow batch at a time.

    `fn` gets an iterator of tuples of lists, so it may keep state over a partition,
    and yields dicts of equally long lists that fit `schema`.
    """
    target = df.sparkSession.createDataFrame([], schema).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(target)
        source = (tuple(b.column(i).to_pylist() for i in range(b.num_columns)) for b in slices(batches))
        for out in fn(source):
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.select(*columns).mapInArrow(run, schema)


def add_columns(df: DataFrame, inputs: Sequence[str], fn: Callable[..., dict], schema: str, at_end: Callable[[], None] | None = None) -> DataFrame:
    """`df` with the columns that `fn` makes, batch by batch, from lists of the `inputs`' values.

    A column of `df` that has the name of a new one is replaced. `at_end` is called after a partition.
    """
    new = df.sparkSession.createDataFrame([], schema).schema
    names = {f.name.lower() for f in new}
    kept = [c for c in df.columns if c.lower() not in names]
    source = df.select(*kept, *[F.col(c).alias(free_name(df, f"in{i}")) for i, c in enumerate(inputs)])
    target = type(new)([*df.select(*kept).schema.fields, *new.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(target)
        for b in slices(batches):
            out = fn(*(b.column(len(kept) + i).to_pylist() for i in range(len(inputs))))
            made = [pa.array(out[f.name], arrow.field(f.name).type) for f in new]
            arrays = [b.column(i) for i in range(len(kept))] + made
            yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, arrow)], schema=arrow)
        if at_end:
            at_end()

    return source.mapInArrow(run, target)
