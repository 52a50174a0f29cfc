"""Totals along an order: range partitions, their totals, and running sums inside each.

A window over the whole table would run in one task. Here rows are dealt by ranges of the order
and written once, so that every row keeps its partition; a partition's offset is the total of
those before it. The partitions decide only how even the work is; the totals are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabsmith.session import stage

_WIDE = "decimal(38,0)"


def running_totals(df: DataFrame, order: Sequence[str], sums: Sequence[str], descending: bool = False) -> DataFrame:
    """Add `<sum>_before` for each of `sums`: its total over the rows that come earlier.

    The columns of `order` must be unique together and not null, and each of `sums` a whole number.
    """
    by = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    dealt = stage(df.repartitionByRange(*by).withColumn("_part", F.spark_partition_id()), "ranges")
    totals = dealt.groupBy("_part").agg(*[F.sum(F.col(s).cast(_WIDE)).alias(s) for s in sums])
    # one row per partition
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_part", *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).cast(_WIDE).alias(f"{s}_offset") for s in sums])
    inside = Window.partitionBy("_part").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    running = dealt.withColumns({f"{s}_inside": F.sum(F.col(s).cast(_WIDE)).over(inside) for s in sums})
    before = [
        (F.coalesce(F.col(f"{s}_inside"), F.lit(0)) + F.col(f"{s}_offset")).cast(_WIDE).alias(f"{s}_before") for s in sums]
    return running.join(F.broadcast(offsets), "_part").select(*df.columns, *before)


def dense_codes(values: DataFrame) -> DataFrame:
    """(name, value, code) of distinct (name, value): codes 0..n-1 within each name, in sorted order."""
    ranges = values.select("name", "value").repartitionByRange("name", "value")
    dealt = stage(ranges.withColumn("_part", F.spark_partition_id()), "ranges")
    earlier = Window.partitionBy("name").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # a name has one row per range that it is in: as many rows as names and ranges together
    offsets = dealt.groupBy("name", "_part").agg(F.count(F.lit(1)).alias("n")).select(
        "name", "_part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    nth = F.row_number().over(Window.partitionBy("name", "_part").orderBy("value")) - 1
    return dealt.withColumn("nth", nth).join(F.broadcast(offsets), ["name", "_part"]).select(
        "name", "value", (F.col("before") + F.col("nth")).cast("long").alias("code"))
