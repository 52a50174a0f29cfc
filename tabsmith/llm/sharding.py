"""Sharding on a consistent-hash ring with virtual nodes and bounded loads, with DataFrame operations only.

A row's key has a position on the ring; the next virtual node clockwise names its shard. Keys
between two virtual nodes (an arc) share the order in which they try shards, so the loads follow from
one count per arc, at most shards x virtual nodes numbers: every arc fills its own shard
first, and what finds a full shard goes on clockwise to the next node with room. Rows then
get their place from their rank within the arc.

With `slack` 0 the bounds are exact: counts differ by one at most. A larger slack lets shards hold
(1 + slack) times their share and moves fewer keys when shards come or go.

Defined results: rows with a null key share a position; equal keys and repeated rows are
separate rows, each with a slot of its own; other columns stay, an input column called shard
or slot is replaced.
"""

from __future__ import annotations

import json
import math

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.llm.common import shielded

#: Cells of equal width that the ring is looked up by, and parts an arc's rows are ranked in.
RING_BITS, ARC_PARTS = 12, 32


def ring(shards: int, virtual_nodes: int) -> list[tuple[int, int]]:
    """(position, shard) of every virtual node, by position."""
    nodes = [(f"{s}/{v}", s) for s in range(shards) for v in range(virtual_nodes)]
    return sorted((np.uint64(xxhash.xxh64_intdigest(name.encode(), 42)).astype(np.int64).item(), s) for name, s in nodes)


def fill(counts: list[int], owners: list[int], capacity: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, end rank, shard, first slot): where the rows of each arc go."""
    room, left = list(capacity), list(counts)
    used = [0] * len(capacity)
    placed = []
    for step in range(len(owners)):
        waiting = [arc for arc, n in enumerate(left) if n]
        if not waiting:
            return placed
        for arc in waiting:
            shard = owners[(arc + step) % len(owners)]
            take = min(left[arc], room[shard])
            if take:
                begin = counts[arc] - left[arc]
                placed.append((arc, begin, begin + take, shard, used[shard]))
                left[arc] -= take
                room[shard] -= take
                used[shard] += take
    if any(left):
        raise ValueError("the shards hold fewer rows than there are")
    return placed


def _rows(spark, values: list[dict], schema: str) -> DataFrame:
    """A small table from literals."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(values)), f"array<struct<{schema}>>")))


@shielded
def assign(df: DataFrame, key: str, shards: int, virtual_nodes: int = 64, slack: float = 0.0, ties: list[str] | None = None) -> DataFrame:
    """`df` with shard and slot (gapless from 0 within a shard).

    `ties` names columns that, after the key, decide the order of rows within an arc and
    spread rows of one key over the tasks that rank them.
    """
    if shards < 1 or virtual_nodes < 1 or slack < 0:
        raise ValueError("shards and virtual_nodes must be positive, slack not negative")
    spark, ties = df.sparkSession, ties or []
    nodes = ring(shards, virtual_nodes)
    positions = [p for p, _ in nodes]
    width = 64 - RING_BITS
    cells = []
    for cell in range(-(1 << RING_BITS - 1), 1 << RING_BITS - 1):
        low = int(np.searchsorted(positions, cell << width))
        high = int(np.searchsorted(positions, (cell + 1) << width)) if cell + 1 < 1 << RING_BITS - 1 else len(positions)
        cells.append({"__cell": cell, "__base": low, "__cuts": positions[low:high]})
    lookup = F.broadcast(_rows(spark, cells, "__cell:bigint,__base:int,__cuts:array<bigint>"))  # 2**RING_BITS rows
    kept = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    keyed = df.withColumns({
        "__at": F.xxhash64(F.col(key).cast("string")), "__part": F.pmod(F.xxhash64(F.lit("part"), key, *ties), F.lit(ARC_PARTS))})
    arcs = keyed.join(lookup, F.shiftright("__at", width) == F.col("__cell")).withColumn(
        "__arc", F.pmod(F.col("__base") + F.size(F.filter("__cuts", lambda c: c < F.col("__at"))), F.lit(len(nodes))))
    # at most shards x virtual nodes x ARC_PARTS rows
    counts = arcs.groupBy("__arc", "__part").count().collect()
    by_arc = [0] * len(nodes)
    begins = []
    for row in sorted(counts, key=lambda r: (r["__arc"], r["__part"])):
        begins.append({"__a": row["__arc"], "__p": row["__part"], "__begin": by_arc[row["__arc"]]})
        by_arc[row["__arc"]] += row["count"]
    total = sum(by_arc)
    share, more = divmod(total, shards)
    capacity = [math.ceil((1 + slack) * total / shards) if slack else share + (s < more) for s in range(shards)]
    places = [dict(zip(("__of", "__lo", "__hi", "__shard", "__slot0"), p)) for p in fill(by_arc, [s for _, s in nodes], capacity)]
    begins_df = F.broadcast(_rows(spark, begins, "__a:int,__p:bigint,__begin:bigint"))
    places_df = F.broadcast(_rows(spark, places, "__of:int,__lo:bigint,__hi:bigint,__shard:int,__slot0:bigint"))
    nth = F.row_number().over(Window.partitionBy("__arc", "__part").orderBy("__at", key, *ties)) - 1
    ranked = arcs.withColumn("__nth", nth).join(begins_df, (F.col("__arc") == F.col("__a")) & (F.col("__part") == F.col("__p")))
    rank = F.col("__begin") + F.col("__nth")
    placed = ranked.join(places_df, (F.col("__arc") == F.col("__of")) & (rank >= F.col("__lo")) & (rank < F.col("__hi")))
    return placed.select(
        *kept, F.col("__shard").alias("shard"),
        (F.col("__slot0") + rank - F.col("__lo")).alias("slot"))

