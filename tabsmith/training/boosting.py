"""Gradient boosting over pre-binned columns, many rounds in one stage or one small job per tree level.

Features are binned once: every task sums up its values per feature in a bounded sketch, the sketches are merged per feature, and
rows are written as blocks of one byte per feature and row to the shared folder. Then each task adds up gradients, weights and rows
per (node, feature, bin) with numpy, level by level, and the best splits are picked from the sums over all tasks. Only the smaller
child of a node is summed up; its sibling is what is left of the parent.

Where the blocks fit into the tasks that run at once (HELD_BYTES a task), a barrier stage grows many rounds: its tasks keep their
blocks, put their sums into files of the shared folder, and each of them adds up and searches its own range of features and puts
the best splits it found there too. Else a level of all trees of a round is a job of its own: the sums of a
few tasks are added in the driver and those of many in a tree of tasks. The driver holds sums per node, feature and bin, no rows.
Both ways give the same trees.

Margins are kept with the blocks and take in the trees of the last rounds in the job that begins the next ones; the loss of the
validation rows is added up with every round, so a run goes on from where it is until `early_stopping` rounds brought
nothing better. The chain of updates is cut by checkpoints in the shared folder, and a lost executor costs a few of them.

Sums are of whole numbers (gradients are rounded to a fixed fraction of the largest), so a model does not depend on how blocks are
dealt to tasks or in which order these finish. Draws go by the rows' numbers in the blocks: with all rows drawn, the order of
the rows makes no difference either, as long as the bins are the same.

Missing values have a bin of their own, and every split sends them to the side that gains more.
"""

from __future__ import annotations

import json
import math
import threading
import time
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSystem, FileType
from pyspark import RDD, BarrierTaskContext, StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.session import stage, work_path
from tabsmith.training import objectives

#: Rows of a block, rows of a staged one, which are dealt out to tasks, and rows that are worth a task of their own.
BLOCK_ROWS, STAGED_ROWS, TASK_ROWS = 65_536, 8_192, 32_768
#: A task of a barrier stage keeps so many bytes of blocks at most.
HELD_BYTES = 256 << 20
#: Nodes whose splits are searched at once.
SEARCHED_NODES = 64
#: Points of a sketch; a rank is missed by at most one in so many rows and merge.
SKETCH_POINTS = 2_048
#: Up to so many tasks the driver adds up their sums itself.
FLAT_TASKS = 24
#: Seconds that a task of a barrier stage waits for another.
WAIT_SECONDS = 900
#: Rounds of a barrier stage, after which margins are written to the shared folder, and such rounds where a level is a job.
HELD_ROUNDS = 100
CHECKPOINT_ROUNDS = 25
#: The largest gradient has so many binary digits.
DIGITS = 20


@dataclass
class Tree:
    """Nodes in order of their making; a leaf is its own child. `bin` and lower ones, or smaller values, go left."""

    feature: np.ndarray
    bin: np.ndarray
    threshold: np.ndarray
    missing_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    rows: np.ndarray
    weight: np.ndarray

    def leaves_of(self, bins: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
        """The node where each column of `bins` (features x rows) ends."""
        at = np.zeros(bins.shape[1], np.int64) if start is None else start
        columns = np.arange(bins.shape[1])
        while True:
            inner = np.flatnonzero(self.left[at] != at)
            if not len(inner):
                return at
            here = at[inner]
            value = bins[self.feature[here], columns[inner]]
            goes_left = np.where(value == 0, self.missing_left[here], value <= self.bin[here])
            at[inner] = np.where(goes_left, self.left[here], self.right[here])


@dataclass
class Boosted:
    """A boosted model: `rounds[r][k]` is the tree of round r for margin k."""

    features: list[str]
    edges: list[np.ndarray]
    start: list[float]
    rounds: list[list[Tree]]
    objective: str
    options: dict
    trained_rounds: int = 0  # with the rounds that were looked at and not kept
    train_losses: list[float] | None = None
    val_losses: list[float] | None = None

    @property
    def getNumTrees(self) -> int:  # noqa: N802 - the name that Spark's own models have
        return len(self.rounds)

    def first(self, n: int) -> Boosted:
        return Boosted(self.features, self.edges, self.start, self.rounds[:n], self.objective, self.options, self.trained_rounds,
                       self.train_losses, self.val_losses)


# ---------------------------------------------------------------- bins


def _sketch(values: np.ndarray, weights: np.ndarray, points: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values with their weights; of more than `points` those at even shares, each with the weight up to it."""
    order = np.argsort(values, kind="stable")
    values, weights = values[order], weights[order]
    last = np.flatnonzero(np.append(values[1:] != values[:-1], True)) if len(values) else np.zeros(0, np.int64)
    upto = np.cumsum(weights)[last]
    values = values[last]
    if len(values) > points:
        wanted = upto[-1] * np.arange(1, points + 1) / points
        pick = np.unique(np.searchsorted(upto, wanted - 1e-9 * upto[-1], "left").clip(max=len(values) - 1))
        values, upto = values[pick], upto[pick]
    return values, np.diff(upto, prepend=0.0)


def _matrix(batch: pa.RecordBatch, at: int) -> np.ndarray:
    """Features x rows from column `at` on; missing values are NaN."""
    return np.array([batch.column(i).to_numpy(zero_copy_only=False) for i in range(at, batch.num_columns)], np.float64)


def bin_edges(df: DataFrame, features: Sequence[str], max_bins: int = 256) -> list[np.ndarray]:
    """For each feature the upper ends of its bins: all its values if they are few, else values at even shares.

    One bin is kept for missing values. Sketches are merged in the order of the partitions.
    """
    schema = "feature int, part int, points array<double>, weights array<double>"

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        held: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0), np.zeros(0))] * len(features)
        for batch in batches:
            for f, values in enumerate(_matrix(batch, 0)):
                values = values[~np.isnan(values)]
                both = np.concatenate([held[f][0], values]), np.concatenate([held[f][1], np.ones(len(values))])
                held[f] = _sketch(*both, SKETCH_POINTS)
        yield pa.RecordBatch.from_arrays([
            pa.array(range(len(features)), pa.int32()), pa.array([part] * len(features), pa.int32()),
            pa.array([h[0] for h in held], pa.list_(pa.float64())), pa.array([h[1] for h in held], pa.list_(pa.float64()))],
            names=["feature", "part", "points", "weights"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.column("parts"):
                # a row has the sketches of one feature, by partition; a few hundred at a time
                held = np.zeros(0), np.zeros(0)
                parts = row.values
                points, weights = parts.field("points"), parts.field("weights")
                for at in range(0, len(row), 256):
                    block = range(at, min(at + 256, len(row)))
                    held = _sketch(
                        np.concatenate([held[0], *[points[i].values.to_numpy() for i in block]]),
                        np.concatenate([held[1], *[weights[i].values.to_numpy() for i in block]]), 4 * SKETCH_POINTS)
                out.append(_shares(*held, max_bins - 1))
            yield pa.RecordBatch.from_arrays([batch.column("feature"), pa.array(out, pa.list_(pa.float64()))], names=["feature", "edges"])

    numbers = df.select(*[F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(features)])
    sketches = numbers.mapInArrow(sketch, schema)
    parts = sketches.groupBy("feature").agg(F.sort_array(F.collect_list(F.struct("part", "points", "weights"))).alias("parts"))
    rows = parts.mapInArrow(merge, "feature int, edges array<double>").collect()  # one row per feature, at most 254 edges
    found = {r["feature"]: np.array(r["edges"]) for r in rows}
    return [found.get(f, np.zeros(0)) for f in range(len(features))]


def _shares(values: np.ndarray, weights: np.ndarray, bins: int) -> np.ndarray:
    """The upper ends of at most `bins` bins; the last bin needs none."""
    if len(values) > bins:
        values, _ = _sketch(values, weights, bins)
    return values[:-1]


def binned(matrix: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """Features x rows of bytes: 0 for missing, 1 for values up to the first edge, and so on."""
    out = np.empty(matrix.shape, np.uint8)
    for f, values in enumerate(matrix):
        out[f] = np.searchsorted(edges[f], values, "left") + 1
        out[f][np.isnan(values)] = 0
    return out


def bin_blocks(df: DataFrame, label: str, features: Sequence[str], edges: Sequence[np.ndarray], is_val: bool) -> DataFrame:
    """Blocks (is_val, first, y, bins) of up to STAGED_ROWS rows; `first` numbers the rows."""

    def block(first: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        y = np.concatenate([p.column(0).to_numpy(zero_copy_only=False) for p in parts])
        bins = np.concatenate([binned(_matrix(p, 1), edges) for p in parts], axis=1)
        return pa.RecordBatch.from_arrays(
            [pa.array([is_val]), pa.array([first]), pa.array([y.astype("<f8").tobytes()]), pa.array([bins.tobytes()])],
            names=["is_val", "first", "y", "bins"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 49
        parts, rows = [], 0
        for batch in batches:
            while batch.num_rows:
                part, batch = batch.slice(0, STAGED_ROWS - rows), batch.slice(STAGED_ROWS - rows)
                parts.append(part)
                rows += part.num_rows
                if rows == STAGED_ROWS:
                    yield block(first, parts)
                    first, parts, rows = first + rows, [], 0
        if rows:
            yield block(first, parts)

    numbers = df.select(F.col(label).cast("double").alias("y"), *[F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(features)])
    return numbers.filter("y is not null").mapInArrow(run, "is_val boolean, first long, y binary, bins binary")


# ---------------------------------------------------------------- tasks


def _draw(first: int, rows: int, number: int, seed: int, share: float) -> np.ndarray:
    """Which rows a round takes: by a hash of row, round and seed."""
    x = np.arange(first, first + rows, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= np.uint64((seed * 0x2545F4914F6CDD1D + number * 0xD1342543DE82EF95) % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x < np.uint64(min(int(share * 2**64), 2**64 - 1))


def _drawn(firsts: Sequence[tuple[int, int]], number: int, plan: _Plan) -> np.ndarray | None:
    """The rows of a block that a round takes; None: all of them."""
    if plan.share >= 1:
        return None
    return np.flatnonzero(np.concatenate([_draw(first, rows, number, plan.seed, plan.share) for first, rows in firsts]))


def _used(settings, features: int, classes: int, number: int) -> list[np.ndarray]:
    """The features that the trees of a round may split by."""
    out = []
    for k in range(classes):
        draw = np.random.default_rng([settings.seed, number, k])
        mask = np.zeros(features, bool)
        mask[draw.permutation(features)[:max(1, math.ceil(settings.colsample * features))]] = True
        out.append(mask)
    return out


@dataclass
class _Plan:
    """What the tasks of one round need to know."""

    name: str
    facts: objectives.Facts
    options: dict
    classes: int
    positive: float  # the weight of rows with label 1 (binary objectives)
    units: tuple[float, float]
    share: float
    seed: int
    offsets: np.ndarray  # of each feature's bins among all bins

    def gradients(self, y: np.ndarray, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(margins, rows) each, as whole numbers of a unit."""
        if self.classes > 1:
            p = objectives.softmax(margins.T).T
            g = p - (np.arange(self.classes)[:, None] == y)
            h = np.maximum(2 * p * (1 - p), objectives.LEAST_WEIGHT)
        else:
            g, h = objectives.objective(self.name, self.facts, **self.options).gradient(y, margins[0])
            g, h = g[None], h[None]
        if self.positive != 1.0:
            w = np.where(y == 1, self.positive, 1.0)
            g, h = g * w, h * w
        return np.rint(g / self.units[0]), np.rint(h / self.units[1])

    def losses(self, y: np.ndarray, margins: np.ndarray) -> float:
        if self.classes > 1:
            p = objectives.softmax(margins.T)
            return float(-np.log(np.clip(p[np.arange(len(y)), y.astype(np.int64)], 1e-15, None)).sum())
        return float(objectives.objective(self.name, self.facts, **self.options).loss(y, margins[0]).sum())


def _sum_up(
    sums: np.ndarray, bins: np.ndarray, drawn: np.ndarray | None, g: np.ndarray, h: np.ndarray, slot: np.ndarray, used: np.ndarray,
    offsets: np.ndarray,
) -> None:
    """Adds gradients, weights and rows to `sums`, (3, slots, bins); `slot` and `drawn` are of the drawn rows, `g` and `h` of all."""
    rows = np.flatnonzero(slot >= 0)
    if not len(rows):
        return
    slot = slot[rows]
    rows = rows if drawn is None else drawn[rows]
    low, high = int(slot.min()), int(slot.max()) + 1
    slot, g, h = slot - low, g[rows], h[rows]
    # whole numbers below 2^53 are exact: where there is room, weights and rows share one
    unit = float(1 << len(rows).bit_length())
    shared = float(h.sum()) * unit < 2**52
    both = h * unit + 1 if shared else None
    for f in np.flatnonzero(used):
        a, b = int(offsets[f]), int(offsets[f + 1])
        at = slot * (b - a) + bins[f][rows]
        cells = (high - low) * (b - a)
        found = [np.bincount(at, g, cells)]
        if shared:
            pair = np.bincount(at, both, cells)
            weights = np.floor(pair / unit)
            found += [weights, pair - weights * unit]
        else:
            found += [np.bincount(at, h, cells), np.bincount(at, None, cells)]
        for i, one in enumerate(found):
            sums[i, low:high, a:b] += one.reshape(high - low, b - a)


def _histograms(block: tuple, plan: _Plan, number: int, trees: list[Tree], slots: list[np.ndarray], used: list[np.ndarray]) -> np.ndarray:
    """(3, slots, bins): gradient, weight and row sums of the nodes that have a slot, for the features that a tree uses."""
    _, firsts, y, bins, margins = block
    sums = np.zeros((3, sum(int((s >= 0).sum()) for s in slots), int(plan.offsets[-1])))
    drawn = _drawn(firsts, number, plan)
    g, h = plan.gradients(y, margins)
    for k, tree in enumerate(trees):
        node = tree.leaves_of(bins)
        _sum_up(sums, bins, drawn, g[k], h[k], slots[k][node if drawn is None else node[drawn]], used[k], plan.offsets)
    return sums


def _add(tasks: RDD) -> np.ndarray:
    """The sum of all tasks' arrays."""
    if tasks.getNumPartitions() <= FLAT_TASKS:
        parts = tasks.collect()
        return sum(parts[1:], parts[0])
    return tasks.treeReduce(lambda a, b: a + b, depth=max(2, math.ceil(math.log(tasks.getNumPartitions(), FLAT_TASKS))))


# ---------------------------------------------------------------- splits


def best_splits(sums: np.ndarray, totals: np.ndarray, starts: np.ndarray, settings) -> list[tuple[float, int, bool, list[float]]]:
    """(gain, cell, missing values to the left, sums of the left) of the best split of each node; the first of equal ones.

    `sums` are (nodes, 3, cells), `totals` (nodes, 3), `starts` the first cell of each cell's feature. The gain is half that of the
    second-order loss. Missing values go left where that is as good.
    """
    reg, rows, weight = settings.reg_lambda, settings.min_child, settings.min_child_weight
    out = []
    for at in range(0, len(sums), SEARCHED_NODES):
        own, whole = sums[at:at + SEARCHED_NODES], totals[at:at + SEARCHED_NODES, :, None]
        nodes = np.arange(len(own))
        lead = np.cumsum(own, axis=2)
        missing = own[:, :, starts]
        upto = lead - (lead[:, :, starts] - missing)
        none = whole[:, 0, 0] ** 2 / (whole[:, 1, 0] + reg)
        found = []
        for left in (upto, upto - missing):
            g, h, n = left[:, 0], left[:, 1], left[:, 2]
            ok = (n >= rows) & (whole[:, 2] - n >= rows) & (h >= weight) & (whole[:, 1] - h >= weight)
            with np.errstate(all="ignore"):
                gain = np.where(ok, g**2 / (h + reg) + (whole[:, 0] - g) ** 2 / (whole[:, 1] - h + reg), -np.inf)
            cell = gain.argmax(axis=1)
            found.append(((gain[nodes, cell] - none) / 2, cell, left[nodes, :, cell]))
        for i in nodes:
            side = int(found[1][0][i] > found[0][0][i])
            gain, cell, left = (x[i] for x in found[side])
            out.append((float(gain), int(cell), not side, left.tolist()))
    return out


class _Growing:
    """One tree while it grows."""

    def __init__(self):
        self.columns = {c: [] for c in ("feature", "bin", "threshold", "missing_left", "left", "right", "value", "gain", "rows", "weight")}
        self.totals: dict[int, np.ndarray] = {}

    def add(self, totals: np.ndarray, reg: float, rate: float) -> int:
        node, (g, h, rows) = len(self.columns["left"]), totals.tolist()
        self.totals[node] = totals
        made = dict(feature=0, bin=0, threshold=np.nan, missing_left=True, left=node, right=node, value=-rate * g / (h + reg),
                    gain=0.0, rows=int(rows), weight=h)
        for name, value in made.items():
            self.columns[name].append(value)
        return node

    def tree(self) -> Tree:
        kinds = dict(feature=np.int64, bin=np.int64, missing_left=bool, left=np.int64, right=np.int64, rows=np.int64)
        return Tree(**{n: np.array(v, kinds.get(n, np.float64)) for n, v in self.columns.items()})


class _Sums:
    """The sums (3, cells) of a level's nodes by (tree, node), for a range of all bins, and the search in them."""

    def __init__(self, plan: _Plan, settings, used: list[np.ndarray], first: int, end: int):
        self.plan, self.settings, self.used = plan, settings, used
        self.units = np.array([*plan.units, 1.0])[:, None, None]
        self.held: dict[tuple[int, int], np.ndarray] = {}
        self.cells, self.starts = [], []
        for mask in used:
            ends = [(int(plan.offsets[f]) - first, int(plan.offsets[f + 1]) - first) for f in np.flatnonzero(mask)]
            ends = [(a, b) for a, b in ends if 0 <= a < end - first]
            sizes = [b - a for a, b in ends]
            self.cells.append(np.concatenate([np.arange(a, b) for a, b in ends]) if ends else np.zeros(0, np.int64))
            self.starts.append(np.repeat(np.cumsum([0, *sizes])[:-1], np.array(sizes, np.int64)))
        self.first = first

    def root(self, found: np.ndarray) -> None:
        """`found` (3, trees, cells) is of all rows that the round takes."""
        own = found * self.units
        self.held = {(k, 0): own[:, k] for k in range(len(self.used))}

    def children(self, found: np.ndarray, pairs: list[tuple[int, int, int, int]]) -> None:
        """`found` (3, pairs, cells) is of the smaller child of each (tree, parent, smaller, larger)."""
        own = found * self.units
        held = {}
        for slot, (k, parent, less, more) in enumerate(pairs):
            held[k, less] = own[:, slot]
            held[k, more] = self.held[k, parent] - own[:, slot]
        self.held = held

    def best(self, nodes: list[tuple[int, int]], totals: list[np.ndarray]) -> list[tuple[float, int, bool, list[float]]]:
        """The best split of each node; its cell is counted among all bins."""
        out = {}
        for k, cells in enumerate(self.cells):
            own = [i for i, (tree, _) in enumerate(nodes) if tree == k]
            if own and len(cells):
                sums = np.array([self.held[nodes[i]][:, cells] for i in own])
                for i, (gain, cell, side, left) in zip(own, best_splits(sums, np.array([totals[i] for i in own]), self.starts[k], self.settings)):
                    out[i] = gain, int(cells[cell]) + self.first, side, left
        return [out.get(i, (-math.inf, 0, True, [0.0, 0.0, 0.0])) for i in range(len(nodes))]


class _JobSums(_Sums):
    """Sums of all bins in the driver; a level is a job over the blocks."""

    def __init__(self, blocks: RDD, context, plan: _Plan, number: int, settings, used: list[np.ndarray], root: np.ndarray):
        super().__init__(plan, settings, used, 0, int(plan.offsets[-1]))
        self.blocks, self.context, self.number = blocks, context, number
        self.root(root)

    def totals(self) -> list[np.ndarray]:
        out = []
        for k, mask in enumerate(self.used):
            f = int(np.flatnonzero(mask)[0])
            out.append(self.held[k, 0][:, self.plan.offsets[f]:self.plan.offsets[f + 1]].sum(axis=1))
        return out

    def descend(self, trees: list[Tree], slots: list[np.ndarray], pairs: list[tuple[int, int, int, int]]) -> None:
        shipped = self.context.broadcast((self.plan, self.number, trees, slots, self.used))  # bounded by the nodes of a round

        def sums_of(part):
            total = None
            for block in part:
                if not block[0]:
                    own = _histograms(block, *shipped.value)
                    total = own if total is None else total + own
            if total is None:
                p, _, _, slots, _ = shipped.value
                total = np.zeros((3, sum(int((s >= 0).sum()) for s in slots), int(p.offsets[-1])))
            yield total

        self.children(_add(self.blocks.mapPartitions(sums_of)), pairs)
        shipped.unpersist()


def grow(sums: _JobSums | _TaskSums, settings, edges: Sequence[np.ndarray]) -> list[Tree]:
    """The trees of one round, level by level; `sums` begin with those of the roots."""
    reg, rate, offsets = settings.reg_lambda, settings.learning_rate, sums.plan.offsets
    growing = [_Growing() for _ in sums.used]
    for one, totals in zip(growing, sums.totals()):
        one.add(totals, reg, rate)
    feature_of = np.repeat(np.arange(len(edges)), np.diff(offsets))
    level = [(k, 0) for k in range(len(growing))]
    for depth in range(settings.max_depth):
        nodes = [(k, n) for k, n in level if growing[k].totals[n][2] >= 2 * settings.min_child]
        slots: list[dict[int, int]] = [{} for _ in growing]
        pairs, level = [], []
        for (k, n), (gain, cell, missing_left, left) in zip(nodes, sums.best(nodes, [growing[k].totals[n] for k, n in nodes])):
            if not gain > max(settings.min_split_gain, 1e-12):
                continue
            one, whole, left = growing[k], growing[k].totals[n], np.array(left)
            f = int(feature_of[cell])
            local = int(cell) - int(offsets[f])
            ids = [one.add(part, reg, rate) for part in (left, whole - left)]
            c = one.columns
            c["feature"][n], c["bin"][n], c["missing_left"][n], c["gain"][n] = f, local, bool(missing_left), float(gain)
            c["threshold"][n] = -np.inf if local == 0 else edges[f][local - 1] if local <= len(edges[f]) else np.inf
            c["left"][n], c["right"][n] = ids
            c["value"][n] = 0.0
            less = ids[0] if left[2] <= whole[2] - left[2] else ids[1]
            slots[k][less] = len(pairs)
            pairs.append((k, n, less, ids[0] + ids[1] - less))
            level += [(k, i) for i in ids]
        if not pairs or depth + 1 == settings.max_depth:
            break
        trees = [one.tree() for one in growing]
        arrays = []
        for tree, slot in zip(trees, slots):
            array = np.full(len(tree.left), -1, np.int64)
            array[list(slot)] = list(slot.values())
            arrays.append(array)
        sums.descend(trees, arrays, pairs)
    return [one.tree() for one in growing]


# ---------------------------------------------------------------- many rounds in one stage


class _Exchange:
    """What the tasks of a barrier stage tell each other, step by step: a file of the shared folder each, with a message and sums.

    Spark's own `allGather` looks for the others once a second, so it is used once, to agree on names that no other try of the stage has.
    """

    def __init__(self, folder: str, ranges: list[tuple[int, int]]):
        context = BarrierTaskContext.get()
        self.task, self.ranges, self.step = context.partitionId(), ranges, 0
        self.files, self.folder = FileSystem.from_uri(folder)
        self.name = context.allGather(uuid.uuid4().hex)[0]

    def _path(self, step: int, task: int) -> str:
        return f"{self.folder}/{self.name}-{step}-{task}"

    def _opened(self, task: int):
        """The file of another task, when it is there: written under another name, it is whole."""
        path, began, pause = self._path(self.step, task), time.monotonic(), 0.0005
        while self.files.get_file_info(path).type != FileType.File:
            if time.monotonic() - began > WAIT_SECONDS:
                raise TimeoutError(f"task {task} told nothing for {WAIT_SECONDS} s")
            time.sleep(pause)
            pause = min(1.5 * pause, 0.02)
        return self.files.open_input_file(path)

    def tell(self, message, sums: np.ndarray | None = None) -> tuple[list, np.ndarray | None]:
        """The messages of all tasks, in their order; of their `sums` (3, slots, bins) the total for the range of bins that this task has."""
        kind = np.dtype(np.int32 if sums is None or abs(sums).max(initial=0) < 2**31 else np.int64)  # they are whole numbers
        head = json.dumps((kind.itemsize, message)).encode()
        path = self._path(self.step, self.task)
        with self.files.open_output_stream(f"{path}-part") as out:
            out.write(len(head).to_bytes(8, "little") + head)
            for a, b in self.ranges if sums is not None else ():
                out.write(sums[:, :, a:b].astype(kind).tobytes())
        self.files.move(f"{path}-part", path)
        a, b = self.ranges[self.task]
        total = None if sums is None else np.zeros((3, sums.shape[1], b - a))
        told = []
        for task in range(len(self.ranges)):
            with self._opened(task) as file:
                length = int.from_bytes(file.read(8), "little")
                size, found = json.loads(file.read(length))
                told.append(found)
                if total is not None and total.size:
                    part = file.read_at(total.size * size, 8 + length + 3 * total.shape[1] * a * size)
                    total += np.frombuffer(part, f"i{size}").reshape(total.shape)
        if self.step:  # all have told something since they read the step before
            self.files.delete_file(self._path(self.step - 1, self.task))
        self.step += 1
        return told, total


class _Held:
    """A block in a task that grows trees: its rows' margins, and in a round their gradients and nodes."""

    def __init__(self, block: tuple):
        self.is_val, self.firsts, self.y, self.bins, self.margins = block

    def begin(self, plan: _Plan, number: int) -> None:
        self.drawn = _drawn(self.firsts, number, plan)
        self.g, self.h = plan.gradients(self.y, self.margins)
        self.nodes = np.zeros(self.margins.shape, np.int64)

    def totals(self) -> np.ndarray:
        """(trees, 3) sums of the drawn rows."""
        own = [x if self.drawn is None else x[:, self.drawn] for x in (self.g, self.h)]
        return np.array([*(x.sum(axis=1) for x in own), np.full(len(self.g), own[0].shape[1])]).T

    def step(self, trees: list[Tree]) -> None:
        for k, tree in enumerate(trees):
            tree.leaves_of(self.bins, self.nodes[k])

    def add_to(self, sums: np.ndarray, plan: _Plan, slots: list[np.ndarray], used: list[np.ndarray]) -> None:
        for k, node in enumerate(self.nodes):
            slot = slots[k][node if self.drawn is None else node[self.drawn]]
            _sum_up(sums, self.bins, self.drawn, self.g[k], self.h[k], slot, used[k], plan.offsets)

    def end(self, trees: list[Tree]) -> None:
        if self.is_val:
            self.nodes = np.zeros(self.margins.shape, np.int64)
        self.step(trees)
        self.margins = self.margins + np.array([t.value[node] for t, node in zip(trees, self.nodes)])


class _TaskSums(_Sums):
    """Sums of this task's range of bins; the rows are in its and the other tasks' blocks."""

    def __init__(self, exchange: _Exchange, blocks: list[_Held], plan: _Plan, settings, used: list[np.ndarray]):
        super().__init__(plan, settings, used, *exchange.ranges[exchange.task])
        self.exchange, self.blocks = exchange, blocks

    def _found(self, slots: list[np.ndarray], wanted: int, message=None) -> tuple[list, np.ndarray]:
        sums = np.zeros((3, wanted, int(self.plan.offsets[-1])))
        for block in self.blocks:
            block.add_to(sums, self.plan, slots, self.used)
        return self.exchange.tell(message, sums)

    def begin(self, message) -> list:
        """The roots' sums; gives the messages."""
        own = sum((b.totals() for b in self.blocks), np.zeros((len(self.used), 3)))
        told, found = self._found([np.array([k]) for k in range(len(self.used))], len(self.used), (own.tolist(), message))
        self.root(found)
        self.roots = np.sum([t[0] for t in told], axis=0) * self.units[:, 0, 0]
        return [t[1] for t in told]

    def totals(self) -> list[np.ndarray]:
        return list(self.roots)

    def best(self, nodes: list[tuple[int, int]], totals: list[np.ndarray]) -> list[tuple[float, int, bool, list[float]]]:
        # the highest gain; of equal ones that with missing values to the left, and then the first
        return [max(found, key=lambda s: (s[0], s[2], -s[1])) for found in zip(*self.exchange.tell(super().best(nodes, totals))[0])]

    def descend(self, trees: list[Tree], slots: list[np.ndarray], pairs: list[tuple[int, int, int, int]]) -> None:
        for block in self.blocks:
            block.step(trees)
        self.children(self._found(slots, len(pairs))[1], pairs)


@dataclass
class _Course:
    """Losses by round, and when to stop."""

    settings: object
    rows: int
    n_val: int
    root: bool  # the metric is the root of twice the mean loss
    train: list[float]
    val: list[float]
    best: int = 0

    def ends(self, number: int, train_loss: float, val_loss: float) -> bool:
        """Takes in the sums of losses before round `number`; whether that round is not to be grown."""
        if number:
            for losses, total, size in ((self.train, train_loss, self.rows), (self.val, val_loss, self.n_val)):
                if size:
                    losses.append(math.sqrt(2 * total / size) if self.root else total / size)
        if self.val and self.val[-1] < self.val[self.best]:
            self.best = len(self.val) - 1
        patience = self.settings.early_stopping if self.n_val else 0
        return number == self.settings.num_rounds or bool(patience and self.val and len(self.val) - 1 - self.best >= patience)


def _ranges(offsets: np.ndarray, tasks: int) -> list[tuple[int, int]]:
    """A range of whole features for each task, of about as many bins."""
    ends = offsets[np.searchsorted(offsets, offsets[-1] * np.arange(1, tasks + 1) / tasks)]
    return list(zip([0, *ends[:-1].tolist()], ends.tolist()))


def _rounds(part: Iterator[tuple], plan: _Plan, course: _Course, edges, numbers: range, folder: str, ranges) -> Iterator[tuple]:
    """(trees by round, course, whether it ended) of the rounds `numbers`; the first task tells."""
    settings = course.settings
    exchange = _Exchange(folder, ranges)
    blocks = [_Held(b) for b in part]
    own = [b for b in blocks if not b.is_val]
    done, ended = [], False
    for number in numbers:
        losses = [sum(plan.losses(b.y, b.margins) for b in blocks if b.is_val == side) for side in (False, True)]
        for block in own:
            block.begin(plan, number)
        sums = _TaskSums(exchange, own, plan, settings, _used(settings, len(edges), plan.classes, number))
        told = sums.begin(losses)
        ended = course.ends(number, *(sum(x) for x in zip(*told)))
        if ended:
            break
        trees = grow(sums, settings, edges)
        for block in blocks:
            block.end(trees)
        done.append(trees)
    if not exchange.task:
        yield done, course, ended


def _tasks_at_once(context) -> int:
    """How many tasks a barrier stage may have; none if executors come and go."""
    if context.getConf().get("spark.dynamicAllocation.enabled", "false").lower() == "true":
        return 0
    scala = context._jsc.sc()
    return scala.maxNumConcurrentTasks(scala.resourceProfileManager().defaultResourceProfile())


def _exchange_folder(spark) -> str | None:
    """A new folder that tasks can open by themselves, below the shared one; None if the shared folder's store is not one of Arrow's."""
    path = spark._jvm.org.apache.hadoop.fs.Path(work_path(spark, "sums"))
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    path = files.makeQualified(path)
    try:
        FileSystem.from_uri(path.toString())
    except (pa.ArrowException, OSError):
        return None
    files.mkdirs(path)
    return path.toString()


# ---------------------------------------------------------------- the run


def _with_rounds(block: tuple, rounds: list[list[Tree]]) -> tuple:
    is_val, firsts, y, bins, margins = block
    for trees in rounds:
        margins = margins + np.array([t.value[t.leaves_of(bins)] for t in trees])
    return is_val, firsts, y, bins, margins


#: Binned tables by (train, val, label, features, bins), with the frames that they came from, and a lock each.
_BINNED: dict[tuple, tuple] = {}
_BINNED_LOCK = threading.Lock()


def _binned(train: DataFrame, val: DataFrame | None, label: str, features: Sequence[str], max_bins: int) -> tuple:
    """(edges, offsets, table of blocks, facts per task) of the rows, binned and staged once for all fits on the same frames.

    Trials and compared models train on the same frames with the same bins: they share one binned table instead of each
    sketching, binning and writing the rows again. Fits side by side wait for the first.
    """
    key = (id(train), id(val), label, tuple(features), max_bins)
    with _BINNED_LOCK:
        entry = _BINNED.get(key)
        if entry is None or entry[0] is not train or entry[1] is not val:
            entry = _BINNED[key] = (train, val, threading.Lock(), [])
    with entry[2]:
        if not entry[3]:
            entry[3].append(_bin(train, val, label, features, max_bins))
    return entry[3][0]


def _blocks(features: int, start: list[float]):
    """Staged rows to blocks (is_val, (first, rows) of its parts, y, bins, margins) of about BLOCK_ROWS rows."""

    def merged(is_val: bool, rows: list) -> tuple:
        y = np.concatenate([np.frombuffer(r["y"], "<f8") for r in rows])
        bins = np.concatenate([np.frombuffer(r["bins"], np.uint8).reshape(features, -1) for r in rows], axis=1)
        firsts = [(r["first"], len(r["y"]) // 8) for r in rows]
        return is_val, firsts, y, bins, np.repeat(np.array(start)[:, None], len(y), axis=1)

    def run(part: Iterator) -> Iterator[tuple]:
        held: dict[bool, list] = {False: [], True: []}
        for row in part:
            own = held[row["is_val"]]
            own.append(row)
            if sum(len(r["y"]) for r in own) >= 8 * BLOCK_ROWS:
                yield merged(row["is_val"], own)
                held[row["is_val"]] = []
        for is_val, own in held.items():
            if own:
                yield merged(is_val, own)

    return run


def _bin(train: DataFrame, val: DataFrame | None, label: str, features: Sequence[str], max_bins: int) -> tuple:
    edges = bin_edges(train, features, max_bins)
    offsets = np.concatenate([[0], np.cumsum([len(e) + 2 for e in edges])])
    binned_rows = bin_blocks(train, label, features, edges, False)
    if val is not None:
        binned_rows = binned_rows.unionByName(bin_blocks(val, label, features, edges, True))
    table = stage(binned_rows, "binned")

    def facts_of(part):
        held = {}
        for row in part:
            y = np.frombuffer(row["y"], "<f8")
            own = len(y), y.sum(), (y**2).sum(), y.min(), y.max(), (y == 1).sum()
            kept = held.get(row["is_val"])
            held[row["is_val"]] = own if kept is None else tuple(f(a, b) for f, a, b in zip((sum2, sum2, sum2, min, max, sum2), kept, own))
        yield [(is_val, *own) for is_val, own in held.items()]

    def sum2(a, b):
        return a + b

    facts = [f for part in table.rdd.mapPartitions(facts_of).collect() for f in part]  # two rows per task
    return edges, offsets, table, facts


def fit(train: DataFrame, val: DataFrame | None, label: str, features: Sequence[str], settings, positive_weight: float = 1.0) -> Boosted:
    """Boost until `settings.num_rounds`, or until the validation loss was no better for `settings.early_stopping` rounds."""
    spark = train.sparkSession
    context = spark.sparkContext
    multi = settings.task == "multiclass"
    positive_weight = positive_weight if positive_weight > 0 else 1.0  # there are no negatives to even out
    edges, offsets, table, facts = _binned(train, val, label, features, settings.max_bins)
    count = len(features)
    own = [f for f in facts if not f[0]]
    rows = sum(f[1] for f in own)
    if not rows:
        raise ValueError("there is no row to train on")
    extra = (positive_weight - 1.0) * sum(f[6] for f in own)
    mean = (sum(f[2] for f in own) + extra) / (rows + extra)
    plain_mean = sum(f[2] for f in own) / rows
    spread = math.sqrt(max(sum(f[3] for f in own) / rows - plain_mean**2, 0.0))
    known = objectives.Facts(mean, spread, min(f[4] for f in own), max(f[5] for f in own))
    options = {"alpha": settings.quantile_alpha, "power": settings.tweedie_power, "delta": settings.huber_delta}
    classes = int(max(f[5] for f in facts)) + 1 if multi else 1
    if multi:
        start, root_of = [0.0] * classes, False
        limits = 1.0, 0.5
    else:
        chosen = objectives.objective(settings.objective, known, **options)
        if chosen.least_label is not None and (known.least < chosen.least_label or chosen.over_zero and known.least == chosen.least_label):
            raise ValueError(f"{settings.objective}: labels below its range")
        start, root_of = [float(chosen.start(known))], chosen.root
        ends = [chosen.gradient(np.array([y]), np.array([start[0]])) for y in (known.least, known.most)]
        limits = tuple(max(float(abs(e[i]).max()) for e in ends) * max(positive_weight, 1.0) for i in (0, 1))
    units = tuple(2.0 ** (math.ceil(math.log2(max(x, 1e-12))) - DIGITS) for x in limits)
    plan = _Plan(settings.objective, known, options, classes, positive_weight, units, settings.subsample, settings.seed, offsets)
    n_val = sum(f[1] for f in facts) - rows
    course = _Course(SimpleNamespace(**vars(settings)), rows, n_val, root_of, [], [])  # tasks need not import the settings' module
    make = _blocks(count, start)
    wanted = max(1, -(-(rows + n_val) // TASK_ROWS))  # tasks
    at_once = min(wanted, _tasks_at_once(context))
    folder = None
    if at_once and (rows + n_val) / at_once * (count + 8 + 40 * classes) <= HELD_BYTES:
        folder = _exchange_folder(spark)
    if folder is not None:
        done, course = _fit_held(table.repartition(at_once).rdd.mapPartitions(make), plan, course, edges, folder)
    else:
        done = _fit_by_jobs(table.rdd.coalesce(min(table.rdd.getNumPartitions(), wanted)).mapPartitions(make), plan, course, edges)
    keep = course.best + 1 if settings.early_stopping and n_val and course.val else len(done)
    return Boosted(list(features), edges, start, done[:keep], settings.objective, options, len(done), course.train, course.val)


def _fit_held(state: RDD, plan: _Plan, course: _Course, edges, folder: str) -> tuple[list[list[Tree]], _Course]:
    """All rounds, many in a stage whose tasks keep their blocks."""
    context = state.context
    ranges = _ranges(plan.offsets, state.getNumPartitions())
    done: list[list[Tree]] = []
    kept, ended = [], False
    state = state.persist(StorageLevel.MEMORY_AND_DISK)
    while not ended:
        told = state.barrier().mapPartitions(
            lambda part, course=course, numbers=range(len(done), len(done) + HELD_ROUNDS): _rounds(
                part, plan, course, edges, numbers, folder, ranges)).collect()
        for old in kept:
            old.unpersist()
        trees, course, ended = told[0]
        done += trees
        kept = [state]
        if not ended:
            shipped = context.broadcast(trees)  # bounded by the nodes of HELD_ROUNDS rounds
            state = state.map(lambda block, shipped=shipped: _with_rounds(block, shipped.value), preservesPartitioning=True)
            state = state.persist(StorageLevel.MEMORY_AND_DISK)
            state.checkpoint()
            kept.append(shipped)
    for old in kept:
        old.unpersist()
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    return done, course


def _fit_by_jobs(state: RDD, plan: _Plan, course: _Course, edges) -> list[list[Tree]]:
    """All rounds, a level in a job."""
    context, settings = state.context, course.settings
    done: list[list[Tree]] = []
    kept = None
    for number in range(settings.num_rounds + 1):
        used = _used(settings, len(edges), plan.classes, number)
        shipped = context.broadcast((plan, number, done[-1:], used))  # bounded by the nodes of a round
        state = state.map(lambda block, shipped=shipped: _with_rounds(block, shipped.value[2]), preservesPartitioning=True)
        state = state.persist(StorageLevel.MEMORY_AND_DISK)
        if number and number % CHECKPOINT_ROUNDS == 0:
            state.checkpoint()
        last = number == settings.num_rounds

        def begin(part, shipped=shipped, last=last):
            plan, number, _, used = shipped.value
            total = np.zeros((3, plan.classes, int(plan.offsets[-1])))
            losses = np.zeros(2)
            roots = [Tree(*[np.zeros(1, np.int64)] * 10) for _ in range(plan.classes)]
            slots = [np.array([k]) for k in range(plan.classes)]
            for block in part:
                losses[int(block[0])] += plan.losses(block[2], block[4])
                if not block[0] and not last:
                    total += _histograms(block, plan, number, roots, slots, used)
            yield np.concatenate([losses, total.reshape(-1)])

        found = _add(state.mapPartitions(begin))
        if kept is not None:
            kept[0].unpersist()
            kept[1].unpersist()
        kept = state, shipped
        if course.ends(number, float(found[0]), float(found[1])):
            break
        root = found[2:].reshape(3, plan.classes, int(plan.offsets[-1]))
        done.append(grow(_JobSums(state, context, plan, number, settings, used, root), settings, edges))
    if kept is not None:
        kept[0].unpersist()
        kept[1].unpersist()
    return done


# ---------------------------------------------------------------- a model as functions and tables


def margins_by_round(model: Boosted, bins: np.ndarray) -> Iterator[np.ndarray]:
    """The margins (classes x rows) after each round."""
    margins = np.repeat(np.array(model.start)[:, None], bins.shape[1], axis=1)
    for trees in model.rounds:
        margins = margins + np.array([t.value[t.leaves_of(bins)] for t in trees])
        yield margins


def respond(model: Boosted, margins: np.ndarray) -> np.ndarray:
    """Margins (classes x rows) to scores: probabilities, or numbers in the label's unit."""
    if len(model.start) > 1:
        return objectives.softmax(margins.T).T
    kind = objectives.objective(model.objective, objectives.Facts(0, 1, 0, 0), **model.options)
    return kind.respond(margins)


def predict(model: Boosted, df: DataFrame, by_round: bool = False) -> DataFrame:
    """`df` with prediction: an array of the score (one per class), or by round an array of those."""
    context = df.sparkSession.sparkContext
    shared = context.broadcast(model)  # bounded by its rounds and nodes
    names = {c.lower() for c in df.columns}
    name = next(n for n in ("prediction", *[f"prediction_{i}" for i in range(len(names) + 1)]) if n not in names)
    source = df.select("*", *[F.col(c).cast("double").alias(f"{name}_f{i}") for i, c in enumerate(model.features)])
    kind = "array<array<double>>" if by_round else "array<double>"
    target = df.sparkSession.createDataFrame([], f"{name} {kind}").schema
    target = type(target)([*df.schema.fields, *target.fields])
    width = len(df.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(target)
        for batch in batches:
            m = shared.value
            bins = binned(_matrix(batch, width), m.edges)
            many = margins_by_round(m, bins)
            rows, classes = batch.num_rows, len(m.start)
            if by_round:
                kept = np.array([respond(m, x) for x in many]).reshape(len(m.rounds), classes, rows)
                inner = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, rows * len(m.rounds) * classes + 1, classes), pa.int32()), pa.array(kept.transpose(2, 0, 1).reshape(-1)))
                made = pa.ListArray.from_arrays(pa.array(np.arange(0, rows * len(m.rounds) + 1, max(len(m.rounds), 1))[:rows + 1], pa.int32()), inner)
            else:
                margins = np.repeat(np.array(m.start)[:, None], rows, axis=1)
                for margins in many:
                    pass
                made = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, rows * classes + 1, classes), pa.int32()), pa.array(respond(m, margins).T.reshape(-1)))
            columns = [batch.column(i) for i in range(width)] + [made]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return source.mapInArrow(run, target)


TREE_TABLE = (
    "round int, class int, node int, parent int, place long, feature string, threshold double, missing_left boolean, left int, right int, "
    "value double, gain double, cover double, rows long")


def tree_rows(model: Boosted) -> list[tuple]:
    """The rows of TREE_TABLE: leaves have no feature, threshold, gain or children, roots no parent.

    `place` is 1 at the root, and 2p and 2p + 1 at the children of place p.
    """
    out = []
    for number, trees in enumerate(model.rounds):
        for k, t in enumerate(trees):
            parent = {int(child): n for n in range(len(t.left)) if t.left[n] != n for child in (t.left[n], t.right[n])}
            place = {0: 1}
            for n in range(len(t.left)):
                inner = t.left[n] != n
                if inner:  # children are made after their parent
                    place[int(t.left[n])], place[int(t.right[n])] = 2 * place[n], 2 * place[n] + 1
                out.append((
                    number, k, n, parent.get(n), place[n], model.features[t.feature[n]] if inner else None, float(t.threshold[n]) if inner else None,
                    bool(t.missing_left[n]) if inner else None, int(t.left[n]) if inner else None, int(t.right[n]) if inner else None,
                    None if inner else float(t.value[n]), float(t.gain[n]) if inner else None, float(t.weight[n]), int(t.rows[n])))
    return out


def save(model: Boosted, spark, path: str) -> None:
    """The trees as a Parquet table below `path`, and what else the model needs as a row beside it."""
    spark.createDataFrame(tree_rows(model), TREE_TABLE).coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")
    spark.createDataFrame(
        [(model.features, [e.tolist() for e in model.edges], model.start, model.objective, model.options, len(model.rounds))],
        "features array<string>, edges array<array<double>>, start array<double>, objective string, options map<string, double>, rounds int",
    ).coalesce(1).write.mode("overwrite").parquet(f"{path}/model")


def load(spark, path: str) -> Boosted:
    row = spark.read.parquet(f"{path}/model").first()
    edges = [np.array(e) for e in row["edges"]]
    number = {f: i for i, f in enumerate(row["features"])}
    trees: dict[tuple[int, int], list] = {}
    for r in spark.read.parquet(f"{path}/trees").collect():  # bounded by the model
        trees.setdefault((r["round"], r["class"]), []).append(r)
    rounds: list[list[Tree]] = [[None] * len(row["start"]) for _ in range(row["rounds"])]
    for (n, k), nodes in trees.items():
        nodes.sort(key=lambda r: r["node"])
        inner = [r["feature"] is not None for r in nodes]
        feature = np.array([number[r["feature"]] if i else 0 for r, i in zip(nodes, inner)])
        threshold = np.array([r["threshold"] if i else np.nan for r, i in zip(nodes, inner)])
        bins = [0 if not i or t == -np.inf else int(np.searchsorted(edges[f], t, "left")) + 1 for f, t, i in zip(feature, threshold, inner)]
        rounds[n][k] = Tree(
            feature, np.array(bins), threshold, np.array([r["missing_left"] if i else True for r, i in zip(nodes, inner)]),
            *[np.array([r[c] if i else r["node"] for r, i in zip(nodes, inner)]) for c in ("left", "right")],
            np.array([0.0 if i else r["value"] for r, i in zip(nodes, inner)]), np.array([r["gain"] if i else 0.0 for r, i in zip(nodes, inner)]),
            np.array([r["rows"] for r in nodes]), np.array([r["cover"] for r in nodes]))
    return Boosted(list(row["features"]), edges, list(row["start"]), rounds, row["objective"], dict(row["options"]), row["rounds"])
