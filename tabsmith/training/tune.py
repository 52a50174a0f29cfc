"""Search over tree parameters, scored on a fixed validation table."""

from __future__ import annotations

import hashlib
import itertools
import json
import math
import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, fields, replace

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.operators import evaluate
from tabsmith.training.model import TreeParams, larger_is_better, report, report_column, score, train


@dataclass(frozen=True)
class Continuous:
    low: float
    high: float

    def draw(self, rng: random.Random) -> float:
        return rng.uniform(self.low, self.high)

    def steps(self, n: int) -> list[float]:
        return [self.low + (self.high - self.low) * i / max(n - 1, 1) for i in range(n)]


@dataclass(frozen=True)
class Integer:
    low: int
    high: int

    def draw(self, rng: random.Random) -> int:
        return rng.randint(self.low, self.high)

    def steps(self, n: int) -> list[int]:
        return sorted({round(x) for x in Continuous(self.low, self.high).steps(n)})


Space = Mapping[str, Continuous | Integer]

# The ranges that are searched unless a run names its own.
DEPTHWISE_SPACE: Space = {
    "learning_rate": Continuous(0.01, 0.3), "max_depth": Integer(3, 10),
    "subsample": Continuous(0.5, 1.0), "colsample": Continuous(0.5, 1.0), "min_child": Integer(1, 10),
}
LEAFWISE_SPACE: Space = {
    "learning_rate": Continuous(0.01, 0.3), "max_depth": Integer(3, 10),
    "subsample": Continuous(0.5, 1.0), "colsample": Continuous(0.5, 1.0), "min_child": Integer(5, 50),
}


# Names of ranges that are settings here under another name.
RANGE_NAMES = {
    "colsample_bytree": "colsample", "min_child_weight": "min_child", "min_child_samples": "min_child", "eta": "learning_rate",
    "feature_fraction": "colsample", "bagging_fraction": "subsample",
}


def space_from_config(ranges: Mapping[str, Mapping]) -> Space:
    """Ranges from `{name: {type: continuous|integer, min:, max:}}`, with names in the usual spellings."""
    kinds = {"continuous": (Continuous, float), "integer": (Integer, int)}
    known = {f.name for f in fields(TreeParams)}
    out = {}
    for name, spec in ranges.items():
        plain = name.replace("-", "_").lower()
        setting = RANGE_NAMES.get(plain, plain)
        if plain == "num_leaves":
            raise ValueError("num-leaves: trees grow level by level here; bound them by max-depth")
        if setting not in known:
            raise ValueError(f"{name}: no such setting")
        kind, number = kinds[str(spec["type"]).lower()]
        if isinstance(getattr(TreeParams, setting), int) and kind is Continuous:
            kind, number = Integer, lambda x: int(float(x))  # a whole-numbered setting
        out[setting] = kind(number(spec["min"]), number(spec["max"]))
    return out


def random_trials(space: Space, n: int, seed: int = 42) -> list[dict]:
    rng = random.Random(seed)
    return [{name: r.draw(rng) for name, r in space.items()} for _ in range(n)]


def grid_trials(space: Space, n: int | None = None, per_axis: int = 3) -> list[dict]:
    """All points of the grid with `per_axis` steps on each axis; more than `n` of them are an error."""
    axes = [[(name, v) for v in r.steps(per_axis)] for name, r in space.items()]
    points = math.prod(map(len, axes))
    if n is not None and points > n:
        raise ValueError(f"the grid has {points} points and {n} trials are allowed: allow more, or use fewer steps or random trials")
    return [dict(point) for point in itertools.product(*axes)]


def _density(x: Sequence[float], points: Sequence[Sequence[float]], width: float) -> float:
    """Of a mixture of bells around the points and an even share over the unit cube."""
    height = (width * math.sqrt(2 * math.pi)) ** len(x)
    bells = sum(math.exp(-sum((a - b) ** 2 for a, b in zip(x, p)) / (2 * width**2)) / height for p in points)
    return (bells + 1.0) / (len(points) + 1)


def parzen_trials(
    space: Space, done: Sequence[tuple[dict, float | None]], n: int, seed: int = 42, maximize: bool = True,
    startup: int = 8, best_share: float = 0.2, candidates: int = 24, width: float = 0.15,
) -> list[dict]:
    """The next `n` points, given the (point, objective) of the trials so far; the same history and seed give the same points.

    Up to `startup` trials points are drawn at random. Then the best share of them and the others give a Parzen density each,
    over all settings together, with a width that shrinks with the trials; of some candidates drawn from the first density the one
    that is likeliest under it against the second is taken, and keeps the rest of its batch off. Trials without an objective count among the others.
    """
    rng = random.Random(f"{seed}/{len(done)}")
    found = [(p, v) for p, v in done if v is not None]
    if len(found) < startup:
        return [{name: r.draw(rng) for name, r in space.items()} for _ in range(n)]
    spans = {name: float(r.high - r.low) or 1.0 for name, r in space.items()}
    place = lambda p: [(p[name] - r.low) / spans[name] for name, r in space.items()]
    ranked = sorted(found, key=lambda t: -t[1] if maximize else t[1])
    some = max(2, round(best_share * len(ranked)))
    best = [place(p) for p, _ in ranked[:some]]
    rest = [place(p) for p, _ in ranked[some:]] + [place(p) for p, v in done if v is None]
    width *= (startup / len(found)) ** (1 / 3)
    out = []
    for _ in range(n):
        drawn = []
        for _ in range(candidates):
            centre = rng.choice([*best, None])
            x = [rng.random() if centre is None else min(1.0, max(0.0, rng.gauss(c, width))) for c in centre or spans]
            drawn.append((_density(x, best, width) / _density(x, rest, width), x))
        x = max(drawn)[1]
        rest.append(x)
        point = {}
        for (name, r), at in zip(space.items(), x):
            value = r.low + spans[name] * at
            point[name] = min(r.high, max(r.low, round(value))) if isinstance(r, Integer) else value
        out.append(point)
    return out


LEDGER = "trial int, algorithm string, params string, rounds int, objective double, error string, metric string, fixed string"


def _exists(spark, path: str) -> bool:
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there)


def _finished(spark, ledger: str | None) -> dict[tuple, tuple]:
    """(algorithm, params, metric, fixed settings) -> (rounds, objective) of the trials that a ledger has."""
    if not ledger or not _exists(spark, ledger):
        return {}
    rows = spark.read.schema(LEDGER).json(f"{ledger.rstrip('/')}/*").filter("error is null").collect()  # one row per trial
    return {(r["algorithm"], r["params"], r["metric"], r["fixed"]): (r["rounds"], r["objective"]) for r in rows}


def tune_in_turns(
    train_df: DataFrame, val_df: DataFrame, label: str, searches: Mapping[str, tuple[TreeParams, Space, int]], metric: str = "auc_roc",
    parallel: int = 4, seed: int = 42, direction: str | None = None, ledger: str | None = None,
) -> DataFrame:
    """Trials asked for in batches of `parallel`, each batch after what the earlier ones found.

    `searches` gives, by algorithm name, the fixed parameters, the ranges and the number of trials.
    """
    maximize = _maximize(direction or direction_of(metric))
    rows: list[tuple] = []
    for name, (base, space, budget) in searches.items():
        done: list[tuple[dict, float | None]] = []
        while len(done) < budget:
            points = parzen_trials(space, done, min(parallel, budget - len(done)), seed, maximize)
            found = tune(train_df, val_df, label, {name: (base, points)}, metric, parallel, ledger, must_work=False).orderBy("trial").collect()
            done += [(point, r["objective"]) for point, r in zip(points, found)]
            rows += [(len(rows) + i, *r[1:]) for i, r in enumerate(found)]
    if rows and all(r[-1] for r in rows):
        raise RuntimeError(f"every trial failed, the first with: {rows[0][-1]}")
    return train_df.sparkSession.createDataFrame(rows, TRIALS)


TRIALS = "trial int, algorithm string, params string, rounds int, objective double, error string"


def tune(
    train_df: DataFrame,
    val_df: DataFrame,
    label: str,
    searches: Mapping[str, tuple[TreeParams, Sequence[dict]]],
    metric: str = "auc_roc",
    parallel: int = 4,
    ledger: str | None = None,
    must_work: bool = True,
) -> DataFrame:
    """One row per trial: (trial, algorithm, params, objective).

    `searches` gives, by algorithm name, the fixed parameters and the points to
    try. Trials run side by side as jobs of one application; every trial is
    scored on the whole validation table. A failed trial has its error and no objective; an
    objective that is no number counts as none. Every finished trial is written below `ledger`, if it is given; a search that starts
    again there takes over what is finished under the same settings and metric. With `must_work` it is an error if all trials fail.
    """
    spark = train_df.sparkSession
    finished = _finished(spark, ledger)
    trials = [(name, replace(base, **point), point) for name, (base, points) in searches.items() for point in points]
    weight = None
    if any(p.task == "binary" for _, p, _ in trials):
        weight = evaluate.class_balance(train_df, label).first()["weight"]
    column = report_column(metric)

    def run(number: int) -> tuple:
        name, params, point = trials[number]
        said = json.dumps(point, sort_keys=True)
        key = (name, said, column, json.dumps(asdict(params), sort_keys=True))
        if key in finished:
            return number, name, said, *finished[key], None
        try:
            trained = train(train_df, val_df, label, params, weight)
            value = report(trained, score(trained, val_df)).first()[column]
            row = number, name, said, trained.rounds, value if value is None or math.isfinite(value) else None, None
            if ledger:  # a folder per trial, as several are written at a time
                path = f"{ledger.rstrip('/')}/{hashlib.md5(repr(key).encode()).hexdigest()}"
                spark.createDataFrame([(*row, *key[2:])], LEDGER).coalesce(1).write.mode("overwrite").json(path)
            return row
        except Exception as e:  # noqa: BLE001 - one failed trial must not cost the others
            return number, name, said, None, None, str(e)[:500]

    with ThreadPoolExecutor(parallel) as pool:
        # one wrapper per trial: each copies the caller's local properties
        jobs = [pool.submit(inheritable_thread_target(spark)(run), i) for i in range(len(trials))]
        results = [j.result() for j in jobs]
    if must_work and results and all(r[-1] for r in results):
        raise RuntimeError(f"every trial failed, the first with: {results[0][-1]}")
    return spark.createDataFrame(results, TRIALS)


def _maximize(direction: str) -> bool:
    plain = direction.lower()
    if plain not in ("maximize", "minimize"):
        raise ValueError(f"direction {direction}: use maximize or minimize")
    return plain == "maximize"


def _order(direction: str) -> list:
    best = F.desc_nulls_last if _maximize(direction) else F.asc_nulls_last
    return [best(F.nanvl(F.col("objective").cast("double"), F.lit(None).cast("double"))), F.asc("trial"), F.asc("algorithm")]


def direction_of(metric: str) -> str:
    return "maximize" if larger_is_better(report_column(metric)) else "minimize"


def top_trials(trials: DataFrame, n: int, direction: str = "maximize") -> DataFrame:
    """The best n trials of all algorithms; ties go to the lower trial number."""
    return trials.orderBy(*_order(direction)).limit(n)


def best_by_algorithm(trials: DataFrame, direction: str = "maximize") -> DataFrame:
    """The best trial of each algorithm, found by an aggregate that combines before the shuffle."""
    sign = -1 if _maximize(direction) else 1
    objective = F.nanvl(F.col("objective").cast("double"), F.lit(None).cast("double"))
    rank = F.struct(objective.isNull(), sign * objective, F.col("trial"))
    others = [c for c in trials.columns if c != "algorithm"]
    row = F.struct(*[F.col(c) for c in others])
    return trials.groupBy("algorithm").agg(F.min_by(row, rank).alias("best")).select("algorithm", "best.*")
