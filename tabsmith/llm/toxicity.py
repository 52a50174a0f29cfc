"""Toxicity by a logistic classifier with a counterfactual regulariser.

Features are the words of a text and their beginnings, each once. The features are chosen and the
weights fitted on a sample of about `sample_rows` labelled training rows, drawn by a hash of the id:
its ids are few enough to be broadcast, so the other texts are not moved. Where a labelled text names a group, the term is swapped for others of its kind and for a neutral
word, and the change of the score is penalised, so naming a group by itself decides nothing.

Defined results: null and empty texts have no features and get the score of the bias alone; rows
with a null doc_id are scored and never learnt from; a document with several labels counts
with each; other columns stay, input columns called score or predicted are replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.llm.common import add_columns, free_name, map_rows, stage, text_or_empty

#: Fixed value: words are runs of letters, digits and characters beyond ASCII.
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Terms for groups of people, by kind; the first of each is a neutral word.
IDENTITY_TERMS = (
    ("people", "women", "men", "girls", "boys", "transgender"),
    ("person", "woman", "man", "girl", "boy"),
    ("people", "muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("ordinary", "muslim", "christian", "jewish", "hindu", "buddhist", "catholic"),
    ("ordinary", "black", "white", "asian", "african", "latino", "european", "american"),
    ("ordinary", "gay", "lesbian", "straight", "bisexual", "queer"),
    ("ordinary", "old", "young", "elderly", "blind", "deaf", "disabled"),
    ("people", "immigrants", "refugees", "foreigners"),
    ("menschen", "frauen", "männer", "muslime", "christen", "juden", "ausländer"),
    ("gens", "femmes", "hommes", "musulmans", "chrétiens", "juifs", "étrangers"),
    ("gente", "mujeres", "hombres", "musulmanes", "cristianos", "judíos", "extranjeros"),
)


@dataclass(frozen=True)
class Settings:
    """Production settings. `sample_rows` bounds the labelled rows that the classifier is fitted on."""

    max_features: int = 3000
    least_rows: int = 3
    least_told: float = 7.0
    prefixes: tuple[int, ...] = (4, 5)
    sample_rows: int = 50_000
    held_out_of: int = 5
    ridge: float = 1e-4
    counterfactual: float = 1.0
    steps: int = 400
    rate: float = 0.3


@dataclass
class Model:
    bias: float
    weights: dict[str, float] = field(default_factory=dict)
    prefixes: tuple[int, ...] = (4, 5)

    def score(self, text: str | None) -> float:
        known = self.weights
        found = {f for f in features(text, self.prefixes) if f in known}
        return float(1 / (1 + np.exp(-np.clip(self.bias + sum(map(known.__getitem__, sorted(found))), -50, 50))))


def features(text: str | None, prefixes: tuple[int, ...]) -> set[str]:
    """A text's words, and "beginning*" for words longer than each prefix."""
    words = set(_WORD.findall((text or "").lower()))
    return words.union(*({w[:n] + "*" for w in words if len(w) > n} for n in prefixes))


def held_out(column: str, of: int):
    """Whether a row is kept from learning: crc32 of the id as text leaves no remainder; null ids are, too."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % of == 0, F.lit(True))


def _swaps(text: str) -> list[tuple[str, str]]:
    """(term, other) for each group term of a text."""
    words = set(_WORD.findall(text.lower()))
    return [(t, o) for group in IDENTITY_TERMS for t in group[1:] if t in words for o in group if o != t]


def _count_features(prefixes: tuple[int, ...]):
    def run(batches):
        held: dict[str, list[int]] = {}

        def flush():
            names = list(held)
            for at in range(0, len(names), 50_000):
                part = names[at:at + 50_000]
                yield {"feature": part, "toxic_rows": [held[f][1] for f in part], "other_rows": [held[f][0] for f in part]}
            held.clear()

        for texts, labels in batches:
            for text, label in zip(texts, labels):
                for f in features(text, prefixes):
                    if (n := held.get(f)) is None:
                        n = held[f] = [0, 0]
                    n[label] += 1
                if len(held) > 100_000:
                    yield from flush()
        yield from flush()

    return run


def choose_features(labelled: DataFrame, settings: Settings) -> list[str]:
    """The features whose presence tells most about the label (G statistic)."""
    counted = map_rows(labelled, ["text", "toxic"], _count_features(settings.prefixes), "feature string, toxic_rows long, other_rows long")
    counted = counted.groupBy("feature").agg(F.sum("toxic_rows").alias("a"), F.sum("other_rows").alias("b")).filter(
        F.col("a") + F.col("b") >= settings.least_rows)
    sizes = {r["toxic"]: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return []
    part = lambda seen, rows, of: F.when(seen > 0, seen * F.log(seen * float(n1 + n0) / (rows * float(of)))).otherwise(0.0)
    a, b = F.col("a"), F.col("b")
    rest = n1 + n0 - a - b
    told = part(a, a + b, n1) + part(b, a + b, n0) + part(n1 - a, rest, n1) + part(n0 - b, rest, n0)
    # a feature must tell more than chance would, over the many that are tried
    top = counted.select("feature", told.alias("told")).filter(F.col("told") >= settings.least_told).orderBy(F.desc("told"), "feature").limit(settings.max_features)
    return [r["feature"] for r in top.collect()]


def _fit(rows: pa.Table, names: list[str], settings: Settings) -> Model:
    """Gradient steps (Adam) on log-loss, a ridge, and the squared change of the score under swaps.

    `rows` has toxic, found (numbers of features) and swaps (term, other).
    """
    number = {f: i for i, f in enumerate(names)}
    labels = rows.column("toxic").to_numpy().astype(float)
    found = rows.column("found").combine_chunks()
    at = np.repeat(np.arange(len(labels)), np.diff(found.offsets.to_numpy()))
    cols = found.flatten().to_numpy().astype(np.int64)
    swap_at, swap_cols, swap_by = [], [], []
    swaps = [(own, s["term"], s["other"]) for own, many in zip(found, rows.column("swaps").to_pylist()) for s in many]
    for k, (own, term, other) in enumerate(swaps):
        has = set(own.as_py())
        change = Counter({f: 1 for f in features(other, settings.prefixes) if number.get(f) not in has})
        change.subtract(features(term, settings.prefixes))
        for f, by in sorted(change.items()):
            if f in number and by:
                swap_at.append(k)
                swap_cols.append(number[f])
                swap_by.append(by)
    swap_at, swap_cols, swap_by = np.array(swap_at, np.int64), np.array(swap_cols, np.int64), np.array(swap_by, float)
    w, share = np.zeros(len(names) + 1), min(max(labels.mean(), 1e-3), 1 - 1e-3)
    w[-1] = np.log(share / (1 - share))
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, settings.steps + 1):
        logits = np.bincount(at, w[cols], len(labels)) + w[-1]
        wrong = 1 / (1 + np.exp(-np.clip(logits, -50, 50))) - labels
        grad = np.append(np.bincount(cols, wrong[at], len(names)), wrong.sum()) / len(labels)
        grad[:-1] += settings.ridge * w[:-1]
        if len(swaps):
            moved = np.bincount(swap_at, w[swap_cols] * swap_by, len(swaps))
            grad[:-1] += 2 * settings.counterfactual / len(swaps) * np.bincount(swap_cols, moved[swap_at] * swap_by, len(names))
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad ** 2
        rate = settings.rate * (1 - step / (settings.steps + 1))
        w -= rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return Model(float(w[-1]), {f: float(w[i]) for f, i in number.items() if abs(w[i]) > 1e-4}, settings.prefixes)


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Learn `labels.toxic` (0 or 1) from rows that are not held out."""
    known = labels.select(F.col("doc_id").alias("__id"), F.col("toxic").cast("int").alias("toxic")).filter("toxic in (0, 1)")
    known = known.filter(~held_out("__id", settings.held_out_of))
    rows = known.count()
    share = min(1.0, settings.sample_rows / max(rows, 1))
    drawn = known.filter(F.pmod(F.xxhash64(F.lit("sample"), "__id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    text = docs.select("doc_id", text_or_empty().alias("text"))
    # about sample_rows ids at most
    labelled = stage(text.join(F.broadcast(drawn), F.col("doc_id") == F.col("__id")).select("text", "toxic"), "labelled")
    names = choose_features(labelled, settings)
    if not names:  # nothing to tell apart
        share = labelled.agg(F.avg("toxic")).first()[0] or 0.0
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(float(np.log(share / (1 - share))), {}, settings.prefixes)
    number = {f: i for i, f in enumerate(names)}

    def pick(texts):
        found = [sorted(number[f] for f in features(t, settings.prefixes) if f in number) for t in texts]
        return {"found": found, "swaps": [[{"term": a, "other": b} for a, b in _swaps(t)] for t in texts]}

    picked = add_columns(labelled, ["text"], pick, "found array<int>, swaps array<struct<term:string,other:string>>")
    return _fit(picked.select("toxic", "found", "swaps").toArrow(), names, settings)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with score (0 to 1) and predicted (1 from 0.5 on)."""

    def run(texts):
        found = [model.score(t) for t in texts]
        return {"score": found, "predicted": [int(s >= 0.5) for s in found]}

    return add_columns(docs, ["text"], run, "score double, predicted int")


def remove_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that are predicted 0, with the columns of `docs`."""
    name = free_name(docs, "predicted_toxic")
    judged = add_columns(docs, ["text"], lambda texts: {name: [int(model.score(t) >= 0.5) for t in texts]}, f"{name} int")
    return judged.filter(F.col(name) == 0).select(*docs.columns)
