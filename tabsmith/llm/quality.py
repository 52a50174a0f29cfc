"""Quality rules by distribution divergence.

Each language of the corpus has two references, over all its documents: a histogram of
character classes and one of its most common words. A document is judged by the Jensen-Shannon
distance of its own histograms to the nearest reference; texts too short for a histogram
are not judged by it. Plain counts (symbols, repeated lines and word windows) come with it.

Defined results: null and empty texts have no words and fail the base rule; every language with
`reference_chars` characters has references, whatever its share of the corpus; documents of a language
with less are not judged by distance; those without a language are held against the nearest
reference; other columns stay, input columns with the names of new ones are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.llm.common import add_columns, free_name, map_rows, stage
from tabsmith.llm.wordcounts import count_words, words_of

#: Classes of characters, by the bytes that begin them.
CLASSES = {
    "lower": b"abcdefghijklmnopqrstuvwxyz", "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789",
    "space": b" \t\n\x0b\x0c\r", "stop": b".,;:'\"()-?", "call": b"!", "symbol": b"#*$%&|<>",
    "beyond": bytes(range(0xC0, 0x100)), "inside": bytes(range(0x80, 0xC0)),  # the last are no characters
}
_NAMES = [*CLASSES, "other"]
_CLASS_OF = np.full(256, len(CLASSES), np.uint8)
for _i, _name in enumerate(CLASSES):
    _CLASS_OF[np.frombuffer(CLASSES[_name], np.uint8)] = _i
# digits come in bursts in clean text (numbers, addresses) and tell nothing about it
_IN_HISTOGRAM = [i for i, n in enumerate(_NAMES) if n not in ("inside", "digit")]
_SYMBOL, _SPACE, _INSIDE = (_NAMES.index(n) for n in ("symbol", "space", "inside"))


@dataclass(frozen=True)
class Limits:
    """Production settings: the distances, the lengths from which they are used, and the references' size."""

    class_distance: float = 0.2
    word_distance: float = 0.4
    least_chars: int = 100
    least_words: int = 50
    common_words: int = 32
    reference_chars: int = 10_000


def class_counts(data: bytes) -> np.ndarray:
    return np.bincount(_CLASS_OF[np.frombuffer(data, np.uint8)], minlength=len(_NAMES))


def repeat_words(ids: np.ndarray, distinct: int, width: int = 5) -> int:
    """Words inside windows of `width` that occur twice or more; ids below `distinct` stand for words."""
    n = len(ids)
    if n <= width:
        return 0
    key, base = ids[:n - width + 1].astype(np.int64), max(distinct, 1)
    values = base
    for k in range(1, width):
        if values * base >= 1 << 62:  # the same windows by smaller numbers
            known, key = np.unique(key, return_inverse=True)
            values = len(known)
        key = key * base + ids[k:n - width + 1 + k]
        values *= base
    _, of, counts = np.unique(key, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[of] > 1)
    if not len(starts):
        return 0
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + width, -1)
    return int((np.cumsum(marks[:n]) > 0).sum())


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2, 0 to 1) between rows of counts and rows of references; rows without counts have 0."""
    p = p / np.maximum(p.sum(axis=-1, keepdims=True), 1e-300)
    q = q / np.maximum(q.sum(axis=-1, keepdims=True), 1e-300)
    m = (p + q) / 2

    def part(x):
        return np.where(x > 0, x * np.log2(np.where(x > 0, x, 1) / np.where(m > 0, m, 1)), 0).sum(axis=-1)

    return np.where(p.sum(axis=-1) > 0, np.sqrt(np.clip((part(p) + part(q)) / 2, 0, 1)), 0)


def references(docs: DataFrame, limits: Limits = Limits()) -> list[dict]:
    """One per language with enough text: its class counts, common words with their counts, and all its words.

    A row per language and common_words words of each come to the driver.
    """
    source = docs.select("text", F.col("lang").cast("string").alias("lang")).filter("lang is not null")

    def classes(batches):
        for texts, langs in batches:
            sums: dict[str, np.ndarray] = {}
            for text, lang in zip(texts, langs):
                sums[lang] = sums.get(lang, 0) + class_counts((text or "").encode())
            yield {"lang": list(sums), **{n: [int(v[i]) for v in sums.values()] for i, n in enumerate(_NAMES)}}

    by_class = map_rows(source, ["text", "lang"], classes, "lang string, " + ", ".join(f"{n} long" for n in _NAMES))
    by_class = by_class.groupBy("lang").agg(*[F.sum(n).alias(n) for n in _NAMES])
    total = sum((F.col(n) for n in _NAMES if n != "inside"), F.lit(0))
    large = stage(by_class.filter(total >= max(limits.reference_chars, 1)), "language-classes")
    found = large.collect()
    if not found:
        return []
    words = count_words(source, "lang").join(large.select(F.col("lang").alias("grp")), "grp", "left_semi")
    sums = words.groupBy("grp").agg(F.sum("n").alias("all"))
    ranked = words.withColumn("nth", F.row_number().over(Window.partitionBy("grp").orderBy(F.desc("n"), "word")))
    top: dict[str, dict[bytes, int]] = {}
    every: dict[str, int] = {}
    for w in ranked.filter(F.col("nth") <= limits.common_words).join(sums, "grp").collect():
        top.setdefault(w["grp"], {})[bytes(w["word"])] = w["n"]
        every[w["grp"]] = w["all"]
    return [
        {"lang": r["lang"], "classes": [r[_NAMES[i]] for i in _IN_HISTOGRAM], "words": top.get(r["lang"], {}), "all": every.get(r["lang"], 0)}
        for r in sorted(found, key=lambda r: r["lang"])]


def measure(docs: DataFrame, refs: list[dict], limits: Limits = Limits()) -> DataFrame:
    """`docs` with the counts, class_distance, word_distance (null when too short), base_failed and kept."""
    column = {w: i for i, w in enumerate(sorted({w for r in refs for w in r["words"]}))}
    class_refs = np.array([r["classes"] for r in refs], float).reshape(len(refs), len(_IN_HISTOGRAM))
    # per reference, the columns of its words (the last one has no hits), and their counts with all others last
    wide = max((len(r["words"]) for r in refs), default=0)
    own = np.array([[column[w] for w in r["words"]] + [len(column)] * (wide - len(r["words"])) for r in refs], np.int64).reshape(len(refs), wide)
    word_refs = np.array(
        [[*r["words"].values(), *[0] * (wide - len(r["words"])), r["all"] - sum(r["words"].values())] for r in refs], float).reshape(len(refs), wide + 1)
    known = {None, *(r["lang"] for r in refs)}

    def run(texts, langs):
        rows = []
        for text, lang in zip(texts, langs):
            text = text or ""
            data = text.encode()
            words = words_of(text)
            plain = data.split()  # repeats are of the words as they are written
            number: dict[bytes, int] = {}
            ids = np.array([number.setdefault(w, len(number)) for w in plain], np.int64)
            counts = class_counts(data)
            lines = [line for line in data.split(b"\n") if line.strip(b" \t\n\r\x0b\x0c")]
            chars = int(counts.sum() - counts[_INSIDE])
            row = {
                "n_words": len(words), "word_chars": chars - int(counts[_SPACE]), "n_symbols": int(counts[_SYMBOL]),
                "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": repeat_words(ids, len(number)),
                "class_distance": None, "word_distance": None}
            judged = refs and lang in known
            if judged and chars >= limits.least_chars:
                row["class_distance"] = float(js_distance(counts[_IN_HISTOGRAM][None, :].astype(float), class_refs).min())
            if judged and len(words) >= limits.least_words:
                hits = np.zeros(len(column) + 1)
                for w in words:
                    if (c := column.get(w)) is not None:
                        hits[c] += 1
                mine = hits[own]
                others = len(words) - mine.sum(axis=1, keepdims=True)
                row["word_distance"] = float(js_distance(np.concatenate([mine, others], axis=1), word_refs).min())
            row["base_failed"] = row["n_words"] < 10 or 100 * row["n_repeat_words"] > 20 * row["n_words"]
            row["kept"] = not row["base_failed"] and (row["class_distance"] or 0) <= limits.class_distance and (
                row["word_distance"] or 0) <= limits.word_distance
            rows.append(row)
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_distance", "word_distance", "base_failed", "kept"]
        return {n: [r[n] for r in rows] for n in names}

    name = free_name(docs, "__lang")
    return add_columns(
        docs.withColumn(name, F.col("lang").cast("string")), ["text", name], run,
        "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, class_distance double, "
        "word_distance double, base_failed boolean, kept boolean").drop(name)


def apply_rules(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """References from all documents, then every document measured against them."""
    return measure(docs, references(docs, limits), limits)
