import re
from collections import Counter

import numpy as np
import pytest
from odd_rows import ODD
from pyspark.sql import functions as F

from tabsmith.llm import phrases


def brute(rows, least, longest=5, top=2000):
    """`rows` are (text, lang); the result's rows as tuples."""
    counts, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        held = counts.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                held.update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = set()
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    if 100 * a >= 100 * f[p[i:i + size]]:
                        gone.add(p[i:i + size])
        ranked = []
        for p, a in candidates.items():
            if p not in gone:
                score, k = min((1000 * a * n[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def corpus(seed, texts=300):
    rng = np.random.default_rng(seed)
    vocabulary = ["the", "The", "of", "new", "york", "city", "in", "a", "é", "É", "漢字", "x\x1cy", "u v"]
    marks = [" ", "  ", "\t", ". ", ",", "\n", "!", " ; ", "\x0b", "\r\n"]
    rows = []
    for _ in range(texts):
        words = rng.choice(vocabulary, rng.integers(0, 60))
        text = "".join(w + str(rng.choice(marks, p=[.6, .1, .05, .05, .05, .05, .02, .02, .03, .03])) for w in words)
        rows.append((text, [None, "en", "fr", "und", ""][rng.integers(0, 5)]))
    rows += [("in the city of new york, the city that never sleeps", "en")] * 60
    return rows


def frame(spark, rows, parts=5):
    return spark.createDataFrame(rows, "text string, lang string").repartition(parts)


@pytest.mark.parametrize("least,chunk", [(1, 1_000_000), (5, 50), (60, 700)])
def test_equals_brute_force(spark, monkeypatch, least, chunk):
    from tabsmith.llm.common import prepare

    prepare(spark)
    rows = corpus(least)
    monkeypatch.setattr(phrases, "CHUNK_WORDS", chunk)
    monkeypatch.setattr(phrases, "HELD_WORDS", 2 * chunk)
    assert got(phrases.best_collocations(frame(spark, rows), least=least)) == brute(rows, least)


def test_ranks_lengths_and_shares(spark):
    rows = corpus(8, 150)
    df = frame(spark, rows)
    assert got(phrases.best_collocations(df, top=7, least=3, longest=3)) == brute(rows, 3, 3, 7)
    every = {r["phrase"] for r in phrases.collocations(df, least=3, swallowed=101).collect()}
    fewer = {r["phrase"] for r in phrases.collocations(df, least=3, swallowed=50).collect()}
    usual = {r["phrase"] for r in phrases.collocations(df, least=3).collect()}
    assert fewer < usual < every


def test_odd_rows(spark, odd):
    clash = odd.withColumnsRenamed({"lines": "chunk", "fp": "phrase", "__x": "rank"})
    rows = [(t, "en") for _, t in ODD]
    assert got(phrases.best_collocations(clash, least=2)) == brute(rows, 2)
    assert got(phrases.best_collocations(odd.limit(0), least=1)) == []
    assert got(phrases.best_collocations(odd.withColumn("text", F.lit(None)), least=1)) == []
    assert got(phrases.best_collocations(odd, least=10**9)) == []


def test_arithmetic_is_exact_beyond_64_bits(spark):
    n, f1, f2, f3, a12, a23, a = 10**15 + 7, 9 * 10**11 + 1, 7 * 10**11 + 3, 10**12 + 9, 5 * 10**11, 6 * 10**11 + 5, 4 * 10**11 + 1
    df = spark.createDataFrame([(n, [f1, a12, a], [f3, a23, a])], "n long, l array<long>, r array<long>")
    score, k, left, right = df.select(phrases.weakest_cut(F.col("n"), F.col("l"), F.col("r"), 3).alias("c")).first()["c"]
    assert (score, k, left, right) == min((1000 * a * n // (x * y), k, x, y) for k, x, y in ((1, f1, a23), (2, a12, f3)))


def test_numbers_pack(spark):
    numbers = np.array([0, 1, 255, 256, 70_000, 2**31 - 1], np.int32)
    assert phrases.unpacked(phrases.packed(numbers)).tolist() == numbers.tolist()
    assert phrases.unpacked(phrases.packed(numbers[:0])).tolist() == []


def test_joins_are_sort_merge_joins(spark):
    plan = phrases.collocations(frame(spark, corpus(1, 20)), least=2)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "ShuffledHashJoin" not in plan


def test_rank_of_a_language_reads_a_bounded_share(spark, monkeypatch):
    # one window by lang ranked all phrases of a language in one task; now each part gives it at most `top`
    rows = corpus(8, 150)
    monkeypatch.setattr(phrases, "RANK_PARTS", 3)
    df = phrases.best_collocations(frame(spark, rows), top=4, least=3)
    assert got(df) == brute(rows, 3, top=4)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("row_number()") >= 2 and "xxhash64(phrase" in plan
