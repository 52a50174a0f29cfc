import re
import time

import numpy as np
import pytest
from odd_rows import ODD
from pyspark.sql import functions as F

from tabsmith.llm import decontaminate


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, n=13):
    windows = {}
    for item, text in items:
        w = words(text)
        size = min(n, len(w))
        for i in range(len(w) - size + 1) if w else ():
            windows.setdefault(tuple(w[i:i + size]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                if (key := tuple(w[i:i + size])) in windows:
                    hit |= set(range(i, i + size))
                    found |= windows[key]
        out.append((doc, text, len(w), len(hit), len(found), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def _cases():
    rng = np.random.default_rng(6)
    vocabulary = [f"w{k}" for k in range(300)] + ["É", "漢字", "The"]
    text = lambda n: " ".join(rng.choice(vocabulary, n))
    items = [(k, text(int(rng.integers(14, 40)))) for k in range(12)] + [
        (50, "Short item, only five words."), (51, None), (52, "?!"), (53, "one"), (54, "a " * 30), (None, text(20))]
    docs = []
    for i in range(80):
        parts = [text(int(rng.integers(0, 120)))]
        if i % 3 == 0:
            w = words(items[int(rng.integers(0, 12))][1])
            parts.append(" - ".join(w[: int(rng.integers(10, 14))]).upper())
        if i % 7 == 0:
            parts.append("short ITEM only (five) words")
        if i % 11 == 0:
            parts.append("a a a " * 9)
        docs.append((i, ", ".join(parts)))
    return docs + ODD, items


@pytest.mark.parametrize("broadcast", [True, False])
def test_equals_brute_force(spark, frame, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    docs, items = _cases()
    items = [(i, t) for i, t in items if i is not None]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.judge(frame(docs), benchmark).collect()
    assert sorted(map(str, [(r["doc_id"], r["text"], r["n_words"], r["n_hit"], r["n_items"], r["hit_items"], r["contaminated"]) for r in got])) == sorted(
        map(str, brute(docs, items)))
    kept = decontaminate.remove_contaminated(frame(docs), benchmark)
    assert kept.columns == frame(docs).columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r[0]) for r in brute(docs, items) if not r[-1])


def test_clashing_and_empty(spark, frame, odd):
    benchmark = spark.createDataFrame([(1, "one")], "item_id long, text string")
    clash = odd.withColumnsRenamed({"lang": "contaminated", "lines": "n_hit", "fp": "hash"})
    judged = decontaminate.judge(clash, benchmark)
    assert judged.columns.count("contaminated") == 1 and judged.columns.count("n_hit") == 1
    kept = decontaminate.remove_contaminated(clash, benchmark)
    assert kept.columns == clash.columns and {r["contaminated"] for r in kept.collect()} == {"en"}
    assert decontaminate.judge(odd.limit(0), benchmark).count() == 0
    assert not any(r["contaminated"] for r in decontaminate.judge(odd, benchmark.limit(0)).collect())


def test_null_items_are_ignored_only_without_words(spark, frame):
    benchmark = spark.createDataFrame([(None, "one two three")], "item_id long, text string")
    got = decontaminate.judge(frame([(1, "one two three four")]), benchmark).first()
    assert (got["n_hit"], got["n_items"]) == (3, 0)


def test_shuffled_windows_of_long_texts_carry_no_words(spark, frame, monkeypatch):
    rng = np.random.default_rng(2)
    texts = [(i, " ".join(f"w{k}" for k in rng.integers(0, 5000, 8000))) for i in range(20)]
    items = [(0, " ".join(texts[3][1].split()[100:130])), (1, "one two three")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    seconds = {}
    for windows in (200_000, 0):
        monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", windows)
        start = time.time()
        rows = decontaminate.judge(frame(texts), benchmark).collect()
        seconds[windows] = time.time() - start
        assert {r["doc_id"]: r["n_hit"] for r in rows if r["n_hit"]} == {3: 30}
    assert seconds[0] < 2 * seconds[200_000] + 5


def test_internal_names_of_users_survive(spark, frame):
    benchmark = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    names = ["__words", "__body", "__hit", "__items", "__doc", "__hit_body", "__verdict", "kept__words", "in0"]
    df = frame([(1, "one two"), (2, "none")]).select("doc_id", "text", *[F.lit(f"mine {n}").alias(n) for n in names])
    for out in (decontaminate.judge(df, benchmark), decontaminate.remove_contaminated(df, benchmark)):
        assert out.columns[:len(df.columns)] == df.columns
        assert all(r[n] == f"mine {n}" for r in out.collect() for n in names)
