import re

import numpy as np
import xxhash
from odd_rows import ODD
from pyspark.sql import functions as F

from tabsmith.llm import neardup


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def brute_components(prints):
    """Index of the first print that links reach, by comparing all pairs."""
    root = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3 and root[i] != root[j]:
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    return root


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints():
    for text in [None, "", "one", "Two words", "a b c", "a  b\tc\nd", "Ünï " * 40, "x y z " * 30_000]:
        assert neardup.simhash(text or "") == _signed(brute_print(text))


def _planted(n, seed):
    rng, prints = np.random.default_rng(seed), []
    for _ in range(n):
        base = int(rng.integers(0, 1 << 63)) * 2 + 1
        prints.append(base)
        for _ in range(int(rng.integers(0, 4))):  # chains of up to three changes each, and some of four
            for b in rng.choice(64, int(rng.integers(1, 5)), replace=False):
                base ^= 1 << int(b)
            prints.append(base)
    return sorted(set(prints))


def test_links_lose_nothing(spark):
    for segment_bits in (1, 2, 4):
        prints = _planted(60, segment_bits)
        df = spark.createDataFrame([(_signed(p),) for p in prints], "fp long")
        got = {tuple(r) for r in neardup.links(df, 3, segment_bits).collect()}
        want = {tuple(sorted((_signed(a), _signed(b)))) for i, a in enumerate(prints) for b in prints[:i] if (a ^ b).bit_count() <= 3}
        assert got == want
    for bits in (0, 1, 2, 5):
        got = {tuple(r) for r in neardup.links(df, bits).collect()}
        assert got == {tuple(sorted((_signed(a), _signed(b)))) for i, a in enumerate(prints) for b in prints[:i] if (a ^ b).bit_count() <= bits}


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(i, i + 1) for i in range(50)] + [(1000, int(k)) for k in rng.integers(1001, 1100, 80)] + [(5000, 6000), (6000, 5500), (7, 7)]
    got = {r["node"]: r["root"] for r in neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = sorted({x for e in edges for x in e if e[0] != e[1]})
    root = {n: n for n in nodes}
    for _ in range(60):
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    assert got == root
    assert neardup.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_documents(frame):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(60):
        words = [f"w{k}" for k in rng.integers(0, 500, 150)]
        rows.append((len(rows), " ".join(words)))
        for _ in range(int(rng.integers(0, 4))):
            words[int(rng.integers(0, 150))] = "changed"
            rows.append((len(rows), " ".join(words)))
    rows += [(2000 + i, "copied " * 30) for i in range(50)] + ODD
    prints = [brute_print(t) for _, t in rows]
    root = brute_components(prints)
    names = {r: min((rows[k][0] for k in range(len(rows)) if root[k] == r and rows[k][0] is not None), default=None) for r in set(root)}
    got = neardup.near_duplicates(frame(rows))
    want = sorted(map(str, [(i, t, f"{p:016x}", names[r]) for (i, t), p, r in zip(rows, prints, root)]))
    assert sorted(map(str, [(r["doc_id"], r["text"], r["fingerprint"], r["component_id"]) for r in got.collect()])) == want
    narrow = neardup.near_duplicates(frame(rows).select("doc_id", "text")).select("doc_id", "fingerprint", "component_id")
    assert sorted(map(str, map(tuple, narrow.collect()))) == sorted(str((i, f"{p:016x}", names[r])) for (i, _), p, r in zip(rows, prints, root))
    kept = neardup.keep_first(frame(rows))
    assert kept.columns == frame(rows).columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(ids, key=str) == sorted(names.values(), key=str)
    assert neardup.keep_first(frame(rows).limit(0)).count() == 0


def test_null_ids_only(frame):
    rows = [(None, "the same text"), (None, "the same text"), (None, "quite another text of words")]
    got = neardup.near_duplicates(frame(rows)).collect()
    assert [r["component_id"] for r in got] == [None] * 3 and neardup.keep_first(frame(rows)).count() == 2
    assert neardup.near_duplicates(frame(rows).withColumn("fingerprint", F.lit(1))).columns.count("fingerprint") == 1
