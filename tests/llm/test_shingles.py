import re

import numpy as np
import pytest
from odd_rows import ODD
from pyspark.sql import functions as F
from test_neardup import brute_components, brute_print

from tabsmith.llm import neardup, shingles
from tabsmith.llm.common import add_columns, prepare


@pytest.fixture(autouse=True)
def workers(spark):
    prepare(spark)


def brute_set(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    width = min(width, len(words))
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def alike(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b) and len(a | b) > 0


def brute_groups(texts):
    """Index of the first text of each group: prints within 3 bits, or sets of which four fifths are shared."""
    root = brute_components([brute_print(t) for t in texts])
    sets = [brute_set(t) for t in texts]
    for i in range(len(texts)):
        for j in range(i):
            if root[i] != root[j] and alike(sets[i], sets[j]):
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    return root


def families(seed, count, changes):
    """Texts of 60 to 200 words with copies that have some words changed, and chains of copies of copies."""
    rng = np.random.default_rng(seed)
    texts = []
    for f in range(count):
        base = [f"w{k}" for k in rng.integers(0, 3000, int(rng.integers(60, 200)))]
        texts.append(" ".join(base))
        for c in range(int(rng.integers(1, 5))):
            words = list(base)
            for _ in range(int(rng.integers(1, changes))):
                words[int(rng.integers(0, len(words)))] = f"x{f}.{c}.{rng.integers(0, 9)}"
            texts.append(" ".join(words))
            if rng.integers(0, 2):
                base = words
    return texts


def test_sets_and_buckets():
    for text in [None, "", " \t", "one", "Two words", "a b c d e", "a b c d e f A B C D E F", "x y z " * 30_000, "Ünï 漢字 " * 9]:
        assert len(shingles.shingle_set(text)) == len(brute_set(text))
    assert (shingles.shingle_set("A b\tC d e f") == shingles.shingle_set("a B c D e  F")).all()
    assert not set(shingles.shingle_set("a b c").tolist()) & set(shingles.shingle_set("a b c a b c").tolist())
    assert len(shingles.bands_of(shingles.shingle_set(None))) == 0
    words = [f"w{i}" for i in range(5000)]
    assert len(shingles.bands_of(shingles.shingle_set(" ".join(words)))) == shingles.BANDS


def test_groups_equal_all_pairs(frame):
    texts = families(1, 60, 12) + ["a b c d e f", "A  b c d e F", "a b c d e f", "g h"]
    rows = list(enumerate(texts))
    root = brute_groups(texts)
    want = sorted({r: i for i, r in reversed(list(enumerate(root)))}.values())
    assert len(want) < len(set(brute_components([brute_print(t) for t in texts])))  # shingles find what prints do not
    assert sorted(r["doc_id"] for r in neardup.keep_first(frame(rows), overlap=(4, 5)).collect()) == want


def test_the_second_step_finds_all_links(spark):
    """Without the ends of the buckets, the pairs of a bucket that are in different components find the same links."""
    shared = [f"s{i}" for i in range(178)]
    # 60 pairs of texts; texts of different pairs share nearly four fifths of their shingles
    texts = [" ".join(shared + [f"f{f}.{i}" for i in range(22)] + [f"c{c}"]) for f in range(60) for c in range(2)]
    df = spark.createDataFrame(list(enumerate(texts)), "fp long, text string").withColumn("body", F.xxhash64("text"))
    hashed = add_columns(df, ["text"], shingles.described, shingles.DESCRIBED)
    found = shingles.Overlaps(hashed.drop("text"), df.select("body", "text"), (4, 5))
    pairs = {(2 * f, 2 * f + 1) for f in range(60)}
    assert {tuple(sorted(r)) for r in found.first_links().collect()} == pairs
    found.met = found.met.limit(0)
    some = neardup.components(found.first_links().unionByName(spark.createDataFrame([(0, 1), (7, 6)], "a long, b long")))
    assert {tuple(sorted(r)) for r in found.links_between(some).collect()} == pairs - {(0, 1), (6, 7)}


def test_a_large_group_makes_few_pairs(spark):
    texts = [" ".join([f"s{i}" for i in range(100)] + [f"own{k}"]) for k in range(3000)]
    df = spark.createDataFrame(list(enumerate(texts)), "fp long, text string").withColumn("body", F.xxhash64("text"))
    hashed = add_columns(df, ["text"], shingles.described, shingles.DESCRIBED)
    found = shingles.Overlaps(hashed.drop("text"), df.select("body", "text"), (4, 5))
    assert found.met.count() < 2 * 24 * 3000
    roots = neardup.components(found.first_links())
    assert roots.select("root").distinct().count() == 1 and roots.count() == 3000
    assert found.links_between(roots).count() == 0


def test_odd_rows(frame):
    df = frame(ODD)
    kept = neardup.keep_first(df, overlap=(4, 5))
    assert kept.columns == df.columns
    ids = [i for i, _ in ODD]
    texts = [t for _, t in ODD]
    root = brute_groups(texts)
    want = {r: min((ids[k] for k in range(len(ids)) if root[k] == r and ids[k] is not None), default=None) for r in set(root)}
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted(want.values(), key=str)
    assert neardup.keep_first(df.limit(0), overlap=(4, 5)).count() == 0
