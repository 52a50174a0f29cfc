import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from odd_rows import ODD

from tabsmith.llm import runs


def brute(words, least_words=24, least_periods=3):
    """All (start, length, smallest period), by comparing words at every distance."""
    n, found = len(words), {}
    for q in range(1, n // least_periods + 1):
        at = 0
        while at + q < n:
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end + q - at >= least_periods * q:
                found.setdefault((at, end + q), q)
            at = end + 1
    return sorted(((s, e - s, q) for (s, e), q in found.items() if e - s >= least_words), key=lambda r: (r[0], r[2]))


blocks = st.lists(st.integers(0, 3), min_size=1, max_size=40)
repeated = st.builds(lambda a, k, tail: a * k + tail, blocks, st.integers(1, 7), st.lists(st.integers(0, 3), max_size=20))
nested = st.builds(lambda a, k: a * k, repeated, st.integers(1, 5))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(repeated, nested), max_size=5), st.sampled_from([1, 24]))
def test_equals_brute_force(texts, least_words):
    assert runs.runs_of_texts(texts, least_words, 3) == [brute(t, least_words) for t in texts]


def test_every_scale_and_borders():
    rng = np.random.default_rng(3)
    texts = []
    for p in [1, 2, 3, 7, 8, 9, 15, 16, 17, 31, 33, 64, 100, 250]:
        # the last unit is a word short of, or just at, three periods
        unit = rng.integers(0, 1000, p).tolist()
        for length in (3 * p - 1, 3 * p, 3 * p + 1):
            texts.append([-1, *(unit * 4)[:length], -2])
        texts.append([0] * (3 * p) + [1] + [0] * (3 * p) + [1] + [0] * (3 * p) + [1])
    got = runs.runs_of_texts(texts, 1, 3)
    assert got == [brute(t, 1) for t in texts]
    assert got == [runs.runs_of_texts([t], 1, 3)[0] for t in texts]  # the batch changes nothing


def test_strings_with_many_squares():
    a, b = [0], [0, 1]
    while len(b) < 900:
        a, b = b, b + a
    morse = [bin(i).count("1") % 2 for i in range(512)]
    for text in (b * 2, morse * 3, (morse[:100] + [0] * 300 + [1]) * 3):
        assert runs.runs_of_texts([text], 1, 3) == [brute(text, 1)]


def test_a_colliding_hash_only_proposes(monkeypatch):
    monkeypatch.setattr(runs, "_mixed", lambda a, b: np.zeros(len(a), np.uint64))
    text = [k % 11 for k in range(100)] + list(range(60))
    assert runs.runs_of_texts([text], 24, 3) == [brute(text)]


def test_fewer_periods_are_refused(odd):
    with pytest.raises(ValueError):
        runs.find_runs(odd, least_periods=2)


def expected(text):
    words = (text or "").encode().split()
    found = brute(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return len(words), found, b" ".join(w for i, w in enumerate(words) if i not in gone).decode()


def test_odd_rows(frame):
    rows = [*ODD, (20, "a b\tc\n" * 30 + "end"), (20, "a b\tc\n" * 30 + "end"), (21, "x\x1cy z z " * 40), (22, "the " * 23), (23, "the " * 24),
            (24, " ".join(f"w{i % 3000}" for i in range(12_000)))]
    df = frame(rows).withColumnsRenamed({"lang": "runs", "lines": "in0", "fp": "n_words"})
    found = runs.find_runs(df)
    assert set(found.columns) == {"doc_id", "text", "in0", "runs", "n_words", "collapsed", "__x"}
    got = [(r["doc_id"], r["text"], r["in0"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in found.collect()]
    want = [(i, t, "l", *expected(t)) for i, t in rows]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert runs.find_runs(df.limit(0)).count() == 0
