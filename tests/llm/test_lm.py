import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tabsmith.llm import lm

SMALL = lm.Settings(word_classes=12, suffix_classes=5, table_words=30, size=8, noise=16, warm_tokens=1500, batch=256)


def _corpus():
    rng = np.random.default_rng(3)
    out = []
    for i in range(400):
        words = ["red", "green", "blue", "cyan"] if i % 2 else ["un", "deux", "trois", "quatre"]
        rest = [f"w{k}" for k in rng.integers(0, 60, 6)]
        out.append((i, " ".join(rng.choice(words, 25).tolist() + rest)))
    return out


def test_base_score_and_counts(frame):
    rows = _corpus() + [(1000, None), (1001, ""), (1003, "never seen Words"), (None, "red green")]
    vocabulary, model, counts = lm.train(frame(rows), SMALL)
    got = {(r["doc_id"], r["n_tokens"]): r for r in lm.score(frame(rows), vocabulary, model, counts).collect()}
    seen = Counter()
    for i, text in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 10:
            seen.update([*(text or "").lower().split(), None])
    total, kinds = sum(seen.values()), len(seen)
    assert len(got) == len(rows)
    for i, text in rows:
        tokens = [*(text or "").lower().split(), None]
        row = got[i, len(tokens)]
        want = sum(math.log10((seen[t] + 0.1) / (total + 0.1 * (kinds + 1))) for t in tokens)
        assert row["base_score"] == pytest.approx(want, rel=1e-9)
        assert (row["n_known"], row["train_tokens"]) == (sum(seen[t] > 0 for t in tokens), total)
        assert "text" not in row.asDict() and row["lines"] == "l"
    held = [got[i, 32] for i, _ in rows[:400] if zlib.crc32(str(i).encode()) % 10 == 0]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) + 0.05 * sum(r["n_tokens"] for r in held)


def test_probabilities_add_up_to_one(frame):
    vocabulary, model, counts = lm.train(frame(_corpus()), SMALL)
    s = SMALL
    before = np.array([0, 0, 0, 0, 3, 1], np.int16)
    seq = np.concatenate([np.concatenate([before, [c]]) for c in range(s.classes)]).astype(np.int16)
    at = np.arange(1, s.classes + 1) * 7 - 1
    by_class = 10 ** model.log10(seq, at, model.tables())
    assert by_class.sum() == pytest.approx(1, abs=1e-4)
    # within each class of several words, the words and one unseen word add up to one
    words = {bytes(r["word"]): r["n"] for r in counts.collect()}
    parts = Counter()
    for w, n in words.items():
        if vocabulary.number.get(w, s.word_classes) >= s.word_classes:
            parts[s.word_classes + vocabulary.suffix(w)] += 10 ** (math.log10(n + 0.1) - vocabulary.class_norm[s.word_classes + vocabulary.suffix(w)])
    for c, p in parts.items():
        assert p + 10 ** (-1 - vocabulary.class_norm[c]) == pytest.approx(1, abs=1e-9)


def test_scatter_adds_rows():
    rng = np.random.default_rng(5)
    rows, values = rng.integers(0, 7, 100), rng.standard_normal((100, 3))
    got, want = np.zeros((7, 3)), np.zeros((7, 3))
    lm._scatter(got, rows, values)
    np.add.at(want, rows, values)
    assert np.allclose(got, want)


def test_odd_and_empty(odd):
    vocabulary, model, counts = lm.train(odd, SMALL)
    rows = lm.score(odd, vocabulary, model, counts).collect()
    assert len(rows) == odd.count() and all(math.isfinite(r["score"]) for r in rows)
    vocabulary, model, counts = lm.train(odd.limit(0), SMALL)
    rows = lm.score(odd, vocabulary, model, counts).collect()
    assert {(r["train_tokens"], r["n_known"]) for r in rows} == {(0, 0)} and all(r["base_score"] == 0 for r in rows)
    assert lm.score(odd.limit(0), vocabulary, model, counts).count() == 0


def _vocabulary(rows, s):
    words = Counter(w for _, text in rows for w in lm.words_of(text))
    top = sorted(words)
    totals = {}
    for w, n in [(lm.END, len(rows)), *words.items()]:
        kind = zlib.crc32(w[-2:]) % s.suffix_classes
        totals[kind] = (totals.get(kind, (0, 0))[0] + n, totals.get(kind, (0, 0))[1] + 1)
    tokens = sum(words.values()) + len(rows)
    return lm.Vocabulary([lm.END, *top], [len(rows), *[words[w] for w in top]], totals, tokens, len(words) + 1, s)


def test_production_settings_train_on_every_position():
    rows = _corpus()
    s = lm.Settings()
    vocabulary = _vocabulary(rows, s)
    encoded = [vocabulary.classes(w := lm.words_of(t), vocabulary.numbers(w)).astype(np.int16).tobytes() for _, t in rows]
    chunks = lm._chunks([(encoded[:100],), (encoded[100:],)], s.context, 1_000)
    assert lm.LogBilinear(s, vocabulary.noise).fit(chunks, seed=0) == vocabulary.tokens


@pytest.mark.parametrize("warm", [0, 1500, 10**9])
def test_every_training_position_is_learnt_once(frame, monkeypatch, warm):
    rows = _corpus()
    df = frame(rows)
    settings = lm.Settings(**{**vars(SMALL), "warm_tokens": warm})
    counts = lm.count_training_words(df, settings)
    vocabulary = lm.build_vocabulary(counts, settings)
    encoded, names = lm.encode(df, vocabulary)
    seen = []
    plain = lm.map_rows

    def watched(*args):
        out = plain(*args)
        seen.append(out.agg({"tokens": "sum"}).first()[0] or 0)
        return out

    monkeypatch.setattr(lm, "map_rows", watched)
    lm.fit(encoded, names, vocabulary)
    assert sum(seen) == vocabulary.tokens and seen[0] <= 0.7 * vocabulary.tokens


def test_score_equals_a_token_by_token_computation(frame):
    rows = _corpus()[:60] + [(2000, "red never seen 漢字"), (2001, None)]
    vocabulary, model, counts = lm.train(frame(_corpus()), SMALL)
    seen = {bytes(r["word"]): r["n"] for r in counts.collect()}
    got = {r["doc_id"]: r["score"] for r in lm.score(frame(rows), vocabulary, model, counts).collect()}
    r, c, q, b = (p.astype(float) for p in model.parameters())
    for doc, text in rows:
        tokens = [*(text or "").lower().encode().split(), lm.END]
        classes = [0] * SMALL.context
        total = 0.0
        for t in tokens:
            rank = vocabulary.number.get(t, SMALL.word_classes)
            k = rank if rank < SMALL.word_classes else SMALL.word_classes + vocabulary.suffix(t)
            guess = sum(r[classes[-1 - p]] @ c[p] for p in range(SMALL.context))
            scores = q @ guess + b
            total += (scores[k] - np.log(np.exp(scores - scores.max()).sum()) - scores.max()) / math.log(10)
            if k >= SMALL.word_classes:
                total += math.log10(seen.get(t, 0) + 0.1) - vocabulary.class_norm[k]
            classes.append(k)
        assert got[doc] == pytest.approx(total, abs=1e-3)
    far = lm.LogBilinear(SMALL, vocabulary.noise)
    far.q *= 10_000  # scores far beyond what an exponent bears
    seq = np.array([0, 0, 0, 0, 3, 1, 2], np.int16)
    assert np.isfinite(far.log10(seq, np.arange(4, 7), far.tables())).all()
