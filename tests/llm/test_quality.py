import re
from collections import Counter

import numpy as np
import pytest
from odd_rows import ODD

from tabsmith.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    hit = {i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), len(words) < 10 or 100 * len(hit) > 20 * len(words)


def test_repeat_words_equal_brute_force():
    rng = np.random.default_rng(2)
    for distinct in (1, 2, 5, 40, 10_000, 1 << 20):
        for _ in range(30):
            ids = rng.integers(0, distinct, int(rng.integers(0, 60)))
            ids = np.concatenate([ids, ids[: int(rng.integers(0, 20))]])
            text = " ".join(map(str, ids))
            assert quality.repeat_words(ids, distinct) == brute(text)[4]


def test_js_distance():
    p, q = np.array([[1.0, 0, 0]]), np.array([[0.0, 2, 0]])
    assert quality.js_distance(p, q)[0] == pytest.approx(1) and quality.js_distance(p, 5 * p)[0] == pytest.approx(0)
    assert quality.js_distance(0 * p, q)[0] == 0
    a, b = np.array([0.2, 0.3, 0.5]), np.array([0.4, 0.4, 0.2])
    m = (a + b) / 2
    want = np.sqrt(((a * np.log2(a / m)).sum() + (b * np.log2(b / m)).sum()) / 2)
    assert quality.js_distance(a, b) == pytest.approx(want)


def test_rules_tell_prose_from_junk(frame):
    rng = np.random.default_rng(8)
    common, rare = ["the", "of", "and", "to", "in", "that"], [f"w{chr(97 + a)}{chr(97 + b)}" for a in range(26) for b in range(26)]
    draw = lambda n: [str(rng.choice(common)) if rng.random() < 0.4 else str(rng.choice(rare)) for _ in range(n)]
    rows = [(i, " ".join(draw(120)) + ".") for i in range(200)]
    junk = [(1000, " ".join(f"{w}###" for w in draw(120))), (1001, " ".join(w.upper() + "!!" for w in draw(120))),
            (1002, " ".join(rng.choice(rare, 120).tolist())), (1003, "again and again it goes on " * 30)]
    got = {r["doc_id"]: r for r in quality.apply_rules(frame(rows + junk + [(2000, "a short text of ten words is not judged at all")])).collect()}
    assert all(got[i]["kept"] for i, _ in rows) and not any(got[i]["kept"] for i, _ in junk)
    assert got[2000]["kept"] and got[2000]["class_distance"] is None and got[2000]["word_distance"] is None
    for i, text in rows + junk:
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute(text)


def test_odd_rows(odd):
    got = quality.apply_rules(odd).collect()
    assert Counter((r["doc_id"], r["text"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
                   for r in got) == Counter((i, t, *brute(t)) for i, t in ODD)
    assert not any(r["kept"] for r in got if r["base_failed"])
    assert quality.apply_rules(odd.limit(0)).count() == 0


def test_small_languages_are_held_against_their_own_text(frame):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(9)

    def draw(first, n):
        words = ["".join(chr(first + int(k)) for k in rng.integers(0, 20, 5)) for _ in range(60)]
        return lambda: " ".join(rng.choice(words[:6] if rng.random() < 0.4 else words) for _ in range(n)) + "."

    latin, cyrillic, greek = draw(97, 2500), draw(0x430, 200), draw(0x3B1, 200)
    rows = [(i, latin()) for i in range(120)] + [(1000 + i, cyrillic()) for i in range(12)] + [(2000, greek())]
    junk = [(1100, " ".join(f"{w}###" for w in cyrillic().split()))]
    sizes = {k: sum(len(t) for i, t in rows if i // 1000 == k) for k in (0, 1, 2)}
    assert 10_000 <= sizes[1] < 0.01 * sum(sizes.values()) and sizes[2] < 10_000
    lang = F.when(F.col("doc_id") < 1000, "en").when(F.col("doc_id") < 2000, "ru").otherwise("el")
    got = {r["doc_id"]: r for r in quality.apply_rules(frame(rows + junk).withColumn("lang", lang)).collect()}
    # ru has references of its own, and they still tell junk; el has too little text for any
    assert all(got[i]["kept"] for i, _ in rows) and not got[1100]["kept"]
    assert all(got[1000 + i]["class_distance"] is not None and got[1000 + i]["word_distance"] is not None for i in range(12))
    assert got[2000]["class_distance"] is None and got[2000]["word_distance"] is None
