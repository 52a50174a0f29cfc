import hashlib
import random

import pytest
from hypothesis import given, settings, strategies as st

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

from tabsmith.llm import bpe  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = tokenizers.Tokenizer.from_file(PATH)
with open(PATH, encoding="utf-8") as _f:
    CODEC = bpe.Codec(_f.read())


def same(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    ids, written = CODEC.encode_with_text(text)
    assert ids.tolist() == want == CODEC.encode(text).tolist()
    assert written == " ".join(map(str, want))
    assert CODEC.decode(ids).decode() == LIBRARY.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("text", [
    "", "  ", "Hello World's don't we'll", "x<|endoftext|>y<|startoftext|>", "ΑΣ ΟΔΟΣ. Σ", "İstanbul é ﬁ ½ ١٢ 漢字かな 👍🏽",
    "a b\x1cc\x85d​e", "a" * 50 + "!" * 40, "각 가", "supercalifragilistic " * 300])
def test_equals_the_library(text):
    same(text)


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(max_codepoint=0x4FF, exclude_categories=["Cn", "Cs"]), max_size=80))
def test_equals_the_library_on_any_text(text):
    same(text)


def test_equals_the_library_on_letter_runs():
    rng = random.Random(4)
    for _ in range(300):
        same("".join(rng.choice("abcdeinrst") for _ in range(rng.randint(1, 40))))


def test_table_matches(spark, odd, frame):
    rows = odd.count()
    got = bpe.digests(odd, PATH, with_ids=True).collect()
    assert len(got) == rows
    for r in bpe.decode(bpe.encode(odd, PATH), PATH).collect():
        want = LIBRARY.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == want and r["n_tokens"] == len(want)
        assert r["decoded"] == LIBRARY.decode(want, skip_special_tokens=False)
    for r in got:
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, r["ids"])).encode()).hexdigest()
    assert bpe.digests(odd.limit(0), PATH).count() == 0


def test_small_caches_change_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 3)
    monkeypatch.setattr(bpe, "CACHED_PAIRS", 3)
    with open(PATH, encoding="utf-8") as f:
        small = bpe.Codec(f.read())
    text = "many different words, and many words again, and again... " * 3
    assert small.encode(text).tolist() == CODEC.encode(text).tolist()
    assert len(small.known) <= 3 and len(small.pairs) <= 3


def test_the_straight_way_is_the_one_with_steps_back():
    rng = random.Random(9)
    stepped = 0
    for _ in range(3000):
        piece = "".join(rng.choice("aeinorstlhdu") for _ in range(rng.randint(1, 14)))
        want = CODEC._stepping_back(piece, piece + bpe.END)
        assert CODEC.encode_piece(piece) == want
        longest, at = [], 0
        for end, found in CODEC.automaton.iter_long(piece + bpe.END):
            longest.append(found & 0xFFFFF)
        stepped += longest != want
    assert stepped  # both ways were taken


@pytest.mark.parametrize("text", ["word, word. word; a:b c!? ... (x) don't, we'll. é, naïve! 漢字. 12, a1. x', '' ','", "ª, º. ǆ, ﬃ; ٣! ²,"])
def test_marks_at_the_end_of_words(text):
    same(text)
