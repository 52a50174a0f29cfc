"""BPE encoding by backtracking over longest token matches, and decoding by an offset table.

An Aho-Corasick automaton finds the longest token at every position of a word. Tokens are taken from
the left; a token stays only if it is compatible with the one before, that is, if merging their
joined text would give just these two. Where none fits, the last token is given up for
its next shorter prefix. Every position is ruled out at most once, so a word takes linear time.

Most words need no step back: the automaton's longest matches, one after the other, are the answer if they cover
the word and every neighbouring pair is compatible, as only one such sequence exists.

The tokenizer file is read on the driver and sent to the tasks as a broadcast; it is
bounded by its vocabulary. Words and pieces are looked up in a bounded cache first.

Defined results: null texts are empty and have no tokens; other columns stay, an input column with
the name of a new one is replaced.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame

from tabsmith.llm.common import add_columns

#: Stands for the end of a word; it occurs in no mapped word.
END = "\x00"
#: Entries that a task's caches hold before they start afresh.
CACHED_WORDS, CACHED_PAIRS = 200_000, 200_000
#: Longer words are not cached.
CACHED_CHARS = 64
#: Fixed value: control characters that str.split() takes for white space and Unicode does not.
NOT_SPACE = regex.compile("[\x1c-\x1f]")


def byte_letters() -> list[str]:
    """The letter of each byte in byte-level vocabularies: printable bytes stand for themselves, others follow 255."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + others.index(b)) for b in range(256)]


#: Marks that are one piece at the end of a word of letters.
MARKS = ".,;:!?"


class Codec:
    """Encoder and decoder for a tokenizers JSON file of byte-level BPE with a word-end suffix."""

    def __init__(self, description: str):
        spec = json.loads(description)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        splits = [p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if (model["type"], kinds, len(splits), spec["decoder"]) != ("BPE", ["NFC", "Replace", "Lowercase"], 1, None) or not self.suffix:
            raise ValueError("only lower-case byte-level BPE with a word-end suffix and no decoder is supported")
        self.pieces = regex.compile(splits[0]).findall
        self.letters = dict(enumerate(byte_letters()))
        mark = lambda token: token[:-len(self.suffix)] + END if token.endswith(self.suffix) else token
        self.ids = {mark(t): i for t, i in model["vocab"].items()}
        self.rank: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.partners: dict[int, dict[int, int]] = {}
        for rank, (left, right) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            pair = self.ids[mark(left)], self.ids[mark(right)]
            whole = self.ids[mark(left + right)]
            self.partners.setdefault(pair[0], {}).setdefault(pair[1], rank)
            self.parts.setdefault(whole, pair)
            self.rank.setdefault(whole, rank)
        if any(self.rank.get(p, -1) >= rank for whole, rank in self.rank.items() for p in self.parts[whole]):
            raise ValueError("a merge comes before the merges of its parts")
        self.edges: tuple[dict, dict] = ({}, {})
        self.pairs: dict[int, bool] = {}
        never = self._never_made()
        self.ids = {t: i for t, i in self.ids.items() if i not in never}
        # a token is packed with its length: id | length << 20
        self.automaton = ahocorasick.Automaton()
        for token, i in self.ids.items():
            self.automaton.add_word(token, i | len(token) << 20)
        self.automaton.make_automaton()
        self.token = {i: t for t, i in self.ids.items()}
        self.shorter = {i: self._prefix(i) for i in self.token}
        names = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.special.items()}
        blob = [(names.get(i, "") + " ").encode() for i in range(max(names) + 1)]
        self.blob = np.frombuffer(b"".join(blob), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(b) for b in blob])])
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.digits = [str(i) for i in range(max(names) + 1)]
        #: words and pieces to their ids in decimal; a piece that stands alone is a word with the same ids
        self.known: dict[str, str] = {}

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The parts of a token at its left (0) or right (1) edge, each with the rank of the merge that ends it."""
        if token not in self.edges[side]:
            edge, part, ends = [], token, float("inf")
            while part in self.parts:
                edge.append((part, ends))
                ends, part = self.rank[part], self.parts[part][side]
            self.edges[side][token] = [*edge, (part, ends)]
        return self.edges[side][token]

    def _merged_over(self, left: int, right: int, but: tuple[int, int] | None = None) -> bool:
        """Whether merging both tokens' joined text merges over the border between them, other than by the pair `but`.

        Parts on either side of the border merge if that comes before both parts' own merges;
        of equal merges the leftmost comes first.
        """
        others = self._edge(right, 0)
        for a, a_ends in self._edge(left, 1):
            if partners := self.partners.get(a):
                for b, b_ends in others:
                    rank = partners.get(b)
                    if rank is not None and rank < a_ends and rank <= b_ends and (a, b) != but:
                        return True
        return False

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges of both tokens' joined text leave the border between them alone."""
        if len(self.pairs) >= CACHED_PAIRS:
            self.pairs.clear()
        found = self.pairs[left << 20 | right] = not self._merged_over(left, right)
        return found

    def _prefix(self, token: int) -> int:
        """The longest token that is a proper prefix of this one, packed; 0 if there is none."""
        text = self.token[token]
        return next((self.ids[text[:n]] | n << 20 for n in range(len(text) - 1, 0, -1) if text[:n] in self.ids), 0)

    def encode_piece(self, piece: str) -> list[int]:
        if piece.isascii() and piece.isprintable():  # these letters stand for themselves
            word = piece + END
        else:
            word = piece.encode().decode("latin-1").translate(self.letters) + END
        pairs, at, last, straight = self.pairs, 0, -1, []
        for end, found in self.automaton.iter_long(word):
            token = found & 0xFFFFF
            if end + 1 - (found >> 20) != at or last >= 0 and not ((ok := pairs.get(last << 20 | token)) or ok is None and self.compatible(last, token)):
                break
            straight.append(token)
            at, last = end + 1, token
        return straight if at == len(word) else self._stepping_back(piece, word)

    def _stepping_back(self, piece: str, word: str) -> list[int]:
        size = len(word)
        longest = [0] * size  # the longest token from each position, as it is packed in the automaton
        for end, found in self.automaton.iter(word):
            longest[end + 1 - (found >> 20)] = found  # a later match from the same start is longer
        pairs, at, out = self.pairs, 0, []
        dead: set[int] = set()
        found, last = longest[0], -1
        while at < size:
            while found:
                token = found & 0xFFFFF
                if at + (found >> 20) not in dead and (last < 0 or ((ok := pairs.get(last << 20 | token)) or ok is None and self.compatible(last, token))):
                    break
                found = self.shorter[token]
            if found:
                out.append(found)
                at += found >> 20
                last = token
                found = longest[at] if at < size else 0
            elif not out:
                raise ValueError(f"the vocabulary can't spell {piece!r}")
            else:
                dead.add(at)
                found = out.pop()
                at -= found >> 20
                last = out[-1] & 0xFFFFF if out else -1
                found = self.shorter[found & 0xFFFFF]
        return [f & 0xFFFFF for f in out]

    def _never_made(self) -> set[int]:
        """Tokens that no text gives, as merging their own text goes another way."""
        never: set[int] = set()
        for whole in sorted(self.rank, key=self.rank.get):
            left, right = self.parts[whole]
            if left in never or right in never or self._merged_over(left, right, but=(left, right)):
                never.add(whole)
        return never

    def _keep(self, word: str, ids: str) -> str:
        if len(word) <= CACHED_CHARS:
            if len(self.known) >= CACHED_WORDS:
                self.known.clear()
            self.known[word] = ids
        return ids

    def _piece(self, piece: str) -> str:
        return self._keep(piece, " ".join([self.digits[i] for i in self.encode_piece(piece)]))

    def _word(self, word: str) -> str:
        """The ids of a word that is not known yet."""
        if word.isalpha():  # one piece
            return self._piece(word)
        known = self.known.get
        core = word.rstrip(MARKS)
        pieces = (core, word[len(core):]) if core.isalpha() else self.pieces(word)
        return self._keep(word, " ".join([known(p) or self._piece(p) for p in pieces]))

    def _normal(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        # one letter at a time, as a sigma at a word's end is lower-cased like any other
        return "".join(map(str.lower, text)) if "Σ" in text else text.lower()

    def written(self, text: str | None) -> str:
        """The ids as decimal numbers joined by spaces."""
        text = text or ""
        parts = self.special_split.split(text) if self.special_split and any(s in text for s in self.special) else [text]
        found: list[str] = []
        known, miss = self.known.get, self._word
        for part in parts:
            if part in self.special:
                found.append(str(self.special[part]))
            else:
                normal = self._normal(part)
                words = regex.findall(r"[^\s]+", normal) if NOT_SPACE.search(normal) else normal.split()
                found += [known(w) or miss(w) for w in words]
        return " ".join(filter(None, found))

    def encode_with_text(self, text: str | None) -> tuple[np.ndarray, str]:
        """The ids, and the ids as decimal numbers joined by spaces."""
        written = self.written(text)
        return np.fromstring(written, np.int32, sep=" ") if written else np.zeros(0, np.int32), written

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_with_text(text)[0]

    def decode(self, ids) -> bytes:
        """The tokens' strings joined by spaces, in UTF-8."""
        ids = np.asarray(ids, np.int64)
        ids = ids[(ids >= 0) & (ids < len(self.offsets) - 1)]
        ids = ids[self.offsets[ids + 1] - self.offsets[ids] > 1]  # numbers without a token decode to nothing
        if not len(ids):
            return b""
        out = bytearray()
        for at in range(0, len(ids), 100_000):
            block = ids[at:at + 100_000]
            sizes = self.offsets[block + 1] - self.offsets[block]
            ends = np.cumsum(sizes)
            where = np.arange(ends[-1]) + np.repeat(self.offsets[block] - (ends - sizes), sizes)
            out += self.blob[where].tobytes()
        return bytes(out[:-1])


class _Shared:
    """One codec per worker process, made from the broadcast file on first use."""

    made: dict[int, Codec] = {}

    def __init__(self, spark, path: str):
        with open(path, encoding="utf-8") as f:
            self.text = spark.sparkContext.broadcast(f.read())
        self.key = hashlib.sha256(self.text.value.encode()).hexdigest()

    def get(self) -> Codec:
        if self.key not in _Shared.made:
            _Shared.made[self.key] = Codec(self.text.value)
        return _Shared.made[self.key]

    def release(self) -> None:
        """Empty the caches: a worker goes on to other work after a partition."""
        if codec := _Shared.made.get(self.key):
            codec.known.clear()
            codec.pairs.clear()


def encode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """`docs` with ids (array of int) and n_tokens."""
    shared = _Shared(docs.sparkSession, tokenizer_path)

    def run(texts):
        ids = [shared.get().encode(t) for t in texts]
        return {"ids": ids, "n_tokens": [len(i) for i in ids]}

    return add_columns(docs, ["text"], run, "ids array<int>, n_tokens long", shared.release)


def decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """`encoded` with decoded, the text of its column ids (null: empty)."""
    shared = _Shared(encoded.sparkSession, tokenizer_path)
    return add_columns(
        encoded, ["ids"], lambda many: {"decoded": [shared.get().decode(i or []).decode() for i in many]}, "decoded string")


def digests(docs: DataFrame, tokenizer_path: str, with_ids: bool = False) -> DataFrame:
    """`docs` with n_tokens, ids_sha256 and decoded_sha256, and ids if asked for; else ids and texts stay in the task."""
    shared = _Shared(docs.sparkSession, tokenizer_path)

    def run(texts):
        codec, out = shared.get(), {"n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": []}
        for text in texts:
            ids, written = codec.encode_with_text(text)
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(hashlib.sha256(written.encode()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(codec.decode(ids)).hexdigest())
            if with_ids:
                out["ids"].append(ids)
        return out

    return add_columns(docs, ["text"], run, "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids, shared.release)
