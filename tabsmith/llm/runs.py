"""Periodic runs of words: passages that repeat themselves at least three times in a row.

String synchronising sets find them. At scale t (4, 8, 16, ...) the hash of every stretch of t words
selects positions: i is selected when the smallest hash among the stretches that begin at i..i+t belongs
to the first or to the last of them. Whether i is selected depends on the 2t words from i only, so
inside a run of period p selected positions come back p words later with the same context. Every
pair of selected positions with equal contexts and 2t <= p < 4t words between them proposes p, and the
proposal is extended word by word as far as it holds. Stretches with a period of at most t/3 are left out of
the selection, as they would select everywhere; periods below 8 are found separately by comparing words
that are so far apart, and larger ones at the scales before.

Why none is missed: if nothing is selected in t consecutive positions, the 3t-1 words from the first have a
period of at most t/3. A run of period p >= 2t has p+1 possible positions or more; were none of
them selected, all p+2t-1 words would have a period of at most t/3, and then p were not the smallest. Hashes only
select and propose; words decide.

Documents are taken in batches, joined by words that occur once; at scale t only texts of 6t words
or more are looked at. A task holds one batch; nothing is shuffled.

Defined results: null and empty texts have no words and no runs; repeated rows are judged alike, each for
itself; other columns stay, an input column with the name of a new one is replaced.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from itertools import count

import numpy as np
from pyspark.sql import DataFrame

from tabsmith.llm.common import add_columns

#: Periods below this are found by comparing words; it is twice the smallest scale.
SMALL = 8
#: Words of a batch, unless a single text has more.
BATCH_WORDS = 250_000
_LEFT_OUT = np.uint64(2**64 - 1)
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, in UTF-8."""
    return (text or "").encode().split()


def _mixed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    x = first * _FACTORS[0] + (second ^ (second >> np.uint64(29))) * _FACTORS[1]
    x ^= x >> np.uint64(32)
    x *= _FACTORS[2]
    return x


def _stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the stretches of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], equal, [False]]).view(np.int8)))
    return edges[::2], edges[1::2]


def _selected(hashes: np.ndarray, scale: int, periodic: list[tuple[int, int]]) -> np.ndarray:
    """The synchronising positions among 0..n-2*scale; `hashes` are those of all stretches of `scale` words."""
    ids = hashes >> np.uint64(1)  # never the mark of those left out
    for start, end in periodic:
        ids[start:max(start, end - scale + 1)] = _LEFT_OUT
    least, width = ids, 1
    while width < scale:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:-1], ids[scale:])
    picked = (least == ids[:-scale]) | (least == ids[scale:])
    return np.flatnonzero(picked & (least != _LEFT_OUT))


def _proposals(at: np.ndarray, contexts: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(period, position) of all pairs of equal contexts that are 2 to under 4 scales apart, in order."""
    periods, starts = [], []
    for lag in range(1, len(at)):
        apart = at[lag:] - at[:-lag]
        if apart.min() >= 4 * scale:
            break
        same = np.flatnonzero(contexts[lag:] == contexts[:-lag])
        same = same[(apart[same] >= 2 * scale) & (apart[same] < 4 * scale)]
        periods.append(apart[same])
        starts.append(at[same])
    if not periods:
        return at[:0], at[:0]
    period, start = np.concatenate(periods), np.concatenate(starts)
    order = np.lexsort((start, period))
    return period[order], start[order]


def _extended(words: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The longest stretch around `at` in which words `period` apart are equal."""
    end, step = at, 64
    while end + period < len(words):
        size = min(step, len(words) - period - end)
        unequal = words[end:end + size] != words[end + period:end + period + size]
        first = int(unequal.argmax())
        if unequal[first]:
            end += first
            break
        end += size
        step *= 2
    start, step = at, 64
    while start:
        size = min(step, start)
        unequal = words[start - size:start] != words[start - size + period:start + period]
        if unequal.any():
            start -= int(unequal[::-1].argmax())
            break
        start -= size
        step *= 2
    return start, end + period


def find(words: np.ndarray, usable=None) -> dict[tuple[int, int], int]:
    """{(start, end): smallest period} of all maximal stretches of three periods or more.

    `usable(n)` tells how many of the first words belong to texts of at least n words; the
    texts then have to be sorted by length, longest first, and parted by words that occur once.
    """
    found: dict[tuple[int, int], int] = {}
    for period in range(1, min(SMALL, len(words))):
        begins, ends = _stretches(words[period:] == words[:-period])
        long = ends - begins >= 2 * period
        for start, end in zip(begins[long].tolist(), ends[long].tolist()):
            found.setdefault((start, end + period), period)  # a multiple of the period has the same stretch
    hashes = _mixed(words.astype(np.uint64), np.arange(1, dtype=np.uint64))
    width, scale = 1, SMALL // 2
    while True:
        size = usable(6 * scale) if usable else len(words) * (len(words) >= 6 * scale)
        if not size:
            return found
        words, hashes = words[:size], hashes[:size - width + 1]
        while width < 2 * scale:
            if width == scale:
                own = hashes
            hashes = _mixed(hashes[:-width], hashes[width:])
            width *= 2
        periodic = [(s, e) for (s, e), p in found.items() if 3 * p <= scale <= e - s and e <= size]
        at = _selected(own, scale, periodic)
        period, start = _proposals(at, hashes[at], scale)
        k = 0
        while k < len(period):
            p = int(period[k])
            begin, end = _extended(words, int(start[k]), p)
            if end - begin >= 3 * p:
                found.setdefault((begin, end), p)
            # all further pairs with this period inside the stretch propose the same one
            beyond = np.searchsorted(period, p, "right")
            k += max(1, int(np.searchsorted(start[k:beyond], end - p, "left")))
        scale *= 2


def runs_of_texts(texts: Sequence[Sequence], least_words: int, least_periods: int) -> list[list[tuple[int, int, int]]]:
    """For each list of words its runs (start, length, period), by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    order = sorted((k for k in range(len(texts)) if len(texts[k]) >= least_periods), key=lambda k: -len(texts[k]))
    numbers: dict = defaultdict(count().__next__)
    parts, offsets, lengths, at = [], [], [], 0
    for k in order:
        n = len(texts[k])
        parts += [np.fromiter(map(numbers.__getitem__, texts[k]), np.int64, n), np.array([-1 - at])]
        offsets.append(at)
        lengths.append(n)
        at += n + 1
    if not order:
        return out

    def usable(least: int) -> int:
        texts_left = int(np.searchsorted(-np.array(lengths), -least, "right"))
        return offsets[texts_left - 1] + lengths[texts_left - 1] if texts_left else 0

    for (start, end), period in find(np.concatenate(parts), usable).items():
        if end - start >= max(least_words, least_periods * period):
            which = int(np.searchsorted(offsets, start, "right")) - 1
            out[order[which]].append((start - offsets[which], end - start, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def kept_words(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that a run holds after its first period."""
    stay = np.ones(len(words), bool)
    for start, length, period in runs:
        stay[start + period:start + length] = False
    return [w for w, s in zip(words, stay.tolist()) if s]


def _batches(texts: list[list]) -> list[slice]:
    cuts, held = [0], 0
    for k, words in enumerate(texts):
        if held and held + len(words) > BATCH_WORDS:
            cuts.append(k)
            held = 0
        held += len(words)
    return [slice(a, b) for a, b in zip(cuts, [*cuts[1:], len(texts)])]


def find_runs(docs: DataFrame, least_words: int = 24, least_periods: int = 3) -> DataFrame:
    """`docs` with n_words, runs (array of start, length, period in words; by start, then period) and collapsed.

    A run is a stretch of words with smallest period q and a length of at least `least_words` and
    `least_periods` * q that no neighbouring word extends. `collapsed` is the text without the words that a run holds after its
    first q, joined by single spaces.
    """
    if least_periods < 3:
        raise ValueError("runs of fewer than three periods may be missed")

    def run(texts):
        words = [words_of(t) for t in texts]
        found = [r for part in _batches(words) for r in runs_of_texts(words[part], least_words, least_periods)]
        return {
            "n_words": [len(w) for w in words],
            "runs": [[dict(zip(("start", "length", "period"), r)) for r in runs] for runs in found],
            "collapsed": [b" ".join(kept_words(w, r) if r else w).decode() for w, r in zip(words, found)],
        }

    return add_columns(
        docs, ["text"], run,
        "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
