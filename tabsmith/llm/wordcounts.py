"""Counts of words over whole corpora, combined in the task before they are shuffled."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.llm.common import map_rows

#: Distinct words that a task counts before it hands its counts on.
HELD_WORDS = 300_000


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, with A-Z in lower case, in UTF-8."""
    return (text or "").encode().lower().split()


def count_words(docs: DataFrame, group: str, extra=()) -> DataFrame:
    """(grp, word, n) over every text; `group` is a string column, null groups count as one.

    `extra` words are counted once per text besides.
    """
    extra = list(extra)

    def run(batches):
        held: dict[str | None, Counter] = {}

        def flush():
            for grp, counter in held.items():
                words = list(counter)
                for at in range(0, len(words), 50_000):
                    part = words[at:at + 50_000]
                    yield {"grp": [grp] * len(part), "word": part, "n": [counter[w] for w in part]}
            held.clear()

        for texts, groups in batches:
            for text, grp in zip(texts, groups):
                if (counter := held.get(grp)) is None:
                    counter = held[grp] = Counter()
                counter.update(words_of(text))
                counter.update(extra)
                if len(counter) > HELD_WORDS:
                    yield from flush()
            if sum(map(len, held.values())) > HELD_WORDS:
                yield from flush()
        yield from flush()

    counted = map_rows(docs, ["text", group], run, "grp string, word binary, n long")
    return counted.groupBy("grp", "word").agg(F.sum("n").alias("n"))
