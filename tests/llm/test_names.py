"""Columns of users that have an operator's internal names come through unchanged."""

import pytest
from pyspark.sql import functions as F

from tabsmith.llm import bpe, chat, linededup, lm, neardup, quality, runs, secrets, sharding, toxicity

NAMES = [
    "__kinds", "__text", "__doc", "__nodoc", "__body", "__low", "__fp", "__component", "__nth", "__at", "__part", "__cell", "__base", "__cuts",
    "__arc", "__a", "__p", "__begin", "__of", "__lo", "__hi", "__shard", "__slot0", "__in0", "__row", "__rare", "in0", "in1", "row", "key",
    "classes", "rare", "learnt", "found", "m_doc", "m_body", "m_keep", "kept__doc", "__id", "__lang", "hi", "lo", "pos"]
TEXTS = ["one two three four", "one two three four", "password = abcdefghijkl12345", None, "a line of some length\nother " * 3]


@pytest.fixture
def named(frame):
    df = frame(list(enumerate(TEXTS))).drop("lines", "fp", "__x")
    return df.select("*", *[F.lit(f"mine {n}").alias(n) for n in NAMES])


def _lm(df):
    settings = lm.Settings(word_classes=4, suffix_classes=3, table_words=5, size=4, noise=4, warm_tokens=10, batch=8)
    return lm.train_and_score(df, settings)


def _toxic(df):
    labels = df.select("doc_id", (F.col("doc_id") == 2).cast("int").alias("toxic"))
    model = toxicity.train(df, labels)
    return toxicity.score(df, model), toxicity.remove_toxic(df, model)


OPERATORS = {
    "sharding": lambda df: sharding.assign(df, "doc_id", 3, ties=["__at"]),
    "lm": _lm,
    "bpe": lambda df: bpe.digests(df, pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")),
    "toxicity": _toxic,
    "linededup": linededup.dedup_lines,
    "quality": quality.apply_rules,
    "secrets": secrets.scan,
    "neardup": lambda df: (neardup.near_duplicates(df), neardup.keep_first(df)),
    "runs": runs.find_runs,
    "chat": lambda df: chat.canonical(df.withColumn("record", F.struct(F.col("text").alias("prompt"), F.lit("x").alias("completion")))),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_columns_survive(named, name):
    made = OPERATORS[name](named)
    for out in made if isinstance(made, tuple) else (made,):
        assert set(NAMES) <= set(out.columns) and len(set(out.columns)) == len(out.columns)
        rows = out.collect()
        assert rows and all(r[n] == f"mine {n}" for r in rows for n in NAMES)
