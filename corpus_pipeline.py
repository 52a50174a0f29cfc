"""A training corpus from `documents`: toxic documents out, shared lines out, one of each group of near copies,
benchmark text out, tokens.

Each stage works on all that its predecessor kept; stages are joined by Parquet tables in
the shared folder. A document that loses every line stays, with an empty text; all such documents
are copies of each other, so the next stage keeps one of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.llm import bpe, decontaminate, linededup, neardup, toxicity
from tabsmith.llm.common import prepare, stage, table
from tabsmith.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a classifier learnt from the labels of these documents does not call toxic."""
    return toxicity.remove_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Long lines of three documents or more stay in the last one only; n_chars follows the text."""
    prepare(spark)
    kept = linededup.dedup_lines(docs)
    count = {"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return kept.withColumns(count).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near copies: fingerprints within 3 bits, or five-word
    shingles of which four fifths are shared."""
    prepare(spark)
    return neardup.keep_first(docs, overlap=(4, 5))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words less than one in twenty lies in a window of a benchmark item."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the digests of the ids and of the decoded text."""
    prepare(spark)
    return bpe.digests(docs.select("doc_id", "text"), tokenizer_path(), with_ids=True).drop("text")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_shared_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("bpe", tokenize),
]

#: XXH64 fingerprints, a fitted classifier and BPE are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
