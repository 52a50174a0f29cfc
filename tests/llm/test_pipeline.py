import hashlib

import pytest
import test_bpe
import test_decontaminate
import test_linededup
import test_shingles

import corpus_pipeline
from tabsmith.llm import toxicity
from tabsmith.llm.common import prepare


def test_run_equals_brute_force_stages(spark, sf_dir):
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect() if model.score(r["text"]) < 0.5]
    rows = [(i, text) for i, text, _, _ in test_linededup.brute(rows)]
    root = test_shingles.brute_groups([t for _, t in rows])
    first = {}
    for (i, _), r in zip(rows, root):
        first[r] = min(first.get(r, i), i)
    rows = [(i, t) for i, t in rows if i in set(first.values())]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    rows = [r[:2] for r in test_decontaminate.brute(rows, items) if not r[-1]]
    want = {i: test_bpe.LIBRARY.encode(t, add_special_tokens=False).ids for i, t in rows}
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert set(got) == set(want)
    for i, r in got.items():
        assert r["ids"] == want[i] and r["ids_sha256"] == hashlib.sha256(" ".join(map(str, want[i])).encode()).hexdigest()


@pytest.mark.parametrize("n", [0, 1])
def test_small_tables(spark, sf_dir, n):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(n)
    for _, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, sf_dir)
        assert out.columns == docs.columns
        docs = out
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() <= n


def test_stages_keep_types_and_follow_the_text(spark, sf_dir, odd):
    from pyspark.sql import functions as F

    docs = odd.withColumns({"source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    for _, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, sf_dir)
    rows = docs.collect()
    assert dict(docs.dtypes)["n_chars"] == "bigint"
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in rows)
