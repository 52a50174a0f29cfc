"""Benchmark decontamination with DataFrame operations only.

Every window of `n` consecutive words of a benchmark item is hashed; the set of distinct
windows is joined to the hashes of all windows of the documents, broadcast when its counted
size allows, and hits are verified word by word. A larger set is shuffled: a document's window then is a hash and a
position, and the words of the few documents that are hit are read once more to verify them.

Defined results: null and empty texts have no words; items without words are ignored, items
of fewer words are one window; a document's rows that share doc_id and text are judged alike;
other columns stay, an input column with the name of a new one is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabsmith.llm.common import ascii_lower, shielded, stage, text_or_empty

#: Fixed value: everything but letters, digits and characters beyond ASCII parts words.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Windows up to this many are broadcast (about 250 bytes each).
BROADCAST_WINDOWS = 200_000


#: The same for text that is not in lower case yet.
BETWEEN_ANY_WORDS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased words of a text, in order."""
    return F.array_remove(F.split(ascii_lower(text), BETWEEN_WORDS, -1), "")


def count_words(text: Column) -> Column:
    return F.size(F.array_remove(F.split(text, BETWEEN_ANY_WORDS, -1), "")).cast("long")


def _window_hash(tokens: str, start: Column, length: int) -> Column:
    return F.xxhash64(*[F.get(F.col(tokens), start + k) for k in range(length)])


def benchmark_windows(benchmark: DataFrame, n: int = 13) -> DataFrame:
    """One row per distinct window: its number of words, hash, words, and the items that have it."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words(text_or_empty()).alias("w"))
    items = items.filter(F.size("w") > 0)
    length = F.least(F.size("w"), F.lit(n))
    spans = items.select(
        "item", "w", length.alias("len"), F.explode(F.sequence(F.lit(0), F.size("w") - length)).alias("at"))
    windows = spans.select("item", "len", F.slice("w", F.col("at") + 1, F.col("len")).alias("win_words"))
    grouped = windows.groupBy("len", "win_words").agg(F.sort_array(F.collect_set("item")).alias("items"))
    by_length = F.lit(None).cast("long")
    for k in range(1, n + 1):
        by_length = F.when(F.col("len") == k, _window_hash("win_words", F.lit(0), k)).otherwise(by_length)
    return grouped.select("len", by_length.alias("hash"), "win_words", "items")


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, n: int = 13) -> DataFrame:
    """doc_id, body (xxhash64 of the text), start, len (in words), items: every verified window hit."""
    windows = stage(benchmark_windows(benchmark, n), "benchmark-windows")
    sizes = {r["len"]: r["count"] for r in windows.groupBy("len").count().collect()}  # at most n rows
    few = sum(sizes.values()) <= BROADCAST_WINDOWS
    found = windows.hint("broadcast") if few else windows
    found = found.select(F.col("len").alias("win_len"), F.col("hash").alias("win_hash"), "win_words", "items")
    tokens = docs.select(
        F.col("doc_id"), F.xxhash64(text_or_empty()).alias("body"), words(text_or_empty()).alias("w"))
    if not sizes:  # no benchmark item has words
        return tokens.select(
            "doc_id", "body", F.lit(0).alias("start"), F.lit(n).alias("len"), F.array(F.lit("")).alias("items")).filter(F.lit(False))
    # all lengths in one pass over the texts
    at = tokens.filter(F.size("w") > 0).select("doc_id", "body", "w", F.explode(F.sequence(F.lit(0), F.size("w") - 1)).alias("start"))
    if len(sizes) == 1:
        length = F.lit(next(iter(sizes)))
        at = at.withColumn("len", length).filter(F.col("start") + length <= F.size("w"))
    else:
        at = at.withColumn("len", F.explode(F.array(*map(F.lit, sorted(sizes))))).filter(F.col("start") + F.col("len") <= F.size("w"))
    hashed = F.lit(None).cast("long")
    for length in sorted(sizes):
        own = _window_hash("w", F.col("start"), length)
        hashed = own if len(sizes) == 1 else F.when(F.col("len") == length, own).otherwise(hashed)
    at = at.withColumn("win_hash", hashed)
    same = lambda start: F.slice("w", start + 1, F.size("win_words")) == F.col("win_words")
    if few:
        hits = at.join(found, (F.col("len") == F.col("win_len")) & (at["win_hash"] == found["win_hash"])).filter(same(F.col("start")))
        return hits.select("doc_id", "body", "start", "len", "items")
    hits = at.select("doc_id", "body", "start", "len", "win_hash").join(
        found, (F.col("len") == F.col("win_len")) & (at["win_hash"] == found["win_hash"])).select(
        F.col("doc_id").alias("hit_doc"), F.col("body").alias("hit_body"), "start", "len", "win_words", "items").distinct()
    # rows that share doc_id and text have one text; few columns on the left, and no text is sorted
    texts = tokens.join(
        hits.select("hit_doc", "hit_body").distinct().hint("shuffle_hash"),
        tokens["doc_id"].eqNullSafe(F.col("hit_doc")) & (tokens["body"] == F.col("hit_body")), "left_semi").dropDuplicates(["doc_id", "body"])
    checked = texts.hint("shuffle_hash").join(hits, texts["doc_id"].eqNullSafe(hits["hit_doc"]) & (texts["body"] == hits["hit_body"]))
    return checked.filter(same(F.col("start"))).select("doc_id", "body", "start", "len", "items")


def _with_verdict(docs: DataFrame, benchmark: DataFrame, n: int, share: int) -> DataFrame:
    """`docs` with a struct __verdict."""
    spans = contaminated_spans(docs, benchmark, n)
    per_doc = spans.groupBy("doc_id", "body").agg(
        F.sort_array(F.collect_set(F.struct("start", "len"))).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("hit_items"))
    # spans come by their start: each adds the words beyond the end so far
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["start"] + s["len"]).alias("end"),
            (acc["n"] + F.greatest(F.lit(0), s["start"] + s["len"] - F.greatest(acc["end"], s["start"]))).alias("n")),
        lambda acc: acc["n"])
    hit = per_doc.select(
        F.col("doc_id").alias("__doc"), F.col("body").alias("__hit_body"), covered.alias("__hit"), F.col("hit_items").alias("__items"))
    left = docs.withColumns({
        "__words": count_words(text_or_empty()), "__body": F.xxhash64(text_or_empty())})
    # few columns on the right; the texts need no sort this way
    joined = left.join(
        hit.hint("shuffle_hash"), left["doc_id"].eqNullSafe(hit["__doc"]) & (left["__body"] == hit["__hit_body"]), "left")
    n_hit = F.coalesce("__hit", F.lit(0).cast("long"))
    items = F.coalesce("__items", F.array().cast("array<string>"))
    return joined.select(*docs.columns, F.struct(
        F.col("__words").alias("n_words"), n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"), items.alias("hit_items"),
        ((n_hit > 0) & (n_hit * share >= F.col("__words"))).alias("contaminated")).alias("__verdict"))


@shielded
def judge(docs: DataFrame, benchmark: DataFrame, n: int = 13, share: int = 20) -> DataFrame:
    """`docs` with n_words, n_hit, n_items, hit_items (sorted) and contaminated.

    A word inside any occurrence of a window is hit; a document is contaminated when it
    has hits and at least one word in `share` is hit.
    """
    new = ["n_words", "n_hit", "n_items", "hit_items", "contaminated"]
    kept = [c for c in docs.columns if c.lower() not in new]
    return _with_verdict(docs, benchmark, n, share).select(*kept, "__verdict.*")


@shielded
def remove_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = 13, share: int = 20) -> DataFrame:
    """The documents that are not contaminated, with the columns of `docs`."""
    return _with_verdict(docs, benchmark, n, share).filter("not __verdict.contaminated").select(*docs.columns)
