"""Phrase collocations: word sequences that stand together more often than their parts would by chance.

The counts are laid out as for external language-model estimation: for every length a stream of phrases with
their counts, where a phrase of n words is the pair (its first n-1 words, its last n-1 words), each by its
number in the stream one shorter. Sorted by the first it is in prefix order, by the last in suffix order. Sort-merge
joins run a stream in lockstep with the shorter one: in prefix order a phrase meets the counts of all its
beginnings and a beginning its right extensions, in suffix order the same for endings and left extensions. No
phrase is looked up in a hash table.

Only phrases found `least` times are reported, and so are all their parts; a phrase of n words is therefore counted only
where both its parts of n-1 words are that frequent, which drops none. Texts are split once into chunks, arrays of word
numbers in the shared folder, with the numbers of a chunk's own words. Each length is one round: counts per chunk are
shuffled by phrase, in compressed buckets whose number grows with the corpus, and the frequent ones go back to the chunks that hold
them. A chunk is bounded by its words unless a single text has more; a word or phrase meets at most one row per chunk.

Defined results: a null text has no words; a null language is `und`; rows that share a doc_id are counted
each; an empty table gives no phrases. Input columns other than text and lang are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabsmith.llm.common import map_rows, stage

#: Words of one language that a chunk holds before it is closed, and words that a task holds of all languages.
CHUNK_WORDS, HELD_WORDS = 500_000, 1_000_000
#: Pairs of a bucket, about: they are added up in one task.
BUCKET_PAIRS = 2_000_000
#: Parts of a language whose phrases are ranked apart before the rank over the language.
RANK_PARTS = 64
#: What parts pieces, and the byte that stands for it, which UTF-8 text never has.
PARTING, PARTED = b".,;:!?\n\x0b\x0c\r", b"\xff"
_MARKED = bytes.maketrans(b"\t" + PARTING, b" " + PARTED * len(PARTING))
NO_LANGUAGE = "und"


def packed(numbers: np.ndarray) -> bytes:
    """32-bit numbers byte by byte, lowest bytes first, so that small numbers compress well."""
    return np.ascontiguousarray(numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes()


def unpacked(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).reshape(-1).view("<i4")


def marked_words(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case, and PARTED between pieces and at the end."""
    return ((text or "").encode().lower().translate(_MARKED) + PARTED).replace(PARTED, b" " + PARTED + b" ").split()


class _Held:
    """The words of one language that wait for their chunk to be closed."""

    def __init__(self):
        self.numbers: dict[bytes, int] = defaultdict(count().__next__)
        self.parts: list[np.ndarray] = []
        self.size = self.numbers[PARTED]  # the mark is number 0

    def add(self, text: str | None) -> int:
        words = marked_words(text)
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self.size += len(words)
        return len(words)

    def closed(self, lang: str) -> dict:
        tokens = np.concatenate(self.parts)
        counts = np.bincount(tokens, minlength=len(self.numbers))
        return {
            "lang": [lang], "held": [np.packbits(np.ones(len(tokens), bool)).tobytes()], "which": [packed(tokens)],
            "words": [list(self.numbers)[1:]], "counts": [counts[1:]]}


def _close_chunks(texts_and_langs: Iterator) -> Iterator[dict]:
    open_chunks: dict[str, _Held] = {}
    total = 0
    for texts, langs in texts_and_langs:
        for text, lang in zip(texts, langs):
            if (chunk := open_chunks.get(lang)) is None:
                chunk = open_chunks[lang] = _Held()
            total += chunk.add(text)
            if chunk.size >= CHUNK_WORDS:
                total -= chunk.size
                yield open_chunks.pop(lang).closed(lang)
            elif total >= HELD_WORDS:
                while open_chunks:
                    lang, chunk = open_chunks.popitem()
                    yield chunk.closed(lang)
                total = 0
    for lang, chunk in open_chunks.items():
        yield chunk.closed(lang)


def _squeezed(*columns: np.ndarray) -> bytes:
    """Whole numbers, column by column and byte by byte, compressed."""
    planes = [np.ascontiguousarray(c.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes() for c in columns]
    return pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def _spread(blob: bytes, rows: int, columns: int) -> list[np.ndarray]:
    planes = np.frombuffer(pa.decompress(blob, rows * columns * 8, codec="zstd"), np.uint8).reshape(columns, 8, rows)
    return [np.ascontiguousarray(p.T).reshape(-1).view("<i8") for p in planes]


def _next_length(buckets: int):
    """Chunks, with the numbers of the frequent phrases among theirs, to the neighbouring pairs of these, dealt to buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {n: batch.column(n) for n in batch.schema.names}
            for row in range(batch.num_rows):
                which = unpacked(column["which"][row].as_py())
                held = np.unpackbits(np.frombuffer(column["held"][row].as_py(), np.uint8)).view(bool)
                at = np.flatnonzero(held)[:len(which)]
                places = column["places"][row].values.to_numpy()
                numbers = column["numbers"][row].values.to_numpy()
                local = np.full(max(int(which.max(initial=-1)), int(places.max(initial=-1))) + 1, -1, np.int64)
                local[places] = np.arange(len(places))
                found = local[which]
                at, found = at[found >= 0], found[found >= 0]
                beside = np.flatnonzero(np.diff(at) == 1)
                pairs, which, counts = np.unique(
                    found[beside] << 32 | found[beside + 1], return_inverse=True, return_counts=True)
                held = np.zeros(len(held), bool)
                held[at[beside]] = True
                lefts, rights = numbers[pairs >> 32], numbers[pairs & 0xFFFFFFFF]
                mixed = lefts.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + rights.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
                bucket = ((mixed ^ mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                ends = np.cumsum(np.bincount(bucket, minlength=buckets))
                dealt = []
                for b, (start, end) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist())):
                    if end > start:
                        own = order[start:end]
                        dealt.append({"bucket": b, "rows": end - start, "blob": _squeezed(
                            np.diff(own, prepend=0), np.diff(lefts[own], prepend=0), rights[own], counts[own])})
                yield pa.RecordBatch.from_arrays([
                    pa.array([column["chunk"][row].as_py()], pa.int64()), pa.array([np.packbits(held).tobytes()]), pa.array([packed(which)]),
                    pa.array([dealt], pa.list_(pa.struct([("bucket", pa.int32()), ("rows", pa.int32()), ("blob", pa.binary())])))],
                    names=["chunk", "held", "which", "dealt"])

    return run


_CHUNK = "chunk long, held binary, which binary, dealt array<struct<bucket: int, rows: int, blob: binary>>"


def _add_up(least: int):
    """All pairs of a bucket: those found `least` times in all, and where the chunks have them."""

    def run(table: pa.Table) -> pa.Table:
        chunks, sizes = table.column("chunk").to_numpy(), table.column("rows").to_numpy()
        parts = [_spread(blob.as_py(), n, 4) for blob, n in zip(table.column("blob"), sizes.tolist())]
        place, left = (np.concatenate([np.cumsum(p[i]) for p in parts]) for i in (0, 1))
        right, n = (np.concatenate([p[i] for p in parts]) for i in (2, 3))
        order = np.lexsort((right, left))
        left, right = left[order], right[order]
        begins = np.flatnonzero(np.append(True, (left[1:] != left[:-1]) | (right[1:] != right[:-1])))
        total = np.add.reduceat(n[order], begins)
        frequent = total >= least
        # numbers are unique, as a pair is in one bucket only
        ids = (int(table.column("bucket")[0].as_py()) << 32) + np.cumsum(frequent) - 1
        of_row = np.empty(len(order), np.int64)
        of_row[order] = np.repeat(np.where(frequent, ids, -1), np.diff(np.append(begins, len(order))))
        out = {name: [] for name in ("chunk", "places", "numbers", "id", "left", "right", "f")}
        at = 0
        for chunk, size in zip(chunks.tolist(), sizes.tolist()):
            mine = np.flatnonzero(of_row[at:at + size] >= 0)
            if len(mine):
                for name, value in (("chunk", chunk), ("places", place[at + mine]), ("numbers", of_row[at + mine]),
                                    ("id", None), ("left", None), ("right", None), ("f", None)):
                    out[name].append(value)
            at += size
        where = begins[frequent]
        count_of = len(where)
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), *[pa.int64()] * 4]
        rows = pa.table([pa.array(v, k) for v, k in zip(out.values(), kinds)], names=list(out))
        phrases = pa.table([
            pa.nulls(count_of, kinds[0]), pa.nulls(count_of, kinds[1]), pa.nulls(count_of, kinds[2]), pa.array(ids[frequent]),
            pa.array(left[where]), pa.array(right[where]), pa.array(total[frequent])], names=list(out))
        return pa.concat_tables([rows, phrases])

    return run


_HITS = "chunk long, places array<long>, numbers array<long>, id long, left long, right long, f long"


def chunks_of(docs: DataFrame) -> DataFrame:
    """The texts as chunks: chunk, lang, held, which (packed word numbers; 0 parts pieces), words and their counts."""
    source = docs.select(F.col("text").cast("string").alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"))
    closed = map_rows(
        source, ["text", "lang"], _close_chunks, "lang string, held binary, which binary, words array<binary>, counts array<long>")
    return stage(closed.withColumn("chunk", F.monotonically_increasing_id()), "phrase-chunks")


def _frequent_words(words: DataFrame, least: int) -> DataFrame:
    """The rows (chunk, place) of words found `least` times in all, with their number id, and one row each with lang, word and the count f."""
    key = ["lang", "word"]
    together = Window.partitionBy(*key)
    found = words.withColumn("f", F.sum("n").over(together)).filter(F.col("f") >= least)
    # the same partitions serve both windows
    numbered = found.withColumn("row", F.monotonically_increasing_id()).withColumn("id", F.min("row").over(together))
    is_first = F.col("row") == F.col("id")
    return stage(numbered.select(
        "chunk", "place", "id", is_first.alias("is_first"), *[F.when(is_first, F.col(c)).alias(c) for c in (*key, "f")]), "phrase-words")


def _next_chunks(chunks: DataFrame, fed: DataFrame, shorter: DataFrame, name: str) -> DataFrame:
    # there are no more pairs than places of shorter phrases; a bucket has a bounded share of them
    buckets = (shorter.agg(F.sum("f").alias("n")).first()["n"] or 0) // BUCKET_PAIRS + 1
    return stage(chunks.select("chunk", "held", "which").join(fed, "chunk").mapInArrow(_next_length(buckets), _CHUNK), name)


def count_phrases(docs: DataFrame, least: int = 100, longest: int = 5) -> tuple[DataFrame, list[DataFrame]]:
    """(lang, n words) and, for each length from 1, the frequent phrases.

    Words are (id, lang, word, f), longer phrases (id, left, right, f) where left and right are the ids of all words but the last
    and all but the first. ids are unique within a length.
    """
    chunks = chunks_of(docs)
    totals = chunks.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, c: a + c)).alias("n"))
    words = chunks.select("chunk", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "of"))
    words = words.select("chunk", (F.col("place") + 1).alias("place"), "lang", F.col("of.words").alias("word"), F.col("of.counts").alias("n"))
    hits = _frequent_words(words, least)
    lengths = [hits.filter("is_first").select("id", "lang", F.col("word").cast("string").alias("word"), "f")]
    fed = hits.groupBy("chunk").agg(F.collect_list(F.struct("place", "id")).alias("fed"))
    fed = fed.select("chunk", F.col("fed.place").alias("places"), F.col("fed.id").alias("numbers"))
    for n in range(2, longest + 1):
        chunks = _next_chunks(chunks, fed, lengths[-1], f"phrase-chunks-{n}")
        dealt = chunks.select("chunk", F.inline("dealt"))
        hits = stage(dealt.groupBy("bucket").applyInArrow(_add_up(least), _HITS), f"phrase-pairs-{n}")
        fed = hits.filter("chunk is not null").groupBy("chunk").agg(F.collect_list(F.struct("places", "numbers")).alias("fed"))
        fed = fed.select("chunk", F.flatten("fed.places").alias("places"), F.flatten("fed.numbers").alias("numbers"))
        lengths.append(hits.filter("chunk is null").select("id", "left", "right", "f"))
    return totals, lengths


def weakest_cut(n: Column, left: Column, right: Column, parts: int) -> Column:
    """(score, k, l, r) of the cut with the lowest score, the first of equal ones.

    `left` and `right` hold the counts of the beginnings and endings of 1, 2, ... words; the last
    of each is the phrase's own. The score of a cut is floor(1000 * a * n / (l * r)), in whole numbers.
    """
    own = F.get(left, F.lit(parts - 1))
    whole = lambda c: c.cast("decimal(38,0)")  # noqa: E731 - the products pass 64 bits

    def cut(k: int) -> Column:
        part_l, part_r = F.get(left, F.lit(k - 1)), F.get(right, F.lit(parts - k - 1))
        score = F.call_function("div", whole(own) * whole(n * 1000), whole(part_l) * whole(part_r))
        return F.struct(score.alias("score"), F.lit(k).alias("k"), part_l.alias("l"), part_r.alias("r"))

    return F.array_min(F.array(*[cut(k) for k in range(1, parts)]))


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, swallowed: int = 100) -> DataFrame:
    """lang, phrase, a, l, r, n, score of phrases of 2 to `longest` words found at least `least` times.

    a, l and r are the counts of the phrase and of its parts at the weakest cut, n all words of the
    language. A phrase is left out when a longer one that contains it is at least `swallowed` per cent as frequent.
    """
    totals, lengths = count_phrases(docs, least, longest)
    shorter = lengths[0].select(
        "id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), F.array("f").alias("left_counts"),
        F.array("f").alias("right_counts"))
    out = None
    for parts in range(2, longest + 1):
        table = lengths[parts - 1]
        # in prefix order beside the phrases one shorter, then in suffix order
        begun = shorter.select(F.col("id").alias("left"), "lang", F.col("phrase").alias("begin"), "left_counts").hint("merge")
        ended = shorter.select(F.col("id").alias("right"), "last", "right_counts").hint("merge")
        own = F.array("f")
        phrases = table.join(begun, "left").join(ended, "right").select(
            "id", "lang", "f", F.concat_ws(" ", "begin", "last").alias("phrase"), "last",
            F.concat("left_counts", own).alias("left_counts"), F.concat("right_counts", own).alias("right_counts"))
        phrases = shorter = stage(phrases, f"phrases-{parts}")
        if parts < longest:
            # a longer phrase that contains this one is no more frequent than one with a single word more
            for side in ("left", "right"):
                longer = lengths[parts].groupBy(side).agg(F.max("f").alias(f"{side}_most")).hint("merge")
                phrases = phrases.join(longer.withColumnRenamed(side, "id"), "id", "left")
            most = F.greatest(F.coalesce("left_most", F.lit(0)), F.coalesce("right_most", F.lit(0)))
            phrases = phrases.filter(~((most > 0) & (most * 100 >= F.col("f") * swallowed)))
        cut = weakest_cut(F.col("n"), F.col("left_counts"), F.col("right_counts"), parts)
        scored = phrases.join(totals, "lang").select("lang", "phrase", F.col("f").alias("a"), "n", cut.alias("cut"))
        out = scored if out is None else out.unionByName(scored)
    return out.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def best_collocations(docs: DataFrame, top: int = 2000, **settings) -> DataFrame:
    """The `top` collocations of every language with their rank: by score, then count, then the phrase's bytes.

    A language's phrases are ranked in RANK_PARTS parts by a hash of the phrase first; its first `top` are among the first `top`
    of their parts, so the rank over the language reads at most `top` rows of each part, however many phrases it has.
    """
    order = [F.desc("score"), F.desc("a"), "phrase"]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    found = collocations(docs, **settings).withColumn("rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order)))
    ranked = found.filter(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
