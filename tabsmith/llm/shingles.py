"""Pairs of texts whose sets of word shingles overlap: bands of minhashes find them, the whole sets decide.

Texts with equal sets form a class; classes alone are compared. A class is in one bucket for each band of
its minhashes. First every class meets the smallest and the largest class of each of its buckets, so a bucket of any size costs
two pairs a member. Once these links (and any others) are components, the classes of a bucket that are in
different components meet too, and no pair that shares a bucket is left out: it is verified or linked already.
A pair with a similarity of 0.8 shares no bucket with a chance of 0.0007 at 24 bands of 6 (the measured recall is in the README).

Defined results: words are parted by `[\\x20\\x09-\\x0D]+`, A-Z in lower case; fewer words than a shingle has are one
shingle; null and empty texts, and those of blanks, have the empty set and are one class.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabsmith.llm.common import map_rows, stage

SEED = 5
BANDS, ROWS = 24, 6
#: Shingles whose minhashes are computed at once.
BLOCK = 1024
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.random.default_rng(SEED).integers(0, 1 << 63, (BANDS * ROWS, 1), np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(29)


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """The hashes of the shingles of `width` words, sorted, each once."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hash_of = xxhash.xxh64_intdigest
    hashes = np.fromiter((hash_of(w, SEED) for w in words), np.uint64, len(words))
    width = min(width, len(words))
    count = len(words) - width + 1
    out = np.full(count, width, np.uint64)
    for k in range(width):
        out = _mixed(out * _FACTOR + hashes[k:k + count])
    return np.unique(out)


def bands_of(shingles: np.ndarray) -> np.ndarray:
    """The buckets of a set, one for each band; none for the empty set."""
    if not len(shingles):
        return np.empty(0, np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), BLOCK):
        least = np.minimum(least, (shingles[at:at + BLOCK] * _ODD).min(axis=1))
    out = np.arange(BANDS, dtype=np.uint64)
    for row in least.reshape(BANDS, ROWS).T:
        out = _mixed(out * _FACTOR + row)
    return out.view(np.int64)


#: The columns that `described` makes: the class, the size of its set and its buckets.
DESCRIBED = "cls binary, n_set long, bands array<long>"


def described(texts: list[str | None], width: int = 5) -> dict:
    sets = [shingle_set(t, width) for t in texts]
    return {
        "cls": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets], "n_set": [len(s) for s in sets], "bands": [bands_of(s) for s in sets]}


def _alike(a: Column, b: Column, least: tuple[int, int]) -> Column:
    """Whether sets of these sizes can be as similar as `least`, a fraction."""
    return F.least(a, b) * least[1] >= F.greatest(a, b) * least[0]


class Overlaps:
    """The links of documents with overlapping sets, as pairs of their fingerprints fp.

    `hashed` has body (the hash of the text), fp and the described columns of every document, `texts` body and text.
    """

    def __init__(self, hashed: DataFrame, texts: DataFrame, least: tuple[int, int], width: int = 5):
        self.least = least
        # the described columns depend on the class alone
        classes = hashed.groupBy("cls").agg(
            F.min("fp").alias("fp"), F.min("body").alias("body"), F.first("n_set").alias("n"), F.first("bands").alias("bands"))
        self.classes = stage(classes.withColumn("id", F.monotonically_increasing_id()), "shingle-classes")
        same = hashed.select("cls", F.col("fp").alias("b")).distinct().join(self.classes.select("cls", F.col("fp").alias("a")), "cls")
        self.same_class = same.select("a", "b").filter("a <> b")
        entries = self.classes.select("id", "fp", "n", F.explode("bands").alias("band"))
        ends = entries.groupBy("band").agg(
            F.min(F.struct("id", "n")).alias("low"), F.max(F.struct("id", "n")).alias("high")).filter("low.id <> high.id")
        self.entries = stage(entries.join(ends, "band"), "shared-buckets")
        wanted = self.entries.select("id").distinct().join(self.classes.select("id", "body"), "id")
        found = texts.join(wanted, "body").groupBy("id").agg(F.first("text").alias("text"))
        sets = map_rows(found, ["id", "text"], lambda rows: (
            {"id": ids, "shingles": [shingle_set(t, width).view(np.int64) for t in some]} for ids, some in rows), "id long, shingles array<long>")
        self.sets = stage(sets, "shingle-sets")
        met = None
        for end in ("low", "high"):
            pair = self.entries.filter((F.col("id") != F.col(f"{end}.id")) & _alike(F.col("n"), F.col(f"{end}.n"), least)).select(
                F.least("id", f"{end}.id").alias("a"), F.greatest("id", f"{end}.id").alias("b"))
            met = pair if met is None else met.unionByName(pair)
        self.met = stage(met.distinct(), "bucket-ends")

    def _verified(self, pairs: DataFrame) -> DataFrame:
        """Those pairs (a, b) of classes whose sets are similar."""
        left = self.sets.select(F.col("id").alias("a"), F.col("shingles").alias("left_set"))
        right = self.sets.select(F.col("id").alias("b"), F.col("shingles").alias("right_set"))
        both = F.size(F.array_intersect("left_set", "right_set")).cast("long")
        part, whole = self.least
        return pairs.join(left, "a").join(right, "b").filter(
            both * (part + whole) >= (F.size("left_set") + F.size("right_set")) * part).select("a", "b")

    def first_links(self) -> DataFrame:
        """Links (a, b) of fingerprints: of one class, and of classes that are similar to an end of a bucket."""
        of = self.classes.select("id", "fp")
        found = self._verified(self.met).join(of.select(F.col("id").alias("a"), F.col("fp").alias("x")), "a").join(
            of.select(F.col("id").alias("b"), F.col("fp").alias("y")), "b")
        return self.same_class.unionByName(found.filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")))

    def links_between(self, roots: DataFrame) -> DataFrame:
        """The further links, as pairs (a, b) of roots; `roots` has the root of every fingerprint (node, root) with links."""
        rooted = self.entries.select("band", "id", "fp", "n").join(
            roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
        mixed = rooted.groupBy("band").agg(F.min("root").alias("p"), F.max("root").alias("q")).filter("p <> q").select("band")
        rooted = stage(rooted.join(mixed, "band").select("band", "id", "n", "root"), "mixed-buckets")
        present = rooted.select("band", "root").distinct()
        beside = present.select("band", F.col("root").alias("x")).join(present.select("band", F.col("root").alias("y")), "band").filter("x < y")
        one = rooted.select("band", F.col("root").alias("x"), F.col("id").alias("i"), F.col("n").alias("m"))
        other = rooted.select("band", F.col("root").alias("y"), F.col("id").alias("j"), F.col("n").alias("o"))
        pairs = beside.join(one, ["band", "x"]).join(other, ["band", "y"]).filter(_alike(F.col("m"), F.col("o"), self.least))
        pairs = pairs.select(F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b")).distinct().join(self.met, ["a", "b"], "left_anti")
        of = rooted.select("id", "root").distinct()
        return self._verified(pairs).join(of.select(F.col("id").alias("a"), F.col("root").alias("x")), "a").join(
            of.select(F.col("id").alias("b"), F.col("root").alias("y")), "b").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()
