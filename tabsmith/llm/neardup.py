"""SimHash near-duplicates by a segment-popcount embedding.

A fingerprint of 64 bits becomes the vector of the bit counts of its segments. Fingerprints
that differ in d bits have vectors at a Manhattan distance of at most d, so the vectors give a
lower bound: a grid range join finds all pairs within it, and the bits decide. The vector is
parted into groups of segments, as many that, of `max_bits` differences, one group has at most one
(two groups for 3 bits). The range of one around a group's vector is a cell of the grid and
the cells one step up in one segment; the lower of two neighbours finds the higher.

Only distinct fingerprints are joined. Components come from rounds of hooking to the smallest
neighbour over the links, written to the shared folder in each round.

Defined results: null and empty texts have fingerprint zero and link like others; rows
with a null doc_id have a fingerprint and take part in links, but a component is named by its
smallest doc_id that is not null; rows that share a doc_id are judged by their own text.
Other columns stay; an input column called fingerprint or component_id is replaced.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.llm import shingles
from tabsmith.llm.common import add_columns, shielded, stage, text_or_empty

SHINGLE_SEED = 42


def simhash(text: str, width: int = 3) -> int:
    """Fingerprint of the shingles of `width` words, repeats included, as a signed long."""
    words = text.encode().lower().split()
    if not words:
        return 0
    hash_of = xxhash.xxh64_intdigest
    if len(words) <= width:
        hashes = [hash_of(b" ".join(words), SHINGLE_SEED)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        hashes = [hash_of(joined[a:b], SHINGLE_SEED) for a, b in zip(starts[:len(words) - width + 1].tolist(), ends[width - 1:].tolist())]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        block = np.array(hashes[at:at + 65_536], np.uint64)
        counts += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """`docs` with fp, the fingerprint as a signed long."""
    return add_columns(docs, ["text"], lambda texts: {"fp": [simhash(t or "", width) for t in texts]}, "fp long")


def cells(fp: Column, max_bits: int, segment_bits: int) -> tuple[Column, Column]:
    """The cells of a fingerprint, one for each group of segments, and the cells one step up from them.

    A cell is (group, bit counts of the group's segments, packed).
    """
    groups = max(2, (max_bits + 2) // 2)  # of so many groups, one has at most max_bits // groups <= 1 differences
    segments = 64 // segment_bits
    field = segment_bits.bit_length()  # bits that hold a segment's count
    mask = (1 << segment_bits) - 1
    bounds = [segments * g // groups for g in range(groups + 1)]
    own, up = [], []
    for g in range(groups):
        counts = [F.bit_count(F.shiftrightunsigned(fp, s * segment_bits).bitwiseAND(F.lit(mask))) for s in range(bounds[g], bounds[g + 1])]
        packed = F.lit(0).cast("long")
        for k, c in enumerate(counts):
            packed = packed + F.shiftleft(c.cast("long"), k * field)
        cell = F.struct(F.lit(g).alias("g"), packed.alias("v"))
        own.append(cell)
        up += [F.when(c < segment_bits, F.struct(F.lit(g).alias("g"), (packed + (1 << (k * field))).alias("v"))) for k, c in enumerate(counts)]
    return F.array(*own), F.array(*up)


def links(prints: DataFrame, max_bits: int = 3, segment_bits: int = 2) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints `fp` that differ in at most `max_bits` bits."""
    if 64 % segment_bits or not 0 < segment_bits <= 8 or (64 // segment_bits + 1) // max(2, (max_bits + 2) // 2) * segment_bits.bit_length() > 62:
        raise ValueError("segment_bits must part 64 bits, and a group's counts must fit a long")
    own, up = cells(F.col("fp"), max_bits, segment_bits)
    lower = prints.select(F.col("fp").alias("x"), F.explode(F.concat(
        F.transform(own, lambda c: F.struct(c.alias("cell"), F.lit(True).alias("same"))),
        F.transform(F.filter(up, lambda c: c.isNotNull()), lambda c: F.struct(c.alias("cell"), F.lit(False).alias("same"))))).alias("p"))
    lower = lower.select("x", F.col("p.cell.g").alias("g"), F.col("p.cell.v").alias("v"), F.col("p.same").alias("same"))
    upper = prints.select(F.col("fp").alias("y"), F.explode(own).alias("c")).select("y", F.col("c.g").alias("g"), F.col("c.v").alias("v"))
    near = F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= max_bits
    once = ~F.col("same") | (F.col("x") < F.col("y"))  # two prints of one cell meet twice
    joined = lower.alias("l").join(
        upper.alias("u"), (F.col("l.g") == F.col("u.g")) & (F.col("l.v") == F.col("u.v")) & near & once & (F.col("x") != F.col("y")))
    return joined.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root) for every node of `edges` (a, b): root is the component's smallest node.

    Each round joins every node's larger neighbours to its smallest one, then every node's
    neighbours to the smallest, until nothing changes: the links become stars.
    A round sends one row per link; a node with many links is pre-aggregated and, in the
    join with its minimum, split like any skewed key.
    """
    both = lambda e: e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        e.select(F.col("b").alias("u"), F.col("a").alias("v")))
    edges = stage(edges.select("a", "b").filter("a <> b"), "links")
    before = None
    for _ in range(max_rounds):
        # large star: neighbours above a node hang on the smallest of the node and its neighbours
        pairs = both(edges)
        low = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = pairs.filter("v > u").join(low, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).filter("a <> b").distinct()
        large = stage(large, "large-star")
        # small star: a node and its neighbours below hang on the smallest of them
        down = large.select(F.col("b").alias("u"), F.col("a").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u")
        edges = small.select(F.col("m").alias("a"), F.col("v").alias("b")).filter("a <> b").unionByName(
            low.select(F.col("m").alias("a"), F.col("u").alias("b"))).distinct()
        edges = stage(edges, "small-star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def _memberships(docs: DataFrame, width: int, max_bits: int, segment_bits: int, overlap: tuple[int, int] | None = None) -> DataFrame:
    """doc_id, body (xxhash64 of the text), fp, root (one fingerprint of the component), component_id, per row."""
    narrow = docs.select("doc_id", "text").withColumn("body", F.xxhash64(text_or_empty()))
    if overlap:
        with_sets = add_columns(narrow, ["text"], lambda texts: {
            "fp": [simhash(t or "", width) for t in texts], **shingles.described(texts)}, f"fp long, {shingles.DESCRIBED}")
        hashed = stage(with_sets.drop("text"), "fingerprints")
    else:
        hashed = stage(fingerprints(narrow, width).select("doc_id", "body", "fp"), "fingerprints")
    prints = stage(hashed.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "distinct-fingerprints")
    near = links(prints.select("fp"), max_bits, segment_bits)
    if overlap:
        overlaps = shingles.Overlaps(hashed, narrow.select("body", "text"), overlap)
        near = near.unionByName(overlaps.first_links())
    roots = stage(components(near), "component-roots")
    if overlap:
        # links between components join these; the root of what is joined stands for all of it
        joined = components(overlaps.links_between(roots)).select(F.col("node").alias("part"), F.col("root").alias("whole"))
        of = prints.select(F.col("fp").alias("node")).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        roots = stage(of.join(joined, F.col("root") == F.col("part"), "left").select("node", F.coalesce("whole", "root").alias("root")), "joined-roots")
    rooted = prints.join(roots, prints["fp"] == roots["node"], "left").select(
        "fp", "first_doc", F.coalesce("root", "fp").alias("root"))
    names = rooted.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    return hashed.join(rooted.select("fp", "root").join(names, "root"), "fp")


def _with_key(docs: DataFrame) -> DataFrame:
    return docs.withColumns({
        "__doc": F.coalesce("doc_id", F.lit(0)), "__nodoc": F.col("doc_id").isNull(), "__body": F.xxhash64(text_or_empty())})


_KEY = ["__doc", "__nodoc", "__body"]


@shielded
def near_duplicates(docs: DataFrame, width: int = 3, max_bits: int = 3, segment_bits: int = 2) -> DataFrame:
    """`docs` with fingerprint (16 hexadecimal digits) and component_id, the smallest doc_id that links reach."""
    new = [F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"]
    kept = [c for c in docs.columns if c.lower() not in ("fingerprint", "component_id")]
    found = _memberships(docs, width, max_bits, segment_bits)
    if set(kept) <= {"doc_id", "text"} and "text" not in kept:
        return found.select(*kept, *new)
    per_doc = found.select(
        F.coalesce("doc_id", F.lit(0)).alias("__doc"), F.col("doc_id").isNull().alias("__nodoc"), F.col("body").alias("__body"), *new).distinct()
    per_doc = per_doc.withColumnsRenamed({"fingerprint": "__fp", "component_id": "__component"})
    joined = _with_key(docs).join(per_doc.hint("shuffle_hash"), _KEY)
    return joined.select(*kept, F.col("__fp").alias("fingerprint"), F.col("__component").alias("component_id"))


@shielded
def keep_first(docs: DataFrame, width: int = 3, max_bits: int = 3, segment_bits: int = 2, overlap: tuple[int, int] | None = None) -> DataFrame:
    """One document of each component, that with the smallest doc_id, with the columns of `docs`.

    With `overlap`, a fraction such as (4, 5), texts whose sets of five-word shingles are that similar (shared shingles to all
    shingles) are linked as well.
    Of rows that share the doc_id, the one with the smallest hash of its text stays; of rows
    that share both, any one. A component without any doc_id keeps one row in the same way.
    """
    found = _memberships(docs, width, max_bits, segment_bits, overlap)
    first = found.groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("__nodoc"), F.coalesce("doc_id", F.lit(0)).alias("__doc"), F.col("body").alias("__body"))).alias("f"))
    joined = _with_key(docs).join(first.select("f.*").hint("shuffle_hash"), _KEY)
    nth = F.row_number().over(Window.partitionBy(*_KEY).orderBy("__body"))
    return joined.withColumn("__nth", nth).filter("__nth = 1").select(*docs.columns)
