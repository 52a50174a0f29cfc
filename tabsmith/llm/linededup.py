"""Line deduplication: lines that several documents share stay only in the last document that has them.

Hashes of long lines are range-partitioned by (hash, document) and sorted by document,
largest first, and position, so a task streams each line's occurrences in order and holds no
table of lines. A line found everywhere spreads over many partitions: a run that a task
cannot see whole is handed on as "open" and decided from one total per line and task.
The result is a compressed bitmap of kept lines per document; text is read only to apply it.

Defined results: a null text is one empty line and stays null; rows with a null doc_id count as one document,
below all others; rows that share a doc_id count as one document, and each of their lines is
judged by its own; other columns stay as they are, an input column called n_lines or n_dropped
is replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.llm.common import add_columns, free_name, map_rows, stage, text_or_empty

#: Rows of one line that a task holds back before it hands the run on as open.
HELD_ROWS = 50_000
#: Totals of open lines are broadcast up to so many (about 50 bytes each).
BROADCAST_LINES = 100_000
_SPACE = b" \t\n\r\x0b\x0c"
_NAMES = ["doc", "nodoc", "body", "n_lines", "pos", "hi", "lo"]


def line_keys(lines: list[bytes], min_chars: int) -> Iterator[tuple[int, bytes]]:
    """(position, key) of every line whose key has at least `min_chars` code points.

    A key is the line without ASCII white space at its ends, with A-Z in lower case.
    """
    for pos, line in enumerate(lines):
        key = line.strip(_SPACE).lower()
        if len(key) >= min_chars and (key.isascii() or len(key.decode()) >= min_chars):
            yield pos, key


def _hash_lines(min_chars: int):
    def run(batches):
        for ids, texts, bodies in batches:
            rows = []
            for doc, text, body in zip(ids, texts, bodies):
                lines = text.encode().split(b"\n")
                for pos, key in line_keys(lines, min_chars):
                    hi, lo = np.frombuffer(xxhash.xxh3_128_digest(key), np.int64).tolist()
                    rows.append((doc or 0, doc is None, body, len(lines), pos, hi, lo))
            for at in range(0, len(rows), HELD_ROWS):
                yield dict(zip(_NAMES, zip(*rows[at:at + HELD_ROWS])))

    return run


def _stream_runs(min_docs: int, held_rows: int):
    """Rows sorted by (hash, document descending, position) to dropped and to open lines.

    A run is one line's rows. A run is decided here when it both begins and ends in this
    partition; the first and the last run, and runs of more than `held_rows`, are open.
    """

    def out(cols: dict, pick, is_open: bool, fresh: np.ndarray) -> pa.RecordBatch:
        arrays = [pa.array(cols[n][pick]) for n in _NAMES]
        made = [pa.array(np.full(len(arrays[0]), is_open)), pa.array(fresh[pick].astype(np.int64))]
        return pa.RecordBatch.from_arrays([*arrays, *made], names=[*_NAMES, "open", "fresh"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # rows of the run that is not over yet
        sent = None  # key and document of the last row of a run that was handed on before its end
        first = True  # no run of this partition is over yet
        for batch in batches:
            cols = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in _NAMES}
            if held is not None:
                cols = {n: np.concatenate([held[n], cols[n]]) for n in _NAMES}
            size = len(cols["hi"])
            if not size:
                continue
            begins = np.ones(size, bool)
            begins[1:] = (cols["hi"][1:] != cols["hi"][:-1]) | (cols["lo"][1:] != cols["lo"][:-1])
            fresh = begins.copy()  # the first row of a document within its run
            fresh[1:] |= (cols["doc"][1:] != cols["doc"][:-1]) | (cols["nodoc"][1:] != cols["nodoc"][:-1])
            if sent is not None:
                begins[0] = sent[:2] != (cols["hi"][0], cols["lo"][0])
                fresh[0] = begins[0] or sent[2:] != (cols["doc"][0], cols["nodoc"][0])
            starts = np.flatnonzero(begins)
            last = int(starts[-1]) if len(starts) else 0
            if not len(starts):
                undecided = size
            elif sent is not None:
                undecided = int(starts[0])
            else:
                undecided = int(starts[1]) if first and len(starts) > 1 else 0
            if undecided:
                yield out(cols, slice(0, undecided), True, fresh)
            if not len(starts):
                sent = tuple(cols[n][-1] for n in ("hi", "lo", "doc", "nodoc"))
                continue
            first = first and sent is None and len(starts) == 1
            if last > undecided:
                part = slice(undecided, last)
                run_of = np.cumsum(begins[part]) - 1
                docs = np.bincount(run_of, fresh[part])
                nth_doc = np.cumsum(fresh[part]) - (np.cumsum(docs) - docs)[run_of]
                drop = np.flatnonzero((docs[run_of] >= min_docs) & (nth_doc > 1)) + undecided
                if len(drop):
                    yield out(cols, drop, False, fresh)
            if size - last > held_rows:
                yield out(cols, slice(last, size), True, fresh)
                held, sent = None, tuple(cols[n][-1] for n in ("hi", "lo", "doc", "nodoc"))
            else:
                held, sent = {n: cols[n][last:] for n in _NAMES}, None
        if held is not None:
            fresh = np.ones(len(held["hi"]), bool)
            fresh[1:] = (held["doc"][1:] != held["doc"][:-1]) | (held["nodoc"][1:] != held["nodoc"][:-1])
            yield out(held, slice(0, len(fresh)), True, fresh)

    return run


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, held_rows: int = HELD_ROWS) -> DataFrame:
    """doc_id, body (xxhash64 of the text), n_lines, n_dropped, keep: for documents that lose lines.

    `keep` is the zlib-compressed bitmap of the lines that stay (numpy's packbits order).
    A document without a row keeps every line.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc"), text_or_empty().alias("text"))
    source = source.withColumn("body", F.xxhash64("text"))
    schema = "doc long, nodoc boolean, body long, n_lines int, pos int, hi long, lo long"
    lines = stage(map_rows(source, ["doc", "text", "body"], _hash_lines(min_chars), schema), "line-hashes")
    ordered = lines.repartitionByRange("hi", "lo", "nodoc", "doc").sortWithinPartitions(
        "hi", "lo", "nodoc", F.desc("doc"), "body", "pos")
    found = stage(ordered.mapInArrow(_stream_runs(min_docs, held_rows), f"{schema}, open boolean, fresh long"), "line-runs")
    still_open = found.filter("open")
    totals = still_open.groupBy("hi", "lo").agg(
        F.sum("fresh").alias("docs"), F.max(F.struct(~F.col("nodoc"), "doc")).alias("largest")
    ).filter(F.col("docs") >= min_docs)
    # two lines per task and a line per `held_rows` rows are open at most; hot ones then need no shuffle
    totals = stage(totals, "line-totals")
    if totals.count() <= BROADCAST_LINES:
        totals = F.broadcast(totals)
    late = still_open.join(totals, ["hi", "lo"]).filter(F.struct(~F.col("nodoc"), "doc") != F.col("largest"))
    key = [F.when(~F.col("nodoc"), F.col("doc")).alias("doc_id"), "body"]
    dropped = found.filter("not open").select(*key, "n_lines", "pos").unionByName(late.select(*key, "n_lines", "pos"))
    per_doc = dropped.groupBy("doc_id", "body", "n_lines").agg(F.collect_set("pos").alias("gone"))

    def pack(n_lines, gone):
        maps = []
        for n, positions in zip(n_lines, gone):
            bits = np.ones(n, bool)
            bits[positions] = False
            maps.append(zlib.compress(np.packbits(bits).tobytes()))
        return {"n_dropped": [len(set(p)) for p in gone], "keep": maps}

    return add_columns(per_doc, ["n_lines", "gone"], pack, "n_dropped int, keep binary").drop("gone")


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """`docs` with the kept lines as text, and n_lines (before) and n_dropped."""
    names = {n: free_name(docs, n) for n in ("m_doc", "m_body", "m_keep")}
    right = bitmaps.select(
        F.col("doc_id").alias(names["m_doc"]), F.col("body").alias(names["m_body"]), F.col("keep").alias(names["m_keep"]))
    # few columns on the right; the texts need no sort this way
    joined = docs.join(
        right.hint("shuffle_hash"),
        docs["doc_id"].cast("long").eqNullSafe(right[names["m_doc"]])
        & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == right[names["m_body"]]), "left")

    def cut(texts, keeps):
        kept, n_lines, n_dropped = [], [], []
        for text, keep in zip(texts, keeps):
            lines = (text or "").split("\n")
            if keep is not None:
                bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=len(lines))
                stay = [line for line, bit in zip(lines, bits) if bit]
            else:
                stay = lines
            kept.append("\n".join(stay) if text is not None else None)  # a null has no line to lose
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(stay))
        return {"text": kept, "n_lines": n_lines, "n_dropped": n_dropped}

    cut_docs = add_columns(joined, ["text", names["m_keep"]], cut, "text string, n_lines long, n_dropped long")
    order = [*docs.columns, *[c for c in ("n_lines", "n_dropped") if c not in docs.columns]]
    return cut_docs.select(*order)


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Keys of at least `min_chars` found in at least `min_docs` documents stay only in the largest doc_id."""
    return apply_bitmaps(docs, keep_bitmaps(docs, min_chars, min_docs))
