from collections import defaultdict

import numpy as np
import pytest
from odd_rows import ODD

from tabsmith.llm import linededup


def brute(rows, min_chars=20, min_docs=3):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(" \t\n\r\x0b\x0c").translate(lower)
    holders = defaultdict(set)
    order = lambda i: (i is not None, i or 0)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(order(i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(h := holders.get(key(x), ())) < min_docs or max(h) == order(i)]
        out.append((i, "\n".join(kept) if text is not None else None, len(lines), len(lines) - len(kept)))
    return out


def check(df, rows, **settings):
    got = linededup.apply_bitmaps(df, linededup.keep_bitmaps(df, **settings)).collect()
    assert sorted(map(str, [(r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in got])) == sorted(map(str, brute(rows)))


@pytest.mark.parametrize("held_rows", [1, 7, 50_000])
def test_equals_brute_force(spark, frame, held_rows):
    rng = np.random.default_rng(held_rows)
    lines = [f"a line that is long enough {k}" for k in range(40)] + ["short", "", "  A LINE that is long enough 3 "]
    rows = [(int(i), "\n".join(rng.choice(lines, rng.integers(1, 9)))) for i in rng.permutation(300)]
    rows += [(1000 + i, "a line that everybody has, again and again\n" + "own line of this document %d" % i) for i in range(400)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        check(frame(rows), rows, held_rows=held_rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_shuffled_totals(frame, monkeypatch):
    monkeypatch.setattr(linededup, "BROADCAST_LINES", -1)
    rows = [(i, "a line that everybody has, again and again\nx") for i in range(30)]
    check(frame(rows), rows, held_rows=2)


def test_odd_rows(odd, frame):
    check(odd, ODD)
    out = linededup.dedup_lines(odd.withColumnRenamed("lines", "n_lines"))
    assert out.columns.count("n_lines") == 1
    assert linededup.dedup_lines(odd.limit(0)).count() == 0
    unicode = [(i, "é" * 19 + "\n" + "é" * 20) for i in range(4)]
    check(frame(unicode), unicode)
