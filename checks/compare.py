"""Run queries next to their SQL: python -m checks.compare [sf_dir] [name ...]"""

from __future__ import annotations

import datetime
import json
import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if hasattr(value, "asDict"):
        return json.dumps(value.asDict(recursive=True), sort_keys=True)
    if isinstance(value, dict):
        return json.dumps(value, sort_keys=True)
    return value


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: [(v is None, str(type(v)), str(v)) for v in r])


def compare(df, con, sql: str) -> str | None:
    """None when both sides agree exactly, else the first difference."""
    got_names, got = df.columns, df.collect()
    result = con.execute(sql)
    want_names, want = [d[0] for d in result.description], result.fetchall()
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(got_names)} against {sorted(want_names)}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    for a, b in zip(_sorted_rows(got_names, got), _sorted_rows(want_names, want)):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{sorted(got_names)}: {a} against {b}"
    return None


def main() -> int:
    from checks import all_queries
    from tabsmith.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    queries, oracles = all_queries()
    names = sys.argv[2:] or list(queries)
    spark = build_session(
        "compare", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                problem = compare(df, con, oracles[name])
                note = "ok" if problem is None else "DIFFERENT " + problem[:1500]
            else:
                rows = df.collect()
                problem, note = (None, f"rows only: {len(rows)}") if rows else ("empty", "EMPTY")
        except Exception as e:  # noqa: BLE001 - report and go on with the next query
            problem, note = "error", "ERROR " + str(e)[:1500]
        bad += problem is not None
        print(f"{name:26s} {time.time() - start:6.1f}s  {note}", flush=True)
    print(f"{len(names)} queries, {bad} with problems")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
