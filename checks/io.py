"""Readers, writers, counts, schema and log extraction."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.loans import RAW_NAMES, loans, with_loans
from checks.registry import query
from checks.sql_parts import DEDUPED, quote
from tabsmith.operators import counts, logs
from tabsmith.plans import loan_preset as preset
from tabsmith.session import work_path
from tabsmith.sources import tables


# a CSV file does not tell empty text from missing text; both come in as NULL
@query("scan_csv", with_loans("select " + ", ".join(
    f"nullif({c}, '') as {c}" if c in preset.RAW_TEXT_COLUMNS else c for c in RAW_NAMES) + " from loans"))
def scan_csv(spark, sf_dir):
    path = work_path(spark, "loans") + ".csv"
    tables.write_table(loans(spark, sf_dir).select(*preset.RAW_COLUMNS), path, "csv")
    return tables.read_table(spark, path, schema=preset.raw_schema())


_NUMBERS = ["src_ord", "credit_score", "num_credit_inquiries", "loan_amount"]


@query("scan_csv_noheader", with_loans(
    "select " + ", ".join(f"{c} as _c{i}" for i, c in enumerate(_NUMBERS)) + " from loans"))
def scan_csv_noheader(spark, sf_dir):
    path = work_path(spark, "numbers") + ".csv"
    tables.write_table(loans(spark, sf_dir).select(*_NUMBERS), path, "csv", header=False)
    return tables.read_table(spark, path, schema="_c0 bigint, _c1 double, _c2 int, _c3 double", header=False)


@query("scan_parquet", "select o_orderkey, o_totalprice, o_orderpriority from orders")
def scan_parquet(spark, sf_dir):
    df = tables.read_table(spark, [f"{sf_dir}/orders.parquet"])
    return df.select("o_orderkey", "o_totalprice", "o_orderpriority")


@query("sink_csv_roundtrip", with_loans("select src_ord, loan_id, city, interest_rate from loans"))
def sink_csv_roundtrip(spark, sf_dir):
    path = work_path(spark, "sink") + ".csv"
    df = loans(spark, sf_dir).select("src_ord", "loan_id", "city", "interest_rate")
    tables.write_table(df, path, "csv", header=True, files=8)
    return tables.read_table(spark, path, schema="src_ord bigint, loan_id string, city string, interest_rate double")


_QUOTED = """concat('a "', o_orderpriority, '", ', chr(10), ' ', cast(o_orderkey as string), ', "" ')"""


@query("csv_quoting", f"select o_orderkey, {_QUOTED} as said from orders")
def csv_quoting(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr("o_orderkey", f"{_QUOTED} as said")
    path = work_path(spark, "quoted") + ".csv"
    tables.write_table(orders, path, "csv", files=4)
    return tables.read_table(spark, path, schema="o_orderkey bigint, said string", multiline=True)


@query("sink_parquet_roundtrip", with_loans("select src_ord, loan_id, city, interest_rate from loans"))
def sink_parquet_roundtrip(spark, sf_dir):
    path = work_path(spark, "sink")
    df = loans(spark, sf_dir).select("src_ord", "loan_id", "city", "interest_rate")
    tables.write_table(df, path, "parquet", files=8)
    return tables.read_table(spark, path)


@query("stage_counts", with_loans("""
select (select count(*) from loans) as rows_in, count(*) as rows_out,
  (select count(*) from loans) - count(*) as rows_removed
from deduped where loan_status in ('Default', 'Paid')""", DEDUPED))
def stage_counts(spark, sf_dir):
    return counts.stage_counts(
        loans(spark, sf_dir), preset.KEY, "src_ord", preset.LABEL, preset.ALLOWED_LABELS)


@query("schema_report", with_loans(" union all ".join(
    f"select {i + 1} as position, '{c}' as name, count(*) as rows, count({c}) as present from loans"
    for i, c in enumerate(RAW_NAMES))))
def schema_report(spark, sf_dir):
    return counts.schema_report(loans(spark, sf_dir).select(*preset.RAW_COLUMNS))


@query("label_distribution", with_loans("""
select loan_status, count(*) as n, count(*) * 1e2 / sum(count(*)) over () as percent from loans group by loan_status"""))
def label_distribution(spark, sf_dir):
    return counts.value_shares(loans(spark, sf_dir), "loan_status")


# one line of each shape that a training run prints, with the numbers of a lineitem row
_LINE = """case l_linenumber
  when 1 then concat('  AUC-ROC:   ', cast(l_discount as string))
  when 2 then concat('[', cast(l_orderkey as string), ']  eval-logloss:', cast(l_tax as string), '  eval-auc:', cast(l_discount as string))
  when 3 then concat('  F1 (macro):  ', cast(l_discount as string))
  when 4 then concat('[', cast(l_orderkey as string), ']  eval', chr(39), 's auc: ', cast(l_discount as string), '  eval', chr(39), 's l2: ', cast(l_tax as string))
  when 5 then concat('  RMSE: ', cast(l_extendedprice as string))
  when 6 then concat('  R2:   -', cast(l_quantity as string))
  else concat('  Loaded in ', cast(l_quantity as string), 's') end"""
_PATTERNS = {**logs.XGB_PATTERNS, **{k: v for k, v in logs.LGBM_PATTERNS.items() if k.startswith("lgbm:")}}


def _log_sql() -> str:
    found = " union all ".join(
        f"select l_orderkey, l_linenumber, {quote(name)} as name, "
        f"regexp_extract(value, {quote(pattern)}, 1) as text from lines"
        for name, pattern in _PATTERNS.items())
    return (
        f"with lines as (select l_orderkey, l_linenumber, {_LINE} as value from lineitem) "
        f"select l_orderkey, l_linenumber, name, cast(text as double) as metric from ({found}) where text <> ''")


@query("log_metrics", _log_sql())
def log_metrics(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(
        "l_orderkey", "l_linenumber", f"{_LINE} as value")
    return logs.extract_metrics(lines, _PATTERNS)
