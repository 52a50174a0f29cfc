"""Synthesis of dirty tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.loans import RAW_NAMES, loans, with_loans
from checks.registry import query
from tabsmith.plans import loan_preset as preset
from tabsmith.plans import synthesis


def _draw(salt: int) -> str:
    """An integer hash of the order key that both engines compute alike, as a draw on [0, 1)."""
    return f"((((o_orderkey % 100003) * {48271 + 2 * salt} + 11) % 100003) / 100003e0)"


_DRAW = _draw(0)


@query("inject_dirt", f"""
select o_orderkey, case when {_draw(1)} < 3e-2 then null else o_totalprice end as o_totalprice,
  case when {_draw(2)} < 7e-1 then '' else o_orderpriority end as o_orderpriority,
  case when {_draw(3)} < 6e-1 then -1 else o_custkey end as o_custkey
from orders""")
def inject_dirt(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_totalprice", "o_orderpriority", "o_custkey")
    names = ["o_totalprice", "o_orderpriority", "o_custkey"]
    return synthesis.inject_dirt(
        orders, dict(zip(names, (0.03, 0.7, 0.6))), {n: F.expr(_draw(i + 1)) for i, n in enumerate(names)},
        {"o_orderpriority": F.lit(""), "o_custkey": F.lit(-1)})


@query("inject_duplicates", f"""
with marked as (select o_orderkey, o_orderpriority, o_orderstatus, {_DRAW} as draw from orders)
select o_orderkey, o_orderpriority, o_orderstatus, 0 as copy from marked
union all select o_orderkey, case when draw < 3e-3 then '' else o_orderpriority end,
  case when draw < 1e-3 then '' else o_orderstatus end, 1 from marked where draw < 1e-2""")
def inject_duplicates(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_orderpriority", "o_orderstatus", F.expr(_DRAW).alias("draw"))
    draw = F.col("draw")
    return synthesis.inject_duplicates(
        orders, draw < 0.01, {"o_orderpriority": draw < 0.003, "o_orderstatus": draw < 0.001}).drop("draw")


@query("append_sentinels", with_loans(
    "select " + ", ".join(RAW_NAMES) + " from loans union all select 'LN-' || lpad(cast(i as string), 10, '0'), "
    + ", ".join("null" for _ in RAW_NAMES[1:]) + " from (values (900000000), (900000001), (900000002)) v(i)"))
def append_sentinels(spark, sf_dir):
    return synthesis.append_sentinels(loans(spark, sf_dir).select(*preset.RAW_COLUMNS), 900000000)
