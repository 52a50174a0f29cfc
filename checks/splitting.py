"""Training and validation parts."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from checks import sql_parts as sql
from checks.fitting import cleaned
from checks.loans import loans, with_loans
from checks.registry import query
from tabsmith.operators import split
from tabsmith.session import stage, work_path
from tabsmith.sources import tables


@query("split_exact", sql.cleaned_sql("""
select loan_id, row_number() over (order by substr(md5(loan_id), 1, 15), loan_id)
    > cast(floor((select count(*) from cleaned) * 8e-1) as bigint) as is_val
from cleaned"""))
def split_exact(spark, sf_dir):
    keys = stage(cleaned(spark, sf_dir).select("loan_id"), "keys")
    return split.exact_split(keys, "loan_id", 0.2)


@query("split_hash", with_loans("""
select src_ord, loan_id, cast('0x' || substr(md5(loan_id), 1, 8) as bigint) % 1000 < 200 as is_val from loans"""))
def split_hash(spark, sf_dir):
    return split.hash_split(loans(spark, sf_dir).select("src_ord", "loan_id"), "loan_id", 0.2)


# which rows are drawn depends on the partitions: all rows are there once, and about a fifth is for validation
@query("split_random", with_loans(
    "select count(*) as rows, count(distinct src_ord) as distinct_rows, true as share_is_near from loans"))
def split_random(spark, sf_dir):
    train, val = split.random_split(stage(loans(spark, sf_dir).select("src_ord"), "numbers"), 0.2)
    both = train.withColumn("is_val", F.lit(0)).unionByName(val.withColumn("is_val", F.lit(1)))
    return both.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("src_ord").alias("distinct_rows"),
        F.avg("is_val").between(0.15, 0.25).alias("share_is_near"))


def _val_priorities() -> str:
    # the five priorities are the five files, in this order
    names = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    order = np.random.RandomState(42).permutation(len(names))
    return ", ".join(f"'{names[i]}'" for i in order[int(len(names) * 0.8):])


@query("split_files", f"""
select o_orderkey, substr(o_orderpriority, 1, 1) in (
    select substr(p, 1, 1) from (values {', '.join(f'({p})' for p in _val_priorities().split(', '))}) v(p)) as is_val
from orders""")
def split_files(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", F.substring("o_orderpriority", 1, 1).alias("priority"))
    path = work_path(spark, "by-priority")
    # one file for each priority, however many files the table has
    orders.repartition("priority").write.partitionBy("priority").parquet(path)
    files = tables.list_files(spark, path)
    train, val = split.file_split(files, 0.2)
    read = lambda names, mark: tables.read_table(spark, names, "parquet").select(
        "o_orderkey", F.lit(mark).alias("is_val"))
    return read(train, False).unionByName(read(val, True))
