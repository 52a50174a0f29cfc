"""Dates and durations held as text."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sql_parts as sql
from checks.loans import loans, with_loans
from checks.registry import query
from tabsmith.functions import dates
from tabsmith.plans import loan_preset as preset


def _dated(spark, sf_dir):
    df = loans(spark, sf_dir).select("src_ord", "application_date")
    return df.withColumn("app_date", dates.parse_dates(F.col("application_date"), preset.DATE_FORMATS))


@query("parse_dates", with_loans(
    f"select src_ord, application_date, strftime({sql.DATE}, '%Y-%m-%d') as app_date from loans"))
def parse_dates(spark, sf_dir):
    return _dated(spark, sf_dir).withColumn("app_date", F.date_format("app_date", "yyyy-MM-dd"))


@query("date_parts", with_loans(
    f"select src_ord, cast(year({sql.DATE}) as int) as year, cast(month({sql.DATE}) as int) as month, "
    f"cast(isodow({sql.DATE}) - 1 as int) as day_of_week, cast(quarter({sql.DATE}) as int) as quarter from loans"))
def date_parts(spark, sf_dir):
    df = _dated(spark, sf_dir)
    return df.select("src_ord", *[v.alias(n) for n, v in dates.date_parts(F.col("app_date")).items()])


@query("days_since_ref", with_loans(
    f"select src_ord, cast(date_diff('day', date '2020-01-01', {sql.DATE}) as int) as days from loans"))
def days_since_ref(spark, sf_dir):
    return _dated(spark, sf_dir).select(
        "src_ord", dates.days_since(F.col("app_date"), preset.REFERENCE_DATE).alias("days"))


@query("term_months", with_loans(f"select src_ord, loan_term, {sql.TERM} as months from loans"))
def term_months(spark, sf_dir):
    return loans(spark, sf_dir).select(
        "src_ord", "loan_term", dates.months_of_term(F.col("loan_term")).alias("months"))
