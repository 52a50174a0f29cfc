"""The dirty `loans` table that the checks run on, derived from orders and customer.

Every expression uses integer arithmetic and string functions that Spark SQL
and DuckDB spell the same way, so one text serves both engines.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# name | type | expression. U<s> is a draw in 0..999; P(<s>;a|b|c) picks one item, ~ is an apostrophe.
# The spellings are fixed values.
_SPEC = r"""
loan_id	string	concat('LN-', lpad(cast(k as string), 10, '0'))
applicant_age	double	case when U1 < 30 then null when U1 < 35 then cast(P(1;-1|0|150|200|999) as double) else 18e0 + (k*37 % 530)/1e1 end
gender	string	P(2;Male|Female|male|female|M|F|MALE|FEMALE|| Male |  f|nan|None |N/A|-)
marital_status	string	P(3;Single|Married|Divorced|Widowed|single|MARRIED|divorced|Maried|Sep|Separated|| single |NONE|na)
education_level	string	P(4;High School|Bachelor~s|Master~s|PhD|Bachelors|bachelor~s|masters|high school|Doctorate|phd|Associate~s|associates|)
dependents	string	P(5;0|1|2|3|4|5+|3+||two|-1)
employment_type	string	P(15;Salaried|Self-Employed|Business|Freelancer|salaried|self_employed|SALARIED|Govt|Government|Retired|Unemployed|)
employer_name	string	P(16;Acme|Globex|Initech|Self|self|N/A|NA|-||Freelance|State Govt)
years_at_current_job	double	case when U17 < 50 then null when U17 < 60 then cast(P(17;-2|75|100) as double) else (k*13 % 400)/1e1 end
annual_income	double	case when U7 < 40 then null when U7 < 48 then cast(P(7;0|-1) as double) else tp / 4e0 end
other_income	double	case when U18 < 80 then null when U18 < 380 then cast(k*19 % 9000 as double) else 0e0 end
credit_score	double	case when U6 < 80 then null when U6 < 90 then cast(P(6;0|200|900|999|-1) as double) else cast(300 + k*53 % 551 as double) end
num_existing_loans	double	case when U19 < 30 then null else cast(k*7 % 9 as double) end
num_defaults_last_5y	int	cast(case when U20 < 650 then 0 when U20 < 830 then 1 when U20 < 910 then 2 when U20 < 950 then 3 when U20 < 980 then 5 else 10 end as int)
num_credit_inquiries	int	cast(k*3 % 11 as int)
credit_utilization_pct	double	case when U21 < 40 then null when U21 < 60 then 100e0 + k % 100 else (k*17 % 1000)/1e1 end
loan_amount	double	case when U8 < 20 then null else tp / 1e1 end
loan_purpose	string	P(22;Home|Car|Education|Personal|Debt Consolidation|home|HOME|car_loan|Car Loan|education|Medical|medical|Wedding|Business|Other)
loan_term	string	case when U10 < 20 then '' when U10 < 50 then concat(P(10;1|2|3|5|10),' years') else P(10;12|24|36|48|60|84|120|180|240|360) end
interest_rate	double	case when U23 < 30 then null when U23 < 35 then cast(P(23;0.0|-1.5|99.9) as double) else 3e0 + (k*29 % 2200)/1e2 end
bank_balance	double	case when U24 < 50 then null when U24 < 60 then -500e0 else c_acctbal end
monthly_expenses	double	case when U25 < 40 then null else 500e0 + k*23 % 4000 end
existing_emi	double	case when U9 < 60 then null else cast(k*11 % 900 as double) end
savings_balance	double	case when U26 < 70 then null else cast(k*41 % 30000 as double) end
property_value	double	case when U27 < 300 then null else tp * 2e0 end
property_type	string	P(28;Apartment|House|Condo|Townhouse|apartment|HOUSE|condo|)
city	string	P(29; New York |none|New York|Los Angeles|Chicago|Houston|new york|San Francsico|Dallas|Austin|Nashvile|Seattle|Denver|Boston)
state	string	P(30;NY|CA|IL|TX|AZ|FL|New York|California|ca|texas| ny |nan|none)
zip_code	string	case when U12 < 40 then '' when U12 < 90 then cast(1000 + k % 9000 as string) when U12 < 120 then 'abcde' when U12 < 150 then concat(cast(10000 + k % 90000 as string),'.0') else cast(10000 + k*7 % 90000 as string) end
application_date	string	case when U11 < 20 then P(11;31/02/2022|not available|N/A|) else case U11 % 4 when 0 then concat(y,'-',m,'-',d) when 1 then concat(m,'/',d,'/',y) when 2 then concat(d,'-',m,'-',y) else concat(d,' ',split_part('Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec','|',cast(m as int)),' ',y) end end
application_channel	string	P(31;Online|Branch|Mobile App|online|BRANCH|mobile|)
has_co_applicant	string	P(32;Yes|No|yes|no|Y|N|1|0|)
phone_number	string	case when U33 < 50 then '' else concat(cast(200 + k % 800 as string),'-',cast(100 + k*7 % 900 as string),'-',cast(1000 + k*13 % 9000 as string)) end
loan_status	string	case when U13 < 80 then 'Current' when U14 < 150 + (case when k*53 % 551 < 200 then 100 else 0 end) then 'Default' else 'Paid' end
src_ord	bigint	k * 2
"""


def _draw(match: re.Match) -> str:
    s = int(match.group(1))
    return f"((((k % 100003) * {7919 + 2000 * s} + {s * 15485863}) % 100003) % 1000)"


def _pick(match: re.Match) -> str:
    s, items = match.group(1), match.group(2)
    n = items.count("|") + 1
    return f"replace(split_part('{items}', '|', cast(U{s} % {n} + 1 as int)), '~', chr(39))"


def _columns() -> list[tuple[str, str]]:
    out = []
    for line in _SPEC.strip().split("\n"):
        name, kind, expr = line.split("\t")
        expr = re.sub(r"P\((\d+);([^)]*)\)", _pick, expr)
        expr = re.sub(r"\bU(\d+)\b", _draw, expr)
        out.append((name, f"cast({expr} as {kind})"))
    return out


def spellings(column: str) -> list[str]:
    """What a text column of the loans may hold."""
    line = next(x for x in _SPEC.strip().split("\n") if x.startswith(column + "\t"))
    return [x.replace("~", "'") for x in re.search(r"P\(\d+;([^)]*)\)", line).group(1).split("|")]


COLUMNS = _columns()
RAW_NAMES = [name for name, _ in COLUMNS if name != "src_ord"]

_BASE = """
  select o_orderkey as k, o_totalprice as tp, c_acctbal,
         cast(year(o_orderdate) as string) as y,
         lpad(cast(month(o_orderdate) as string), 2, '0') as m,
         lpad(cast(day(o_orderdate) as string), 2, '0') as d
  from orders join customer on o_custkey = c_custkey
"""
_BLANKS = {"phone_number": 600, "employer_name": 1000}


#: The table comes as one small file; its rows are dealt out by hand.
_PARTITIONS = 8


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate").repartition(_PARTITIONS)
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    base = spark.sql(
        _BASE.replace("from orders join customer", "from {orders} join {customer}"),
        orders=orders, customer=customer,
    )
    clean = base.selectExpr(*[f"{e} as {n}" for n, e in COLUMNS])
    # one pass makes both the row and its copy, where a union would scan and join twice
    copies = F.when(F.expr("src_ord % 200 = 14"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    both = clean.withColumn("copy", F.explode(copies))
    blanked = {
        name: F.when(F.expr(f"copy = 1 and src_ord % {step} = 14"), "").otherwise(F.col(name))
        for name, step in _BLANKS.items()
    }
    return both.withColumns({**blanked, "src_ord": F.expr("src_ord + copy")}).drop("copy")


def _loans_sql() -> str:
    first = ", ".join(f"{e} as {n}" for n, e in COLUMNS)
    second = ", ".join(
        f"case when src_ord % {_BLANKS[n]} = 14 then '' else {n} end as {n}" if n in _BLANKS
        else "src_ord + 1 as src_ord" if n == "src_ord" else n
        for n, _ in COLUMNS
    )
    return (
        f"base as ({_BASE}), first_loans as (select {first} from base), "
        f"loans as (select * from first_loans union all "
        f"select {second} from first_loans where src_ord % 200 = 14)"
    )


LOANS_SQL = _loans_sql()


def with_loans(sql: str, *ctes: str) -> str:
    """`sql` with `loans`, and the given further `name as (…)` parts, in front."""
    return "with " + ", ".join([LOANS_SQL, *ctes]) + "\n" + sql
