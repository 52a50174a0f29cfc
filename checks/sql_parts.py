"""SQL text shared by the oracles: the same rules, written a second time for DuckDB."""

from __future__ import annotations

from checks.loans import with_loans
from tabsmith.plans import loan_preset as preset

MAPPED_NULLS = "('', 'nan', 'none', 'n/a', 'na', '-')"
PLAIN_NULLS = "('', 'nan', 'none')"


def text_of(column: str) -> str:
    return f"lower(trim({column}, chr(9) || chr(10) || chr(13) || ' '))"


def quote(value) -> str:
    if value is None:
        return "null"
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def mapped(column: str, mapping: dict, nulls: str = MAPPED_NULLS, kind: str = "varchar") -> str:
    key = text_of(column)
    whens = " ".join(f"when {quote(k)} then {quote(v)}" for k, v in mapping.items())
    return f"cast(case when {key} in {nulls} then null else case {key} {whens} end end as {kind})"


GENDER = mapped("gender", preset.GENDER)
MARITAL = mapped("marital_status", preset.MARITAL_STATUS)
EDUCATION = mapped("education_level", preset.EDUCATION)
EMPLOYMENT = mapped("employment_type", preset.EMPLOYMENT)
PURPOSE = mapped("loan_purpose", preset.PURPOSE)
PROPERTY = mapped("property_type", preset.PROPERTY)
CHANNEL = mapped("application_channel", preset.CHANNEL)
YES_NO = mapped("has_co_applicant", preset.YES_NO, kind="double")
DEPENDENTS = mapped("dependents", preset.DEPENDENTS, kind="double")
STATE = mapped("state", preset.STATE_CODES, PLAIN_NULLS)
CITY = (
    f"case when {text_of('city')} in {PLAIN_NULLS} then null "
    f"when {text_of('city')} = 'san francsico' then 'san francisco' "
    f"when {text_of('city')} = 'nashvile' then 'nashville' else {text_of('city')} end"
)
ZIP_VALID = "case when regexp_matches(trim(zip_code), '^[0-9]{5}([.]0)?$') then trim(zip_code) end"
ZIP = f"lpad(regexp_replace({ZIP_VALID}, '[.]0$', ''), 5, '0')"

AGE = "case when applicant_age >= 18 and applicant_age <= 100 then applicant_age end"
YEARS = "case when years_at_current_job >= 0 and years_at_current_job <= 50 then years_at_current_job end"
SCORE = "case when credit_score >= 300 and credit_score <= 850 then credit_score end"
RATE = "case when interest_rate >= 0.5 and interest_rate <= 50 then interest_rate end"
INCOME = "case when annual_income > 0 then annual_income end"
OTHER = "case when other_income >= 0 then other_income end"
BALANCE = "case when bank_balance > -10000 then bank_balance end"
UTILISATION = "case when credit_utilization_pct > 100 then 100e0 else credit_utilization_pct end"

DATE = (
    "cast(coalesce(try_strptime(application_date, '%Y-%m-%d'), try_strptime(application_date, '%m/%d/%Y'), "
    "try_strptime(application_date, '%d-%m-%Y'), try_strptime(application_date, '%d %b %Y')) as date)"
)
NUMBER = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
TERM = (
    f"case when {text_of('loan_term')} in {PLAIN_NULLS} then null "
    f"when contains({text_of('loan_term')}, 'year') "
    f"then try_cast(regexp_extract({text_of('loan_term')}, '([0-9]+)', 1) as double) * 12 "
    f"when regexp_matches({text_of('loan_term')}, '{NUMBER}') then try_cast({text_of('loan_term')} as double) end"
)

_UNTOUCHED = (
    "num_existing_loans, num_defaults_last_5y, num_credit_inquiries, loan_amount, monthly_expenses, "
    "existing_emi, savings_balance, property_value, employer_name, phone_number, loan_status, src_ord"
)

DEDUPED = (
    "deduped as (select * exclude (rn) from (select *, row_number() over "
    "(partition by loan_id order by src_ord) as rn from loans where loan_id is not null) where rn = 1)"
)
CLEANED = f"""cleaned as (
  select loan_id, {AGE} as applicant_age, {GENDER} as gender, {MARITAL} as marital_status,
    {EDUCATION} as education_level, {DEPENDENTS} as dependents, {EMPLOYMENT} as employment_type,
    {YEARS} as years_at_current_job, {INCOME} as annual_income, {OTHER} as other_income,
    {SCORE} as credit_score, {UTILISATION} as credit_utilization_pct, {PURPOSE} as loan_purpose,
    {RATE} as interest_rate, {BALANCE} as bank_balance, {PROPERTY} as property_type, {CITY} as city,
    {STATE} as state, {ZIP} as zip_code, {CHANNEL} as application_channel, {YES_NO} as has_co_applicant,
    {_UNTOUCHED},
    cast(year({DATE}) as double) as app_year, cast(month({DATE}) as double) as app_month,
    cast(isodow({DATE}) - 1 as double) as app_day_of_week, cast(quarter({DATE}) as double) as app_quarter,
    cast(date_diff('day', date '2020-01-01', {DATE}) as double) as app_days_since_ref,
    {TERM} as loan_term_months
  from deduped where loan_status in ('Default', 'Paid'))"""

MEDIAN_EXPRS = ", ".join(f"coalesce(median({c}), 0e0) as {c}" for c in preset.NUMERIC_IMPUTED)
MEDIANS = f"medians as (select {MEDIAN_EXPRS} from cleaned)"
PAIRS = "pairs as (" + " union all ".join(
    f"select '{c}' as name, {c} as value, count(*) as n from cleaned where {c} is not null group by {c}"
    for c in preset.CATEGORICAL_IMPUTED
) + ")"
MODES = (
    "modes as (select name, value as mode from (select *, row_number() over "
    "(partition by name order by n desc, value) as rn from pairs) where rn = 1)"
)
CODES = (
    "codes as (select name, value, dense_rank() over (partition by name order by value) - 1 as code from pairs "
    "where name in (" + ", ".join(f"'{c}'" for c in preset.LABEL_ENCODED) + "))"
)
_FILLED_NUMBERS = ", ".join(f"coalesce(c.{n}, m.{n}) as {n}" for n in preset.NUMERIC_IMPUTED)
_FILLED_TEXTS = ", ".join(
    f"coalesce(c.{n}, (select mode from modes where name = '{n}'), 'unknown') as {n}"
    for n in preset.CATEGORICAL_IMPUTED
)
FILLED = (
    f"filled as (select c.loan_id, c.loan_status, c.num_defaults_last_5y, c.num_credit_inquiries, "
    f"{_FILLED_NUMBERS}, {_FILLED_TEXTS} from cleaned c, medians m)"
)


def ratio(a: str, b: str) -> str:
    return f"case when {b} > 0 then {a} / {b} end"


def bins(x: str, edges: list) -> str:
    whens = " ".join(f"when {x} <= {e} then {i}" for i, e in enumerate(edges[1:]))
    return f"case when {x} < {edges[0]} or {x} > {edges[-1]} then null {whens} end"


EDUCATION_ORDINAL = (
    "case education_level when 'high_school' then 0 when 'associates' then 1 when 'bachelors' then 2 "
    "when 'masters' then 3 when 'doctorate' then 4 end"
)
DERIVED = {
    "debt_to_income": ratio("(existing_emi * 12)", "annual_income"),
    "loan_to_income": ratio("loan_amount", "annual_income"),
    "total_income": "annual_income + coalesce(other_income, 0)",
    "monthly_surplus": "annual_income / 12 - monthly_expenses - existing_emi",
    "loan_to_value": ratio("loan_amount", "property_value"),
    "income_per_dependent": "case when dependents >= 0 then annual_income / (dependents + 1) else annual_income end",
    "has_other_income": "case when other_income > 0 then 1 else 0 end",
    "savings_to_loan": ratio("savings_balance", "loan_amount"),
    "balance_to_expenses": ratio("bank_balance", "monthly_expenses"),
    "total_debt_exposure": "existing_emi * loan_term_months + loan_amount",
    "credit_score_bin": bins("credit_score", preset.CREDIT_SCORE_EDGES),
    "age_bin": bins("applicant_age", preset.AGE_EDGES),
    "payment_per_month": ratio("loan_amount", "loan_term_months"),
    "payment_burden": ratio("(" + ratio("loan_amount", "loan_term_months") + ")", "(annual_income / 12)"),
    "education_ordinal": EDUCATION_ORDINAL,
}

CLEAN_STEPS = (DEDUPED, CLEANED)
FIT_STEPS = (*CLEAN_STEPS, MEDIANS, PAIRS, MODES, CODES, FILLED)


def cleaned_sql(sql: str) -> str:
    return with_loans(sql, *CLEAN_STEPS)


def fitted_sql(sql: str) -> str:
    return with_loans(sql, *FIT_STEPS)
