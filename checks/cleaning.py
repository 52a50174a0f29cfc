"""Row cleaning: keys, labels, text, numeric guards."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sql_parts as sql
from checks.loans import loans, with_loans
from checks.registry import query
from tabsmith.functions import numeric, text
from tabsmith.operators import rows
from tabsmith.plans import loan_features, loan_preset as preset
from tabsmith.session import work_path
from tabsmith.sources import tables


@query("dedup_first", with_loans(
    "select loan_id, src_ord, phone_number, employer_name, loan_status from deduped", sql.DEDUPED))
def dedup_first(spark, sf_dir):
    df = rows.first_per_key(loans(spark, sf_dir), ["loan_id"], ["src_ord"])
    return df.select("loan_id", "src_ord", "phone_number", "employer_name", "loan_status")


# the fixture has no null keys, so blank every key whose loan has no phone number
_NULL_KEY = "case when phone_number = '' then null else loan_id end as loan_id"


@query("drop_null_key", with_loans(
    f"select * from (select {_NULL_KEY}, src_ord from loans) where loan_id is not null"))
def drop_null_key(spark, sf_dir):
    df = loans(spark, sf_dir).selectExpr(_NULL_KEY, "src_ord")
    return rows.drop_null_keys(df, ["loan_id"])


@query("filter_labels", with_loans(
    "select loan_id, src_ord, loan_status from loans where loan_status in ('Default', 'Paid')"))
def filter_labels(spark, sf_dir):
    df = loans(spark, sf_dir).select("loan_id", "src_ord", "loan_status")
    return rows.keep_values(df, "loan_status", preset.ALLOWED_LABELS)


@query("normalize_map", with_loans(
    f"select src_ord, {sql.GENDER} as gender, {sql.EDUCATION} as education_level from loans"))
def normalize_map(spark, sf_dir):
    return loans(spark, sf_dir).select(
        "src_ord",
        text.normalize(F.col("gender"), preset.GENDER).alias("gender"),
        text.normalize(F.col("education_level"), preset.EDUCATION).alias("education_level"),
    )


def _register_column(name: str, column: str, sql_expr: str, expr) -> None:
    """A query that shows one raw column next to its cleaned value."""

    @query(name, with_loans(f"select src_ord, {column} as raw, {sql_expr} as cleaned from loans"))
    def run(spark, sf_dir):
        return loans(spark, sf_dir).select(
            "src_ord", F.col(column).alias("raw"), expr(F.col(column)).alias("cleaned")
        )


for _name, _column, _sql, _mapping in (
    ("normalize_gender", "gender", sql.GENDER, preset.GENDER),
    ("normalize_marital", "marital_status", sql.MARITAL, preset.MARITAL_STATUS),
    ("normalize_education", "education_level", sql.EDUCATION, preset.EDUCATION),
    ("normalize_employment", "employment_type", sql.EMPLOYMENT, preset.EMPLOYMENT),
    ("normalize_purpose", "loan_purpose", sql.PURPOSE, preset.PURPOSE),
    ("normalize_property", "property_type", sql.PROPERTY, preset.PROPERTY),
    ("normalize_channel", "application_channel", sql.CHANNEL, preset.CHANNEL),
):
    _register_column(_name, _column, _sql, lambda c, m=_mapping: text.normalize(c, m))

_register_column("map_yes_no", "has_co_applicant", sql.YES_NO,
                 lambda c: text.normalize(c, preset.YES_NO).cast("double"))
_register_column("map_dependents", "dependents", sql.DEPENDENTS,
                 lambda c: text.normalize(c, preset.DEPENDENTS).cast("double"))
_register_column("fix_city_typos", "city", sql.CITY, lambda c: text.replace_exact(c, preset.CITY_TYPOS))
_register_column("state_code", "state", sql.STATE,
                 lambda c: text.normalize(c, preset.STATE_CODES, text.PLAIN_NULLS))
_register_column("zip_validate", "zip_code", sql.ZIP_VALID,
                 lambda c: text.keep_matching(c, preset.ZIP_PATTERN))
_register_column("zip_clean", "zip_code", sql.ZIP, lambda c: text.strip_suffix_and_pad(
    text.keep_matching(c, preset.ZIP_PATTERN), preset.ZIP_SUFFIX, preset.ZIP_WIDTH))
_register_column("clip_upper", "credit_utilization_pct", sql.UTILISATION,
                 lambda c: numeric.clip_upper(c, 100.0))
# text of every shape: plain numbers, `12345.0`, letters, `3+`, blanks
_register_column("coerce_numeric", "zip_code",
                 f"case when regexp_matches(zip_code, '{sql.NUMBER}') then try_cast(zip_code as double) end",
                 text.to_number)


@query("range_guard", with_loans(
    f"select src_ord, {sql.AGE} as applicant_age, {sql.YEARS} as years_at_current_job, "
    f"{sql.SCORE} as credit_score, {sql.RATE} as interest_rate from loans"))
def range_guard(spark, sf_dir):
    return loans(spark, sf_dir).select("src_ord", *[
        numeric.in_range(F.col(c), low, high).alias(c) for c, (low, high) in preset.CLOSED_RANGES.items()
    ])


@query("bound_guard", with_loans(
    f"select src_ord, {sql.INCOME} as annual_income, {sql.OTHER} as other_income, "
    f"{sql.BALANCE} as bank_balance from loans"))
def bound_guard(spark, sf_dir):
    return loans(spark, sf_dir).select("src_ord", *[
        numeric.above(F.col(c), bound, inclusive).alias(c)
        for c, (bound, inclusive) in preset.LOWER_BOUNDS.items()
    ])


@query("clean_table", sql.cleaned_sql("select * from cleaned"))
def clean_table(spark, sf_dir):
    return loan_features.clean(loans(spark, sf_dir), ["src_ord"]).transform(floats_to_doubles)


def _read_in_order(spark, sf_dir, kind):
    """The cleaned table of a written one, by the order in which its rows are read."""
    path = f"{work_path(spark, 'raw')}.{kind}"
    # as many ranges as the shuffle gives, so that no writer takes a share that grows with the table
    ordered = loans(spark, sf_dir).repartitionByRange("src_ord").sortWithinPartitions("src_ord")
    tables.write_table(ordered.select(*preset.RAW_COLUMNS), path, kind)
    raw = tables.read_table(spark, path, kind, preset.raw_schema(), position=True)
    return loan_features.clean(raw).select("loan_id", "loan_status", "city", "phone_number", "employer_name")


_FIRST_READ = sql.cleaned_sql(
    "select loan_id, loan_status, city, nullif(phone_number, '') as phone_number, nullif(employer_name, '') as employer_name from cleaned")


# CSV has no empty text, so both queries read it as missing
@query("dedup_default_parquet", _FIRST_READ)
def dedup_default_parquet(spark, sf_dir):
    texts = {c: F.nullif(F.col(c), F.lit("")) for c in ("phone_number", "employer_name")}
    return _read_in_order(spark, sf_dir, "parquet").withColumns(texts)


@query("dedup_default_csv", _FIRST_READ)
def dedup_default_csv(spark, sf_dir):
    return _read_in_order(spark, sf_dir, "csv")


def floats_to_doubles(df):
    """FLOAT columns as DOUBLE, the width that the SQL side is compared in."""
    return df.select(*[F.col(c).cast("double").alias(c) if t == "float" else c for c, t in df.dtypes])
