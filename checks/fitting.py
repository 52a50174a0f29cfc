"""Imputation, derived columns, bins and encodings."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sql_parts as sql
from checks.cleaning import floats_to_doubles
from checks.loans import loans, with_loans
from checks.registry import query
from tabsmith.functions import numeric
from tabsmith.operators import fit as fitting
from tabsmith.operators import rows
from tabsmith.operators.selection import exact_medians
from tabsmith.plans import loan_features, loan_preset as preset
from tabsmith.session import stage, work_path


def cleaned(spark, sf_dir):
    return loan_features.clean(loans(spark, sf_dir), ["src_ord"])


def staged_and_fitted(spark, sf_dir):
    """The cleaned table, written once and read by every later pass, and its fitted state."""
    df = stage(cleaned(spark, sf_dir), "cleaned")
    return df, loan_features.fit(df)


def _as_rows(spark, values: dict, kind: str):
    return spark.createDataFrame(list(values.items()), kind)


_MEDIAN_ROWS = " union all ".join(
    f"select '{c}' as name, {c} as median from medians" for c in preset.NUMERIC_IMPUTED)


@query("impute_medians", sql.cleaned_sql(_MEDIAN_ROWS).replace(
    "\nselect", f", {sql.MEDIANS}\nselect", 1))
def impute_medians(spark, sf_dir):
    df = stage(cleaned(spark, sf_dir).select(*preset.NUMERIC_IMPUTED), "numbers")
    found = exact_medians(df, preset.NUMERIC_IMPUTED)
    return _as_rows(spark, {c: 0.0 if v is None else v for c, v in found.items()}, "name string, median double")


@query("impute_modes", with_loans(
    "select name, mode from modes", *sql.CLEAN_STEPS, sql.PAIRS, sql.MODES))
def impute_modes(spark, sf_dir):
    return fitting.modes(fitting.value_counts(cleaned(spark, sf_dir), preset.CATEGORICAL_IMPUTED))


@query("value_counts", with_loans("select name, value, n from pairs", *sql.CLEAN_STEPS, sql.PAIRS))
def value_counts(spark, sf_dir):
    return fitting.value_counts(cleaned(spark, sf_dir), preset.CATEGORICAL_IMPUTED)


@query("sample_fraction", with_loans("""
select src_ord, loan_id, credit_score from loans
where cast('0x' || substr(md5('42:' || loan_id), 1, 8) as bigint) < 1288490188"""))
def sample_fraction(spark, sf_dir):
    df = loans(spark, sf_dir).select("src_ord", "loan_id", "credit_score")
    return rows.sample_by_key(df, "loan_id", 0.3)


@query("fill_missing", with_loans(
    "select loan_id, " + ", ".join(preset.NUMERIC_IMPUTED + preset.CATEGORICAL_IMPUTED) + " from filled",
    *sql.FIT_STEPS))
def fill_missing(spark, sf_dir):
    df, state = staged_and_fitted(spark, sf_dir)
    filled = fitting.fill_missing(df, state.fill_values())
    return filled.select("loan_id", *preset.NUMERIC_IMPUTED, *preset.CATEGORICAL_IMPUTED).transform(
        floats_to_doubles)


_RATIOS = ["debt_to_income", "loan_to_income", "loan_to_value", "savings_to_loan", "balance_to_expenses",
           "payment_per_month", "payment_burden"]
_LINEAR = ["total_income", "monthly_surplus", "total_debt_exposure", "income_per_dependent", "has_other_income"]
_BINS = ["credit_score_bin", "age_bin"]


def _derived_sql(names: list[str]) -> str:
    # over the cleaned table, not the filled one, so that missing values reach the expressions
    return sql.cleaned_sql(
        "select loan_id, " + ", ".join(f"{sql.DERIVED[n]} as {n}" for n in names) + " from cleaned")


def _derived(spark, sf_dir, names):
    derived = loan_features.derived_columns()
    return cleaned(spark, sf_dir).select("loan_id", *[derived[n].alias(n) for n in names])


@query("safe_ratios", _derived_sql(_RATIOS))
def safe_ratios(spark, sf_dir):
    return _derived(spark, sf_dir, _RATIOS)


@query("linear_features", _derived_sql(_LINEAR))
def linear_features(spark, sf_dir):
    return _derived(spark, sf_dir, _LINEAR)


@query("bin_right_closed", with_loans(
    f"select src_ord, {sql.bins('credit_score', preset.CREDIT_SCORE_EDGES)} as credit_score_bin, "
    f"{sql.bins('applicant_age', preset.AGE_EDGES)} as age_bin from loans"))
def bin_right_closed(spark, sf_dir):
    return loans(spark, sf_dir).select(
        "src_ord",
        numeric.right_closed_bin(F.col("credit_score"), preset.CREDIT_SCORE_EDGES).alias("credit_score_bin"),
        numeric.right_closed_bin(F.col("applicant_age"), preset.AGE_EDGES).alias("age_bin"),
    )


@query("binary_target", with_loans(
    "select src_ord, case when loan_status = 'Default' then 1 else 0 end as target from loans"))
def binary_target(spark, sf_dir):
    return loans(spark, sf_dir).select("src_ord", loan_features.target_column().alias("target"))


@query("ordinal_encode", sql.cleaned_sql(
    f"select loan_id, {sql.EDUCATION_ORDINAL} as education_ordinal from cleaned"))
def ordinal_encode(spark, sf_dir):
    return cleaned(spark, sf_dir).select("loan_id", loan_features.education_ordinal().alias("education_ordinal"))


@query("label_maps", with_loans(
    "select name, value, cast(code as bigint) as code from codes", *sql.CLEAN_STEPS, sql.PAIRS, sql.CODES))
def label_maps(spark, sf_dir):
    path = work_path(spark, "state")
    fitting.fit(cleaned(spark, sf_dir), encoded=preset.LABEL_ENCODED).save(spark, path)
    return fitting.FitState.load(spark, path).codes


_ENCODED_SQL = ", ".join(
    f"cast((select code from codes where name = '{c}' and value = f.{c}) as double) as {c}_encoded"
    for c in preset.LABEL_ENCODED)


@query("label_encode", with_loans(
    f"select loan_id, {_ENCODED_SQL} from cleaned f", *sql.CLEAN_STEPS, sql.PAIRS, sql.CODES))
def label_encode(spark, sf_dir):
    df = stage(cleaned(spark, sf_dir).select("loan_id", *preset.LABEL_ENCODED), "labels")
    state = fitting.fit(df, encoded=preset.LABEL_ENCODED)
    encoded = fitting.encode_labels(df, state)
    return encoded.select("loan_id", *[f"{c}_encoded" for c in preset.LABEL_ENCODED]).transform(floats_to_doubles)


def _feature_sql() -> str:
    exprs = {c: f"f.{c}" for c in preset.NUMERIC_IMPUTED + preset.INT_FEATURES}
    exprs.update(sql.DERIVED)
    exprs.update({
        f"{c}_encoded": f"(select code from codes where name = '{c}' and value = f.{c})"
        for c in preset.LABEL_ENCODED})
    whole = {preset.TARGET, *preset.INT_FEATURES, *preset.FLAG_FEATURES}
    columns = ["case when loan_status = 'Default' then 1 else 0 end as target"]
    columns += [
        f"cast({exprs[c]} as int) as {c}" if c in whole else f"cast(cast({exprs[c]} as float) as double) as {c}"
        for c in preset.FEATURES]
    return sql.fitted_sql("select " + ", ".join(columns) + " from filled f")


@query("feature_table", _feature_sql())
def feature_table(spark, sf_dir):
    df, state = staged_and_fitted(spark, sf_dir)
    features = floats_to_doubles(loan_features.transform(df, state))
    small = [c for c, t in features.dtypes if t == "tinyint"]
    return features.withColumns({c: F.col(c).cast("int") for c in small})
