"""Raw loans to the feature table: clean, fit, derive and encode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabsmith.functions import dates, numeric, text
from tabsmith.operators import fit as fitting
from tabsmith.operators import rows
from tabsmith.plans import loan_preset as preset
from tabsmith.sources.tables import POSITION


def _clean_text(c: str) -> Column:
    mapped = {
        "gender": preset.GENDER, "marital_status": preset.MARITAL_STATUS,
        "education_level": preset.EDUCATION, "employment_type": preset.EMPLOYMENT,
        "loan_purpose": preset.PURPOSE, "property_type": preset.PROPERTY,
        "application_channel": preset.CHANNEL,
    }
    if c in mapped:
        return text.normalize(F.col(c), mapped[c])
    if c == "has_co_applicant":
        return text.normalize(F.col(c), preset.YES_NO).cast("float")
    if c == "dependents":
        return text.normalize(F.col(c), preset.DEPENDENTS).cast("float")
    if c == "city":
        return text.replace_exact(F.col(c), preset.CITY_TYPOS)
    if c == "state":
        return text.normalize(F.col(c), preset.STATE_CODES, text.PLAIN_NULLS)
    valid = text.keep_matching(F.col(c), preset.ZIP_PATTERN)
    return text.strip_suffix_and_pad(valid, preset.ZIP_SUFFIX, preset.ZIP_WIDTH)


CLEANED_TEXT = [
    "gender", "marital_status", "education_level", "employment_type", "loan_purpose",
    "property_type", "application_channel", "has_co_applicant", "dependents", "city", "state",
    "zip_code",
]


def clean_columns() -> dict[str, Column]:
    """The cleaning expressions by column: text, numeric guards, date parts and the loan term."""
    out = {c: _clean_text(c) for c in CLEANED_TEXT}
    for c, (low, high) in preset.CLOSED_RANGES.items():
        out[c] = numeric.in_range(F.col(c), low, high)
    for c, (bound, inclusive) in preset.LOWER_BOUNDS.items():
        out[c] = numeric.above(F.col(c), bound, inclusive)
    for c, bound in preset.UPPER_CLIPS.items():
        out[c] = numeric.clip_upper(F.col(c), float(bound))
    for part, value in dates.date_parts(F.col("_date")).items():
        out[f"app_{part}"] = value.cast("float")
    out["app_days_since_ref"] = dates.days_since(F.col("_date"), preset.REFERENCE_DATE).cast("float")
    out["loan_term_months"] = dates.months_of_term(F.col("loan_term")).cast("float")
    return out


def clean_rows(df: DataFrame) -> DataFrame:
    """The row-wise part of cleaning; works on a stream too."""
    rows.require_columns(df, preset.RAW_COLUMNS)
    dated = df.withColumn("_date", dates.parse_dates(F.col("application_date"), preset.DATE_FORMATS, preset.DATE_BOUNDS))
    return dated.withColumns(clean_columns()).drop("_date", "application_date", "loan_term")


def clean(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    """One cleaned row per loan with a known outcome.

    Cleaning comes before deduplication: it works row by row, so the result is
    the same, and the shuffle then carries short canonical values. The label
    filter has to come after it, as a dropped copy may carry another label.
    `order` says which copy is first; without it, the position that read_table adds does.
    """
    by = order or [c for c in POSITION if c in df.columns]
    if not by:
        raise ValueError("which copy of a loan comes first? name columns in `order`, or read the table with position=True")
    cleaned = clean_rows(rows.drop_null_keys(df, [preset.KEY]))
    first = rows.first_per_key(cleaned, [preset.KEY], by)
    return rows.keep_values(first, preset.LABEL, preset.ALLOWED_LABELS).drop(*POSITION)


def fit(cleaned: DataFrame) -> fitting.FitState:
    return fitting.fit(cleaned, preset.NUMERIC_IMPUTED, preset.CATEGORICAL_IMPUTED, preset.LABEL_ENCODED)


def derived_columns() -> dict[str, Column]:
    """Ratios, sums, flags and bins over the imputed columns."""
    c = F.col
    ratio = numeric.safe_ratio
    income, emi, amount, term = c("annual_income"), c("existing_emi"), c("loan_amount"), c("loan_term_months")
    monthly = income / 12
    per_month = ratio(amount, term)
    return {
        "debt_to_income": ratio(emi * 12, income),
        "loan_to_income": ratio(amount, income),
        "total_income": income + F.coalesce(c("other_income"), F.lit(0.0)),
        "monthly_surplus": monthly - c("monthly_expenses") - emi,
        "loan_to_value": ratio(amount, c("property_value")),
        "income_per_dependent": F.when(c("dependents") >= 0, income / (c("dependents") + 1)).otherwise(income),
        "has_other_income": numeric.flag(c("other_income") > 0),
        "savings_to_loan": ratio(c("savings_balance"), amount),
        "balance_to_expenses": ratio(c("bank_balance"), c("monthly_expenses")),
        "total_debt_exposure": emi * term + amount,
        "credit_score_bin": numeric.right_closed_bin(c("credit_score"), preset.CREDIT_SCORE_EDGES),
        "age_bin": numeric.right_closed_bin(c("applicant_age"), preset.AGE_EDGES),
        "payment_per_month": per_month,
        "payment_burden": ratio(per_month, monthly),
    }


def target_column() -> Column:
    return numeric.flag(F.col(preset.LABEL) == preset.POSITIVE_LABEL)


def education_ordinal() -> Column:
    order = {v: i for i, v in enumerate(preset.EDUCATION_ORDER)}
    return F.element_at(text.literal_map(order), F.col("education_level"))


def transform(cleaned: DataFrame, state: fitting.FitState) -> DataFrame:
    """The feature table, target first. Stateless once fitted, so it works on a stream too."""
    filled = fitting.fill_missing(cleaned, state.fill_values())
    derived = filled.withColumns(
        {
            **derived_columns(),
            preset.TARGET: target_column(),
            "education_ordinal": education_ordinal(),
        }
    )
    encoded = fitting.encode_labels(derived, state)
    kinds = {
        **{c: "int" for c in preset.INT_FEATURES},
        **{c: "tinyint" for c in [preset.TARGET, *preset.FLAG_FEATURES]},
    }
    return encoded.select(
        *[F.col(c).cast(kinds.get(c, "float")).alias(c) for c in [preset.TARGET, *preset.FEATURES]]
    )


def risk_score(credit_score: Column, annual_income: Column) -> Column:
    """The chance of default that the synthetic label is drawn from."""

    def shift(x: Column, p: dict) -> Column:
        return numeric.clip((F.lit(p["centre"]) - F.coalesce(x, F.lit(p["default"]))) / p["scale"], p["low"], p["high"])

    raw = F.lit(preset.RISK_BASE) + shift(credit_score, preset.RISK_SCORE) + shift(annual_income, preset.RISK_INCOME)
    return numeric.clip(raw, preset.RISK_LOW, preset.RISK_HIGH)
