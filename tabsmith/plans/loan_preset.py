"""Fixed values of the loan table: names, lookup tables, bounds and column order."""

from __future__ import annotations

# Fixed values ---------------------------------------------------------------

RAW_TEXT_COLUMNS = [
    "loan_id", "gender", "marital_status", "education_level", "dependents", "employment_type",
    "employer_name", "loan_purpose", "loan_term", "property_type", "city", "state", "zip_code",
    "application_date", "application_channel", "has_co_applicant", "phone_number", "loan_status",
]
RAW_INT_COLUMNS = ["num_defaults_last_5y", "num_credit_inquiries"]
RAW_COLUMNS = [
    "loan_id", "applicant_age", "gender", "marital_status", "education_level",
    "dependents", "employment_type", "employer_name", "years_at_current_job",
    "annual_income", "other_income", "credit_score", "num_existing_loans",
    "num_defaults_last_5y", "num_credit_inquiries", "credit_utilization_pct",
    "loan_amount", "loan_purpose", "loan_term", "interest_rate",
    "bank_balance", "monthly_expenses", "existing_emi", "savings_balance",
    "property_value", "property_type", "city", "state", "zip_code",
    "application_date", "application_channel", "has_co_applicant",
    "phone_number", "loan_status",
]

KEY = "loan_id"
LABEL = "loan_status"
ALLOWED_LABELS = ["Default", "Paid"]
POSITIVE_LABEL = "Default"

GENDER = {"male": "male", "m": "male", "female": "female", "f": "female"}
MARITAL_STATUS = {
    "single": "single", "married": "married", "maried": "married", "divorced": "divorced",
    "widowed": "widowed", "sep": "separated", "separated": "separated",
}
EDUCATION = {
    "high school": "high_school", "bachelor's": "bachelors", "bachelors": "bachelors",
    "master's": "masters", "masters": "masters", "phd": "doctorate", "doctorate": "doctorate",
    "associate's": "associates", "associates": "associates",
}
EMPLOYMENT = {
    "salaried": "salaried", "self-employed": "self_employed", "self_employed": "self_employed",
    "business": "business", "freelancer": "freelancer", "freelance": "freelancer",
    "govt": "government", "government": "government", "retired": "retired",
    "unemployed": "unemployed",
}
PURPOSE = {
    "home": "home", "car": "car", "car_loan": "car", "car loan": "car", "education": "education",
    "personal": "personal", "debt consolidation": "debt_consolidation", "medical": "medical",
    "wedding": "wedding", "business": "business", "other": "other",
}
PROPERTY = {"apartment": "apartment", "house": "house", "condo": "condo", "townhouse": "townhouse"}
CHANNEL = {"online": "online", "branch": "branch", "mobile app": "mobile", "mobile": "mobile"}
YES_NO = {"yes": 1, "y": 1, "1": 1, "no": 0, "n": 0, "0": 0}
DEPENDENTS = {
    "0": 0, "1": 1, "2": 2, "two": 2, "3": 3, "3+": 3, "4": 4, "5+": 5, "-1": None,
}
STATE_CODES = {
    "new york": "NY", "california": "CA", "ca": "CA", "texas": "TX", "ny": "NY", "il": "IL",
    "tx": "TX", "az": "AZ", "fl": "FL", "oh": "OH", "nc": "NC", "in": "IN", "wa": "WA",
    "co": "CO", "ma": "MA", "or": "OR", "tn": "TN", "ga": "GA", "ky": "KY", "md": "MD",
    "wi": "WI", "pa": "PA", "mn": "MN",
}
CITY_TYPOS = {"san francsico": "san francisco", "nashvile": "nashville"}
EDUCATION_ORDER = ["high_school", "associates", "bachelors", "masters", "doctorate"]

ZIP_PATTERN = "^[0-9]{5}([.]0)?$"
ZIP_SUFFIX = "[.]0$"
ZIP_WIDTH = 5

CLOSED_RANGES = {
    "applicant_age": (18, 100), "years_at_current_job": (0, 50),
    "credit_score": (300, 850), "interest_rate": (0.5, 50),
}
LOWER_BOUNDS = {  # bound, whether the bound itself is valid
    "annual_income": (0, False), "other_income": (0, True), "bank_balance": (-10000, False),
}
UPPER_CLIPS = {"credit_utilization_pct": 100}

DATE_FORMATS = ["%Y-%m-%d", "%m/%d/%Y", "%d-%m-%Y", "%d %b %Y"]
# The dates a 64-bit count of nanoseconds can hold; others count as missing.
DATE_BOUNDS = ("1677-09-22", "2262-04-11")
REFERENCE_DATE = "2020-01-01"

CREDIT_SCORE_EDGES = [0, 580, 670, 740, 800, 850]
AGE_EDGES = [0, 25, 35, 45, 55, 65, 100]

NUMERIC_IMPUTED = [
    "applicant_age", "years_at_current_job", "annual_income", "other_income",
    "credit_score", "num_existing_loans", "credit_utilization_pct",
    "loan_amount", "interest_rate", "bank_balance", "monthly_expenses",
    "existing_emi", "savings_balance", "property_value",
    "has_co_applicant", "dependents", "loan_term_months",
    "app_year", "app_month", "app_day_of_week", "app_quarter", "app_days_since_ref",
]
CATEGORICAL_IMPUTED = [
    "gender", "marital_status", "education_level", "employment_type", "loan_purpose",
    "property_type", "application_channel", "city", "state", "zip_code",
]
LABEL_ENCODED = [
    "gender", "marital_status", "employment_type", "loan_purpose", "property_type",
    "application_channel", "city", "state",
]

TARGET = "target"
FEATURES = [
    "applicant_age", "dependents", "years_at_current_job", "annual_income", "other_income",
    "credit_score", "num_existing_loans", "num_defaults_last_5y", "num_credit_inquiries",
    "credit_utilization_pct", "loan_amount", "interest_rate", "bank_balance",
    "monthly_expenses", "existing_emi", "savings_balance", "property_value",
    "has_co_applicant", "app_year", "app_month", "app_day_of_week", "app_quarter",
    "app_days_since_ref", "loan_term_months", "debt_to_income", "loan_to_income",
    "total_income", "monthly_surplus", "loan_to_value", "income_per_dependent",
    "has_other_income", "savings_to_loan", "balance_to_expenses", "total_debt_exposure",
    "credit_score_bin", "age_bin", "payment_per_month", "payment_burden",
    "education_ordinal", "gender_encoded", "marital_status_encoded",
    "employment_type_encoded", "loan_purpose_encoded", "property_type_encoded",
    "application_channel_encoded", "city_encoded", "state_encoded",
]
INT_FEATURES = ["num_defaults_last_5y", "num_credit_inquiries"]
FLAG_FEATURES = ["has_other_income"]

# The chance of default: a base value, then how score and income move it.
RISK_BASE, RISK_LOW, RISK_HIGH = 0.15, 0.02, 0.60
RISK_SCORE = {"default": 600.0, "centre": 650.0, "scale": 1000.0, "low": -0.10, "high": 0.25}
RISK_INCOME = {"default": 50000.0, "centre": 50000.0, "scale": 500000.0, "low": -0.05, "high": 0.15}

# End of fixed values --------------------------------------------------------


def raw_schema() -> str:
    """The schema of the raw table, for readers that would otherwise have to infer it."""
    kinds = {
        **{c: "string" for c in RAW_TEXT_COLUMNS},
        **{c: "int" for c in RAW_INT_COLUMNS},
    }
    return ", ".join(f"{c} {kinds.get(c, 'double')}" for c in RAW_COLUMNS)


def feature_schema() -> str:
    """The schema of the feature table: the target, then the features in order."""
    kinds = {
        **{c: "int" for c in INT_FEATURES},
        **{c: "tinyint" for c in [TARGET, *FLAG_FEATURES]},
    }
    return ", ".join(f"{c} {kinds.get(c, 'float')}" for c in [TARGET, *FEATURES])
