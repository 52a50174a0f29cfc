import datetime
import string

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from checks.loans import spellings
from tabsmith.functions import dates, numeric, text
from tabsmith.plans import loan_preset as preset

MAPPED = {
    "gender": preset.GENDER, "marital_status": preset.MARITAL_STATUS, "education_level": preset.EDUCATION,
    "employment_type": preset.EMPLOYMENT, "loan_purpose": preset.PURPOSE, "property_type": preset.PROPERTY,
    "application_channel": preset.CHANNEL, "has_co_applicant": preset.YES_NO,
}
NULL_TOKENS = {"", "nan", "none", "n/a", "na", "-"}


def test_normalize_edges(values):
    data = [" M ", "\tfemale\n", "\xa0Male ", "N/A", "-", "None", "", "other", None, "FEMALE"]
    got = values(lambda c: text.normalize(c, preset.GENDER), data, "string")
    assert got == ["male", "female", "male", None, None, None, None, None, None, "female"]


@pytest.mark.parametrize("name", MAPPED)
def test_every_spelling_maps(values, name):
    variants = spellings(name)
    got = values(lambda c: text.normalize(c, MAPPED[name]).cast("string"), variants, "string")
    assert [v for v, g in zip(variants, got) if g is None] == [v for v in variants if v.strip().lower() in NULL_TOKENS]


def test_null_tokens_win_over_the_mapping(values):
    assert values(lambda c: text.normalize(c, {"na": "x", "b": "y"}), ["NA", "b"], "string") == [None, "y"]


def test_dependents(values):
    got = values(lambda c: text.normalize(c, preset.DEPENDENTS), ["two", "3+", "5+", "-1", "0", "7", ""], "string")
    assert got == [2, 3, 5, None, 0, None, None]


def test_states_and_cities(values):
    states = ["NY", "tn", " Md ", "New York", "California", "ca", "texas", "none"]
    got = values(lambda c: text.normalize(c, preset.STATE_CODES, text.PLAIN_NULLS), states, "string")
    assert got == ["NY", "TN", "MD", "NY", "CA", "CA", "TX", None]
    cities = ["San Francsico", " Nashvile ", "Boston", "", "nan", "N/A", None, "\tYork\t"]
    got = values(lambda c: text.replace_exact(c, preset.CITY_TYPOS), cities, "string")
    assert got == ["san francisco", "nashville", "boston", None, None, "n/a", None, "york"]


def test_zip_codes(values):
    data = ["12345.0", " 01234 ", "1234", "123456", "abcde", "", None, "12345.00"]

    def clean(c):
        return text.strip_suffix_and_pad(text.keep_matching(c, preset.ZIP_PATTERN), preset.ZIP_SUFFIX, 5)

    assert values(clean, data, "string") == ["12345", "01234", None, None, None, None, None, None]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=string.printable + "\xa0 \x85é", max_size=8), min_size=1, max_size=40))
def test_strip_is_pythons(values, data):
    assert values(text.strip, data, "string") == [s.strip() for s in data]


def test_to_number(values):
    data = ["12", "-1.5", ".5", "1e3", "12d", "1.5f", "abc", "", " 7", None, "5.", "1e"]
    assert values(text.to_number, data, "string") == [12, -1.5, 0.5, 1000, None, None, None, None, None, None, 5, None]


def test_guards(values):
    data = [18.0, 100.0, 17.99, 101.0, 999.0, None, float("nan")]
    got = values(lambda c: numeric.in_range(numeric.nan_to_null(c), 18, 100), data, "double")
    assert got == [18, 100, None, None, None, None, None]
    assert values(lambda c: numeric.above(c, 0), [0.0, 0.1, None], "double") == [None, 0.1, None]
    assert values(lambda c: numeric.above(c, 0, True), [0.0, -0.1], "double") == [0.0, None]
    assert values(lambda c: numeric.clip_upper(c, 100.0), [150.0, None, -5.0, 100.0], "double") == [100, None, -5, 100]


def test_bins_are_closed_on_the_right(values):
    data = [0.0, 580.0, 581.0, 670.0, 740.0, 800.0, 850.0, 851.0, -1.0, None]
    got = values(lambda c: numeric.right_closed_bin(c, preset.CREDIT_SCORE_EDGES), data, "double")
    assert got == [0, 0, 1, 1, 2, 3, 4, None, None, None]


def test_ratio_and_flag(values):
    assert values(lambda c: numeric.safe_ratio(F.lit(6.0), c), [2.0, 0.0, -2.0, None], "double") == [3, None, None, None]
    assert values(lambda c: numeric.flag(c > 0), [1.0, 0.0, None], "double") == [1, 0, 0]


def test_dates(values):
    day = datetime.date(2020, 1, 5)
    data = ["2020-1-5", "1/5/2020", "05-01-2020", "05 JAN 2020", "5  Jan 2020"]
    assert values(lambda c: dates.parse_dates(c, preset.DATE_FORMATS, preset.DATE_BOUNDS), data, "string") == [day] * 5
    bad = ["31/02/2022", "2020-02-30", "not available", "5 January 2020", "", None, "2020-01-05 ", "05 Xyz 2020",
           "0001-01-01", "13/13/2020"]
    assert values(lambda c: dates.parse_dates(c, preset.DATE_FORMATS, preset.DATE_BOUNDS), bad, "string") == [None] * len(bad)


def test_dates_without_bounds(values):
    got = values(lambda c: dates.parse_dates(c, preset.DATE_FORMATS), ["0001-01-01", "9999-12-31"], "string")
    assert got == [datetime.date(1, 1, 1), datetime.date(9999, 12, 31)]


def test_first_format_that_fits_wins(values):
    got = values(lambda c: dates.parse_dates(c, ["%m/%d/%Y", "%d/%m/%Y"]), ["02/03/2020", "13/02/2020"], "string")
    assert got == [datetime.date(2020, 2, 3), datetime.date(2020, 2, 13)]


def test_date_parts(spark):
    df = spark.sql("select date '2020-01-06' as d union all select date '2023-12-31'").orderBy("d")
    rows = df.select(*[v.alias(k) for k, v in dates.date_parts(F.col("d")).items()],
                     dates.days_since(F.col("d"), "2020-01-01").alias("days")).collect()
    assert [tuple(r) for r in rows] == [(2020, 1, 0, 1, 5), (2023, 12, 6, 4, 1460)]


def test_terms(values):
    data = ["5 years", "36", "years", "abc", "12d", " 24 ", "1 YEAR", "", "nan", None, "10years"]
    assert values(dates.months_of_term, data, "string") == [60, 36, None, None, None, 24, 12, None, None, None, 120]
