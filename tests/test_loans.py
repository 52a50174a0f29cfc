import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from sf_paths import SF_DIR

from checks.loans import loans
from tabsmith.operators import rows, split
from tabsmith.plans import loan_features, loan_preset as preset, synthesis
from tabsmith.sources import tables

# What each encoded or bounded feature may hold.
RANGES = {
    "app_month": (1, 12), "app_day_of_week": (0, 6), "app_quarter": (1, 4), "loan_term_months": (12, 360), "credit_score_bin": (0, 4),
    "age_bin": (0, 5), "education_ordinal": (0, 4), "gender_encoded": (0, 1),
    "marital_status_encoded": (0, 4), "employment_type_encoded": (0, 6), "loan_purpose_encoded": (0, 8),
    "property_type_encoded": (0, 3), "application_channel_encoded": (0, 2), "credit_utilization_pct": (0, 100), "interest_rate": (3, 25),
}


@pytest.fixture(scope="module")
def raw(spark):
    """The derived loans, one row each."""
    ordered = loans(spark, SF_DIR.replace("0.001", "0.01"))
    return ordered.filter("src_ord % 2 = 0").select(*preset.RAW_COLUMNS).cache()


@pytest.fixture(scope="module")
def fitted(spark, raw):
    cleaned = loan_features.clean(raw, ["phone_number"]).cache()
    return cleaned, loan_features.fit(cleaned)


def test_feature_table(fitted):
    cleaned, state = fitted
    table = loan_features.transform(cleaned, state).cache()
    assert table.columns == ["target", *preset.FEATURES] and len(preset.FEATURES) == 47
    kinds = dict(table.dtypes)
    assert kinds["target"] == "tinyint" and kinds["num_credit_inquiries"] == "int"
    assert {kinds[c] for c in preset.FEATURES if c not in preset.INT_FEATURES + preset.FLAG_FEATURES} == {"float"}
    assert table.filter(" or ".join(f"{c} is null" for c in preset.NUMERIC_IMPUTED)).count() == 0
    bounds = table.agg(*[f(c).alias(n + c) for c in RANGES for n, f in (("l", F.min), ("h", F.max))]).first()
    for c, (low, high) in RANGES.items():
        assert low <= bounds["l" + c] and bounds["h" + c] <= high, c
    for c in preset.LABEL_ENCODED:
        codes = sorted(r[0] for r in table.select(f"{c}_encoded").distinct().collect())
        assert codes == [float(i) for i in range(state.sizes[c])], c


def test_copies_are_removed(spark, raw):
    copied = synthesis.inject_duplicates(
        raw.withColumn("ord", F.monotonically_increasing_id()), F.col("loan_id").endswith("7"),
        {"phone_number": F.col("loan_id").endswith("77")})
    ordered = copied.withColumn("ord", F.col("ord") * 2 + F.col("copy")).drop("copy")
    assert ordered.count() > raw.count()
    first = rows.first_per_key(ordered, ["loan_id"], ["ord"])
    assert first.drop("ord").exceptAll(raw).count() == 0 and first.count() == raw.count()


def test_label_filter_follows_deduplication(spark, raw):
    one = raw.filter("loan_status = 'Paid'").limit(1)
    two = one.withColumn("loan_status", F.lit("Current")).withColumn("ord", F.lit(1)).unionByName(
        one.withColumn("ord", F.lit(2)))
    assert loan_features.clean(two, ["ord"]).count() == 0
    assert loan_features.clean(two.withColumn("ord", -F.col("ord")), ["ord"]).count() == 1


def test_cleaning_twice_changes_nothing_numeric(raw):
    columns = [*preset.CLOSED_RANGES, *preset.LOWER_BOUNDS, *preset.UPPER_CLIPS]
    exprs = loan_features.clean_columns()
    once = raw.select("loan_id", *[exprs[c].alias(c) for c in columns])
    twice = once.select("loan_id", *[exprs[c].alias(c) for c in columns])
    assert once.exceptAll(twice).count() == 0


def test_only_needed_columns_cross_the_shuffle(spark, raw, tmp_path):
    raw.write.parquet(str(tmp_path / "raw"))
    read = spark.read.parquet(str(tmp_path / "raw"))
    plan = loan_features.clean(read, ["phone_number"]).select("loan_id", "gender")
    text = plan._jdf.queryExecution().executedPlan().toString()
    schema = text[text.index("ReadSchema"):].split("\n")[0]
    assert "gender" in schema and "city" not in schema and "annual_income" not in schema
    assert "PushedFilters: [IsNotNull(loan_id)]" in text


def test_missing_column_is_an_error(raw):
    with pytest.raises(ValueError, match="gender"):
        loan_features.clean(raw.drop("gender"), ["city"])
    with pytest.raises(ValueError, match="comes first"):
        loan_features.clean(raw)


@pytest.mark.parametrize("kind", ["parquet", "csv"])
def test_the_copy_read_first_stays(spark, raw, tmp_path, kind):
    """A blanked copy after its original, in files of their own order."""
    originals = raw.filter("city is not null and city <> '' and trim(city) <> 'none' and loan_status <> 'Current'").limit(200)
    numbered = originals.withColumn("i", F.row_number().over(Window.orderBy("loan_id")))
    both = numbered.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    both = both.withColumns({c: F.when(F.col("copy") == 1, "").otherwise(F.col(c)) for c in ("city", "phone_number")})
    both.repartitionByRange(4, "i", "copy").sortWithinPartitions("i", "copy").select(*preset.RAW_COLUMNS).transform(
        lambda df: tables.write_table(df, str(tmp_path / "raw"), kind) or df)
    read = tables.read_table(spark, str(tmp_path / "raw"), kind, preset.raw_schema(), position=True)
    cleaned = loan_features.clean(read.repartition(5))
    assert cleaned.count() == 200 and cleaned.filter("city is null").count() == 0
    assert not set(tables.POSITION) & set(cleaned.columns)


def test_empty_input(spark, raw):
    cleaned = loan_features.clean(raw.limit(0), ["city"])
    state = loan_features.fit(cleaned)
    table = loan_features.transform(cleaned, state)
    assert table.count() == 0 and table.columns == ["target", *preset.FEATURES]
    assert state.medians["annual_income"] == 0.0 and state.modes["gender"] == "unknown"


def test_dirt(spark):
    df = spark.range(1000).selectExpr("id", "1.0D as a", "'x' as b")
    draws = {"a": (F.col("id") + 0.5) / 1000, "b": ((F.col("id") * 7) % 1000 + 0.5) / 1000}
    out = synthesis.inject_dirt(df, {"a": 0.6, "b": 0.7}, draws, {"b": F.lit("")})
    assert out.filter("a is null").count() == 600 and out.filter("b = ''").count() == 700
    assert out.filter("a is null and b = ''").count() >= 300


def test_sentinels(raw):
    more = synthesis.append_sentinels(raw, 900_000_000)
    assert more.count() == raw.count() + 3
    assert rows.keep_values(more, "loan_status", preset.ALLOWED_LABELS).filter("loan_id >= 'LN-0900000000'").count() == 0


def test_split_by_key_covers_the_table(fitted):
    cleaned, _ = fitted
    train, val = split.parts(split.exact_split(cleaned, "loan_id", 0.2))
    n = cleaned.count()
    assert (train.count(), val.count()) == (int(n * 0.8), n - int(n * 0.8))
