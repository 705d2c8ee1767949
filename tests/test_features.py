import datetime as dt

import pytest
from pyspark.sql import functions as F

from carelake.fixed_values import LABEL
from carelake.functions.clinical import (
    age_bucket,
    age_descriptor,
    clinical_query,
    diagnosis_name,
    percent,
    predicted_label,
    risk_band,
    stay_descriptor,
)
from carelake.operators.features import (
    feature_names,
    patients_to_features,
    require_features,
    split_features_label,
)
from carelake.schemas import PATIENT_SCHEMA


def patient(age=65, sex="M", dx="I50.9", start=(2024, 6, 1), end=(2024, 6, 8), label=True):
    return ("P", age, sex, dt.date(*start), dt.date(*end), dx, label)


def features(spark, *rows, **options):
    return patients_to_features(spark.createDataFrame(list(rows), PATIENT_SCHEMA), **options)


def values(spark, function, items, kind):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("x"))).collect()]


def test_contract():
    names = feature_names()
    assert len(names) == len(set(names)) == 19
    assert names[:3] == ["age", "length_of_stay_days", "sex_F"]
    assert names[-1] == "age_bucket_age_70_plus"
    require_features(names, feature_names())
    with pytest.raises(ValueError, match="retrain"):
        require_features(names[::-1], names)


def test_default_patient(spark):
    got = features(spark, patient()).first().asDict()
    on = {n for n in feature_names()[2:] if got[n] == 1}
    assert on == {"sex_M", "dx_I50.9", "age_bucket_age_50_69"}
    assert (got["age"], got["length_of_stay_days"], got[LABEL]) == (65, 7, True)


def test_column_order_with_and_without_label(spark):
    assert features(spark, patient()).columns == [*feature_names(), LABEL]
    assert features(spark, patient(), include_label=False).columns == feature_names()
    assert features(spark, patient(), include_label=False, keep=["mrn"]).columns[0] == "mrn"


@pytest.mark.parametrize("dx", ["X99.9", None, ""])
def test_unknown_diagnosis(spark, dx):
    got = features(spark, patient(dx=dx)).first()
    assert got["dx_UNKNOWN"] == 1
    assert sum(got[n] for n in feature_names() if n.startswith("dx_")) == 1


@pytest.mark.parametrize("end, days", [((2024, 6, 1), 0), ((2024, 6, 8), 7), ((2024, 5, 31), -1)])
def test_length_of_stay(spark, end, days):
    assert features(spark, patient(end=end)).first()["length_of_stay_days"] == days


def test_age_buckets(spark):
    got = values(spark, age_bucket, [18, 49, 50, 69, 70, 95], "int")
    assert got == ["under_50"] * 2 + ["age_50_69"] * 2 + ["age_70_plus"] * 2


def test_empty_input_keeps_columns(spark):
    empty = features(spark, patient()).limit(0)
    assert empty.columns == [*feature_names(), LABEL] and empty.count() == 0


def test_split_features_label(spark):
    x, y = split_features_label(features(spark, patient(), patient(label=False)))
    assert x.columns == feature_names()
    assert sorted(r[0] for r in y.collect()) == [0, 1]


def test_features_need_no_shuffle(spark):
    plan = features(spark, patient())._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_age_descriptors(spark):
    got = values(spark, age_descriptor, [5, 17, 18, 30, 40, 64, 65, 78, 80, 95], "int")
    assert got == (
        ["pediatric"] * 2
        + ["young adult"] * 2
        + ["middle-aged"] * 2
        + ["older adult"] * 2
        + ["very elderly"] * 2
    )


def test_stay_descriptors(spark):
    got = values(spark, stay_descriptor, [0, -1, 1, 3, 4, 7, 10, 14, 15, 30], "int")
    assert got == (
        ["same-day discharge"] * 2
        + ["short stay"] * 2
        + ["typical stay"] * 2
        + ["extended stay"] * 2
        + ["prolonged hospitalization"] * 2
    )


def test_diagnosis_names(spark):
    got = values(spark, diagnosis_name, ["I50.9", "I10", "Z99.9", None, ""], "string")
    assert got == [
        "heart failure",
        "essential hypertension",
        "Z99.9",
        "unspecified diagnosis",
        "unspecified diagnosis",
    ]


def test_clinical_query_takes_dates_and_text(spark):
    want = (
        "30-day hospital readmission risk in older adult patient "
        "with heart failure after typical stay (7 days)"
    )
    for kind in ("string", "date"):
        df = spark.sql(
            f"SELECT 78 age, CAST('2024-06-15' AS {kind}) a, CAST('2024-06-22' AS {kind}) d, 'I50.9' dx"
        )
        query = clinical_query(F.col("age"), F.col("a"), F.col("d"), F.col("dx"))
        assert df.select(query).first()[0] == want


def test_bands_labels_percent(spark):
    shares = [0.0, 0.1499, 0.15, 0.2999, 0.30, 1.0]
    assert values(spark, risk_band, shares, "double") == ["low"] * 2 + ["medium"] * 2 + ["high"] * 2
    assert values(spark, predicted_label, [0.49, 0.5, 0.51], "double") == [0, 1, 1]
    assert values(spark, percent, [0.1234, 1.0], "double") == [12.3, 100.0]
