"""Clinical scalar functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import (
    AGE_BUCKETS,
    AGE_DESCRIPTORS,
    CLINICAL_QUERY_FORMAT,
    DIAGNOSIS_NAMES,
    DIAGNOSIS_VALUES,
    HIGH_RISK_FROM,
    MEDIUM_RISK_FROM,
    STAY_DESCRIPTORS,
    UNSPECIFIED_DIAGNOSIS,
)


def length_of_stay_days(admission: Column, discharge: Column) -> Column:
    """Whole days; negative when the dates are swapped."""
    return F.datediff(discharge, admission)


def age_bucket(age: Column) -> Column:
    young, middle, old = AGE_BUCKETS
    return F.when(age < 50, young).when(age < 70, middle).when(age >= 70, old)


def known_diagnosis(code: Column) -> Column:
    """The code if the model knows it, ``UNKNOWN`` for null, empty or unlisted."""
    return F.when(code.isin(DIAGNOSIS_VALUES), code).otherwise(DIAGNOSIS_VALUES[-1])


def age_descriptor(age: Column) -> Column:
    return F.when(age.isNotNull(), _age_text(age))


def stay_descriptor(days: Column) -> Column:
    return F.when(days.isNotNull(), _stay_text(days))


def _age_text(age: Column) -> Column:
    return _first_match([(age < b if b is not None else None, d) for b, d in AGE_DESCRIPTORS])


def _stay_text(days: Column) -> Column:
    return _first_match([(days <= b if b is not None else None, d) for b, d in STAY_DESCRIPTORS])


def _first_match(cases: list[tuple[Column | None, str]]) -> Column:
    *bounded, (_, last) = cases
    chosen = F
    for condition, text in bounded:
        chosen = chosen.when(condition, text)
    return chosen.otherwise(last)


def diagnosis_name(code: Column) -> Column:
    """Clinical name of a code; unlisted codes pass through."""
    names = F.create_map(*[F.lit(x) for pair in DIAGNOSIS_NAMES.items() for x in pair])
    return F.when(
        F.coalesce(code, F.lit("")) == "", UNSPECIFIED_DIAGNOSIS
    ).otherwise(F.coalesce(F.try_element_at(names, code), code))


def clinical_query(
    age: Column, admission: Column, discharge: Column, diagnosis: Column
) -> Column:
    """Search text for the literature on a patient like this one; null without an
    age or a stay."""
    days = length_of_stay_days(admission.cast("date"), discharge.cast("date"))
    text = F.format_string(
        CLINICAL_QUERY_FORMAT,
        age_descriptor(age),
        diagnosis_name(diagnosis),
        stay_descriptor(days),
        days,
    )
    return F.when(age.isNotNull() & days.isNotNull(), text)


def risk_band(probability: Column) -> Column:
    return (
        F.when(probability < MEDIUM_RISK_FROM, "low")
        .when(probability < HIGH_RISK_FROM, "medium")
        .when(probability >= HIGH_RISK_FROM, "high")
    )


def predicted_label(probability: Column, threshold: float = 0.5) -> Column:
    return (probability >= threshold).cast("int")


def percent(share: Column) -> Column:
    """A share as a percentage with one decimal."""
    return F.round(share * 100, 1)
