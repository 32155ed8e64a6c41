"""COVID infections: diagnosed visits and positive, negative or unknown tests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careflow import vocab
from careflow.functions import classify
from careflow.operators.projection import Fields, Rule, lineage, map_columns, with_source_rank
from careflow.operators.union import union_aligned
from careflow.schemas import HEADERS, LIS03

DIAGNOSIS_LOOKUPS = {
    "diagnosis": vocab.DIAGNOSIS,
    "patient_id": vocab.PATIENT_ID,
    "visit_date": vocab.VISIT_DATE,
}
TEST_LOOKUPS = {
    "test_name": vocab.TEST_NAME,
    "test_result": vocab.TEST_RESULT,
    "patient_id": vocab.PATIENT_ID,
    "test_date": vocab.TEST_DATE,
}
INTENT_DIAGNOSIS_LOOKUPS = DIAGNOSIS_LOOKUPS | {
    "diagnosis": vocab.DIAGNOSIS_TEXT_FIRST,
    "patient_id": vocab.ANY_PATIENT_ID,
}
INTENT_TEST_LOOKUPS = TEST_LOOKUPS | {"patient_id": vocab.ANY_PATIENT_ID}


def diagnosed_cases(
    df: DataFrame,
    visit_type: str,
    target: Sequence[str] = HEADERS[LIS03],
    keywords: Sequence[str] = vocab.COVID_DIAGNOSIS,
    compat: bool = False,
) -> DataFrame:
    """Visits whose diagnosis names the disease."""
    fields = Fields(df, DIAGNOSIS_LOOKUPS if compat else INTENT_DIAGNOSIS_LOOKUPS)
    text = fields["diagnosis"]
    rows = fields.rows_with("diagnosis", "patient_id")
    if text is not None:
        rows = rows.filter(classify.contains_any(text, keywords))
    patient = Rule(vocab.TO_PATIENT, fields["patient_id"])
    others = [
        Rule(vocab.TO_VISIT_TYPE, F.lit(visit_type)),
        fields.date_rule(vocab.VISIT_DATE, "visit_date"),
        Rule(vocab.DIAGNOSIS, text),
        Rule(vocab.TO_INFECTION, F.lit(classify.CONFIRMED)),
    ]
    rules = [patient, *others] if compat else [*others, patient]
    return rows.select(*map_columns(df, target, rules), *lineage(df))


def tested_cases(
    df: DataFrame,
    target: Sequence[str] = HEADERS[LIS03],
    keywords: Sequence[str] = vocab.COVID_TEST,
    compat: bool = False,
) -> DataFrame:
    """Tests for the disease, with the infection status that the result means."""
    fields = Fields(df, TEST_LOOKUPS if compat else INTENT_TEST_LOOKUPS)
    rows = fields.rows_with("test_name", "test_result", "patient_id")
    name, result = fields["test_name"], fields["test_result"]
    if name is not None:
        rows = rows.filter(classify.contains_any(name, keywords))
    raw = None if result is None else classify.text_or_blank(result)
    status = Rule(
        vocab.TO_INFECTION,
        None if result is None else classify.infection_status(result, compat),
    )
    patient = Rule(vocab.TO_PATIENT, fields["patient_id"])
    visit = Rule(vocab.TO_VISIT_TYPE, F.lit(vocab.TAG_TEST))
    days = vocab.TO_TEST_DAY if compat else ("检查日期", "检验日期", "检测日期")
    others = [
        fields.date_rule(days, "test_date"),
        fields.date_rule(vocab.VISIT_DATE, "test_date"),
        Rule(vocab.TEST_NAME, name),
    ]
    outcome = Rule(vocab.TEST_RESULT, raw)
    rules = (
        [patient, visit, *others, outcome, status]
        if compat
        else [visit, *others, status, outcome, patient]
    )
    return rows.select(*map_columns(df, target, rules), *lineage(df))


def infection_cases(
    outpatients: DataFrame,
    inpatients: DataFrame,
    examinations: DataFrame,
    target: Sequence[str] = HEADERS[LIS03],
    compat: bool = False,
) -> DataFrame:
    return union_aligned([
        diagnosed_cases(with_source_rank(outpatients, 0), vocab.TAG_OUTPATIENT, target, compat=compat),
        diagnosed_cases(with_source_rank(inpatients, 1), vocab.TAG_INPATIENT, target, compat=compat),
        tested_cases(with_source_rank(examinations, 2), target, compat=compat),
    ])
