"""Antiviral drug orders and laboratory tests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careflow import vocab
from careflow.functions import classify
from careflow.operators.projection import Fields, Rule, lineage, map_columns
from careflow.schemas import HEADERS, LIS04, LIS05

DRUG_LOOKUPS = {
    "drug_name": vocab.DRUG_NAME,
    "patient_id": vocab.PATIENT_ID,
    "drug_date": vocab.DRUG_DATE,
    "dose": vocab.DOSE,
    "frequency": vocab.FREQUENCY,
    "route": vocab.ROUTE,
}
LAB_LOOKUPS = {
    "test_name": vocab.TEST_NAME,
    "test_result": vocab.TEST_RESULT,
    "patient_id": vocab.PATIENT_ID,
    "test_date": vocab.TEST_DATE,
    "test_method": vocab.TEST_METHOD,
    "test_department": vocab.TEST_DEPARTMENT,
}
INTENT_DRUG_LOOKUPS = DRUG_LOOKUPS | {"patient_id": vocab.ANY_PATIENT_ID}
INTENT_LAB_LOOKUPS = LAB_LOOKUPS | {"patient_id": vocab.ANY_PATIENT_ID}


def antiviral_orders(
    df: DataFrame,
    target: Sequence[str] = HEADERS[LIS04],
    keywords: Sequence[str] = vocab.ANTIVIRAL,
    compat: bool = False,
) -> DataFrame:
    """Orders whose drug name holds an antiviral keyword (case-sensitive)."""
    fields = Fields(df, DRUG_LOOKUPS if compat else INTENT_DRUG_LOOKUPS)
    rows = fields.rows_with("drug_name", "patient_id")
    drug = fields["drug_name"]
    if drug is not None:
        rows = rows.filter(classify.contains_any(drug, keywords))
    rules = [
        Rule(vocab.TO_PATIENT, fields["patient_id"]),
        Rule(vocab.DRUG_NAME, drug),
        fields.date_rule(vocab.DRUG_DATE, "drug_date"),
        Rule(vocab.DOSE, fields["dose"]),
        Rule(vocab.FREQUENCY, fields["frequency"]),
        Rule(vocab.ROUTE, fields["route"]),
        Rule(vocab.TO_DRUG_TYPE, F.lit(vocab.DRUG_TYPE)),
    ]
    return rows.select(*map_columns(df, target, rules), *lineage(df))


def lab_tests(
    df: DataFrame,
    target: Sequence[str] = HEADERS[LIS05],
    keywords: Sequence[str] = vocab.COVID_TEST,
    compat: bool = False,
) -> DataFrame:
    """Tests for the disease with result type and (recorded or implied) method."""
    fields = Fields(df, LAB_LOOKUPS if compat else INTENT_LAB_LOOKUPS)
    rows = fields.rows_with("test_name", "test_result", "patient_id")
    name, result = fields["test_name"], fields["test_result"]
    if name is not None:
        rows = rows.filter(classify.contains_any(name, keywords))
    outcome = Rule(
        vocab.TEST_RESULT, None if result is None else classify.text_or_blank(result)
    )
    kind = Rule(
        vocab.TO_RESULT_TYPE, None if result is None else classify.result_type(result, compat)
    )
    method = None if name is None else classify.detection_method(fields["test_method"], name)
    rules = [
        Rule(vocab.TO_PATIENT, fields["patient_id"]),
        Rule(vocab.TEST_NAME, name),
        # As written the shorter key wins and the type column shows the raw result.
        *([outcome, kind] if compat else [kind, outcome]),
        fields.date_rule(vocab.TEST_DATE, "test_date"),
        Rule(vocab.TEST_METHOD, method),
        Rule(vocab.TEST_DEPARTMENT, fields["test_department"]),
    ]
    return rows.select(*map_columns(df, target, rules), *lineage(df))
