"""Diagnosis flags on merged visits, and the diagnosis extract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careflow import vocab
from careflow.functions import classify
from careflow.functions.naming import quoted
from careflow.operators.projection import (
    Fields, Rule, lineage, map_columns, text_or_null, with_source_rank,
)
from careflow.operators.union import union_aligned
from careflow.schemas import DIAGNOSIS_EXTRACT_HEADER, ROW_ID

FLAG_PREFIX = 14
TEXT, CODE = "诊断（文字）", "诊断（ICD编码）"


def flag_diagnoses(
    visits: DataFrame,
    exact: bool = False,
    text: str = TEXT,
    code: str = CODE,
    codes: Sequence[str] = vocab.RS_CODES,
) -> DataFrame:
    """The first 14 columns of the visits and three flags.

    By default a code counts when it occurs anywhere in the code text; ``exact`` wants
    the whole text to be one code and reads unknown text as "no".
    """
    words, icd = F.col(quoted(text)), F.col(quoted(code))
    respiratory = classify.respiratory_flag(icd, exact, codes)
    own = [c for c in visits.columns if c not in ROW_ID]
    return visits.select(
        *[F.col(quoted(c)) for c in own[:FLAG_PREFIX]],
        classify.covid_flag(words, exact).alias("新冠患者"),
        respiratory.alias("RS患者"),
        classify.pneumonia_flag(respiratory, words).alias("诊断合并为肺炎"),
        *lineage(visits),
    )


LOOKUPS = {
    "diagnosis": vocab.DIAGNOSIS,
    "diagnosis_code": vocab.DIAGNOSIS_CODE,
    "patient_id": vocab.PATIENT_ID,
    "visit_date": vocab.VISIT_DATE,
}
INTENT_LOOKUPS = LOOKUPS | {
    "diagnosis": vocab.DIAGNOSIS_TEXT_FIRST,
    "patient_id": vocab.ANY_PATIENT_ID,
}


def extract_diagnoses(
    df: DataFrame,
    visit_type: str,
    target: Sequence[str] = DIAGNOSIS_EXTRACT_HEADER,
    compat: bool = False,
) -> DataFrame:
    """Diagnosis columns of one sheet on the extract header."""
    fields = Fields(df, LOOKUPS if compat else INTENT_LOOKUPS)
    rows = fields.rows_with("diagnosis", "patient_id")
    text, code, patient = fields["diagnosis"], fields["diagnosis_code"], fields["patient_id"]
    if compat:
        # Keys are tried in this order, so the diagnosis and patient rules win too often.
        rules = [
            Rule(vocab.DIAGNOSIS, text),
            Rule(vocab.TO_CODE, code),
            Rule(vocab.TO_PATIENT, patient),
            Rule(vocab.TO_VISIT_TYPE, F.lit(visit_type)),
            fields.date_rule(vocab.VISIT_DATE, "visit_date"),
        ]
    else:
        words, icd = text_or_null(text), text_or_null(code)
        respiratory = classify.respiratory_flag(icd)
        rules = [
            Rule(("诊断", "诊断（文字）", "诊断文字", "疾病", "病名"), text, exact=True),
            Rule(vocab.TO_CODE, code),
            Rule(("新冠患者",), classify.covid_flag(words), exact=True),
            Rule(("RS患者",), respiratory, exact=True),
            Rule(("诊断合并为肺炎",), classify.pneumonia_flag(respiratory, words), exact=True),
            Rule(("就诊类型", "来源"), F.lit(visit_type)),
            fields.date_rule(vocab.VISIT_DATE, "visit_date"),
            Rule(vocab.TO_PATIENT, patient),
        ]
    return rows.select(*map_columns(df, target, rules), *lineage(df))


def diagnosis_extract(
    outpatients: DataFrame,
    inpatients: DataFrame,
    target: Sequence[str] = DIAGNOSIS_EXTRACT_HEADER,
    compat: bool = False,
) -> DataFrame:
    return union_aligned([
        extract_diagnoses(with_source_rank(outpatients, 0), vocab.TAG_OUTPATIENT, target, compat),
        extract_diagnoses(with_source_rank(inpatients, 1), vocab.TAG_INPATIENT, target, compat),
    ])
