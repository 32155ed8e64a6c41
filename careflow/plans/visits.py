"""Merged visits: outpatient and inpatient rows on one header, latest per patient and day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careflow import schemas, vocab
from careflow.functions import classify
from careflow.functions.naming import clean_name, quoted
from careflow.functions.temporal import as_timestamp
from careflow.operators import dedup
from careflow.operators.projection import Fields, align, lineage, with_source_rank
from careflow.operators.union import union_aligned
from careflow.schemas import HEADERS, LIS01, SOURCE_FILE

VISIT_TS, VISIT_DAY = "_visit_ts", "_visit_day"
CODE = "患者唯一编码"
LOOKUPS = {"visit_patient": vocab.VISIT_PATIENT_ID}


def _one_source(
    df: DataFrame, source: str, rank: int, dates: dict[str, str], compat: bool
) -> DataFrame:
    """One sheet on the visit header.  ``dates`` maps visit dates to the columns they take."""
    clean = not compat
    key = clean_name if clean else str
    have = {key(c): c for c in reversed(df.columns)}
    renamed = dict(dates)
    if not compat:
        patient = Fields(df, LOOKUPS).names["visit_patient"]
        if patient is not None:
            renamed["患者编号"] = patient
    ranked = with_source_rank(df, rank)
    start = have.get(key(renamed.get("就诊日期", "就诊日期")))
    ts = F.lit(None).cast("timestamp_ntz") if start is None else as_timestamp(df, start)
    return ranked.select(
        *align(ranked, HEADERS[LIS01], clean, renamed), ts.alias(VISIT_TS), *lineage(ranked)
    ).withColumn("来源", F.lit(source))


def all_visits(
    outpatients: DataFrame,
    inpatients: DataFrame,
    compat: bool = False,
    department_types: Sequence[tuple[str, str]] = classify.DEPARTMENT_TYPES,
) -> DataFrame:
    """Every visit with its codes and type, before duplicates go.

    An inpatient's visit starts with the admission and ends with the discharge.
    """
    stay = {"就诊日期": "入院日期", "就诊结束日期": "出院日期"}
    visits = union_aligned([
        _one_source(outpatients, vocab.TAG_OUTPATIENT, 0, {}, compat),
        _one_source(inpatients, vocab.TAG_INPATIENT, 1, stay, compat),
    ])
    return (
        visits.withColumn("医院编码", classify.hospital_code(F.col("医院编码")))
        .withColumns({
            CODE: classify.patient_code(F.col("医院编码"), F.col("患者编号")),
            "就诊类别": classify.visit_type(F.col("就诊科室"), F.col("来源"), department_types),
            VISIT_DAY: F.col(VISIT_TS).cast("date"),
        })
    )


def visit_keys(visits: DataFrame) -> list[str]:
    """Workbooks are independent of each other, so the file is part of the key."""
    return [c for c in (SOURCE_FILE,) if c in visits.columns] + [CODE, VISIT_DAY]


def _row_key(visits: DataFrame) -> list[str]:
    return lineage(visits) if schemas.ROW_IDX in visits.columns else []


def latest_first(visits: DataFrame) -> list[Column]:
    """Newest first; then outpatients before inpatients, in input order."""
    others = [schemas.ROW_IDX] if schemas.ROW_IDX in visits.columns else [
        c for c in visits.columns if c not in (*visit_keys(visits), VISIT_TS, schemas.SOURCE_RANK)
    ]
    return [F.desc_nulls_last(VISIT_TS), *dedup.tie_break(visits, [schemas.SOURCE_RANK, *others])]


def latest_visits(visits: DataFrame, keep_null_keys: bool = False) -> DataFrame:
    """Latest visit per patient and day.

    Rows without a patient (or a date) are alike and one of them is kept, unless
    ``keep_null_keys`` asks for all of them.
    """
    keys = visit_keys(visits)
    if not keep_null_keys:
        return dedup.keep_first(visits, keys, latest_first(visits))
    known = F.col(CODE).isNotNull() & F.col(VISIT_DAY).isNotNull()
    latest = dedup.keep_first(visits.filter(known), keys, latest_first(visits))
    return latest.unionByName(visits.filter(~known))


def merge_visits(
    outpatients: DataFrame,
    inpatients: DataFrame,
    compat: bool = False,
    keep_null_keys: bool = False,
    department_types: Sequence[tuple[str, str]] = classify.DEPARTMENT_TYPES,
) -> DataFrame:
    visits = all_visits(outpatients, inpatients, compat, department_types)
    return latest_visits(visits, keep_null_keys).drop(VISIT_TS, VISIT_DAY)


def duplicate_visits(visits: DataFrame) -> DataFrame:
    """Audit: every visit that shares patient and day with another, and the group's size."""
    members = dedup.duplicate_members(visits, visit_keys(visits), _row_key(visits))
    return members.select(
        *visit_keys(visits), "group_size", "来源", "就诊科室", "就诊类别", "就诊日期",
        *[quoted(c) for c in lineage(visits) if c != SOURCE_FILE],
    )


def duplicate_visit_groups(visits: DataFrame) -> DataFrame:
    """Audit, one row per duplicate group: its size, the visit kept and what is removed."""
    return dedup.duplicate_groups(
        visits,
        visit_keys(visits),
        F.max(VISIT_TS).cast("string").alias("kept_ts"),
        F.min(VISIT_TS).cast("string").alias("first_ts"),
    ).withColumn("removed", F.col("group_size") - 1)


def removed_visits(visits: DataFrame) -> DataFrame:
    return dedup.removed_rows(visits, visit_keys(visits))
