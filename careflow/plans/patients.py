"""Population split (one row per visit) and unique patients (one row per patient)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careflow import vocab
from careflow.functions import classify
from careflow.functions.naming import clean_names, quoted
from careflow.operators.filters import keyed_rows
from careflow.operators.projection import (
    FIELD_PREFIX, MISSING, Fields, Rule, lineage, map_columns, text_or_null, with_source_rank,
)
from careflow.operators.union import outer_union
from careflow.schemas import HEADERS, LIS06, LISA1, ROW_ID, ROW_IDX, SOURCE_FILE, SOURCE_RANK

POPULATION_LOOKUPS = {
    "patient_id": vocab.PATIENT_ID,
    "age": vocab.AGE,
    "gender": vocab.GENDER,
    "region": vocab.REGION,
}
PATIENT_LOOKUPS = {
    "unique_patient_id": vocab.UNIQUE_PATIENT_ID,
    "name": vocab.NAME,
    "age": vocab.AGE,
    "gender": vocab.GENDER,
    "birth": vocab.BIRTH,
    "contact": vocab.CONTACT,
    "address": vocab.ADDRESS,
    "visit_date": vocab.VISIT_DATE,
    "admission_date": vocab.ADMISSION_DATE,
    "latest_date": vocab.LATEST_DATE,
}
INTENT_POPULATION_LOOKUPS = POPULATION_LOOKUPS | {"patient_id": vocab.ANY_PATIENT_ID}
INTENT_PATIENT_LOOKUPS = PATIENT_LOOKUPS | {"unique_patient_id": vocab.ANY_UNIQUE_PATIENT_ID}


def all_patients(outpatients: DataFrame, inpatients: DataFrame) -> DataFrame:
    """Both sheets, united by cleaned column name."""
    return outer_union([
        with_source_rank(_cleaned(outpatients), 0), with_source_rank(_cleaned(inpatients), 1)
    ])


def _cleaned(df: DataFrame) -> DataFrame:
    kept = (*ROW_ID, MISSING)
    own = [c for c in df.columns if c not in kept and not c.startswith(FIELD_PREFIX)]
    return df.withColumnsRenamed(dict(zip(own, clean_names(own))))


def population_split(
    patients: DataFrame, target: Sequence[str] = HEADERS[LIS06], compat: bool = False
) -> DataFrame:
    """Age band and population category of every row.

    The bands and the categories cut age at different years; both are kept.
    """
    fields = Fields(patients, POPULATION_LOOKUPS if compat else INTENT_POPULATION_LOOKUPS)
    rows = fields.rows_with("patient_id")
    age = text_or_null(fields["age"])
    gender = classify.text_or_blank(text_or_null(fields["gender"]))
    years = Rule(vocab.AGE, age)
    band = Rule(vocab.TO_AGE_BAND, classify.age_band(age))
    rules = [
        Rule(vocab.TO_PATIENT, classify.text_or_blank(text_or_null(fields["patient_id"]))),
        # As written the shorter key wins and the band column shows the raw age.
        *([years, band] if compat else [band, years]),
        Rule(vocab.GENDER, gender),
        Rule(vocab.REGION,
             classify.text_or_blank(text_or_null(fields["region"]))),
        Rule(vocab.TO_POPULATION, classify.population_category(age, gender)),
    ]
    return rows.select(*map_columns(patients, target, rules), *lineage(patients))


def _latest_date(fields: Fields, compat: bool) -> Column:
    """When a row was recorded: visit, else admission; as written the first date column."""
    names = ("latest_date",) if compat else ("visit_date", "admission_date")
    dates = [d for d in map(fields.timestamp, names) if d is not None]
    return F.coalesce(*dates) if dates else F.lit(None).cast("timestamp_ntz")


def unique_patients(
    patients: DataFrame, target: Sequence[str] = HEADERS[LISA1], compat: bool = False
) -> DataFrame:
    """Latest row of every known patient; first visit, last visit and number of visits.

    One aggregation does it all: rows are mapped first, then each map task keeps one
    candidate and partial counts per patient, so a patient with most of the rows costs
    one row per task in the shuffle.
    """
    fields = Fields(patients, PATIENT_LOOKUPS if compat else INTENT_PATIENT_LOOKUPS)

    def blank(field: str) -> Column:
        return classify.text_or_blank(text_or_null(fields[field]))

    patient = text_or_null(fields["unique_patient_id"])
    stats = () if compat else ("首次就诊日期", "最近就诊日期", "就诊次数")
    rules = [
        Rule(vocab.TO_UNIQUE_PATIENT, patient),
        Rule(vocab.NAME, blank("name")),
        Rule(vocab.AGE, text_or_null(fields["age"])),
        Rule(vocab.GENDER, blank("gender")),
        Rule(vocab.BIRTH, text_or_null(fields["birth"])),
        Rule(vocab.CONTACT, blank("contact")),
        Rule(vocab.ADDRESS, blank("address")),
    ]
    own = [c for c in target if c not in stats]
    keys = [c for c in (SOURCE_FILE,) if c in patients.columns] + ["_patient"]
    ties = [c for c in (SOURCE_RANK, ROW_IDX) if c in patients.columns]
    rows = fields.rows_with("unique_patient_id").select(
        *[c for c in keys if c != "_patient"],
        patient.alias("_patient"),
        _latest_date(fields, compat).alias("_ts"),
        F.struct(*map_columns(patients, own, rules)).alias("_row"),
        *ties,
    )
    rows = keyed_rows(rows, "_patient")
    # Greatest time first (null is least), then earliest row; without row numbers the
    # row's own content settles ties.
    order = [-F.col(c) for c in ties] if ROW_IDX in ties else [F.col("_row")]
    latest = rows.groupBy(*keys).agg(
        F.max_by("_row", F.struct("_ts", *order)).alias("_row"),
        F.min("_ts").alias("_first"),
        F.max("_ts").alias("_last"),
        F.count("*").alias("_visits"),
    )
    stat_rules = [
        Rule(("首次就诊日期",), F.lit(""), exact=True, timestamp=F.col("_first")),
        Rule(("最近就诊日期",), F.lit(""), exact=True, timestamp=F.col("_last")),
        Rule(("就诊次数",), F.col("_visits"), exact=True),
    ]
    computed = {
        r.keys[0]: r.value(r.keys[0]) for r in stat_rules if r.keys[0] in stats
    }
    return latest.select(
        *[computed[c].alias(c) if c in computed else F.col("_row").getField(c).alias(c)
          for c in target],
        *[c for c in keys if c != "_patient"],
    )


def patient_ids(patients: DataFrame, compat: bool = False) -> DataFrame:
    """Distinct known patient IDs."""
    fields = Fields(patients, PATIENT_LOOKUPS if compat else INTENT_PATIENT_LOOKUPS)
    rows = fields.rows_with("unique_patient_id")
    ids = rows.select(text_or_null(fields["unique_patient_id"]).alias("患者ID"))
    return keyed_rows(ids, "患者ID").distinct()


def population_labels(patients: DataFrame, age: str, gender: str) -> DataFrame:
    """Every row with all the categories it belongs to."""
    return patients.withColumn(
        "人群标签", classify.population_labels(F.col(quoted(age)), F.col(quoted(gender)))
    )
