"""The seven output tables: inputs, input layout and builder of each.

A new table is one more entry here.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from careflow.operators.projection import rows_having
from careflow.plans import diagnosis, infections, orders, patients, visits
from careflow.schemas import (
    DIAGNOSIS_EXTRACT_HEADER, DRUG_ORDERS, EXAMINATIONS, HEADERS, INPATIENT, LIS01, LIS02, LIS03,
    LIS04, LIS05, LIS06, LISA1, OUTPATIENT, STATISTICS,
)
from careflow.sources.workbook import Layout

Inputs = Mapping[str, DataFrame]


@dataclass(frozen=True)
class TableSpec:
    """``build`` takes the input sheets, the tables built so far, the header and the mode.

    A table of ``fixed_header`` ignores the header of an output that is already there.
    """

    number: int
    name: str
    required: tuple[str, ...]
    build: Callable[[Inputs, Inputs, Sequence[str], bool], DataFrame]
    fixed_header: bool = False

    def inputs(self, sheets: Inputs) -> Inputs:
        """The input sheets, without rows of files that lack a sheet this table needs."""
        return {s: rows_having(df, self.required) for s, df in sheets.items()}


def _visits(sheets: Inputs, built: Inputs, header: Sequence[str], compat: bool) -> DataFrame:
    return visits.merge_visits(sheets[OUTPATIENT], sheets[INPATIENT], compat)


def _diagnoses(sheets: Inputs, built: Inputs, header: Sequence[str], compat: bool) -> DataFrame:
    merged = built[LIS01] if LIS01 in built else _visits(sheets, built, header, compat)
    return diagnosis.flag_diagnoses(merged)


def _infections(sheets: Inputs, built: Inputs, header: Sequence[str], compat: bool) -> DataFrame:
    return infections.infection_cases(
        sheets[OUTPATIENT], sheets[INPATIENT], sheets[EXAMINATIONS], header, compat
    )


def _population(sheets: Inputs, built: Inputs, header: Sequence[str], compat: bool) -> DataFrame:
    united = patients.all_patients(sheets[OUTPATIENT], sheets[INPATIENT])
    return patients.population_split(united, header, compat)


def _unique(sheets: Inputs, built: Inputs, header: Sequence[str], compat: bool) -> DataFrame:
    united = patients.all_patients(sheets[OUTPATIENT], sheets[INPATIENT])
    return patients.unique_patients(united, header, compat)


VISIT_SHEETS = (OUTPATIENT, INPATIENT)
SPECS = (
    TableSpec(1, LIS01, VISIT_SHEETS, _visits, fixed_header=True),
    TableSpec(2, LIS02, VISIT_SHEETS, _diagnoses, fixed_header=True),
    TableSpec(3, LIS03, (*VISIT_SHEETS, EXAMINATIONS), _infections),
    TableSpec(4, LIS04, (DRUG_ORDERS,),
              lambda s, b, header, compat: orders.antiviral_orders(
                  s[DRUG_ORDERS], header, compat=compat)),
    TableSpec(5, LIS05, (EXAMINATIONS,),
              lambda s, b, header, compat: orders.lab_tests(
                  s[EXAMINATIONS], header, compat=compat)),
    TableSpec(6, LIS06, (*VISIT_SHEETS, STATISTICS), _population),
    TableSpec(7, LISA1, VISIT_SHEETS, _unique),
)


def layouts(compat: bool = False) -> dict[str, Layout]:
    """What to read of each input sheet of a workbook."""
    visit_fields = (
        (patients.POPULATION_LOOKUPS if compat else patients.INTENT_POPULATION_LOOKUPS)
        | (patients.PATIENT_LOOKUPS if compat else patients.INTENT_PATIENT_LOOKUPS)
        | (infections.DIAGNOSIS_LOOKUPS if compat else infections.INTENT_DIAGNOSIS_LOOKUPS)
        | (diagnosis.LOOKUPS if compat else diagnosis.INTENT_LOOKUPS)
    )
    if not compat:
        visit_fields |= visits.LOOKUPS
    test_fields = orders.LAB_LOOKUPS if compat else orders.INTENT_LAB_LOOKUPS
    drug_fields = orders.DRUG_LOOKUPS if compat else orders.INTENT_DRUG_LOOKUPS

    def names(*headers: tuple[str, ...]) -> tuple[str, ...]:
        return tuple(dict.fromkeys(c for h in headers for c in h))

    visit = Layout(
        visit_fields,
        names(HEADERS[LIS01], HEADERS[LIS03], HEADERS[LIS06], HEADERS[LISA1],
              DIAGNOSIS_EXTRACT_HEADER),
        ("diagnosis", "patient_id", "unique_patient_id"),
    )
    # As written the first date column of the outpatients decides for both sheets.
    stay_fields = {f: v for f, v in visit_fields.items() if not (compat and f == "latest_date")}
    return {
        OUTPATIENT: visit,
        INPATIENT: replace(visit, fields=stay_fields),
        DRUG_ORDERS: Layout(drug_fields, names(HEADERS[LIS04]), ("drug_name", "patient_id")),
        EXAMINATIONS: Layout(
            test_fields, names(HEADERS[LIS03], HEADERS[LIS05]),
            ("test_name", "test_result", "patient_id"),
        ),
        # Required by the population split, its content is not used.
        STATISTICS: Layout({}),
    }
