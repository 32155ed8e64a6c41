"""Classification rules as column expressions.

Wherever two published definitions disagree the rule list is a parameter, so both
run through the same code.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from careflow import vocab

YES, NO = "是", "否"

# Department keyword -> visit type, first match wins; then by source.
DEPARTMENT_TYPES = (("ICU", "ICU(I)"), ("发热", "发热(F)"), ("急诊", "急诊(E)"))
SOURCE_TYPES = ((vocab.TAG_OUTPATIENT, "门诊(O)"), (vocab.TAG_INPATIENT, "住院(H)"))
DEFAULT_HOSPITAL = "030"

# Result patterns.  The word for "not detected" holds the word for
# "detected", so the order of the two rules decides how it is read.
POSITIVE, NEGATIVE = "阳性|检出|positive", "阴性|未检出|negative"
RESULT_UNKNOWN = "未知"
METHOD_PATTERNS = (
    ("核酸|PCR|RT-PCR", "核酸检测"), ("抗原", "抗原检测"), ("抗体|IgM|IgG", "抗体检测"),
)

# Age bands as (upper bound, label).
AGE_BANDS = (
    (3, "婴幼儿(0-2岁)"), (6, "学龄前(3-5岁)"), (12, "儿童(6-11岁)"),
    (18, "青少年(12-17岁)"), (35, "青年(18-34岁)"), (60, "中年(35-59岁)"),
    (80, "老年(60-79岁)"),
)
LAST_BAND, UNKNOWN_BAND = "高龄老人(80岁以上)", "未知"

# Labels of infection status, result type and population category.
CONFIRMED, EXCLUDED = "确诊", "排除"
RESULT_POSITIVE, RESULT_NEGATIVE = "阳性", "阴性"
ELDERLY, ADULT, MINOR, CHILD = "老年人", "成年人", "儿童青少年", "儿童"
MALE, FEMALE, UNCLASSIFIED = "男性", "女性", "未分类"
GENDER_MALE, GENDER_FEMALE = "男", "女"


def contains_any(text: Column, keywords: Sequence[str]) -> Column:
    """True when ``text`` holds any keyword.

    ``contains`` (unlike ``rlike``) is pushed down to Parquet.  A keyword that holds
    another keyword adds nothing and is left out.
    """
    needed = [k for k in dict.fromkeys(keywords)
              if not any(o != k and o in k for o in keywords)]
    if not needed:
        return F.lit(False)
    return reduce(or_, [text.contains(k) for k in needed])


def first_match(text: Column, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """Label of the first case-blind pattern found in ``text``."""
    result = F
    for pattern, label in rules:
        result = result.when(text.rlike(f"(?i){pattern}"), F.lit(label))
    return result.otherwise(F.lit(default))


def text_or_blank(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def visit_type(
    department: Column,
    source: Column,
    department_types: Sequence[tuple[str, str]] = DEPARTMENT_TYPES,
    source_types: Sequence[tuple[str, str]] = SOURCE_TYPES,
) -> Column:
    """Department decides first, then where the visit was recorded; else null."""
    result, dept = F, text_or_blank(department)
    for keyword, label in department_types:
        result = result.when(dept.contains(keyword), F.lit(label))
    for name, label in source_types:
        result = result.when(source == name, F.lit(label))
    return result.otherwise(F.lit(None).cast("string"))


def hospital_code(column: Column, default: str = DEFAULT_HOSPITAL) -> Column:
    return F.coalesce(column, F.lit(default))


def patient_code(hospital: Column, patient: Column) -> Column:
    """``hospital-patient``; ``concat`` gives null when the patient is unknown."""
    return F.concat(hospital, F.lit("-"), patient)


def _result_rules(positive: str, negative: str, compat: bool):
    rules = [(NEGATIVE, negative), (POSITIVE, positive)]
    return rules[::-1] if compat else rules


def infection_status(result: Column, compat: bool = False) -> Column:
    return first_match(text_or_blank(result), _result_rules(CONFIRMED, EXCLUDED, compat), RESULT_UNKNOWN)


def result_type(result: Column, compat: bool = False) -> Column:
    return first_match(text_or_blank(result), _result_rules(RESULT_POSITIVE, RESULT_NEGATIVE, compat), RESULT_UNKNOWN)


def detection_method(method: Column | None, test_name: Column) -> Column:
    """The recorded method, else the one that the test's name implies."""
    implied = first_match(text_or_blank(test_name), METHOD_PATTERNS, "")
    return implied if method is None else F.coalesce(method, implied)


def _flag(condition: Column) -> Column:
    return F.when(condition, F.lit(YES)).otherwise(F.lit(NO))


def covid_flag(text: Column, exact: bool = False) -> Column:
    """Unknown text stays null; in the exact variant it counts as no."""
    flag = _flag(text.contains(vocab.COVID_PATIENT_TEXT))
    return flag if exact else F.when(text.isNotNull(), flag)


def respiratory_flag(
    code: Column, exact: bool = False, codes: Sequence[str] = vocab.RS_CODES
) -> Column:
    """Any listed code inside the code text, or (exact) the whole text is one code."""
    return _flag(code.isin(*codes) if exact else contains_any(code, codes))


def pneumonia_flag(respiratory: Column, text: Column) -> Column:
    return _flag((respiratory == YES) & contains_any(text, vocab.PNEUMONIA_TEXT))


def age_value(age: Column) -> Column:
    """Age as a number; text that is not a plain number, and NaN, become null."""
    text = F.trim(age.cast("string"))
    number = F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), text.try_cast("double"))
    return number


def age_band(
    age: Column, bands: Sequence[tuple[float, str]] = AGE_BANDS, last: str = LAST_BAND
) -> Column:
    years = age_value(age)
    result = F.when(years.isNull(), F.lit(UNKNOWN_BAND))
    for upper, label in bands:
        result = result.when(years < upper, F.lit(label))
    return result.otherwise(F.lit(last))


def population_category(age: Column, gender: Column) -> Column:
    """By age where there is one, else by gender."""
    years = age_value(age)
    return (
        F.when(years >= 65, F.lit(ELDERLY))
        .when(years >= 18, F.lit(ADULT))
        .when(years.isNotNull(), F.lit(MINOR))
        .when(gender == GENDER_MALE, F.lit(MALE))
        .when(gender == GENDER_FEMALE, F.lit(FEMALE))
        .otherwise(F.lit(UNCLASSIFIED))
    )


def population_labels(age: Column, gender: Column) -> Column:
    """Every category whose criterion holds, as an array."""
    years = age_value(age)
    criteria = (
        (ELDERLY, years >= 65),
        (ADULT, (years >= 18) & (years < 65)),
        (CHILD, years < 18),
        (MALE, gender == GENDER_MALE),
        (FEMALE, gender == GENDER_FEMALE),
    )
    return F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in criteria]))
