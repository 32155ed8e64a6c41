"""Target headers, input sheet names and row-identity columns."""

from __future__ import annotations

from pyspark.sql import types as T

# Reserved columns that travel with every row.  Spark has no row order, so every
# "keep the first row" rule ends its ordering with these.
SOURCE_FILE = "_source_file"
SOURCE_RANK = "_source_rank"
ROW_IDX = "_row_idx"
ROW_ID = (SOURCE_FILE, SOURCE_RANK, ROW_IDX)

# Input sheet names.
OUTPATIENT = "门急诊信息"
INPATIENT = "住院信息"
DRUG_ORDERS = "药物医嘱信息"
EXAMINATIONS = "检查信息"
STATISTICS = "统计数据"

# Output table names, in output order.
LIS01 = "Lis01_就诊合并"
LIS02 = "Lis02_诊断"
LIS03 = "Lis03_新冠感染"
LIS04 = "Lis04_抗病毒药物"
LIS05 = "Lis05_新冠检测"
LIS06 = "Lis06_人群划分"
LISA1 = "LisA1_唯一患者"
TABLES = (LIS01, LIS02, LIS03, LIS04, LIS05, LIS06, LISA1)

# Default target headers.
HEADERS: dict[str, tuple[str, ...]] = {
    LIS01: (
        "医院编码", "医院名称", "患者编号", "患者唯一编码", "来源", "年龄（周岁）", "性别",
        "就诊科室", "就诊类别", "就诊日期", "就诊结束日期", "诊断（ICD编码）", "诊断（文字）",
        "主诉", "现病史（临床症状）", "既往新冠阳性次数", "上次感染日期", "疫苗接种次数",
        "末次接种日期", "是否收入院", "入院日期", "出院日期", "是否收入ICU", "入ICU日期",
        "出ICU日期", "是否死亡", "死亡诊断", "死亡日期",
    ),
    LIS03: (
        "患者ID", "姓名", "就诊类型", "就诊日期", "诊断", "感染状态", "检测方法", "检测结果",
        "检测日期", "症状", "严重程度", "治疗方案", "数据来源", "数据更新时间",
    ),
    LIS04: (
        "患者ID", "姓名", "药物名称", "药物类型", "用药日期", "剂量", "单位", "频次",
        "用药途径", "用药天数", "医嘱医生", "医嘱科室", "数据来源", "数据更新时间",
    ),
    LIS05: (
        "患者ID", "姓名", "检查名称", "检查方法", "检查日期", "检查结果", "结果类型", "CT值",
        "检查部门", "采样部位", "备注", "数据来源", "数据更新时间",
    ),
    LIS06: (
        "患者ID", "姓名", "年龄", "性别", "地区", "年龄段", "人群类别", "特殊人群标记",
        "备注", "数据来源", "数据更新时间",
    ),
    LISA1: (
        "患者ID", "姓名", "年龄", "性别", "出生日期", "联系方式", "家庭住址",
        "首次就诊日期", "最近就诊日期", "就诊次数", "数据来源", "数据更新时间",
    ),
}
FLAG_COLUMNS = ("新冠患者", "RS患者", "诊断合并为肺炎")
HEADERS[LIS02] = HEADERS[LIS01][:14] + FLAG_COLUMNS

# Header of the diagnosis extract.
DIAGNOSIS_EXTRACT_HEADER = (
    "患者ID", "姓名", "就诊类型", "就诊日期", "诊断", "诊断编码", "诊断类型", "诊断医生",
    "诊断科室", "诊断状态", "数据来源", "数据更新时间", "诊断（ICD编码）", "诊断（文字）",
    "新冠患者", "RS患者", "诊断合并为肺炎",
)

# The one target column that is not text.
COLUMN_TYPES: dict[str, T.DataType] = {"就诊次数": T.LongType()}


def target_type(column: str) -> T.DataType:
    return COLUMN_TYPES.get(column, T.StringType())


def target_schema(table: str) -> T.StructType:
    """Schema of one output table; all text but for the visit count."""
    return T.StructType([T.StructField(c, target_type(c)) for c in HEADERS[table]])
