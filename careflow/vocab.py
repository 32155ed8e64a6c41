"""Keyword lists.  They are data: every operator takes its list as a parameter."""

from __future__ import annotations

# Where a row comes from, and the one drug type.
TAG_OUTPATIENT, TAG_INPATIENT, TAG_TEST = "门急诊", "住院", "检查"
DRUG_TYPE = "抗病毒药物"

# Match vocabularies.
COVID_DIAGNOSIS = ("新冠", "冠状病毒", "COVID", "SARS-CoV-2", "新型冠状")
COVID_TEST = ("新冠", "冠状病毒", "COVID", "SARS-CoV-2", "核酸", "PCR", "抗原")
ANTIVIRAL = (
    "利巴韦林", "阿比多尔", "奥司他韦", "扎那米韦", "帕拉米韦", "法匹拉韦",
    "瑞德西韦", "洛匹那韦", "利托那韦", "达芦那韦", "克立芝", "克力芝",
    "抗病毒", "抗病毒药", "抗病毒药物", "抗病毒治疗",
    "Ribavirin", "Arbidol", "Oseltamivir", "Zanamivir", "Peramivir", "Favipiravir",
    "Remdesivir", "Lopinavir", "Ritonavir", "Darunavir", "Kaletra",
)
RS_CODES = (
    "R50", "J00", "J01", "J02", "J03", "J04", "J06", "J07", "J08", "J09", "J10", "J11",
    "J12", "J13", "J14", "J15", "J16", "J17", "J18", "J20", "J21", "J98.414", "J98.802",
)
COVID_PATIENT_TEXT = "新型冠状病毒感染"
PNEUMONIA_TEXT = ("肺部感染", "肺炎")

# A column is a date column when its name holds one of these.
DATE_COLUMN_NAMES = (
    "就诊日期", "开始日期", "门诊日期", "就诊结束日期", "结束日期",
    "出院日期", "入院日期", "住院开始日期", "住院结束日期",
)

# A column identifies a row when its lower-cased name holds one of these.
ID_COLUMN_NAMES = ("id", "编号", "标识")

# Keywords that locate an input column.
PATIENT_ID = ("患者ID", "病人ID", "就诊ID")
UNIQUE_PATIENT_ID = ("患者ID", "病人ID", "唯一标识")
PATIENT_ID_ALIAS = "患者编号"
DIAGNOSIS = ("诊断", "疾病", "病名")
DIAGNOSIS_CODE = ("诊断编码", "疾病编码", "ICD")
VISIT_DATE = ("就诊日期", "开始日期", "门诊日期")
TEST_NAME = ("检查名称", "检验名称", "项目名称")
TEST_RESULT = ("检查结果", "检验结果", "结果")
TEST_DATE = ("检查日期", "检验日期", "日期")
TEST_METHOD = ("检查方法", "检验方法", "方法")
TEST_DEPARTMENT = ("检查部门", "检验部门", "部门", "科室")
DRUG_NAME = ("药物名称", "药品名称", "医嘱内容", "药名")
DRUG_DATE = ("用药日期", "医嘱日期", "开始日期")
DOSE = ("剂量", "用量", "单次用量")
FREQUENCY = ("频次", "用药频次", "给药频次")
ROUTE = ("途径", "给药途径", "用药途径")
AGE = ("年龄",)
GENDER = ("性别",)
REGION = ("地区", "区域", "地址", "住址")
NAME = ("姓名", "患者姓名", "病人姓名")
BIRTH = ("出生", "生日", "出生日期")
CONTACT = ("联系", "电话", "手机", "联系方式")
ADDRESS = ("地址", "住址", "家庭住址")
LATEST_DATE = ("日期", "时间", "就诊日期", "入院日期")
ADMISSION_DATE = ("入院日期",)

# Keywords that mark a target column, compared with its lower-cased name.
# Where a target column is marked by the same words as an input column, the list above
# serves both.
TO_PATIENT = ("患者", "病人", "就诊")
TO_UNIQUE_PATIENT = ("患者id", "病人id", "唯一标识")
TO_VISIT_TYPE = ("就诊类型", "类型", "来源")
TO_CODE = ("编码", "icd")
TO_INFECTION = ("感染状态", "感染情况", "感染结果")
TO_TEST_DAY = ("检查日期", "检验日期")
TO_RESULT_TYPE = ("结果类型", "结果判断")
TO_DRUG_TYPE = ("药物类型", "药品类型", "类型")
TO_AGE_BAND = ("年龄段", "年龄组", "年龄分组")
TO_POPULATION = ("人群类别", "人群分类", "人群划分")

# Lookups with the intended meaning: alternatives are tried in turn.
ANY_PATIENT_ID = (PATIENT_ID, (PATIENT_ID_ALIAS,))
ANY_UNIQUE_PATIENT_ID = (UNIQUE_PATIENT_ID, (PATIENT_ID_ALIAS,))
VISIT_PATIENT_ID = ((PATIENT_ID_ALIAS,), PATIENT_ID)
# Diagnosis text comes before the code column, whose name holds the same word.
DIAGNOSIS_TEXT_FIRST = (("诊断（文字）", "诊断文字"), DIAGNOSIS)
