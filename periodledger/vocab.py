"""Vocabularies and patterns the results depend on.

Everything below the marker is a fixed value: the published report format, not this
library, decides it, and a different spelling would give a different answer.
"""

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------

# Pollutant code -> (display name, accepted names).
POLLUTANTS = {
    "A21002": ("NOx", ["nox", "氮氧化物"]),
    "A21026": ("SO2", ["so2", "二氧化硫"]),
    "A34002": ("颗粒物", ["颗粒物"]),
    "A99911": ("颗粒物", ["颗粒物"]),
    "A34013": ("烟尘", ["烟尘"]),
    "A34012": ("粉尘", ["粉尘"]),
    "A20057": ("汞及其化合物", ["汞及其化合物"]),
    "A21001": ("氨", ["氨", "氨（氨气）", "氨(氨气)", "nh3"]),
    "A99901": ("VOCs", ["vocs", "挥发性有机物", "挥发性有机物(vocs)", "挥发性有机物（vocs）"]),
}

# Names that denote a mass emission when the code is not in POLLUTANTS.
MASS_NAMES = (
    "氮氧化物|二氧化硫|颗粒物|烟尘|粉尘|汞|铅|镉|铬|镍|砷|锰|铜|锌|锡|锑|铊|"
    "钴|硒|钡|银|铍|氨|氯化氢|氟化氢|氟化物|氯气|硫化氢|硫酸雾|氰化氢|"
    "一氧化碳|二氧化碳|总烃|非甲烷总烃|挥发性有机物|苯|酚|醛|醇|酮|胺|"
    "二噁英|二恶英|沥青烟|油烟|nox|so2|vocs|nmhc|nh3|hcl|hf|h2s|co2"
)

BLACKNESS_CODE = "A01010"
BLACKNESS_NAMES = "林格曼|黑度"
GAS_VOLUME_NAMES = "废气(?:排放)?量|烟气(?:排放)?量|气体体积"
CONCENTRATION_NAMES = "浓度"
RATE_NAMES = "速率|流量"

# Folded unit spelling -> unit.
UNITS = {
    "t": "t", "吨": "t", "tonne": "t", "tonnes": "t",
    "kg": "kg", "千克": "kg", "公斤": "kg",
    "g": "g", "克": "g", "mg": "mg", "毫克": "mg",
    "m3": "m3", "nm3": "Nm3", "标m3": "Nm3", "标准m3": "Nm3",
    "万m3": "万m3", "万nm3": "万Nm3", "万标m3": "万Nm3", "万标准m3": "万Nm3",
    "无量纲": "dimensionless", "级": "grade",
    "mg/m3": "mg/m3", "mg/nm3": "mg/Nm3", "kg/h": "kg/h", "g/s": "g/s", "%": "%",
}
UNIT_REWRITES = [("立方米", "m3"), ("米3", "m3"), ("^3", "3")]
UNIT_OUTER_CHARS = "()（）[]【】.,，;；。"
ADDITIVE_UNITS = {
    "t": "mass", "kg": "mass", "g": "mass", "mg": "mass",
    "m3": "volume", "Nm3": "volume", "万m3": "volume", "万Nm3": "volume",
}
NOT_A_MASS_UNIT = ["dimensionless", "grade", "mg/m3", "mg/Nm3", "kg/h", "g/s", "%"]
UNIT_NOTE = r"单位\s*(?:为|[:：=])?\s*([^,，;；。\n]+)"
UNIT_NOTE_BREAK = r"[\s,，;；。]"
UNIT_FIELDS = ["unit", "unitName", "emissionUnit", "emitUnit", "pollutantUnit", "measureUnit", "valueUnit"]
TEMPLATE_UNIT = "吨"
TEMPLATE_SOURCE_MONTH = "reviewed_official_viewer:air_month_actual_emission_header_tonnes"
TEMPLATE_SOURCE_OTHER = "reviewed_official_viewer:air_table_mass_unit_convention_from_tonnes_header"
INDEX_UNIT_SOURCE = "indicator_name:blackness_index"

# Reported values that are not numbers.
NOT_REPORTED_TOKENS = ["", "/", "-", "--", "—", "n/a", "na", "null", "未填", "未填报"]
NOT_APPLICABLE_TOKENS = ["不适用", "无此项"]
NUMBER = r"[+]?(?:(?:\d{1,3}(?:,\d{3})+|\d+)(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?"

# Report type wording -> type.
REPORT_TYPES = {
    "月报": "month", "月报表": "month", "month": "month", "monthly": "month",
    "季报": "quarter", "季报表": "quarter", "quarter": "quarter", "quarterly": "quarter",
    "年报": "year", "年报表": "year", "year": "year", "annual": "year",
}
ANNUAL_DECLARATIONS = ["年报", "年报表", "year", "annual"]
ANNUAL_WORD = "年报"

# Period wording.
YEAR_PATTERN = r"(?<!\d)((?:19|20)\d{2})(?!\d)"
MONTH_PATTERN = r"年\s*(\d{1,2})\s*月"
QUARTER_PATTERN = r"第?\s*0?([1-4])\s*季"

# Value fields per report type.
MONTH_FIELD = "emitValue"
QUARTER_FIELDS = ["firstMonth", "secondMonth", "thirdMonth"]
TOTAL_FIELD = "total"

# Scope wording.
PLANT_TOTAL = "全厂合计"
GROUP_TOTAL = "合计"
FUGITIVE = "无组织"
FUGITIVE_OUTLET = "无组织排放"

# Identifier shapes and facility text.
ENTERPRISE_ID = "[0-9a-f]{32}"
REPORT_PARAMETER = "[0-9a-f]{32,64}"
REPORT_PARAMETERS = ["reportId", "provinceSharding", "yearSharding"]
REGION_SEPARATOR = "[-－—]"
DETAIL_REGION = r"所在地区[：:]\s*(.*?)\s*发证机关"
DETAIL_ADDRESS = r"生产经营场所地址[：:]\s*(.*?)\s*行业类别"
CATALOG_COLUMNS = ["province", "city", "permit_code", "name", "industry", "validity", "issued", "management"]
CATALOG_LINK = "getxxgkContent"
CATALOG_PAGE_ROWS = 10
CATALOG_MAX_PAGES = 3000

# Columns that change from run to run and are ignored when runs are compared.
VOLATILE_COLUMNS = ["access_utc", "path", "retrieved_at", "download_path"]
DIFFERENCE_SAMPLE = 10
