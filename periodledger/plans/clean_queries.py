"""Cleaning of text, numbers, units and identities over dirty values derived from the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from periodledger.functions import context as C
from periodledger.functions.hashing import canonical_row, content_hash
from periodledger.functions.identity import emission_scope, with_pollutant
from periodledger.functions.numbers import with_number
from periodledger.functions.text import clean_map, clean_text, fold_key
from periodledger.functions.units import normalize_unit, unit_evidence, with_unit
from periodledger.operators.catalog import html_text
from periodledger.plans import fixtures
from periodledger.plans.common import joined, pick, text
from periodledger.sources.reports import with_url_identity


def q_clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents, cleaned and folded."""
    docs = fixtures.table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("clean", clean_text(F.col("text"))).withColumn("folded", fold_key(F.col("clean")))
    return docs.select("doc_id", F.char_length("clean").alias("n_chars"), content_hash(F.col("clean")).alias("clean_sha"),
                       content_hash(F.col("folded")).alias("key_sha"))


CLEAN_SQL = r"""
WITH c AS (SELECT doc_id, regexp_replace(regexp_replace(text, '<[^>]*>', '', 'g'), '^\s+|\s+$', '', 'g') AS clean FROM documents),
f AS (SELECT *, replace(lower(regexp_replace(clean, '\s+', '', 'g')), 'ß', 'ss') AS folded FROM c)
SELECT doc_id, CAST(length(clean) AS INT) AS n_chars, sha256(clean) AS clean_sha, sha256(folded) AS key_sha FROM f"""

LABELS = ["NO<sub>x</sub>", " Ａｂ Ｃ ", "单位：万Nm³", "<b>颗粒物</b>", "　氨（氨气）　", "A &amp; B", "Ⅳ ㎏", "x&lt;y"]
LABELS_CLEAN = ["NOx", "Ab C ", "单位:万Nm3", "颗粒物", "氨(氨气) ", "A & B", "IV kg", "x<y"]
LABELS_KEY = ["nox", "abc", "单位:万nm3", "颗粒物", "氨(氨气)", "a&b", "ivkg", "x<y"]


def q_clean_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags, entities, full-width and compatibility characters in labels."""
    li = fixtures.table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey")
    raw = F.concat(pick(LABELS, F.col("l_suppkey") % 8), F.lit(" "), text(F.col("l_partkey") % 50))
    rows = li.select(raw.alias("raw"))
    rows = rows.withColumn("clean", clean_text(F.col("raw")))
    return rows.groupBy("raw", "clean", fold_key(F.col("clean")).alias("folded")).agg(F.count(F.lit(1)).alias("n"))


def _case(values: list[str], index: str) -> str:
    return "CASE " + index + "".join(f" WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


LABELS_SQL = f"""
SELECT {_case(LABELS, 'l_suppkey % 8')} || ' ' || (l_partkey % 50) AS raw,
       ({_case(LABELS_CLEAN, 'l_suppkey % 8')} || ' ' || (l_partkey % 50)) AS clean,
       {_case(LABELS_KEY, 'l_suppkey % 8')} || (l_partkey % 50) AS folded, count(*) AS n
FROM lineitem GROUP BY 1, 2, 3"""


def q_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = fixtures.table(spark, sf_dir, "pages").select("page_id", html_text(F.col("html")).alias("t"))
    return pages.select("page_id", F.char_length("t").alias("n_chars"), content_hash(F.col("t")).alias("text_sha"))


PAGE_TEXT_SQL = r"""
WITH a AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script\s*>', ' ', 'g'), '(?is)<style\b.*?</style\s*>', ' ', 'g') AS t FROM pages),
b AS (SELECT page_id, regexp_replace(regexp_replace(t, '(?s)<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g') AS t FROM a),
b1 AS (SELECT page_id, regexp_replace(replace(replace(t, '&copy;', '©'), '&middot;', '·'), '&amp($|[^;])', '&amp;\1', 'g') AS t FROM b),
c AS (SELECT page_id, replace(replace(replace(replace(replace(replace(t, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&') AS t FROM b1),
d AS (SELECT page_id, trim(regexp_replace(t, '\s+', ' ', 'g')) AS t FROM c)
SELECT page_id, CAST(length(t) AS INT) AS n_chars, sha256(t) AS text_sha FROM d"""


def _values(li: DataFrame) -> DataFrame:
    """Reported values of twelve kinds, most of them not plain numbers."""
    o, p, s = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    kind = o % 12
    raw = (
        F.when(kind == 0, "0").when(kind == 1, "/").when(kind == 2, "").when(kind == 3, F.lit(None)).when(kind == 4, F.concat(F.lit("-"), text(p)))
        .when(kind == 5, "NaN").when(kind == 6, "不适用")
        .when(kind == 7, F.concat(text(p % 900 + 1), F.lit(","), F.lpad(text(s % 1000), 3, "0"), F.lit(".5")))
        .when(kind == 8, F.concat(text(p), F.lit(",2"))).when(kind == 9, F.concat(text(p % 1000 + 1), F.lit("e-3")))
        .when(kind == 10, F.concat(text(s), F.lit(".25"))).otherwise(F.concat(F.lit(" "), text(p), F.lit(" ")))
    )
    return li.select("l_orderkey", "l_linenumber", raw.alias("value_raw"), (kind != 2).alias("present"), kind.alias("kind"), p.alias("p"), s.alias("s"))


def q_value_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _values(fixtures.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    rows = rows.withColumn("clean", clean_text(F.col("value_raw")))
    return with_number(rows, clean="clean", raw="value_raw", present="present").groupBy(
        "value_raw", "present", "value_status", "value").agg(F.count(F.lit(1)).alias("n"))


VALUE_SQL = """
WITH r AS (
  SELECT l_orderkey % 12 AS k, l_partkey AS p, l_suppkey AS s FROM lineitem),
v AS (
  SELECT *, CASE k WHEN 0 THEN '0' WHEN 1 THEN '/' WHEN 2 THEN '' WHEN 3 THEN NULL WHEN 4 THEN '-' || p WHEN 5 THEN 'NaN' WHEN 6 THEN '不适用'
     WHEN 7 THEN (p % 900 + 1) || ',' || lpad(CAST(s % 1000 AS VARCHAR), 3, '0') || '.5' WHEN 8 THEN p || ',2'
     WHEN 9 THEN (p % 1000 + 1) || 'e-3' WHEN 10 THEN s || '.25' ELSE ' ' || p || ' ' END AS value_raw,
     CASE k WHEN 0 THEN 'reported_zero' WHEN 1 THEN 'not_reported' WHEN 2 THEN 'not_reported' WHEN 3 THEN 'missing' WHEN 6 THEN 'not_applicable'
     WHEN 4 THEN 'invalid' WHEN 5 THEN 'invalid' WHEN 8 THEN 'invalid'
     WHEN 11 THEN CASE WHEN p = 0 THEN 'reported_zero' ELSE 'reported_numeric' END ELSE 'reported_numeric' END AS value_status,
     CASE k WHEN 0 THEN 0.0 WHEN 7 THEN (p % 900 + 1) * 1000 + s % 1000 + 0.5 WHEN 9 THEN (p % 1000 + 1) / 1000.0
     WHEN 10 THEN s + 0.25 WHEN 11 THEN p END AS value FROM r)
SELECT value_raw, k <> 2 AS present, value_status, CAST(value AS DOUBLE) AS value, count(*) AS n FROM v GROUP BY 1, 2, 3, 4"""

RAW_UNITS = ["吨", " (T) ", "KG", "万Nm³", "标准立方米", "米3", "mg/m^3", "【千克】；", "t/a", "无量纲", "ｋｇ／ｈ"]
UNITS = ["t", "t", "kg", "万Nm3", "Nm3", "m3", "mg/m3", "kg", None, "dimensionless", "kg/h"]


def q_unit_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.table(spark, sf_dir, "lineitem").select(pick(RAW_UNITS, F.col("l_partkey") % 11).alias("raw"))
    rows = rows.withColumn("unit", normalize_unit(clean_text(F.col("raw"))))
    return rows.groupBy("raw", "unit").agg(F.count(F.lit(1)).alias("n"))


def _unit_case(values, index: str) -> str:
    return "CASE " + index + "".join(f" WHEN {i} THEN " + ("NULL" if v is None else f"'{v}'") for i, v in enumerate(values)) + " END"


UNIT_NORMALIZE_SQL = f"""
SELECT {_unit_case(RAW_UNITS, 'l_partkey % 11')} AS raw, {_unit_case(UNITS, 'l_partkey % 11')} AS unit, count(*) AS n FROM lineitem GROUP BY 1, 2"""

# Variants of a row: remark, unit field; and what follows from them for four kinds of metric.
UNIT_ROWS = [
    (None, None), ("单位：kg", None), (None, "吨"), ("单位：kg", "吨"), ("单位为 kg 每月；其他", None), ("单位名称", None),
    (None, "mg/m³"), ("单位:t，单位:吨", None), (None, "/"), (None, "浴缸"), ("单位：t", "浴缸"), (None, "万m3"),
]
METRICS = [("A21002", "NOx"), ("/", "工业废气排放量"), ("A01010", "林格曼黑度"), ("X", "未知指标")]
_E = {  # (variant, metric) -> unit, source, status; metric '*' where all agree
    0: {0: ("t", "template", "template_default"), 1: (None, "unresolved", "unknown"), 2: ("dimensionless", "index", "known"),
        3: (None, "unresolved", "unknown")},
    1: {0: ("kg", "row.remark", "known"), 1: ("kg", "row.remark", "conflict"), 2: ("kg", "row.remark", "conflict"), 3: ("kg", "row.remark", "known")},
    2: {0: ("t", "row.unit", "known"), 1: ("t", "row.unit", "conflict"), 2: ("t", "row.unit", "conflict"), 3: ("t", "row.unit", "known")},
    3: {m: ("kg", "row.remark", "conflict") for m in range(4)},
    4: {0: ("kg", "row.remark", "known"), 1: ("kg", "row.remark", "conflict"), 2: ("kg", "row.remark", "conflict"), 3: ("kg", "row.remark", "known")},
    5: {m: (None, "row.remark", "unknown") for m in range(4)},
    6: {0: ("mg/m3", "row.unit", "conflict"), 1: ("mg/m3", "row.unit", "known"), 2: ("mg/m3", "row.unit", "known"), 3: ("mg/m3", "row.unit", "known")},
    7: {0: ("t", "row.remark", "known"), 1: ("t", "row.remark", "conflict"), 2: ("t", "row.remark", "conflict"), 3: ("t", "row.remark", "known")},
    9: {m: (None, "row.unit", "unknown") for m in range(4)},
    10: {m: ("t", "row.remark", "conflict") for m in range(4)},
    11: {0: ("万m3", "row.unit", "conflict"), 1: ("万m3", "row.unit", "known"), 2: ("万m3", "row.unit", "conflict"), 3: ("万m3", "row.unit", "known")},
}
_E[8] = _E[0]


def q_unit_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = fixtures.table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey")
    variant, metric = (F.col("l_partkey") % 12).cast("int"), (F.col("l_suppkey") % 4).cast("int")
    rows = li.select(variant.alias("variant"), metric.alias("metric"), (F.col("l_orderkey") % 2 == 0).alias("monthly"))
    raw = F.create_map(F.lit("remark"), pick([r for r, _ in UNIT_ROWS], F.col("variant")),
                       F.lit("unit"), pick([u for _, u in UNIT_ROWS], F.col("variant")))
    rows = rows.withColumn("row", raw).withColumn("clean", clean_map(F.col("row")))
    rows = rows.withColumns({
        "unit_evidence": unit_evidence(F.col("row"), F.col("clean")),
        "code": pick([c for c, _ in METRICS], F.col("metric")), "name": pick([n for _, n in METRICS], F.col("metric")),
        "report_type": F.when(F.col("monthly"), "month").otherwise("quarter"),
        "template_allowed": F.lit(True), "template_unit": F.lit("吨"), "template_unit_clean": F.lit("吨"),
        "template_source": F.lit(None).cast("string"), "template_note": F.lit(None).cast("string"),
    })
    rows = with_unit(with_pollutant(rows, "code", "name"))
    short = F.when(F.col("unit_source").startswith("reviewed_"), "template").when(F.col("unit_source").startswith("indicator_"), "index") \
        .otherwise(F.col("unit_source"))
    return rows.groupBy("variant", "metric", "unit", short.alias("source"), "unit_status", "unit_additive", "dimension").agg(
        F.count(F.lit(1)).alias("n"))


def _unit_resolve_sql() -> str:
    additive = {"t": "mass", "kg": "mass", "万m3": "volume"}
    kinds = ["mass", "volume", "index", "unknown"]
    quote = lambda v: "NULL" if v is None else f"'{v}'"
    rows = []
    for v in range(12):
        for m in range(4):
            unit, source, status = _E[v][m]
            adds = unit in additive and status in ("known", "template_default")
            rows.append(f"({v}, {m}, {quote(unit)}, '{source}', '{status}', {str(adds).lower()}, '{additive.get(unit) or kinds[m]}')")
    return f"""
WITH t(variant, metric, unit, source, unit_status, unit_additive, dimension) AS (VALUES {", ".join(rows)}),
r AS (SELECT CAST(l_partkey % 12 AS INT) AS variant, CAST(l_suppkey % 4 AS INT) AS metric, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT * FROM t JOIN r USING (variant, metric)"""


IDENTITIES = [  # code, name -> key, display name, conflict, metric kind
    ("A21002", "氮氧化物", "code:A21002", "NOx", False, "mass"), ("a21002", "NOx", "code:A21002", "NOx", False, "mass"),
    ("A21002", "二氧化硫", "code:A21002", "NOx", True, "mass"), ("/", "氮氧化物", "name:nox", "NOx", False, "mass"),
    ("", "氨（氨气）", "name:氨", "氨", False, "mass"), ("C1", "氮氧化物浓度", "code:C1", "氮氧化物浓度", False, "concentration"),
    ("", "", "", "", False, "unknown"), ("A01010", "林格曼黑度", "code:A01010", "林格曼黑度", False, "index"),
    ("/", "烟气排放量", "name:烟气排放量", "烟气排放量", False, "volume"), ("Q7", "排放速率", "code:Q7", "排放速率", False, "rate"),
    ("A99911", "", "code:A99911", "颗粒物", False, "mass"), ("CUSTOM", "未知指标", "code:CUSTOM", "未知指标", False, "unknown"),
    ("CUSTOM2", "氯化氢", "code:CUSTOM2", "氯化氢", False, "mass"),
]


def q_pollutant_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 13).cast("int").alias("variant"))
    rows = rows.withColumns({"code": clean_text(pick([i[0] for i in IDENTITIES], F.col("variant"))),
                             "name": clean_text(pick([i[1] for i in IDENTITIES], F.col("variant")))})
    rows = with_pollutant(rows, "code", "name")
    return rows.groupBy("variant", "pollutant_identity", "pollutant_name", "pollutant_identity_conflict", "metric_kind").agg(
        F.count(F.lit(1)).alias("n"))


def q_metric_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_pollutant_identity(spark, sf_dir).groupBy("metric_kind").agg(F.sum("n").alias("n"))


_IDENTITY_ROWS = ", ".join(f"({i}, '{k}', '{d}', {str(c).lower()}, '{m}')" for i, (_, _, k, d, c, m) in enumerate(IDENTITIES))
IDENTITY_SQL = f"""
WITH t(variant, pollutant_identity, pollutant_name, pollutant_identity_conflict, metric_kind) AS (VALUES {_IDENTITY_ROWS}),
r AS (SELECT CAST(l_suppkey % 13 AS INT) AS variant, count(*) AS n FROM lineitem GROUP BY 1)
SELECT * FROM t JOIN r USING (variant)"""

SECTIONS = ["airTotalEmission", "airUnorganizedEmission", "airMinorEmission", "airMainEmission", "airOther", "AIRMainEmission"]
PORTS = ["", "全厂合计", "无组织（合计）", "一般排放口（合计）", "主要排放口"]


def q_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = fixtures.table(spark, sf_dir, "lineitem")
    rows = li.select(
        pick(SECTIONS, F.col("l_orderkey") % 6).alias("section"), clean_text(pick(PORTS, F.col("l_partkey") % 5)).alias("port_type"),
        F.when(F.col("l_suppkey") % 3 == 0, "").otherwise("DA001").alias("outlet_code"),
        F.when(F.col("l_suppkey") % 5 == 0, "无组织排放").otherwise("x").alias("outlet_name"))
    scope = emission_scope(F.col("section"), F.col("port_type"), F.col("outlet_name"), F.col("outlet_code"))
    return rows.groupBy("section", "port_type", "outlet_code", "outlet_name", scope.alias("scope")).agg(F.count(F.lit(1)).alias("n"))


SCOPE_SQL = f"""
WITH r AS (
  SELECT {_case(SECTIONS, 'l_orderkey % 6')} AS section, translate({_case(PORTS, 'l_partkey % 5')}, '（）', '()') AS port_type,
         CASE WHEN l_suppkey % 3 = 0 THEN '' ELSE 'DA001' END AS outlet_code,
         CASE WHEN l_suppkey % 5 = 0 THEN '无组织排放' ELSE 'x' END AS outlet_name FROM lineitem),
g AS (SELECT *, port_type LIKE '%合计%' AS grouped FROM r)
SELECT section, port_type, outlet_code, outlet_name,
       CASE WHEN section = 'airTotalEmission' OR port_type = '全厂合计' THEN 'enterprise_total'
            WHEN section = 'airUnorganizedEmission' OR port_type LIKE '%无组织%' OR outlet_name = '无组织排放'
              THEN CASE WHEN outlet_code = '' OR grouped THEN 'fugitive_group_total' ELSE 'fugitive_outlet' END
            WHEN section = 'airMinorEmission' THEN CASE WHEN outlet_code = '' OR grouped THEN 'minor_group_total' ELSE 'minor_outlet' END
            WHEN section = 'airMainEmission' THEN CASE WHEN grouped THEN 'main_group_total' ELSE 'main_outlet' END
            ELSE 'unknown:' || section END AS scope, count(*) AS n
FROM g GROUP BY ALL"""


def _context_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One report heading per order, with gaps that the fallback chains have to fill."""
    k, c = F.col("o_orderkey"), text("o_custkey")
    y, m = F.year("o_orderdate"), F.month("o_orderdate")
    quarter = F.quarter("o_orderdate")
    orders = fixtures.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    month_text = F.concat(text(y), F.lit("年"), text(m), F.lit("月"))
    quarter_text = F.concat(text(y), F.lit("年第0"), text(quarter), F.lit("季"))
    own = F.when(k % 4 == 0, quarter_text).otherwise(month_text)
    null = F.lit(None).cast("string")
    info = F.create_map(
        F.lit("reportTime"), F.when(k % 5 != 1, own), F.lit("reportType"), F.when(k % 7 != 2, F.when(k % 4 == 0, "季报").otherwise("月报表")),
        F.lit("reportQuarter"), F.when((k % 4 == 0) & (k % 3 == 0), text(k % 4 + 1)), F.lit("permitCode"), F.when(k % 6 != 3, F.concat(F.lit(" P"), c)),
        F.lit("reportId"), F.concat(F.lit("body-"), text(k)), F.lit("enterName"), F.when(k % 2 == 0, F.concat(F.lit("N"), c)))
    filed = F.when(k % 9 == 4, F.concat(text(y - 1), F.lit("年"), text(m), F.lit("月"))).otherwise(own)
    meta = F.create_map(
        F.lit("report_period"), F.when(k % 8 != 5, filed), F.lit("report_type"), F.when(k % 4 == 0, "quarterly").otherwise("Month"),
        F.lit("permit_code"), F.when(k % 10 == 7, F.lit("OTHER")).when(k % 10 != 6, F.concat(F.lit("P"), c)),
        F.lit("url"), F.when(k % 3 != 0, F.concat(F.lit("https://reports.example/#/pubView?reportId=url-"), text(k), F.lit("&x=1"))),
        F.lit("report_id"), F.when(k % 12 == 0, F.concat(F.lit("meta-"), text(k))))
    enterprise = F.create_map(F.lit("dataid"), F.when(k % 2 == 0, F.concat(F.lit("E"), c)), F.lit("permitCode"), F.concat(F.lit("P"), c),
                              F.lit("name"), F.concat(F.lit("M"), c))
    return orders.select("o_orderkey", info.alias("info"), meta.alias("meta"), enterprise.alias("enterprise"))


def q_report_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.with_report_context(_context_reports(spark, sf_dir))
    return rows.select("o_orderkey", "report_type", "year", "report_month", "report_quarter", "report_id", "permit_code",
                       "expected_permit_code", "enterprise_id", "enterprise_name")


CONTEXT = """
WITH b AS (
  SELECT o_orderkey AS k, o_custkey AS c, CAST(year(o_orderdate) AS INT) AS y, CAST(month(o_orderdate) AS INT) AS m,
         CAST(quarter(o_orderdate) AS INT) AS q FROM orders),
x AS (
  SELECT *, k % 4 = 0 AS is_q, k % 5 <> 1 AS own, k % 8 <> 5 AS filed, k % 9 = 4 AS shifted,
         (k % 4 = 0) AND (k % 3 = 0) AS has_field FROM b),
-- The period text that counts: the report's own, else the one it was filed under.
z AS (
  SELECT *, own OR filed AS timed, own OR (filed AND NOT shifted) AS plain,
         CASE WHEN own THEN y WHEN filed AND shifted THEN y - 1 WHEN filed THEN y END AS year,
         CASE WHEN (own AND NOT is_q) OR (NOT own AND filed AND (shifted OR NOT is_q)) THEN m END AS month,
         CASE WHEN is_q AND (own OR (filed AND NOT shifted)) THEN q END AS text_q FROM x),
w AS (
  SELECT *, CASE WHEN has_field THEN CAST(k % 4 + 1 AS INT) ELSE text_q END AS quarter,
         CASE WHEN k % 10 = 7 THEN 'OTHER' ELSE 'P' || c END AS expected,
         CASE WHEN k % 6 <> 3 THEN 'P' || c WHEN k % 10 = 7 THEN 'OTHER' ELSE 'P' || c END AS permit FROM z)"""

CONTEXT_SQL = CONTEXT + """
SELECT k AS o_orderkey, CASE WHEN is_q THEN 'quarter' ELSE 'month' END AS report_type, year, month AS report_month, quarter AS report_quarter,
       CASE WHEN k % 12 = 0 THEN 'meta-' || k WHEN k % 3 <> 0 THEN 'url-' || k ELSE 'body-' || k END AS report_id,
       permit AS permit_code, expected AS expected_permit_code,
       CASE WHEN k % 2 = 0 THEN 'E' || c ELSE permit END AS enterprise_id, CASE WHEN k % 2 = 0 THEN 'N' || c ELSE 'M' || c END AS enterprise_name
FROM w"""


def q_identity_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.with_report_context(_context_reports(spark, sf_dir))
    return rows.groupBy("report_type", joined("identity_conflicts")).agg(F.count(F.lit(1)).alias("n"))


CONFLICT_SQL = CONTEXT + """
SELECT CASE WHEN is_q THEN 'quarter' ELSE 'month' END AS report_type,
       concat_ws(',', CASE WHEN text_q <> quarter THEN 'report_quarter_mismatch' END,
                      CASE WHEN own AND filed AND (shifted OR (is_q AND NOT shifted AND q <> quarter)) THEN 'report_period_mismatch' END,
                      CASE WHEN expected <> permit THEN 'permit_code_mismatch' END) AS identity_conflicts, count(*) AS n
FROM w GROUP BY 1, 2"""


def q_url_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    ids = {n: F.md5(F.concat(F.lit(n), text(k))) for n in ("r", "p", "y")}
    report = F.when(k % 7 == 3, F.upper(ids["r"])).otherwise(ids["r"])
    tail = F.concat(F.lit("reportId="), report, F.lit("&provinceSharding="), ids["p"], F.when(k % 5 != 2, F.concat(F.lit("&yearSharding="), ids["y"])).otherwise(F.lit("")))
    url = F.when(k % 11 == 6, F.concat(F.lit("https://reports.example/file.pdf?"), tail)).otherwise(
        F.concat(F.lit("https://reports.example/report/"), F.when(k % 2 == 0, F.lit("?reportId=outer")).otherwise(F.lit("")), F.lit("#/pubView?"), tail))
    rows = fixtures.table(spark, sf_dir, "orders").select("o_orderkey", url.alias("doc_url"))
    return with_url_identity(rows).select("o_orderkey", "reportId", "provinceSharding", "yearSharding", "url_status")


URL_SQL = """
WITH b AS (SELECT o_orderkey AS k, md5('r' || o_orderkey) AS r, md5('p' || o_orderkey) AS p, md5('y' || o_orderkey) AS y FROM orders)
SELECT k AS o_orderkey, CASE WHEN k % 7 = 3 THEN upper(r) ELSE r END AS "reportId", p AS "provinceSharding",
       CASE WHEN k % 5 <> 2 THEN y END AS "yearSharding",
       CASE WHEN k % 11 = 6 THEN 'unsupported_format' WHEN k % 5 = 2 OR (k % 7 = 3 AND upper(r) <> r) THEN 'invalid_identifier' ELSE 'ok' END AS url_status
FROM b"""


def q_row_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = fixtures.table(spark, sf_dir, "customer").select("c_name", "c_custkey", "c_nationkey", "c_mktsegment")
    customers = customers.withColumn("c_mktsegment", F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")))
    return customers.select("c_custkey", content_hash(canonical_row(customers)).alias("row_sha"))


ROW_HASH_SQL = """
SELECT c_custkey, sha256('{"c_custkey":' || c_custkey || ',"c_mktsegment":' || CASE WHEN c_custkey % 3 <> 0 THEN '"' || c_mktsegment || '"' ELSE 'null' END
       || ',"c_name":"' || c_name || '","c_nationkey":' || c_nationkey || '}') AS row_sha FROM customer"""

QUERIES = {
    "q_clean_text": q_clean_text, "q_clean_labels": q_clean_labels, "q_page_text": q_page_text, "q_value_status": q_value_status,
    "q_unit_normalize": q_unit_normalize, "q_unit_resolve": q_unit_resolve, "q_pollutant_identity": q_pollutant_identity,
    "q_metric_kind": q_metric_kind, "q_scope": q_scope, "q_report_context": q_report_context,
    "q_identity_conflicts": q_identity_conflicts, "q_url_params": q_url_params, "q_row_hash": q_row_hash,
}
ORACLES = {
    "q_clean_text": CLEAN_SQL, "q_clean_labels": LABELS_SQL, "q_page_text": PAGE_TEXT_SQL, "q_value_status": VALUE_SQL,
    "q_unit_normalize": UNIT_NORMALIZE_SQL, "q_unit_resolve": _unit_resolve_sql(), "q_pollutant_identity": IDENTITY_SQL,
    "q_metric_kind": f"SELECT metric_kind, CAST(sum(n) AS BIGINT) AS n FROM ({IDENTITY_SQL}) GROUP BY 1", "q_scope": SCOPE_SQL,
    "q_report_context": CONTEXT_SQL, "q_identity_conflicts": CONFLICT_SQL, "q_url_params": URL_SQL, "q_row_hash": ROW_HASH_SQL,
}
