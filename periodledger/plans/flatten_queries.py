"""Report bodies to long records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodledger.operators.flatten import explode_rows, flatten_reports, parse_bodies, prune_sections, rejected_bodies
from periodledger.plans import fixtures, oracles
from periodledger.plans.common import joined, text


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_reports(fixtures.bodies(spark, sf_dir))


def q_extract_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).select(
        "enterprise_id", "permit_code", "report_id", "report_type", "year", "month", "period_kind", "scope", "outlet_code",
        "pollutant_key", "unit", "unit_status", "field_present", "value_raw", "value_status", "value", "json_pointer",
        joined("identity_conflicts"), "aggregation_eligible")


# Rows of the bodies in body order, with every field their report type has.
BODIES = oracles.LINES + """,
rows AS (
  SELECT *, row_number() OVER (PARTITION BY e, t, y, per, rev ORDER BY p, o, dup) - 1 AS idx
  FROM (SELECT DISTINCT e, t, y, per, rev, p, o, dup FROM placed)),
fields AS (
  SELECT *, unnest(CASE t WHEN 'month' THEN [{'f': 'emitValue', 'm': per}]
      WHEN 'quarter' THEN [{'f': 'firstMonth', 'm': 3 * per - 2}, {'f': 'secondMonth', 'm': 3 * per - 1},
                           {'f': 'thirdMonth', 'm': 3 * per}, {'f': 'total', 'm': NULL}]
      ELSE [{'f': 'total', 'm': NULL}] END) AS x FROM rows),
long AS (
  SELECT f.e, f.t, f.y, f.per, f.rev, f.p, f.o, f.dup, idx, x.f AS field, x.m AS month, c.value_raw, c.field IS NOT NULL AS present
  FROM fields f LEFT JOIN cells c ON f.e = c.e AND f.t = c.t AND f.y = c.y AND f.per = c.per AND f.rev = c.rev
       AND f.p = c.p AND f.o = c.o AND f.dup = c.dup AND x.f = c.field),
extracted AS (
  SELECT 'E' || e AS enterprise_id, CASE WHEN e % 9 = 8 THEN 'X' ELSE 'P' END || e AS permit_code,
         t || '|' || e || '|' || y || '|' || per || '|' || rev AS report_id, t AS report_type, CAST(y AS INT) AS year, CAST(month AS INT) AS month,
         CASE WHEN month IS NULL THEN t ELSE 'month' END AS period_kind, 'main_outlet' AS scope, 'DA00' || (o + 1) AS outlet_code,
         CASE p WHEN 0 THEN 'code:A21002' WHEN 1 THEN 'code:A21026' WHEN 2 THEN 'code:A99911' ELSE 'name:工业废气排放量' END AS pollutant_key,
         CASE WHEN p = 3 THEN '万Nm3' ELSE 't' END AS unit, CASE WHEN p = 3 THEN 'known' ELSE 'template_default' END AS unit_status,
         present AS field_present, value_raw,
         CASE WHEN NOT present OR value_raw = '/' THEN 'not_reported' WHEN value_raw = '-1' THEN 'invalid'
              WHEN value_raw = '0' THEN 'reported_zero' ELSE 'reported_numeric' END AS value_status,
         CASE WHEN value_raw NOT IN ('/', '-1') THEN CAST(value_raw AS DOUBLE) END AS value,
         '/emissionInfo/airMainEmission/' || idx || '/' || field AS json_pointer, field,
         CASE WHEN e % 9 = 8 THEN 'permit_code_mismatch' ELSE '' END AS identity_conflicts,
         coalesce(value_raw NOT IN ('/', '-1') AND e % 9 <> 8, false) AS aggregation_eligible, e
  FROM long)"""

EXTRACT_SQL = "WITH " + BODIES + " SELECT * EXCLUDE (field, e) FROM extracted"


def q_eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).groupBy("enterprise_id", "value_status", "period_kind", "aggregation_eligible").agg(F.count(F.lit(1)).alias("n"))


ELIGIBILITY_SQL = "WITH " + BODIES + """
SELECT enterprise_id, value_status, period_kind, aggregation_eligible, count(*) AS n FROM extracted GROUP BY ALL"""


def q_unpivot_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).groupBy("report_type", "period_kind", "field", "year", "month").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("field_present").alias("present"))


UNPIVOT_SQL = "WITH " + BODIES + """
SELECT report_type, period_kind, field, year, month, count(*) AS n, count(*) FILTER (field_present) AS present FROM extracted GROUP BY ALL"""


def q_prune_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies with further air parts wrapped around them at several depths, nulls among them."""
    reports = fixtures.bodies(spark, sf_dir).select("report_id", "enterprise_id", "body")
    odd = F.substring("enterprise_id", 2, 20).cast("bigint") % 2 == 1
    extra = F.when(odd, '"monitoring":{"site":{"airQuality":"good","noise":"1"}},"a":{"b":{"c":{"d":{"e":{"airDeep":1,"airNull":null}}}}},').otherwise('"airNotes":null,')
    wrapped = F.concat(F.lit("{"), extra, F.substr("body", F.lit(2)))
    parts = prune_sections(reports.withColumn("body", wrapped), keys=["report_id"])
    return parts.select("report_id", "path", "status", F.col("value").isNotNull().alias("filled"))


PRUNE_SQL = "WITH " + oracles.LINES + """,
r AS (SELECT DISTINCT e, t || '|' || e || '|' || y || '|' || per || '|' || rev AS report_id FROM placed)
SELECT report_id, '/companyInfo' AS path, 'kept' AS status, true AS filled FROM r
UNION ALL SELECT report_id, '/emissionInfo/airMainEmission', 'kept', true FROM r
UNION ALL SELECT report_id, '/monitoring/site/airQuality', 'kept', true FROM r WHERE e % 2 = 1
UNION ALL SELECT report_id, '/a/b/c/d/e/airDeep', 'kept', true FROM r WHERE e % 2 = 1
UNION ALL SELECT report_id, '/a/b/c/d/e/airNull', 'kept', false FROM r WHERE e % 2 = 1
UNION ALL SELECT report_id, '/airNotes', 'kept', false FROM r WHERE e % 2 = 0"""


def _mixed_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One body per customer: readable, broken, missing, or with JSON strings that hold objects."""
    k = F.col("c_custkey")
    quoted = F.lit('"{\\"airQ\\":1,\\"pollutantName\\":\\"NOx\\"}"')
    body = (
        F.when(k % 8 == 0, F.lit('{"emissionInfo":')).when(k % 8 == 1, F.lit("[1]")).when(k % 8 == 2, F.lit(None))
        .when(k % 8 == 3, F.concat(F.lit('{"a":'), quoted, F.lit(',"b":{"airB":'), text(k), F.lit("}}")))
        .when(k % 8 == 4, F.concat(F.lit('{"emissionInfo":{"airX":['), quoted, F.lit(',{"pollutantName":"NOx"}]},"airTop":'), quoted, F.lit("}")))
        .when(k % 8 == 5, F.concat(F.lit('{"emissionInfo":'), quoted, F.lit(',"companyInfo":'), quoted, F.lit("}")))
        .when(k % 8 == 6, F.lit('"{}"')).otherwise(F.lit('{"x":{"airY":{"z":1}}}')))
    return fixtures.table(spark, sf_dir, "customer").select("c_custkey", body.alias("body"))


def q_unreadable_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_bodies(_mixed_bodies(spark, sf_dir), ["c_custkey"])


UNREADABLE_SQL = """
SELECT c_custkey, CASE WHEN c_custkey % 8 = 2 THEN 'body_missing' ELSE 'body_not_an_object' END AS reason FROM customer WHERE c_custkey % 8 IN (0, 1, 2, 6)"""


def q_typed_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Air parts and section rows of the mixed bodies: strings are not opened, unreadable bodies are listed."""
    bodies = _mixed_bodies(spark, sf_dir)
    parts = prune_sections(bodies, keys=["c_custkey"]).select("c_custkey", F.coalesce("path", F.lit("-")).alias("path"), "status")
    rows = explode_rows(parse_bodies(bodies)).select(
        "c_custkey", F.col("row_json_pointer").alias("path"), F.coalesce(F.nullif(F.array_join("schema_warnings", ","), F.lit("")), F.lit("row")).alias("status"))
    return parts.unionByName(rows)


TYPED_SQL = """
WITH c AS (SELECT c_custkey, c_custkey % 8 AS r FROM customer)
SELECT c_custkey, '-' AS path, 'unreadable_body' AS status FROM c WHERE r IN (0, 1, 2, 6)
UNION ALL SELECT c_custkey, '/b/airB', 'kept' FROM c WHERE r = 3
UNION ALL SELECT c_custkey, '/emissionInfo/airX', 'kept' FROM c WHERE r = 4 UNION ALL SELECT c_custkey, '/airTop', 'kept' FROM c WHERE r = 4
UNION ALL SELECT c_custkey, '/emissionInfo/airX/0', 'row_not_object' FROM c WHERE r = 4 UNION ALL SELECT c_custkey, '/emissionInfo/airX/1', 'row' FROM c WHERE r = 4
UNION ALL SELECT c_custkey, '/companyInfo', 'kept' FROM c WHERE r = 5
UNION ALL SELECT c_custkey, '/x/airY', 'kept' FROM c WHERE r = 7"""


def q_extract_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed sections: one body per customer, in six shapes."""
    k = F.col("c_custkey")
    row = F.concat(F.lit('{"pollutantName":"NOx","emitValue":"'), text(k), F.lit('"}'))
    section = (
        F.when(k % 6 == 0, F.concat(F.lit("["), row, F.lit(',"bad-row",null,5]'))).when(k % 6 == 1, row).when(k % 6 == 2, F.lit("null"))
        .when(k % 6 == 3, F.lit('"text"')).when(k % 6 == 4, F.lit("[]")).otherwise(F.concat(F.lit("["), row, F.lit(",[1]]")))
    )
    body = F.concat(F.lit('{"emissionInfo":{"airA/b~c":'), section, F.lit(',"waterX":[{}]}}'))
    broken = F.when(k % 17 == 9, F.lit("<html>")).when(k % 17 == 10, F.lit('{"emissionInfo":[1]}')).otherwise(body)
    bodies = fixtures.table(spark, sf_dir, "customer").select("c_custkey", broken.alias("body"))
    rows = explode_rows(parse_bodies(bodies))
    return rows.select("c_custkey", "row_json_pointer", joined("schema_warnings"), F.col("raw_row").isNull().alias("no_row"))


WARNINGS_SQL = """
WITH k AS (SELECT c_custkey FROM customer WHERE c_custkey % 17 NOT IN (9, 10)),
x AS (
  SELECT c_custkey, c_custkey % 6 AS s, unnest(CASE c_custkey % 6 WHEN 0 THEN [0, 1, 2, 3] WHEN 5 THEN [0, 1] WHEN 1 THEN [-1] WHEN 3 THEN [-1] ELSE [] END) AS i FROM k)
SELECT c_custkey, '/emissionInfo/airA~1b~0c' || CASE WHEN i >= 0 THEN '/' || i ELSE '' END AS row_json_pointer,
       CASE WHEN s = 1 THEN 'section_not_list' WHEN s = 3 THEN 'section_not_list,row_not_object' WHEN i > 0 THEN 'row_not_object' ELSE '' END AS schema_warnings,
       s = 0 AND i = 2 AS no_row FROM x"""

QUERIES = {
    "q_extract_long": q_extract_long, "q_eligibility": q_eligibility, "q_unpivot_periods": q_unpivot_periods,
    "q_unreadable_bodies": q_unreadable_bodies, "q_typed_walk": q_typed_walk,
    "q_prune_sections": q_prune_sections, "q_extract_warnings": q_extract_warnings,
}
ORACLES = {
    "q_extract_long": EXTRACT_SQL, "q_eligibility": ELIGIBILITY_SQL, "q_unpivot_periods": UNPIVOT_SQL,
    "q_unreadable_bodies": UNREADABLE_SQL, "q_typed_walk": TYPED_SQL,
    "q_prune_sections": PRUNE_SQL, "q_extract_warnings": WARNINGS_SQL,
}
