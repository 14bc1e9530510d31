"""Readback and run comparison over runs with seeded faults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from periodledger.functions.hashing import content_hash
from periodledger.operators.audit import verify_run
from periodledger.operators.compare import compare_runs, multiset_difference
from periodledger.operators.flatten import flatten_reports
from periodledger.operators.resolve import summarize_native, summarize_period
from periodledger.operators.timeselect import partition_kinds, requested_rows
from periodledger.plans import fixtures, oracles
from periodledger.plans.common import QUARTER
from periodledger.plans.flatten_queries import BODIES
from periodledger.sources.scratch import materialize


def _number(column: str = "enterprise_id") -> Column:
    return F.substring(column, 2, 20).cast("bigint")


def _faulty_run(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A run in which every kind of problem was planted; its problems and result."""
    reports = materialize(fixtures.bodies(spark, sf_dir), "bodies").withColumnRenamed("filed_permit", "permit_code")
    ten = _number() % 10
    manifest = reports.select("enterprise_id", "permit_code", "report_id", F.lit("downloaded").alias("status"),
                              F.when(ten == 3, "0000").otherwise(content_hash(F.col("body"))).alias("air_sha256"))
    quarterly, april = F.col("report_id").startswith("quarter|"), F.col("report_id").rlike(r"^month\|\d+\|\d+\|4\|")
    copies = F.when((ten == 2) & april, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    stored = reports.where(~((ten == 1) & quarterly)).withColumn("_copy", F.explode(copies)).select(
        "permit_code", "report_id", "body", "meta", "enterprise")
    records = materialize(requested_rows(flatten_reports(reports, selection=QUARTER), QUARTER), "records")
    records = records.withColumns({
        "raw_row": F.when(ten == 4, F.concat("raw_row", F.lit(" "))).otherwise(F.col("raw_row")),
        "value_raw": F.when((ten == 5) & F.col("field_present"), F.concat("value_raw", F.lit("0"))).otherwise(F.col("value_raw")),
        "json_pointer": F.when(ten == 6, F.concat("json_pointer", F.lit("x"))).otherwise(F.col("json_pointer")),
    })
    monthly, native_rows = partition_kinds(records)
    summary = materialize(summarize_period(records, QUARTER), "summary")
    done = F.col("complete")
    summary = summary.withColumns({
        "period_total": F.when((ten == 7) & ~done, 1.0).otherwise(F.col("period_total")),
        "period_total_decimal": F.when((ten == 0) & done, F.concat(F.lit("9"), F.col("period_total_decimal"))).otherwise(F.col("period_total_decimal")),
        "complete": done | (ten == 9),
    })
    native = summarize_native(native_rows, QUARTER).where(ten != 0)
    return verify_run(manifest=manifest, stored=stored, records=records, monthly=monthly.where(ten != 0), native_rows=native_rows,
                      summary=summary, native=native, selection=QUARTER)


def q_verify_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    problems, _ = _faulty_run(spark, sf_dir)
    return problems.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def q_verify_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _faulty_run(spark, sf_dir)[1]


_PERIODS = list(QUARTER.periods)
VERIFY = "WITH " + BODIES + """,
rep AS (SELECT DISTINCT e, t, y, per, rev FROM placed),
judged AS (SELECT *, (e % 10 = 1 AND t = 'quarter') OR (e % 10 = 2 AND t = 'month' AND per = 4) AS unsound FROM rep),
got AS (
  SELECT x.*, (e % 10 = 1 AND report_type = 'quarter') OR (e % 10 = 2 AND report_type = 'month' AND x.month = 4) AS unsound
  FROM extracted x
  WHERE x.year = 1997 AND ((period_kind = 'month' AND x.month BETWEEN 4 AND 6) OR period_kind = 'year'
        OR (period_kind = 'quarter' AND split_part(report_id, '|', 4) = '2'))),
sums AS (SELECT *, CAST(substr(enterprise_id, 2) AS INT) % 10 AS ten FROM (""" + oracles.period_summary(_PERIODS, True) + """)),
found AS (
  SELECT 'report_cache_missing_or_duplicate' AS kind, count(*) AS n FROM judged WHERE unsound
  UNION ALL SELECT 'air_hash', count(*) FROM judged WHERE NOT unsound AND e % 10 = 3
  UNION ALL SELECT 'identity', count(*) FROM judged WHERE NOT unsound AND e % 9 = 8
  UNION ALL SELECT 'row_no_body', count(*) FROM got WHERE unsound OR e % 9 = 8
  UNION ALL SELECT 'pointer', count(*) FROM got WHERE NOT unsound AND e % 9 <> 8 AND e % 10 = 6
  UNION ALL SELECT 'raw_row', count(*) FROM got WHERE NOT unsound AND e % 9 <> 8 AND e % 10 = 4
  UNION ALL SELECT 'raw_value', count(*) FROM got WHERE NOT unsound AND e % 9 <> 8 AND e % 10 = 5 AND field_present
  UNION ALL SELECT 'incomplete_nonnull_total', count(*) FROM sums WHERE status <> 'complete' AND ten = 7
  UNION ALL SELECT 'months', count(*) FROM sums WHERE status <> 'complete' AND ten = 9
  UNION ALL SELECT 'total_arithmetic', count(*) FROM sums WHERE status = 'complete' AND ten = 0
  UNION ALL SELECT 'records_differ_from_reparsed_sources', CAST(count(*) > 0 AS INT) FROM got
    WHERE unsound OR e % 10 IN (4, 6) OR (e % 10 = 5 AND field_present)
  UNION ALL SELECT 'period_summary_recompute_mismatch', CAST(count(*) > 0 AS INT) FROM sums
    WHERE (status <> 'complete' AND ten IN (7, 9)) OR (status = 'complete' AND ten = 0)
  UNION ALL SELECT 'native_period_summary_recompute_mismatch', CAST(count(*) > 0 AS INT) FROM got WHERE e % 10 = 0 AND period_kind <> 'month'
  UNION ALL SELECT 'record_partition_mismatch', CAST(count(*) > 0 AS INT) FROM got WHERE e % 10 = 0 AND period_kind = 'month')"""

VERIFY_SQL = VERIFY + " SELECT kind, CAST(n AS BIGINT) AS n FROM found WHERE n > 0"
VERIFY_SUMMARY_SQL = VERIFY + """
SELECT (SELECT count(*) FROM judged WHERE NOT unsound) AS report_files_checked, (SELECT count(*) FROM got) AS air_rows_read_back,
       (SELECT count(*) FROM sums) AS period_groups_checked,
       (SELECT count(*) FROM sums WHERE status = 'complete' OR ten = 9) AS complete_period_groups_checked,
       (SELECT count(*) FROM (SELECT DISTINCT enterprise_id, permit_code, pollutant_key, outlet_code, unit, period_kind
                              FROM got WHERE period_kind <> 'month' AND e % 10 <> 0)) AS native_period_groups_checked,
       CAST((SELECT sum(n) FROM found) AS BIGINT) AS problems, (SELECT sum(n) FROM found) = 0 AS passed, true AS nonempty_evidence"""


def _two_runs(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """A run and an independent second one that differs in known places."""
    left = materialize(fixtures.records(spark, sf_dir), "records").withColumn("access_utc", F.lit("first"))
    e = _number()
    right = left.where(~((F.col("pollutant_code") == "A21026") & (e % 17 == 0))).withColumns({
        "value_raw": F.when((e % 13 == 1) & (F.col("month") == 5), F.concat("value_raw", F.lit("!"))).otherwise(F.col("value_raw")),
        "_n": F.explode(F.when((e % 19 == 1) & (F.col("field") == "total"), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))),
        "access_utc": F.lit("second")}).drop("_n")

    def manifest(changed: bool) -> DataFrame:
        sha = F.when(F.lit(changed) & (_number() % 7 == 2), "changed").otherwise(F.sha2("report_id", 256))
        return left.select("enterprise_id", "permit_code", "report_id").distinct().select(
            "permit_code", "report_id", F.when(_number() % 5 == 1, "unsupported_or_invalid").otherwise("downloaded").alias("status"), sha.alias("air_sha256"))

    return {"records": left, "manifest": manifest(False)}, {"records": right, "manifest": manifest(True)}


def q_run_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_runs(*_two_runs(spark, sf_dir), same_selection=True, both_finished=True)[0]


def q_run_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = _two_runs(spark, sf_dir)
    difference = multiset_difference(left["records"], right["records"], ["access_utc"])
    return difference.groupBy("left_count", "right_count").agg(F.count(F.lit(1)).alias("n"))


COMPARE = "WITH " + oracles.RECORDS + """,
flags AS (
  SELECT *, p = 1 AND e % 17 = 0 AS dropped, e % 13 = 1 AND coalesce(month = 5, false) AS changed, e % 19 = 1 AND field = 'total' AS doubled FROM records),
reps AS (SELECT DISTINCT e, report_id FROM records WHERE e % 5 <> 1),
n AS (
  SELECT count(*) AS l, count(*) FILTER (NOT dropped) + count(*) FILTER (NOT dropped AND doubled) AS r,
         count(*) FILTER (dropped OR changed) AS only_left, count(*) FILTER (NOT dropped AND changed) AS only_right,
         count(*) FILTER (NOT dropped AND NOT changed AND doubled) AS more_right FROM flags)"""

COMPARE_SQL = COMPARE + """,
h AS (SELECT count(*) AS reports, count(*) FILTER (e % 7 = 2) AS other FROM reps)
SELECT l AS left_rows, r AS right_rows, reports AS left_reports, reports AS right_reports, only_left + only_right + more_right AS different_rows,
       2 * other AS different_reports, only_left + only_right + more_right = 0 AS air_records_equal, other = 0 AS air_report_hashes_equal,
       true AS time_selection_equal, true AS both_runs_finished, true AS nonempty_evidence,
       only_left + only_right + more_right + other = 0 AS equal FROM n, h"""

DIFFERENCE_SQL = COMPARE + """
SELECT * FROM (SELECT CAST(1 AS BIGINT) AS left_count, CAST(0 AS BIGINT) AS right_count, only_left AS n FROM n
  UNION ALL SELECT 0, 1, only_right FROM n UNION ALL SELECT 1, 2, more_right FROM n) WHERE n > 0"""

QUERIES = {"q_verify_problems": q_verify_problems, "q_verify_summary": q_verify_summary,
           "q_run_compare": q_run_compare, "q_run_differences": q_run_differences}
ORACLES = {"q_verify_problems": VERIFY_SQL, "q_verify_summary": VERIFY_SUMMARY_SQL,
           "q_run_compare": COMPARE_SQL, "q_run_differences": DIFFERENCE_SQL}
