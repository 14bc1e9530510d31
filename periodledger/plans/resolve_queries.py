"""Competing sources, period totals, native totals, lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodledger.functions.numbers import NUMBER_COLUMNS, with_decimal_sum, with_number
from periodledger.operators import resolve
from periodledger.operators.timeselect import TimeSelection
from periodledger.plans import fixtures, oracles
from periodledger.plans.common import CROSS_YEAR, GROUP, ONE_YEAR, PARTIAL, QUARTER, joined
from periodledger.sources.scratch import materialize


def _summary(selection: TimeSelection):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        summary = resolve.summarize_period(fixtures.records(spark, sf_dir), selection)
        return summary.select(
            *GROUP, "enterprise_name", "status", "month_coverage_complete", "period_total", "period_total_decimal",
            "covered_full_months_total", joined("missing_periods"), joined("conflict_periods"), "lower_priority_disagreement")
    return query


def q_period_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = resolve.resolve_months(fixtures.records(spark, sf_dir), QUARTER)
    return months.withColumn("conflict_reasons", F.array_join("conflict_reasons", ","))


DECIMALS = "1234567890987654321012345678909876543210"  # forty, and more behind them for each pollutant


def _long_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records with more than forty decimals behind each number; those of the third pollutant end in zeros."""
    p = F.substring("row_json_pointer", 31, 1).cast("int").bitwiseAND(6)  # the row of a pollutant is twice its number, and one
    more = F.concat(F.lit("." + DECIMALS), F.when(p == 4, "500").otherwise((p + 1).cast("string")))
    step = fixtures.records(spark, sf_dir).drop("value_status").withColumns({
        "value_raw": F.when(F.col("value_raw").rlike("^[0-9]+$"), F.concat("value_raw", more)).otherwise(F.col("value_raw")), "_yes": F.lit(True)})
    return with_number(step.drop(*NUMBER_COLUMNS), clean="value_raw", raw="value_raw", present="_yes").drop("_yes")


def q_wide_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolved months whose numbers have more digits than a fixed width holds."""
    months = resolve.resolve_months(_long_values(spark, sf_dir), QUARTER)
    return months.select(*GROUP, "period", "status", "value_decimal", "selected_priority", "source_count")


def q_wide_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    native = resolve.summarize_native(_long_values(spark, sf_dir), ONE_YEAR)
    return native.select(*GROUP, "period_kind", joined("covered_periods"), "status", "value_decimal", "source_count")


def _long_sql(number: str) -> str:
    tail = "CASE pollutant_key WHEN 'code:A21002' THEN '1' WHEN 'code:A21026' THEN '3' WHEN 'code:A99911' THEN '500' ELSE '7' END"
    return f"CAST(CAST({number} AS BIGINT) AS VARCHAR) || '.{DECIMALS}' || {tail}"


WIDE_SQL = oracles.period_months(list(QUARTER.periods)).rsplit("SELECT", 1)[0] + f"""
SELECT {oracles.GROUP}, 'main_outlet' AS scope, period, status, {_long_sql("value")} AS value_decimal, selected_priority, source_count
FROM months"""


def _native(selection: TimeSelection):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        native = resolve.summarize_native(fixtures.records(spark, sf_dir), selection)
        return native.select(
            *GROUP, "period_kind", joined("covered_periods"), "status", "value", joined("conflict_reasons"), "candidate_count",
            "source_count", "fully_within_requested_months", "exactly_matches_request")
    return query


def native_sql(periods: list[str], whole: bool) -> str:
    flag = "true" if whole else "false"
    listed = "[" + ", ".join(f"'{p}'" for p in periods) + "]"
    return "WITH " + oracles.RECORDS + f""",
native AS (
  SELECT *, CASE WHEN period_kind = 'quarter' THEN [printf('%04d-%02d', year, 3 * per - 3 + i) for i in [1, 2, 3]]
                 ELSE [printf('%04d-%02d', year, i) for i in range(1, 13)] END AS covered
  FROM records WHERE period_kind <> 'month'),
met AS (SELECT * FROM native WHERE list_has_any(covered, {listed})),
docs AS (
  SELECT {oracles.GROUP}, period_kind, covered, report_id, count(DISTINCT (p, o, dup)) AS n FROM met WHERE ok GROUP BY ALL),
dups AS (SELECT {oracles.GROUP}, period_kind, covered, bool_or(n > 1) AS duplicate FROM docs GROUP BY ALL),
vals AS (
  SELECT {oracles.GROUP}, period_kind, covered, count(*) AS candidate_count, count(*) FILTER (ok) AS source_count,
         count(DISTINCT num) FILTER (ok) AS n_values, min(num) FILTER (ok) AS num
  FROM met GROUP BY ALL)
SELECT {oracles.GROUP}, 'main_outlet' AS scope, period_kind, array_to_string(covered, ',') AS covered_periods,
       CASE WHEN n_values = 1 AND NOT duplicate THEN 'selected' WHEN n_values > 1 OR duplicate THEN 'conflict' ELSE 'ineligible' END AS status,
       CASE WHEN n_values = 1 AND NOT duplicate THEN CAST(num AS DOUBLE) END AS value,
       concat_ws(',', CASE WHEN n_values > 1 THEN 'same_priority_value_conflict' END,
                      CASE WHEN duplicate THEN 'duplicate_scope_rows' END) AS conflict_reasons,
       candidate_count, source_count,
       {flag} AND list_has_all({listed}, covered) AS fully_within_requested_months,
       {flag} AND list_sort(covered) = list_sort({listed}) AS exactly_matches_request
FROM vals LEFT JOIN dups USING ({oracles.GROUP}, period_kind, covered)"""


WIDE_NATIVE_SQL = f"""SELECT {oracles.GROUP}, scope, period_kind, covered_periods, status, {_long_sql("value")} AS value_decimal, source_count
FROM ({native_sql(list(ONE_YEAR.periods), True)})"""


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records as a written table, as a run keeps them: several readers, computed once."""
    return materialize(fixtures.records(spark, sf_dir), "records")


def q_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = resolve.lineage(_stored(spark, sf_dir), QUARTER)
    return rows.select(*GROUP[:5], "period", "report_id", "report_type", "json_pointer", "value_raw", "value", "aggregation_eligible", "selected")


LINEAGE_SQL = "WITH " + oracles.resolved_months(list(QUARTER.periods)) + f"""
SELECT enterprise_id, permit_code, pollutant_key, 'main_outlet' AS scope, outlet_key, c.period, report_id, report_type,
       '/emissionInfo/airMainEmission/' || (p * 2 + o) || '#' || dup || '/' || field AS json_pointer, value_raw,
       CAST(num AS DOUBLE) AS value, ok AS aggregation_eligible,
       coalesce(ok AND m.status = 'selected' AND c.report_type = m.selected_priority, false) AS selected
FROM cand c JOIN months m USING ({oracles.GROUP}, period)"""


def q_selected_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = resolve.selected_sources(resolve.lineage(_stored(spark, sf_dir), QUARTER))
    return sources.groupBy("enterprise_id", "period", "report_type").agg(F.count(F.lit(1)).alias("sources"), F.sum("value").alias("total"))


SOURCES_SQL = "WITH " + oracles.resolved_months(list(QUARTER.periods)) + f"""
SELECT enterprise_id, c.period, report_type, count(*) AS sources, CAST(sum(num) AS DOUBLE) AS total
FROM cand c JOIN months m USING ({oracles.GROUP}, period)
WHERE ok AND m.status = 'selected' AND c.report_type = m.selected_priority GROUP BY ALL"""


def q_decimal_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact sums of decimal text: three amounts per line, then counted by outcome."""
    li = fixtures.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    cents = lambda c: F.concat((c / 100).cast("bigint").cast("string"), F.lit("."), F.lpad((c % 100).cast("string"), 2, "0"))
    tenths = F.concat(F.lit("0."), (F.col("l_linenumber") % 10).cast("string"))
    step = li.withColumns({"a": cents(F.col("l_partkey")), "b": tenths, "c": F.col("l_suppkey").cast("string"), "_yes": F.lit(True)})
    parts = []
    for name in ("a", "b", "c"):
        step = with_number(step, clean=name, raw=name, present="_yes")
        step = step.withColumn(f"_{name}", F.struct(F.col("value_digits").alias("digits"), F.col("value_exp").alias("exp"),
                                                    F.col("value_scale").alias("scale"), F.col("value_decimal").alias("text")))
        parts.append(f"_{name}")
    step = with_decimal_sum(step.withColumn("_terms3", F.array(*parts)), "_terms3", F.lit(True), "total")
    return step.groupBy("l_linenumber", "total").agg(F.count(F.lit(1)).alias("n"))


DECIMAL_SQL = """
SELECT l_linenumber, CAST(CAST(l_partkey // 100 || '.' || lpad(CAST(l_partkey % 100 AS VARCHAR), 2, '0') AS DECIMAL(18, 2))
         + CAST('0.' || (l_linenumber % 10) AS DECIMAL(18, 2)) + CAST(l_suppkey AS DECIMAL(18, 2)) AS VARCHAR) AS total, count(*) AS n
FROM lineitem GROUP BY 1, 2"""

_MONTHS = list(QUARTER.periods)
QUERIES = {
    "q_period_summary": _summary(QUARTER),
    "q_period_summary_partial": _summary(PARTIAL),
    "q_period_summary_cross_year": _summary(CROSS_YEAR),
    "q_period_summary_year": _summary(ONE_YEAR),
    "q_period_months": q_period_months,
    "q_wide_values": q_wide_values,
    "q_wide_native": q_wide_native,
    "q_native_summary": _native(ONE_YEAR),
    "q_native_summary_quarter": _native(QUARTER),
    "q_native_summary_partial": _native(PARTIAL),
    "q_lineage": q_lineage,
    "q_selected_sources": q_selected_sources,
    "q_decimal_sum": q_decimal_sum,
}
ORACLES = {
    "q_period_summary": oracles.period_summary(_MONTHS, True),
    "q_period_summary_partial": oracles.period_summary(list(PARTIAL.periods), False),
    "q_period_summary_cross_year": oracles.period_summary(list(CROSS_YEAR.periods), True),
    "q_period_summary_year": oracles.period_summary(list(ONE_YEAR.periods), True),
    "q_period_months": oracles.period_months(_MONTHS),
    "q_wide_values": WIDE_SQL,
    "q_wide_native": WIDE_NATIVE_SQL,
    "q_native_summary": native_sql(list(ONE_YEAR.periods), True),
    "q_native_summary_quarter": native_sql(_MONTHS, True),
    "q_native_summary_partial": native_sql(list(PARTIAL.periods), False),
    "q_lineage": LINEAGE_SQL,
    "q_selected_sources": SOURCES_SQL,
    "q_decimal_sum": DECIMAL_SQL,
}
