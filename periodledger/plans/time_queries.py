"""Requested and reported periods."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodledger.operators import timeselect
from periodledger.plans import fixtures, oracles
from periodledger.sources.scratch import materialize
from periodledger.plans.common import QUARTER, joined, sql_list



def _resolved(requests: DataFrame, *keys: str) -> DataFrame:
    wide = requests
    for name, kind in (("years", "array<int>"), ("months", "array<int>"), ("start", "string"), ("end", "string"),
                       ("explicit", "array<string>")):
        if name not in wide.columns:
            wide = wide.withColumn(name, F.lit(None).cast(kind))
    return timeselect.expand_requests(wide).select(*keys, "mode", "whole_months", F.size("periods").alias("n_periods"), joined("periods"))


def q_periods_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One year-and-month request per customer."""
    key = F.col("c_custkey")
    cast = lambda c: c.cast("int")
    customers = fixtures.table(spark, sf_dir, "customer").select("c_custkey")
    return _resolved(customers.withColumns({
        "years": F.when(key % 13 != 5, F.array(cast(1995 + key % 7), cast(1995 + key * 3 % 7))).otherwise(F.array(cast(1899 + key % 2))),
        "months": F.when(key % 10 != 0, F.array(cast(key % 12 + 1), cast(key * 5 % 12 + 1), cast(key % 3 + key % 13))),
    }), "c_custkey")


GRID_SQL = """
WITH r AS (
  SELECT c_custkey,
         CASE WHEN c_custkey % 13 <> 5 THEN [1995 + c_custkey % 7, 1995 + c_custkey * 3 % 7] ELSE [1899 + c_custkey % 2] END AS ys,
         CASE WHEN c_custkey % 10 <> 0 THEN [c_custkey % 12 + 1, c_custkey * 5 % 12 + 1, c_custkey % 3 + c_custkey % 13]
              ELSE range(1, 13) END AS ms
  FROM customer),
v AS (
  SELECT *, list_min(ys) >= 1900 AND list_max(ys) <= 2099 AND list_min(ms) >= 1 AND list_max(ms) <= 12 AS good FROM r),
years AS (SELECT DISTINCT c_custkey, unnest(ys) AS y FROM v WHERE good),
months AS (SELECT DISTINCT c_custkey, unnest(ms) AS m FROM v WHERE good),
grid AS (SELECT c_custkey, printf('%04d-%02d', y, m) AS p FROM years JOIN months USING (c_custkey)),
listed AS (SELECT c_custkey, count(*) AS n, string_agg(p, ',' ORDER BY p) AS ps FROM grid GROUP BY 1)
SELECT c_custkey, CASE WHEN good THEN 'years_months' ELSE 'invalid' END AS mode,
       CASE WHEN good THEN true END AS whole_months, CAST(coalesce(n, 0) AS INT) AS n_periods, coalesce(ps, '') AS periods
FROM v LEFT JOIN listed USING (c_custkey)"""


def q_periods_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One range request per order: from the order date over up to 400 days, as months or days,
    some in the wrong order."""
    key, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    orders = fixtures.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    until = F.date_add(day, (key % 401).cast("int"))
    layout = lambda d: F.when(key % 3 == 0, F.date_format(d, "yyyy-MM")).otherwise(F.date_format(d, "yyyy-MM-dd"))
    back = key % 11 == 4
    return _resolved(orders.withColumns({
        "start": layout(F.when(back, until).otherwise(day)), "end": layout(F.when(back, day).otherwise(until))}), "o_orderkey")


RANGE_SQL = """
WITH b AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 401 AS INT) AS u,
         o_orderkey % 3 = 0 AS by_month, o_orderkey % 11 = 4 AS back FROM orders),
s AS (
  SELECT o_orderkey, by_month, CASE WHEN back THEN u ELSE d END AS a, CASE WHEN back THEN d ELSE u END AS z FROM b),
r AS (
  SELECT o_orderkey, CASE WHEN by_month THEN CAST(date_trunc('month', a) AS DATE) ELSE a END AS a,
         CASE WHEN by_month THEN last_day(z) ELSE z END AS z FROM s),
x AS (
  SELECT o_orderkey, a, z, unnest(CASE WHEN a <= z THEN generate_series(CAST(date_trunc('month', a) AS TIMESTAMP), CAST(z AS TIMESTAMP), INTERVAL 1 MONTH)
                                        ELSE [CAST(NULL AS TIMESTAMP)] END) AS m FROM r)
SELECT o_orderkey, CASE WHEN a <= z THEN 'date_range' ELSE 'invalid' END AS mode,
       CASE WHEN a <= z THEN day(a) = 1 AND z = last_day(z) END AS whole_months,
       CAST(count(m) AS INT) AS n_periods, coalesce(string_agg(strftime(m, '%Y-%m'), ',' ORDER BY m), '') AS periods
FROM x GROUP BY o_orderkey, a, z"""


def q_periods_explicit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The months each customer ordered in, as an explicit request; at most one per month."""
    months = fixtures.table(spark, sf_dir, "orders").select(
        "o_custkey", F.when(F.col("o_custkey") % 17 == 3, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM")).alias("p"))
    asked = months.groupBy("o_custkey").agg(F.collect_set("p").alias("explicit"))
    return _resolved(asked, "o_custkey")


EXPLICIT_SQL = """
WITH m AS (SELECT DISTINCT o_custkey, strftime(o_orderdate, '%Y-%m') AS p FROM orders)
SELECT o_custkey, CASE WHEN o_custkey % 17 = 3 THEN 'invalid' ELSE 'explicit_months' END AS mode,
       CASE WHEN o_custkey % 17 <> 3 THEN true END AS whole_months,
       CASE WHEN o_custkey % 17 = 3 THEN 0 ELSE CAST(count(*) AS INT) END AS n_periods,
       CASE WHEN o_custkey % 17 = 3 THEN '' ELSE string_agg(p, ',' ORDER BY p) END AS periods
FROM m GROUP BY o_custkey"""


def q_report_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    classified = timeselect.with_report_period(fixtures.index_entries(spark, sf_dir))
    return classified.select("report_id", "period_year", "period_kind", joined("periods"), "period_error")


INDEX = oracles.LINES + """,
idx AS (
  SELECT DISTINCT e, t, y, per, rev, t || '|' || e || '|' || y || '|' || per || '|' || rev AS report_id,
         CASE WHEN (e + per) % 7 = 3 THEN CASE t WHEN 'month' THEN 'invalid_month' WHEN 'quarter' THEN 'unrecognized_period'
              ELSE 'unrecognized_year' END END AS bad,
         CASE WHEN e % 11 = 5 AND t = 'year' THEN y + 1 ELSE y END AS index_year
  FROM placed),
months_of AS (
  SELECT *, CASE WHEN bad IS NOT NULL THEN [] WHEN t = 'month' THEN [per] WHEN t = 'quarter' THEN [3 * per - 2, 3 * per - 1, 3 * per]
                 ELSE range(1, 13) END AS ms FROM idx),
cls AS (
  SELECT *, [printf('%04d-%02d', y, x) for x in ms] AS periods FROM months_of)"""

PERIOD_SQL = "WITH " + INDEX + """
SELECT report_id, CASE WHEN bad IS NULL THEN CAST(y AS INT) END AS period_year, CASE WHEN bad IS NULL THEN t END AS period_kind,
       array_to_string(periods, ',') AS periods, bad AS period_error FROM cls"""


def q_index_relevant(spark: SparkSession, sf_dir: str) -> DataFrame:
    classified = timeselect.with_report_period(fixtures.index_entries(spark, sf_dir))
    kept = timeselect.relevant_reports(classified, QUARTER, index_year="index_year")
    return kept.select("report_id", "index_year", "period_kind", "period_error")


RELEVANT_SQL = "WITH " + INDEX + f"""
SELECT report_id, CAST(index_year AS INT) AS index_year, CASE WHEN bad IS NULL THEN t END AS period_kind,
       coalesce(bad, CASE WHEN index_year <> y THEN 'period_differs_from_index_year' END) AS period_error
FROM cls WHERE bad IS NOT NULL OR index_year <> y OR list_has_any(periods, {sql_list(QUARTER.periods)})"""


def _with_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of which some have lost their year, as an unreadable period text leaves them."""
    records = fixtures.records(spark, sf_dir)
    lost = (F.col("report_type") == "year") & (F.substring("enterprise_id", 2, 20).cast("bigint") % 10 == 7)
    return records.withColumn("year", F.when(~lost, F.col("year")))


def q_row_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = timeselect.with_row_periods(_with_unknown(spark, sf_dir))
    return rows.groupBy("enterprise_id", "period_kind", joined("periods")).agg(F.count(F.lit(1)).alias("n"))


ROWS = oracles.RECORDS + """,
known AS (
  SELECT *, CASE WHEN report_type = 'year' AND e % 10 = 7 THEN NULL ELSE year END AS yr,
         CASE WHEN period_kind = 'month' THEN [month] WHEN period_kind = 'quarter' THEN [3 * per - 2, 3 * per - 1, 3 * per]
              ELSE range(1, 13) END AS ms FROM records),
rows AS (SELECT *, CASE WHEN yr IS NULL THEN [] ELSE [printf('%04d-%02d', yr, x) for x in ms] END AS periods FROM known)"""

ROW_PERIODS_SQL = "WITH " + ROWS + """
SELECT enterprise_id, period_kind, array_to_string(periods, ',') AS periods, count(*) AS n FROM rows GROUP BY 1, 2, 3"""


def q_requested_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = timeselect.requested_rows(_with_unknown(spark, sf_dir), QUARTER)
    return kept.groupBy("enterprise_id", "period_kind", F.col("year").isNull().alias("no_year")).agg(F.count(F.lit(1)).alias("n"))


REQUESTED_SQL = "WITH " + ROWS + f"""
SELECT enterprise_id, period_kind, yr IS NULL AS no_year, count(*) AS n FROM rows
WHERE len(periods) = 0 OR list_has_any(periods, {sql_list(QUARTER.periods)}) GROUP BY 1, 2, 3"""


def q_partition_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    monthly, native = timeselect.partition_kinds(fixtures.records(spark, sf_dir))
    count = lambda df, name: df.groupBy("enterprise_id", "period_kind").agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit(name))
    return count(monthly, "monthly").unionByName(count(native, "native"))


PARTITION_SQL = "WITH " + oracles.RECORDS + """
SELECT enterprise_id, period_kind, count(*) AS n, CASE WHEN period_kind = 'month' THEN 'monthly' ELSE 'native' END AS part
FROM records GROUP BY 1, 2"""

def _by_year(table: DataFrame, name: str) -> DataFrame:
    """A table written by year into the shared folder and read back."""
    return materialize(timeselect.with_scan_year(table), name, partition_by=[timeselect.SCAN_YEAR])


def q_pruned_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as q_requested_rows, from records stored by year."""
    kept = timeselect.requested_rows(_by_year(_with_unknown(spark, sf_dir), "records-by-year"), QUARTER)
    return kept.groupBy("enterprise_id", "period_kind", F.col("year").isNull().alias("no_year")).agg(F.count(F.lit(1)).alias("n"))


def q_pruned_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same entries as q_index_relevant, from entries stored by year."""
    classified = timeselect.with_index_clash(timeselect.with_report_period(fixtures.index_entries(spark, sf_dir)), "index_year")
    kept = timeselect.relevant_reports(_by_year(classified, "index-by-year"), QUARTER)
    return kept.select("report_id", "index_year", "period_kind", "period_error")


def _customers_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per customer, in each of the three ways and invalid."""
    k = F.col("c_custkey") % 4
    return fixtures.table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(k == 1, F.array(F.lit(1996))).alias("years"), F.when(k == 1, F.array(F.lit(3))).alias("months"),
        F.when(k == 2, "1997-11").alias("start"), F.when(k == 2, "1998-01-10").alias("end"), F.when(k == 0, F.array(F.lit("1994-02"))).alias("explicit"))


def q_pruned_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records stored by year that meet any customer's request."""
    stored = _by_year(_with_unknown(spark, sf_dir), "records-by-year")
    kept = timeselect.requested_by(stored, timeselect.expand_requests(_customers_requests(spark, sf_dir)))
    return kept.groupBy("enterprise_id", "period_kind", "year").agg(F.count(F.lit(1)).alias("n"))


PRUNED_REQUESTS_SQL = "WITH " + ROWS + """,
asked AS (SELECT DISTINCT unnest(CASE c_custkey % 4 WHEN 0 THEN ['1994-02'] WHEN 1 THEN ['1996-03'] WHEN 2 THEN ['1997-11', '1997-12', '1998-01'] ELSE [] END) AS p FROM customer)
SELECT enterprise_id, period_kind, CAST(yr AS INT) AS year, count(*) AS n FROM rows
WHERE len(periods) = 0 OR list_has_any(periods, (SELECT list(p) FROM asked)) GROUP BY 1, 2, 3"""

QUERIES = {
    "q_pruned_rows": q_pruned_rows, "q_pruned_index": q_pruned_index, "q_pruned_requests": q_pruned_requests,
    "q_periods_grid": q_periods_grid, "q_periods_range": q_periods_range, "q_periods_explicit": q_periods_explicit,
    "q_report_period": q_report_period, "q_index_relevant": q_index_relevant, "q_row_periods": q_row_periods,
    "q_requested_rows": q_requested_rows, "q_partition_kinds": q_partition_kinds,
}
ORACLES = {
    "q_pruned_rows": REQUESTED_SQL, "q_pruned_index": RELEVANT_SQL, "q_pruned_requests": PRUNED_REQUESTS_SQL,
    "q_periods_grid": GRID_SQL, "q_periods_range": RANGE_SQL, "q_periods_explicit": EXPLICIT_SQL,
    "q_report_period": PERIOD_SQL, "q_index_relevant": RELEVANT_SQL, "q_row_periods": ROW_PERIODS_SQL,
    "q_requested_rows": REQUESTED_SQL, "q_partition_kinds": PARTITION_SQL,
}
