"""The registered queries restated in SQL for an independent engine, over the same tables."""

from __future__ import annotations

LINES = """
lines AS (
  SELECT l_suppkey // 5 AS e, year(l_shipdate) AS y, month(l_shipdate) AS m, quarter(l_shipdate) AS qtr,
         l_partkey % 4 AS p, l_linenumber % 2 AS o,
         CASE WHEN l_orderkey % 10 < 6 THEN 'month' WHEN l_orderkey % 10 < 9 THEN 'quarter' ELSE 'year' END AS t,
         CASE WHEN l_orderkey % 97 = 0 THEN 'r2' ELSE 'r1' END AS rev,
         CASE WHEN l_orderkey % 89 = 1 THEN 1 ELSE 0 END AS dup,
         CAST(l_quantity AS BIGINT) AS q
  FROM lineitem),
placed AS (
  SELECT *, m AS per, 'emitValue' AS field, m AS cm FROM lines WHERE t = 'month'
  UNION ALL
  SELECT *, qtr, CASE (m - 1) % 3 WHEN 0 THEN 'firstMonth' WHEN 1 THEN 'secondMonth' ELSE 'thirdMonth' END, m
  FROM lines WHERE t = 'quarter'
  UNION ALL
  SELECT *, qtr, 'total', NULL FROM lines WHERE t = 'quarter'
  UNION ALL
  SELECT *, 0, 'total', NULL FROM lines WHERE t = 'year'),
cells AS (
  SELECT e, t, y, per, rev, p, o, dup, field, cm AS m,
         CASE WHEN (e * 7 + coalesce(cm, 0) * 3 + p) % 23 = 0 THEN '/'
              WHEN (e + coalesce(cm, 0) + p) % 29 = 0 THEN '-1'
              WHEN (e + coalesce(cm, 0) * 5 + p) % 31 = 0 THEN '0'
              ELSE CAST(CAST(sum(q) AS BIGINT) AS VARCHAR) END AS value_raw
  FROM placed GROUP BY e, t, y, per, rev, p, o, dup, field, cm)"""

RECORDS = LINES + """,
records AS (
  SELECT 'E' || e AS enterprise_id, CASE WHEN e % 9 = 8 THEN 'X' ELSE 'P' END || e AS permit_code,
         CASE p WHEN 0 THEN 'code:A21002' WHEN 1 THEN 'code:A21026' WHEN 2 THEN 'code:A99911'
              ELSE 'name:工业废气排放量' END AS pollutant_key,
         'DA00' || (o + 1) AS outlet_key, CASE WHEN p = 3 THEN '万Nm3' ELSE 't' END AS unit,
         t || '|' || e || '|' || y || '|' || per || '|' || rev AS report_id,
         t AS report_type, CASE WHEN m IS NULL THEN t ELSE 'month' END AS period_kind,
         y AS year, m AS month, per, field, value_raw, p, o, dup, e,
         CASE WHEN m IS NULL THEN NULL ELSE printf('%04d-%02d', y, m) END AS period,
         CASE WHEN value_raw = '/' THEN 'not_reported' WHEN value_raw = '-1' THEN 'invalid'
              WHEN value_raw = '0' THEN 'reported_zero' ELSE 'reported_numeric' END AS value_status,
         CASE WHEN value_raw IN ('/', '-1') THEN NULL ELSE CAST(value_raw AS BIGINT) END AS num,
         value_raw NOT IN ('/', '-1') AND e % 9 <> 8 AS ok
  FROM cells)"""

GROUP = "enterprise_id, permit_code, pollutant_key, outlet_key, unit"


def requested(periods: list[str]) -> str:
    return "req AS (SELECT unnest([" + ", ".join(f"'{p}'" for p in periods) + "]) AS period)"


def resolved_months(periods: list[str]) -> str:
    """CTEs up to ``months``: one row per group and requested month."""
    years = sorted({p[:4] for p in periods})
    return RECORDS + ", " + requested(periods) + f""",
wanted AS (
  SELECT * FROM records r WHERE period IN (SELECT period FROM req)
     OR (period_kind = 'year' AND CAST(year AS VARCHAR) IN ({", ".join(f"'{y}'" for y in years)}))
     OR (period_kind = 'quarter' AND EXISTS (
           SELECT 1 FROM req WHERE left(req.period, 4) = CAST(r.year AS VARCHAR)
             AND (CAST(right(req.period, 2) AS INT) + 2) // 3 = r.per))),
groups AS (SELECT DISTINCT {GROUP} FROM wanted),
cand AS (SELECT * FROM wanted WHERE period_kind = 'month'),
best AS (
  SELECT {GROUP}, period, count(*) AS candidate_count,
         CASE WHEN count(*) FILTER (ok AND report_type = 'month') > 0 THEN 'month'
              WHEN count(*) FILTER (ok AND report_type = 'quarter') > 0 THEN 'quarter' END AS tier,
         count(DISTINCT num) FILTER (ok) AS all_values
  FROM cand GROUP BY ALL),
docs AS (
  SELECT {GROUP}, period, report_id, count(DISTINCT (p, o, dup)) AS rows_in_doc
  FROM cand JOIN best USING ({GROUP}, period) WHERE ok AND report_type = tier GROUP BY ALL),
dups AS (SELECT {GROUP}, period, bool_or(rows_in_doc > 1) AS duplicate FROM docs GROUP BY ALL),
pool AS (
  SELECT {GROUP}, period, count(DISTINCT num) AS n_values, min(num) AS num, count(*) AS source_count
  FROM cand JOIN best USING ({GROUP}, period) WHERE ok AND report_type = tier GROUP BY ALL),
months AS (
  SELECT g.*, req.period,
         CASE WHEN n_values = 1 AND NOT duplicate THEN 'selected'
              WHEN n_values > 1 OR duplicate THEN 'conflict'
              WHEN candidate_count > 0 THEN 'ineligible' ELSE 'missing' END AS status,
         CASE WHEN n_values = 1 AND NOT duplicate THEN CAST(num AS DOUBLE) END AS value,
         CASE WHEN n_values = 1 AND NOT duplicate THEN tier END AS selected_priority,
         concat_ws(',', CASE WHEN n_values > 1 THEN 'same_priority_value_conflict' END,
                        CASE WHEN duplicate THEN 'duplicate_scope_rows' END) AS conflict_reasons,
         coalesce(n_values = 1 AND NOT duplicate AND all_values > 1, false) AS lower_priority_disagreement,
         coalesce(candidate_count, 0) AS candidate_count, coalesce(source_count, 0) AS source_count
  FROM groups g CROSS JOIN req
  LEFT JOIN best USING ({GROUP}, period) LEFT JOIN pool USING ({GROUP}, period) LEFT JOIN dups USING ({GROUP}, period))"""


def period_summary(periods: list[str], whole: bool) -> str:
    complete = "every AND " + ("true" if whole else "false")
    return "WITH " + resolved_months(periods) + f""",
sums AS (
  SELECT {GROUP}, bool_and(status = 'selected') AS every, bool_or(status = 'conflict') AS clash,
         CAST(sum(CAST(value AS BIGINT)) AS BIGINT) AS total,
         coalesce(string_agg(period, ',' ORDER BY period) FILTER (status IN ('missing', 'ineligible')), '') AS missing_periods,
         coalesce(string_agg(period, ',' ORDER BY period) FILTER (status = 'conflict'), '') AS conflict_periods,
         bool_or(lower_priority_disagreement) AS lower_priority_disagreement
  FROM months GROUP BY ALL)
SELECT {GROUP}, 'main_outlet' AS scope, 'Enterprise ' || substr(enterprise_id, 2) AS enterprise_name,
       CASE WHEN {complete} THEN 'complete' WHEN clash THEN 'conflict'
            WHEN NOT {"true" if whole else "false"} THEN 'granularity_mismatch' ELSE 'incomplete' END AS status,
       every AS month_coverage_complete,
       CASE WHEN {complete} THEN CAST(total AS DOUBLE) END AS period_total,
       CASE WHEN {complete} THEN CAST(total AS VARCHAR) END AS period_total_decimal,
       CASE WHEN every THEN CAST(total AS DOUBLE) END AS covered_full_months_total,
       missing_periods, conflict_periods, lower_priority_disagreement
FROM sums"""


def period_months(periods: list[str]) -> str:
    return "WITH " + resolved_months(periods) + f"""
SELECT {GROUP}, 'main_outlet' AS scope, period, CAST(left(period, 4) AS INT) AS year, CAST(right(period, 2) AS INT) AS month,
       status, value, CAST(CAST(value AS BIGINT) AS VARCHAR) AS value_decimal, selected_priority, conflict_reasons,
       lower_priority_disagreement, candidate_count, source_count
FROM months"""
