"""Catalog pages, identity, facilities, discovery. Suppliers are the catalog's enterprises."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodledger.operators import catalog as K
from periodledger.operators.coverage import coverage, index_coverage
from periodledger.operators.resolve import summarize_native, summarize_period
from periodledger.operators.timeselect import partition_kinds, requested_rows, with_report_period
from periodledger.plans import fixtures, oracles
from periodledger.plans.common import CROSS_YEAR, QUARTER, sql_list, text
from periodledger.plans.resolve_queries import native_sql
from periodledger.plans.time_queries import INDEX
from periodledger.sources.scratch import materialize

SEARCH = 1000  # suppliers per archived search


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with their place; nation and region hold a fixed number of rows (25 and 5)."""
    t = lambda n: fixtures.table(spark, sf_dir, n)
    places = t("nation").join(F.broadcast(t("region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return t("supplier").join(F.broadcast(places), F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("k"), F.col("r_name").alias("province"), F.col("n_name").alias("city"))


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog rows as archived: ten suppliers to a page; some repeated on the next page, some
    listed a page too late, the page count of some searches changing."""
    k = F.col("k")
    s = _suppliers(spark, sf_dir)
    late = k % 37 == 5
    page = ((k % SEARCH) / 10).cast("int") + 1 + late.cast("int")
    spot = F.struct(page.alias("page"), F.when(late, k % 10 + 11).otherwise(k % 10).cast("int").alias("pos"))
    again = F.struct((page + 1).alias("page"), F.when(late, 30).otherwise(10).alias("pos"))
    rows = s.select("*", F.explode(F.when(k % 17 == 0, F.array(spot, again)).otherwise(F.array(spot))).alias("x"))
    rows = rows.select("*", "x.page", "x.pos", F.expr(f"cast(k div {SEARCH} as bigint)").alias("search")).drop("x")
    ends = rows.groupBy("search").agg(F.max("page").alias("last"))
    # One row per 1,000 suppliers; the optimizer may broadcast it by its size.
    rows = rows.join(ends, "search")
    return rows.select(
        "search", "page", "pos", (F.col("last") + F.when((F.col("search") % 3 == 1) & (F.col("page") == 2), 1).otherwise(0)).alias("total_pages"),
        "province", "city", F.concat(F.lit("P"), text("k")).alias("permit_code"),
        F.concat(F.lit("Plant "), text(F.col("k") - F.when(F.col("k") % 11 == 1, 1).otherwise(0))).alias("name"),
        F.md5(text("k")).alias("enterprise_id"), F.concat(F.lit("/getxxgkContent.action?dataid="), F.md5(text("k"))).alias("detail_url"))


CATALOG = f"""
sup AS (
  SELECT s_suppkey AS k, r_name AS province, n_name AS city, s_suppkey // {SEARCH} AS search, s_suppkey % 37 = 5 AS late,
         (s_suppkey % {SEARCH}) // 10 + CASE WHEN late THEN 2 ELSE 1 END AS page, s_suppkey % 10 + CASE WHEN late THEN 11 ELSE 0 END AS pos
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
listed AS (SELECT * FROM sup UNION ALL SELECT k, province, city, search, late, page + 1, CASE WHEN late THEN 30 ELSE 10 END FROM sup WHERE k % 17 = 0),
cat AS (
  SELECT *, max(page) OVER (PARTITION BY search) + CASE WHEN search % 3 = 1 AND page = 2 THEN 1 ELSE 0 END AS total_pages,
         'P' || k AS permit_code, 'Plant ' || (k - CASE WHEN k % 11 = 1 THEN 1 ELSE 0 END) AS name, md5(CAST(k AS VARCHAR)) AS enterprise_id
  FROM listed)"""


def q_catalog_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result pages rendered from the catalog (at most eleven rows each), then read back."""
    cells = [F.col("province"), F.col("city"), F.col("permit_code"), F.concat(F.lit("<b>"), F.col("name"), F.lit("</b> &amp; Co")),
             F.lit("industry"), F.lit("2020-2030"), F.lit("2020-01-01"), F.lit("key")]
    row = F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), c, F.lit("</td>")) for c in cells],
                   F.lit('<td><a class="x" href="'), F.col("detail_url"), F.lit('">detail</a></td></tr>'))
    pages = _catalog(spark, sf_dir).withColumn("row", row).groupBy("search", "page", "total_pages").agg(
        F.sort_array(F.collect_list(F.struct("pos", "row"))).alias("rows"))
    html = F.concat(F.lit('<form id="mainForm"><input name="a" value="b"></form><script>var totalPages = '), text("total_pages"),
                    F.lit(';</script><table class="tabtd"><tr><th>c</th></tr>'), F.array_join(F.transform("rows", lambda r: r["row"]), "\n"), F.lit("</table>"))
    key = F.concat_ws("-", text("search"), text("page"))
    good, _ = K.catalog_from_pages(pages.select(key.alias("page"), html.alias("html")))
    return good.select("page", "pos", "total_pages", "province", "city", "permit_code", "name", "management", "enterprise_id", "detail_url")


PAGES_SQL = "WITH " + CATALOG + """
SELECT search || '-' || page AS page, CAST(row_number() OVER (PARTITION BY search, page ORDER BY pos) - 1 AS INT) AS pos,
       CAST(total_pages AS INT) AS total_pages, province, city, permit_code, name || ' & Co' AS name, 'key' AS management, enterprise_id,
       '/getxxgkContent.action?dataid=' || enterprise_id AS detail_url FROM cat"""


def q_page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.page_links(fixtures.table(spark, sf_dir, "pages"))


LINKS_SQL = """
WITH l AS (SELECT page_id, regexp_extract_all(html, '(?is)<a\\b[^>]*?\\bhref\\s*=\\s*["'']([^"'']*)["'']', 1) AS hs FROM pages)
SELECT page_id, CAST(i - 1 AS INT) AS pos, hs[i] AS href FROM (SELECT page_id, hs, unnest(range(1, len(hs) + 1)) AS i FROM l)"""


def q_catalog_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.dedupe_catalog(_catalog(spark, sf_dir)).select("permit_code", "enterprise_id", "name", "page", "pos", "duplicates")


DEDUPE_SQL = "WITH " + CATALOG + """
SELECT permit_code, enterprise_id, name, CAST(max(page) AS INT) AS page, CAST(arg_max(pos, page) AS INT) AS pos, count(*) - 1 AS duplicates
FROM cat GROUP BY 1, 2, 3"""


def q_page_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.audit_pages(_catalog(spark, sf_dir), by=["search"])


AUDIT_SQL = "WITH " + CATALOG + """,
b AS (SELECT search, min(total_pages) AS lo, max(total_pages) AS hi FROM cat GROUP BY 1),
p AS (SELECT search, page, count(*) AS n FROM cat GROUP BY 1, 2),
due AS (SELECT search, lo, hi, unnest(range(1, hi + 1)) AS page FROM b)
SELECT search, CAST(page AS INT) AS page, coalesce(n, 0) AS rows,
       CASE WHEN lo <> hi THEN 'page_count_changed' WHEN n IS NULL THEN 'page_missing' WHEN page < hi THEN 'page_not_full' ELSE 'page_too_long' END AS reason
FROM due LEFT JOIN p USING (search, page) WHERE lo <> hi OR n IS NULL OR (page < hi AND n <> 10) OR n > 10"""


def q_region_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer asks for a nation by name under a region; some names are wrong, one is
    listed twice."""
    t = lambda n: fixtures.table(spark, sf_dir, n)
    nation = t("nation").select(text("n_regionkey").alias("parent_code"), F.col("n_name").alias("region_name"), text("n_nationkey").alias("region_code"))
    regions = nation.unionByName(nation.where("region_code = '7'").withColumn("region_code", F.lit("7b")))
    places = t("nation").select("n_nationkey", "n_name", text("n_regionkey").alias("parent_code"))
    k = F.col("c_custkey")
    asked = t("customer").join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.when(k % 19 == 3, "99").otherwise(F.col("parent_code")).alias("parent_code"),
        F.when(k % 13 == 4, F.lower("n_name")).otherwise(F.col("n_name")).alias("region_name"))
    return K.resolve_regions(asked, regions)


REGION_SQL = """
SELECT c_custkey, CASE WHEN c_custkey % 19 = 3 THEN '99' ELSE CAST(n_regionkey AS VARCHAR) END AS parent_code,
       CASE WHEN c_custkey % 13 = 4 THEN lower(n_name) ELSE n_name END AS region_name,
       CASE WHEN c_custkey % 19 <> 3 AND c_custkey % 13 <> 4 AND n_nationkey <> 7 THEN CAST(n_nationkey AS VARCHAR) END AS region_code,
       CASE WHEN c_custkey % 19 = 3 OR c_custkey % 13 = 4 THEN 'absent' WHEN n_nationkey = 7 THEN 'ambiguous' ELSE 'resolved' END AS resolution
FROM customer JOIN nation ON c_nationkey = n_nationkey"""


def _identities(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    listed = K.dedupe_catalog(_catalog(spark, sf_dir))
    c = F.col("c_custkey")
    asked = fixtures.table(spark, sf_dir, "customer").select(
        c.alias("request_id"), F.when(c % 3 != 0, F.concat(F.lit("Plant "), text((c - 1) % 2000))).alias("name"),
        F.when(c % 3 == 0, F.concat(F.lit("P"), text(c % 2000))).alias("permit"))
    return asked, listed


def q_company_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked, listed = _identities(spark, sf_dir)
    return K.resolve_identities(asked, listed)


IDENTITY = "WITH " + CATALOG + """,
uniq AS (SELECT DISTINCT permit_code, enterprise_id, name FROM cat),
ask AS (
  SELECT c_custkey AS request_id, CASE WHEN c_custkey % 3 <> 0 THEN 'Plant ' || ((c_custkey - 1) % 2000) END AS name,
         CASE WHEN c_custkey % 3 = 0 THEN 'P' || (c_custkey % 2000) END AS permit FROM customer),
hit AS (
  SELECT a.request_id, a.name, a.permit, count(u.permit_code) AS matches, min(u.permit_code) AS permit_code, min(u.enterprise_id) AS enterprise_id
  FROM ask a LEFT JOIN uniq u ON u.permit_code = a.permit OR (a.permit IS NULL AND u.name = a.name) GROUP BY 1, 2, 3)"""

IDENTITY_SQL = IDENTITY + """
SELECT request_id, name, permit, matches, CASE matches WHEN 0 THEN 'absent' WHEN 1 THEN 'identified' ELSE 'ambiguous' END AS identity_status,
       CASE WHEN matches = 1 THEN permit_code END AS permit_code, CASE WHEN matches = 1 THEN enterprise_id END AS enterprise_id FROM hit"""


def q_identity_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked, listed = _identities(spark, sf_dir)
    return K.identity_candidates(K.resolve_identities(asked, listed), listed).select("request_id", "name", "permit_code", "enterprise_id")


CANDIDATES_SQL = IDENTITY + """
SELECT h.request_id, h.name, u.permit_code, u.enterprise_id FROM hit h JOIN uniq u ON u.name = h.name WHERE matches > 1 AND permit IS NULL"""


def _facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated catalog with facility details; some details missing or of another kind."""
    listed = K.dedupe_catalog(_catalog(spark, sf_dir))
    k = F.substring("permit_code", 2, 20).cast("bigint")
    dash = F.element_at(F.array(F.lit("-"), F.lit("－"), F.lit("—")), (k % 3 + 1).cast("int"))
    region = F.when(k % 29 == 7, F.concat(F.col("province"), dash, F.col("city"))).otherwise(
        F.concat(F.when(k % 23 == 4, "ELSEWHERE").otherwise(F.col("province")), F.lit(" "), dash, F.col("city"), dash, F.lit(" D"), text(k % 3)))
    body = F.concat(F.lit("许可证编号："), F.when(k % 31 == 2, "other").otherwise(F.col("permit_code")), F.lit(" 所在地区："), region, F.lit(" 发证机关：x 生产经营场所地址：Road "),
                    text(k), F.when(k % 41 == 3, " 行业：y").otherwise(" 行业类别：y"))
    details = listed.where(k % 43 != 6).select("detail_url", body.alias("text"))
    return K.with_facility(listed, details)


def q_district_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = K.filter_district(_facilities(spark, sf_dir), province=F.col("province"), city=F.col("city"), county="D1")
    return placed.select("permit_code", "detail_status", "official_region", "facility_address", "district", "placement")


FACILITY = "WITH " + CATALOG + """,
u AS (SELECT DISTINCT k, permit_code, province, city FROM cat),
d AS (
  SELECT *, CASE k % 3 WHEN 0 THEN '-' WHEN 1 THEN '－' ELSE '—' END AS dash,
         CASE WHEN k % 43 = 6 THEN 'detail_missing' WHEN k % 31 = 2 THEN 'permit_not_in_detail' WHEN k % 41 = 3 THEN 'region_or_address_missing' ELSE 'ok' END AS detail_status FROM u),
f AS (
  SELECT *, CASE WHEN detail_status = 'ok' THEN CASE WHEN k % 29 = 7 THEN province || dash || city
         ELSE (CASE WHEN k % 23 = 4 THEN 'ELSEWHERE' ELSE province END) || ' ' || dash || city || dash || ' D' || (k % 3) END END AS official_region,
         CASE WHEN detail_status = 'ok' THEN CASE WHEN k % 29 = 7 THEN city ELSE 'D' || (k % 3) END END AS district,
         CASE WHEN detail_status <> 'ok' OR k % 29 = 7 OR k % 23 = 4 THEN 'hierarchy_mismatch' WHEN k % 3 = 1 THEN 'selected' ELSE 'other_district' END AS placement FROM d)"""

DISTRICT_SQL = FACILITY + """
SELECT permit_code, detail_status, official_region, CASE WHEN detail_status = 'ok' THEN 'Road ' || k END AS facility_address, district, placement FROM f"""


def q_sample_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The limited sample of a run: the first 25 selected enterprises in catalog order."""
    placed = K.filter_district(_facilities(spark, sf_dir), province=F.col("province"), city=F.col("city"), county="D1")
    return K.sample(placed.where(F.col("placement") == "selected"), 25, ["search", "page", "pos"]).select("permit_code", "search", "page", "pos")


SAMPLE_SQL = FACILITY + """
SELECT permit_code, search, CAST(page AS INT) AS page, CAST(pos AS INT) AS pos
FROM (SELECT c.permit_code, c.search, max(c.page) AS page, arg_max(c.pos, c.page) AS pos FROM cat c GROUP BY 1, 2)
JOIN f USING (permit_code) WHERE placement = 'selected' ORDER BY search, page, pos LIMIT 25"""


def q_discovery_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _catalog(spark, sf_dir)
    placed = K.filter_district(_facilities(spark, sf_dir), province=F.col("province"), city=F.col("city"), county="D1")
    return K.discovery_ledger(rows.withColumn("page", F.struct("search", "page")), placed, K.audit_pages(rows, by=["search"]), mode="region", limit=25)


LEDGER_SQL = FACILITY + """,
viol AS (SELECT count(*) AS n FROM (""" + AUDIT_SQL.replace("WITH " + CATALOG + ",", "WITH") + """)),
c AS (SELECT CAST(max(total_pages) AS INT) AS server_pages, count(DISTINCT (search, page)) AS pages_fetched, count(*) AS catalog_rows FROM cat),
g AS (
  SELECT count(*) AS catalog_unique, count(*) FILTER (detail_status = 'ok') AS details_inspected, count(*) FILTER (placement = 'selected') AS county_matches,
         count(*) FILTER (placement = 'hierarchy_mismatch') AS hierarchy_mismatches FROM f)
SELECT server_pages, pages_fetched, catalog_rows, catalog_unique, details_inspected, county_matches, hierarchy_mismatches, viol.n AS page_violations,
       catalog_rows - catalog_unique AS duplicate_rows, viol.n = 0 AND pages_fetched = server_pages AS catalog_pages_complete,
       details_inspected = catalog_unique AS details_complete, CAST(least(county_matches, 25) AS BIGINT) AS selected_for_reports, 'region' AS mode,
       viol.n = 0 AND pages_fetched = server_pages AND details_inspected = catalog_unique AND catalog_rows = catalog_unique AS discovery_complete,
       county_matches > 25 AS report_sample_limited FROM c, g, viol"""


def _enterprises(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All enterprises, also those without a report."""
    k = F.expr(f"cast(s_suppkey div {fixtures.SUPPLIERS_PER_ENTERPRISE} as string)")
    return fixtures.table(spark, sf_dir, "supplier").select(F.concat(F.lit("E"), k).alias("enterprise_id"), F.concat(F.lit("P"), k).alias("permit_code")).distinct()


def q_index_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = with_report_period(fixtures.index_entries(spark, sf_dir))
    return index_coverage(_enterprises(spark, sf_dir), index, CROSS_YEAR).withColumn("requested_periods", F.array_join("requested_periods", ","))


COVER_SQL = "WITH " + INDEX + f""",
ent AS (SELECT DISTINCT s_suppkey // 5 AS e FROM supplier), yr AS (SELECT unnest([1998, 1999]) AS year)
SELECT 'E' || ent.e AS enterprise_id, 'P' || ent.e AS permit_code, CAST(year AS INT) AS year, count(cls.e) AS index_reports,
       count(bad) AS unreadable_reports, count(*) FILTER (bad IS NULL AND index_year <> y) AS misfiled_reports,
       CASE WHEN count(bad) > 0 THEN 'unreadable_periods' WHEN count(*) FILTER (index_year <> y) > 0 THEN 'misfiled_reports' ELSE 'ok' END AS status,
       count(*) FILTER (list_has_any(periods, {sql_list(["1998-11", "1998-12", "1999-01"])})) AS relevant_reports,
       CASE year WHEN 1998 THEN '1998-11,1998-12' ELSE '1999-01' END AS requested_periods
FROM ent CROSS JOIN yr LEFT JOIN cls ON cls.e = ent.e AND cls.index_year = year GROUP BY ent.e, year"""


def q_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The coverage row of a run over all reports; every eleventh enterprise has one report in
    a format that cannot be read, and some index entries name no period or stand under another year."""
    records = materialize(requested_rows(fixtures.records(spark, sf_dir), QUARTER), "records")
    index = with_report_period(fixtures.index_entries(spark, sf_dir))
    unreadable = F.col("period_error").isNotNull() | (F.substring("enterprise_id", 2, 20).cast("bigint") % 11 == 0) & (F.col("type") == "年报")
    manifest = index.select("report_id", F.when(unreadable, "unsupported_or_invalid").otherwise("downloaded").alias("status"))
    enterprises = _enterprises(spark, sf_dir)
    row = coverage(
        mode="region", selection=QUARTER, enterprises=enterprises, indexes=index_coverage(enterprises, index, QUARTER), manifest=manifest,
        records=records, summary=summarize_period(records, QUARTER), native=summarize_native(partition_kinds(records)[1], QUARTER))
    return row.withColumn("requested_periods", F.array_join("requested_periods", ","))


def _coverage_sql() -> str:
    periods = list(QUARTER.periods)
    return "WITH " + oracles.resolved_months(periods) + ", s AS (" + oracles.period_summary(periods, True) + "), nat AS (" + native_sql(periods, True) + "), i AS (" \
        "WITH " + INDEX + """ SELECT count(*) AS n, count(*) FILTER (bad IS NULL AND NOT (e % 11 = 0 AND t = 'year')) AS d,
             count(*) FILTER (index_year = 1997 AND (bad IS NOT NULL OR index_year <> y)) AS wrong,
             count(DISTINCT e) FILTER (index_year = 1997 AND (bad IS NOT NULL OR index_year <> y)) AS unread FROM cls),
ent AS (SELECT count(DISTINCT s_suppkey // 5) AS n FROM supplier),
w AS (SELECT count(*) FILTER (period_kind = 'month') AS m, count(*) FILTER (period_kind <> 'month') AS x,
             count(*) FILTER (period_kind = 'month' AND num IS NULL) AS z FROM wanted),
g AS (SELECT count(*) AS n, count(*) FILTER (status = 'complete') AS c, count(*) FILTER (status = 'conflict') AS f,
             count(*) FILTER (lower_priority_disagreement) AS l FROM s),
v AS (SELECT count(*) AS n, count(*) FILTER (status = 'selected' AND exactly_matches_request) AS x FROM nat)
SELECT ent.n AS enterprises, ent.n - i.unread AS indexes_completed, CAST(i.wrong AS BIGINT) AS index_errors, i.n AS reports_requested, i.d AS reports_downloaded, i.n - i.d AS reports_unsupported,
       w.m AS air_monthly_rows, w.x AS air_native_period_rows, w.z AS monthly_missing_or_invalid_rows, CAST(0 AS BIGINT) AS unknown_or_conflicting_unit_rows,
       g.n AS period_groups, g.c AS period_complete_groups, g.f AS period_conflict_groups, g.l AS monthly_vs_quarterly_disagreement_groups,
       g.n - g.c AS period_incomplete_groups, v.n AS native_period_groups, v.x AS native_exact_request_groups,
       false AS selected_identity_discovery_complete, 'region' AS mode, true AS whole_months, '1997-04,1997-05,1997-06' AS requested_periods,
       i.n = i.d AND i.unread = 0 AS report_acquisition_complete_for_selected, false AS geographic_completeness, false AS historical_all_permit_enterprises_complete
FROM ent, i, w, g, v"""


QUERIES = {
    "q_catalog_pages": q_catalog_pages, "q_page_links": q_page_links, "q_catalog_dedupe": q_catalog_dedupe, "q_page_audit": q_page_audit,
    "q_region_resolve": q_region_resolve, "q_company_identity": q_company_identity, "q_identity_candidates": q_identity_candidates,
    "q_district_filter": q_district_filter, "q_sample_limit": q_sample_limit, "q_discovery_ledger": q_discovery_ledger,
    "q_index_coverage": q_index_coverage, "q_coverage": q_coverage,
}
ORACLES = {
    "q_catalog_pages": PAGES_SQL, "q_page_links": LINKS_SQL, "q_catalog_dedupe": DEDUPE_SQL, "q_page_audit": AUDIT_SQL,
    "q_region_resolve": REGION_SQL, "q_company_identity": IDENTITY_SQL, "q_identity_candidates": CANDIDATES_SQL,
    "q_district_filter": DISTRICT_SQL, "q_sample_limit": SAMPLE_SQL, "q_discovery_ledger": LEDGER_SQL,
    "q_index_coverage": COVER_SQL, "q_coverage": _coverage_sql(),
}
