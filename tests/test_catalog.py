import pytest

from periodledger.operators.catalog import (
    audit_pages, catalog_from_pages, dedupe_catalog, discovery_ledger, filter_district, html_text, resolve_identities, with_facility)
from periodledger.operators.coverage import coverage, index_coverage
from periodledger.operators.timeselect import select_time, with_report_period


def page(numbers, total=1, name="Plant", table=True, cells=8, link="/getxxgkContent.action?dataid=%032x"):
    head = '<form id="mainForm"><input name="k" value="v"></form><script>var totalPages = %d;</script>' % total
    if not table:
        return head
    rows = ["<tr>" + "<th>c</th>" * 9 + "</tr>"]
    for n in numbers:
        values = ["A省", "B市", f"P{n}", name, "i", "2020-2030", "2020-01-01", "key"][:cells]
        target = link % n if "%" in link else link
        rows.append("<tr>" + "".join(f"<td>{v}</td>" for v in values) + f'<td><a href="{target}">x</a></td></tr>')
    return head + '<table class="tabtd">' + "".join(rows) + "</table>"


def catalog(spark, *counts, total=None):
    rows = [(p + 1, i, total or len(counts), f"P{p}-{i}", f"E{p}-{i}", "Plant") for p, n in enumerate(counts) for i in range(n)]
    return spark.createDataFrame(rows, "page int, pos int, total_pages int, permit_code string, enterprise_id string, name string")


def test_pages_become_rows_or_rejects(spark):
    pages = [("ok", page(range(1, 4))), ("no table", page([], table=False)), ("no form", "<html></html>"), ("empty", page([])),
             ("short", page([1], cells=3)), ("bad id", page([1], link="/getxxgkContent?dataid=XYZ")), ("two ids", page([1], link="/getxxgkContent?dataid=" + "a" * 32 + "&dataid=" + "b" * 32)),
             ("no link", page([1], link="/elsewhere")), ("no count", page([1]).replace("totalPages", "other"))]
    good, rejects = catalog_from_pages(spark.createDataFrame(pages, "page string, html string"))
    rows = good.orderBy("pos").collect()
    assert [(r.page, r.permit_code, r.province, r.total_pages) for r in rows] == [("ok", f"P{n}", "A省", 1) for n in (1, 2, 3)]
    assert rows[0].enterprise_id == "%032x" % 1
    assert {r.page: r.reason for r in rejects.collect()} == {
        "no table": "table_absent", "no form": "form_absent", "empty": "no_rows", "short": "too_few_cells", "bad id": "enterprise_id_invalid",
        "two ids": "enterprise_id_invalid", "no link": "detail_link_absent", "no count": "page_count_absent"}


@pytest.mark.parametrize("counts,total,reasons", [
    ((10, 1), None, []), ((10, 10), None, []), ((10,), None, []), ((9, 1), None, ["page_not_full"]), ((11, 1), None, ["page_not_full"]), ((10, 11), None, ["page_too_long"]),
    ((10, 0, 1), None, ["page_missing"]), ((10, 9, 1), None, ["page_not_full"]), ((10, 10), 3, ["page_missing"]), ((10, 10, 3), 2, ["page_beyond_total"])])
def test_page_audit(spark, counts, total, reasons):
    assert [r.reason for r in audit_pages(catalog(spark, *counts, total=total)).collect()] == reasons


def test_page_audit_limits(spark):
    rows = catalog(spark, 10, 2)
    assert audit_pages(rows, max_pages=1).where("reason = 'beyond_page_limit'").count() == 1
    assert audit_pages(rows.unionByName(catalog(spark, 1, total=9))).where("reason = 'page_count_changed'").count() >= 2


def test_duplicates_keep_the_last(spark):
    rows = catalog(spark, 2).unionByName(catalog(spark, 1).selectExpr("page + 1 as page", "pos", "total_pages", "permit_code", "enterprise_id", "'newer' as name"))
    got = {r.permit_code: (r.name, r.duplicates) for r in dedupe_catalog(rows).collect()}
    assert got == {"P0-0": ("newer", 1), "P0-1": ("Plant", 0)}


def test_identity_needs_one_match_and_all_pages(spark):
    rows = catalog(spark, 2)
    asked = spark.createDataFrame([(1, "Plant", None), (2, None, "P0-1"), (3, "Plan", None)], "request_id int, name string, permit string")
    got = {r.request_id: (r.identity_status, r.permit_code) for r in resolve_identities(asked, rows).collect()}
    assert got == {1: ("ambiguous", None), 2: ("identified", "P0-1"), 3: ("absent", None)}
    assert {r.identity_status for r in resolve_identities(asked, rows, pages_complete=False).collect()} == {"pages_incomplete"}


def facilities(spark, region):
    rows = spark.createDataFrame([("u", "P1", "E1")], "detail_url string, permit_code string, enterprise_id string")
    text = f"许可证编号：P1 所在地区：{region} 发证机关：x 生产经营场所地址：Road 1 行业类别：y"
    return with_facility(rows, spark.createDataFrame([("u", text)], "detail_url string, text string"))


@pytest.mark.parametrize("region,placement", [
    ("A省-B市-C县", "selected"), ("A省 － B市 — C县", "selected"), ("A省-B市-D县", "other_district"), ("Z省-B市-C县", "hierarchy_mismatch"),
    ("A省-Y市-C县", "hierarchy_mismatch"), ("A省-C县", "hierarchy_mismatch")])
def test_districts(spark, region, placement):
    got = filter_district(facilities(spark, region), province="A省", city="B市", county="C县").first()
    assert (got.placement, got.facility_address) == (placement, "Road 1")


def test_other_district_is_complete_discovery(spark):
    placed = filter_district(facilities(spark, "A省-B市-D县"), province="A省", city="B市", county="C县")
    rows = catalog(spark, 1)
    ledger = discovery_ledger(rows, placed, audit_pages(rows), mode="region").first()
    assert (ledger.county_matches, ledger.details_inspected, ledger.discovery_complete, ledger.report_sample_limited) == (0, 1, True, False)
    whole = [discovery_ledger(rows, placed, audit_pages(rows), mode="region", pages_read=n).first().catalog_pages_complete for n in (100, 1, 0)]
    assert whole == [True, True, False]


def test_links_as_html_writes_them(spark):
    texts = ['/getxxgkContent.action?kind=1&amp;dataid=%032x', "/getxxgkContent.action?dataid=%032x"]
    pages = [("escaped", page([1], link=texts[0])), ("unquoted", page([1], link=texts[1]).replace('"/get', "/get").replace('1">', "1>"))]
    good, rejects = catalog_from_pages(spark.createDataFrame(pages, "page string, html string"))
    assert {(r.page, r.enterprise_id, r.detail_url) for r in good.collect()} == {
        ("escaped", "%032x" % 1, "/getxxgkContent.action?kind=1&dataid=%032x" % 1), ("unquoted", "%032x" % 1, texts[1] % 1)}
    assert rejects.isEmpty()


def test_index_errors_are_counted_and_leave_an_index_incomplete(spark):
    selection = select_time(years=[2023])
    ents = spark.createDataFrame([(e, "P") for e in ("fine", "unread", "misfiled")], "enterprise_id string, permit_code string")
    entries = [("fine", 2023, "2023年05月", "月报"), ("unread", 2023, "2023年13月", "月报"), ("unread", 2023, "later", "月报"),
               ("unread", 2023, "2023年06月", "月报"), ("misfiled", 2023, "2022年12月", "月报")]
    index = with_report_period(spark.createDataFrame(entries, "enterprise_id string, index_year int, report_time string, type string"))
    got = {r.enterprise_id: (r.index_reports, r.relevant_reports, r.unreadable_reports, r.misfiled_reports, r.status)
           for r in index_coverage(ents, index, selection).collect()}
    assert got == {"fine": (1, 1, 0, 0, "ok"), "unread": (3, 1, 2, 0, "unreadable_periods"), "misfiled": (1, 0, 0, 1, "misfiled_reports")}


def test_page_text_decodes_every_entity_once(spark):
    pages = ["<p>a &amp;lt; b &#233;&#xE9; &copy 2024&nbsp;&nbsp;x</p>", "&am & &; &#39;q&#39;", "&lt;b&gt; &notit; &hearts;", "plain", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(pages)], "i int, h string")
    got = {r.i: r.t for r in df.select("i", html_text(df.h).alias("t")).collect()}
    assert got == {0: "a &lt; b éé © 2024 x", 1: "&am & &; 'q'", 2: "<b> ¬it; ♥", 3: "plain", 4: None}


def test_coverage_of_nothing_is_not_success(spark):
    selection = select_time(years=[2023, 2024])
    ents = spark.createDataFrame([], "enterprise_id string, permit_code string")
    one = spark.createDataFrame([("e", "P1")], "enterprise_id string, permit_code string")
    index = with_report_period(spark.createDataFrame([], "enterprise_id string, index_year int, report_time string, type string"))
    spine = index_coverage(one, index, selection).orderBy("year").collect()
    assert [(r.year, r.index_reports, r.relevant_reports) for r in spine] == [(2023, 0, 0), (2024, 0, 0)]
    manifest = spark.createDataFrame([], "status string")
    records = spark.createDataFrame([], "period_kind string, value_decimal string, unit_status string")
    summary = spark.createDataFrame([], "complete boolean, status string, lower_priority_disagreement boolean")
    native = spark.createDataFrame([], "status string, exactly_matches_request boolean")
    run = dict(mode="company", selection=selection, manifest=manifest, records=records, summary=summary, native=native)
    none = coverage(enterprises=ents, indexes=index_coverage(ents, index, selection), **run).first()
    assert (none.enterprises, none.report_acquisition_complete_for_selected, none.geographic_completeness) == (0, False, None)
    some = coverage(enterprises=one, indexes=index_coverage(one, index, selection), **run).first()
    assert (some.reports_requested, some.report_acquisition_complete_for_selected) == (0, True)
