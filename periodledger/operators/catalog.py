"""Catalog of facilities: pages to rows, page audit, identity and facility filters, ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodledger import vocab
from periodledger.functions.text import clean_text, decode_entities, trim_space

CATALOG_KEY = ["permit_code", "enterprise_id"]


# --- pages -----------------------------------------------------------------------------

def html_text(html: Column) -> Column:
    """Visible text: script and style blocks dropped, tags to spaces, entities decoded, white space collapsed."""
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    text = F.regexp_replace(text, r"(?s)<!--.*?-->", " ")
    text = F.regexp_replace(text, r"<[^>]*>", " ")
    return F.trim(F.regexp_replace(decode_entities(text), r"(?U)\s+", " "))


def html_links(html: Column) -> Column:
    """Targets of all links, in page order, quoted or not, with escaped ampersands decoded."""
    written = F.regexp_extract_all(html, F.lit(r"""(?is)<a\b[^>]*?\bhref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""), 1)
    return F.transform(written, lambda h: F.replace(F.regexp_replace(h, r"""^["']|["']$""", ""), F.lit("&amp;"), F.lit("&")))


def _blocks(html: Column, tag: str) -> Column:
    return F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>"), 1)


def page_links(pages: DataFrame) -> DataFrame:
    """One row per link of each page, in order: ``page_id, pos, href``."""
    return pages.select("page_id", F.posexplode(html_links(F.col("html"))).alias("pos", "href"))


def catalog_from_pages(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Catalog rows of archived result pages, and rejects with a reason.

    ``pages``: ``page, html``. A result row has at least nine cells and a detail link with
    exactly one enterprise id. A page without form, page count or result table is rejected as
    a page: it is not evidence that there are no enterprises.
    """
    html = F.col("html")
    step = pages.select("page", html, F.regexp_extract(html, r"\btotalPages\s*=\s*(\d+)", 1).try_cast("int").alias("total_pages"))
    step = step.withColumns({
        "_table": F.regexp_extract(html, r"""(?is)<table\b[^>]*class\s*=\s*["'][^"']*\btabtd\b[^>]*>(.*?)</table\s*>""", 1),
        "_form": html.rlike(r"""(?i)<form\b[^>]*\bid\s*=\s*["']mainForm["']"""),
        "_has_table": html.rlike(r"""(?i)<table\b[^>]*class\s*=\s*["'][^"']*\btabtd\b"""),
    })
    step = step.withColumn("_rows", _blocks(F.col("_table"), "tr"))
    links = lambda r: F.filter(html_links(r), lambda h: h.contains(vocab.CATALOG_LINK))
    is_row = lambda r: (F.size(_blocks(r, "td")) > 0) | (F.size(links(r)) > 0)
    step = step.withColumn("_rows", F.filter("_rows", lambda r, i: (i > 0) & is_row(r)))  # the first is the heading
    step = step.withColumn("reason", F.when(~F.col("_form"), "form_absent").when(F.col("total_pages").isNull(), "page_count_absent")
                           .when(~F.col("_has_table"), "table_absent").when(F.size("_rows") == 0, "no_rows"))
    rows = step.where(F.col("reason").isNull()).select("page", "total_pages", F.posexplode("_rows").alias("pos", "_row"))
    rows = rows.withColumns({
        "_cells": _blocks(F.col("_row"), "td"),
        "_link": F.try_element_at(links(F.col("_row")), F.lit(1)),
    })
    rows = rows.withColumn("_ids", F.regexp_extract_all("_link", F.lit("[?&]dataid=([^&#]*)"), 1))
    rows = rows.withColumn("reason", F.when(F.col("_link").isNull(), "detail_link_absent").when(F.size("_cells") < 9, "too_few_cells")
                           .when((F.size("_ids") != 1) | ~F.coalesce(F.try_element_at("_ids", F.lit(1)).rlike(
                               f"^{vocab.ENTERPRISE_ID}$"), F.lit(False)), "enterprise_id_invalid"))
    good = rows.where(F.col("reason").isNull()).select(
        "page", "pos", "total_pages",
        *[html_text(F.col("_cells")[i]).alias(c) for i, c in enumerate(vocab.CATALOG_COLUMNS)],
        F.col("_ids")[0].alias("enterprise_id"), F.col("_link").alias("detail_url"))
    # Row rejects and page rejects.
    rejects = rows.where(F.col("reason").isNotNull()).select("page", "pos", "reason").unionByName(
        step.where(F.col("reason").isNotNull()).select("page", F.lit(None).cast("int").alias("pos"), "reason"))
    return good, rejects


def audit_pages(catalog: DataFrame, *, by: list[str] | None = None, max_pages: int = vocab.CATALOG_MAX_PAGES,
                page_rows: int = vocab.CATALOG_PAGE_ROWS) -> DataFrame:
    """Violations of complete paging: ``by..., page, rows, reason``; empty when all is whole.

    ``catalog``: ``page`` (from 1), ``total_pages``; ``by`` names the columns that identify a
    search when several were archived. Every page of a search but the last holds exactly
    ``page_rows`` rows and the last 1 to ``page_rows``; the page count never changes.
    """
    by = by or []
    pages = catalog.groupBy(*by, "page").agg(F.count(F.lit(1)).alias("rows"), F.min("total_pages").alias("lo"), F.max("total_pages").alias("hi"))
    bounds = pages.groupBy(*by).agg(F.min("lo").alias("min_total"), F.max("hi").alias("max_total"))
    # Every page a search should have; never longer than the page limit.
    expected = F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.col("max_total"), F.lit(max_pages + 1))))
    spine = bounds.select(*by, F.explode(expected).alias("page"), F.lit(True).alias("_due"))
    seen = pages.select(*by, "page", "rows")
    joined = spine.join(seen, [*by, "page"], "full")
    if by:
        joined = joined.join(bounds, by, "left")
    else:
        joined = joined.crossJoin(bounds)  # one row
    rows = F.coalesce("rows", F.lit(0))
    reason = (
        F.when(F.col("min_total") != F.col("max_total"), "page_count_changed")
        .when(F.col("page") > max_pages, "beyond_page_limit")
        .when(F.col("_due").isNull(), "page_beyond_total")
        .when(rows == 0, "page_missing")
        .when((F.col("page") < F.col("max_total")) & (rows != page_rows), "page_not_full")
        .when(rows > page_rows, "page_too_long")
    )
    return joined.select(*by, "page", rows.cast("bigint").alias("rows"), reason.alias("reason")).where(F.col("reason").isNotNull())


def dedupe_catalog(catalog: DataFrame) -> DataFrame:
    """One row per permit and enterprise, the last listed; ``duplicates`` counts the others."""
    rest = [c for c in catalog.columns if c not in CATALOG_KEY]
    newest = F.struct("page", "pos")
    merged = catalog.groupBy(*CATALOG_KEY).agg(
        F.max_by(F.struct(*rest), newest).alias("r"), (F.count(F.lit(1)) - 1).alias("duplicates"))
    return merged.select(*CATALOG_KEY, "r.*", "duplicates")


# --- regions and identity --------------------------------------------------------------

def resolve_regions(requests: DataFrame, regions: DataFrame) -> DataFrame:
    """Exact lookup of ``region_name`` under ``parent_code``; must match exactly one region.

    Adds ``region_code`` (NULL unless resolved) and ``resolution``. The region side is merged
    to one row per name first, so a much-requested region never multiplies rows.
    """
    names = regions.groupBy("parent_code", "region_name").agg(
        F.count(F.lit(1)).alias("_n"), F.min("region_code").alias("region_code"))
    joined = requests.join(names, ["parent_code", "region_name"], "left")
    resolution = F.when(F.col("_n").isNull(), "absent").when(F.col("_n") > 1, "ambiguous").otherwise("resolved")
    return joined.withColumns({"region_code": F.when(F.col("_n") == 1, F.col("region_code")), "resolution": resolution}).drop("_n")


def resolve_identities(requests: DataFrame, catalog: DataFrame, *, pages_complete: bool = True) -> DataFrame:
    """Company requests against the catalog: exact ``permit`` if given, else exact ``name``.

    Exactly one match identifies a company; ``enterprise_id`` and ``permit_code`` are NULL
    otherwise. With incomplete pages nobody is identified. ``requests``: ``request_id, name,
    permit`` (either may be NULL).
    """
    def one_of(column: str) -> DataFrame:
        return catalog.groupBy(F.col(column).alias("_wanted")).agg(
            F.count(F.lit(1)).alias("matches"), F.min(F.struct("permit_code", "enterprise_id")).alias("_hit"))

    merged = one_of("permit_code").withColumn("_by", F.lit("permit")).unionByName(
        one_of("name").withColumn("_by", F.lit("name")))
    asked = requests.withColumns({
        "_by": F.when(F.coalesce("permit", F.lit("")) != "", "permit").otherwise("name"),
        "_wanted": F.coalesce(F.nullif("permit", F.lit("")), "name"),
    })
    joined = asked.join(merged, ["_by", "_wanted"], "left")
    matches = F.coalesce("matches", F.lit(0))
    status = F.when(F.lit(not pages_complete), "pages_incomplete").when(matches == 1, "identified") \
        .when(matches == 0, "absent").otherwise("ambiguous")
    hit = (matches == 1) & F.lit(pages_complete)
    return joined.select(
        *requests.columns, matches.cast("bigint").alias("matches"), status.alias("identity_status"),
        F.when(hit, F.col("_hit.permit_code")).alias("permit_code"), F.when(hit, F.col("_hit.enterprise_id")).alias("enterprise_id"))


def identity_candidates(resolved: DataFrame, catalog: DataFrame) -> DataFrame:
    """For name requests that were not unique: the catalog rows to choose from."""
    open_requests = resolved.where(F.col("identity_status") == "ambiguous").select("request_id", "name")
    return open_requests.join(catalog, "name")


# --- facilities ------------------------------------------------------------------------

def with_facility(catalog: DataFrame, details: DataFrame) -> DataFrame:
    """Catalog rows with region and address of their detail page; ``detail_status`` says why
    a row has none. ``details``: ``detail_url, text`` with one row per URL."""
    content = details.select("detail_url", trim_space(F.col("text")).alias("_text"), F.sha2("text", 256).alias("detail_sha256"))
    joined = catalog.join(content, "detail_url", "left")
    region, address = F.regexp_extract("_text", vocab.DETAIL_REGION, 1), F.regexp_extract("_text", vocab.DETAIL_ADDRESS, 1)
    status = (
        F.when(F.col("_text").isNull(), "detail_missing")
        .when(F.instr("_text", F.col("permit_code")) == 0, "permit_not_in_detail")
        .when(~F.col("_text").rlike(vocab.DETAIL_REGION) | ~F.col("_text").rlike(vocab.DETAIL_ADDRESS), "region_or_address_missing")
        .otherwise("ok")
    )
    ok = status == "ok"
    return joined.withColumns({
        "detail_status": status, "official_region": F.when(ok, trim_space(region)), "facility_address": F.when(ok, trim_space(address)),
    }).drop("_text")


def filter_district(facilities: DataFrame, *, province: Column | str | None = None, city: Column | str | None = None,
                    county: Column | str | None = None) -> DataFrame:
    """Place each facility by its official region; adds ``district`` and ``placement``:

    ``selected``, ``other_district`` (normal, not an error) or ``hierarchy_mismatch`` (fewer
    than three levels, or another province or city than asked for).
    """
    parts = F.transform(F.split("official_region", vocab.REGION_SEPARATOR), trim_space)
    wanted = lambda v: v if isinstance(v, Column) else F.lit(v)
    step = facilities.withColumn("_parts", parts)
    step = step.withColumn("district", F.try_element_at("_parts", F.lit(-1)))
    differs = lambda level, v: F.lit(False) if v is None else F.coalesce(F.try_element_at("_parts", F.lit(level)) != wanted(v), F.lit(True))
    bad = (F.coalesce(F.size("_parts"), F.lit(0)) < 3) | differs(1, province) | differs(2, city)
    here = F.lit(True) if county is None else F.col("district") == wanted(county)
    return step.withColumn("placement", F.when(bad, "hierarchy_mismatch").when(here, "selected").otherwise("other_district")).drop("_parts")


def sample(ordered: DataFrame, limit: int, order: list[str]) -> DataFrame:
    """The first ``limit`` rows in a declared order; 0 means all. Spark plans this as a
    distributed top-k (per-partition first, then merged)."""
    return ordered.orderBy(*order).limit(limit) if limit else ordered


def discovery_ledger(catalog: DataFrame, placed: DataFrame, violations: DataFrame, *, mode: str, pages_read: int | None = None,
                     limit: int = 0) -> DataFrame:
    """One row: page, duplicate, detail and selection counts with the completeness flags.

    ``catalog`` is the raw catalog, ``placed`` the deduplicated facilities with ``placement``
    and ``detail_status``. ``pages_read`` is how many pages were to be read (None: all); a catalog is complete if that
    covers the server's count.
    """
    count_if = lambda c: F.count_if(c)
    pages = catalog.agg(F.max("total_pages").alias("server_pages"), F.count_distinct("page").alias("pages_fetched"),
                        F.count(F.lit(1)).alias("catalog_rows"))
    found = placed.agg(
        F.count(F.lit(1)).alias("catalog_unique"), count_if(F.col("detail_status") == "ok").alias("details_inspected"),
        count_if(F.col("placement") == "selected").alias("county_matches"),
        count_if(F.col("placement") == "hierarchy_mismatch").alias("hierarchy_mismatches"))
    broken = violations.agg(F.count(F.lit(1)).alias("page_violations"))
    row = pages.crossJoin(found).crossJoin(broken)  # three one-row tables
    row = row.withColumns({
        "duplicate_rows": F.col("catalog_rows") - F.col("catalog_unique"),
        "catalog_pages_complete": (F.col("page_violations") == 0) & (
            F.col("pages_fetched") == F.col("server_pages")) & (F.lit(True) if pages_read is None else F.col("server_pages") <= pages_read),
        "details_complete": F.col("details_inspected") == F.col("catalog_unique"),
        "selected_for_reports": F.when(F.lit(limit == 0), F.col("county_matches")).otherwise(
            F.least(F.col("county_matches"), F.lit(limit))),
    })
    no_duplicates = F.col("duplicate_rows") == 0
    complete = (F.col("county_matches") == 1) & F.col("catalog_pages_complete") & no_duplicates if mode == "company" else \
        F.col("catalog_pages_complete") & F.col("details_complete") & no_duplicates
    return row.withColumns({
        "mode": F.lit(mode), "discovery_complete": complete,
        "report_sample_limited": F.col("selected_for_reports") < F.col("county_matches"),
    })
