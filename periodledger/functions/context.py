"""What a report says about itself: type, period, identity and where they disagree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodledger import vocab
from periodledger.functions import periods as P
from periodledger.functions.text import clean_values, first_filled, fold_key
from periodledger.functions.units import literal_map

STRING_MAP = "map<string,string>"
EMPTY_MAP = f"cast(map() as {STRING_MAP})"
CONTEXT_COLUMNS = [
    "enterprise_id", "enterprise_name", "permit_code", "expected_permit_code", "report_id", "report_type",
    "report_type_raw", "report_time", "report_year", "year", "report_quarter", "report_month", "source_url",
    "report_submit_time", "identity_conflicts",
]
TEMPLATE_COLUMNS = ["template_allowed", "template_unit", "template_unit_clean", "template_source", "template_note"]


def item(mapping: str, key: str) -> Column:
    return F.try_element_at(F.col(mapping), F.lit(key))


def url_parameter(url: Column, name: str) -> Column:
    """Query parameter of a URL; a parameter behind the fragment's ``?`` takes precedence.
    Pattern-based because observed URLs are not always well-formed. NULL when absent."""
    pattern = rf"(?:^|&){name}=([^&]+)"
    query = F.regexp_extract(F.regexp_extract(url, r"^[^#?]*\?([^#]*)", 1), pattern, 1)
    fragment = F.regexp_extract(F.regexp_extract(url, r"#[^?]*\?(.*)$", 1), pattern, 1)
    return F.try_url_decode(F.nullif(first_filled(fragment, query), F.lit("")))


def report_type(clean: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map(vocab.REPORT_TYPES), fold_key(clean)), F.lit("unknown"))


def period_conflicts(kind: Column, year: Column, month: Column, quarter: Column, text_quarter: Column,
                     expected: Column, comparable: Column) -> list[Column]:
    """Disagreements between a report's own period and the period it was filed under."""
    differs = lambda wanted, own: F.coalesce(wanted != own, F.lit(False))
    mismatch = differs(P.text_year(expected), year) \
        | ((kind == "month") & differs(P.text_month(expected), month)) \
        | ((kind == "quarter") & differs(P.text_quarter(expected), quarter))
    return [
        F.when(differs(text_quarter, quarter), "report_quarter_mismatch"),
        F.when(comparable & mismatch, "report_period_mismatch"),
    ]


def with_report_context(reports: DataFrame, *, allow_template_mass_unit: bool = True,
                        table_unit: str = vocab.TEMPLATE_UNIT) -> DataFrame:
    """Add CONTEXT_COLUMNS, TEMPLATE_COLUMNS and ``report_time_clean`` to reports.

    Needs ``info`` (the body's company object), ``meta`` (provenance) and ``enterprise``, all
    string maps that may be NULL. Fallback chains take the first non-empty value.
    """
    company = F.from_json(item("meta", "companyInfo"), STRING_MAP)
    step = reports.withColumns({
        m: F.coalesce(F.col(m), F.expr(EMPTY_MAP)) for m in ("meta", "enterprise")})
    step = step.withColumn("info", F.coalesce(
        F.when(F.size("info") > 0, F.col("info")), company, F.expr(EMPTY_MAP)))
    permits = [item("meta", "permit_code"), item("meta", "permit"),
               item("enterprise", "permit_code"), item("enterprise", "permitCode")]
    step = step.withColumn("_filed", first_filled(
        item("meta", "reportTime"), item("meta", "report_time"), item("meta", "report_period"), item("meta", "report")))
    step = step.withColumns({
        "report_time": first_filled(item("info", "reportTime"), F.col("_filed")),
        "report_type_raw": F.nullif(first_filled(
            item("info", "reportType"), item("meta", "report_type"), item("meta", "reportType"),
            item("meta", "type")), F.lit("")),
        "_permit": first_filled(item("info", "permitCode"), *permits),
        "_expected": first_filled(*permits),
    })
    step = step.withColumn(
        "template_unit", F.when(F.map_contains_key("meta", "air_table_unit"), item("meta", "air_table_unit"))
        .when(F.map_contains_key("meta", "table_unit"), item("meta", "table_unit")).otherwise(F.lit(table_unit)))
    step = step.withColumn("_clean", clean_values(
        F.array("report_time", "_filed", "report_type_raw", "_permit", "_expected", "template_unit")))
    raw_quarter = first_filled(item("info", "reportQuarter"), item("meta", "report_quarter"), item("meta", "reportQuarter"))
    raw_year = first_filled(item("info", "reportYear"), item("meta", "year"))
    text = F.col("_clean")[0]
    month = P.text_month(text)
    step = step.withColumns({
        "report_type": report_type(F.col("_clean")[2]),
        "report_time_clean": text,
        "permit_code": F.col("_clean")[3],
        "expected_permit_code": F.col("_clean")[4],
        "year": F.coalesce(P.text_year(text), F.when(raw_year.rlike(r"^(?:19|20)\d{2}$"), raw_year).try_cast("int")),
        "report_month": F.when(month.between(1, 12), month),
        "_text_quarter": P.text_quarter(text),
        "_field_quarter": F.when(raw_quarter.rlike("^0?[1-4]$"), raw_quarter).try_cast("int"),
        "source_url": first_filled(item("meta", "source_url"), item("meta", "url"), item("meta", "docUrl"),
                                   item("meta", "official_public_url")),
    })
    step = step.withColumn("report_quarter", F.coalesce("_field_quarter", "_text_quarter"))
    conflicts = period_conflicts(
        F.col("report_type"), F.col("year"), F.col("report_month"), F.col("report_quarter"), F.col("_text_quarter"),
        F.col("_clean")[1], (F.col("_filed") != "") & (first_filled(item("info", "reportTime")) != ""))
    permit_clash = (F.col("expected_permit_code") != "") & (F.col("permit_code") != "") \
        & (F.col("expected_permit_code") != F.col("permit_code"))
    allowed = item("meta", "allow_template_mass_unit")
    step = step.withColumns({
        "report_year": F.col("year"),
        "report_id": first_filled(item("meta", "report_id"), item("meta", "reportId"),
                                  url_parameter(F.col("source_url"), "reportId"), item("info", "reportId")),
        "enterprise_id": first_filled(item("enterprise", "enterprise_id"), item("enterprise", "dataid"),
                                      item("enterprise", "id"), F.col("permit_code")),
        "enterprise_name": first_filled(item("info", "enterName"), item("info", "companyName"),
                                        item("enterprise", "enterprise_name"), item("enterprise", "name")),
        "report_submit_time": item("info", "reportSubmitTime"),
        "identity_conflicts": F.array_compact(F.array(*conflicts, F.when(permit_clash, "permit_code_mismatch"))),
        "template_allowed": F.when(F.map_contains_key("meta", "allow_template_mass_unit"),
                                   ~F.coalesce(F.lower(allowed), F.lit("")).isin("", "false", "0"))
        .otherwise(F.lit(allow_template_mass_unit)),
        "template_unit_clean": F.col("_clean")[5],
        "template_source": F.when(F.map_contains_key("meta", "air_table_unit_source"), item("meta", "air_table_unit_source"))
        .otherwise(item("meta", "table_unit_source")),
        "template_note": item("meta", "public_template_unit"),
    })
    return step.drop("_filed", "_permit", "_expected", "_clean", "_text_quarter", "_field_quarter")
