"""Report bodies (nested JSON) to one long record per row and value field.

Everything here is map-side: a report is parsed, exploded and cleaned where it is read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodledger import vocab
from periodledger.functions import periods as P
from periodledger.functions.context import (
    CONTEXT_COLUMNS, EMPTY_MAP, STRING_MAP, TEMPLATE_COLUMNS, with_report_context)
from periodledger.functions.identity import emission_scope, with_pollutant
from periodledger.functions.numbers import NUMBER_COLUMNS, fence, with_number
from periodledger.functions.text import clean_map, last_wins, object_keys, object_places
from periodledger.functions.units import UNIT_COLUMNS, unit_evidence, with_unit
from periodledger.operators.timeselect import TimeSelection
from periodledger.sources.scratch import materialize

RECORD_COLUMNS = CONTEXT_COLUMNS + UNIT_COLUMNS + [
    "month", "period_kind", "section", "scope", "outlet_code", "outlet_name", "port_type_raw",
    "pollutant_code_raw", "pollutant_name_raw", "pollutant_code", "pollutant_name", "pollutant_key",
    "metric_kind", "pollutant_identity_conflict", "field", "field_present", "value_raw", *NUMBER_COLUMNS,
    "value_status", "json_pointer", "row_json_pointer", "row_id", "source_row_report_id", "remark",
    "raw_row", "schema_warnings", "aggregation_eligible", "period_classifier_mismatch",
]


def pointer_token(name: Column) -> Column:
    """One reference token of a JSON pointer."""
    return F.replace(F.replace(name, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))


def parse_bodies(reports: DataFrame) -> DataFrame:
    """Add ``info`` and ``sections`` (air sections only, raw text by name) to reports with a
    JSON ``body``. ``body_ok`` is false where the body is not a JSON object. Of a key that an
    object repeats, the last value counts. A JSON string is never opened, whatever it holds."""
    once = lambda df, *names: df.withColumns({n: last_wins(F.col(n)) for n in names})
    step = once(reports.withColumn("_body", F.from_json("body", STRING_MAP)), "_body")
    step = step.withColumn("_objects", object_keys(F.col("body")))
    part = lambda key: F.when(F.coalesce(F.array_contains("_objects", key), F.lit(True)), F.try_element_at("_body", F.lit(key)))
    step = once(step.withColumns({
        "body_ok": F.col("_body").isNotNull(),
        "info": F.from_json(part("companyInfo"), STRING_MAP),
        "_emission": F.from_json(part("emissionInfo"), STRING_MAP),
    }), "info", "_emission")
    sections = F.map_filter("_emission", lambda k, v: F.lower(k).startswith("air") & v.isNotNull())
    return step.withColumn("sections", sections).drop("_body", "_emission", "_objects", "body")


def rejected_bodies(reports: DataFrame, keys: list[str]) -> DataFrame:
    """Reports that give no records because their body cannot be read: ``keys`` and ``reason``. Flattening passes over
    them, so a run keeps this table beside its records."""
    read = F.from_json("body", STRING_MAP).isNotNull()
    reason = F.when(F.col("body").isNull(), "body_missing").when(~read, "body_not_an_object")
    return reports.select(*keys, reason.alias("reason")).where(F.col("reason").isNotNull())


def explode_rows(parsed: DataFrame) -> DataFrame:
    """One row per section row: ``section``, ``row_json_pointer``, ``raw_row``, ``row`` (map,
    empty when the row is not an object), ``schema_warnings``."""
    # Outer generators: an inner one would make the optimizer test the parsed value for
    # emptiness below the generator, and so parse every body a second time.
    step = parsed.select("*", F.explode_outer("sections").alias("section", "_text")).drop("sections")
    step = step.where(F.col("section").isNotNull())
    step = step.withColumn("_items", F.from_json("_text", "array<string>"))
    step = step.withColumn("_is_list", F.col("_items").isNotNull()).withColumn("_objects", object_places(F.col("_text")))
    step = step.select(
        *[c for c in step.columns if c not in ("_items", "_text")],
        F.posexplode_outer(F.coalesce("_items", F.array("_text"))).alias("_ord", "raw_row"))
    step = step.where(F.col("_ord").isNotNull())
    # Of a list, an item that is a string stays one; a section that is no list stands for its only row.
    item = F.coalesce(F.get("_objects", F.col("_ord")), F.lit(True))
    step = step.withColumn("_row", F.from_json(F.when(item, F.col("raw_row")), STRING_MAP)).drop("_objects")
    step = step.withColumn("_row", last_wins(F.col("_row")))
    base = F.concat(F.lit("/emissionInfo/"), pointer_token(F.col("section")),
                    F.when(F.col("_is_list"), F.concat(F.lit("/"), F.col("_ord").cast("string"))).otherwise(F.lit("")))
    return step.withColumns({
        "row_json_pointer": base,
        "row": F.coalesce("_row", F.expr(EMPTY_MAP)),
        "schema_warnings": F.array_compact(F.array(
            F.when(~F.col("_is_list"), "section_not_list"), F.when(F.col("_row").isNull(), "row_not_object"))),
    }).drop("_row", "_ord", "_is_list")


def value_fields() -> Column:
    """The value fields of a row with their month and kind, decided by the report type."""
    def field(month: Column, name: Column | None, kind: Column) -> Column:
        return F.struct(month.cast("int").alias("month"), (F.lit(None) if name is None else name).cast("string").alias("field"),
                        kind.alias("period_kind"))

    none, kind, quarter = F.lit(None), F.col("report_type"), F.col("report_quarter")
    months = [field(quarter * 3 - 2 + i, F.lit(name), F.lit("month")) for i, name in enumerate(vocab.QUARTER_FIELDS)]
    total = field(none, F.lit(vocab.TOTAL_FIELD), kind)
    return (
        F.when(kind == "month", F.array(field(F.col("report_month"), F.lit(vocab.MONTH_FIELD), F.lit("month"))))
        .when((kind == "quarter") & quarter.between(1, 4), F.array(*months, total))
        .when(kind.isin("quarter", "year"), F.array(total))
        .otherwise(F.array(field(none, None, F.lit("unknown"))))
    )


def requested_fields(selection: TimeSelection) -> Column:
    """The value fields of :func:`value_fields` whose records :func:`requested_rows` keeps. A record's period is that of its report
    and field, so this is known before any row is read."""
    def wanted(field: Column) -> Column:
        periods = P.covered_periods(F.col("year"), field["period_kind"], field["month"], F.col("report_quarter"))
        return (F.size(periods) == 0) | P.overlaps(periods, selection.array())

    return F.filter(value_fields(), wanted)


def eligibility() -> Column:
    """A record may enter a total only if nothing about it is in doubt."""
    known_period = (
        ((F.col("period_kind") == "month") & F.col("month").between(1, 12))
        | ((F.col("period_kind") == "quarter") & F.col("report_quarter").between(1, 4))
        | (F.col("period_kind") == "year")
    )
    return F.coalesce(
        F.col("value_decimal").isNotNull() & F.col("unit_additive") & (F.col("pollutant_identity") != "")
        & ~F.col("pollutant_identity_conflict") & (F.size("identity_conflicts") == 0) & known_period
        & F.col("year").isNotNull() & (F.size("schema_warnings") == 0) & ~F.col("scope").startswith("unknown:"),
        F.lit(False))


def _text_kind_differs() -> Column:
    """The wording of the period and the declared type name different kinds of period."""
    time = F.coalesce(F.col("report_time_clean"), F.lit(""))
    worded = F.when(P.text_month(time).isNotNull(), "month").when(P.text_quarter(time).isNotNull(), "quarter") \
        .when(time.contains(vocab.ANNUAL_WORD), "year")
    return F.coalesce(worded != F.col("report_type"), F.lit(False))


def flatten_reports(reports: DataFrame, *, keys: list[str] | None = None, allow_template_mass_unit: bool = True,
                    table_unit: str = vocab.TEMPLATE_UNIT, selection: TimeSelection | None = None) -> DataFrame:
    """Long records of reports with columns ``body``, ``meta`` and ``enterprise``.

    With ``selection`` only the records that :func:`requested_rows` keeps: reports without any are left before their rows are read.

    ``keys`` are further input columns to carry along (a report key, for one). Rows that are
    malformed, unreadable or unknown stay in the result with a status.
    """
    keys = keys or []
    parsed = parse_bodies(reports.select("body", "meta", "enterprise", *keys))
    context = with_report_context(parsed, allow_template_mass_unit=allow_template_mass_unit, table_unit=table_unit)
    context = context.withColumn("period_classifier_mismatch", _text_kind_differs())
    context = context.select(*keys, *CONTEXT_COLUMNS, *TEMPLATE_COLUMNS, "period_classifier_mismatch", "sections")
    fields = value_fields()
    if selection is not None:
        fields = requested_fields(selection)
        judged = context.withColumn("_asked", F.size(fields) > 0)
        context = fence(judged, ["_asked"], context.columns).where("_asked").drop("_asked")
    rows = explode_rows(context)
    rows = rows.withColumn("clean", clean_map(F.col("row")))
    clean = lambda key: F.coalesce(F.try_element_at("clean", F.lit(key)), F.lit(""))
    raw = lambda key: F.try_element_at("row", F.lit(key))
    rows = rows.withColumns({
        "_code": clean("pollutantCode"), "_name": clean("pollutantName"), "_port": clean("portType"),
        "outlet_code": clean("outletCode"), "outlet_name": clean("outletName"), "row_id": clean("id"),
        "source_row_report_id": clean("reportId"),
        "pollutant_code_raw": raw("pollutantCode"), "pollutant_name_raw": raw("pollutantName"),
        "port_type_raw": raw("portType"), "remark": raw("remark"),
        "unit_evidence": unit_evidence(F.col("row"), F.col("clean")),
    })
    rows = with_unit(with_pollutant(rows, "_code", "_name"))
    rows = rows.withColumns({
        "scope": emission_scope(F.col("section"), F.col("_port"), F.col("outlet_name"), F.col("outlet_code")),
        "pollutant_key": F.coalesce(F.nullif("pollutant_identity", F.lit("")),
                                    F.concat(F.lit("unknown:"), F.col("row_json_pointer"))),
        "report_id": F.coalesce(F.nullif("report_id", F.lit("")), "source_row_report_id"),
    })
    values = rows.select("*", F.inline(fields))
    values = values.withColumns({
        "field_present": F.coalesce(F.map_contains_key("row", F.col("field")), F.lit(False)),
        "value_raw": F.try_element_at("row", F.col("field")),
        "_value": F.coalesce(F.try_element_at("clean", F.col("field")), F.lit("")),
        "json_pointer": F.concat("row_json_pointer", F.coalesce(
            F.concat(F.lit("/"), pointer_token(F.col("field"))), F.lit(""))),
    })
    values = with_number(values, clean="_value", raw="value_raw", present="field_present")
    values = values.withColumn("aggregation_eligible", eligibility())
    return values.select(*keys, *RECORD_COLUMNS)


def prune_sections(reports: DataFrame, *, keys: list[str]) -> DataFrame:
    """Air parts of each body at any object depth (lists are not entered), in long form.

    Columns: ``keys``, ``path``, ``value`` (NULL for a JSON null) and ``status``: ``kept`` for the company object and the entries
    with air keys, or ``unreadable_body`` (no path) for a body that is not a JSON object. A JSON string is not entered. Objects are opened
    level by level, in as many jobs as the deepest body has levels; each level is stored and holds only the air parts found and the
    objects still to open.
    """
    company = F.col("path") == "/companyInfo"
    opened = [F.from_json("_text", STRING_MAP).alias("_object"), object_keys(F.col("_text")).alias("_objects")]
    top = reports.select(*keys, F.lit("").alias("_above"), F.col("body").alias("_text"))
    unreadable = top.where(F.from_json("_text", STRING_MAP).isNull()).select(
        *keys, *[F.lit(None).cast("string").alias(c) for c in ("path", "value")], F.lit("unreadable_body").alias("status"))
    parts, inside = [unreadable], top.select(*keys, "_above", *opened)
    while True:
        entries = inside.withColumn("_object", last_wins(F.col("_object"))).select(*keys, "_above", "_objects", F.explode("_object").alias("_key", "value"))
        entries = entries.withColumn("path", F.concat("_above", F.lit("/"), pointer_token(F.col("_key"))))
        air = F.lower("_key").startswith("air")
        kept = (company & F.col("value").isNotNull()) | (~company & air)
        nested = F.ltrim("value").startswith("{") & F.coalesce(F.array_contains("_objects", F.col("_key")), F.lit(True))
        entries = entries.withColumn("status", F.when(kept, "kept").when(~company & nested, "open"))
        level = materialize(entries.where(F.col("status").isNotNull()).select(*keys, "path", "value", "status"), "pruned-level")
        parts.append(level.where(F.col("status") == "kept"))
        inner = level.where(F.col("status") == "open")
        if inner.isEmpty():
            return reduce(DataFrame.unionByName, parts)
        inside = inner.select(*keys, F.col("path").alias("_above"), F.col("value").alias("_text")).select(*keys, "_above", *opened)
