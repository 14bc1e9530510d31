"""Units: spelling, evidence, status and physical dimension."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodledger import vocab
from periodledger.functions.text import drop_space, fold_case, trim_space

EVIDENCE = "array<struct<raw:string,unit:string,source:string,template_evidence:string>>"
UNIT_COLUMNS = ["unit_raw", "unit", "unit_source", "unit_status", "unit_evidence", "dimension", "unit_additive"]

_OUTER = "[" + re.escape(vocab.UNIT_OUTER_CHARS) + "]+"


def literal_map(mapping: dict[str, str]) -> Column:
    """Constant map; written as SQL because one expression is built much faster than dozens."""
    return F.expr("map(" + ", ".join(f"'{k}', '{v}'" for k, v in mapping.items()) + ")")


def normalize_unit(clean: Column) -> Column:
    """Unit of a cleaned spelling; NULL when it is not a known one."""
    key = fold_case(F.regexp_replace(drop_space(clean), f"^{_OUTER}|{_OUTER}$", ""))
    for old, new in vocab.UNIT_REWRITES:
        key = F.replace(key, F.lit(old), F.lit(new))
    return F.try_element_at(literal_map(vocab.UNITS), key)


def _evidence(raw: Column, unit: Column, source: Column | str) -> Column:
    source = F.lit(source) if isinstance(source, str) else source
    return F.struct(raw.alias("raw"), unit.alias("unit"), source.alias("source"),
                    F.lit(None).cast("string").alias("template_evidence"))


def _note_evidence(note: Column) -> Column:
    """A note is a unit, or else its first word that is one."""
    words = F.transform(F.split(note, "(?U)" + vocab.UNIT_NOTE_BREAK),
                        lambda w: _evidence(w, normalize_unit(w), "row.remark"))
    whole = _evidence(note, normalize_unit(note), "row.remark")
    options = F.concat(F.array(whole), words)
    return F.coalesce(F.try_element_at(F.filter(options, lambda o: o["unit"].isNotNull()), F.lit(1)), whole)


def unit_evidence(row_raw: Column, row_clean: Column) -> Column:
    """Everything a row says about its unit: notes in the remark, then its unit fields."""
    remark = F.coalesce(F.try_element_at(row_clean, F.lit("remark")), F.lit(""))
    notes = F.transform(
        F.regexp_extract_all(remark, F.lit("(?iU)" + vocab.UNIT_NOTE), 1), lambda n: _note_evidence(trim_space(n)))
    notes = F.when(remark.contains("单位"), notes).otherwise(F.expr(f"cast(array() as {EVIDENCE})"))
    names = F.array(*[F.lit(f) for f in vocab.UNIT_FIELDS])
    clean = lambda f: F.coalesce(F.try_element_at(row_clean, f), F.lit(""))
    given = F.filter(names, lambda f: ~clean(f).isin("", "/", "-"))
    fields = F.transform(given, lambda f: _evidence(F.try_element_at(row_raw, f), normalize_unit(clean(f)), F.concat(F.lit("row."), f)))
    has_field = F.arrays_overlap(F.map_keys(row_clean), names)
    named = F.when(has_field, fields).otherwise(F.expr(f"cast(array() as {EVIDENCE})"))
    return F.concat(notes, named)


def with_unit(df: DataFrame) -> DataFrame:
    """Add UNIT_COLUMNS.

    Needs ``unit_evidence``, ``metric_kind``, ``report_type`` and the template columns
    ``template_allowed``, ``template_unit``, ``template_unit_clean``, ``template_source`` and
    ``template_note``.
    """
    kind = F.col("metric_kind")
    template = F.struct(
        F.col("template_unit").alias("raw"),
        normalize_unit(F.col("template_unit_clean")).alias("unit"),
        F.coalesce(F.nullif(F.col("template_source"), F.lit("")),
                   F.when(F.col("report_type") == "month", vocab.TEMPLATE_SOURCE_MONTH)
                   .otherwise(vocab.TEMPLATE_SOURCE_OTHER)).alias("source"),
        F.nullif(F.col("template_note"), F.lit("")).alias("template_evidence"),
    )
    index = _evidence(F.lit(None).cast("string"), F.lit("dimensionless"), vocab.INDEX_UNIT_SOURCE)
    step = df.withColumn("_rule", F.when(F.size("unit_evidence") > 0, "row").when(kind == "index", "index")
                         .when((kind == "mass") & F.col("template_allowed"), "template").otherwise("none"))
    step = step.withColumn("unit_evidence", F.when(F.col("_rule") == "index", F.array(index))
                           .when(F.col("_rule") == "template", F.array(template))
                           .otherwise(F.col("unit_evidence")))
    step = step.withColumns({
        "_chosen": F.try_element_at("unit_evidence", F.lit(1)),
        "_units": F.array_distinct(F.array_compact(F.transform("unit_evidence", lambda e: e["unit"]))),
        "_unread": F.exists("unit_evidence", lambda e: e["unit"].isNull()),
    })
    status = (
        F.when((F.size("_units") > 1) | (F.col("_unread") & (F.size("unit_evidence") > 1)), "conflict")
        .when(F.col("_chosen")["unit"].isNull(), "unknown")
        .when(F.col("_rule") == "template", "template_default")
        .otherwise("known")
    )
    step = step.withColumns({
        "unit_raw": F.col("_chosen")["raw"], "unit": F.col("_chosen")["unit"],
        "unit_source": F.coalesce(F.col("_chosen")["source"], F.lit("unresolved")),
        "_additive": F.try_element_at(literal_map(vocab.ADDITIVE_UNITS), F.col("_chosen")["unit"]),
        "_status": status,
    })
    clash = (F.col("_additive").isNotNull() & (kind != "unknown") & (kind != F.col("_additive"))) \
        | ((kind == "mass") & F.col("unit").isin(vocab.NOT_A_MASS_UNIT))
    step = step.withColumn("unit_status", F.when(F.coalesce(clash, F.lit(False)), "conflict").otherwise(F.col("_status")))
    step = step.withColumns({
        "dimension": F.coalesce("_additive", "metric_kind"),
        "unit_additive": F.col("_additive").isNotNull() & F.col("unit_status").isin("known", "template_default"),
    })
    return step.drop("_rule", "_chosen", "_units", "_unread", "_additive", "_status")
