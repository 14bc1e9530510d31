"""Competing sources resolved per group and month, and summed per group.

Shape of the plan. Records are aggregated in three steps, each with map-side partials, so a
group, month or document that holds a large share of all records is reduced before it is
shuffled and never gathered in one task:

1. (group, period, tier, document): value and row-pointer ranges, as fixed-width columns, so
   this is a hash aggregate although it sees every record;
2. (group, period): which tier wins, whether it is in conflict;
3. (group): the requested months, at most one entry each, and descriptive fields.

Digits beyond the 38 that fit a fixed width are text. They are no part of steps 1 and 2, which tell such values apart by
their hashes, and join the selected months in step 3, in the rows that bring the descriptions.

Every group key comes from all requested records, so that a group with only a yearly report
still appears with all its months missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodledger.functions import periods as P
from periodledger.functions.numbers import wide_digits, wide_text_sql, with_decimal_sum, with_rebuilt_text
from periodledger.functions.text import first_filled
from periodledger.operators.timeselect import TimeSelection, requested_rows, with_row_periods

GROUP_KEY = ["enterprise_id", "permit_code", "pollutant_key", "scope", "outlet_key", "unit_key"]
DESCRIPTION = ["enterprise_name", "pollutant_code", "pollutant_name", "outlet_code", "outlet_name", "dimension"]
NO_OUTLET = "__group__"
NATIVE_RULE = "The total as it was filed for its quarter or year; it stands beside the months."
UNIDENTIFIED = "unidentified_report"

_RANGES = ["value_id", "value", "row_id1", "row_id2"]


def with_group_key(records: DataFrame) -> DataFrame:
    """Add ``outlet_key`` and ``unit_key``; a NULL unit is a key value of its own ('')."""
    return records.withColumns({
        "outlet_key": F.coalesce(F.nullif("outlet_code", F.lit("")), F.nullif("outlet_name", F.lit("")), F.lit(NO_OUTLET)),
        "unit_key": F.coalesce("unit", F.lit("")),
        **{c: F.coalesce(c, F.lit("")) for c in ("enterprise_id", "permit_code", "pollutant_key", "scope")},
    })


def _valid() -> Column:
    return F.col("aggregation_eligible") & F.col("value_decimal").isNotNull()


def _tier() -> Column:
    return F.when(_valid(), F.when(F.col("report_type") == "month", 1).when(F.col("report_type") == "quarter", 2).otherwise(3))


def _candidates(records: DataFrame, keep: list[str]) -> DataFrame:
    """Narrow projection the aggregates run on."""
    keyed = with_group_key(records)
    only_valid = lambda c: F.when(_valid(), c)
    return keyed.select(
        *GROUP_KEY, *keep, _tier().alias("tier"),
        only_valid(first_filled("report_id", "source_url", "source_row_report_id", F.lit(UNIDENTIFIED))).alias("document"),
        only_valid(F.col("value_id")).alias("value_id"), only_valid(F.col("value")).alias("value"),
        only_valid(F.col("value_digits")).alias("digits"), only_valid(F.col("value_exp")).alias("exp"),
        only_valid(F.col("value_scale")).alias("scale"),
        # A row is identified by two independent hashes of its pointer (96 bits).
        only_valid(F.xxhash64("row_json_pointer")).alias("row_id1"), only_valid(F.hash("row_json_pointer")).alias("row_id2"),
    )


def _by_document(candidates: DataFrame, keys: list[str]) -> DataFrame:
    both = lambda c: [F.min(c).alias(f"{c}_lo"), F.max(c).alias(f"{c}_hi")]
    documents = candidates.groupBy(*keys, "tier", "document").agg(
        F.count(F.lit(1)).alias("n"), *[a for c in _RANGES for a in both(c)],
        F.max("digits").alias("digits"), F.max("exp").alias("exp"), F.max("scale").alias("scale"))
    duplicate = (F.col("row_id1_lo") != F.col("row_id1_hi")) | (F.col("row_id2_lo") != F.col("row_id2_hi"))
    return documents.withColumn("duplicate", F.coalesce(duplicate, F.lit(False)))


def _pool(suffix: str, member: Column) -> list[Column]:
    """Aggregates over one pool of documents."""
    of = lambda c: F.when(member, F.col(c))
    return [
        F.min(of("value_id_lo")).alias(f"id_lo{suffix}"), F.max(of("value_id_hi")).alias(f"id_hi{suffix}"),
        F.min(of("value_lo")).alias(f"v_lo{suffix}"), F.max(of("value_hi")).alias(f"v_hi{suffix}"),
        F.coalesce(F.max(of("duplicate")), F.lit(False)).alias(f"dup{suffix}"),
        F.coalesce(F.sum(of("n")), F.lit(0)).alias(f"n{suffix}"),
        F.max(of("digits")).alias(f"digits{suffix}"), F.max(of("exp")).alias(f"exp{suffix}"),
        F.max(of("scale")).alias(f"scale{suffix}"),
    ]


def _differs(suffix: str) -> Column:
    return F.coalesce((F.col(f"id_lo{suffix}") != F.col(f"id_hi{suffix}")) | (F.col(f"v_lo{suffix}") != F.col(f"v_hi{suffix}")),
                      F.lit(False))


def _verdict(df: DataFrame, suffix_of: Column | None) -> DataFrame:
    """Status, value and reasons. ``suffix_of`` picks the winning tier (1 or 2), or None when
    all valid rows form one pool (suffix '')."""
    def pick(name: str) -> Column:
        if suffix_of is None:
            return F.col(name)
        return F.when(suffix_of == 1, F.col(f"{name}1")).when(suffix_of == 2, F.col(f"{name}2"))

    if suffix_of is None:
        differs, duplicate, pool = _differs(""), F.col("dup"), F.col("n_valid")
        anything_else = F.lit(False)
    else:
        differs = F.coalesce(F.when(suffix_of == 1, _differs("1")).when(suffix_of == 2, _differs("2")), F.lit(False))
        duplicate = F.coalesce(pick("dup"), F.lit(False))
        pool = F.coalesce(pick("n"), F.lit(0))
        anything_else = _differs("")
    step = df.withColumns({"_differs": differs, "_duplicate": duplicate, "source_count": pool.cast("bigint")})
    selected = (F.col("source_count") > 0) & ~F.col("_differs") & ~F.col("_duplicate")
    step = step.withColumn("status", F.when(selected, "selected").when(F.col("_differs") | F.col("_duplicate"), "conflict")
                           .when(F.col("candidate_count") > 0, "ineligible").otherwise("missing"))
    step = step.withColumns({
        "value": F.when(selected, pick("v_lo")),
        "value_digits": F.when(selected, pick("digits")), "value_exp": F.when(selected, pick("exp")),
        "value_scale": F.when(selected, pick("scale")),
        "conflict_reasons": F.array_compact(F.array(
            F.when(F.col("_differs"), "same_priority_value_conflict"), F.when(F.col("_duplicate"), "duplicate_scope_rows"))),
        "lower_priority_disagreement": selected & anything_else,
    })
    return with_rebuilt_text(step, "value_decimal")


_MONTH = ("struct<period:string,status:string,value:double,value_decimal:string,value_digits:decimal(38,0),"
          "value_exp:int,value_scale:int,selected_priority:string,conflict_reasons:array<string>,"
          "lower_priority_disagreement:boolean,candidate_count:bigint,source_count:bigint>")
_MONTH_FIELDS = [f.split(":")[0] for f in (
    "period status value value_decimal value_digits value_exp value_scale selected_priority conflict_reasons "
    "lower_priority_disagreement candidate_count source_count").split()]


def _with_long_numbers() -> str:
    """SQL: ``found`` with the whole text of selected values whose digits are listed in ``_wides``."""
    same = ("w.slot = (cast(left(m.period, 4) as int) * 12 + cast(right(m.period, 2) as int)) * 2"
            " + if(m.selected_priority = 'month', 0, 1)")
    text = wide_text_sql("w.wide", "m.value_exp", "m.value_scale")
    whole = f"if(m.status = 'selected', get(transform(filter(_wides, w -> {same}), w -> {text}), 0), null)"
    fields = ", ".join(f"'{f}', " + (f"coalesce({whole}, m.{f})" if f == "value_decimal" else f"m.{f}") for f in _MONTH_FIELDS)
    return f"if(size(_wides) = 0, found, transform(found, m -> named_struct({fields})))"


_WITH_LONG_NUMBERS = _with_long_numbers()


def _months_of_groups(requested: DataFrame, selection: TimeSelection) -> DataFrame:
    """(group, period): one resolved entry for every month that has a candidate."""
    periodic = with_row_periods(requested.where(F.col("period_kind") == "month"))
    periodic = periodic.where(F.size("periods") == 1).withColumn("period", F.col("periods")[0])
    periodic = periodic.where(F.col("period").isin(*selection.periods))
    documents = _by_document(_candidates(periodic, ["period"]), [*GROUP_KEY, "period"])
    tier = F.col("tier")
    months = documents.groupBy(*GROUP_KEY, "period").agg(
        F.sum("n").alias("candidate_count"), F.min("tier").alias("_best"),
        *_pool("1", tier == 1), *_pool("2", tier == 2), *_pool("", tier.isNotNull()))
    resolved = _verdict(months, F.col("_best"))
    priority = F.when(F.col("status") == "selected", F.when(F.col("_best") == 1, "month").otherwise("quarter"))
    return resolved.withColumn("selected_priority", priority)


def _descriptions(requested: DataFrame, extra: list[str], slot: Column) -> DataFrame:
    """Distinct descriptions of each group with the first year they are reported in, and apart from them the valid values that
    have more digits than ``value_digits`` holds: ``wide``, and the place ``slot`` says they compete for (NULL: none).

    A hash aggregate that merges nearly everything map-side, so little of it is shuffled.
    """
    keyed = with_group_key(requested).withColumn("wide", F.when(_valid() & slot.isNotNull(), wide_digits("value_decimal")))
    keyed = keyed.withColumn("slot", F.when(F.col("wide").isNotNull(), slot))
    return keyed.groupBy(*GROUP_KEY, *extra, *DESCRIPTION, "slot", "wide").agg(F.coalesce(F.min("year"), F.lit(9999)).alias("first_year"))


def _month_slot() -> Column:
    """A month and, of its two tiers, the one a record competes in."""
    tier = F.when(F.col("report_type") == "month", 0).when(F.col("report_type") == "quarter", 1)
    return F.when(F.col("period_kind") == "month", (F.col("year") * 12 + F.col("month")) * 2 + tier)


_D = "struct<first_year:int," + ",".join(f"{c}:string" for c in DESCRIPTION) + ">"


def _described() -> Column:
    return F.struct("first_year", *DESCRIPTION).cast(_D).alias("d")


def _undescribed() -> Column:
    return F.lit(None).cast(_D).alias("d")


def summarize_period(records: DataFrame, selection: TimeSelection) -> DataFrame:
    """One row per group: resolved months, totals, missing and conflicting months.

    ``period_total`` is given only if every requested month is selected and the request
    consists of whole months; ``covered_full_months_total`` only needs the former.
    """
    requested = requested_rows(records, selection)
    months = _months_of_groups(requested, selection).select(
        *GROUP_KEY, F.struct(*_MONTH_FIELDS).cast(_MONTH).alias("m"), _undescribed())
    # Several long numbers of a month and tier are a conflict: only a single one is kept.
    described = _descriptions(requested, [], _month_slot()).withColumn("d", _described()).groupBy(*GROUP_KEY, "slot").agg(
        F.min("d").alias("d"), F.min("wide").alias("wide"), F.max("wide").alias("_other"))
    described = described.select(*GROUP_KEY, "d", F.when(F.col("wide") == F.col("_other"), F.struct("slot", "wide")).alias("w"))
    groups = months.unionByName(described, allowMissingColumns=True).groupBy(*GROUP_KEY).agg(
        F.min("d").alias("d"),
        # At most one entry per requested month and two long numbers, so the lists are bounded by the request.
        F.collect_list("m").alias("found"), F.collect_list("w").alias("_wides"))
    groups = groups.withColumn("found", F.expr(_WITH_LONG_NUMBERS))
    missing = ("named_struct('period', p, 'status', 'missing', 'value', cast(null as double), 'value_decimal', cast(null as string),"
               " 'value_digits', cast(null as decimal(38,0)), 'value_exp', cast(null as int), 'value_scale', cast(null as int),"
               " 'selected_priority', cast(null as string), 'conflict_reasons', cast(array() as array<string>),"
               " 'lower_priority_disagreement', false, 'candidate_count', 0L, 'source_count', 0L)")
    step = groups.withColumn("requested_periods", selection.array())
    step = step.withColumn("_by_period", F.expr("map_from_arrays(transform(found, m -> m.period), found)"))
    step = step.withColumn("months", F.expr(
        f"transform(requested_periods, p -> coalesce(try_element_at(_by_period, p), {missing}))"))
    step = step.withColumns({
        "month_coverage_complete": F.forall("months", lambda m: m["status"] == "selected"),
        "missing_periods": F.expr("transform(filter(months, m -> m.status in ('missing', 'ineligible')), m -> m.period)"),
        "conflict_periods": F.expr("transform(filter(months, m -> m.status = 'conflict'), m -> m.period)"),
        "_values": F.expr("transform(months, m -> named_struct('digits', m.value_digits, 'exp', m.value_exp,"
                          " 'scale', m.value_scale, 'text', m.value_decimal))"),
    })
    whole = F.lit(selection.whole_months)
    step = step.withColumn("complete", F.col("month_coverage_complete") & whole)
    step = step.withColumn("status", F.when(F.col("complete"), "complete").when(F.size("conflict_periods") > 0, "conflict")
                           .when(~whole, "granularity_mismatch").otherwise("incomplete"))
    step = with_decimal_sum(step, "_values", F.col("month_coverage_complete"), "_total")
    step = step.withColumns({
        "requested_start": F.lit(selection.requested_start).cast("string"),
        "requested_end": F.lit(selection.requested_end).cast("string"),
        "covered_full_months_total": F.col("_total").cast("double"),
        "period_total_decimal": F.when(F.col("complete"), F.col("_total")),
        "period_total": F.when(F.col("complete"), F.col("_total").cast("double")),
        "lower_priority_disagreement": F.exists("months", lambda m: m["lower_priority_disagreement"]),
    })
    return step.select(*_group_columns(), "requested_periods", "requested_start", "requested_end", "months",
                       "month_coverage_complete", "complete", "status", "period_total", "period_total_decimal",
                       "covered_full_months_total", "missing_periods", "conflict_periods", "lower_priority_disagreement")


def _group_columns() -> list[Column]:
    return [*[F.col(c) for c in GROUP_KEY[:5]], F.nullif("unit_key", F.lit("")).alias("unit"),
            *[F.col("d")[c].alias(c) for c in DESCRIPTION]]


def resolve_months(records: DataFrame, selection: TimeSelection) -> DataFrame:
    """One row per group and requested month, gaps included."""
    return months_of(summarize_period(records, selection))


def months_of(summary: DataFrame) -> DataFrame:
    """The resolved months of :func:`summarize_period` in long form."""
    keys = [*GROUP_KEY[:5], "unit"]
    long = summary.select(*keys, F.explode("months").alias("m")).select(*keys, "m.*")
    return long.withColumns({"year": F.substring("period", 1, 4).cast("int"), "month": F.substring("period", 6, 2).cast("int")}) \
        .drop("value_digits", "value_exp", "value_scale")


def summarize_native(records: DataFrame, selection: TimeSelection) -> DataFrame:
    """Reported quarter and year totals, resolved per group and covered period and kept apart
    from monthly sums. All valid rows of a group and period compete on equal terms."""
    native = with_row_periods(records.where(F.col("period_kind").isin("quarter", "year")))
    native = native.where(P.overlaps(F.col("periods"), selection.array()))
    native = native.withColumn("first_period", F.col("periods")[0])
    keys = [*GROUP_KEY, "period_kind", "first_period"]
    documents = _by_document(_candidates(native, ["period_kind", "first_period"]), keys)
    totals = documents.groupBy(*keys).agg(
        F.sum("n").alias("candidate_count"), F.sum(F.when(F.col("tier").isNotNull(), F.col("n"))).alias("_n"),
        *_pool("", F.col("tier").isNotNull()))
    totals = _verdict(totals.withColumn("n_valid", F.coalesce("_n", F.lit(0))), None)
    fields = ["status", "value", "value_decimal", "conflict_reasons", "candidate_count", "source_count"]
    described = _descriptions(native, ["period_kind", "first_period"], F.lit(0))
    resolved = [*fields, "value_exp", "value_scale"]
    united = totals.select(*keys, *resolved, _undescribed()).unionByName(
        described.select(*keys, _described(), "wide"), allowMissingColumns=True)
    # One row of either kind per key: the maximum merely skips the NULLs of the other.
    merged = united.groupBy(*keys).agg(F.min("d").alias("d"), F.max("wide").alias("wide"), *[F.max(f).alias(f) for f in resolved])
    merged = merged.withColumn("value_decimal", F.expr(
        f"if(status = 'selected' and wide is not null, {wide_text_sql('wide', 'value_exp', 'value_scale')}, value_decimal)"))
    year, start = F.substring("first_period", 1, 4).cast("int"), F.substring("first_period", 6, 2).cast("int")
    covered = P.months_of(year, start, F.when(F.col("period_kind") == "quarter", start + 2).otherwise(12))
    merged = merged.withColumns({"covered_periods": covered, "_requested": selection.array()})
    whole = F.lit(selection.whole_months)
    return merged.select(
        *_group_columns(), "period_kind", "covered_periods", *fields,
        F.when(F.col("status") == "selected", F.col("period_kind")).alias("selected_priority"),
        (whole & P.within(F.col("covered_periods"), F.col("_requested"))).alias("fully_within_requested_months"),
        (whole & P.same_months(F.col("covered_periods"), F.col("_requested"))).alias("exactly_matches_request"),
        F.lit(NATIVE_RULE).alias("aggregation_rule"))


LINEAGE_COLUMNS = [
    "report_id", "report_type", "report_submit_time", "source_url", "json_pointer", "row_json_pointer", "row_id", "field",
    "value_raw", "value", "value_decimal", "value_status", "unit", "unit_raw", "unit_source", "unit_status",
    "aggregation_eligible", "identity_conflicts", "pollutant_identity_conflict", "schema_warnings",
]


def lineage(records: DataFrame, selection: TimeSelection) -> DataFrame:
    """Every monthly candidate with its group, month and whether it is a selected source.

    The join partner has one row per group and month; a group that dominates the records is
    split by the adaptive skew join, since nothing above the join needs its partitioning.
    """
    periodic = with_row_periods(requested_rows(records, selection).where(F.col("period_kind") == "month"))
    periodic = with_group_key(periodic.where(F.size("periods") == 1)).withColumn("period", F.col("periods")[0])
    chosen = resolve_months(records, selection).where(F.col("status") == "selected").select(
        *GROUP_KEY[:5], F.coalesce("unit", F.lit("")).alias("unit_key"), "period", "selected_priority")
    joined = periodic.join(chosen, [*GROUP_KEY, "period"], "left")
    selected = F.col("aggregation_eligible") & F.col("value_decimal").isNotNull() \
        & (F.col("report_type") == F.col("selected_priority"))
    return joined.select(*GROUP_KEY[:5], "unit_key", "period", *LINEAGE_COLUMNS,
                         F.coalesce(selected, F.lit(False)).alias("selected"))


def selected_sources(candidates: DataFrame) -> DataFrame:
    """Selected lineage with exact repeats of one source (same report, URL, pointer and value)
    counted once. All agreeing sources stay."""
    return candidates.where("selected").dropDuplicates(
        [*GROUP_KEY, "period", "report_id", "source_url", "json_pointer", "value_decimal"])
