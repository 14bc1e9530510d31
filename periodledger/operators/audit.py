"""Readback of a finished run against the stored report bodies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodledger.functions.hashing import canonical_row, content_hash
from periodledger.functions.numbers import fence, with_decimal_sum
from periodledger.operators import resolve
from periodledger.operators.compare import multiset_difference
from periodledger.operators.flatten import flatten_reports
from periodledger.operators.timeselect import TimeSelection, partition_kinds, requested_rows
from periodledger.sources.scratch import materialize

REPORT = ["permit_code", "report_id"]


def _problems(df: DataFrame, kind: Column | str, key: Column) -> DataFrame:
    return df.select((kind if isinstance(kind, Column) else F.lit(kind)).alias("kind"), key.cast("string").alias("key"))


def check_bodies(manifest: DataFrame, stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Problems of downloaded reports (missing or repeated body, hash, identity), and the
    reports with exactly one body. Bodies are reduced to a hash before anything is shuffled."""
    body_permit = F.get_json_object("body", "$.companyInfo.permitCode")
    facts = stored.select(*REPORT, content_hash(F.col("body")).alias("sha"), body_permit.alias("body_permit"))
    facts = facts.groupBy(*REPORT).agg(F.count(F.lit(1)).alias("copies"), F.max("sha").alias("sha"), F.max("body_permit").alias("body_permit"))
    downloaded = manifest.where(F.col("status") == "downloaded").select(*REPORT, "air_sha256")
    checked = downloaded.join(facts, REPORT, "left")
    single = F.coalesce(F.col("copies") == 1, F.lit(False))
    kinds = F.array_compact(F.array(
        F.when(~single, "report_cache_missing_or_duplicate"),
        F.when(single & ~F.col("sha").eqNullSafe(F.col("air_sha256")), "air_hash"),
        F.when(single & ~F.col("body_permit").eqNullSafe(F.col("permit_code")), "identity")))
    problems = checked.select(F.explode(kinds).alias("kind"), F.col("report_id").alias("key"))
    return problems, checked.where(single).select(*REPORT).distinct()


def check_readback(records: DataFrame, reparsed: DataFrame, bodies: DataFrame) -> DataFrame:
    """Stored records against the rows their pointers lead to.

    A join on the pointer, which is unique within a report; raw rows are compared by hash so
    that only hashes are shuffled.
    """
    mine = records.select(*REPORT, "json_pointer", "row_json_pointer", "field_present", "value_raw",
                          F.sha2("raw_row", 256).alias("raw_hash"))
    source = reparsed.select(*REPORT, "json_pointer", F.col("row_json_pointer").alias("_row"), F.col("field_present").alias("_present"),
                             F.col("value_raw").alias("_value"), F.sha2("raw_row", 256).alias("_hash"))
    held = bodies.withColumn("_held", F.lit(True))
    joined = mine.join(source, [*REPORT, "json_pointer"], "left").join(held, REPORT, "left")
    found = F.col("_row").eqNullSafe(F.col("row_json_pointer"))
    unresolved = ~found | (F.col("field_present") & ~F.coalesce("_present", F.lit(False)))
    kinds = F.when(F.col("_held").isNull(), F.array(F.lit("row_no_body"))).otherwise(F.array_compact(F.array(
        F.when(unresolved, "pointer"),
        F.when(found & ~F.col("_hash").eqNullSafe(F.col("raw_hash")), "raw_row"),
        F.when(~unresolved & F.col("field_present") & ~F.col("_value").eqNullSafe(F.col("value_raw")), "raw_value"))))
    key = F.concat_ws("|", *REPORT, "json_pointer")
    return joined.select(F.explode(kinds).alias("kind"), key.alias("key"))


def check_totals(summary: DataFrame, selection: TimeSelection) -> DataFrame:
    """Complete groups must be complete and add up; others must not show a total."""
    periods = F.transform("months", lambda m: m["period"])
    whole = (periods == selection.array()) & F.forall("months", lambda m: m["status"] == "selected") & F.lit(selection.whole_months)
    values = F.expr("transform(months, m -> named_struct('digits', m.value_digits, 'exp', m.value_exp,"
                    " 'scale', m.value_scale, 'text', m.value_decimal))")
    step = summary.withColumns({"_all_months": whole, "_values": values})
    step = with_decimal_sum(step, "_values", F.col("_all_months"), "_sum")
    amount = lambda c: F.col(c).try_cast("decimal(38,18)")
    exact = F.coalesce(amount("_sum") == amount("period_total_decimal"),
                       F.col("_sum").cast("double") == F.col("period_total_decimal").cast("double"), F.lit(False))
    shown = F.coalesce(F.col("period_total") == F.col("period_total_decimal").cast("double"), F.lit(False))
    kind = (
        F.when(~F.col("complete"), F.when(F.col("period_total").isNotNull(), "incomplete_nonnull_total"))
        .when(~F.col("_all_months"), "months").when(~exact | ~shown, "total_arithmetic")
    )
    key = F.concat_ws("|", "enterprise_id", "permit_code", "pollutant_key", "scope", "outlet_key", F.coalesce("unit", F.lit("")))
    judged = fence(step.withColumns({"kind": kind, "key": key}), ["kind", "key"], [])
    return judged.where(F.col("kind").isNotNull())


def check_equal(left: DataFrame, right: DataFrame, kind: str, key: str = "") -> DataFrame:
    """One problem row when two tables are not the same multiset of rows."""
    right = right.select(*left.columns)
    differing = multiset_difference(left, right).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 0)
    return _problems(differing, kind, F.lit(key))


def check_records(records: DataFrame, reparsed: DataFrame, monthly: DataFrame, native_rows: DataFrame) -> DataFrame:
    """The record tables against the reparsed bodies and against each other.

    All three comparisons share one aggregation over row hashes: each row counts for the
    tables it was read from, and each comparison is a difference of two counts.
    """
    tables = {"records": records, "reparsed": reparsed, "monthly": monthly, "native": native_rows}
    columns, hashed = records.columns, None
    for name, table in tables.items():
        table = table.select(*columns)
        marks = [F.lit(1 if name == other else 0).cast("bigint").alias(other) for other in tables]
        part = table.select(content_hash(canonical_row(table)).alias("row_hash"), "period_kind", *marks)
        hashed = part if hashed is None else hashed.unionByName(part)
    counts = hashed.groupBy("row_hash", "period_kind").agg(*[F.sum(name).alias(name) for name in tables])
    kind = F.col("period_kind")
    of = lambda kinds: F.when(kind.isin(kinds), F.col("records")).otherwise(0)
    differing = counts.agg(
        F.count_if(F.col("records") != F.col("reparsed")).alias("a"), F.count_if(F.col("monthly") != of(["month"])).alias("b"),
        F.count_if(F.col("native") != of(["quarter", "year"])).alias("c"))
    found = [("a", "records_differ_from_reparsed_sources", ""), ("b", "record_partition_mismatch", "air_monthly_rows"),
             ("c", "record_partition_mismatch", "air_native_period_rows")]
    rows = F.array_compact(F.array(*[F.when(F.col(c) > 0, F.struct(F.lit(k).alias("kind"), F.lit(t).alias("key"))) for c, k, t in found]))
    return differing.select(F.inline(rows))


def verify_run(*, manifest: DataFrame, stored: DataFrame, records: DataFrame, monthly: DataFrame, native_rows: DataFrame,
               summary: DataFrame, native: DataFrame, selection: TimeSelection) -> tuple[DataFrame, DataFrame]:
    """Problems (``kind, key``) and the one-row result. A run passes when there are none.

    ``stored`` holds ``permit_code, report_id, body, meta, enterprise``. The bodies are parsed
    once; the reparsed records are written to the shared scratch folder and read from there.
    """
    body_problems, bodies = check_bodies(manifest, stored)
    bodies = materialize(bodies, "bodies")
    # Bodies to leave out are few. Written first, their size is known, so they are broadcast
    # when small and the bodies themselves are not shuffled.
    unsound = materialize(stored.select(*REPORT).distinct().join(bodies, REPORT, "left_anti"), "unsound")
    sound = stored.join(unsound, REPORT, "left_anti").select("body", "meta", "enterprise")
    reparsed = materialize(requested_rows(flatten_reports(sound, selection=selection), selection), "reparsed")
    problems = body_problems
    for part in (
        check_readback(records, reparsed, bodies),
        check_totals(summary, selection),
        check_records(records, reparsed, monthly, native_rows),
        check_equal(summary, resolve.summarize_period(records, selection), "period_summary_recompute_mismatch"),
        check_equal(native, resolve.summarize_native(partition_kinds(records)[1], selection), "native_period_summary_recompute_mismatch"),
    ):
        problems = problems.unionByName(part)
    problems = materialize(problems, "problems")
    n = F.count(F.lit(1))
    result = bodies.agg(n.alias("report_files_checked")).crossJoin(records.agg(n.alias("air_rows_read_back"))) \
        .crossJoin(summary.agg(n.alias("period_groups_checked"), F.count_if("complete").alias("complete_period_groups_checked"))) \
        .crossJoin(native.agg(n.alias("native_period_groups_checked"))).crossJoin(problems.agg(n.alias("problems")))
    return problems, result.withColumns({
        "passed": F.col("problems") == 0, "nonempty_evidence": F.col("report_files_checked") > 0})
