"""Requested periods: one validated request, or a whole table of requests."""

from __future__ import annotations

import datetime as dt
import re
from calendar import monthrange
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from periodledger import vocab
from periodledger.functions import periods as P
from periodledger.functions.text import clean_text

FIRST_YEAR, LAST_YEAR = 1900, 2099
SUM_RULE = "A total adds the months asked for, each whole and resolved; longer filings take no part in it."


@dataclass(frozen=True)
class TimeSelection:
    """One request. Its months (2,400 at the most) enter plans as a literal array, so they
    are pushed into scans and never need a join."""

    mode: str
    periods: tuple[str, ...]
    requested_start: str | None
    requested_end: str | None
    whole_months: bool
    aggregation_rule: str = SUM_RULE

    @property
    def years(self) -> tuple[int, ...]:
        return tuple(sorted({int(p[:4]) for p in self.periods}))

    def array(self) -> Column:
        return F.array(*[F.lit(p) for p in self.periods])

    def to_df(self, spark: SparkSession) -> DataFrame:
        row = (self.mode, list(self.periods), list(self.years), self.requested_start,
               self.requested_end, self.whole_months, self.aggregation_rule)
        return spark.createDataFrame(
            [row], "mode string, periods array<string>, years array<int>, requested_start string,"
                   " requested_end string, whole_months boolean, aggregation_rule string")

    def periods_df(self, spark: SparkSession) -> DataFrame:
        return self.to_df(spark).select(F.posexplode("periods").alias("ord", "period"))


def _is_int(value, low: int, high: int) -> bool:
    return type(value) is int and low <= value <= high


def _bound(text, closing: bool) -> dt.date:
    if not isinstance(text, str) or not re.fullmatch(r"\d{4}-\d{2}(-\d{2})?", text):
        raise ValueError(f"a bound is YYYY-MM or YYYY-MM-DD, not {text!r}")
    if len(text) == 10:
        return dt.date.fromisoformat(text)
    first = dt.date.fromisoformat(text + "-01")
    return first.replace(day=monthrange(first.year, first.month)[1]) if closing else first


def _range_labels(first: dt.date, last: dt.date) -> list[str]:
    index = range(first.year * 12 + first.month - 1, last.year * 12 + last.month)
    return [f"{i // 12:04d}-{i % 12 + 1:02d}" for i in index]


def select_time(*, years=None, months=None, start=None, end=None, periods=None) -> TimeSelection:
    """Validate a request given as years (and months), as an inclusive range or as months.

    There is no default: exactly one of the three ways must be used.
    """
    ways = [bool(years), bool(periods), bool(start or end)]
    if sum(ways) != 1:
        raise ValueError("give exactly one of years, periods, or start with end")
    if months is not None and not years:
        raise ValueError("months needs years")
    first = last = None
    whole = True
    if years:
        wanted = list(range(1, 13)) if months is None else list(months)
        if not all(_is_int(y, FIRST_YEAR, LAST_YEAR) for y in years):
            raise ValueError(f"years are integers from {FIRST_YEAR} to {LAST_YEAR}")
        if not wanted or not all(_is_int(m, 1, 12) for m in wanted):
            raise ValueError("months are integers from 1 to 12")
        mode, labels = "years_months", {f"{y:04d}-{m:02d}" for y in years for m in wanted}
    elif periods:
        if not all(isinstance(p, str) and len(p) == 7 for p in periods):
            raise ValueError("periods are YYYY-MM")
        mode, labels = "explicit_months", {_bound(p, False).strftime("%Y-%m") for p in periods}
    else:
        if not (start and end):
            raise ValueError("start and end belong together")
        first, last = _bound(start, False), _bound(end, True)
        if first > last:
            raise ValueError("start lies after end")
        whole = first.day == 1 and (last + dt.timedelta(days=1)).day == 1
        mode, labels = "date_range", set(_range_labels(first, last))
    if not all(FIRST_YEAR <= int(p[:4]) <= LAST_YEAR for p in labels):
        raise ValueError(f"requested months lie in {FIRST_YEAR} to {LAST_YEAR}")
    return TimeSelection(mode, tuple(sorted(labels)), first and first.isoformat(),
                         last and last.isoformat(), whole)


def expand_requests(requests: DataFrame) -> DataFrame:
    """Resolve a table of requests; adds ``mode``, ``periods`` and ``whole_months``.

    Columns (each may be NULL): ``years array<int>``, ``months array<int>``, ``start string``,
    ``end string``, ``explicit array<string>``. A row using none or several ways, or a range
    in the wrong order, has mode ``invalid`` and no periods. The same rules as in
    :func:`select_time`, but over data; map-side only.
    """
    filled = lambda c: F.coalesce(F.size(c) > 0, F.lit(False))
    has_range = F.col("start").isNotNull() | F.col("end").isNotNull()
    ways = filled("years").cast("int") + filled("explicit").cast("int") + has_range.cast("int")
    shape = r"^[0-9]{4}-(0[1-9]|1[0-2])(-[0-9]{2})?$"
    first = F.when(F.col("start").rlike(shape), P.bound_date(F.col("start")))
    last = F.when(F.col("end").rlike(shape), P.bound_date(F.col("end"), end=True))
    months = F.coalesce(F.col("months"), F.sequence(F.lit(1), F.lit(12)))
    bad_years = F.exists("years", lambda y: ~y.between(FIRST_YEAR, LAST_YEAR))
    bad_months = (F.size(months) == 0) | F.exists(months, lambda m: ~m.between(1, 12))
    bad_labels = F.exists("explicit", lambda p: ~p.rlike(r"^(19|20)[0-9]{2}-(0[1-9]|1[0-2])$"))
    mode = (
        F.when((ways != 1) | (F.col("months").isNotNull() & ~filled("years")), "invalid")
        .when(filled("years"), F.when(bad_years | bad_months, "invalid").otherwise("years_months"))
        .when(filled("explicit"), F.when(bad_labels, "invalid").otherwise("explicit_months"))
        .when((first <= last) & (F.year(first) >= FIRST_YEAR) & (F.year(last) <= LAST_YEAR), "date_range")
        .otherwise("invalid")
    )
    found = (
        F.when(F.col("mode") == "years_months", P.month_grid(F.col("years"), months))
        .when(F.col("mode") == "explicit_months", P.explicit_months(F.col("explicit")))
        .when(F.col("mode") == "date_range", P.month_range(first, last))
        .otherwise(F.expr(P.NO_PERIODS))
    )
    whole = F.when(F.col("mode") == "date_range", P.is_whole_months(first, last)).when(
        F.col("mode") != "invalid", True)
    return requests.withColumn("mode", mode).withColumns({"periods": found, "whole_months": whole})


def with_report_period(index: DataFrame, *, time: str = "report_time", type: str = "type") -> DataFrame:
    """Classify index entries by their reported period text (month before quarter before year).

    Adds ``period_year``, ``period_kind``, ``periods`` and ``period_error`` (NULL when fine).
    Submission dates play no part. Nothing is dropped: callers stop on, or set aside, rows
    with an error (:func:`require_known_periods`).
    """
    step = index.withColumn("_time", clean_text(F.col(time)))
    step = step.withColumns({
        "_year": P.text_year(F.col("_time")),
        "_month": P.text_month(F.col("_time")),
        "_quarter": P.text_quarter(F.col("_time")),
        "_annual": F.col("_time").contains(vocab.ANNUAL_WORD)
        | F.coalesce(F.col(type).isin(vocab.ANNUAL_DECLARATIONS), F.lit(False)),
    })
    kind = (F.when(F.col("_month").isNotNull(), "month").when(F.col("_quarter").isNotNull(), "quarter")
            .when(F.col("_annual"), "year"))
    step = step.withColumns({
        "period_error": F.when(F.col("_year").isNull(), "unrecognized_year")
        .when(F.col("_month").isNotNull() & ~F.col("_month").between(1, 12), "invalid_month")
        .when(kind.isNull(), "unrecognized_period"),
    })
    ok = F.col("period_error").isNull()
    step = step.withColumns({"period_year": F.when(ok, F.col("_year")), "period_kind": F.when(ok, kind)})
    covered = P.covered_periods(F.col("period_year"), F.col("period_kind"), F.col("_month"), F.col("_quarter"))
    # The results pass through a one-row generator. Filters on them would otherwise be pushed
    # below this point with every expression above copied into them, many times over.
    result = F.struct("period_year", "period_kind", covered.alias("periods"), "period_error")
    return step.select(*index.columns, F.inline_outer(F.array(result)))


def require_known_periods(classified: DataFrame) -> DataFrame:
    """Strict reading: evaluating the result fails on the first unknown period."""
    bad = F.col("period_error").isNotNull()
    message = F.concat(F.lit("report period not understood: "), F.col("period_error"))
    return classified.where(F.when(bad, F.raise_error(message).cast("boolean")).otherwise(True))


def relevant_reports(classified: DataFrame, selection: TimeSelection, *, index_year: str | None = None) -> DataFrame:
    """Index entries whose months meet the request. With ``index_year``, an entry listed under
    another year than the one it reports is an error (``period_error``), never an omission.
    Entries stored by ``scan_year`` are read for the requested years only."""
    if index_year is not None:
        classified = with_index_clash(classified, index_year)
    classified = of_years(classified, selection)
    return classified.where(F.col("period_error").isNotNull() | P.overlaps(F.col("periods"), selection.array()))


def with_index_clash(classified: DataFrame, index_year: str) -> DataFrame:
    clash = F.col("period_year") != F.col(index_year)
    return classified.withColumn("period_error", F.coalesce(
        F.col("period_error"), F.when(clash, "period_differs_from_index_year")))


# --- storage by year -------------------------------------------------------------------
#
# A request is decided on a computed list of months, which no scan can use. Tables written with
# ``scan_year`` as their partition column carry the year in which a row can meet a request, NULL
# where the row must be looked at by every request. A condition on that plain column prunes folders.

SCAN_YEAR = "scan_year"


def with_scan_year(table: DataFrame) -> DataFrame:
    """``scan_year`` of classified index entries (those with ``period_error``) or of records. Covered months never cross a year."""
    if "period_error" in table.columns:
        return table.withColumn(SCAN_YEAR, F.when(F.col("period_error").isNull(), F.col("period_year")))
    known = with_row_periods(table)
    return known.withColumn(SCAN_YEAR, F.when(F.size("periods") > 0, F.col("year"))).drop("periods")


def of_years(table: DataFrame, selection: TimeSelection) -> DataFrame:
    """The rows a request has to look at; all rows of a table without ``scan_year``."""
    if SCAN_YEAR not in table.columns:
        return table
    return table.where(F.col(SCAN_YEAR).isin(*selection.years) | F.col(SCAN_YEAR).isNull())


def requested_by(records: DataFrame, requests: DataFrame) -> DataFrame:
    """Records that meet any request of an expanded table (:func:`expand_requests`), and those without a known period.

    The years of all requests, at most one row for each of the 200 years a request can name, prune the folders of a table stored by
    ``scan_year`` while the query runs.
    """
    wanted = requests.where(F.col("mode") != "invalid").select(F.explode("periods").alias("period")).distinct()
    years = F.broadcast(wanted.select(F.substring("period", 1, 4).cast("int").alias(SCAN_YEAR)).distinct())  # bounded by the calendar
    months = F.broadcast(wanted.agg(F.collect_set("period").alias("_wanted")))  # one row, at most 2,400 months
    known = with_row_periods(records.join(years, SCAN_YEAR, "left_semi")).crossJoin(months)
    met = known.where(P.overlaps(F.col("periods"), F.col("_wanted"))).select(records.columns)
    return met.unionByName(records.where(F.col(SCAN_YEAR).isNull()))


def with_row_periods(records: DataFrame) -> DataFrame:
    """Months covered by each extracted record, as ``periods``."""
    return records.withColumn("periods", P.covered_periods(
        F.col("year"), F.col("period_kind"), F.col("month"), F.col("report_quarter")))


def requested_rows(records: DataFrame, selection: TimeSelection) -> DataFrame:
    """Records that meet the request, and those without a known period (kept for audit). Records
    stored by ``scan_year`` are read for the requested years only."""
    kept = with_row_periods(of_years(records, selection))
    wanted = (F.size("periods") == 0) | P.overlaps(F.col("periods"), selection.array())
    return kept.where(wanted).drop("periods")


def partition_kinds(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Monthly records, and native quarter or year records; unknown kinds are in neither."""
    return (records.where(F.col("period_kind") == "month"),
            records.where(F.col("period_kind").isin("quarter", "year")))
