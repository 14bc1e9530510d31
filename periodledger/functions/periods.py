"""Reporting periods: classification of period text and expansion to months.

A month is the text ``YYYY-MM`` throughout; it sorts and compares as it should.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from periodledger import vocab
from periodledger.functions.numbers import ascii_digits

NO_PERIODS = "cast(array() as array<string>)"


def _number(text: Column, pattern: str) -> Column:
    """The number found, in digits of any script; NULL when there is none or it cannot be read."""
    found = F.regexp_extract(text, "(?U)" + pattern, 1)
    return ascii_digits(F.nullif(found, F.lit(""))).try_cast("int")


def text_year(text: Column) -> Column:
    return _number(text, vocab.YEAR_PATTERN)


def text_month(text: Column) -> Column:
    """Month number as written; may exceed 12."""
    return _number(text, vocab.MONTH_PATTERN)


def text_quarter(text: Column) -> Column:
    return _number(text, vocab.QUARTER_PATTERN)


def month_label(year: Column, month: Column) -> Column:
    return F.concat(F.lpad(year.cast("string"), 4, "0"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))


def months_of(year: Column, first: Column, last: Column) -> Column:
    """Labels of the months ``first`` to ``last`` of one year."""
    return F.transform(F.sequence(first, last), lambda m: month_label(year, m))


def covered_periods(year: Column, kind: Column, month: Column, quarter: Column) -> Column:
    """Months a record covers: one, three or twelve, or none when its period is not known."""
    return (
        F.when(year.isNull(), F.expr(NO_PERIODS))
        .when((kind == "month") & month.between(1, 12), F.array(month_label(year, month)))
        .when((kind == "quarter") & quarter.between(1, 4), months_of(year, quarter * 3 - 2, quarter * 3))
        .when(kind == "year", months_of(year, F.lit(1), F.lit(12)))
        .otherwise(F.expr(NO_PERIODS))
    )


def month_grid(years: Column, months: Column) -> Column:
    """Every combination of the given years and months, sorted and without repeats."""
    grid = F.transform(years, lambda y: F.transform(months, lambda m: month_label(y, m)))
    return F.array_sort(F.array_distinct(F.flatten(grid)))


def month_range(start: Column, end: Column) -> Column:
    """Months touched by the inclusive range of two dates; none when it is empty."""
    first = F.trunc(start, "MM")
    days = F.sequence(first, end, F.expr("interval 1 month"))
    labels = F.transform(days, lambda d: F.date_format(d, "yyyy-MM"))
    return F.when(start <= end, labels).otherwise(F.expr(NO_PERIODS))


def bound_date(text: Column, end: bool = False) -> Column:
    """Date of a ``YYYY-MM`` or ``YYYY-MM-DD`` bound, NULL when there is no such day; an end
    without day is the month end."""
    day = F.rpad(text, 10, "-01").try_cast("date")
    return F.when(F.lit(end) & (F.length(text) == 7), F.last_day(day)).otherwise(day)


def is_whole_months(start: Column, end: Column) -> Column:
    return (F.dayofmonth(start) == 1) & (end == F.last_day(end))


def explicit_months(labels: Column) -> Column:
    return F.array_sort(F.array_distinct(labels))


def overlaps(periods: Column, requested: Column) -> Column:
    return F.arrays_overlap(periods, requested)


def within(periods: Column, requested: Column) -> Column:
    return F.size(F.array_except(periods, requested)) == 0


def same_months(left: Column, right: Column) -> Column:
    return F.array_sort(F.array_distinct(left)) == F.array_sort(F.array_distinct(right))
