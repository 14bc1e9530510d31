"""Shared pieces of the registered queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from periodledger.operators.timeselect import select_time

QUARTER = select_time(start="1997-04", end="1997-06")
PARTIAL = select_time(start="1997-04-15", end="1997-06-20")
CROSS_YEAR = select_time(periods=["1998-11", "1998-12", "1999-01"])
ONE_YEAR = select_time(years=[1997])
GROUP = ["enterprise_id", "permit_code", "pollutant_key", "scope", "outlet_key", "unit"]


def joined(array: str) -> Column:
    """An array as text, so that results compare as plain values."""
    return F.array_join(array, ",").alias(array)


def text(number: Column | str) -> Column:
    return (F.col(number) if isinstance(number, str) else number).cast("string")


def pick(options: list, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), (index + 1).cast("int"))


def sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"
