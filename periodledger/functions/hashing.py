"""Content hashes and canonical row text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def content_hash(content: Column) -> Column:
    return F.sha2(content, 256)


def _canonical_value(name: str, data_type: T.DataType) -> Column:
    column = F.col(name)
    if isinstance(data_type, T.MapType):
        return F.array_sort(F.map_entries(column)).alias(name)
    return column.alias(name)


def canonical_row(df: DataFrame, ignore: tuple[str, ...] = ()) -> Column:
    """Text of a row that does not depend on column or map-key order; keeps nulls."""
    fields = sorted((f for f in df.schema.fields if f.name not in ignore), key=lambda f: f.name)
    return F.to_json(F.struct(*[_canonical_value(f.name, f.dataType) for f in fields]), {"ignoreNullFields": "false"})
