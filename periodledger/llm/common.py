"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the word rules: white space of [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """The ``[^\\x20\\x09-\\x0D]+`` words of a text, an empty list for null."""
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(F.length(bare) > 0, F.split(bare, BLANK_RUN)).otherwise(F.array().cast("array<string>"))


def row_key(*columns: str) -> Column:
    """64-bit identity of a row: rows with equal values share it."""
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\x00null")) for c in columns])


def crc_fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``. A null id counts as the empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds).cast("int")


def fresh(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns an operator is about to add: its results replace columns of the same name."""
    return df.drop(*names)


def add_in_arrow(df: DataFrame, ddl: str, make: Callable[[pa.RecordBatch], list[pa.Array]], replace: tuple[str, ...] = (), rows: int = 1 << 30) -> DataFrame:
    """``df`` plus the columns of ``ddl``, made batch by batch, at most ``rows`` rows at a time. Existing columns of those names are
    replaced; columns named in ``replace`` are the leading results of ``make`` and keep their place."""
    added = T.StructType.fromDDL(ddl)
    df = fresh(df, *added.names)
    schema = T.StructType(df.schema.fields + added.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(i, rows) for whole in batches for i in range(0, max(whole.num_rows, 1), rows)):
            made = make(batch)
            columns = list(batch.columns)
            for name, values in zip(replace, made):
                columns[batch.schema.names.index(name)] = values
            yield pa.RecordBatch.from_arrays(columns + made[len(replace):], names=schema.names)

    return df.mapInArrow(run, schema)


_held: dict[str, Any] = {}


def held(name: str, make: Callable[[], Any]) -> Any:
    """What a Python worker keeps from task to task under a name. It keeps one thing at a time: workers are used again by
    whatever runs next on their executor, so what the operator before kept goes first."""
    if name not in _held:
        let_go()
        _held[name] = make()
    return _held[name]


def let_go() -> None:
    """Frees what an operator that ran here before still keeps."""
    if _held:
        _held.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # GNU C library: freed memory goes back to the system
    if trim is not None:
        trim(0)


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner drop shuffle files of finished steps now instead of at some later collection."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
