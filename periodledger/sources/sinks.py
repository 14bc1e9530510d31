"""Table sinks, the output contract and idempotent ingest."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import groupby

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from periodledger.operators.timeselect import TimeSelection
from periodledger.sources.scratch import materialize

CONTRACT_VERSION = "1"
QUERY_FIELDS = ["mode", "province", "city", "county", "name", "permit"]
REPORT_IDENTITY = ["permit_code", "reportId", "provinceSharding", "yearSharding"]


class ContractMismatch(ValueError):
    """The output belongs to another request."""


def write_table(df: DataFrame, path: str, *, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    df.write.mode(mode).partitionBy(*(partition_by or [])).parquet(path)


def write_json(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def flatten_for_csv(df: DataFrame) -> DataFrame:
    """Nested cells as JSON text with their nulls, so that every column fits a CSV cell."""
    def cell(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.MapType):
            column = F.map_from_entries(F.array_sort(F.map_entries(column)))
        if isinstance(field.dataType, (T.MapType, T.ArrayType, T.StructType)):
            column = F.to_json(column, {"ignoreNullFields": "false"})
        return column.alias(field.name)

    return df.select(*[cell(f) for f in df.schema.fields])


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    flatten_for_csv(df).write.mode(mode).option("header", True).option("escape", '"').csv(path)


NO_KEY = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder for a key that is NULL


def write_files(rows: DataFrame, folder: str, *, by: list[str], value: str = "value") -> None:
    """One text file for each key, in the folders that ``partitionBy`` would make for the whole-number or plain-word columns ``by``.

    The rows of a key (by its first column) meet in one task, each a line of its file; the tasks have like numbers of files, however
    the input is split. Files are opened through Arrow: Spark's own writer makes a checksum file beside each, sets permissions by
    starting processes and moves every file at the end, milliseconds for a file. It remains for file systems Arrow does not know.
    A task that is run again writes the same files again.
    """
    tasks = 4 * rows.sparkSession.sparkContext.defaultParallelism
    dealt = rows.repartition(tasks, by[0])
    try:
        fs.FileSystem.from_uri(folder)
    except (pa.ArrowException, OSError):
        dealt.write.partitionBy(*by).text(folder)
        return
    place = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit(NO_KEY))) for c in by])

    def write(part: Iterable) -> None:
        files, top = fs.FileSystem.from_uri(folder)
        for at, held in groupby(part, key=lambda row: row[0]):
            files.create_dir(f"{top}/{at}", recursive=True)
            with files.open_output_stream(f"{top}/{at}/part-0.txt") as out:
                for row in held:
                    out.write(bytes(row[1]) + b"\n")

    dealt.select(place.alias("at"), F.coalesce(F.col(value), F.lit("")).cast("binary")).sortWithinPartitions("at").foreachPartition(write)


# --- output contract -------------------------------------------------------------------

def contract_rows(spark: SparkSession, selection: TimeSelection, query: dict[str, str | None]) -> DataFrame:
    """What an output was made for, as ``field, value`` rows."""
    values = {"version": CONTRACT_VERSION, "time_mode": selection.mode, "periods": ",".join(selection.periods),
              "requested_start": selection.requested_start, "requested_end": selection.requested_end,
              **{f: query.get(f) for f in QUERY_FIELDS}}
    return spark.createDataFrame(list(values.items()), "field string, value string")


def contract_difference(stored: DataFrame, wanted: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Fields whose values differ (NULL equals NULL): ``by..., field, stored, wanted``.

    ``by`` names the output a row belongs to when many contracts are compared at once.
    """
    keys = [*(by or []), "field"]
    joined = stored.withColumnRenamed("value", "stored").join(wanted.withColumnRenamed("value", "wanted"), keys, "full")
    return joined.where(~F.col("stored").eqNullSafe(F.col("wanted"))).select(*keys, "stored", "wanted")


def guard_contract(spark: SparkSession, path: str, wanted: DataFrame) -> None:
    """Refuse an output made for another request; claim a new one. A handful of rows."""
    
    try:
        stored = spark.read.schema("field string, value string").json(path)
        known = stored.limit(1).count()
    except AnalysisException:
        known = 0
    if known:
        differing = contract_difference(stored, wanted).limit(len(QUERY_FIELDS) + 5).collect()
        if differing:
            raise ContractMismatch("the output was made for another request: " + ", ".join(sorted(r.field for r in differing)))
        return
    wanted.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


# --- idempotent ingest -----------------------------------------------------------------

ROW_ADDRESS = "_row_address"


def with_row_address(stored: DataFrame) -> DataFrame:
    """Rows of a stored table with a 64-bit hash of their file and place in it."""
    return stored.select("*", F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index")).alias(ROW_ADDRESS))


def ingest_new(new: DataFrame, store: DataFrame, *, keys: list[str] | None = None, url: str = "source_url",
               sha: str = "air_sha256", stored: bool = False) -> tuple[DataFrame, DataFrame]:
    """Split arriving reports into rows to append and conflicts.

    A report that is stored with the same URL and content is already there. One whose URL or
    content differs, from the store or between two arriving copies, is a conflict and not
    appended; conflicts have a row for each differing URL and content that arrived.

    What happens to a report is decided on numbers: its key, a 128-bit mark of URL and content and
    the address of its row, in a hash aggregate that merges copies map-side. Only the row at the address
    decided on is then fetched, so bodies take part in no aggregate and no sort. ``stored`` says that ``new`` is read from
    Parquet files, each row once; other rows are stored first.
    """
    keys = keys or REPORT_IDENTITY
    columns, both = new.columns, [F.coalesce(url, F.lit("")), F.coalesce(sha, F.lit(""))]
    marks = [F.xxhash64(*both).alias("_m1"), F.xxhash64(F.lit(1), *both).alias("_m2")]
    arrived = with_row_address(new if stored else materialize(new, "arrivals"))
    merged = arrived.select(*keys, ROW_ADDRESS, *marks).groupBy(*keys).agg(
        F.min(ROW_ADDRESS).alias(ROW_ADDRESS), F.count(F.lit(1)).alias("arrived"),
        *[f(m).alias(f"{m}{n}") for m in ("_m1", "_m2") for f, n in ((F.min, "_lo"), (F.max, "_hi"))])
    known = store.select(*keys, *marks).groupBy(*keys).agg(F.min("_m1").alias("_s1"), F.min("_m2").alias("_s2"))
    judged = merged.join(known, keys, "left")
    mixed = (F.col("_m1_lo") != F.col("_m1_hi")) | (F.col("_m2_lo") != F.col("_m2_hi"))
    other = F.coalesce((F.col("_s1") != F.col("_m1_lo")) | (F.col("_s2") != F.col("_m2_lo")), F.lit(False))
    accepted = judged.where(F.col("_s1").isNull() & ~mixed).select(ROW_ADDRESS).hint("shuffle_hash")
    append = arrived.join(accepted, ROW_ADDRESS, "left_semi").select(columns)
    reason = F.when(mixed, "copies_differ").otherwise("differs_from_store")
    clashes = judged.where(mixed | other).select(*keys, "arrived", reason.alias("reason"))
    return append, arrived.select(*keys, url, sha).distinct().join(clashes, keys)
