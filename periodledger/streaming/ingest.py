"""Newly arriving reports: append once, then refresh the totals they can change.

A revision may arrive years later and must reopen a total, so there is no watermark and no
streaming state: the state is the store itself. A batch that is replayed after a lost driver
writes its own folders anew and computes the same totals again.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from periodledger.operators.flatten import flatten_reports, rejected_bodies
from periodledger.operators.resolve import summarize_native, summarize_period
from periodledger.operators.timeselect import TimeSelection, partition_kinds, requested_rows
from periodledger.sources.scratch import materialize
from periodledger.sources.sinks import REPORT_IDENTITY, ingest_new

_TEXT_MAP = T.MapType(T.StringType(), T.StringType())
ARRIVAL_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in (*REPORT_IDENTITY, "enterprise_id", "source_url", "air_sha256", "body")]
    + [T.StructField("meta", _TEXT_MAP), T.StructField("enterprise", _TEXT_MAP)])
STORE_SCHEMA = T.StructType([*ARRIVAL_SCHEMA.fields, T.StructField("bucket", T.IntegerType()), T.StructField("batch", T.LongType())])
_TOUCHED_SCHEMA = T.StructType([T.StructField("enterprise", T.StringType()), T.StructField("enterprise_id", T.StringType()),
                                T.StructField("bucket", T.IntegerType()), T.StructField("batch", T.LongType())])


@dataclass(frozen=True)
class ReportStore:
    """Tables ``reports``, ``conflicts``, ``rejects``, ``records``, ``touched``, ``period_summary`` and ``native_summary`` under one folder.

    Maintenance is by key. Reports lie by a hash bucket of the enterprise and by batch; a batch is compared with the keys of its
    buckets only. Only the reports a batch adds are flattened; their records lie by enterprise and batch. The totals of the
    enterprises a batch touches are computed anew from their own records: a semi-join with the batch's ``touched`` rows prunes the other
    enterprises' folders before anything is read. Their rows replace the old ones in the totals' buckets.

    A group never spans enterprises. Every batch writes folders of its own, so that a replay replaces what it wrote before. Choose
    the number of buckets so that the totals of one are some MB; it must not change over the life of a store. Small batches leave
    small files, which an ordinary rewrite of an enterprise's folders between batches joins.
    """

    spark: SparkSession
    folder: str
    selection: TimeSelection
    buckets: int = 64

    def _bucket(self, key: str = "enterprise_id") -> Column:
        return F.pmod(F.xxhash64(F.coalesce(key, F.lit(""))), F.lit(self.buckets)).cast("int")

    def _path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self._path(name))

    def _table_or(self, name: str, schema: T.StructType) -> DataFrame:
        """A table, or an empty one before the first batch."""
        try:
            return self.spark.read.schema(schema).parquet(self._path(name))
        except AnalysisException:
            return self.spark.createDataFrame([], schema)

    def reports(self) -> DataFrame:
        return self._table_or("reports", STORE_SCHEMA)

    def records(self) -> DataFrame:
        fields = [f for f in _record_schema(self.spark).fields if f.name not in ("enterprise", "batch")]
        return self._table_or("records", T.StructType([*fields, T.StructField("enterprise", T.StringType()), T.StructField("batch", T.LongType())]))

    def add(self, batch: DataFrame, batch_id: int, stored: bool = False) -> None:
        """Store what is new in a batch: reports, conflicts, the records of the new reports and whom they touch."""
        arriving = batch.withColumn("bucket", self._bucket())
        buckets = sorted(r.bucket for r in arriving.select("bucket").distinct().collect())  # at most ``buckets`` rows
        before = self.reports().where(F.col("bucket").isin(buckets) & (F.col("batch") != batch_id))
        append, conflicts = ingest_new(arriving, before, keys=[*REPORT_IDENTITY, "bucket"], stored=stored)
        conflicts.write.mode("overwrite").parquet(f"{self._path('conflicts')}/batch={batch_id}")
        self._replace(append.withColumn("batch", F.lit(batch_id).cast("long")), "reports", "bucket", "batch")
        added = self.reports().where(F.col("bucket").isin(buckets) & (F.col("batch") == batch_id))
        rejected_bodies(added, REPORT_IDENTITY).write.mode("overwrite").parquet(f"{self._path('rejects')}/batch={batch_id}")
        records = requested_rows(flatten_reports(added, selection=self.selection), self.selection).withColumns({"enterprise": _enterprise(), "batch": F.lit(batch_id).cast("long")})
        # An enterprise's records meet in one task and make one file: every task would otherwise open a file for nearly every enterprise.
        self._replace(records.repartition("enterprise"), "records", "enterprise", "batch")
        touched = self.records().where(F.col("batch") == batch_id).select("enterprise", "enterprise_id").distinct()
        touched.withColumn("bucket", self._bucket()).write.mode("overwrite").parquet(f"{self._path('touched')}/batch={batch_id}")

    def records_of(self, touched: DataFrame) -> DataFrame:
        """The records of some enterprises; the folders of the others are not read."""
        return self.records().join(touched.select("enterprise"), "enterprise", "left_semi")

    def refresh(self, batch_id: int) -> None:
        """Compute the totals of the enterprises a batch touches, and replace exactly those."""
        touched = self.spark.read.schema(_TOUCHED_SCHEMA).parquet(self._path("touched")).where(F.col("batch") == batch_id)
        buckets = sorted(r.bucket for r in touched.select("bucket").distinct().collect())  # at most ``buckets`` rows
        if not buckets:
            return
        records = self.records_of(touched)
        period = summarize_period(records, self.selection)
        native = summarize_native(partition_kinds(records)[1], self.selection)
        for name, totals in (("period_summary", period), ("native_summary", native)):
            schema = T.StructType([*totals.schema.fields, T.StructField("bucket", T.IntegerType())])
            new = totals.withColumn("bucket", self._bucket())
            stale = touched.select(F.coalesce("enterprise_id", F.lit("")).alias("_of"), "bucket")
            others = self._table_or(name, schema).where(F.col("bucket").isin(buckets)).withColumn("_of", F.coalesce("enterprise_id", F.lit("")))
            others = others.join(stale, ["_of", "bucket"], "left_anti").select(schema.names)
            # Stored before the buckets it is made from are replaced.
            self._replace(materialize(new.select(schema.names).unionByName(others), name), name, "bucket")

    def _replace(self, df: DataFrame, name: str, *by: str) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(self._path(name))

    def take(self, batch: DataFrame, batch_id: int) -> None:
        """Ingest one micro-batch; safe to repeat."""
        self.add(materialize(batch, "batch"), batch_id, stored=True)
        self.refresh(batch_id)


@lru_cache(maxsize=1)
def _record_schema(spark: SparkSession) -> T.StructType:
    return flatten_reports(spark.createDataFrame([], ARRIVAL_SCHEMA)).schema


def _enterprise() -> Column:
    """Folder name of a record's enterprise."""
    return F.coalesce(F.nullif("enterprise_id", F.lit("")), F.lit("-"))


def follow(store: ReportStore, arrivals: str, checkpoint: str, *, max_files: int = 1000) -> StreamingQuery:
    """Ingest all arrival files (parquet, ARRIVAL_SCHEMA) not seen before, then stop."""
    stream = store.spark.readStream.schema(ARRIVAL_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(arrivals)
    return stream.writeStream.foreachBatch(store.take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
