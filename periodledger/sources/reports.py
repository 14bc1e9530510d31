"""Report bodies, provenance and index listings as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from periodledger import vocab
from periodledger.functions.context import STRING_MAP, url_parameter
from periodledger.functions.hashing import content_hash
from periodledger.sources.files import any_match, find_files, local_folder, read_paired


# Where a run folder keeps its files, and what in a path names the report: the directory of the file.
BODY_FILES, META_FILES, KEY_IN_PATH = "reports/*/air_report.json", "reports/*/provenance.json", r"([^/]+)/[^/]+$"


def _whole_files(spark: SparkSession, pattern: str, key: str, name: str) -> DataFrame:
    files = spark.read.format("binaryFile").load(pattern)
    return files.select(F.regexp_extract(F.col("_metadata.file_path"), key, 1).alias("report_key"), F.col("content").alias(name))


def scan_report_files(spark: SparkSession, folder: str, *, bodies: str = BODY_FILES, metas: str = META_FILES, key: str = KEY_IN_PATH) -> DataFrame:
    """All stored reports of a run folder: ``report_key, permit_code, report_id, body, air_sha256, meta, file_status``.

    Body and provenance lie side by side as files and are joined by their directory. The hash is that of the file's bytes. A file
    without its partner stays, with the status ``body_without_provenance`` or ``provenance_without_body``; several files under one key
    are all paired. Files of a local folder are found and read by tasks; other file systems, names that only Spark's patterns can
    match and folders without such files, which it refuses, keep Spark's reader.
    """
    place = local_folder(spark, folder, bodies, metas)
    if place and any_match(place, bodies) and any_match(place, metas):
        body, meta = (find_files(spark, place, x).select(F.regexp_extract("uri", key, 1).alias("report_key"), "path") for x in (bodies, metas))
        found = read_paired(body, meta, "report_key", ("_body", "_meta"))
    else:
        found = _whole_files(spark, f"{folder}/{bodies}", key, "_body").join(_whole_files(spark, f"{folder}/{metas}", key, "_meta"), "report_key", "full")
    status = F.when(F.col("_body").isNull(), "provenance_without_body").when(F.col("_meta").isNull(), "body_without_provenance").otherwise("paired")
    told = found.select("report_key", F.decode("_body", "UTF-8").alias("body"), F.sha2("_body", 256).alias("air_sha256"),
                        F.from_json(F.decode("_meta", "UTF-8"), STRING_MAP).alias("meta"), status.alias("file_status"))
    return told.select(
        "report_key", F.try_element_at("meta", F.lit("permit_code")).alias("permit_code"),
        F.try_element_at("meta", F.lit("report_id")).alias("report_id"), "body", "air_sha256", "meta", "file_status")


def scan_report_folder(spark: SparkSession, folder: str) -> DataFrame:
    """The complete reports of a run folder. Keep the result as a table (:func:`periodledger.sources.sinks.write_table`): there
    body and provenance share a row and the join is never needed again."""
    return scan_report_files(spark, folder).where(F.col("file_status") == "paired").drop("file_status")


def attach_enterprises(reports: DataFrame, enterprises: DataFrame, key: str = "enterprise_id", salts: int = 1) -> DataFrame:
    """Add the ``enterprise`` map to reports; an unknown enterprise gives an empty record.

    ``enterprises``: ``key`` and plain string columns. Of several rows of one key the one with the smallest values, column
    by column, is taken, so that reports are never multiplied; :func:`surplus_rows` lists such keys. Which side is broadcast is
    left to the optimizer, which knows the size. Otherwise reports of one hot enterprise are
    split by the adaptive skew join, or, with ``salts`` > 1, spread over that many partitions
    in advance: by a hash of the report id, so that a retried task puts them in the same place.
    """
    columns = [c for c in enterprises.columns if c != key]
    values = F.struct(*[F.col(c).cast("string").alias(c) for c in columns]) if columns else F.lit(None)
    packed = enterprises.groupBy(key).agg(F.min(values).alias("_one")).select(key, F.create_map(
        F.lit("enterprise_id"), F.col(key), *[x for c in columns for x in (F.lit(c), F.col("_one")[c])]).alias("enterprise"))
    if salts == 1:
        return reports.join(packed, key, "left")
    salted = reports.withColumn("_salt", F.pmod(F.xxhash64("report_id"), F.lit(salts)).cast("int"))
    copies = packed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [key, "_salt"], "left").drop("_salt")


def surplus_rows(df: DataFrame, key: str = "enterprise_id") -> DataFrame:
    """Keys that have more than one row, with the number of rows beyond the first."""
    return df.groupBy(key).agg((F.count(F.lit(1)) - 1).alias("surplus")).where("surplus > 0")


def explode_index(listings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Index listings (``enterprise_id, index_year, listing`` JSON text) to entries and rejects.

    A listing that is not a JSON list is a reject, not an empty year. Entries keep their raw
    JSON next to ``report_time, type, doc_url``.
    """
    parsed = listings.withColumn("_items", F.from_json("listing", "array<string>"))
    rejects = parsed.where(F.col("_items").isNull()).select("enterprise_id", "index_year", F.lit("listing_not_a_list").alias("reason"))
    raw = parsed.select("enterprise_id", "index_year", F.posexplode_outer("_items").alias("pos", "raw")).where(F.col("pos").isNotNull())
    entry = F.from_json("raw", STRING_MAP)
    rows = raw.withColumn("_entry", entry).select(
        "enterprise_id", "index_year", "pos",
        F.coalesce(F.nullif(F.try_element_at("_entry", F.lit("reportTime")), F.lit("")),
                   F.try_element_at("_entry", F.lit("report_period"))).alias("report_time"),
        F.coalesce(*[F.nullif(F.try_element_at("_entry", F.lit(k)), F.lit("")) for k in ("type", "report_type", "reportType")]).alias("type"),
        F.try_element_at("_entry", F.lit("docUrl")).alias("doc_url"), "raw")
    return rows, rejects


def with_url_identity(index: DataFrame, url: str = "doc_url") -> DataFrame:
    """Add the three id parameters of a report URL and ``url_status``: ``ok``,
    ``unsupported_format`` (not a public view) or ``invalid_identifier``."""
    step = index.withColumns({name: url_parameter(F.col(url), name) for name in vocab.REPORT_PARAMETERS})
    valid = F.lit(True)
    for name in vocab.REPORT_PARAMETERS:
        valid = valid & F.coalesce(F.col(name).rlike(f"^{vocab.REPORT_PARAMETER}$"), F.lit(False))
    public = F.coalesce(F.col(url).contains("/pubView?"), F.lit(False))
    return step.withColumn("url_status", F.when(~public, "unsupported_format").when(valid, "ok").otherwise("invalid_identifier"))


def report_cache_key(permit: Column) -> Column:
    """Identity of a stored report: permit and the three id parameters, hashed."""
    return F.sha2(F.to_json(F.array(permit, *[F.col(n) for n in vocab.REPORT_PARAMETERS])), 256)
