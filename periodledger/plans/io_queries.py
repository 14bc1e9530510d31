"""Sources, sinks, contracts and ingest."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodledger.functions.hashing import content_hash
from periodledger.plans import fixtures, oracles
from periodledger.plans.common import GROUP, QUARTER, joined, text
from periodledger.sources.reports import attach_enterprises, explode_index, scan_report_files
from periodledger.sources.scratch import materialize, shared_folder
from periodledger.sources.sinks import contract_difference, flatten_for_csv, ingest_new, write_files
from periodledger.streaming.ingest import ReportStore


def q_body_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fixtures.table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", content_hash(F.col("text")).alias("sha"), F.char_length("text").alias("n_chars"))


def q_index_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One listing per customer: lists of zero to two entries, or not a list at all."""
    k = F.col("c_custkey")
    entry = lambda n: F.concat(F.lit('{"reportTime":"2024年0'), F.lit(str(n)), F.lit('月","type":"月报","docUrl":"u'), text(k), F.lit('","other":1}'))
    listing = (
        F.when(k % 5 == 0, F.concat(F.lit("["), entry(1), F.lit(","), entry(2), F.lit("]"))).when(k % 5 == 1, F.concat(F.lit("["), entry(3), F.lit("]")))
        .when(k % 5 == 2, F.lit("[]")).when(k % 5 == 3, entry(4)).otherwise(F.lit("<html>"))
    )
    listings = fixtures.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("E"), text(k)).alias("enterprise_id"), F.lit(2024).alias("index_year"), listing.alias("listing"))
    rows, rejects = explode_index(listings)
    rows = rows.select("enterprise_id", "pos", "report_time", "type", "doc_url", F.lit(None).cast("string").alias("reason"))
    missing = [F.lit(None).cast(t).alias(c) for c, t in (("pos", "int"), ("report_time", "string"), ("type", "string"), ("doc_url", "string"))]
    return rows.unionByName(rejects.select("enterprise_id", *missing, "reason"))


LISTING_SQL = """
WITH x AS (SELECT c_custkey AS k, unnest(CASE c_custkey % 5 WHEN 0 THEN [1, 2] WHEN 1 THEN [3] WHEN 2 THEN [] ELSE [0] END) AS n FROM customer)
SELECT 'E' || k AS enterprise_id, CASE n WHEN 0 THEN NULL WHEN 2 THEN 1 ELSE 0 END AS pos, CASE WHEN n > 0 THEN '2024年0' || n || '月' END AS report_time,
       CASE WHEN n > 0 THEN '月报' END AS type, CASE WHEN n > 0 THEN 'u' || k END AS doc_url, CASE WHEN n = 0 THEN 'listing_not_a_list' END AS reason FROM x"""


def q_attach_enterprises(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as reports, customers as enterprises; a third of all reports belong to one."""
    k = F.col("o_orderkey")
    reports = fixtures.table(spark, sf_dir, "orders").select(
        text("o_orderkey").alias("report_id"), text(F.when(k % 3 == 0, 7).when(k % 31 == 1, -1).otherwise(F.col("o_custkey"))).alias("enterprise_id"))
    enterprises = fixtures.table(spark, sf_dir, "customer").select(text("c_custkey").alias("enterprise_id"), F.col("c_name").alias("name"))
    joined = attach_enterprises(reports, enterprises, salts=8)
    return joined.select("report_id", "enterprise_id", F.try_element_at("enterprise", F.lit("name")).alias("name"))


ATTACH_SQL = """
WITH r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 7 WHEN o_orderkey % 31 = 1 THEN -1 ELSE o_custkey END AS c FROM orders)
SELECT CAST(o_orderkey AS VARCHAR) AS report_id, CAST(c AS VARCHAR) AS enterprise_id, c_name AS name FROM r LEFT JOIN customer ON c = c_custkey"""


def q_csv_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with nested cells, as they go to CSV."""
    events = fixtures.table(spark, sf_dir, "events").select(
        "event_id", F.struct(F.col("user_id").alias("u"), F.when(F.col("event_id") % 2 == 0, F.col("event_type")).alias("t")).alias("who"),
        F.array(F.col("event_id"), F.col("user_id")).alias("ids"),
        F.create_map(F.lit("b"), text("user_id"), F.lit("a"), F.col("event_type")).alias("m"))
    return flatten_for_csv(events)


CSV_SQL = """
SELECT event_id, '{"u":' || user_id || ',"t":' || CASE WHEN event_id % 2 = 0 THEN '"' || event_type || '"' ELSE 'null' END || '}' AS who,
       '[' || event_id || ',' || user_id || ']' AS ids, '{"a":"' || event_type || '","b":"' || user_id || '"}' AS m FROM events"""


def q_contract_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contracts of one output per customer, stored and wanted."""
    k = F.col("c_custkey")
    base = fixtures.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")

    def contract(wanted: bool) -> DataFrame:
        changed = F.lit(wanted)
        fields = F.create_map(
            F.lit("mode"), F.lit("region"), F.lit("province"), F.when(changed & (k % 5 == 1), "other").otherwise(F.col("c_mktsegment")),
            F.lit("county"), F.when(k % 3 != 0, "D1"), F.lit("name"), F.when(changed & (k % 7 == 2), "n"))
        return base.select("c_custkey", F.explode(fields).alias("field", "value"))

    return contract_difference(contract(False), contract(True), by=["c_custkey"])


CONTRACT_SQL = """
SELECT c_custkey, 'province' AS field, c_mktsegment AS stored, 'other' AS wanted FROM customer WHERE c_custkey % 5 = 1
UNION ALL SELECT c_custkey, 'name', NULL, 'n' FROM customer WHERE c_custkey % 7 = 2"""


def _arrivals(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Documents as report bodies: a store, and arrivals with repeats, copies and changes."""
    d = F.col("doc_id")
    docs = fixtures.table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("u"), text("doc_id")).alias("source_url"), "text")
    store = docs.where(d % 3 < 2).select("doc_id", "source_url", content_hash(F.col("text")).alias("air_sha256"))
    copies = F.when(d % 11 == 4, F.sequence(F.lit(1), F.lit(5))).otherwise(F.array(F.lit(1)))
    arriving = docs.where(d % 3 > 0).withColumn("copy", F.explode(copies))
    body = F.concat("text", F.when(d % 7 == 3, "+").when((d % 13 == 5) & (F.col("copy") == 2), "?").otherwise(""))
    return arriving.select("doc_id", "source_url", content_hash(body).alias("air_sha256"), body.alias("body")), store


def q_ingest_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    append, _ = ingest_new(*_arrivals(spark, sf_dir), keys=["doc_id"])
    return append.select("doc_id", "source_url", "air_sha256")


def q_ingest_hash_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_new(*_arrivals(spark, sf_dir), keys=["doc_id"])[1]


INGEST = """
WITH a AS (
  SELECT doc_id, text, doc_id % 3 = 1 AS stored, CASE WHEN doc_id % 11 = 4 THEN 5 ELSE 1 END AS arrived,
         doc_id % 11 = 4 AND doc_id % 13 = 5 AND doc_id % 7 <> 3 AS mixed, doc_id % 7 = 3 AS changed FROM documents WHERE doc_id % 3 > 0)"""

def q_report_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as files, one for the text and one for its origin, some without the other; read back and hashed."""
    d = F.col("doc_id")
    docs = fixtures.table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang")
    origin = F.to_json(F.struct(F.col("lang").alias("permit_code"), text("doc_id").alias("report_id")))
    files = F.array_compact(F.array(F.when(d % 10 != 3, F.struct(F.lit("body").alias("kind"), F.col("text").alias("value"))),
                                    F.when(d % 10 != 7, F.struct(F.lit("origin").alias("kind"), origin.alias("value")))))
    folder = f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"
    # Tasks that make folders in one and the same folder wait for each other.
    shard = F.pmod(F.hash("doc_id"), F.lit(256)).alias("shard")
    write_files(docs.select(shard, "doc_id", F.inline(files)), folder, by=["shard", "doc_id", "kind"])
    each = "shard=*/doc_id=*/kind="
    found = scan_report_files(spark, folder, bodies=f"{each}body/part-*", metas=f"{each}origin/part-*", key=r"doc_id=([^/]+)/kind=")
    return found.select("report_key", "permit_code", "report_id", "air_sha256", F.length("body").alias("n_chars"), "file_status")


# The text sink ends a file with a line end.
FILES_SQL = """
SELECT CAST(doc_id AS VARCHAR) AS report_key, CASE WHEN doc_id % 10 <> 7 THEN lang END AS permit_code, CASE WHEN doc_id % 10 <> 7 THEN CAST(doc_id AS VARCHAR) END AS report_id,
       CASE WHEN doc_id % 10 <> 3 THEN sha256(coalesce(text, '') || chr(10)) END AS air_sha256, CASE WHEN doc_id % 10 <> 3 THEN CAST(length(coalesce(text, '')) + 1 AS INT) END AS n_chars,
       CASE doc_id % 10 WHEN 3 THEN 'provenance_without_body' WHEN 7 THEN 'body_without_provenance' ELSE 'paired' END AS file_status FROM documents"""


def _arriving_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report bodies in the form in which they arrive at a store."""
    bodies = fixtures.bodies(spark, sf_dir)
    return bodies.select(
        F.col("filed_permit").alias("permit_code"), F.col("report_id").alias("reportId"), F.lit("p").alias("provinceSharding"), F.lit("y").alias("yearSharding"),
        "enterprise_id", F.concat(F.lit("u"), "report_id").alias("source_url"), content_hash(F.col("body")).alias("air_sha256"), "body", "meta", "enterprise")


def q_incremental_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches into a store, the second one with late reports and repeats: the totals are those of all reports at once."""
    arriving = materialize(_arriving_bodies(spark, sf_dir), "arriving")
    store = ReportStore(spark, f"{shared_folder(spark)}/store-{uuid.uuid4().hex}", QUARTER, buckets=8)
    part = F.crc32("reportId") % 5
    store.take(arriving.where(part > 0), 1)
    store.take(arriving.where(part < 2), 2)
    return store.table("period_summary").select(
        *GROUP, "enterprise_name", "status", "month_coverage_complete", "period_total", "period_total_decimal",
        "covered_full_months_total", joined("missing_periods"), joined("conflict_periods"), "lower_priority_disagreement")


QUERIES = {
    "q_incremental_refresh": q_incremental_refresh, "q_report_files": q_report_files,
    "q_body_hash": q_body_hash, "q_index_listing": q_index_listing, "q_attach_enterprises": q_attach_enterprises, "q_csv_flatten": q_csv_flatten,
    "q_contract_diff": q_contract_diff, "q_ingest_new": q_ingest_new, "q_ingest_hash_conflict": q_ingest_hash_conflict,
}
ORACLES = {
    "q_report_files": FILES_SQL,
    "q_incremental_refresh": oracles.period_summary(list(QUARTER.periods), True),
    "q_body_hash": "SELECT doc_id, sha256(text) AS sha, CAST(length(text) AS INT) AS n_chars FROM documents",
    "q_index_listing": LISTING_SQL, "q_attach_enterprises": ATTACH_SQL, "q_csv_flatten": CSV_SQL, "q_contract_diff": CONTRACT_SQL,
    "q_ingest_new": INGEST + """ SELECT doc_id, 'u' || doc_id AS source_url, sha256(text || CASE WHEN changed THEN '+' ELSE '' END) AS air_sha256
        FROM a WHERE NOT stored AND NOT mixed""",
    "q_ingest_hash_conflict": INGEST + """ SELECT doc_id, CAST(arrived AS BIGINT) AS arrived, CASE WHEN mixed THEN 'copies_differ' ELSE 'differs_from_store' END AS reason,
        'u' || doc_id AS source_url, sha256(text || mark) AS air_sha256
        FROM a, unnest(CASE WHEN mixed THEN ['', '?'] WHEN changed THEN ['+'] ELSE [''] END) AS m(mark) WHERE mixed OR (stored AND changed)""",
}
