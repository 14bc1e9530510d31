"""What is read: folders pruned by year and by enterprise, bodies fetched once."""

import hashlib
import io
import json
import re
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from periodledger.functions.hashing import content_hash
from periodledger.operators.timeselect import expand_requests, relevant_reports, requested_by, requested_rows, select_time, with_index_clash, with_report_period, with_scan_year
from periodledger.sources.scratch import materialize
from periodledger.sources.sinks import ingest_new
from periodledger.streaming.ingest import ARRIVAL_SCHEMA, ReportStore


def plan_of(df):
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def test_records_by_year(spark):
    rows = [(i, y, kind, m, q) for i, (y, kind, m, q) in enumerate([
        (2019, "month", 4, None), (2020, "month", 11, None), (2020, "quarter", None, 4), (2020, "year", None, None), (2021, "month", 1, None), (2021, "month", None, None),
        (None, "month", 3, None), (2018, "unknown", None, None), (2020, "quarter", None, None)])]
    records = spark.createDataFrame(rows, "id int, year int, period_kind string, month int, report_quarter int")
    stored = materialize(with_scan_year(records), "test-years", partition_by=["scan_year"])
    for request in (select_time(periods=["2020-11", "2021-01"]), select_time(years=[2019]), select_time(start="2018-01", end="2022-12")):
        got = requested_rows(stored, request)
        assert sorted(r.id for r in got.collect()) == sorted(r.id for r in requested_rows(records, request).collect())
    filters = re.search(r"PartitionFilters: \[(.*)\]", plan_of(requested_rows(stored, select_time(years=[2020]))))[1]
    assert "scan_year" in filters and "2020" in filters
    # A table of requests prunes while it runs.
    asked = spark.createDataFrame([([2019], None, None, None, None), (None, None, "2020-12", "2021-01", None), (None, None, "2020", None, None)],
                                  "years array<int>, months array<int>, start string, end string, explicit array<string>")
    met = requested_by(stored, expand_requests(asked))
    assert sorted(r.id for r in met.collect()) == [0, 2, 3, 4, 5, 6, 7, 8]
    assert "dynamicpruning" in re.search(r"PartitionFilters: \[(.*)\]", plan_of(met))[1]


def test_index_by_year(spark):
    entries = spark.createDataFrame([("a", "2020年03月", "月报", 2020), ("b", "2021年第1季", "季报", 2021), ("c", "2019年年报", "年报", 2020), ("d", "??", "月报", 2018)],
                                    "report_id string, report_time string, type string, index_year int")
    classified = with_index_clash(with_report_period(entries), "index_year")
    stored = materialize(with_scan_year(classified), "test-index", partition_by=["scan_year"])
    kept = relevant_reports(stored, select_time(periods=["2020-03"]))
    assert {r.report_id: r.period_error for r in kept.collect()} == {"a": None, "c": "period_differs_from_index_year", "d": "unrecognized_year"}
    assert "scan_year" in re.search(r"PartitionFilters: \[(.*)\]", plan_of(kept))[1]


def arrivals(spark, entries):
    """``entries``: enterprise, report id, month, value."""
    rows = []
    for enterprise, report, month, value in entries:
        body = {"companyInfo": {"reportType": "月报", "reportTime": f"2022年{month:02d}月", "permitCode": "Q" + enterprise, "enterName": "Works " + enterprise},
                "emissionInfo": {"airMainEmission": [{"pollutantCode": "A21026", "pollutantName": "二氧化硫", "outletCode": "DA7", "emitValue": value}]}}
        rows.append((enterprise, report, json.dumps(body, ensure_ascii=False)))
    made = spark.createDataFrame(rows, "enterprise_id string, reportId string, body string")
    return made.select(
        F.concat(F.lit("Q"), "enterprise_id").alias("permit_code"), "reportId", F.lit("p").alias("provinceSharding"), F.lit("y").alias("yearSharding"), "enterprise_id",
        F.concat(F.lit("u"), "reportId").alias("source_url"), content_hash(F.col("body")).alias("air_sha256"), "body",
        F.create_map(F.lit("report_id"), F.col("reportId"), F.lit("permit_code"), F.concat(F.lit("Q"), "enterprise_id")).alias("meta"),
        F.create_map(F.lit("enterprise_id"), F.col("enterprise_id")).alias("enterprise")).select(ARRIVAL_SCHEMA.names)


def test_only_touched_enterprises_are_read(spark, tmp_path):
    request = select_time(years=[2022], months=[5, 6])
    store = ReportStore(spark, str(tmp_path / "store"), request, buckets=2)
    store.take(arrivals(spark, [(e, f"{e}-{m}", m, "2.5") for e in ("n", "s", "w") for m in (5, 7)] + [("s", "s-6", 6, "1")]), 1)
    before = {r.enterprise_id: (r.status, r.period_total_decimal) for r in store.table("period_summary").collect()}
    assert before == {"n": ("incomplete", None), "s": ("complete", "3.5"), "w": ("incomplete", None)}
    store.take(arrivals(spark, [("w", "w-6", 6, "0.25"), ("w", "w-5", 5, "2.5")]), 2)
    totals = {r.enterprise_id: (r.status, r.period_total_decimal) for r in store.table("period_summary").collect()}
    assert totals == {**before, "w": ("complete", "2.75")}
    assert "dynamicpruning" in plan_of(store.records_of(spark.read.parquet(str(tmp_path / "store" / "touched")).where("batch = 2")))
    # Taken again, a batch leaves everything as it is.
    store.take(arrivals(spark, [("w", "w-6", 6, "0.25"), ("w", "w-5", 5, "2.5")]), 2)
    assert {r.enterprise_id: (r.status, r.period_total_decimal) for r in store.table("period_summary").collect()} == totals
    assert store.reports().count() == 8
    # Records of other enterprises are not read: a refresh works although they cannot be.
    for name in ("n", "s"):
        for file in (tmp_path / "store" / "records" / f"enterprise={name}").rglob("*.parquet"):
            (file.parent / f".{file.name}.crc").unlink()
            file.write_bytes(b"no table")
    store.take(arrivals(spark, [("w", "w-late", 6, "8")]), 3)
    assert {r.enterprise_id: (r.status, r.period_total_decimal) for r in store.table("period_summary").collect()} == {**before, "w": ("conflict", None)}


def test_bodies_are_in_no_aggregate_and_no_sort(spark):
    made = arrivals(spark, [("n", "r1", 5, "1"), ("n", "r1", 5, "1"), ("n", "r2", 6, "1")])
    new = materialize(made.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(3)))), "test-arrivals")
    store = arrivals(spark, [("n", "r2", 6, "9")]).select("permit_code", "reportId", "provinceSharding", "yearSharding", "source_url", "air_sha256")
    append, conflicts = ingest_new(new, store, stored=True)
    assert [(r.reportId, r.copy in (1, 2, 3)) for r in append.collect()] == [("r1", True)]
    assert [(r.reportId, r.reason, r.arrived, r.source_url, r.air_sha256) for r in conflicts.collect()] == [
        ("r2", "differs_from_store", 3, "ur2", new.where("reportId = 'r2'").first().air_sha256)]
    for step in re.split(r"\n\n", plan_of(append)):
        if re.match(r"\(\d+\) (HashAggregate|SortAggregate|ObjectHashAggregate|Sort)\b", step.strip()):
            assert "body" not in step
    assert "SortAggregate" not in plan_of(append)


def test_files_without_a_partner_are_listed(spark, tmp_path):
    from periodledger.sources.reports import scan_report_files, scan_report_folder

    for name, files in {"one": ("air_report.json", "provenance.json"), "bare": ("air_report.json",), "lost": ("provenance.json",)}.items():
        place = tmp_path / "reports" / name
        place.mkdir(parents=True)
        for file in files:
            (place / file).write_bytes(b'{"permit_code":"Q1","report_id":"' + name.encode() + b'"}\r\n')
    got = {r.report_key: r for r in scan_report_files(spark, str(tmp_path)).collect()}
    assert {k: r.file_status for k, r in got.items()} == {"one": "paired", "bare": "body_without_provenance", "lost": "provenance_without_body"}
    assert got["lost"].report_id == "lost" and got["lost"].body is None and got["bare"].report_id is None
    assert got["bare"].air_sha256 == hashlib.sha256(b'{"permit_code":"Q1","report_id":"bare"}\r\n').hexdigest()
    assert [r.report_key for r in scan_report_folder(spark, str(tmp_path)).collect()] == ["one"]


def test_the_records_of_an_enterprise_are_one_file_a_batch(spark, tmp_path):
    store = ReportStore(spark, str(tmp_path / "store"), select_time(years=[2022], months=[5, 6]), buckets=2)
    rows = [(e, f"{e}-{m}-{n}", m, "1") for e in ("n", "s") for m in (5, 6) for n in range(8)]
    apart = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.openCostInBytes": str(2**27)}  # reports in many tasks
    for name, value in apart.items():
        spark.conf.set(name, value)
    try:
        store.add(arrivals(spark, rows).repartition(8, "reportId"), 1)
    finally:
        for name in apart:
            spark.conf.unset(name)
    files = [at.parent for at in (tmp_path / "store" / "records").glob("enterprise=*/batch=1/*.parquet")]
    assert len(files) == len(set(files)) == 2
    assert store.records().count() == len(rows)
