import json
import os
from types import SimpleNamespace

import pytest
from conftest import filing, line
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from periodledger.functions.hashing import content_hash
from periodledger.operators.compare import compare_runs, difference_samples, multiset_difference
from periodledger.operators.coverage import index_coverage
from periodledger.operators.timeselect import select_time, with_report_period
from periodledger.plans.run import collect_run, load_run, manifest_of, verify_folder
from periodledger.sources import files, reports, sinks
from periodledger.sources.reports import attach_enterprises, scan_report_files, scan_report_folder, surplus_rows, with_url_identity
from periodledger.sources.sinks import ContractMismatch, contract_rows, guard_contract, ingest_new, write_csv, write_json
from periodledger.streaming.ingest import ARRIVAL_SCHEMA, ReportStore, follow

SELECTION = select_time(start="2023-12", end="2024-01")


def _quarterly(year, q, value="1"):
    return filing(f"{year}年第{q:02d}季度季报表", "季报", [line(outlet="D", name="NOx", firstMonth=value, secondMonth="2", thirdMonth="3", total="6")], reportQuarter=q)


def _folder(tmp_path):
    """Reports as files, the way a collected folder holds them."""
    for year, q in ((2023, 4), (2024, 1)):
        place = tmp_path / "reports" / f"{year}-Q{q}"
        place.mkdir(parents=True)
        (place / "air_report.json").write_text(json.dumps(_quarterly(year, q), ensure_ascii=False, indent=1), encoding="utf-8")
        (place / "provenance.json").write_text(json.dumps({
            "enterprise_id": "e1", "permit_code": "P1", "report_id": f"{year}-Q{q}", "report_period": f"{year}年第{q:02d}季度季报表", "report_type": "季报",
            "source_url": f"https://reports.example/{year}/{q}"}, ensure_ascii=False), encoding="utf-8")
    return str(tmp_path)


def test_run_is_collected_verified_and_faults_are_found(spark, tmp_path):
    found = scan_report_folder(spark, _folder(tmp_path / "in"))
    enterprises = spark.createDataFrame([("e1", "P1", "Plant")], "enterprise_id string, permit_code string, name string")
    reports = attach_enterprises(found.withColumn("enterprise_id", F.lit("e1")), enterprises)
    index = with_report_period(spark.createDataFrame(
        [("e1", y, f"{y}年第{q:02d}季度季报表", "季报") for y in (2023, 2024) for q in range(1, 5)], "enterprise_id string, index_year int, report_time string, type string"))
    out = str(tmp_path / "out")
    run = collect_run(spark, out, selection=SELECTION, reports=reports, manifest=manifest_of(reports), enterprises=enterprises,
                      indexes=index_coverage(enterprises, index, SELECTION), query={"mode": "company", "name": "Plant"})
    cover = run["coverage"].first()
    assert (cover.reports_downloaded, cover.indexes_completed, cover.period_complete_groups, cover.report_acquisition_complete_for_selected) == (2, 2, 1, True)
    assert [r.relevant_reports for r in run["indexes"].orderBy("year").collect()] == [1, 1]
    assert run["period_summary"].first().period_total == 4
    problems, result = verify_folder(spark, out, SELECTION)
    assert problems.collect() == [] and result.first().passed and result.first().report_files_checked == 2
    # Corrupt only the derived total.
    bad = run["period_summary"].withColumn("period_total", F.lit(123.0))
    broken = str(tmp_path / "bad")
    bad.write.parquet(broken)
    from periodledger.operators.audit import check_totals

    assert [r.kind for r in check_totals(spark.read.parquet(broken), SELECTION).collect()] == ["total_arithmetic"]
    with pytest.raises(ContractMismatch, match="periods"):
        guard_contract(spark, f"{out}/contract", contract_rows(spark, select_time(years=[2024]), {"mode": "company", "name": "Plant"}))
    with pytest.raises(ContractMismatch, match="name"):
        guard_contract(spark, f"{out}/contract", contract_rows(spark, SELECTION, {"mode": "company", "name": "Other"}))
    guard_contract(spark, f"{out}/contract", contract_rows(spark, SELECTION, {"mode": "company", "name": "Plant"}))
    # Comparison of the run with itself, and with a copy that misses a row.
    mine = {"records": run["air_records"], "manifest": run["manifest"]}
    assert compare_runs(mine, mine, same_selection=True, both_finished=True)[0].first().equal
    less = {**mine, "records": mine["records"].where("month <> 12 or month is null")}
    verdict, difference = compare_runs(mine, less, same_selection=True, both_finished=True)
    assert not verdict.first().equal and verdict.first().air_report_hashes_equal
    assert {r.side for r in difference_samples(difference, mine["records"], less["records"], ["access_utc", "path", "retrieved_at", "download_path"]).collect()} == {"left_only"}
    assert set(load_run(spark, out)) >= {"air_records", "coverage"}


def test_multisets_count_copies_and_nulls(spark):
    left = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    right = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "a int, b string")
    assert sorted((r.left_count, r.right_count) for r in multiset_difference(left, right).collect()) == [(0, 1), (2, 1)]
    difference = multiset_difference(left, right)
    assert [(r.side, r.row) for r in difference_samples(difference, left, right).collect()] == [("right_only", '{"a":3,"b":"y"}')]


def test_csv_and_json_sinks(spark, tmp_path):
    df = spark.range(1).selectExpr("id", "named_struct('b', null, 'a', '中\"') as s", "array(1, 2) as l", "map('z', 1, 'a', 2) as m")
    write_csv(df, str(tmp_path / "c"))
    r = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "c")).first()
    assert (r.s, r.l, r.m) == ('{"b":null,"a":"中\\""}', "[1,2]", '{"a":2,"z":1}')
    write_json(df.selectExpr("id", "cast(null as string) as n").coalesce(1), str(tmp_path / "j"))
    (part,) = [f for f in os.listdir(tmp_path / "j") if f.endswith(".json")]
    assert json.loads((tmp_path / "j" / part).read_text()) == {"id": 0, "n": None}


def test_ingest_appends_once(spark):
    cols = "permit_code string, reportId string, provinceSharding string, yearSharding string, source_url string, air_sha256 string"
    store = spark.createDataFrame([("P", "a", "p", "y", "u", "1"), ("P", "b", "p", "y", "u", "2")], cols)
    new = spark.createDataFrame([("P", "a", "p", "y", "u", "1"), ("P", "b", "p", "y", "u", "9"), ("P", "c", "p", "y", "u", "3"), ("P", "c", "p", "y", "u", "3"),
                                 ("P", "d", "p", "y", "u", "4"), ("P", "d", "p", "y", "v", "4")], cols)
    append, conflicts = ingest_new(new, store)
    assert [r.reportId for r in append.collect()] == ["c"]
    assert {r.reportId: r.reason for r in conflicts.collect()} == {"b": "differs_from_store", "d": "copies_differ"}


def test_url_identity(spark):
    good = "https://r.example/#/pubView?reportId=" + "a" * 32 + "&provinceSharding=" + "b" * 40 + "&yearSharding=" + "c" * 64
    urls = [good, good.replace("a" * 32, "A" * 32), good.replace("&yearSharding", "&other"), "https://r.example/x.pdf", None]
    got = with_url_identity(spark.createDataFrame([(u,) for u in urls], "doc_url string")).collect()
    assert [r.url_status for r in got] == ["ok", "invalid_identifier", "invalid_identifier", "unsupported_format", "unsupported_format"]


def test_stream_appends_refreshes_and_reopens(spark, tmp_path):
    store = ReportStore(spark, str(tmp_path / "store"), SELECTION, buckets=4)

    def arrive(name, entries):
        rows = []
        for permit, rid, b in entries:
            rows.append((permit, b, json.dumps({"report_id": rid, "permit_code": permit}), json.dumps({"enterprise_id": "E" + permit, "permit_code": permit})))
        df = spark.createDataFrame(rows, "permit_code string, body string, m string, e string").select(
            "permit_code", F.get_json_object("m", "$.report_id").alias("reportId"), F.lit("p").alias("provinceSharding"), F.lit("y").alias("yearSharding"),
            F.concat(F.lit("E"), "permit_code").alias("enterprise_id"), F.lit("u").alias("source_url"), content_hash(F.col("body")).alias("air_sha256"), "body",
            F.from_json("m", "map<string,string>").alias("meta"), F.from_json("e", "map<string,string>").alias("enterprise"))
        df.select(*ARRIVAL_SCHEMA.names).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        follow(store, str(tmp_path / "in"), str(tmp_path / "cp")).awaitTermination()
        return {r.enterprise_id: (r.status, r.period_total) for r in store.table("period_summary").collect()}

    text = lambda *a, permit="P1", **k: json.dumps({**_quarterly(*a, **k), "companyInfo": {**_quarterly(*a, **k)["companyInfo"], "permitCode": permit}}, ensure_ascii=False)
    first = arrive("1", [("P1", "a", text(2023, 4)), ("P2", "b", text(2023, 4, permit="P2"))])
    assert first == {"EP1": ("incomplete", None), "EP2": ("incomplete", None)}
    second = arrive("2", [("P1", "c", text(2024, 1)), ("P1", "a", text(2023, 4))])
    assert second == {"EP1": ("complete", 4.0), "EP2": ("incomplete", None)}
    assert store.reports().count() == 3
    third = arrive("3", [("P1", "late", text(2024, 1, value="7"))])
    assert third["EP1"] == ("conflict", None)
    arrive("4", [("P1", "late", text(2024, 1, value="8"))])
    assert [r.reason for r in store.table("conflicts").collect()] == ["differs_from_store"] and store.reports().count() == 4
    kept, totals = store.table("records").count(), sorted(map(repr, store.table("period_summary").collect()))
    store.take(spark.read.schema(ARRIVAL_SCHEMA).parquet(str(tmp_path / "in")), 99)  # everything once more
    assert store.reports().count() == 4 and store.table("records").count() == kept
    store.take(spark.read.schema(ARRIVAL_SCHEMA).parquet(str(tmp_path / "in")).where("reportId = 'late'").limit(0), 2)  # a batch may be empty
    assert sorted(map(repr, store.table("period_summary").collect())) == totals


@pytest.mark.parametrize("salts", [1, 4])
def test_two_rows_of_an_enterprise_do_not_double_its_reports(spark, salts):
    reports = spark.createDataFrame([("r1", "e1"), ("r2", "e1"), ("r3", "e9"), ("r4", None)], "report_id string, enterprise_id string")
    enterprises = spark.createDataFrame([("e1", "B", "P2"), ("e1", "A", "P1"), ("e2", None, "P3")], "enterprise_id string, name string, permit_code string")
    got = {r.report_id: r.enterprise for r in attach_enterprises(reports, enterprises, salts=salts).collect()}
    one = {"enterprise_id": "e1", "name": "A", "permit_code": "P1"}
    assert got == {"r1": one, "r2": one, "r3": None, "r4": None}
    assert [tuple(r) for r in surplus_rows(enterprises).collect()] == [("e1", 1)]


@pytest.mark.parametrize("known", [True, False])
def test_small_files_are_written_by_all_tasks_without_companions(spark, tmp_path, monkeypatch, known):
    if not known:  # a file system that only Spark can open
        def refuse(_):
            raise sinks.pa.ArrowInvalid("unknown")
        monkeypatch.setattr(sinks, "fs", SimpleNamespace(FileSystem=SimpleNamespace(from_uri=refuse)))
    rows = [(1, "body", "é\nx"), (1, "origin", "{}"), (2, "body", ""), (None, "body", "n"), (2, "body", "b")] + [(i, "body", "t") for i in range(3, 60)]
    sinks.write_files(spark.createDataFrame(rows, "doc_id long, kind string, value string").coalesce(1), f"file://{tmp_path}/out", by=["doc_id", "kind"])
    found = {}
    for at in (tmp_path / "out").glob("doc_id=*/kind=*/part-*"):
        found.setdefault("/".join(at.parts[-3:-1]), []).append(at.read_bytes())
    assert len(found) == 61 and all(len(files) == 1 for files in found.values())
    assert found["doc_id=1/kind=body"] == ["é\nx\n".encode()] and found["doc_id=1/kind=origin"] == [b"{}\n"]
    assert sorted(found["doc_id=2/kind=body"][0].splitlines()) == [b"", b"b"] and found[f"doc_id={sinks.NO_KEY}/kind=body"] == [b"n\n"]
    assert not known or not list((tmp_path / "out").rglob("*.crc"))


def _put(top, files):
    for at, content in files.items():
        (top / at).parent.mkdir(parents=True, exist_ok=True)
        (top / at).write_bytes(content)


def test_the_tasks_of_a_scan_do_not_grow_with_the_files(spark, tmp_path):
    tasks = {}
    for n in (2, 300):
        _put(tmp_path / str(n), {f"reports/{i}/{name}": b"{}" for i in range(n) for name in ("air_report.json", "provenance.json")})
        spark.sparkContext.setJobGroup(f"scan of {n}", "")
        try:
            found = scan_report_files(spark, str(tmp_path / str(n))).groupBy("file_status").count().collect()
        finally:
            for name in ("spark.jobGroup.id", "spark.job.description"):
                spark.sparkContext.setLocalProperty(name, None)
        assert [tuple(r) for r in found] == [("paired", n)]
        seen = spark.sparkContext.statusTracker()
        stages = {stage for job in seen.getJobIdsForGroup(f"scan of {n}") for stage in seen.getJobInfo(job).stageIds}
        tasks[n] = sum(info.numCompletedTasks for stage in stages if (info := seen.getStageInfo(stage)))
    assert 0 < tasks[300] <= tasks[2] + 8  # listing took a task for each file


@pytest.mark.parametrize("bodies, metas, key", [
    ("reports/*/air_report.json", "reports/*/provenance.json", r"([^/]+)/[^/]+$"), ("parts/k=*/body/*", "parts/k=*/meta/part-?", "k=([^/]+)/"),
    ("reports/plain/air_report.json", "reports/*/provenance.json", "^(.*)$")])
def test_files_are_found_by_tasks_as_by_the_reader_of_spark(spark, tmp_path, monkeypatch, bodies, metas, key):
    names = ["plain", "a b", "50%", "a%20b", "x#y", "ä中", "q?m", "br[1]", "cu{r}", 'q"t', "b\\s", ".hidden", "_under", "ca^ret", "wide\u3000space"]
    _put(tmp_path, {f"reports/{n}/{file}": content for n in names for file, content in
                    (("air_report.json", f"body {n}\r\n".encode()), ("provenance.json", b'{"permit_code":"P","report_id":"r"}'))})
    _put(tmp_path, {"reports/empty/air_report.json": b"", "reports/empty/provenance.json": b"{}", "reports/loose.txt": b"x", "reports/bare/air_report.json": b"x",
                    "reports/folder/air_report.json/inner": b"i", "reports/folder/air_report.json/.inner": b"i", "reports/folder/air_report.json/deep/er": b"i",
                    "reports/odd/air_report.json": b"x", "reports/odd/provenance.json": b"no json"})
    _put(tmp_path, {f"parts/k=1/{file}": file.encode() for file in ("body/part-0", "body/part-1", "body/.part-2", "body/_x", "body/_x=1", "body/y._COPYING_", "meta/part-0",
                                                                    "meta/part-1", "meta/part-10")})
    _put(tmp_path, {"parts/k=2/body/part-0": b"x", "parts/k=3/meta/part-0": b'{"report_id":"r"}'})
    for name, target in (("dangling", "nowhere"), ("loop", "reports/loop")):
        os.symlink(tmp_path / target, tmp_path / "reports" / name)
    os.symlink(tmp_path / "reports" / "plain", tmp_path / "reports" / "link")
    scanned = lambda folder: sorted(map(repr, scan_report_files(spark, folder, bodies=bodies, metas=metas, key=key).collect()))
    found = [scanned(f"{scheme}{tmp_path}{end}") for scheme, end in (("", ""), ("file:", "/"), ("file://", ""))]
    assert "BinaryFile" not in scan_report_files(spark, str(tmp_path), bodies=bodies, metas=metas, key=key)._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(reports, "local_folder", lambda *_: None)
    assert found == [scanned(str(tmp_path))] * 3 and len(found[0]) >= 5


def _denied(_):
    raise PermissionError(13, "denied")


def test_folders_without_reports_and_corrupt_files_are_refused(spark, tmp_path, monkeypatch):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        scan_report_files(spark, str(tmp_path / "none"))
    _put(tmp_path, {"reports/a/air_report.json": b"{}"})
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND.*provenance"):
        scan_report_files(spark, str(tmp_path))
    spark.range(1).selectExpr("repeat('abc', 500) as value").coalesce(1).write.text(str(tmp_path / "out" / "a"))  # with a checksum file
    (at,) = (tmp_path / "out" / "a").glob("part-*")
    found = scan_report_files(spark, str(tmp_path), bodies="out/*/part-*", metas="reports/*/air_report.json", key="/([^/]+)/[^/]+$")
    assert [(r.report_key, len(r.body), r.file_status) for r in found.collect()] == [("a", 1501, "paired")]
    monkeypatch.setattr(files.os, "listdir", _denied)  # a folder that cannot be listed is not an empty one
    with pytest.raises(PermissionError):
        files.any_match(str(tmp_path), "reports/*/air_report.json")
    monkeypatch.undo()
    at.write_bytes(at.read_bytes()[:700] + b"X" + at.read_bytes()[701:])
    with pytest.raises(Exception, match="checksum"):
        found.collect()
