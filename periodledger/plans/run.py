"""A whole run: report bodies to audited tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodledger.operators.audit import verify_run
from periodledger.operators.coverage import coverage
from periodledger.operators.flatten import flatten_reports, rejected_bodies
from periodledger.operators.resolve import summarize_native, summarize_period
from periodledger.operators.timeselect import TimeSelection, partition_kinds, requested_rows
from periodledger.sources.sinks import contract_rows, guard_contract, write_table

TABLES = ["manifest", "enterprises", "indexes", "reports", "rejected_reports", "air_records", "air_monthly_rows", "air_native_period_rows",
          "period_summary", "native_period_summary", "coverage"]


def collect_run(spark: SparkSession, out: str, *, selection: TimeSelection, reports: DataFrame, manifest: DataFrame,
                enterprises: DataFrame, indexes: DataFrame, query: dict[str, str | None], mode: str = "company",
                discovery: DataFrame | None = None) -> dict[str, DataFrame]:
    """Extract, resolve and write a run under ``out``; returns its tables.

    Bodies are parsed once: everything after ``air_records`` reads that table.
    """
    guard_contract(spark, f"{out}/contract", contract_rows(spark, selection, query))
    for name, table in (("manifest", manifest), ("enterprises", enterprises), ("indexes", indexes), ("reports", reports)):
        write_table(table, f"{out}/{name}")
    tables = load_run(spark, out, ["manifest", "enterprises", "indexes", "reports"])
    records = requested_rows(flatten_reports(tables["reports"], selection=selection), selection)
    write_table(records, f"{out}/air_records", partition_by=["period_kind"])
    write_table(rejected_bodies(tables["reports"], ["permit_code", "report_id"]), f"{out}/rejected_reports")
    written = spark.read.parquet(f"{out}/air_records")
    monthly, native_rows = partition_kinds(written)
    write_table(monthly, f"{out}/air_monthly_rows")
    write_table(native_rows, f"{out}/air_native_period_rows")
    write_table(summarize_period(written, selection), f"{out}/period_summary")
    write_table(summarize_native(native_rows, selection), f"{out}/native_period_summary")
    done = load_run(spark, out, [t for t in TABLES if t != "coverage"])
    write_table(coverage(
        mode=mode, selection=selection, enterprises=done["enterprises"], indexes=done["indexes"], manifest=done["manifest"],
        records=done["air_records"], summary=done["period_summary"], native=done["native_period_summary"],
        discovery=discovery), f"{out}/coverage")
    return load_run(spark, out, TABLES)


def load_run(spark: SparkSession, out: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{out}/{name}") for name in names or TABLES}


def verify_folder(spark: SparkSession, out: str, selection: TimeSelection) -> tuple[DataFrame, DataFrame]:
    """Readback of a written run: problems and the result row."""
    run = load_run(spark, out)
    return verify_run(
        manifest=run["manifest"], stored=run["reports"].select("permit_code", "report_id", "body", "meta", "enterprise"),
        records=run["air_records"], monthly=run["air_monthly_rows"], native_rows=run["air_native_period_rows"],
        summary=run["period_summary"], native=run["native_period_summary"], selection=selection)


def manifest_of(reports: DataFrame, status: str = "downloaded") -> DataFrame:
    """Manifest entries of stored reports."""
    return reports.select("enterprise_id", "permit_code", "report_id", F.lit(status).alias("status"), "air_sha256")
