"""Report-shaped inputs derived from the star-schema tables.

A supplier block is an enterprise, a line item a reported quantity. Every derivation is a
Spark job over whole tables, so the amount of reports grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from periodledger import vocab
from periodledger.functions.numbers import with_number

SUPPLIERS_PER_ENTERPRISE = 5
POLLUTANTS = [("A21002", "氮氧化物", None), ("A21026", "二氧化硫", None), ("A99911", "颗粒物", None),
              ("/", "工业废气排放量", "单位：万Nm³")]
REPORT_KEY = ["e", "t", "y", "per", "rev"]
ROW_KEY = [*REPORT_KEY, "p", "o", "dup"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(options: list, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), (index + 1).cast("int"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as reported quantities with report type, revision and duplicate marks."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate")
    order = F.col("l_orderkey")
    return li.select(
        F.expr(f"cast(l_suppkey div {SUPPLIERS_PER_ENTERPRISE} as bigint)").alias("e"),
        F.year("l_shipdate").alias("y"), F.month("l_shipdate").alias("m"), F.quarter("l_shipdate").alias("quarter"),
        (F.col("l_partkey") % 4).cast("int").alias("p"), (F.col("l_linenumber") % 2).cast("int").alias("o"),
        F.when(order % 10 < 6, "month").when(order % 10 < 9, "quarter").otherwise("year").alias("t"),
        F.when(order % 97 == 0, "r2").otherwise("r1").alias("rev"),
        F.when(order % 89 == 1, 1).otherwise(0).alias("dup"),
        F.col("l_quantity").cast("bigint").alias("q"))


def cells(spark: SparkSession, sf_dir: str, by_report: bool = False) -> DataFrame:
    """One reported value: a field of a row of a report. ``by_report`` brings the lines of a report together beforehand, so that
    its cells, rows and body are made without a further shuffle; there are fewer lines than cells."""
    none = F.lit(None).cast("int")
    cell = lambda field, m: F.struct(field.alias("field"), m.alias("m"))
    total = F.lit(vocab.TOTAL_FIELD)
    fields = (
        F.when(F.col("t") == "month", F.array(cell(F.lit(vocab.MONTH_FIELD), F.col("m"))))
        .when(F.col("t") == "quarter", F.array(
            cell(_pick(vocab.QUARTER_FIELDS, (F.col("m") - 1) % 3), F.col("m")), cell(total, none)))
        .otherwise(F.array(cell(total, none)))
    )
    per = F.when(F.col("t") == "month", F.col("m")).when(F.col("t") == "quarter", F.col("quarter")).otherwise(0)
    placed = lines(spark, sf_dir).withColumn("per", per.cast("int"))
    if by_report:
        placed = placed.repartition(*REPORT_KEY)
    wide = placed.withColumn("c", F.explode(fields)).select("*", "c.field", F.col("c.m").alias("cell_month"))
    summed = wide.groupBy(*ROW_KEY, "field", F.col("cell_month").alias("m")).agg(F.sum("q").alias("v"))
    e, m, p = F.col("e"), F.coalesce(F.col("m"), F.lit(0)), F.col("p")
    return summed.withColumn("value_raw", F.when((e * 7 + m * 3 + p) % 23 == 0, "/").when((e + m + p) % 29 == 0, "-1")
                             .when((e + m * 5 + p) % 31 == 0, "0").otherwise(F.col("v").cast("string")))


def _report_columns() -> dict[str, Column]:
    e, per, y = F.col("e").cast("string"), F.col("per").cast("string"), F.col("y").cast("string")
    quarter = F.when(F.col("e") % 2 == 1, F.lpad(per, 2, "0")).otherwise(per)
    return {
        "enterprise_id": F.concat(F.lit("E"), e),
        "filed_permit": F.concat(F.lit("P"), e),
        "permit_code": F.concat(F.when(F.col("e") % 9 == 8, "X").otherwise("P"), e),
        "report_id": F.concat_ws("|", "t", e, y, per, "rev"),
        "report_time": F.when(F.col("t") == "month", F.concat(y, F.lit("年"), F.lpad(per, 2, "0"), F.lit("月")))
        .when(F.col("t") == "quarter", F.concat(y, F.lit("年第"), quarter, F.lit("季")))
        .otherwise(F.concat(y, F.lit("年年报"))),
    }


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long records straight from the cells, as the resolver takes them."""
    # The number first: its steps pass on every column a row has by then.
    step = cells(spark, sf_dir).withColumn("_present", F.lit(True))
    step = with_number(step, clean="value_raw", raw="value_raw", present="_present")
    step = step.withColumns(_report_columns())
    code, name = _pick([c for c, _, _ in POLLUTANTS], F.col("p")), _pick([n for _, n, _ in POLLUTANTS], F.col("p"))
    volume = F.col("p") == 3
    row = F.concat(F.lit("/emissionInfo/airMainEmission/"), (F.col("p") * 2 + F.col("o")).cast("string"),
                   F.lit("#"), F.col("dup").cast("string"))
    step = step.withColumns({
        "enterprise_name": F.concat(F.lit("Enterprise "), F.col("e").cast("string")),
        "report_type": F.col("t"), "year": F.col("y"), "month": F.col("m"),
        "report_quarter": F.when(F.col("t") == "quarter", F.col("per")),
        "period_kind": F.when(F.col("m").isNotNull(), "month").otherwise(F.col("t")),
        "pollutant_code": code, "pollutant_name": name,
        "pollutant_key": F.when(volume, F.concat(F.lit("name:"), name)).otherwise(F.concat(F.lit("code:"), code)),
        "scope": F.lit("main_outlet"), "outlet_code": F.concat(F.lit("DA00"), (F.col("o") + 1).cast("string")),
        "outlet_name": F.lit(""), "unit": F.when(volume, "万Nm3").otherwise("t"),
        "dimension": F.when(volume, "volume").otherwise("mass"),
        "unit_raw": F.when(volume, "万Nm3").otherwise("吨"),
        "unit_source": F.when(volume, "row.remark").otherwise(vocab.TEMPLATE_SOURCE_OTHER),
        "unit_status": F.when(volume, "known").otherwise("template_default"),
        "row_json_pointer": row, "json_pointer": F.concat(row, F.lit("/"), F.col("field")), "row_id": F.lit(""),
        "source_url": F.lit(""), "source_row_report_id": F.lit(""), "report_submit_time": F.lit(None).cast("string"),
        "identity_conflicts": F.when(F.col("e") % 9 == 8, F.array(F.lit("permit_code_mismatch")))
        .otherwise(F.expr("cast(array() as array<string>)")),
        "pollutant_identity_conflict": F.lit(False), "schema_warnings": F.expr("cast(array() as array<string>)"),
    })
    step = step.withColumn("aggregation_eligible", F.col("value_decimal").isNotNull() & (F.size("identity_conflicts") == 0))
    return step.drop("_present", *[c for c in ROW_KEY], "m", "v", "filed_permit")


def bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports as JSON bodies with provenance and enterprise.

    A report has at most 4 pollutants x 2 outlets x 2 copies = 16 rows of at most 4 fields, so
    the lists below are bounded.
    """
    rows = cells(spark, sf_dir, by_report=True).groupBy(*ROW_KEY).agg(F.map_from_entries(
        F.collect_list(F.struct("field", "value_raw"))).alias("fields"))
    code, name = _pick([c for c, _, _ in POLLUTANTS], F.col("p")), _pick([n for _, n, _ in POLLUTANTS], F.col("p"))
    fixed = F.create_map(
        F.lit("pollutantCode"), code, F.lit("pollutantName"), name,
        F.lit("outletCode"), F.concat(F.lit("DA00"), (F.col("o") + 1).cast("string")))
    remark = F.when(F.col("p") == 3, F.create_map(F.lit("remark"), F.lit(POLLUTANTS[3][2]))).otherwise(
        F.expr("cast(map() as map<string,string>)"))
    rows = rows.withColumn("row", F.to_json(F.map_concat(fixed, remark, F.col("fields"))))
    reports = rows.groupBy(*REPORT_KEY).agg(F.sort_array(F.collect_list(F.struct("p", "o", "dup", "row"))).alias("rows"))
    reports = reports.withColumns(_report_columns())
    word = F.when(F.col("t") == "month", "月报").when(F.col("t") == "quarter", "季报").otherwise("年报")
    reports = reports.withColumns({"word": word, "name": F.concat(F.lit("Enterprise "), F.col("e").cast("string"))})
    company = F.to_json(F.struct(
        F.col("word").alias("reportType"), F.col("report_time").alias("reportTime"),
        F.col("permit_code").alias("permitCode"), F.col("name").alias("enterName")))
    body = F.concat(
        F.lit('{"companyInfo":'), company, F.lit(',"emissionInfo":{"airMainEmission":['),
        F.array_join(F.transform("rows", lambda r: r["row"]), ","),
        F.lit('],"waterMainEmission":[{"pollutantName":"COD","emitValue":"1"}]}}'))
    return reports.select(
        "report_id", "enterprise_id", "filed_permit", "report_time", F.col("word").alias("type"), F.col("y").alias("report_year"),
        body.alias("body"),
        F.create_map(F.lit("report_id"), F.col("report_id"), F.lit("permit_code"), F.col("filed_permit"),
                     F.lit("report_period"), F.col("report_time"), F.lit("report_type"), F.col("word")).alias("meta"),
        F.create_map(F.lit("enterprise_id"), F.col("enterprise_id"), F.lit("name"), F.col("name"),
                     F.lit("permit_code"), F.col("filed_permit")).alias("enterprise"))


def index_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index listings of the reports, with varied period wording; some unreadable, some listed
    under another year than the one they report."""
    per = F.when(F.col("t") == "month", F.col("m")).when(F.col("t") == "quarter", F.col("quarter")).otherwise(0)
    reports = lines(spark, sf_dir).select("e", "t", "y", per.alias("per"), "rev").distinct()
    y, p, e = F.col("y").cast("string"), F.col("per").cast("string"), F.col("e")
    bad = (e + F.col("per")) % 7 == 3
    month = F.when(e % 3 == 0, F.concat(y, F.lit("年"), F.lpad(p, 2, "0"), F.lit("月"))).when(
        e % 3 == 1, F.concat(y, F.lit("年"), p, F.lit("月月报表"))).otherwise(F.concat(F.lit(" "), y, F.lit("年 "), p, F.lit(" 月")))
    quarter = F.when(e % 2 == 0, F.concat(y, F.lit("年第0"), p, F.lit("季度季报表"))).otherwise(F.concat(y, F.lit("年第"), p, F.lit("季")))
    year = F.when(e % 2 == 0, F.concat(y, F.lit("年年报表"))).otherwise(F.concat(y, F.lit("年")))
    wording = (
        F.when(F.col("t") == "month", F.when(bad, F.concat(y, F.lit("年13月"))).otherwise(month))
        .when(F.col("t") == "quarter", F.when(bad, F.concat(y, F.lit("年未知周期"))).otherwise(quarter))
        .otherwise(F.when(bad, F.lit("年报 12345")).otherwise(year))
    )
    return reports.select(
        F.concat(F.lit("E"), e.cast("string")).alias("enterprise_id"), F.concat(F.lit("P"), e.cast("string")).alias("permit_code"),
        F.concat_ws("|", "t", e.cast("string"), y, p, "rev").alias("report_id"), wording.alias("report_time"),
        F.when(F.col("t") == "month", "月报").when(F.col("t") == "quarter", "季报").otherwise("年报").alias("type"),
        F.when((e % 11 == 5) & (F.col("t") == "year"), F.col("y") + 1).otherwise(F.col("y")).alias("index_year"))
