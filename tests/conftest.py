import json
import os
import sys

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def line(amount=None, outlet="DA001", code="A21002", name="氮氧化物", part="airMainEmission", **cells):
    """One row of a report as a tuple: the section it stands in and its cells. Without ``amount`` it has no monthly value."""
    own = [("pollutantCode", code), ("pollutantName", name), ("outletCode", outlet), ("emitValue", amount)]
    return part, {**{k: v for k, v in own if v is not None}, **cells}


def filing(period, form, lines, **header):
    """A report body: ``lines`` are tuples of section and row, rows anything that JSON can hold."""
    sections = {}
    for part, cells in lines:
        sections.setdefault(part, []).append(cells)
    return {"emissionInfo": sections, "companyInfo": {"permitCode": "P1", "enterName": "Plant", "reportTime": period, "reportType": form, **header}}


def reports_df(spark, reports):
    """``reports``: (case, body, meta, enterprise) with plain dicts."""
    texts = [(c, b if isinstance(b, str) else json.dumps(b, ensure_ascii=False), json.dumps(m, ensure_ascii=False), json.dumps(e, ensure_ascii=False))
             for c, b, m, e in reports]
    df = spark.createDataFrame(texts, "case string, body string, m string, e string")
    return df.select("case", "body", F.from_json("m", "map<string,string>").alias("meta"), F.from_json("e", "map<string,string>").alias("enterprise"))
