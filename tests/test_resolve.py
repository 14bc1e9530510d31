import random
from decimal import Decimal

import pytest
from conftest import filing, line, reports_df
from pyspark.sql import functions as F

from periodledger.operators.flatten import flatten_reports
from periodledger.operators.resolve import lineage, months_of, resolve_months, selected_sources, summarize_native, summarize_period
from periodledger.operators.timeselect import requested_rows, select_time
from periodledger.sources.scratch import materialize

SUMMER = select_time(years=[2024], months=[6, 7, 8])


def month(m, value, rid=None, year=2024, **more):
    return filing(f"{year}年{m:02d}月", "月报", [line(value, **more)]), {"report_id": rid or f"m-{year}-{m}"}


def quarter(q, rid="quarter", year=2024, **fields):
    return filing(f"{year}年第{q}季", "季报", [line(**fields)], reportQuarter=q), {"report_id": rid}


def annual(total, **more):
    return filing("2024年", "年报", [line(total=total, **more)]), {"report_id": "annual"}


LONG = "12345678901234567890.1234567890123456789012345"  # 45 digits
SMALL = "0." + "0" * 9 + LONG.replace(".", "")


CASES = {
    "priority": [month(6, "0.1"), month(7, "0.2"), month(8, "0.3"), quarter(3, firstMonth="9", secondMonth="9")],
    "revision": [month(6, "1"), month(7, "2", "old"), month(7, "3", "new"), month(8, "4"), quarter(3, firstMonth="3", secondMonth="4")],
    "agreeing": [month(6, "1"), month(7, "2", "old"), month(7, "2.0", "new"), month(8, "3")],
    "duplicate": [month(6, "1"), month(8, "3"), (filing("2024年07月", "月报", [line("2"), line("2")]), {"report_id": "dup"})],
    "repeat": [month(6, "1"), month(6, "1"), month(7, "2"), month(8, "3")],
    "units": [month(6, "1", unit="吨"), month(7, "1000", unit="kg"), month(8, "1", unit="吨")],
    "unknown": [month(m, "1", name="未知指标", code="X") for m in (6, 7, 8)],
    "annual only": [annual("120", january="10")],
    "zero": [month(6, "0"), month(7, "/"), month(8, "1")],
    "wide": [month(6, "1e300"), month(7, "1e300"), month(8, "1e-400")],
    "wide clash": [month(6, "1e300"), month(6, "2e300", "other"), month(7, "1"), month(8, "1")],
    "deep clash": [month(6, "1.0000000000000000000000000000000000000000001"), month(6, "1", "other"), month(7, "1"), month(8, "1")],
    "long": [month(6, LONG), month(7, LONG[:-2] + "0"), month(8, SMALL), quarter(3, firstMonth=LONG + "7", secondMonth="4")],
    "long clash": [month(6, LONG), month(6, LONG[:-1] + "8", "other"), month(7, LONG), month(8, LONG[:40] + "e5"), annual(LONG)],
    "quarter fills": [month(6, "1"), quarter(3, firstMonth="2", secondMonth="3")],
    "unidentified": [(filing("2024年06月", "月报", [line("1")]), {}), (filing("2024年06月", "月报", [line("9", "DA002"), line("1")]), {}), month(7, "1"), month(8, "1")],
}


@pytest.fixture(scope="module")
def records(spark):
    reports = [(c, b, m, {"enterprise_id": c, "permit_code": "P1"}) for c, parts in CASES.items() for b, m in parts]
    df = flatten_reports(reports_df(spark, reports), keys=["case"])
    df.cache()
    return df


@pytest.fixture(scope="module")
def summary(records):
    rows = summarize_period(records, SUMMER).collect()
    return {k: [r for r in rows if r.enterprise_id == k] for k in CASES}


def test_complete_sum_prefers_months_and_reports_disagreement(summary):
    (g,) = summary["priority"]
    assert (g.period_total_decimal, g.complete, g.status) == ("0.6", True, "complete")
    assert (g.months[1].selected_priority, g.months[1].lower_priority_disagreement, g.months[1].candidate_count) == ("month", True, 2)


def test_conflicts_block_without_fallback(summary):
    (g,) = summary["revision"]
    assert (g.conflict_periods, g.period_total, g.status) == (["2024-07"], None, "conflict")
    assert g.months[1].conflict_reasons == ["same_priority_value_conflict"]
    (d,) = summary["duplicate"]
    assert d.months[1].conflict_reasons == ["duplicate_scope_rows"] and not d.complete
    assert summary["wide clash"][0].conflict_periods == ["2024-06"]
    assert summary["deep clash"][0].conflict_periods == ["2024-06"]


def test_agreeing_sources_all_count(summary, records):
    (g,) = summary["agreeing"]
    assert (g.period_total, g.months[1].source_count) == (6, 2)
    rows = lineage(records, SUMMER).where("enterprise_id in ('agreeing', 'repeat')")
    chosen = {(r.enterprise_id, r.period): r.n for r in selected_sources(rows).groupBy("enterprise_id", "period").agg(F.count("*").alias("n")).collect()}
    assert chosen[("agreeing", "2024-07")] == 2 and chosen[("repeat", "2024-06")] == 1
    assert summary["repeat"][0].complete


def test_units_and_unknowns_stay_apart(summary):
    assert {g.unit for g in summary["units"]} == {"t", "kg"} and all(g.period_total is None for g in summary["units"])
    (u,) = summary["unknown"]
    assert u.unit is None and u.missing_periods == list(SUMMER.periods) and u.months[0].status == "ineligible"


def test_gaps_and_zeros(summary):
    (a,) = summary["annual only"]
    assert a.missing_periods == list(SUMMER.periods) and {m.status for m in a.months} == {"missing"}
    (z,) = summary["zero"]
    assert (z.months[0].value, z.missing_periods, z.period_total) == (0, ["2024-07"], None)


def test_values_beyond_fixed_decimals(summary):
    (g,) = summary["wide"]
    assert g.period_total_decimal == "2.000000000000000000000000000E+300" and g.complete


def test_no_digit_is_lost_however_many_there_are(summary, records):
    (g,) = summary["long"]
    assert [m.value_decimal for m in g.months] == [LONG, LONG[:-2] + "0", str(Decimal(SMALL))]
    assert g.period_total_decimal == "24691357802469135780.24691358" and g.months[0].lower_priority_disagreement is False and g.months[1].lower_priority_disagreement
    (c,) = summary["long clash"]
    assert [(m.status, m.value_decimal) for m in c.months] == [
        ("conflict", None), ("selected", LONG), ("selected", str(Decimal(LONG[:40] + "e5")))]
    (n,) = summarize_native(records.where("enterprise_id = 'long clash'"), SUMMER).collect()
    assert (n.period_kind, n.status, n.value_decimal) == ("year", "selected", LONG)


def test_quarter_fields_fill_months(summary):
    (g,) = summary["quarter fills"]
    assert g.period_total == 6 and [m.selected_priority for m in g.months] == ["month", "quarter", "quarter"]


def test_reports_without_identity_are_one_document(summary):
    g = next(g for g in summary["unidentified"] if g.outlet_key == "DA001")
    assert g.months[0].conflict_reasons == ["duplicate_scope_rows"]


def test_partial_months_and_cross_year(spark):
    parts = [month(12, "0.1", year=2023), month(1, "0.2"), month(2, "0.3"), annual("99", firstMonth="777"), quarter(1, "q", firstMonth="10", secondMonth="20", thirdMonth="30", total="60")]
    rows = flatten_reports(reports_df(spark, [("x", b, m, {}) for b, m in parts])).cache()
    g = summarize_period(rows, select_time(start="2023-12", end="2024-02")).first()
    assert (g.period_total_decimal, [m.period for m in g.months]) == ("0.6", ["2023-12", "2024-01", "2024-02"])
    p = summarize_period(rows, select_time(start="2024-01-15", end="2024-02-20")).first()
    assert (p.month_coverage_complete, p.complete, p.status, p.period_total, p.covered_full_months_total) == (True, False, "granularity_mismatch", None, 0.5)
    year = {r.period_kind: r for r in summarize_native(rows, select_time(years=[2024])).collect()}
    assert (year["year"].value, year["year"].exactly_matches_request, year["quarter"].value, year["quarter"].fully_within_requested_months) == (99, True, 60, True)
    narrow = {r.period_kind: r for r in summarize_native(rows, select_time(periods=["2024-02"])).collect()}
    assert not narrow["quarter"].fully_within_requested_months and not narrow["quarter"].exactly_matches_request
    kept = requested_rows(rows, select_time(periods=["2024-03"])).collect()
    assert sorted(r.field for r in kept) == ["thirdMonth", "total", "total"]


def test_scopes_permits_outlets_stay_apart(spark):
    reports = []
    for m in (6, 7, 8):
        for permit in ("P1", "P2"):
            whole = line("3", "", part="airTotalEmission", portType="全厂合计")
            b = filing(f"2024年{m}月", "月报", [line("1"), line("2", "DA002"), whole], permitCode=permit)
            reports.append(("x", b, {"report_id": f"{permit}-{m}"}, {"enterprise_id": "E1", "permit_code": permit}))
    got = summarize_period(flatten_reports(reports_df(spark, reports)), SUMMER).collect()
    assert sorted(g.period_total for g in got) == [3, 3, 6, 6, 9, 9]


# --- against brute force ---------------------------------------------------------------

def _random_records(spark, seed, n=4000):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = rng.random() < .35  # one group and month holds a third of all records
        kind = rng.choice(["month", "month", "quarter"])
        rows.append((
            "E0" if hot else f"E{rng.randrange(40)}", "P", "code:A", "main_outlet", "D", rng.choice(["", "n"]), "t" if rng.random() < .9 else None,
            rng.choice(["r1", "r2", "", f"r{i % 7}"]), rng.choice(["u", ""]), kind, 2024, 1 if hot else rng.randrange(1, 5), "month",
            rng.choice(["/p/0", "/p/0", "/p/0", "/p/1"]), "5" if rng.random() < .8 else rng.choice(["5.0", "6", "/"])))
    cols = ("enterprise_id string, permit_code string, pollutant_key string, scope string, outlet_code string, outlet_name string, unit string,"
            " report_id string, source_url string, report_type string, year int, month int, period_kind string, row_json_pointer string, clean string")
    df = spark.createDataFrame(rows, cols).withColumn("p", F.lit(True))
    from periodledger.functions.numbers import with_number

    df = with_number(df, clean="clean", raw="clean", present="p")
    null = F.lit(None)
    return rows, materialize(df.withColumns({
        "aggregation_eligible": F.col("value_decimal").isNotNull(), "report_quarter": null.cast("int"), "source_row_report_id": F.lit(""),
        "json_pointer": F.col("row_json_pointer"), "enterprise_name": F.lit("n"), "pollutant_code": F.lit("A"), "pollutant_name": F.lit("A"), "dimension": F.lit("mass")}), "random")


def _brute(rows, periods):
    groups = {}
    for r in rows:
        groups.setdefault((r[0], r[6]), []).append(r)
    found = {}
    for key, members in groups.items():
        for period in periods:
            mine = [r for r in members if f"{r[10]}-{r[11]:02d}" == period]
            valid = [r for r in mine if r[14] != "/"]
            pool = [r for r in valid if r[9] == "month"] or [r for r in valid if r[9] == "quarter"]
            docs = {}
            for r in pool:
                docs.setdefault(r[7] or r[8] or "unidentified_report", set()).add(r[13])
            values = {Decimal(r[14]) for r in pool}
            clash = len(values) > 1 or any(len(d) > 1 for d in docs.values())
            status = "conflict" if clash else "selected" if pool else "ineligible" if mine else "missing"
            disagrees = status == "selected" and any(Decimal(r[14]) not in values for r in valid)
            found[(*key, period)] = (status, float(min(values)) if status == "selected" else None, disagrees, len(mine))
    return found


@pytest.mark.parametrize("seed", [1, 2])
def test_resolver_agrees_with_brute_force_under_skew(spark, seed):
    rows, df = _random_records(spark, seed)
    selection = select_time(years=[2024], months=[1, 2, 3])
    keys = {(r[0], r[6]) for r in rows if r[11] <= 3}
    want = {k: v for k, v in _brute(rows, selection.periods).items() if k[:2] in keys}
    got = {(r.enterprise_id, r.unit, r.period): (r.status, r.value, r.lower_priority_disagreement, r.candidate_count)
           for r in resolve_months(df.repartition(5), selection).collect()}
    assert got == want
    # Order does not matter, and a further copy of a row never completes a group.
    complete = lambda d: {(r.enterprise_id, r.unit) for r in summarize_period(d, selection).where("complete").collect()}
    before = complete(df)
    assert complete(df.orderBy(F.rand(3))) == before
    extra = df.limit(200).withColumn("row_json_pointer", F.lit("/p/copy"))
    assert complete(df.unionByName(extra)) <= before


def test_hot_records_are_reduced_before_they_are_shuffled(spark):
    _, df = _random_records(spark, 3, 200)
    plan = summarize_period(df, SUMMER)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    # Every exchange directly follows a partial aggregate.
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            assert "Aggregate" in lines[i + 1] and "partial" in lines[i + 1] or "keys=" in lines[i + 1], lines[i + 1]
    assert months_of(summarize_period(df, SUMMER)).columns
