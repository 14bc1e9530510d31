import random
import unicodedata
from decimal import Context, Decimal

from pyspark.sql import functions as F

from periodledger.functions.numbers import with_decimal_sum, with_number
from periodledger.functions.text import clean_python, clean_text, fold_key, fold_python

random.seed(7)


def parse(spark, raws):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "i int, raw string")
    df = df.withColumn("clean", clean_text(F.col("raw"))).withColumn("present", F.lit(True))
    return [r for r in with_number(df, clean="clean", raw="raw", present="present").orderBy("i").collect()]


def test_value_battery(spark):
    got = parse(spark, ["0", "/", "", None, "-1", "NaN", "Infinity", "1,234.5", "1,2", "1e-3", "true", "1,234,567", "12,34", "不适用", " 未填 ",
                        "N/A", "１２", "&#49;2", "5.", ".5", "+3", "0.00", "1e300", "2e308", "1e-400", "1e99999999999", "٣", "1_0", "1e5.0", "1\n", "0x1"])
    assert [r.value for r in got] == [
        0, None, None, None, None, None, None, 1234.5, None, 0.001, None, 1234567, None, None, None,
        None, 12, 12, 5, .5, 3, 0, 1e300, None, 0, None, 3, None, None, 1, None]
    assert [r.value_status for r in got[:5]] == ["reported_zero", "not_reported", "not_reported", "missing", "invalid"]
    assert got[13].value_status == "not_applicable" and got[24].value_status == "reported_numeric" and got[21].value_status == "reported_zero"


def test_absent_is_not_null(spark):
    df = spark.createDataFrame([("", None, False), ("", None, True)], "clean string, raw string, present boolean")
    assert [r.value_status for r in with_number(df, clean="clean", raw="raw", present="present").collect()] == ["not_reported", "missing"]


def test_decimal_text_and_parts_agree_with_decimal_arithmetic(spark):
    texts = []
    for _ in range(600):
        whole, part = str(random.randrange(10 ** random.randrange(1, 25))), "".join(random.choices("0123456789", k=random.randrange(0, 12)))
        texts.append("0" * random.randrange(3) + whole + (("." + part) if random.random() < .7 else "") + random.choice(["", "", f"e{random.randrange(-40, 40)}"]))
    for text, got in zip(texts, parse(spark, texts)):
        want = Decimal(text)
        assert got.value_decimal == str(want), text
        assert got.value == float(want)
        assert Decimal(f"{got.value_digits:f}E{got.value_exp}") == want
    twins = parse(spark, ["2", "2.0", "2.00", "20e-1", "0", "0.0", "0e7", "3"])
    assert len({r.value_id for r in twins[:4]}) == 1 and len({r.value_id for r in twins[4:7]}) == 1
    assert len({r.value_id for r in twins}) == 3


def test_decimal_sums_are_exact_and_wide_ones_rounded_like_decimals(spark):
    cases = [["0.1", "0.2", "0.3"], ["1.50", "1.50"], ["1e300", "1"], ["0", "0.00"], ["9" * 27, "0.5"], ["1e-7", "1e-7"], ["1E+3", "2"], ["5"],
             ["0.000000000000000001", "12345678"], ["0.1"] * 1000, ["9" * 16 + "." + "9" * 9] * 1001, ["9" * 17 + ".5"] * 101, ["9" * 38 + "1", "1"]]
    for _ in range(150):
        cases.append([str(Decimal(random.randrange(10 ** random.randrange(1, 30))).scaleb(random.randrange(-25, 10))) for _ in range(random.randrange(1, 6))])
    df = spark.createDataFrame([(i, j, t) for i, c in enumerate(cases) for j, t in enumerate(c)], "i int, j int, t string").withColumn("p", F.lit(True))
    df = with_number(df, clean="t", raw="t", present="p")
    rows = df.groupBy("i").agg(F.sort_array(F.collect_list(F.struct(
        "j", F.col("value_digits").alias("digits"), F.col("value_exp").alias("exp"), F.col("value_scale").alias("scale"), F.col("value_decimal").alias("text")))).alias("v"))
    got = {r.i: r.total for r in with_decimal_sum(rows, "v", F.lit(True), "total").collect()}
    context = Context(prec=28)
    for i, case in enumerate(cases):
        total = Decimal(0)
        for text in case:
            total = context.add(total, Decimal(text))
        assert got[i] == str(total), case


def test_cleaning_agrees_with_the_full_rules_on_any_text(spark):
    alphabet = "ab Z9<>/&;#ß中文（）：　²³½㎏Ⅳéﬁ①Ａｂ\t\n ​\x1c½ｶﾞ가éΣςΑ"
    texts = ["".join(random.choices(alphabet, k=random.randrange(0, 14))) for _ in range(800)]
    texts += ["NO<sub>x</sub>", "&lt;b&gt;", "a &amp; b", "&nbsp;x", "<未闭合", "", "　全角　", "ß", "STRASSE"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").withColumn("clean", clean_text(F.col("t")))
    got = df.select("i", "clean", fold_key(F.col("clean")).alias("key")).orderBy("i").collect()
    for text, r in zip(texts, got):
        assert r.clean == clean_python(text), repr(text)
        assert r.key == fold_python(text), repr(text)
    assert clean_python(None) == "" and unicodedata.is_normalized("NFKC", clean_python("㎏"))
