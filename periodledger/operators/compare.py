"""Two runs compared as multisets of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodledger import vocab
from periodledger.functions.hashing import canonical_row, content_hash

REPORT_IDENTITY = ["permit_code", "report_id", "air_sha256"]


def multiset_difference(left: DataFrame, right: DataFrame, ignore: list[str] | None = None) -> DataFrame:
    """Rows whose number differs: ``row_hash``, ``left_count``, ``right_count``.

    One aggregation answers both directions. Only a SHA-256 per row is shuffled, and equal rows
    are merged map-side, so a row that occurs a billion times costs one record per task. NULLs
    compare equal.
    """
    ignored = tuple(ignore or ())
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    hashed = lambda df: content_hash(canonical_row(df, ignored)).alias("row_hash")
    sides = left.select(hashed(left), one.alias("l"), none.alias("r")).unionByName(
        right.select(hashed(right), none.alias("l"), one.alias("r")))
    counts = sides.groupBy("row_hash").agg(F.sum("l").alias("left_count"), F.sum("r").alias("right_count"))
    return counts.where(F.col("left_count") != F.col("right_count"))


def difference_samples(difference: DataFrame, left: DataFrame, right: DataFrame, ignore: list[str] | None = None,
                       limit: int = vocab.DIFFERENCE_SAMPLE) -> DataFrame:
    """Up to ``limit`` rows found on one side only, per side: ``side``, ``row``. A mere
    difference in the number of copies gives none."""
    ignored = tuple(ignore or ())

    def side(df: DataFrame, name: str, absent: str) -> DataFrame:
        picked = difference.where(F.col(absent) == 0).select("row_hash").orderBy("row_hash").limit(limit)
        rows = df.select(canonical_row(df, ignored).alias("row")).withColumn("row_hash", content_hash(F.col("row")))
        # At most ``limit`` hashes, so this side is always small enough to broadcast.
        found = rows.join(F.broadcast(picked), "row_hash")
        return found.groupBy("row").agg(F.lit(name).alias("side")).select("side", "row")

    return side(left, "left_only", "right_count").unionByName(side(right, "right_only", "left_count"))


def compare_runs(left: dict[str, DataFrame], right: dict[str, DataFrame], *, same_selection: bool, both_finished: bool,
                 ignore: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Verdict row and difference rows of two runs, each given as ``records`` and ``manifest``.

    Equal means: both runs finished and hold evidence, the same request, the same records
    (apart from volatile columns) and the same downloaded report contents.
    """
    ignore = vocab.VOLATILE_COLUMNS if ignore is None else ignore
    difference = multiset_difference(left["records"], right["records"], ignore)
    reports = [side["manifest"].where(F.col("status") == "downloaded").select(
        *[F.coalesce(c, F.lit("")).alias(c) for c in REPORT_IDENTITY]) for side in (left, right)]
    hashes = multiset_difference(*reports)
    n = F.count(F.lit(1))
    row = left["records"].agg(n.alias("left_rows")).crossJoin(right["records"].agg(n.alias("right_rows"))) \
        .crossJoin(reports[0].agg(n.alias("left_reports"))).crossJoin(reports[1].agg(n.alias("right_reports"))) \
        .crossJoin(difference.agg(n.alias("different_rows"))).crossJoin(hashes.agg(n.alias("different_reports")))
    row = row.withColumns({
        "air_records_equal": F.col("different_rows") == 0, "air_report_hashes_equal": F.col("different_reports") == 0,
        "time_selection_equal": F.lit(same_selection), "both_runs_finished": F.lit(both_finished),
        "nonempty_evidence": (F.col("left_rows") > 0) & (F.col("right_rows") > 0) & (F.col("left_reports") > 0) & (F.col("right_reports") > 0),
    })
    equal = F.lit(True)
    for flag in ("nonempty_evidence", "both_runs_finished", "air_records_equal", "air_report_hashes_equal", "time_selection_equal"):
        equal = equal & F.col(flag)
    return row.withColumn("equal", equal), difference
