"""Mixing sources to target weights by systematic sampling.

Inside a source every document is expected ``target / source_size`` times. The expected copies are summed up along
the documents in order of their size, a random offset is added, and a document is emitted once for each integer the
running sum crosses. So all documents of a source have the same expectation, a document never gets more copies than
that expectation rounded up, and since neighbours are of like size, the words taken stay near the target.

The running sum needs one position per row, not a window over a source: the narrow rows are sorted by range over the
whole cluster and numbered where they lie; a small table (one row per source and partition) turns these numbers into
positions. A source with a third of all rows is therefore just several partitions.

Defined results: a null text has size 0; a null source is a source of its own, last in order; an empty table gives an
empty mix; equal rows are emitted as often as each of them is taken; a source without words has target 0 and no copies;
input columns named like a result column (``size``, ``source_size``, ``target``, ``copies``) are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.scratch import materialize
from .common import fresh, row_key, words_of

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CEILING = 2.0
ADDED = ("size", "source_size", "target", "copies")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, ceiling=CEILING) -> DataFrame:
    """``sizes``: source, source_size. Adds target: the share of all sizes dealt by the repeating weights, no source
    above ``ceiling`` times its size, the excess dealt again by weight.

    That is one level for all: target = min(cap, level * weight). Filling the caps in order of cap / weight, the level
    rises as long as sources fill up and falls after, so it is the largest one met. One row per source, not per document.
    """
    by_name, everything = Window.orderBy(F.col("source").asc_nulls_last()), Window.partitionBy()
    at = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (at + 1).cast("int"))
    known = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(ceiling)))
    known = known.withColumn("fills_at", F.col("cap") / F.col("weight"))
    below = Window.orderBy("fills_at", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    budget = F.sum("source_size").over(everything) * F.lit(float(share))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(below), F.lit(0.0))
    level = (budget - F.coalesce(F.sum("cap").over(below), F.lit(0.0))) / open_weight
    known = known.withColumn("level", level).withColumn("level", F.max("level").over(everything))
    return known.select("source", "source_size", F.least("cap", F.col("level") * F.col("weight")).alias("target"))


def _offset(seed: int) -> Column:
    name = F.coalesce(F.concat(F.lit(f"{seed}:s:"), F.col("source")), F.lit(f"{seed}:null"))
    return F.conv(F.substring(F.md5(name), 1, 12), 16, 10).cast("double") / F.lit(float(2**48))


def sampling_plan(docs: DataFrame, weights=WEIGHTS, share=SHARE, ceiling=CEILING, seed: int = 1) -> DataFrame:
    """One narrow row per document: doc_id, source, key, size, source_size, target, copies."""
    narrow = materialize(docs.select(
        "doc_id", F.col("source").cast("string").alias("source"), row_key("doc_id", "source", "text").alias("key"),
        F.size(words_of(F.col("text"))).cast("long").alias("size")), "mix-sizes")
    order = [F.col("source").asc_nulls_last(), "size", "doc_id", "key"]
    laid = materialize(narrow.repartitionByRange(*order).sortWithinPartitions(*order)
                       .withColumn("at", F.monotonically_increasing_id()), "mix-order")
    part = F.shiftright("at", 33)
    parts = laid.groupBy("source", part.alias("part")).agg(F.count("*").alias("rows"), F.min("at").alias("first"), F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("source").alias("s"), "part", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, share, ceiling).withColumnRenamed("source", "t")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    placed = (laid.withColumn("part", part)
              .join(parts.withColumnRenamed("part", "p"), F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
              .join(targets, F.col("source").eqNullSafe(F.col("t")))
              .withColumn("ratio", ratio).withColumn("u", _offset(seed)).withColumn("position", F.col("at") + F.col("shift")))
    crossed = (F.floor((F.col("position") + 1) * F.col("ratio") + F.col("u")) - F.floor(F.col("position") * F.col("ratio") + F.col("u")))
    return placed.select("doc_id", "source", "key", "size", "source_size", "target", crossed.cast("long").alias("copies"))


def mix(docs: DataFrame, weights=WEIGHTS, share=SHARE, ceiling=CEILING, seed: int = 1, explain: bool = False) -> DataFrame:
    """The mixed documents: each row as often as it is taken. ``explain`` adds size, source_size and target."""
    plan = sampling_plan(docs, weights, share, ceiling, seed)
    # Equal rows share a key: their copies are dealt out among them.
    plan = plan.groupBy("key").agg(F.count("*").alias("_rows"), F.sum("copies").alias("_copies"), F.first("size").alias("size"),
                                   F.first("source_size").alias("source_size"), F.first("target").alias("target")).where("_copies > 0")
    docs = fresh(docs, *ADDED, "_key", "_nth", "_rows", "_copies")
    names = docs.columns
    keyed = docs.withColumn("_key", row_key("doc_id", "source", "text")).join(plan.withColumnRenamed("key", "_key"), "_key")
    nth = F.row_number().over(Window.partitionBy("_key").orderBy(F.lit(1)))
    spread = keyed.withColumn("_nth", F.when(F.col("_rows") > 1, nth).otherwise(F.lit(1)))
    own = F.floor(F.col("_copies") / F.col("_rows")) + (F.col("_nth") <= F.col("_copies") % F.col("_rows")).cast("long")
    taken = spread.withColumn("copies", own.cast("int")).where("copies > 0").withColumn("_nth", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return taken.select(*names, *(["size", "source_size", "target"] if explain else []))
