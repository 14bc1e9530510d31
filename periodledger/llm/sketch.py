"""Document fingerprints: invertible Bloom lookup sketches of a text's paragraphs.

A paragraph (a line) is a 64-bit digest. A sketch has three groups of cells; a digest falls into one cell of each group,
and a cell keeps how many digests it has and the XOR of the digests and of their check hashes. Sketches of two versions
subtract cell by cell; what both have cancels. A cell with a single digest left (its check agrees) gives it away; taking
it out of its other cells may free more. This peeling goes on until all cells are empty, which recovers exactly the
digests that only one version has, or until it is stuck; then both texts get sketches four times as large, and so on
until every pair is recovered. Likeness is the share of both versions' paragraphs that is not recovered as differing.

Only built-in functions are used; a pair's sketches are made and peeled inside its row. The work for a pair grows with
its paragraphs times the cells it needs.

The next document is found by sorting narrow rows by range and numbering them; texts are shuffled once, and only the needed
beginning of a text goes to the document before it.

Defined results: a null text is empty; an empty text is one empty paragraph; repeated paragraphs count once; of rows with
equal doc_id and text all get the result of one; null ids come first, equal ids are ordered by a hash of the text; a single
document follows itself.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.scratch import materialize
from .common import release

CELLS = 12
LARGER = 4
ROUNDS = 24


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def digests(text: Column) -> Column:
    """The distinct paragraph digests of a text."""
    return F.array_distinct(F.transform(F.split(text, "\n", -1), lambda line: F.xxhash64(line)))


def _placed(found: Column, third: int, side: Column | None = None) -> Column:
    """Digests with check hash and the cell they have in each group."""
    def one(x: Column) -> Column:
        h = x if side is None else x["h"]
        cells = [(F.pmod(F.xxhash64(h, F.lit(group)), F.lit(third)).cast("int") + group * third).alias(f"c{group}") for group in range(3)]
        return F.struct(h.alias("h"), F.xxhash64(h, F.lit(7)).alias("check"), (F.lit(1) if side is None else x["n"]).alias("n"), *cells)

    return F.transform(found, one)


def _add(cell: Column, x: Column, sign: int) -> Column:
    return F.struct((cell["n"] + sign * x["n"]).alias("n"), cell["h"].bitwiseXOR(x["h"]).alias("h"), cell["check"].bitwiseXOR(x["check"]).alias("check"))


def cells(found: Column, count: int = CELLS) -> Column:
    """The sketch of distinct digests: ``count`` cells (n, h, check)."""
    third = count // 3
    nothing = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("h"), F.lit(0).cast("long").alias("check"))

    def build(placed: Column) -> Column:
        def group(g: int) -> Column:
            numbers = F.sequence(F.lit(g * third), F.lit(g * third + third - 1))
            return F.transform(numbers, lambda c: F.aggregate(F.filter(placed, lambda x: x[f"c{g}"] == c), nothing, lambda cell, x: _add(cell, x, 1)))

        return F.concat(*[group(g) for g in range(3)])

    return _let(_placed(found, third), build)


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: F.struct((x["n"] - y["n"]).alias("n"), x["h"].bitwiseXOR(y["h"]).alias("h"), x["check"].bitwiseXOR(y["check"]).alias("check")))


def peel(difference: Column, count: int = CELLS) -> Column:
    """The recovered digests (h, n: 1 if only the first version has it, else -1), or null if peeling got stuck."""
    third = count // 3

    def step(state: Column, _: Column) -> Column:
        single = F.filter(state["cells"], lambda x: (F.abs(x["n"]) == 1) & (F.xxhash64(x["h"], F.lit(7)) == x["check"]))
        freed = F.array_distinct(F.transform(single, lambda x: F.struct(x["h"].alias("h"), x["n"].alias("n"))))

        def remove(placed: Column) -> Column:
            rest = F.transform(state["cells"], lambda cell, i: F.aggregate(F.filter(placed, lambda x: (x["c0"] == i) | (x["c1"] == i) | (x["c2"] == i)), cell, lambda left, x: _add(left, x, -1)))
            more = F.transform(placed, lambda x: F.struct(x["h"].alias("h"), x["n"].alias("n")))
            return F.struct(rest.alias("cells"), F.concat(state["found"], more).alias("found"))

        return _let(_placed(freed, third, F.lit(True)), lambda placed: F.when(F.size(placed) == 0, state).otherwise(remove(placed)))

    start = F.struct(difference.alias("cells"), F.array().cast("array<struct<h:bigint,n:int>>").alias("found"))
    end = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)
    return _let(end, lambda state: F.when(F.forall(state["cells"], lambda x: (x["n"] == 0) & (x["h"] == 0) & (x["check"] == 0)), state["found"]))


def as_text(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda x: F.concat_ws(".", x["n"].cast("string"), F.lower(F.hex(x["h"])), F.lower(F.hex(x["check"])))), ";")


def reconcile(pairs: DataFrame, first_size: int = CELLS) -> DataFrame:
    """``pairs``: pair, a, b (distinct digests). Returns pair, both (digests of both) and differing (the
    recovered ones), with larger sketches where needed."""
    done, size = [], first_size
    open_ = pairs.select("pair", "a", "b")
    while True:
        peeled = open_.withColumn("differing", peel(subtract(cells(F.col("a"), size), cells(F.col("b"), size)), size))
        again = [F.when(F.col("differing").isNull(), F.col(c)).alias(c) for c in ("a", "b")]
        tried = materialize(peeled.select("pair", (F.size("a") + F.size("b")).alias("both"), "differing", *again), "sketch-peeled")
        done.append(tried.where("differing is not null").select("pair", "both", "differing"))
        open_ = tried.where("differing is null").select("pair", "a", "b")
        if open_.isEmpty():
            return reduce(DataFrame.union, done)
        size *= LARGER


def likeness(both: Column, differing: Column) -> Column:
    return 1.0 - F.size(differing) / both


def _in_order(docs: DataFrame) -> DataFrame:
    """key, before (key of the document before), need (how much of this text it takes), after (key of the next one)."""
    narrow = docs.groupBy("key").agg(F.first("doc_id").alias("doc_id"), F.first("n_chars").alias("n_chars"))
    order = [F.col("doc_id").asc_nulls_first(), "key"]
    laid = materialize(narrow.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "sketch-order")
    part = F.shiftright("at", 33)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    parts = laid.groupBy(part.alias("part")).agg(F.count("*").alias("rows"), F.min("at").alias("first")).select(
        "part", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"), F.sum("rows").over(Window.partitionBy()).alias("all"))
    ranked = materialize(laid.withColumn("part", part).join(F.broadcast(parts), "part").select("key", "n_chars", (F.col("at") + F.col("shift")).alias("rank"), "all"), "sketch-ranks")
    front = ranked.select(((F.col("rank") + 1) % F.col("all")).alias("rank"), F.col("key").alias("before"), F.floor(F.col("n_chars") / 2).cast("int").alias("need"))
    back = ranked.select(((F.col("rank") - 1 + F.col("all")) % F.col("all")).alias("rank"), F.col("key").alias("after"))
    return ranked.join(front, "rank").join(back, "rank").select("key", "before", "need", "after")


def edited_versions(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, key, after, n_chars, text, edited: the text with its second half replaced by the beginning of the next."""
    kept = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("\x00null")), "text"))
    chain = materialize(_in_order(kept.select("key", "doc_id", F.length("text").alias("n_chars"))), "sketch-chain")
    keyed = kept.join(chain, "key")
    one = Window.partitionBy("before").orderBy("doc_id")  # asks for the same columns as below, so that one shuffle of the texts serves both
    beginnings = keyed.select("before", "doc_id", F.substring(F.col("text"), F.lit(1), F.col("need")).alias("beginning")).withColumn("nth", F.row_number().over(one)).where("nth = 1")
    rest = keyed.join(beginnings.select(F.col("before").alias("key"), "beginning"), "key")
    n = F.length("text")
    stays = F.substring(F.col("text"), F.lit(1), (n - F.floor(n / 2)).cast("int"))
    return rest.select("doc_id", "key", "after", n.cast("long").alias("n_chars"), "text", F.concat(stays, "beginning").alias("edited"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    versions = edited_versions(docs).select(
        "doc_id", "key", "after", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), digests(F.col("text")).alias("own"), digests(F.col("edited")).alias("new"))
    versions = materialize(versions.withColumn("row", F.monotonically_increasing_id()), "sketch-versions")
    release(docs.sparkSession)  # the shuffled texts
    each = versions.withColumn("nth", F.row_number().over(Window.partitionBy("key").orderBy("row"))).where("nth = 1")
    following = versions.join(each.select(F.col("key").alias("after"), F.col("own").alias("next")), "after")
    pairs = versions.select((F.col("row") * 2).alias("pair"), F.col("own").alias("a"), F.col("new").alias("b")).union(following.select(F.col("row") * 2 + 1, "own", "next"))
    alike = reconcile(pairs).select("pair", likeness(F.col("both"), F.col("differing")).alias("near"))
    near = alike.groupBy(F.shiftright("pair", 1).alias("row")).agg(
        F.max(F.when(F.col("pair") % 2 == 0, F.col("near"))).alias("near_edited"), F.max(F.when(F.col("pair") % 2 == 1, F.col("near"))).alias("near_next"))
    return versions.join(near, "row").select("doc_id", "n_chars", "edited_sha256", as_text(cells(F.col("own"))).alias("fingerprint"), as_text(cells(F.col("new"))).alias("edited_fingerprint"), "near_edited", "near_next")
