"""Quality rules: word statistics of a text and a hashed n-gram log-likelihood ratio.

The ratio compares two multinomials over hashed unigrams and bigrams: one of trusted texts, one of the whole corpus.
A text's score is the mean of log(p_trusted / p_corpus) over its n-grams, so length does not matter, and every text is
kept or not by one threshold. Only built-in functions are used.

The corpus counts cover every n-gram of every text, the trusted counts those of every text labelled good. Labels are
joined by id with rows that hold a text's n-grams as small numbers, not the text; rows without an id have no label and stay
out of the join. Counting combines on the map side: a task sends at most ``buckets`` rows. The table of ratios has ``buckets`` entries and becomes a constant of the plan.

Repeated 3-word windows are found inside the row: window hashes are sorted with their places, equal neighbours are
repeated, and their places cover words. No row leaves its task.

Defined results: a null or empty text has no words and fails the base rules; a text of one word has one n-gram; without
trusted rows all ratios are 0; repeated rows are judged alike and each counts in the corpus; input columns named like a
result column are replaced.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, fresh, words_of

BUCKETS = 10_000
THRESHOLD = -0.06
SYMBOLS = "#*$%&|<>"
ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "ratio", "kept")


def _word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _places(count: Column) -> Column:
    """0 to count - 1, empty for none."""
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))


def _ngram_buckets(hashes: Column, buckets: int) -> Column:
    single = F.transform(hashes, lambda h: F.pmod(h, F.lit(buckets)).cast("int"))
    pairs = F.transform(_places(F.size(hashes) - 1), lambda i: F.pmod(F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1)), F.lit(buckets)).cast("int"))
    return F.concat(single, pairs)


def trusted_ids(labels: DataFrame) -> DataFrame:
    return labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()


def bucket_ratios(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS) -> list[float]:
    """log(p_trusted / p_corpus) of each bucket, both with one added to each count."""
    kind = "array<smallint>" if buckets <= 1 << 15 else "array<int>"
    hashed = docs.select("doc_id", _word_hashes(words_of(F.col("text"))).alias("hashes"))
    rows = hashed.select("doc_id", _ngram_buckets(F.col("hashes"), buckets).cast(kind).alias("grams"))
    # The same join at every size: a broadcast of the labels has no bound. Many rows of one id are split by the adaptive join.
    trusted = trusted_ids(labels).withColumn("trusted", F.lit(1)).hint("merge")
    joined = rows.where("doc_id is not null").join(trusted, "doc_id", "left").select(F.coalesce("trusted", F.lit(0)).alias("trusted"), "grams")
    both = joined.union(rows.where("doc_id is null").select(F.lit(0).alias("trusted"), "grams"))
    # An inner explode would make the optimizer infer a filter on the size of the list and copy its whole derivation into the scan.
    grams = both.select("trusted", F.explode_outer("grams").alias("bucket"))
    counts = grams.where("bucket is not null").groupBy("bucket").agg(F.count("*").alias("corpus"), F.sum("trusted").alias("trusted")).collect()  # at most `buckets` rows
    corpus, good = [1.0] * buckets, [1.0] * buckets
    for row in counts:
        corpus[row["bucket"]] += row["corpus"]
        good[row["bucket"]] += row["trusted"]
    if sum(good) == buckets:
        return [0.0] * buckets
    import math

    shift = math.log(sum(corpus)) - math.log(sum(good))
    return [math.log(g) - math.log(c) + shift for g, c in zip(good, corpus)]


def _repeat_words(hashes: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more."""
    windows = F.transform(_places(F.size(hashes) - 2), lambda i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1), F.get(hashes, i + 2)))

    def cover(places: Column) -> Column:
        gaps = F.transform(places, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(places, j + 1), p + 3) - p))
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

    def repeated(ordered: Column) -> Column:
        return F.filter(ordered, lambda x, j: (F.get(ordered, j - 1)["h"] == x["h"]) | (F.get(ordered, j + 1)["h"] == x["h"]))

    def count(found: Column) -> Column:
        ordered = F.array_sort(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        flagged = _let(ordered, repeated)
        return _let(F.array_sort(F.transform(flagged, lambda x: x["i"])), cover)

    return _let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(count(w)))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def judge(docs: DataFrame, ratios: list[float], threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` plus the base counts, base_failed, the length-normalised ratio and kept."""
    docs = fresh(docs, *ADDED, "_words", "_hashes")
    text, words = F.col("text"), F.col("_words")
    table = F.from_json(F.lit(json.dumps(ratios)), "array<double>")
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.length(F.btrim(line, F.lit(BLANKS))) > 0)
    plain = text
    for symbol in SYMBOLS:
        plain = F.replace(plain, F.lit(symbol), F.lit(""))
    grams = _ngram_buckets(F.col("_hashes"), len(ratios))
    total = F.aggregate(grams, F.lit(0.0), lambda sum_, b: sum_ + F.get(table, b))
    grams_n = F.col("n_words") + F.greatest(F.col("n_words") - 1, F.lit(0))
    worded = docs.withColumn("_words", words_of(text)).withColumn("_hashes", _word_hashes(words))
    counted = (worded.withColumn("n_words", F.size(words).cast("long"))
               .withColumn("word_chars", F.length(F.array_join(words, "")).cast("long"))
               .withColumn("n_symbols", F.coalesce(F.length(text) - F.length(plain), F.lit(0)).cast("long"))
               .withColumn("n_dup_lines", F.coalesce(_let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))), F.lit(0)).cast("long"))
               .withColumn("n_repeat_words", _repeat_words(F.col("_hashes")).cast("long"))
               .withColumn("ratio", F.when(F.col("n_words") > 0, total / grams_n).otherwise(F.lit(0.0))))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counted.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("ratio") >= threshold)).drop("_words", "_hashes")
