"""License scans by diagonal voting.

All rolling word k-grams of all texts are joined with the positions of the same k-grams in the license templates. A match
at text position p and template position t votes for the diagonal p - t; an inserted or lost word shifts the diagonal, so
neighbouring diagonals of a text and template are merged. A merged span is verified: its words must equal the template's
at the matched places, cover enough of the template, and lie close together. Only built-in functions are used.

The templates are fixed and small, so their k-grams are broadcast; what is shuffled are matches, not texts. Besides, a
text's plain phrases (base labels) are found where its words lie.

Defined results: a null or empty text has no words, no phrases and no labels (empty text); overlapping places all count;
repeated rows are scanned alike; with several verified spans of a label the best covers; input columns named like a result
column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.scratch import materialize
from .common import row_key

K = 3
COVER = 0.6
DENSE = 0.6
SHIFT = 3

# Phrases of the base rule and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Well-known license notices, by label.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
]
ADDED = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: Column) -> Column:
    """The ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` words of a text with A-Z in lower case."""
    return F.filter(F.split(F.coalesce(lower_ascii(text), F.lit("")), _GAPS), lambda w: w != "")


def template_grams(spark: SparkSession, k: int = K) -> DataFrame:
    """template, label, grams (in the template), at, gram (hash), word (the first of the gram)."""
    rows = spark.createDataFrame([(i, label, text) for i, (label, text) in enumerate(TEMPLATES)], "template int, label string, body string")
    split = rows.select("template", "label", words_of(F.col("body")).alias("words"))
    grams = split.withColumn("grams", F.size("words") - (k - 1)).select("template", "label", "grams", "words", F.posexplode(_grams(F.col("words"), k)).alias("at", "gram"))
    return grams.select("template", "label", "grams", "at", "gram", F.element_at("words", F.col("at") + 1).alias("word"))


def _grams(words: Column, k: int) -> Column:
    places = F.when(F.size(words) >= k, F.sequence(F.lit(0), F.size(words) - k)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)]))


def _phrase_places(words: Column) -> Column:
    """Positions and labels of the base phrases, by their last word: struct(at, label)."""
    wanted = [(p.split(" "), label) for p, label in PHRASES.items()]

    def here(i: Column) -> Column:
        found = F.lit(None).cast("string")
        for parts, label in wanted:
            match = F.lit(True)
            for j, part in enumerate(reversed(parts)):
                match = match & (F.coalesce(F.get(words, i - j), F.lit("")) == part)
            found = F.coalesce(F.when(match, F.lit(label)), found)
        return found

    lengths = {label: len(parts) for parts, label in wanted}
    back = F.create_map(*[F.lit(x) for label, n in lengths.items() for x in (label, n - 1)])
    ends = F.filter(F.transform(words, lambda w, i: F.struct(i.alias("i"), (w == "license").alias("hit"))), lambda x: x["hit"])
    placed = F.filter(F.transform(ends, lambda x: F.struct(x["i"].alias("i"), here(x["i"]).alias("label"))), lambda x: x["label"].isNotNull())
    return F.transform(placed, lambda x: F.struct((x["i"] - F.element_at(back, x["label"])).alias("at"), x["label"].alias("label")))


def matches(docs: DataFrame, k: int = K) -> DataFrame:
    """key, template, label, grams, at, pos: every k-gram of a text that is in a template, words compared."""
    grams = F.broadcast(template_grams(docs.sparkSession, k))  # the fixed templates
    worded = docs.select(row_key("doc_id", "text").alias("key"), words_of(F.col("text")).alias("words"))
    rolled = worded.select("key", "words", F.posexplode(_grams(F.col("words"), k)).alias("pos", "gram"))
    own = F.get(F.col("words"), F.col("pos"))
    return rolled.join(grams, "gram").where(own == F.col("word")).select("key", "template", "label", "grams", "at", "pos").distinct()


def spans(found: DataFrame, cover: float = COVER, dense: float = DENSE, shift: int = SHIFT) -> DataFrame:
    """Verified spans: key, label, first, last, covered (share of the template's k-grams)."""
    diagonals = found.groupBy("key", "template", "label", "grams", (F.col("pos") - F.col("at")).alias("diagonal")).agg(
        F.count("*").alias("votes"), F.min("pos").alias("first"), F.max("pos").alias("last"))
    along = Window.partitionBy("key", "template").orderBy("diagonal", "first")
    opens = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(along) > shift).cast("int"), F.lit(1))
    merged = diagonals.withColumn("opens", opens).withColumn("span", F.sum("opens").over(along))
    whole = merged.groupBy("key", "template", "label", "grams", "span").agg(F.sum("votes").alias("votes"), F.min("first").alias("first"), F.max("last").alias("last"))
    covered = F.least(F.lit(1.0), F.col("votes") / F.col("grams"))
    return whole.withColumn("covered", covered).where((covered >= cover) & (F.col("votes") >= dense * (F.col("last") - F.col("first") + 1)))


def scan(docs: DataFrame, k: int = K) -> DataFrame:
    """One row per document: doc_id and the columns of ``ADDED``."""
    worded = docs.select("doc_id", "text", row_key("doc_id", "text").alias("key"), words_of(F.col("text")).alias("words"))
    base = materialize(worded.select("doc_id", "key", F.size("words").cast("long").alias("n_words"), _phrase_places(F.col("words")).alias("places")), "license-base")
    verified = spans(matches(docs, k))
    voted = verified.groupBy("key").agg(F.array_distinct(F.collect_set("label")).alias("voted"), F.max("covered").alias("covered"))  # at most one of each label
    at = F.transform("places", lambda p: p["at"].cast("long"))
    own = F.array_distinct(F.transform("places", lambda p: p["label"]))
    both = base.join(voted, "key", "left").withColumn("own", own)
    every = F.array_union("own", F.coalesce("voted", F.array().cast("array<string>")))
    return both.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"),
        F.array_join(F.array_sort("own"), ",").alias("base_labels"), F.array_join(F.array_sort(every), ",").alias("labels"),
        F.greatest(F.coalesce("covered", F.lit(0.0)), F.when(F.size("own") > 0, F.lit(0.5)).otherwise(F.lit(0.0))).alias("score"))
