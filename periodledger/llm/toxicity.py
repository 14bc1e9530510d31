"""Toxicity scores from averaged subword embeddings and a linear softmax.

A word is the bag of itself and its character 3- to 5-grams, hashed to buckets; each bucket has an embedding. A word's
vector is the mean of its buckets, a text's a weighted mean of its words, and a linear softmax over it gives the label.
Embeddings and softmax are trained jointly in numpy with full-batch Adam. Words never seen in training, misspelled ones
too, are scored by the n-grams they share with known ones.

The gradient of a bucket's embedding is a multiple of the softmax weights, so training passes one number per bucket
through the sparse layers (text to word, word to bucket), which is the same arithmetic as passing vectors.

Training uses a bounded sample of labelled rows: the ``max_docs`` with the smallest id hash among those whose fold is
not 0, less the texts of more than ``max_chars`` characters, and of these rows, equal ones once, the first ``max_docs`` in the
order of that hash and as many as ``max_bytes`` bytes hold. Every text is scored whole. The model (one number per bucket) is broadcast.

Defined results: a null or empty text gets the score of the bias alone; without labels of both kinds all scores are the
share of label 1 (0 without any); rows with null labels are not learned from; a null id counts as the empty text in the
fold; repeated rows get equal scores; input columns ``score`` and ``predicted`` are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_in_arrow, crc_fold, let_go
from .words import buffers, mix, ranges, spans, words

MAX_DOCS = 10_000
MAX_CHARS = 40_000
MAX_BYTES = 32_000_000
BUCKETS = 1 << 17
WIDTH = 8
SLICE = 50_000
SCALE = 20.0
PRIOR = 4.0


def subwords(letters: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of words given as bytes one after another, and the word each bucket belongs to."""
    size = np.diff(first)
    count = len(size)
    # Each word between a mark before and a mark behind.
    marked = np.zeros(len(letters) + 2 * count, np.uint64)
    begin = first[:-1] + 2 * np.arange(count)
    of = np.repeat(np.arange(count), size + 2)
    inside = np.ones(len(marked), bool)
    inside[begin] = inside[begin + size + 1] = False
    marked[inside] = letters.astype(np.uint64) + np.uint64(3)
    marked[begin], marked[begin + size + 1] = 1, 2
    keys, owners = [], []
    rolled = marked.copy()
    for n in range(2, 6):
        if len(marked) < n:
            break
        rolled = rolled[:-1] * np.uint64(0x100000001B3) + marked[n - 1:]
        if n > 2:
            same = of[:len(rolled)] == of[n - 1:]
            keys.append(mix(rolled[same] + np.uint64(n << 56)))
            owners.append(of[:len(rolled)][same])
    powers = np.cumprod(np.full(max(int(size.max(initial=0)), 1), 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)
    whole = np.zeros(count, np.uint64)
    np.add.at(whole, np.repeat(np.arange(count), size), (letters.astype(np.uint64) + np.uint64(1)) * powers[np.arange(len(letters)) - np.repeat(first[:-1], size)])
    keys.append(mix(whole))
    owners.append(np.arange(count))
    return (np.concatenate(keys) % np.uint64(BUCKETS)).astype(np.int32), np.concatenate(owners).astype(np.int32)


def shares(docs: np.ndarray, words_: np.ndarray, kinds: int, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text and word: the word's part in the text's average."""
    pair, times = np.unique(docs * kinds + words_, return_counts=True)
    doc = pair // kinds
    return doc, pair % kinds, parts(doc, times, count)


def parts(doc: np.ndarray, times: np.ndarray, count: int) -> np.ndarray:
    """A word weighs the root of its repeats, so that a text of few repeated words is not judged by them alone; PRIOR
    words without a voice steady very short texts."""
    weight = np.sqrt(times)
    return SCALE * weight / (np.bincount(doc, weight, count) + PRIOR)[doc]


@dataclass
class Model:
    """What scoring needs: the embeddings times the softmax direction, and the bias."""

    weight: np.ndarray
    bias: float

    def word_scores(self, letters: np.ndarray, first: np.ndarray) -> np.ndarray:
        bucket, owner = subwords(letters, first)
        count = len(first) - 1
        return np.bincount(owner, self.weight[bucket], count) / np.maximum(np.bincount(owner, minlength=count), 1)

    def score(self, column: pa.Array) -> np.ndarray:
        data, offsets = buffers(column)
        found = np.full(len(column), self.bias)
        for lo, hi in ranges(offsets):
            w = words(data, offsets, lo, hi)
            if not len(w.hashes):
                continue
            _, at, back = np.unique(w.hashes, return_index=True, return_inverse=True)
            scores = self.word_scores(*spans(data, w.start[at], w.stop[at]))
            doc, word, part = shares(w.text, back, len(at), hi - lo)
            found[lo:hi] += np.bincount(doc, part * scores[word], hi - lo)
        return 1.0 / (1.0 + np.exp(-np.clip(found, -700, 700)))


@dataclass
class Features:
    """Labelled texts as numbers: each text's distinct words with their parts, and each word's buckets."""

    doc: np.ndarray
    word: np.ndarray
    part: np.ndarray
    slices: list[tuple[int, int, np.ndarray, np.ndarray]]  # words from, to, their buckets, how many each has
    per_word: np.ndarray


def features(texts: pa.Array) -> Features:
    data, offsets = buffers(texts)
    # Run by run only distinct words of a text are kept, with their number.
    hashes, docs, times, kinds_, at, to = [], [], [], [], [], []
    for lo, hi in ranges(offsets):
        w = words(data, offsets, lo, hi)
        own, first, word = np.unique(w.hashes, return_index=True, return_inverse=True)
        pair, count = np.unique(w.text * max(len(own), 1) + word, return_counts=True)
        for out, x in ((hashes, own[pair % max(len(own), 1)]), (docs, (pair // max(len(own), 1) + lo).astype(np.int32)), (times, count.astype(np.int32)),
                       (kinds_, own), (at, w.start[first]), (to, w.stop[first])):
            out.append(x)
    kinds_, at, to = (np.concatenate(x) for x in (kinds_, at, to))
    kinds_, first = np.unique(kinds_, return_index=True)
    kinds, at, to = len(kinds_), at[first], to[first]
    doc, word = np.concatenate(docs), np.concatenate([np.searchsorted(kinds_, h).astype(np.int32) for h in hashes])
    part = parts(doc, np.concatenate(times), len(texts)).astype(np.float32)
    del hashes, docs, times, kinds_, first
    # Buckets of SLICE words at a time, so that no step makes wide copies of all of them.
    slices = []
    for lo in range(0, max(kinds, 1), SLICE):
        hi = min(lo + SLICE, kinds)
        bucket, owner = subwords(*spans(data, at[lo:hi], to[lo:hi]))
        slices.append((lo, hi, bucket[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=hi - lo).astype(np.int32)))
    return Features(doc, word, part, slices, np.maximum(np.concatenate([n for *_, n in slices]), 1))


def train(found: Features, labels: np.ndarray, epochs: int = 60, rate: float = 0.05, decay: float = 1e-5, seed: int = 7) -> Model:
    """Joint training of bucket embeddings and softmax on labelled texts."""
    share = float(labels.mean()) if len(labels) else 0.0
    if share in (0.0, 1.0):
        return Model(np.zeros(BUCKETS), 700.0 if share else -700.0)
    doc, word, part, slices, per_word = found.doc, found.word, found.part, found.slices, found.per_word
    kinds = len(per_word)
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.05, (BUCKETS, WIDTH)).astype(np.float32)
    softmax = rng.normal(0, 0.3, (WIDTH, 2)).astype(np.float32)
    bias = np.log(np.array([1 - share, share]), dtype=np.float32)
    values = [embed, softmax, bias]
    means, squares = [np.zeros_like(x) for x in values], [np.zeros_like(x) for x in values]
    for step in range(1, epochs + 1):
        direction = softmax[:, 1] - softmax[:, 0]
        one = embed @ direction
        summed = np.concatenate([np.bincount(np.repeat(np.arange(hi - lo), n), one[bucket], hi - lo) for lo, hi, bucket, n in slices])
        logit = np.bincount(doc, part * (summed / per_word)[word], len(labels)) + bias[1] - bias[0]
        error = (1 / (1 + np.exp(-np.clip(logit, -60, 60))) - labels) / len(labels)
        to_word = np.bincount(word, part * error[doc], kinds) / per_word
        to_bucket = sum(np.bincount(bucket, np.repeat(to_word[lo:hi], n), BUCKETS) for lo, hi, bucket, n in slices).astype(np.float32)
        pull = embed.T @ to_bucket
        gradients = [np.outer(to_bucket, direction) + decay * embed, np.stack([-pull, pull], 1), np.array([-error.sum(), error.sum()], np.float32)]
        for value, gradient, mean, square in zip(values, gradients, means, squares):
            mean += 0.1 * (gradient - mean)
            square += 0.01 * (gradient * gradient - square)
            value -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-7)
    return Model((embed @ (softmax[:, 1] - softmax[:, 0])).astype(np.float64), float(bias[1] - bias[0]))


def training_rows(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS, max_chars: int = MAX_CHARS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """The bounded sample: doc_id, text, toxic. At most ``max_docs`` distinct rows and ``max_bytes`` bytes of text after the join, whatever ids repeat."""
    order, text = F.xxhash64(F.col("doc_id").cast("string"), F.lit(11)), F.xxhash64("text")
    chosen = (labels.where((crc_fold(F.col("doc_id")) != 0) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(order, "doc_id").limit(max_docs))
    texts = docs.select("doc_id", "text").where(F.length("text") <= max_chars)
    rows = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic", order.alias("_o"), text.alias("_t"))  # at most max_docs small rows
    narrow = rows.select("_o", "_t", F.octet_length("text").alias("size")).distinct().orderBy("_o", "_t").limit(max_docs).collect()  # three numbers a row
    total = last = 0
    for last, r in enumerate(narrow):
        total += r["size"]
        if total > max_bytes:
            break
    else:
        last = len(narrow)
    if last < len(narrow):
        end = narrow[last]
        rows = rows.where((F.col("_o") < end["_o"]) | ((F.col("_o") == end["_o"]) & (F.col("_t") < end["_t"])))
    elif narrow:
        end = narrow[-1]
        rows = rows.where((F.col("_o") < end["_o"]) | ((F.col("_o") == end["_o"]) & (F.col("_t") <= end["_t"])))
    return rows.dropDuplicates(["_o", "_t"]).select("doc_id", "text", "toxic")


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS, max_chars: int = MAX_CHARS, max_bytes: int = MAX_BYTES) -> Model:
    rows = training_rows(docs, labels, max_docs, max_chars, max_bytes).orderBy("doc_id", "text").toArrow()
    marks = np.asarray(rows.column("toxic").to_pylist(), dtype=float)
    texts = rows.column("text").combine_chunks() if rows.num_rows else pa.array([], pa.string())
    del rows
    if not len(marks) or marks.mean() in (0.0, 1.0):
        return train(None, marks)
    found = features(texts)
    del texts  # training needs the numbers only
    pa.default_memory_pool().release_unused()
    return train(found, marks)


def _score_batch(shared, batch: pa.RecordBatch) -> list[pa.Array]:
    let_go()
    scores = shared.value.score(batch.column(batch.schema.names.index("text")))
    return [pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` plus ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return add_in_arrow(docs, "score double, predicted int", partial(_score_batch, shared))
