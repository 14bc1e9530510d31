"""A class-based n-gram language model: log10 p(text) = sum of log10 p(class | class before) + log10 p(word | class).

Exchange clustering gives every training word a class, whatever its count. The start is made with items: the most frequent
words, and pseudo-words into which the others fall by their last two letters. They begin in classes dealt by frequency and
move one by one, on the driver, to the class that raises the likelihood of the class bigrams most. Then the words
themselves move, in ``ROUNDS`` Spark rounds of hash-split batches: a scan of the texts counts for each word of the batch which
classes stand before and behind it (packed to a row a task and word), the counts meet by word, and each word moves to the
class that raises the likelihood most, against the class-by-class table counted in the same scan, itself taken out. The
words of a batch move at once. Frequent words (``head``) are split over all rounds; the others, whose classes are too many to
broadcast, all move in the last one, so until then their class follows from their letters. Only words that training texts
do not have keep the class of their pseudo-word. Transitions and emissions are smoothed by half counts.

Counts come from all training texts, made in the tasks and summed by Spark. The driver sees the bigrams of items and classes
only (their squares are fixed) and the ``head`` words: those above the least count that at most ``head`` words reach, whose counts
and classes are broadcast. The other words of a text (rare or unknown) look up both by a join. Each word is looked up in
exactly one of the two ways.

Words are known by 64-bit hashes. A text is scored whole; memory does not depend on its length but for a byte a word (its
class) and its list of rare words.

Defined results: a null or empty text has one token, the end; texts whose fold is 1 are held out (a null id counts as the
empty text in the fold); repeated rows count and are scored row by row; without training texts every count is 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize
from .common import crc_fold, release
from .words import buffers, mix, ranges, tails, words

ITEMS = 1000
PSEUDO = 128
CLASSES = 48
SWEEPS = 6
HEAD = 500_000
ROUNDS = 2
HELD = 1 << 21  # tokens that a task counts at once
UNPLACED = 255
HELD_OUT = 1
HALF = 0.5


def training_texts(docs: DataFrame) -> DataFrame:
    return docs.where(crc_fold(F.col("doc_id")) != HELD_OUT).select("text")


def _pseudo(tail: np.ndarray) -> np.ndarray:
    return (mix(tail.astype(np.uint64)) % np.uint64(PSEUDO)).astype(np.int64)


# ---- counts ---------------------------------------------------------------------------------------------------------

def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = buffers(batch.column(0))
        hashes, tail = [], []
        for lo, hi in ranges(offsets):
            w = words(data, offsets, lo, hi)
            _, at, times = np.unique(w.hashes, return_index=True, return_counts=True)
            hashes.append(np.stack([w.hashes[at], times.astype(np.uint64)]))
            tail.append(_pseudo(tails(data, w)[at]))
        if hashes:
            (key, times), tail = np.concatenate(hashes, 1), np.concatenate(tail)
            kinds, at, back = np.unique(key, return_index=True, return_inverse=True)
            total = np.bincount(back, times.astype(float), len(kinds)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), pa.array(tail[at]), pa.array(total)], names=["word", "pseudo", "n"])


def word_counts(training: DataFrame) -> DataFrame:
    """word (hash), pseudo, n over all training texts."""
    rows = training.mapInArrow(_count_words, "word long, pseudo long, n long")
    return rows.groupBy("word").agg(F.min("pseudo").alias("pseudo"), F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """The frequent words (sorted hashes) and their item numbers."""

    hashes: np.ndarray

    def items(self, hashes: np.ndarray, tail: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.hashes, hashes)
        known = (at < len(self.hashes)) & (self.hashes[np.minimum(at, len(self.hashes) - 1)] == hashes) if len(self.hashes) else np.zeros(len(hashes), bool)
        return np.where(known, at, ITEMS + _pseudo(tail))


END = ITEMS + PSEUDO
SYMBOLS = END + 1


def _sequences(vocabulary: Vocabulary, batch_column: pa.Array):
    """Per run: (lo, hi, words, item of each word, item before each word, last item of each text)."""
    data, offsets = buffers(batch_column)
    for lo, hi in ranges(offsets):
        w = words(data, offsets, lo, hi)
        item = vocabulary.items(w.hashes, tails(data, w)) if len(w.hashes) else np.empty(0, np.int64)
        before = np.concatenate([[END], item[:-1]])[:len(item)]
        filled = w.counts > 0
        before[w.first[:-1][filled]] = END
        last = np.full(hi - lo, END)
        last[filled] = item[w.first[1:][filled] - 1]
        yield lo, hi, w, item, before, last


def item_bigrams(training: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """How often each item follows each other one; the end comes before the first word and after the last."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, waiting, held = np.zeros(SYMBOLS * SYMBOLS, np.int64), [], 0
        for batch in batches:
            for _, _, _, item, before, last in _sequences(vocabulary, batch.column(0)):
                waiting += [before * SYMBOLS + item, last * SYMBOLS + END]
                held += len(item) + len(last)
                if held > 1 << 20:
                    total += np.bincount(np.concatenate(waiting), minlength=len(total))
                    waiting, held = [], 0
        if waiting:
            total += np.bincount(np.concatenate(waiting), minlength=len(total))
        seen = np.flatnonzero(total)
        for part in np.array_split(seen, max(1, len(seen) // 100_000)):
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], names=["pair", "n"])

    rows = training.mapInArrow(count, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()  # at most SYMBOLS^2 rows
    found = np.zeros(SYMBOLS * SYMBOLS)
    if rows.num_rows:
        found[rows.column("pair").to_numpy()] = rows.column("n").to_numpy()
    return found.reshape(SYMBOLS, SYMBOLS)


# ---- clustering -----------------------------------------------------------------------------------------------------

def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def exchange(bigrams: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each item; the end has the last class for itself. An item moves where the bigram likelihood grows most."""
    n = len(bigrams)
    weight = bigrams.sum(0) + bigrams.sum(1)
    order = np.argsort(-weight[:-1], kind="stable")
    group = np.empty(n, np.int64)
    group[order] = np.arange(n - 1) % (classes - 1)
    group[-1] = classes - 1
    one = np.eye(classes)[group]
    after, before = bigrams @ one, bigrams.T @ one  # per item: counts of the classes behind and in front
    table = one.T @ after
    for _ in range(sweeps):
        moved = 0
        for w in order:
            if not weight[w]:
                continue
            old, self_ = group[w], bigrams[w, w]
            right, left = after[w].copy(), before[w].copy()
            right[old] -= self_
            left[old] -= self_
            # Without w.
            table[old, :] -= right
            table[:, old] -= left
            table[old, old] -= self_
            rows, columns = table.sum(1), table.sum(0)
            gain_row = _f(table + right[None, :]) - _f(table)
            gain_column = _f(table + left[:, None]) - _f(table)
            own = np.diagonal(table)
            gain = (gain_row.sum(1) - np.diagonal(gain_row)) + (gain_column.sum(0) - np.diagonal(gain_column)) + _f(own + right + left + self_) - _f(own)
            out, into = right.sum() + self_, left.sum() + self_
            gain -= _f(rows + out) - _f(rows) + _f(columns + into) - _f(columns)
            new = int(np.argmax(gain[:-1]))
            if gain[new] <= gain[old] + 1e-9:
                new = old
            table[new, :] += right
            table[:, new] += left
            table[new, new] += self_
            if new != old:
                moved += 1
                group[w] = new
                after[:, old] -= bigrams[:, w]
                after[:, new] += bigrams[:, w]
                before[:, old] -= bigrams[w]
                before[:, new] += bigrams[w]
        if not moved:
            break
    return group


# ---- rounds over all words ------------------------------------------------------------------------------------------

# Cells of a word's counts: the classes before it, the classes behind it, itself.
ITSELF = 2 * CLASSES
CELLS = ITSELF + 1


@dataclass
class Classes:
    """Class of every word as far as a task can tell: of the head words, by their letters of all others."""

    hashes: np.ndarray  # head words, sorted
    head: np.ndarray  # their classes
    pseudo: np.ndarray  # class of each pseudo-word

    def of(self, data: np.ndarray, w) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each word: its class, whether it is a head word, its place among them."""
        if not len(w.hashes):
            return np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, w.hashes), max(len(self.hashes) - 1, 0))
        known = self.hashes[at] == w.hashes if len(self.hashes) else np.zeros(len(at), bool)
        return np.where(known, self.head[at] if len(self.head) else 0, self.pseudo[_pseudo(tails(data, w))]), known, at


def _moves_in(hashes: np.ndarray, known: np.ndarray, turn: int, rounds: int) -> np.ndarray:
    """Which words move in this round."""
    return np.where(known, (mix(hashes) % np.uint64(rounds)).astype(np.int64), rounds - 1) == turn


def _gather(shared, turn: int, rounds: int):
    """Rows of a word (its class, packed counts of its cells) and, with no word, of the class bigrams."""
    def packed(parts: list) -> pa.RecordBatch:
        word, cell, group = (np.concatenate(x) for x in zip(*parts))
        kinds, at, back = np.unique(word, return_index=True, return_inverse=True)
        found, times = np.unique(back * CELLS + cell, return_counts=True)
        ends = np.concatenate([[0], np.cumsum(np.bincount(found // CELLS, minlength=len(kinds)))]).astype(np.int32) * 4
        cells = ((times << 7) | (found % CELLS)).astype(np.uint32)
        column = pa.Array.from_buffers(pa.binary(), len(kinds), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(cells)])
        return pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), pa.array(group[at].astype(np.int32)), column], names=["word", "class", "cells"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes: Classes = shared.value
        table, parts, held = np.zeros(CLASSES * CLASSES, np.int64), [], 0
        for batch in batches:
            data, offsets = buffers(batch.column(0))
            for lo, hi in ranges(offsets):
                w = words(data, offsets, lo, hi)
                group, known, _ = classes.of(data, w)
                end = CLASSES - 1
                before, after = (np.full(len(group), end) for _ in range(2))
                before[1:], after[:-1] = group[:-1], group[1:]
                filled = w.counts > 0
                heads, lasts = w.first[:-1][filled], w.first[1:][filled] - 1
                before[heads] = after[lasts] = end
                table += np.bincount(before * CLASSES + group, minlength=len(table))
                table[end * CLASSES + end] += int((~filled).sum())
                table += np.bincount(group[lasts] * CLASSES + end, minlength=len(table))
                same = np.zeros(len(group), bool)  # equal to the word before
                same[1:] = w.hashes[1:] == w.hashes[:-1]
                same[heads] = False
                behind = np.append(same[1:], False)[:len(same)]
                moves = _moves_in(w.hashes, known, turn, rounds)
                for here, cell in ((moves & ~same, before), (moves & same, np.full(len(group), ITSELF)), (moves & ~behind, CLASSES + after)):
                    parts.append((w.hashes[here], cell[here], group[here]))
                held += len(group)
                if held > HELD:
                    yield packed(parts)
                    parts, held = [], 0
        if held:
            yield packed(parts)
        if table.any():
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([None], pa.int32()), pa.array([table.tobytes()], pa.binary())], names=["word", "class", "cells"])
    return run


def best_classes(table: np.ndarray, old: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Of words with the given classes and counts (a column for each cell): the class of the largest likelihood, all else as it is.
    An empty class takes none: words that move at once would all go there, however unlike."""
    n, each = len(old), np.arange(len(old))
    left, right, itself = counts[:, :CLASSES], counts[:, CLASSES:ITSELF], counts[:, ITSELF]
    gain = np.zeros((n, CLASSES))
    for towards, own, other in ((table.T, right, left), (table, left, right)):  # row c of ``towards``: cells of all classes with c
        w, c = np.nonzero(own)
        base, more = towards[c], own[w, c]
        base[np.arange(len(w)), old[w]] -= more
        at = np.flatnonzero(c == old[w])  # words in the class c before also leave its other side
        base[at] -= other[w[at]]
        base[at, old[w[at]]] -= itself[w[at]]
        rise = _f(base + more[:, None]) - _f(base)
        rise[np.arange(len(w)), c] = 0  # a class with itself: below
        starts = np.flatnonzero(np.append(True, w[1:] != w[:-1])) if len(w) else np.empty(0, np.int64)
        if len(starts):
            gain[w[starts]] += np.add.reduceat(rise, starts)
    own = np.repeat(np.diagonal(table)[None, :], n, 0)
    own[each, old] -= right[each, old] + left[each, old] + itself
    gain += _f(own + right + left + itself[:, None]) - _f(own)
    for total, mine in ((table.sum(1), right.sum(1) + itself), (table.sum(0), left.sum(1) + itself)):
        rest = np.repeat(total[None, :], n, 0)
        rest[each, old] -= mine
        gain -= _f(rest + mine[:, None]) - _f(rest)
    gain[:, table.sum(1) == 0] = -np.inf
    new = np.argmax(gain[:, :-1], 1)  # the last class is the end's
    return np.where(gain[each, new] > gain[each, old] + 1e-9, new, old)


def _move(shared, step: int = 1000):
    """Rows sorted by word, as ``_gather`` makes them, to word, n, class."""
    def moved(word, old, owner, cells, times, table):
        starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        index = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(word))))
        word, old, owner = word[starts], old[starts].astype(np.int64), index[owner]
        order = np.argsort(owner, kind="stable")
        owner, cells, times = owner[order], cells[order], times[order]
        new, n = np.empty(len(word), np.int32), np.empty(len(word), np.int64)
        for lo in range(0, len(word), step):
            hi = min(lo + step, len(word))
            a, b = np.searchsorted(owner, [lo, hi])
            counts = np.bincount((owner[a:b] - lo) * CELLS + cells[a:b], times[a:b], (hi - lo) * CELLS).reshape(hi - lo, CELLS)
            new[lo:hi] = best_classes(table, old[lo:hi], counts)
            n[lo:hi] = counts[:, :CLASSES].sum(1) + counts[:, ITSELF]  # something stands before each word
        return pa.RecordBatch.from_arrays([pa.array(word), pa.array(n), pa.array(new)], names=["word", "n", "class"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, held = shared.value, None
        for batch in batches:
            if not len(batch):
                continue
            word, old = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            data, offsets = buffers(batch.column(2))
            cells = np.frombuffer(data[offsets[0]:offsets[-1]].tobytes(), np.uint32)
            owner = np.repeat(np.arange(len(word)), np.diff(offsets) // 4)
            columns = [word, old, owner, (cells & 127).astype(np.int64), (cells >> 7).astype(np.int64)]
            if held is not None:
                columns[2] = columns[2] + len(held[0])
                columns = [np.concatenate(x) for x in zip(held, columns)]
            word, old, owner, cells, times = columns
            cut = int(np.searchsorted(word, word[-1]))  # the last word may go on
            part = owner < cut
            if cut:
                yield moved(word[:cut], old[:cut], owner[part], cells[part], times[part], table)
            # What is held of one word is summed up: a row, whatever the number of its rows.
            key, back = np.unique(cells[~part], return_inverse=True)
            held = [word[-1:], old[-1:], np.zeros(len(key), np.int64), key, np.bincount(back, times[~part], len(key)).astype(np.int64)]
        if held is not None:
            yield moved(*held, table)
    return run


def cluster_words(training: DataFrame, classes: Classes, rounds: int = ROUNDS) -> DataFrame:
    """Moves all words: the head words' classes in ``classes``, the others as a table word, n, class."""
    spark = training.sparkSession
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast(classes)
        gathered = materialize(training.mapInArrow(_gather(shared, turn, rounds), "word long, class int, cells binary"), "lm-neighbours")
        table = np.zeros((CLASSES, CLASSES))
        for part in gathered.where("word is null").select("cells").toLocalIterator():  # a row a task
            table += np.frombuffer(part.cells, np.int64).reshape(CLASSES, CLASSES)
        sorted_ = gathered.where("word is not null").repartition("word").sortWithinPartitions("word")
        moved = materialize(sorted_.mapInArrow(_move(spark.sparkContext.broadcast(table)), "word long, n long, class int"), "lm-moved")
        release(spark)
        top = spark.createDataFrame(pa.table({"word": classes.hashes.view(np.int64)})) if len(classes.hashes) else moved.select("word").limit(0)
        found = moved.join(top, "word", "left_semi").select("word", "class").toArrow()  # head words
        if found.num_rows:
            at = np.searchsorted(classes.hashes, found.column("word").to_numpy().view(np.uint64))
            head = classes.head.copy()
            head[at] = found.column("class").to_numpy()
            classes.head = head
    return moved.join(top, "word", "left_anti")


# ---- model and scores -----------------------------------------------------------------------------------------------

@dataclass
class Model:
    classes: Classes
    head_counts: np.ndarray  # of the head words
    transition: np.ndarray  # log10 p(class | class before)
    share: np.ndarray  # per class: log10 of the emissions' denominator
    tokens: int
    kinds: int
    ends: int
    fitted: DataFrame | None = None  # the documents of ``fit``
    placed: DataFrame | None = None  # and their classes, so that these are not looked up again

    @property
    def denominator(self) -> float:
        return float(np.log10(self.tokens + HALF * (self.kinds + 1)))


def fit(docs: DataFrame, items: int = ITEMS, head: int = HEAD) -> tuple[Model, DataFrame]:
    """The model and the table of the other words: word, n, class."""
    training = training_texts(docs)
    counts = materialize(word_counts(training), "lm-counts")
    ends = training.count()
    spread = counts.groupBy("n").agg(F.count("*").alias("kinds")).orderBy(F.desc("n")).toArrow()  # distinct counts
    sizes, kinds = (np.asarray(spread.column(c)) for c in ("n", "kinds"))
    total = np.cumsum(kinds) if len(kinds) else np.empty(0, np.int64)

    def least_for(bound: int) -> int:
        within = np.flatnonzero(total <= bound)
        return int(sizes[within[-1]]) if len(within) else (int(sizes[0]) + 1 if len(sizes) else 1)

    # The items are among the head words: else their classes would be lost.
    frequent = counts.where(F.col("n") >= least_for(max(head, items))).select("word", "pseudo", "n").toArrow().combine_chunks()  # at most so many words
    hashes, pseudo, n = (np.asarray(frequent.column(c)) if frequent.num_rows else np.empty(0, np.int64) for c in ("word", "pseudo", "n"))
    order = np.argsort(hashes.view(np.uint64))
    hashes, pseudo, n = hashes.view(np.uint64)[order], pseudo[order], n[order]
    top = counts.where(F.col("n") >= least_for(items)).select("word").toArrow().column("word")  # at most `items` words
    vocabulary = Vocabulary(np.sort(top.to_numpy().view(np.uint64)) if len(top) else np.empty(0, np.uint64))
    group = exchange(item_bigrams(training, vocabulary))
    start = group[ITEMS + pseudo]
    at = np.searchsorted(vocabulary.hashes, hashes)
    item = vocabulary.hashes[np.minimum(at, len(vocabulary.hashes) - 1)] == hashes if len(vocabulary.hashes) else np.zeros(len(hashes), bool)
    start[item] = group[at[item]]
    classes = Classes(hashes, start, group[ITEMS:ITEMS + PSEUDO])
    others = materialize(cluster_words(training, classes), "lm-classes")
    placed = place(docs, classes, n, others)
    table = class_bigrams(placed.where("not held_out"))
    transition = np.log10((table + HALF) / (table.sum(1, keepdims=True) + HALF * CLASSES))
    # Tokens and kinds of each class, of all words.
    tokens, of_class = np.bincount(classes.head, n, CLASSES), np.bincount(classes.head, minlength=CLASSES).astype(float)
    tokens[-1] += ends
    for row in others.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).collect():  # CLASSES rows
        tokens[row["class"]] += row["n"]
        of_class[row["class"]] += row["kinds"]
    share = np.log10(tokens + HALF * (of_class + 1))
    return Model(classes, n, transition, share, int((sizes * kinds).sum()) + ends, int(kinds.sum()) + (ends > 0), ends, docs, placed), others


def _place_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, counts = shared.value
        logs = np.append(np.log10(counts + HALF), 0.0)  # one value for "not among them" at the end
        for batch in batches:
            data, offsets = buffers(batch.column(2))
            for lo, hi in ranges(offsets):
                w, n = words(data, offsets, lo, hi), hi - lo
                group, known, at = classes.of(data, w)
                owner = w.text[~known]
                ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]).astype(np.int32)
                rare = group[~known].astype(np.uint8)
                sequence = np.where(known, group, UNPLACED).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, n), batch.column(1).slice(lo, n), pa.array(w.counts + 1), pa.array(np.bincount(w.text, known, n).astype(np.int64)), pa.array(np.bincount(w.text, logs[np.where(known, at, -1)], n).astype(float)),
                    _binary(sequence, w.first), _binary(rare, ends), pa.ListArray.from_arrays(pa.array(ends), pa.array(w.hashes[~known].view(np.int64)))],
                    names=["doc_id", "held_out", "n_tokens", "known", "logs", "sequence", "guess", "rare"])
    return run


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _fill_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Puts the classes of rare words, found or guessed, into the sequences."""
    for batch in batches:
        column = dict(zip(batch.schema.names, batch.columns))
        sequences = []
        for sequence, guess, rare, found in zip(column["sequence"], column["guess"], column["rare"], column["found"]):
            sequence = np.frombuffer(sequence.as_buffer(), np.uint8).copy()
            guess = np.frombuffer(guess.as_buffer(), np.uint8).copy()
            if len(guess) and found.is_valid:
                word, group = (found.values.field(name).to_numpy() for name in ("word", "class"))
                order = np.argsort(word)
                word, group, rare = word[order], group[order], rare.values.to_numpy()
                at = np.minimum(np.searchsorted(word, rare), len(word) - 1)
                hit = word[at] == rare
                guess[hit] = group[at[hit]]
            sequence[sequence == UNPLACED] = guess
            sequences.append(sequence.tobytes())
        yield pa.RecordBatch.from_arrays([column[c] for c in ("doc_id", "held_out", "n_tokens", "known", "logs")] + [pa.array(sequences, pa.binary())], names=["doc_id", "held_out", "n_tokens", "known", "logs", "sequence"])


def place(docs: DataFrame, classes: Classes, head_counts: np.ndarray, others: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, known (words that training texts have), logs (sum of their log10 counts), sequence (a class a byte)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast((classes, head_counts))
    rows = docs.select("doc_id", (crc_fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), "text")
    ddl = f"doc_id {kind}, held_out boolean, n_tokens long, known long, logs double, sequence binary"
    first = rows.mapInArrow(_place_batches(shared), f"{ddl}, guess binary, rare array<long>")
    first = materialize(first.withColumn("row", F.monotonically_increasing_id()), "lm-scores")
    rare = first.select("row", F.explode("rare").alias("word")).groupBy("row", "word").agg(F.count("*").alias("times"))
    seen = rare.join(others, "word", "left")
    rest = seen.groupBy("row").agg(  # as many entries as the text has rare words
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(HALF))).alias("rest"), F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("rest_known"),
        F.collect_list(F.when(F.col("n").isNotNull(), F.struct("word", "class"))).alias("found"))
    both = first.join(rest, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("rest_known", F.lit(0))).alias("known"), (F.col("logs") + F.coalesce("rest", F.lit(0.0))).alias("logs"),
        "sequence", "guess", "rare", F.when(F.size("found") > 0, F.col("found")).alias("found"))
    return materialize(both.mapInArrow(_fill_batches, ddl), "lm-placed")


def _pairs(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a column of sequences, each with an end behind it: classes, the classes before, the index of the sequence."""
    data, offsets = buffers(column)
    sizes = np.diff(offsets)
    lasts = np.cumsum(sizes + 1) - 1
    group = np.full(int(sizes.sum()) + len(sizes), CLASSES - 1, np.int64)
    inside = np.ones(len(group), bool)
    inside[lasts] = False
    group[inside] = data[offsets[0]:offsets[-1]]
    before = np.concatenate([[CLASSES - 1], group[:-1]])[:len(group)]
    return group, before, np.repeat(np.arange(len(sizes)), sizes + 1)


def class_bigrams(placed: DataFrame) -> np.ndarray:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES * CLASSES, np.int64)
        for batch in batches:
            group, before, _ = _pairs(batch.column(0))
            total += np.bincount(before * CLASSES + group, minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["pair", "n"])

    table = np.zeros(CLASSES * CLASSES)
    for row in placed.select("sequence").mapInArrow(count, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():  # at most CLASSES^2 rows
        table[row["pair"]] = row["n"]
    return table.reshape(CLASSES, CLASSES)


def _model_scores(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transition, share = shared.value
        share = np.append(share[:-1], 0.0)  # the end is the only one of its class
        for batch in batches:
            group, before, owner = _pairs(batch.column(5))
            model = np.bincount(owner, transition[before, group] - share[group], len(batch)).astype(float)
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(model)], names=["doc_id", "held_out", "n_tokens", "known", "logs", "model"])
    return run


def score(docs: DataFrame, model: Model, others: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    placed = model.placed if docs is model.fitted else place(docs, model.classes, model.head_counts, others)
    shared = docs.sparkSession.sparkContext.broadcast((model.transition, model.share))
    both = placed.mapInArrow(_model_scores(shared), f"doc_id {kind}, held_out boolean, n_tokens long, known long, logs double, model double")
    end = float(np.log10(model.ends + HALF))
    scored = F.col("logs") + F.col("model")
    return both.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.lit(int(model.ends > 0))).alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + F.lit(end) - F.col("n_tokens") * F.lit(model.denominator)).alias("base_score"), scored.alias("score"), F.pow(F.lit(10.0), -scored / F.col("n_tokens")).alias("perplexity"))
