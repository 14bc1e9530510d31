"""Exact Jaccard join of word-shingle sets by PartEnum signatures, as classes of linked documents.

Sets whose sizes lie in one band are joined as a Hamming-distance join: with Jaccard similarity of 4/5 or more, sets of
r and s shingles differ in at most (r + s) / 9. The shingle domain (64-bit hashes) is cut into n equal ranges, about
3/2 of the band's largest distance k. A pair differs in at most k ranges, so n - k ranges hold the same shingles in both;
the shingles of each range, hashed together, are the signatures. Bands grow by 5/4, and a set also signs for the band
below its own, where smaller partners are.

Since a pair shares n - k of n signatures, it shares one among the k + 1 that come first in any order kept by all sets.
That order is by how many sets have a signature, rarest first, and a set keeps those k + 1 only. Ranges that hold
nothing but a passage that many documents repeat are common and go, so such a passage brings no documents together
unless it fills most of them. For each set, k comes from its own size.

Empty ranges would be shared by everybody and are not signed. A pair can then be lost only if both sets fill k ranges or
fewer; such sets sign a second, finer partition too, and those that are sparse there as well share one signature a band.

Copies sign once a task. Signatures are shuffled once; a pass over the sorted rows keeps those that different sets share
and counts their sets up to ``COUNTED`` (more are the most common ones alike: this only orders them), holding no more rows
than that. What a set keeps is sorted by signature again and numbered, holding one row. Links are then found without emitting all pairs of a signature: in each
round the next sets of a signature (1, 8, 64, ...) meet the later ones that are not yet in the same class; pairs that
their cores prove apart are not emitted, the others are compared, the found links are contracted to classes, and signatures within one class are done. Every pair that shares a signature is
compared, proved apart or already connected, so no link is lost; rounds are logarithmic in the largest group.

A set's core are its shingles that a set of another class holds too, among the sets still searched: two sets of different
classes have nothing else in common. Variants of one text that are too far from all others have many shingles of their own,
so their cores are small: a set whose core is below 4/5 of it has no link left and goes, without meeting the others of
its signatures; pairs are proved apart by the sizes of their cores and by ``FOLDS`` (512 bits of a core). Cores take one grouping of the shingles
a round, shrink from round to round, and never grow.

Shingles are compared by their 64-bit hashes, sets are identified by a 64-bit hash of all their shingles.

Defined results: a text without words has an empty set and is linked with nothing; a text of one to four words is one
shingle; equal rows and copies are in one class; a null id takes part, its class carries the smallest id that is not null
(null if there is none).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.scratch import materialize
from .common import let_go, release
from .words import buffers, mix, ranges, words

SHINGLE = 5
_PLACE = np.random.default_rng(555).integers(0, 2**64, SHINGLE, dtype=np.uint64) | np.uint64(1)
FILTER_BITS = 1 << 24
COUNTED = 1 << 16
FOLDS = [f"fold{i}" for i in range(8)]


# ---- sets -----------------------------------------------------------------------------------------------------------

def shingle_sets(data: np.ndarray, offsets: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of the texts of a run, one text after another, and where each text begins."""
    w = words(data, offsets, lo, hi)
    h, n = w.hashes, len(w.hashes)
    made, owner = np.empty(0, np.uint64), np.empty(0, np.int64)
    if n >= SHINGLE:
        full = w.text[:n - SHINGLE + 1] == w.text[SHINGLE - 1:]
        made = sum((h[j:n - SHINGLE + 1 + j] * _PLACE[j] for j in range(1, SHINGLE)), h[:n - SHINGLE + 1] * _PLACE[0])[full]
        owner = w.text[:n - SHINGLE + 1][full]
    short = np.flatnonzero((w.counts > 0) & (w.counts < SHINGLE))
    if len(short):
        whole = np.zeros(hi - lo, np.uint64)
        few = (w.counts < SHINGLE)[w.text]
        place = np.arange(n) - w.first[w.text]
        np.add.at(whole, w.text[few], h[few] * _PLACE[place[few]])
        made = np.concatenate([made, whole[short] + w.counts[short].astype(np.uint64)])
        owner = np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        made, owner = made[order], owner[order]
    made = mix(made)
    first = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=hi - lo))])
    for a, b in zip(first[:-1], first[1:]):
        made[a:b].sort()
    fresh_ = np.ones(len(made), bool)
    fresh_[1:] = (made[1:] != made[:-1]) | (owner[1:] != owner[:-1])
    return made[fresh_], np.concatenate([[0], np.cumsum(np.bincount(owner[fresh_], minlength=hi - lo))])


def set_keys(shingles: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(shingles ^ np.uint64(0xA5A5A5A5DEADBEEF)), dtype=np.uint64)])
    return mix(sums[first[1:]] - sums[first[:-1]] + np.diff(first).astype(np.uint64))


# ---- signatures -----------------------------------------------------------------------------------------------------

@lru_cache(maxsize=1)
def bands(up_to: int = 1 << 40) -> tuple[np.ndarray, np.ndarray]:
    """Largest set size of each band, and the largest distance of a pair whose smaller set is in it."""
    tops = [1]
    while tops[-1] < up_to:
        tops.append(max(tops[-1] + 1, tops[-1] * 5 // 4))
    tops = np.array(tops, np.int64)
    return tops, (tops + tops * 5 // 4) // 9


def _signed(shingles, first, which, band, parts, seed) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of the filled ranges of the texts ``which``: (signature, text)."""
    sizes = np.diff(first)[which]
    ends = np.cumsum(sizes)
    take = np.repeat(first[:-1][which] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
    owner = np.repeat(np.arange(len(which)), sizes)
    own = shingles[take]  # sorted, so that a range is a run
    cell = ((own >> np.uint64(32)) * parts.astype(np.uint64)[owner]) >> np.uint64(32)
    new = np.ones(len(own), bool)
    new[1:] = (cell[1:] != cell[:-1]) | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(new)
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    together = np.add.reduceat(mix(own + np.uint64(seed * 2 + 1)), starts)
    owner = owner[starts]
    label = (cell[starts] << np.uint64(12)) + (band[owner].astype(np.uint64) << np.uint64(2)) + np.uint64(seed)
    return mix(together ^ mix(label)), owner


def signatures(shingles: np.ndarray, first: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All signatures of the texts ``which`` (with filled sets): signature, index of the text in ``which``, family (band and
    partition) and how many of the text's signatures of this family can be spared, the most common ones."""
    tops, distance = bands()
    sizes = np.diff(first)[which]
    own_band = np.searchsorted(tops, sizes)
    found, owners, families, spare = [], [], [], []

    def give(made, owner, family, spared):
        for column, values in zip((found, owners, families, spare), (made, owner, family, spared)):
            column.append(values)

    for below in (0, 1):
        member = np.flatnonzero(own_band >= below)
        for seed in (0, 1):
            band = own_band[member] - below
            k = distance[band]
            largest = sizes[member] * 5 // 4  # a partner's size
            own_k = np.minimum(k, (sizes[member] + (np.minimum(largest, tops[band]) if below else largest)) // 9)
            parts = (k + 1) + k // 2 + 5 if seed == 0 else 3 * (k + 1) + 16
            made, owner = _signed(shingles, first, which[member], band, parts, seed)
            filled = np.bincount(owner, minlength=len(member))
            give(made, member[owner], (band * 4 + seed)[owner], np.maximum(filled - own_k - 1, 0)[owner])
            member = member[filled <= k]
            if not len(member):
                break
        else:
            band = own_band[member] - below
            give(mix(band.astype(np.uint64) + np.uint64(0x5EED << 32)), member, band * 4 + 2, np.zeros(len(member), np.int64))
    return tuple(np.concatenate(x) for x in (found, owners, families, spare))


def _sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    let_go()
    for batch in batches:
        data, offsets = buffers(batch.column(1))
        for lo, hi in ranges(offsets):
            shingles, first = shingle_sets(data, offsets, lo, hi)
            sizes, keys = np.diff(first), set_keys(shingles, first)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(sizes), pa.array(keys.view(np.int64), mask=sizes == 0)], names=["doc_id", "n_shingles", "key"])


def _sized_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """As ``_sized``, with the hash of the text."""
    for batch in batches:
        at = 0
        for found in _sized([pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["doc_id", "text"])]):
            yield pa.RecordBatch.from_arrays([found.column(0), batch.column(2).slice(at, len(found)), found.column(1), found.column(2)], names=["doc_id", "_text", "n_shingles", "key"])
            at += len(found)


def _new_sets(keys: np.ndarray, wanted: np.ndarray, seen: set[int]) -> np.ndarray:
    """Which of the wanted sets this task has not met before."""
    new = []
    for i in np.flatnonzero(wanted).tolist():
        if keys[i] not in seen:
            seen.add(keys[i])
            new.append(i)
    return np.array(new, np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    let_go()
    seen: set[int] = set()
    for batch in batches:
        data, offsets = buffers(batch.column(0))
        for lo, hi in ranges(offsets):
            shingles, first = shingle_sets(data, offsets, lo, hi)
            keys = set_keys(shingles, first)
            which = _new_sets(keys, np.diff(first) > 0, seen)
            if len(which):
                made, owner, family, spare = signatures(shingles, first, which)
                columns = made.view(np.int64), keys[which][owner].view(np.int64), family << 40 | spare
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["signature", "key", "kind"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by signature and key: those of two sets or more, with the number of sets (``COUNTED`` if more)."""
    held: list[np.ndarray] | None = None  # rows of the last signature, whose end is not yet seen
    common = None  # signature and key of the row before, if its signature was given out as common already

    def rows(columns, count):
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (*columns, count)], names=["signature", "key", "kind", "sets"])

    for batch in batches:
        columns = [np.asarray(c) for c in batch.columns]
        if held is not None:
            columns = [np.concatenate(x) for x in zip(held, columns)]
        sig, key, _ = columns
        if not len(sig):
            continue
        new = np.ones(len(sig), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])
        if common is not None:
            new[0] = (sig[0], key[0]) != common
        columns = [c[new] for c in columns]
        sig, key, _ = columns
        if common is not None:
            run = int(np.searchsorted(sig, common[0], side="right"))  # sorted: the common signature is the least
            if run:
                yield rows([c[:run] for c in columns], np.full(run, COUNTED))
                common = (common[0], key[run - 1])
                columns = [c[run:] for c in columns]
                sig, key, _ = columns
            if not len(sig):
                held = None
                continue
            common = None
        starts = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
        sizes = np.diff(np.append(starts, len(sig)))
        last = int(starts[-1])
        sets = np.repeat(np.minimum(sizes, COUNTED), sizes)
        if sizes[-1] > COUNTED:
            common, last, held = (sig[-1], key[-1]), len(sig), None
        else:
            held = [c[last:].copy() for c in columns]
        keep = np.flatnonzero(sets[:last] > 1)
        if len(keep):
            yield rows([c[keep] for c in columns], sets[keep])
    if held is not None and len(held[0]) > 1:
        yield rows(held, np.full(len(held[0]), len(held[0])))


def _shared_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by signature and key: the signatures of two sets or more, their sets numbered."""
    names = ["signature", "place", "lead", "key"]
    last = None  # signature, key, place, lead of the row before; whether it still waits for a second set

    def batch_of(*columns):
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    for batch in batches:
        sig, key = (np.asarray(c) for c in batch.columns)
        if not len(sig):
            continue
        if last is not None:
            sig, key = np.append(np.int64(last[0]), sig), np.append(np.int64(last[1]), key)
        new = np.ones(len(sig), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])
        sig, key = sig[new], key[new]
        group = np.ones(len(sig), bool)
        group[1:] = sig[1:] != sig[:-1]
        starts = np.flatnonzero(group)
        sizes = np.diff(np.append(starts, len(sig)))
        place = np.arange(len(sig)) - np.repeat(starts, sizes)
        lead = np.repeat(key[starts], sizes)
        keep = np.repeat(sizes > 1, sizes)
        if last is not None:
            n = sizes[0]
            place[:n] += last[2]
            lead[:n] = last[3]
            keep[:n] = (n > 1) | ~np.bool_(last[4])
            keep[0] = last[4] and n > 1  # written before unless it waited
        waits = sizes[-1] == 1 and place[-1] == 0
        last = (sig[-1], key[-1], int(place[-1]), lead[-1], waits)
        if keep.any():
            yield batch_of(sig[keep], place[keep], lead[keep], key[keep])


def shared_signatures(docs: DataFrame) -> DataFrame:
    """signature, place, lead, key of the signatures that two sets or more keep."""
    made = docs.select("text").mapInArrow(_sign, "signature long, key long, kind long").repartition("signature").sortWithinPartitions("signature", "key")
    counted = materialize(made.mapInArrow(_counted, "signature long, key long, kind long, sets long"), "jaccard-counted")
    release(docs.sparkSession)
    family = F.shiftright("kind", 40)
    common = F.row_number().over(Window.partitionBy("key", family).orderBy(F.desc("sets"), "signature"))  # as many rows as the set has signatures
    kept = counted.withColumn("nth", common).where(F.col("nth") > F.col("kind").bitwiseAND(F.lit((1 << 40) - 1))).select("signature", "key")
    rows = kept.repartition("signature").sortWithinPartitions("signature", "key")
    return rows.mapInArrow(_shared_only, "signature long, place long, lead long, key long")


# ---- comparison -----------------------------------------------------------------------------------------------------

def _slots(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = mix(np.asarray(batch.column(0)).view(np.uint64) ^ np.asarray(batch.column(1)).view(np.uint64)) % np.uint64(bits)
            one = np.uint64(1) << (at & np.uint64(63))
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int32)), pa.array(one.view(np.int64))], names=["slot", "bits"])
    return run


def _passing(passed, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        field, seen = passed.value, set()
        for batch in batches:
            data, offsets = buffers(batch.column(1))
            ids = np.asarray(batch.column(0)).view(np.uint64)
            for lo, hi in ranges(offsets):
                shingles, first = shingle_sets(data, offsets, lo, hi)
                sizes, keys = np.diff(first), set_keys(shingles, first)
                at = mix(keys ^ ids[lo:hi]) % np.uint64(bits)
                hit = (field[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)
                which = _new_sets(keys, (hit == 1) & (sizes > 0), seen)
                if len(which):
                    own = [shingles[first[i]:first[i + 1]] for i in which]
                    ends = np.concatenate([[0], np.cumsum(sizes[which])]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(keys[which].view(np.int64)), pa.array(sizes[which]), pa.array([outline(x) for x in own], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(own).view(np.int64)))], names=["key", "n", "outline", "shingles"])
    return run


def compared_sets(docs: DataFrame, known: DataFrame, shared: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """key, n, outline, shingles of the sets that share a signature, made again from the text of one document each. Which
    documents these are is told by a bit field of fixed size (too full, it only lets more pass), so no text is shuffled."""
    holder = known.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    wanted = holder.join(shared.select("key").distinct(), "key", "left_semi").select("key", F.xxhash64("doc_id").alias("id"))
    slots = wanted.mapInArrow(_slots(bits), "slot int, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()  # at most bits / 64 rows
    field = np.zeros(bits // 64, np.uint64)
    if slots.num_rows:
        field[slots.column("slot").to_numpy()] = slots.column("bits").to_numpy().view(np.uint64)
    passed = docs.sparkSession.sparkContext.broadcast(field)
    return docs.select(F.xxhash64("doc_id").alias("id"), "text").mapInArrow(_passing(passed, bits), "key long, n long, outline binary, shingles array<long>")


def cores(sets: DataFrame, live: DataFrame) -> DataFrame:
    """key, n, core, folds of the sets in ``live`` that may still be linked with one of another class: the number of their
    shingles that another class holds too, and 64 * len(FOLDS) bits, one set for each of these."""
    own = sets.select("key", "n", "shingles").join(live.select("key", "class").distinct(), "key").dropDuplicates(["key"])
    each = materialize(own.select("key", "n", "class", F.explode("shingles").alias("shingle")), "jaccard-shingles")
    met = materialize(each.groupBy("shingle").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low < high").select("shingle"), "jaccard-met")
    bit = F.expr("shiftleft(1L, cast(shingle & 63 as int))")
    slot = F.shiftright("shingle", 6).bitwiseAND(F.lit(len(FOLDS) - 1))
    folded = [F.bit_or(F.when(slot == i, bit).otherwise(F.lit(0).cast("long"))).alias(f) for i, f in enumerate(FOLDS)]
    core = each.join(met, "shingle", "left_semi").groupBy("key", "n").agg(F.count("shingle").alias("core"), *folded)
    return materialize(core.where("100 * core >= 80 * n"), "jaccard-cores")


def _not_apart() -> Column:
    """Whether the cores of a and b leave it open that they are similar: a bit that only one has is a shingle that only it has."""
    def only(x: str, y: str) -> Column:
        return reduce(add, (F.bit_count(F.col(f"{f}_{x}").bitwiseAND(F.bitwise_not(f"{f}_{y}"))) for f in FOLDS))

    most = F.least(F.col("core_a") - only("a", "b"), F.col("core_b") - only("b", "a"))
    return 100 * most >= 80 * (F.col("n_a") + F.col("n_b") - most)


def outline(shingles: np.ndarray) -> bytes:
    """One bit for each shingle, among twice as many bits or more (a power of two, 64 at least)."""
    size = max(64, 1 << (2 * len(shingles) - 1).bit_length())
    bits = np.zeros(size, bool)
    bits[(shingles & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _may_be_near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drops pairs whose outlines prove them apart: a bit that only one outline has is a shingle that only one set has."""
    for batch in batches:
        a, b, n_a, n_b, o_a, o_b = batch.columns
        keep = []
        for n, m, x, y in zip(n_a.to_pylist(), n_b.to_pylist(), o_a, o_b):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            size = min(len(x), len(y))
            x, y = np.bitwise_or.reduce(x.reshape(-1, size)), np.bitwise_or.reduce(y.reshape(-1, size))
            most = min(n - int(np.bitwise_count(x & ~y).sum()), m - int(np.bitwise_count(y & ~x).sum()))
            keep.append(100 * most >= 80 * (n + m - most))
        yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of set keys whose Jaccard similarity is 4/5 or more, compared exactly. Sizes and outlines
    (a bit or two a shingle) sort out most other pairs before whole sets are sent."""
    def side(name: str, *columns: str) -> DataFrame:
        return sets.select(F.col("key").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])

    near = 5 * F.least("n_a", "n_b") >= 4 * F.greatest("n_a", "n_b")
    outlined = pairs.join(side("b", "n", "outline"), "b").join(side("a", "n", "outline"), "a").where(near)
    left = materialize(outlined.select("a", "b", "n_a", "n_b", "outline_a", "outline_b").mapInArrow(_may_be_near, "a long, b long").distinct(), "jaccard-near")
    both = left.join(side("b", "n", "shingles"), "b").join(side("a", "n", "shingles"), "a")
    common = both.withColumn("common", F.size(F.array_intersect("shingles_a", "shingles_b")))
    return common.where(100 * F.col("common") >= 80 * (F.col("n_a") + F.col("n_b") - F.col("common"))).select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """key, class for all ends of the edges (a, b); the class is some key of the component. Every key moves to its
    smallest neighbour and the edges are contracted, until none is left; keys are hashes, so rounds are logarithmic."""
    moves = []
    while True:
        ends = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = materialize(ends.groupBy("a").agg(F.least("a", F.min("b")).alias("low")), "jaccard-moves")
        moves.append(low)
        to = low.select(F.col("a").alias("b"), F.col("low").alias("low_b"))
        edges = materialize(edges.join(low, "a").join(to, "b").where("low != low_b").select(F.col("low").alias("a"), F.col("low_b").alias("b")).distinct(), "jaccard-edges")
        if edges.isEmpty():
            break
    found = moves[0].select(F.col("a").alias("key"), F.col("low").alias("class"))
    for move in moves[1:]:
        found = found.join(move.select(F.col("a").alias("class"), "low"), "class", "left").select("key", F.coalesce("low", "class").alias("class"))
    return materialize(found, "jaccard-classes")


def linked_classes(docs: DataFrame, known: DataFrame) -> DataFrame | None:
    """key, class of all sets that are linked with another set; None if no two sets share a signature."""
    spark = docs.sparkSession
    live = materialize(shared_signatures(docs), "jaccard-shared")
    if live.isEmpty():
        return None
    release(spark)
    sets = materialize(compared_sets(docs, known, live), "jaccard-sets")
    done = found = classes = None
    start, width = 0, 1
    while True:
        if start == 0:
            pairs = live.where("place > 0").select(F.col("lead").alias("a"), F.col("key").alias("b")).distinct()
        else:
            known_cores = cores(sets, live)
            live = live.join(known_cores.select("key"), "key", "left_semi")
            folded = live.join(known_cores, "key")
            first, later = (folded.select("signature", F.col("place").alias(f"place_{x}"), F.col("key").alias(x), F.col("class").alias(f"class_{x}"), *[F.col(c).alias(f"{c}_{x}") for c in ("n", "core", *FOLDS)]) for x in "ab")
            apart = (F.col("place_a") < F.col("place_b")) & (F.col("class_a") != F.col("class_b"))
            pairs = (later.join(first.where(F.col("place_a") < start + width), "signature").where(apart & _not_apart())
                     .select("a", "b").distinct().join(done, ["a", "b"], "left_anti"))
        pairs = materialize(pairs, "jaccard-pairs")
        done = pairs if done is None else done.union(pairs)
        new = materialize(links(pairs, sets), "jaccard-links")
        release(spark)
        if not new.isEmpty():
            found = new if found is None else found.union(new)
            classes = components(found)
        start, width = start + width, width * 8
        rest = live.where(F.col("place") >= start).select("signature", "place", "key")
        if classes is None:
            rest = rest.withColumn("class", F.col("key"))
        else:
            rest = rest.join(classes, "key", "left").select("signature", "place", "key", F.coalesce("class", "key").alias("class"))
        split = rest.groupBy("signature").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low < high").select("signature")
        live = materialize(rest.join(split, "signature", "left_semi"), "jaccard-live")
        if live.isEmpty():
            return classes


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, key of the set (null if empty)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return materialize(docs.select("doc_id", "text").mapInArrow(_sized, f"doc_id {kind}, n_shingles long, key long"), "jaccard-sized")


def _placed(docs: DataFrame, known: DataFrame) -> DataFrame:
    """The rows of ``known`` with the class of each set (null if empty)."""
    classes = linked_classes(docs, known)
    placed = known.withColumn("class", F.col("key")) if classes is None else known.join(classes, "key", "left").withColumn("class", F.coalesce("class", "key"))
    return materialize(placed.select(*known.columns, "class"), "jaccard-placed")


def classes_of(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id of its class)."""
    placed = _placed(docs, sized(docs)).select("doc_id", "n_shingles", "class")
    smallest = placed.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("smallest"))
    return placed.join(smallest, "class", "left").select("doc_id", "n_shingles", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("smallest")).alias("component_id"))


def _text_hash() -> Column:
    return F.xxhash64("text")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each class of linked documents: that of the smallest doc_id (null only where the class has no other), of
    equal ids the text of the smallest hash, of equal rows any one. Rows without words all stay."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    # Rows with equal id and text are alike here; rows that are not stay apart, also where the ids are equal or null.
    alike = (F.col("doc_id"), F.col("_text"))
    texts = docs.select("doc_id", "text", _text_hash().alias("_text"))
    known = materialize(texts.mapInArrow(_sized_texts, f"doc_id {kind}, _text long, n_shingles long, key long"), "jaccard-sized")
    placed = _placed(docs, known)
    first = placed.where("class is not null").groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), *alike)).alias("first"))
    chosen = first.select(F.xxhash64("first.doc_id").alias("_id"), F.col("first._text").alias("_text"), F.lit(1).alias("_worded"))
    wordless = placed.where("class is null").select(F.xxhash64("doc_id").alias("_id"), "_text", F.lit(0).alias("_worded")).distinct()
    keyed = docs.withColumn("_id", F.xxhash64("doc_id")).withColumn("_text", _text_hash())
    kept = keyed.join(materialize(chosen.union(wordless), "jaccard-kept"), ["_id", "_text"])
    # Rows equal in both may differ in other columns: the least one stays, whatever order they come in.
    order = [F.col(c) for c, t in docs.dtypes if "map<" not in t]
    nth = F.row_number().over(Window.partitionBy("_id", "_text").orderBy(*order))
    return kept.withColumn("_nth", nth).where((F.col("_nth") == 1) | (F.col("_worded") == 0)).select(*docs.columns)
