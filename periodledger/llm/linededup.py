"""Line deduplication by a sharded minimal perfect hash.

Keys of lines that at least ``min_docs`` documents hold are counted by Spark (distinct within a document first, map-side
combined). They are dealt into shards of about ``SHARD`` keys; each shard becomes a minimal perfect hash (levels of
bits: a key settles on the first level where no other key of the shard has its bit; its rank among the set bits is its
place) and, at those places, arrays of compact fingerprints, counts and the largest document holding the line. Documents
probe the arrays where they are read; lines are not joined and texts are not shuffled.

The arrays are broadcast only up to ``max_broadcast`` bytes, checked before. A larger index stays in the shared folder:
the documents' line hashes are dealt to the shards' partitions and probe there, and the lines to drop are joined back by
row. Both ways use the same probe and drop the same lines.

A line is known by a 64-bit hash and, in the arrays, a 32-bit fingerprint from a second one.

Defined results: a null or empty text is one empty line, and the text kept is empty; a line's documents are told apart by
doc_id, so repeated rows count once and all rows of the keeping document keep their lines; a null doc_id never keeps a
line that another document holds; input columns named like a result column are replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize
from .common import held, let_go
from .words import BLANK, LOWER, buffers, mix, ranges, span_hashes

MIN_DOCS = 3
MIN_CHARS = 20
SHARD = 1 << 16
MAX_BROADCAST = 128 << 20
NOBODY = -(1 << 63)
ROWS_A_SALT = 100_000
PIECE = 1 << 20
ROWS = 2_000


def lines_of(data: np.ndarray, offsets: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, ...]:
    """Lines of the texts of a run: text, first byte, last byte + 1, hash of the key, whether it has enough characters."""
    a, b = int(offsets[lo]), int(offsets[hi])
    part = data[a:b]
    breaks = np.flatnonzero(part == 10) + a
    heads = offsets[lo:hi]
    start = np.concatenate([heads, breaks + 1])
    order = np.argsort(start, kind="stable")  # of an empty text and the next one's head, the earlier text first
    owner = np.concatenate([np.arange(hi - lo), np.searchsorted(offsets[lo:hi + 1], breaks, side="right") - 1])[order]
    start = start[order]
    is_last = np.append(owner[1:] != owner[:-1], True)
    stop = np.where(is_last, offsets[lo + 1:hi + 1][owner], np.append(start[1:], 0) - 1)
    # The key: without blanks at both ends.
    filled = np.concatenate([[0], np.cumsum(~BLANK[part])])
    inked = np.flatnonzero(~BLANK[part]) + a
    low, high = filled[start - a], filled[stop - a]
    some = high > low
    first, last = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
    first[some], last[some] = inked[low[some]], inked[high[some] - 1] + 1
    points = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])
    size = np.zeros(len(start), np.int64)
    size[some] = points[last[some] - a] - points[first[some] - a]
    counted = size >= MIN_CHARS
    key = np.zeros(len(start), np.uint64)
    if counted.any():
        edges = np.stack([first[counted] - a, last[counted] - a], 1).ravel()  # lines follow one another
        inner = np.concatenate([[0], edges, [b - a]])
        key[counted] = span_hashes(LOWER[part], inner)[1::2]
    return owner, start, stop, key, counted


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    let_go()
    for batch in batches:
        data, offsets = buffers(batch.column(1))
        for lo, hi in _runs(offsets):
            owner, _, _, key, counted = lines_of(data, offsets, lo, hi)
            owner, key = owner[counted], key[counted]
            order = np.lexsort((key, owner))
            owner, key = owner[order], key[order]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo).take(pa.array(owner[new])), pa.array(key[new].view(np.int64))], names=["doc_id", "key"])


def _runs(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    return ranges(offsets, PIECE)


def repeated_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """key, docs, keeper of the line keys found in at least ``min_docs`` documents."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    held = docs.select("doc_id", "text").mapInArrow(_keys, f"doc_id {kind}, key long").distinct()
    counted = held.groupBy("key").agg(F.count("*").alias("docs"), F.max("doc_id").cast("long").alias("keeper"))
    return counted.where(F.col("docs") >= min_docs).withColumn("keeper", F.coalesce("keeper", F.lit(NOBODY)))


# ---- the index ------------------------------------------------------------------------------------------------------

def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix(keys ^ np.uint64(0x1234567887654321)) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Bit levels over distinct 64-bit keys; ``place`` is a bijection of the keys to 0..n-1."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        sums = [np.concatenate([[0], np.cumsum(x)]) for x in levels]
        base = np.concatenate([[0], np.cumsum([s[-1] for s in sums])])
        self.ranks = [s[:-1] + b for s, b in zip(sums, base)]

    @staticmethod
    def _slot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys):
            size = 2 * len(keys)
            slot = cls._slot(keys, len(levels), size)
            hits = np.bincount(slot, minlength=size)
            levels.append(hits == 1)
            keys = keys[hits[slot] != 1]
        return cls(levels)

    def place(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key; a key never added gets some place or -1."""
        found, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            slot = self._slot(keys[open_], level, len(bits))
            hit = bits[slot]
            found[open_[hit]] = self.ranks[level][slot[hit]]
            open_ = open_[~hit]
        return found


class Shard:
    def __init__(self, bits: bytes, sizes: list[int], prints: bytes, counts: bytes, keepers: bytes):
        packed, at, levels = np.frombuffer(bits, np.uint8), 0, []
        for size in sizes:
            levels.append(np.unpackbits(packed[at:at + (size + 7) // 8], count=size).astype(bool))
            at += (size + 7) // 8
        self.hash = PerfectHash(levels)
        self.prints, self.counts, self.keepers = np.frombuffer(prints, np.uint32), np.frombuffer(counts, np.int64), np.frombuffer(keepers, np.int64)

    def probe(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each key is in the shard, and its keeper."""
        place = self.hash.place(keys)
        hit = (place >= 0) & (self.prints[place] == fingerprint(keys)) if len(self.prints) else np.zeros(len(keys), bool)
        return hit, np.where(hit, self.keepers[place], 0) if len(self.prints) else np.zeros(len(keys), np.int64)


INDEX = "shard int, bits binary, sizes array<int>, prints binary, counts binary, keepers binary"


def _build_shard(table: pa.Table) -> pa.Table:
    keys = table.column("key").to_numpy().view(np.uint64)
    made = PerfectHash.build(keys)
    order = np.empty(len(keys), np.int64)
    order[made.place(keys)] = np.arange(len(keys))
    return pa.table({
        "shard": pa.array([table.column("shard")[0].as_py()], pa.int32()), "bits": pa.array([b"".join(np.packbits(x).tobytes() for x in made.levels)], pa.binary()),
        "sizes": pa.array([[len(x) for x in made.levels]], pa.list_(pa.int32())), "prints": pa.array([fingerprint(keys)[order].tobytes()], pa.binary()),
        "counts": pa.array([table.column("docs").to_numpy()[order].astype(np.int64).tobytes()], pa.binary()),
        "keepers": pa.array([table.column("keeper").to_numpy()[order].astype(np.int64).tobytes()], pa.binary())})


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mix(keys) >> np.uint64(8)) % np.uint64(shards)


def build_index(repeated: DataFrame, shard: int = SHARD) -> tuple[DataFrame, int]:
    """The index, one row per shard, and the number of shards."""
    repeated = materialize(repeated, "lines-repeated")
    shards = max(1, -(-repeated.count() // shard))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = shard_of(batch.column(0).to_numpy().view(np.uint64), shards).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at)], names=["key", "docs", "keeper", "shard"])

    dealt = repeated.select("key", "docs", "keeper").mapInArrow(deal, "key long, docs long, keeper long, shard int")
    return materialize(dealt.groupBy("shard").applyInArrow(_build_shard, INDEX), "lines-index"), shards


# ---- documents ------------------------------------------------------------------------------------------------------

def _numbers(ids: pa.Array) -> np.ndarray:
    return np.asarray(ids.cast(pa.int64()).fill_null(NOBODY))


def _dropped(shards: dict[int, Shard], count: int, keys: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which of the lines (key, document) go."""
    drop, at = np.zeros(len(keys), bool), shard_of(keys, count)
    for number in np.unique(at):
        mine = np.flatnonzero(at == number)
        if int(number) in shards:
            hit, keeper = shards[int(number)].probe(keys[mine])
            drop[mine] = hit & (keeper != ids[mine])
    return drop


def _rebuilt(column: pa.Array, data, offsets, cuts: list) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Texts without the dropped lines, lines, dropped lines. ``cuts``: per run (lo, owner, start, stop, drop)."""
    kept, lines, gone = [], np.zeros(len(column), np.int64), np.zeros(len(column), np.int64)
    for lo, hi, owner, start, stop, drop in cuts:
        lines[lo:hi] = np.bincount(owner, minlength=hi - lo)
        gone[lo:hi] = np.bincount(owner, drop, hi - lo).astype(np.int64)
        first = np.concatenate([[0], np.cumsum(lines[lo:hi])])
        for i in range(hi - lo):
            a, b = int(first[i]), int(first[i + 1])
            if not gone[lo + i]:
                kept.append(data[offsets[lo + i]:offsets[lo + i + 1]].tobytes())
            else:
                kept.append(b"\n".join([data[s:e].tobytes() for s, e, d in zip(start[a:b], stop[a:b], drop[a:b]) if not d]))
    return pa.array(kept, pa.binary()).cast(pa.string()), pa.array(lines), pa.array(gone)


def _shards(shared) -> dict[int, Shard]:
    name, rows = shared.value
    return held(f"lines-{name}", lambda: {number: Shard(*parts) for number, *parts in rows})


def drop_lines(docs: DataFrame, min_docs: int = MIN_DOCS, shard: int = SHARD, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """``docs`` with the text kept, plus n_lines (before) and n_dropped."""
    docs = docs.drop("n_lines", "n_dropped")
    index, count = build_index(repeated_lines(docs, min_docs), shard)
    size = index.agg(F.sum(F.octet_length("bits") + F.octet_length("prints") + F.octet_length("counts") + F.octet_length("keepers"))).first()[0] or 0
    if size <= max_broadcast:
        rows = [tuple(r) for r in index.collect()]  # at most max_broadcast bytes
        shared = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, rows))
        return _probe_here(docs, shared, count)
    return _probe_by_shard(docs, index, count)


def _result_schema(docs: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + ", n_lines long, n_dropped long"


def _probe_here(docs: DataFrame, shared, count: int) -> DataFrame:
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(i, ROWS) for whole in batches for i in range(0, max(whole.num_rows, 1), ROWS)):
            text, ids = batch.column(names.index("text")), _numbers(batch.column(names.index("doc_id")))
            data, offsets = buffers(text)
            cuts = []
            for lo, hi in _runs(offsets):
                owner, start, stop, key, counted = lines_of(data, offsets, lo, hi)
                drop = np.zeros(len(key), bool)
                drop[counted] = _dropped(_shards(shared), count, key[counted], ids[lo:hi][owner[counted]])
                cuts.append((lo, hi, owner, start, stop, drop))
            kept, lines, gone = _rebuilt(text, data, offsets, cuts)
            columns = [kept if n == "text" else c for n, c in zip(names, batch.columns)]
            yield pa.RecordBatch.from_arrays([*columns, lines, gone], names=[*names, "n_lines", "n_dropped"])

    return docs.mapInArrow(run, _result_schema(docs))


def _probe_by_shard(docs: DataFrame, index: DataFrame, count: int) -> DataFrame:
    """The same without a broadcast: line hashes go to the shards, the numbers of dropped lines come back to the rows."""
    docs = materialize(docs.withColumn("_row", F.monotonically_increasing_id()), "lines-rows")
    names = docs.columns

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(2))
            ids, rows = _numbers(batch.column(1)), np.asarray(batch.column(0))
            for lo, hi in _runs(offsets):
                owner, _, _, key, counted = lines_of(data, offsets, lo, hi)
                line = np.arange(len(owner)) - np.searchsorted(owner, owner, side="left")
                owner, key = owner[counted], key[counted]
                yield pa.RecordBatch.from_arrays([pa.array(shard_of(key, count).astype(np.int32)), pa.array(rows[lo:hi][owner]), pa.array(ids[lo:hi][owner]), pa.array(line[counted].astype(np.int32)),
                                                  pa.array(key.view(np.int64))], names=["shard", "row", "id", "line", "key"])

    # A very common line sends a probe from every document to one shard: shards are split by a part of the row as well.
    salts = max(1, -(-docs.count() // ROWS_A_SALT))
    probes = docs.select("_row", "doc_id", "text").mapInArrow(lines, "shard int, row long, id long, line int, key long").withColumn("salt", F.pmod("row", F.lit(salts)).cast("int"))
    copies = index.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))

    def probe(left: pa.Table, right: pa.Table) -> pa.Table:
        keys, ids = left.column("key").to_numpy().view(np.uint64), left.column("id").to_numpy()
        drop = np.zeros(len(keys), bool)
        if right.num_rows and len(keys):
            row = right.to_pylist()[0]
            hit, keeper = Shard(row["bits"], row["sizes"], row["prints"], row["counts"], row["keepers"]).probe(keys)
            drop = hit & (keeper != ids)
        return left.select(["row", "line"]).filter(pa.array(drop))

    hits = probes.groupBy("shard", "salt").cogroup(copies.groupBy("shard", "salt")).applyInArrow(probe, "row long, line int")
    gone = hits.groupBy("row").agg(F.collect_list("line").alias("_gone")).withColumnRenamed("row", "_row")  # at most a text's lines
    joined = docs.join(gone, "_row", "left")
    both = joined.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, dropped = batch.column(both.index("text")), batch.column(both.index("_gone")).to_pylist()
            data, offsets = buffers(text)
            cuts = []
            for lo, hi in _runs(offsets):
                owner, start, stop, _, _ = lines_of(data, offsets, lo, hi)
                first, drop = np.searchsorted(owner, np.arange(hi - lo)), np.zeros(len(owner), bool)
                for i in range(lo, hi):
                    if dropped[i]:
                        drop[first[i - lo] + np.array(dropped[i])] = True
                cuts.append((lo, hi, owner, start, stop, drop))
            kept, n, gone_ = _rebuilt(text, data, offsets, cuts)
            columns = [kept if name == "text" else batch.column(both.index(name)) for name in names if name != "_row"]
            yield pa.RecordBatch.from_arrays([*columns, n, gone_], names=[*[x for x in names if x != "_row"], "n_lines", "n_dropped"])

    return joined.mapInArrow(run, _result_schema(docs.drop("_row")))
