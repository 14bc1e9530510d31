"""Prefix trie of conversations, built as ternary search trees over range shards.

A turn is known by 20 bytes: the MD5 of its role and text and the length of its text, so a conversation is a byte string
and byte order is the order of its turns. Conversations are ordered by these strings and dealt into range shards.
Each shard numbers its turns (a dictionary), puts its distinct conversations into a ternary search tree, the median of
every range first so that siblings stay balanced, and walks the tree without recursion, adding up members, leaves and
savings from the leaves on. A node can only be in several shards if it begins the shard's first or last conversation.
These boundary nodes are not finished in the shard: each shard gives them as two rows of partial sums, one for the path
of its first and one for that of its last conversation, and a single pass over all these rows in shard order, holding
one path at a time, merges them. The other nodes are final, but for the id of a parent that is a boundary node, which
is joined from the merged rows.

Texts are read once and never shuffled, only their 20 bytes. A group of equal conversations is dealt over shards by
conversation id, so a hot one is no single task's work; the ids that end at such a node come as one text per shard and
are hashed as a stream. What one task holds: a shard (about ``SHARD`` turns, or one longer conversation), and in the merge
one path with the shard row at hand. The merge reads two rows a shard.

Defined results: rows without conversation id belong to no conversation; turns are ordered by turn (null first), equal
ones by the MD5 of role and text, and repeated rows count as turns of their own; null roles and texts are empty; ``%`` is
the one of SQL, so a negative id's first conversation is the next multiple towards zero; an empty table has no nodes, not
even the root; other columns play no part, whatever their names. Texts are of any length; a conversation of more than
``SORTED_TURNS`` turns stands whole in the shard that its first ``SORTED_TURNS`` turns lead to.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..sources.scratch import materialize
from .common import crc_fold

WIDTH = 20
SHARD = 200_000
SORTED_TURNS = 400
BLOCK, FOLDS = 5, 9
_INNER = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_SHARD_ROWS = _INNER + ", shard int, at_last boolean, path binary, lows array<long>, members array<long>, children array<long>, leaves array<long>, saved array<long>, ends array<string>"
_MERGED = _INNER + ", shard int, at_last boolean"


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, turn and the 20 bytes of each turn."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    digest = F.unhex(F.md5(F.concat_ws(":", F.length(role).cast("string"), role, text)))
    size = F.unhex(F.lpad(F.hex(F.octet_length(text)), 8, "0"))
    return conversations.where("conv_id is not null").select("conv_id", "turn", F.concat(digest, size).alias("key"))


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole conversations from rows in order of block, first conversation of the block first, id, turn.

    The first turns of the first conversation replace as many of each other one's."""
    head: list[bytes] = []
    block = conv = None
    own: list[bytes] = []
    kept = 0
    made: list[tuple[int, bytes]] = []

    def finish() -> None:
        made.append((conv, b"".join(head[:kept] + own[kept:])))

    for batch in batches:
        for b, c, first, fold, key in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if c != conv or b != block:
                if conv is not None:
                    finish()
                if b != block:
                    block, head = b, []
                conv, own, kept = c, [], fold
            own.append(key)
            if first and len(head) < FOLDS - 1:
                head.append(key)
        if made:
            yield _paths(made)
            made = []
    if conv is not None:
        finish()
        yield _paths(made)


def _paths(made: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([c for c, _ in made], pa.int64()), pa.array([p for _, p in made], pa.binary())], names=["conv_id", "path"])


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id and path (20 bytes a turn) of each conversation with its first turns replaced."""
    first = F.col("conv_id") - F.col("conv_id") % BLOCK
    rows = turn_rows(conversations).select(
        first.alias("block"), "conv_id", (F.col("conv_id") == first).alias("first"), crc_fold(F.col("conv_id"), FOLDS).alias("fold"), "key", "turn")
    ordered = rows.repartition("block").sortWithinPartitions("block", F.desc("first"), "conv_id", F.asc_nulls_first("turn"), "key")
    return ordered.drop("turn").mapInArrow(_rebuild, "conv_id long, path binary")


class Tree:
    """A ternary search tree of number sequences. ``same`` leads to the next turn, ``less`` and ``more`` to siblings."""

    def __init__(self) -> None:
        self.turn, self.less, self.same, self.more = [-1], [-1], [-1], [-1]

    def _node(self, turn: int) -> int:
        self.turn.append(turn)
        for links in (self.less, self.same, self.more):
            links.append(-1)
        return len(self.turn) - 1

    def insert(self, sequence: list[int]) -> list[int]:
        """The nodes of a sequence, made where missing. Node 0 is the root."""
        at, path = 0, [0]
        turn, less, same, more = self.turn, self.less, self.same, self.more
        for x in sequence:
            below = same[at]
            if below < 0:
                below = same[at] = self._node(x)
            while turn[below] != x:
                links = less if x < turn[below] else more
                if links[below] < 0:
                    links[below] = self._node(x)
                below = links[below]
            at = below
            path.append(at)
        return path

    def insert_all(self, ordered: list[list[int]]) -> list[int]:
        """Ends of sequences given in order: medians first."""
        ends, ranges = [0] * len(ordered), [(0, len(ordered))]
        while ranges:
            lo, hi = ranges.pop()
            if lo < hi:
                mid = (lo + hi) // 2
                ends[mid] = self.insert(ordered[mid])[-1]
                ranges += [(lo, mid), (mid + 1, hi)]
        return ends

    def walk(self) -> tuple[list[int], list[int], list[int]]:
        """All nodes, parents before children, with parent and depth."""
        order, parents, depths = [0], [-1], [0]
        waiting = [(self.same[0], 0, 1)]
        while waiting:
            node, parent, depth = waiting.pop()
            if node < 0:
                continue
            order.append(node)
            parents.append(parent)
            depths.append(depth)
            waiting += [(self.less[node], parent, depth), (self.more[node], parent, depth), (self.same[node], node, depth + 1)]
        return order, parents, depths


def _joined(ids: np.ndarray) -> str:
    return ",".join(map(str, ids.tolist()))


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


_NO_ENDS = _sha("")


def shard_rows(conv_ids: np.ndarray, paths: list[bytes]) -> dict[str, list]:
    """Final inner nodes and the two boundary rows of one shard, from its conversations in order of path and id."""
    firsts = [i for i, p in enumerate(paths) if i == 0 or p != paths[i - 1]]
    distinct = [paths[i] for i in firsts]
    keys, numbers = np.unique(np.frombuffer(b"".join(distinct), f"S{WIDTH}"), return_inverse=True) if any(distinct) else ([], np.empty(0, np.int64))
    at = np.cumsum([0] + [len(p) // WIDTH for p in distinct])
    numbers = numbers.tolist()
    sequences = [numbers[a:b] for a, b in zip(at, at[1:])]
    # The bytes of a turn end in the length of its text; trailing zero bytes are cut off in keys.
    sizes = [int.from_bytes(bytes(k).ljust(WIDTH, b"\0")[16:], "big") for k in keys]
    tree = Tree()
    ends = tree.insert_all(sequences)
    count = len(tree.turn)
    order, parents, depths = tree.walk()
    parent, depth = [-1] * count, [0] * count
    for node, up, d in zip(order, parents, depths):
        parent[node], depth[node] = up, d
    first_path, last_path = tree.insert(sequences[0]), tree.insert(sequences[-1])
    boundary = [False] * count
    for node in first_path + last_path:
        boundary[node] = True
    members, low, children, leaves, saved, said = [0] * count, [None] * count, [0] * count, [0] * count, [0] * count, [None] * count
    groups = np.split(conv_ids, firsts[1:])
    for node, ids in zip(ends, groups):
        members[node], low[node], said[node] = len(ids), int(ids[0]), _joined(ids)
    for node in reversed(order):  # children before parents; boundary nodes leave out what is their own
        if not boundary[node]:
            leaves[node] += children[node] == 0
            saved[node] += (members[node] - 1) * sizes[tree.turn[node]]
        up = parent[node]
        if up >= 0:
            members[up] += members[node]
            low[up] = low[node] if low[up] is None else min(low[up], low[node])
            leaves[up] += leaves[node]
            saved[up] += saved[node]
            children[up] += not boundary[node]
    out: dict[str, list] = {n: [] for n in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "at_last")}
    on_last = set(last_path) - set(first_path)
    for node in order:
        if boundary[node]:
            continue
        up = parent[node]
        row = (low[node], depth[node], None if boundary[up] else low[up], members[node], children[node], leaves[node], saved[node],
               _NO_ENDS if said[node] is None else _sha(said[node]), up in on_last)
        for values, x in zip(out.values(), row):
            values.append(x)
    sides = []
    for at_last, path, shared in ((False, first_path, set()), (True, last_path, set(first_path))):
        # What both paths have in common is counted with the first.
        sides.append((at_last, (paths[0], paths[-1])[at_last], *([empty if n in shared else values[n] for n in path] for values, empty in (
            (low, None), (members, 0), (children, 0), (leaves, 0), (saved, 0), (said, None)))))
    return {**out, "sides": sides}


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(T.StructType.fromDDL(ddl))


def _shards(schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, paths = [], []
    for batch in batches:
        ids.append(batch.column(0).to_numpy(zero_copy_only=False))
        paths += batch.column(1).to_pylist()
    if not paths:
        return
    shard = TaskContext.get().partitionId()
    found = shard_rows(np.concatenate(ids), paths)
    sides = found.pop("sides")
    n = len(found["depth"])
    columns = {k: v + [None] * 2 for k, v in found.items()}
    columns["at_last"][n:] = [s[0] for s in sides]
    for i, name in enumerate(("path", "lows", "members", "children", "leaves", "saved", "ends")):
        columns[name] = [None] * n + [s[i + 1] for s in sides]
    columns["shard"] = [shard] * (n + 2)
    whole = pa.RecordBatch.from_pydict({f.name: columns[f.name] for f in schema}, schema=schema)
    for a in range(0, n + 2, 20_000):
        yield whole.slice(a, 20_000)


class _Open:
    """A boundary node while the pass is on it or on its parent. ``own_``: what boundary nodes below add, itself included."""

    def __init__(self, depth: int, size: int):
        self.depth, self.size = depth, size
        self.low = self.sha = None
        self.members = self.children = self.leaves = self.saved = self.own_leaves = self.own_saved = 0
        self.seen: list[tuple[int, bool]] = []
        self.below: list[_Open] = []

    def add(self, row: dict, at: int) -> None:
        """One shard's part of the node."""
        if not self.seen or self.seen[-1][0] != row["shard"]:
            self.seen.append((row["shard"], row["at_last"]))
        low, ends = row["lows"][at], row["ends"][at]
        if low is not None:
            self.low = low if self.low is None else min(self.low, low)
        self.members += row["members"][at]
        self.children += row["children"][at]
        self.leaves += row["leaves"][at]
        self.saved += row["saved"][at]
        if ends is not None:
            if self.sha is None:
                self.sha = hashlib.sha256()
            else:
                self.sha.update(b",")
            self.sha.update(ends.encode())

    def rows(self, up: int | None) -> list[tuple]:
        """The finished node at its first place; its other places carry the id alone."""
        sha = _NO_ENDS if self.sha is None else self.sha.hexdigest()
        whole = (self.low, self.depth, up, self.members, self.children, self.leaves + self.own_leaves, self.saved + self.own_saved, sha)
        return [((*whole, *place) if i == 0 else (self.low, self.depth, *[None] * 6, *place)) for i, place in enumerate(self.seen)]


def _merge(schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merged boundary nodes from the shards' rows in order. A node waits for its parent to end, whose id it needs."""
    path: list[bytes] = []
    stack: list[_Open] = []
    out: list[tuple] = []

    def close() -> None:
        node = stack.pop()
        node.own_leaves += node.children == 0
        node.own_saved += (node.members - 1) * node.size
        for x in node.below:
            out.extend(x.rows(node.low))
        node.below = []
        if stack:
            up = stack[-1]
            up.own_leaves += node.own_leaves
            up.own_saved += node.own_saved
            up.children += 1
            up.below.append(node)
        else:
            out.extend(node.rows(None))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            turns = [row["path"][a:a + WIDTH] for a in range(0, len(row["path"]), WIDTH)]
            common = 0
            while common < min(len(turns), len(path)) and turns[common] == path[common]:
                common += 1
            while len(stack) > common + 1:
                close()
            if not stack:
                stack.append(_Open(0, 0))
            for t in turns[len(stack) - 1:]:
                stack.append(_Open(len(stack), int.from_bytes(t[16:], "big")))
            path = turns
            for at, node in enumerate(stack):
                node.add(row, at)
            if len(out) > 5000:
                yield batch_of(out)
                out.clear()
    while stack:
        close()
    if out:
        yield batch_of(out)


def prefix_trie(conversations: DataFrame, shard: int = SHARD) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations, one row each."""
    spark = conversations.sparkSession
    paths = materialize(rebuilt(conversations), "trie-paths")
    turns = paths.agg(F.sum(F.octet_length("path")) / WIDTH).first()[0] or 0
    count = max(spark.sparkContext.defaultParallelism, ceil(turns / shard))
    long = F.octet_length("path") > SORTED_TURNS * WIDTH
    dealt = paths.repartitionByRange(count, F.substring("path", 1, SORTED_TURNS * WIDTH), long, F.when(~long, F.col("conv_id")))
    rows = materialize(dealt.sortWithinPartitions("path", "conv_id").mapInArrow(partial(_shards, _arrow(_SHARD_ROWS)), _SHARD_ROWS), "trie-shards")
    result = T.StructType.fromDDL(_INNER).names
    sides = rows.where("path is not null").select("shard", "at_last", "path", "lows", "members", "children", "leaves", "saved", "ends")
    merged = materialize(sides.repartition(1).sortWithinPartitions("shard", "at_last").mapInArrow(partial(_merge, _arrow(_MERGED)), _MERGED), "trie-merged")
    inner = rows.where("path is null").select(*result, "shard", "at_last")
    ids = merged.select("shard", "at_last", (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("_parent"))
    below = inner.where("parent_conv_id is null").join(ids, ["shard", "at_last", "depth"]).withColumn("parent_conv_id", F.col("_parent"))
    return inner.where("parent_conv_id is not null").select(result).union(below.select(result)).union(merged.where("n_convs is not null").select(result))
