"""Byte-level BPE encoding and decoding with the vocabulary file of a public tokenizer.

A pre-token's symbols are the leaves of a segment tree that holds, for each pair of neighbours, its merge rank and
place; the root is the leftmost lowest-rank merge. A merge changes three leaves, each in logarithmic time, and merging
ends when the root is empty. The trees of pre-tokens of like length are worked on side by side, one merge in each at a
time, with array operations; a pre-token of more than ``SIDE`` bytes has its tree to itself. Merged pre-tokens are
remembered per worker in tables of bounded size (a memory of results, not a limit: what is not remembered is computed).

Texts are cut before a blank that a non-blank follows. The pre-tokenizer always starts a new pre-token there, so the
pieces between cuts can be encoded one by one. A batch's pieces are found and hashed (64 bits) with array operations,
a few MB at a time whatever the length of a text, and only distinct ones are encoded.

Defined results: a null or empty text has no ids and decodes to the empty text; special tokens written in a text are
encoded as themselves; ids that do not form UTF-8 decode with U+FFFD; input columns ``ids`` or ``decoded`` are replaced.
The vocabulary is read once on the driver and broadcast; its size is that of the file.
"""

from __future__ import annotations

import json
import re
from functools import cached_property, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from .common import add_in_arrow, held
from .remembered import Remembered
from .words import buffers, span_hashes

# Fixed value: the pre-token pattern of byte-level BPE.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SIDE = 33
TREES = 4_096
WINDOW = 1 << 20
ROWS = 500
BATCH = 1000
PRETOKENS = 150_000
_NONE = 1 << 62
_PLAIN = re.compile(rb" ?[A-Za-z]+")  # one pre-token, whatever follows the cut behind it
# Bytes before which a blank is no cut: blanks, and lead bytes of letters among which there are blanks.
_UNCUT = np.zeros(256, bool)
_UNCUT[[*range(0x09, 0x0E), *range(0x1C, 0x21), 0xC2, 0xE1, 0xE2, 0xE3]] = True


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte: itself where printable, else the next letter from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {**{b: chr(b) for b in printable}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


class Vocabulary:
    def __init__(self, text: str):
        spec = json.loads(text)
        if spec.get("normalizer") or spec["pre_tokenizer"] != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}:
            raise ValueError("a byte-level vocabulary without normalizer and prefix space is needed")
        ids, letters = spec["model"]["vocab"], byte_letters()
        self.byte_id = [ids[letters[b]] for b in range(256)]
        self._listed, self._ids = spec["model"]["merges"], ids
        back = {c: b for b, c in letters.items()}
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*ids.values(), *added.values()]) + 1
        self.token_bytes = [b""] * size
        for token, i in ids.items():
            self.token_bytes[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        for token, i in added.items():
            self.token_bytes[i] = token.encode()
        self.added = added
        self.special = re.compile(b"|".join(re.escape(t.encode()) for t in sorted(added, key=len, reverse=True))) if added else None
        self.pattern = regex.compile(PRETOKEN)
        self.pretokens: dict[bytes, bytes] = {}
        self.remembered = Remembered()

    @cached_property
    def merges(self) -> dict[int, tuple[int, int]]:
        """Rank and token of each pair of ids that merges."""
        known: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(self._listed):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            known.setdefault(self._ids[a] << 20 | self._ids[b], (rank, self._ids[a + b]))
        self._listed, self._ids = [], {}
        return known

    @cached_property
    def _sorted(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = sorted(self.merges)
        ranks, news = np.array([[*self.merges[k]] for k in order] + [[0, 0]], np.int64).T
        return np.array([*order, _NONE], np.int64), ranks, news

    def merge(self, ids: list[int]) -> list[int]:
        """All merges of one pre-token, by the segment tree."""
        n, get = len(ids), self.merges.get
        size = 1
        while size < n - 1:
            size *= 2
        tree, merged = [_NONE] * (2 * size), [0] * n
        last = ids[0]
        for i in range(1, n):
            this = ids[i]
            known = get(last << 20 | this)
            if known:
                tree[size + i - 1], merged[i - 1] = known[0] * n + i - 1, known[1]
            last = this
        for i in range(size - 1, 0, -1):
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = a if a < b else b
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while tree[1] != _NONE:
            at = tree[1] % n
            gone = after[at]
            right, left = after[gone], before[at]
            new = ids[at] = merged[at]
            ids[gone], after[at] = -1, right
            changes = []
            value = _NONE
            if right < n:
                before[right] = at
                known = get(new << 20 | ids[right])
                if known:
                    value, merged[at] = known[0] * n + at, known[1]
                changes.append((size + gone, _NONE))
            changes.append((size + at, value))
            if left >= 0:
                known = get(ids[left] << 20 | new)
                if known:
                    changes.append((size + left, known[0] * n + left))
                    merged[left] = known[1]
                else:
                    changes.append((size + left, _NONE))
            for i, value in changes:
                if tree[i] == value:
                    continue
                tree[i] = value
                while i > 1:
                    other = tree[i ^ 1]
                    low = value if value < other else other
                    i >>= 1
                    if tree[i] == low:
                        break
                    tree[i] = value = low
        return [i for i in ids if i >= 0]

    def _known(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether pairs merge, the rank and the merged token."""
        pairs, ranks, news = self._sorted
        key = a << 20 | b
        at = np.searchsorted(pairs, key)
        return pairs[at] == key, ranks[at], news[at]

    def _merge_side_by_side(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """All merges of pre-tokens of at most ``size`` + 1 bytes, ``size`` a power of two: a row of ids each (-1 where none) and how many."""
        rows, levels = len(starts), size.bit_length()
        column = np.arange(size + 1)
        inside = column < lengths[:, None]
        ids = np.where(inside, np.array(self.byte_id)[data[np.where(inside, starts[:, None] + column, 0)]], -1)
        known, rank, merged = self._known(ids[:, :-1], ids[:, 1:])
        tree = np.full((rows, 2 * size), _NONE)
        tree[:, size:] = np.where(known & inside[:, 1:], rank * size + column[:-1], _NONE)
        half = size // 2
        while half:
            tree[:, half:2 * half] = np.minimum(tree[:, 2 * half:4 * half:2], tree[:, 2 * half + 1:4 * half:2])
            half //= 2
        after, before = np.tile(column + 1, (rows, 1)), np.tile(column - 1, (rows, 1))
        live = np.arange(rows)

        def put(row: np.ndarray, leaf: np.ndarray, value: np.ndarray | int) -> None:
            at = leaf + size
            tree[row, at] = value
            for _ in range(levels - 1):
                at = at >> 1
                tree[row, at] = np.minimum(tree[row, 2 * at], tree[row, 2 * at + 1])

        while True:
            live = live[tree[live, 1] != _NONE]
            if not len(live):
                return ids, (ids >= 0).sum(1)
            at = tree[live, 1] % size
            gone = after[live, at]
            right, left, new = after[live, gone], before[live, at], merged[live, at]
            ids[live, at], ids[live, gone], after[live, at] = new, -1, right
            follows = right < lengths[live]
            value = np.full(len(live), _NONE)
            row, to, place = live[follows], right[follows], at[follows]
            before[row, to] = place
            known, rank, pair = self._known(new[follows], ids[row, to])
            value[follows] = np.where(known, rank * size + place, _NONE)
            merged[row, place] = pair
            put(row, gone[follows], _NONE)
            put(live, at, value)
            leads = left >= 0
            row, place = live[leads], left[leads]
            known, rank, pair = self._known(ids[row, place], new[leads])
            merged[row, place] = pair
            put(row, place, np.where(known, rank * size + place, _NONE))

    def merge_all(self, tokens: list[bytes]) -> dict[bytes, bytes]:
        """The ids, as 32-bit integers, of distinct pre-tokens."""
        found: dict[bytes, bytes] = {}
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        data = np.frombuffer(b"".join(tokens), np.uint8)
        starts = np.cumsum(lengths) - lengths
        for i in np.flatnonzero(lengths > SIDE).tolist():
            found[tokens[i]] = np.array(self.merge([self.byte_id[b] for b in tokens[i]]), np.int32).tobytes()
        least, size = 0, 4
        while least < SIDE:
            chosen = np.flatnonzero((lengths > least) & (lengths <= min(size + 1, SIDE)))
            for a in range(0, len(chosen), TREES):
                part = chosen[a:a + TREES]
                ids, counts = self._merge_side_by_side(data, starts[part], lengths[part], size)
                flat, ends = ids[ids >= 0].astype(np.int32).tobytes(), np.cumsum(counts) * 4
                for i, lo, hi in zip(part.tolist(), (ends - counts * 4).tolist(), ends.tolist()):
                    found[tokens[i]] = flat[lo:hi]
            least, size = size + 1, size * 2
        return found

    def encode(self, text: str) -> bytes:
        """The ids of one text as consecutive 32-bit integers."""
        data = text.encode("utf-8", "replace")
        return self.encode_all(np.frombuffer(data, np.uint8), np.array([0, len(data)]))[0].tobytes()

    def encode_all(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of consecutive texts, and how many each has."""
        counts, found = np.zeros(len(bounds) - 1, np.int64), []
        starts = bounds[:-1][np.diff(bounds) > 0]
        whole = data[bounds[0]:bounds[-1]]
        specials = [(bounds[0] + m.start(), bounds[0] + m.end(), self.added[m.group().decode()]) for m in self.special.finditer(memoryview(whole))] if self.special and len(whole) else []
        inside = np.searchsorted(bounds, [x[0] for x in specials], side="right") - 1
        specials = [x for x, i in zip(specials, inside) if x[1] <= bounds[i + 1]]  # none across two texts
        starts = np.sort(np.concatenate([starts, np.array([p for x in specials for p in x[:2]], np.int64)]))
        fixed, at = {x[0]: x[2] for x in specials}, int(bounds[0])
        while at < bounds[-1]:
            stop = int(min(at + WINDOW, bounds[-1]))
            begin = self._begins(data, at, stop, starts)
            while stop < bounds[-1] and len(begin) < 2:  # a piece longer than a window
                stop = int(min(stop + WINDOW, bounds[-1]))
                begin = self._begins(data, at, stop, starts)
            if stop < bounds[-1]:
                begin, stop = begin[:-1], int(begin[-1])
            ids, sizes = self._window(data, np.append(begin, stop), fixed)
            found.append(ids)
            np.add.at(counts, np.searchsorted(bounds, begin, side="right") - 1, sizes)
            at = stop
        return (np.concatenate(found) if found else np.empty(0, np.int32)), counts

    @staticmethod
    def _begins(data: np.ndarray, at: int, stop: int, starts: np.ndarray) -> np.ndarray:
        part = data[at:stop]
        begins = np.zeros(len(part), bool)
        begins[:-1] = (part[:-1] == 0x20) & ~_UNCUT[part[1:]]
        begins[0] = True
        begins[starts[np.searchsorted(starts, at):np.searchsorted(starts, stop)] - at] = True
        return np.flatnonzero(begins) + at

    def _window(self, data: np.ndarray, edges: np.ndarray, fixed: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        def make(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            base, whole = int(edges[0]), data[edges[0]:edges[-1]].tobytes()
            if len(self.pretokens) >= PRETOKENS:
                self.pretokens.clear()
            known, split, plain = self.pretokens, self.pattern.findall, _PLAIN.fullmatch
            pieces: list[list[bytes]] = []
            for a, b in zip((edges[chosen] - base).tolist(), (edges[chosen + 1] - base).tolist()):
                piece = whole[a:b]
                if a + base in fixed:
                    pieces.append([])
                else:
                    pieces.append([piece] if plain(piece) else [t.encode() for t in split(piece.decode("utf-8", "replace"))])
            new = self.merge_all(list({t for tokens in pieces for t in tokens if t not in known}))
            made = [b"".join([new[t] if t in new else known[t] for t in tokens]) for tokens in pieces]
            for i, at in enumerate(edges[chosen].tolist()) if fixed else ():
                if at in fixed:
                    made[i] = np.int32(fixed[at]).tobytes()
            known.update((t, ids) for t, ids in new.items() if len(t) < 64)
            return np.frombuffer(b"".join(made), np.int32), np.fromiter(map(len, made), np.int64, len(made)) // 4

        return self.remembered.look_up(span_hashes(data, edges), make)


def _vocabulary(shared) -> Vocabulary:
    name, text = shared.value
    return held(f"bpe-{name}", lambda: Vocabulary(text))


def _shared(df: DataFrame, vocabulary: str | None):
    with open(vocabulary or default_vocabulary(), encoding="utf-8") as file:
        text = file.read()
    return df.sparkSession.sparkContext.broadcast((hash(text), text))


def _encode_batch(shared, batch: pa.RecordBatch) -> list[pa.Array]:
    known = _vocabulary(shared)
    column = batch.column(batch.schema.names.index("text"))
    data, offsets = buffers(column)
    ids, counts = known.encode_all(data, offsets)
    return [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(ids))]


def _decode_batch(shared, batch: pa.RecordBatch) -> list[pa.Array]:
    known = _vocabulary(shared)
    if not hasattr(known, "token_array"):
        known.token_array = pa.array(known.token_bytes, pa.large_binary())
    ids = batch.column(batch.schema.names.index("ids"))
    if ids.null_count:
        ids = pc.fill_null(ids, pa.scalar([], ids.type))
    parts = [_joined(known.token_array, ids.slice(i, ROWS)) for i in range(0, len(ids), ROWS)]
    return [pa.concat_arrays(parts) if parts else pa.array([], pa.string())]


def _joined(tokens: pa.Array, ids: pa.Array) -> pa.Array:
    """The texts of a few rows of ids."""
    ends = np.asarray(ids.offsets).astype(np.int64)
    joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(ends - ends[0]), tokens.take(ids.flatten())), pa.scalar(b"", pa.large_binary()))
    try:
        return joined.cast(pa.large_string()).cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([x.as_py().decode("utf-8", "replace") for x in joined], pa.string())


def encode(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``docs`` plus ``ids``: the whole text encoded, no special tokens added."""
    return add_in_arrow(docs, "ids array<int>", partial(_encode_batch, _shared(docs, vocabulary)), rows=BATCH)


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """``encoded`` plus ``decoded``: the text its ``ids`` stand for, special tokens included."""
    return add_in_arrow(encoded, "decoded string", partial(_decode_batch, _shared(encoded, vocabulary)), rows=BATCH)
