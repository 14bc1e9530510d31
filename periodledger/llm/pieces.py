"""Encoding and decoding with the model file of a public merge-type SentencePiece tokenizer.

A sequence of tokens is what merging yields exactly if each token is what its own letters merge to and each two
neighbours are what their joined letters merge to. So a text is encoded from left to right without merging it: an
Aho-Corasick automaton gives the longest token at each place, a token is taken if it goes with the one before it (found
out by merging the letters of the two again, remembered per pair), otherwise the next shorter one is tried, and without
one the last token is taken back. A bit per place remembers where no encoding goes on, so that no place is tried twice.

Texts are cut where no token of the model can reach across: before a blank behind another letter and around line ends,
if the model's tokens allow it. A batch's pieces between cuts are hashed (64 bits) with array operations, a few MB at a
time whatever the length of a text; distinct ones are encoded together and remembered per worker in tables of bounded
size (a memory of results, not a limit: what is not remembered is computed).

Defined results: a null or empty text is the end id alone and decodes to the empty text; letters the model does not know
become byte tokens; control tokens written in a text are ordinary letters; a text of blanks keeps them; bytes that form no
UTF-8 decode with one U+FFFD each; repeated rows get equal results; an empty table gives an empty one; input columns
``ids`` or ``decoded`` are replaced. The model is read once on the driver and broadcast; its size is that of the file.
"""

from __future__ import annotations

import codecs
import struct
from collections.abc import Iterator
from functools import cached_property, partial

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import add_in_arrow, held
from .remembered import Remembered
from .words import buffers, mix, span_hashes

BLANK = "▁"
PAIRS = 300_000
WINDOW = 1 << 21
ROWS = 500
BATCH = 2000
# Kinds of tokens in a model file, and the model type of merges.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MERGES = 2
_FIRST = np.uint64(0xA5A5_5A5A_0F0F_F0F1)

codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def message_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of the fields of one protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, data[at:at + size]
        at += size


class Model:
    def __init__(self, data: bytes):
        tokens, self.kinds, scores = [], [], []
        flags = {"type": 1, "bytes": 0, "suffix": 0, "charsmap": b"", "prefix": 1, "squeeze": 1, "escape": 1, "surface": " ⁇ ".encode()}
        names = {2: {3: "type", 24: "suffix", 35: "bytes", 44: "surface"}, 3: {2: "charsmap", 3: "prefix", 4: "squeeze", 5: "escape"}}
        for field, value in message_fields(data):
            if field == 1:
                token = dict(message_fields(value))
                tokens.append(token.get(1, b"").decode())
                scores.append(struct.unpack("<f", token[2])[0] if 2 in token else 0.0)
                self.kinds.append(token.get(3, NORMAL))
            elif field in names:
                flags.update({names[field][k]: v for k, v in message_fields(value) if k in names[field]})
        if (flags["type"], flags["bytes"], flags["suffix"], flags["charsmap"], flags["prefix"], flags["squeeze"], flags["escape"]) != (MERGES, 1, 0, b"", 1, 0, 1):
            raise ValueError("a model of merges with byte tokens, a blank in front and no normalisation is needed")
        if not set(self.kinds) <= {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("user-defined and unused tokens are not supported")
        self.byte_ids = [0] * 256
        self.token_bytes = [b""] * len(tokens)
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        for i, (token, kind) in enumerate(zip(tokens, self.kinds)):
            if kind == BYTE:
                self.byte_ids[int(token[3:5], 16)] = i
                self.token_bytes[i] = bytes([int(token[3:5], 16)])
            elif kind == UNKNOWN:
                self.token_bytes[i] = flags["surface"]
            elif kind == NORMAL:
                self.token_bytes[i] = token.replace(BLANK, " ").encode()
                self.score[token], self.id[token] = scores[i], i
        self.end = tokens.index("</s>")
        self.leads = np.array([k == NORMAL and t.startswith(BLANK) for t, k in zip(tokens, self.kinds)])
        self.spoken = np.array([k != CONTROL for k in self.kinds])
        self.spelled = pa.array([*self.token_bytes, *[b[1:] for b in self.token_bytes]], pa.large_binary())
        self.cut_blanks = not any(a != BLANK and b == BLANK for t in self.id for a, b in zip(t, t[1:]))
        self.cut_lines = not any("\n" in t for t in self.id)
        letters = {c for t in self.id for c in t}
        self.between = next(c for c in map(chr, range(1, 0x10FFFF)) if c not in letters)
        # Letters that occur in tokens but are none: they take part in merges and become bytes when left alone.
        for letter in sorted(letters - set(self.id)):
            self.id[letter] = len(self.id) + len(tokens)
        self.text = {i: t for t, i in self.id.items()}
        self.tokens = len(tokens)
        self.pairs: dict[int, bool] = {}
        self.remembered = Remembered()

    def merge(self, text: str) -> list[str]:
        """What the letters of a short text merge to: the leftmost of the best pairs first."""
        parts, score = list(text), self.score
        ranks = [score.get(a + b) for a, b in zip(parts, parts[1:])]
        while True:
            best = max((r for r in ranks if r is not None), default=None)
            if best is None:
                return parts
            at = ranks.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = score.get(parts[at] + parts[at + 1])
            if at:
                ranks[at - 1] = score.get(parts[at - 1] + parts[at])

    @cached_property
    def walker(self) -> tuple[ahocorasick.Automaton, list[int], list[int]]:
        """The automaton of the tokens that their own letters merge to, their lengths, and each one's next shorter beginning."""
        whole = {t: i for t, i in self.id.items() if len(t) == 1 or self.merge(t) == [t]}
        automaton = ahocorasick.Automaton()
        size, shorter = [0] * (max(self.id.values()) + 1), [-1] * (max(self.id.values()) + 1)
        for token, i in whole.items():
            size[i] = len(token)
            automaton.add_word(token, i)
            shorter[i] = next((whole[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in whole), -1)
        automaton.make_automaton()
        return automaton, size, shorter

    def _together(self, key: int) -> bool:
        a, b = self.text[key >> 20], self.text[key & 0xFFFFF]
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        known = self.pairs[key] = self.merge(a + b) == [a, b]
        return known

    def backtrack(self, text: str) -> tuple[list[int], list[int]]:
        """Tokens of a text and their places. An unknown letter is token -1."""
        n = len(text)
        automaton, size, shorter = self.walker
        longest = [-1] * (n + 1)
        for last, token in automaton.iter(text):
            longest[last + 1 - size[token]] = token  # longer ones end later
        failed = bytearray((n >> 3) + 1)
        pairs, together = self.pairs, self._together
        tokens, places = [], []
        at, token = 0, longest[0]
        while at < n:
            after = at + (size[token] if token >= 0 else 1)
            fits = not failed[after >> 3] >> (after & 7) & 1
            if fits and token >= 0 and tokens and tokens[-1] >= 0:
                key = tokens[-1] << 20 | token
                known = pairs.get(key)
                fits = together(key) if known is None else known
            if fits:
                tokens.append(token)
                places.append(at)
                at, token = after, longest[after]
            elif token >= 0 and shorter[token] >= 0:
                token = shorter[token]
            else:  # nothing goes on here: take the last token back
                failed[at >> 3] |= 1 << (at & 7)
                token, at = tokens.pop(), places.pop()
        return tokens, places

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of separate pieces one after another, and how many each has."""
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)) + 1) - 1
        text = self.between.join(pieces)
        tokens, places = self.backtrack(text)
        ids, places = np.array(tokens, np.int64), np.array(places, np.int64)
        owner = np.searchsorted(ends, places)
        inside = places != ends[owner]
        ids, places, owner = ids[inside], places[inside], owner[inside]
        loose = np.flatnonzero((ids < 0) | (ids >= self.tokens))
        if len(loose):  # as bytes
            spelled = [text[p].encode("utf-8", "replace") for p in places[loose].tolist()]
            repeats = np.ones(len(ids), np.int64)
            repeats[loose] = [len(b) for b in spelled]
            ids, owner = np.repeat(ids, repeats), np.repeat(owner, repeats)
            where = np.flatnonzero((ids < 0) | (ids >= self.tokens))
            ids[where] = np.array(self.byte_ids)[np.frombuffer(b"".join(spelled), np.uint8)]
        return ids, np.bincount(owner, minlength=len(pieces))

    def _begins(self, data: np.ndarray, at: int, stop: int, starts: np.ndarray) -> np.ndarray:
        part = data[at:stop]
        begins = np.zeros(len(part), bool)
        if self.cut_blanks:  # not behind a blank; 0x81 may end a written one
            begins[1:] = (part[1:] == 0x20) & (part[:-1] != 0x20) & (part[:-1] != 0x81)
        if self.cut_lines:
            line = part == 0x0A
            begins |= line
            begins[1:] |= line[:-1]
        begins[0] = True
        begins[starts[np.searchsorted(starts, at):np.searchsorted(starts, stop)] - at] = True
        return np.flatnonzero(begins) + at

    def encode_all(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of consecutive texts, each with the end id, and how many each has."""
        rows = len(bounds) - 1
        counts, found = np.zeros(rows, np.int64), []
        starts = bounds[:-1][np.diff(bounds) > 0]
        at = int(bounds[0])
        while at < bounds[-1]:
            stop = int(min(at + WINDOW, bounds[-1]))
            begin = self._begins(data, at, stop, starts)
            while stop < bounds[-1] and len(begin) < 2:  # a piece longer than a window
                stop = int(min(stop + WINDOW, bounds[-1]))
                begin = self._begins(data, at, stop, starts)
            if stop < bounds[-1]:
                begin, stop = begin[:-1], int(begin[-1])
            ids, sizes = self._window(data, np.append(begin, stop), starts)
            found.append(ids)
            np.add.at(counts, np.searchsorted(bounds, begin, side="right") - 1, sizes)
            at = stop
        ends = np.cumsum(counts + 1)
        out = np.empty(int(ends[-1]) if rows else 0, np.int32)
        inner = np.ones(len(out), bool)
        inner[ends - 1] = False
        out[~inner] = self.end
        out[inner] = np.concatenate(found) if found else np.empty(0, np.int32)
        return out, counts + 1

    def _window(self, data: np.ndarray, edges: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = span_hashes(data, edges)
        places = np.searchsorted(starts, edges[:-1])
        first = (places < len(starts)) & (starts[np.minimum(places, len(starts) - 1)] == edges[:-1])
        keys[first] = mix(keys[first] ^ _FIRST)  # a text's first piece has a blank in front

        def make(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            whole = data[edges[0]:edges[-1]].tobytes()
            cuts = edges - edges[0]
            pieces = [whole[a:b].decode("utf-8", "replace").replace(" ", BLANK) for a, b in zip(cuts[chosen].tolist(), cuts[chosen + 1].tolist())]
            for i in np.flatnonzero(first[chosen]).tolist():
                pieces[i] = BLANK + pieces[i]
            return self.encode_pieces(pieces)

        return self.remembered.look_up(keys, make)

    def decode_all(self, ids: pa.Array) -> pa.Array:
        """Texts of a few lists of ids."""
        ends = np.asarray(ids.offsets).astype(np.int64)
        ends -= ends[0]
        numbers = np.array(ids.flatten())
        later = np.append(np.flatnonzero(self.spoken[numbers]), len(numbers))
        lead = later[np.searchsorted(later, ends[:-1])]
        lead = lead[lead < ends[1:]]
        numbers[lead[self.leads[numbers[lead]]]] += self.tokens  # without its blank
        joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(ends), self.spelled.take(pa.array(numbers))), pa.scalar(b"", pa.large_binary()))
        try:
            return joined.cast(pa.large_string()).cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array([x.as_py().decode("utf-8", "each_byte") for x in joined], pa.string())


def _model(shared) -> Model:
    name, data = shared.value
    return held(f"pieces-{name}", lambda: Model(data))


def _shared(df: DataFrame, model: str | None):
    with open(model or default_model(), "rb") as file:
        data = file.read()
    return df.sparkSession.sparkContext.broadcast((hash(data), data))


def _encode_batch(shared, batch: pa.RecordBatch) -> list[pa.Array]:
    ids, counts = _model(shared).encode_all(*buffers(batch.column(batch.schema.names.index("text"))))
    return [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(ids))]


def _decode_batch(shared, batch: pa.RecordBatch) -> list[pa.Array]:
    model = _model(shared)
    ids = batch.column(batch.schema.names.index("ids"))
    if ids.null_count:
        ids = pc.fill_null(ids, pa.scalar([], ids.type))
    parts = [model.decode_all(ids.slice(i, ROWS)) for i in range(0, len(ids), ROWS)]
    return [pa.concat_arrays(parts) if parts else pa.array([], pa.string())]


def encode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """``docs`` plus ``ids``: the whole text encoded, with the end id and without a start id."""
    return add_in_arrow(docs, "ids array<int>", partial(_encode_batch, _shared(docs, model)), rows=BATCH)


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """``encoded`` plus ``decoded``: the text its ``ids`` stand for."""
    return add_in_arrow(encoded, "decoded string", partial(_decode_batch, _shared(encoded, model)), rows=BATCH)
