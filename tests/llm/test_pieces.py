"""SentencePiece encoding and decoding against the library."""

import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from periodledger.llm import pieces, queries
from periodledger.llm.remembered import Remembered
from periodledger.llm.words import buffers

DIR = "/root/testdata/sf0.001"
ODD = ["", " ", "  ", "a", " a", "a ", "\n", " \n x", "▁", "a▁b", "▁ ▁", "<s>hi</s>", "<0x0A>", "漢字 漢", "🙂🙂 ü", "z" * 30_000, " " * 1000 + "the", "\t \t", "it's 12 3456", "a\x01b",
       "the    the", "é x", "long words " * 3000, "x\ny " * 5000, None]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())


@pytest.fixture(scope="module")
def model():
    with open(pieces.default_model(), "rb") as file:
        return pieces.Model(file.read())


def test_whole_tables(spark, library):
    own = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame(list(enumerate(ODD * 2, 10**6)), "doc_id long, text string")
    docs = own.union(odd).withColumn("ids", pa_clash()).withColumn("score", pa_clash())
    got = pieces.decode(pieces.encode(docs)).collect()
    assert len(got) == own.count() + 2 * len(ODD)
    for r in got:
        ids = library.encode(r.text or "", add_eos=True)
        assert r.ids == ids and r.decoded == library.decode(ids)
    assert pieces.decode(pieces.encode(own.limit(0))).count() == 0
    assert queries.op11_sentencepiece(spark, DIR).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def pa_clash():
    from pyspark.sql import functions as F

    return F.lit("clash")


@pytest.mark.parametrize("letters", ["aetinos ", " ▁\nab", "the ", "aaab   ", "0123 ab", "pieces", "blanks"])
def test_drawn_texts(library, model, letters):
    draw = random.Random(letters)
    known = sorted(model.id)
    make = {"pieces": lambda: "".join(draw.choice(known) for _ in range(draw.randint(1, 6))).replace("▁", " "),
            "blanks": lambda: " " * draw.randint(0, 50) + draw.choice(["the", "x", "\n", ""]) + " " * draw.randint(0, 40) + draw.choice(["t", "12", ""])}
    texts = [make.get(letters, lambda: "".join(draw.choice(letters) for _ in range(draw.randint(0, 60))))() for _ in range(2000)]
    ids, counts = model.encode_all(*buffers(pa.array(texts)))
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(ids))
    wanted = library.encode(texts, add_eos=True)
    assert lists.to_pylist() == wanted
    assert model.decode_all(lists).to_pylist() == [library.decode(w) for w in wanted]


def test_small_windows_and_tables(library, model, monkeypatch):
    # Pieces longer than a window, forgetting all the time.
    monkeypatch.setattr(pieces, "WINDOW", 7)
    monkeypatch.setattr(pieces, "PAIRS", 3)
    model.remembered = Remembered(5)
    model.pairs.clear()
    texts = ["", "one of these is longerthanthewindow\n\n and so on", "", " x", "one"]
    ids, counts = model.encode_all(*buffers(pa.array(texts)))
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == library.encode(texts, add_eos=True)
    model.remembered = Remembered()


def test_any_ids_decode(spark, library):
    # Start ids, broken bytes, the unknown token, no blank in front.
    byte = library.piece_to_id
    rows = [[1, 450, 2], [byte("<0xE6>"), byte("<0xBC>"), 450], [0, 450], [450, 450], [1, 1, 2], [], [byte("<0x20>"), 450], [byte("<0xFF>"), byte("<0xE6>"), byte("<0xBC>"), byte("<0xA2>")]]
    got = pieces.decode(spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, ids array<int>")).orderBy("i").collect()
    assert [r.decoded for r in got] == [library.decode(x) for x in rows]
    assert [r.decoded for r in pieces.decode(spark.createDataFrame([(None,)], "ids array<int>")).collect()] == [""]


def test_backtracking_takes_tokens_back(model):
    # Every token is the merge of its letters, and the walk equals merging from scratch.
    draw = random.Random(4)
    for _ in range(500):
        word = "▁" + "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(draw.randint(1, 14)))
        tokens, places = model.backtrack(word)
        assert [model.text[t] for t in tokens] == model.merge(word) and places == np.cumsum([0, *map(len, model.merge(word))])[:-1].tolist()
