import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from siltline.llm import piece_bpe
from siltline.llm.batches import lists

PATH = public_tokenizers.path("piece_bpe_32k.model")
ALPHABETS = [
    "ab ", "aeiou  ", "0123456789 ", " \n\t a", "éèüßñ漢字かな한글😀 ", "!?#*.,-' s", "▁ a\x00<>0x1s/unk", "\n a.",
    "".join(map(chr, range(32, 600))),
]


@pytest.fixture(scope="module")
def own():
    with open(PATH, "rb") as f:
        return piece_bpe.model(f.read())


@pytest.fixture(scope="module")
def theirs():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def ids_of(packed):
    return np.frombuffer(packed, "<i4").tolist()


def test_random_texts(own, theirs):
    r = random.Random(1)
    for _ in range(2000):
        alphabet = r.choice(ALPHABETS)
        text = "".join(r.choice(alphabet) for _ in range(r.choice([0, 1, 2, 3, 10, 50, 300])))
        packed, want = own.encode(text), theirs.encode(text, add_eos=True)
        assert ids_of(packed) == want, text
        assert ids_of(own.encode(text, end=False)) == want[:-1]
        assert own.decode(lists([packed]))[0].as_py() == theirs.decode(want)


def test_random_ids(own, theirs):
    r = random.Random(2)
    rows = []
    for _ in range(2000):
        pick = lambda: r.choice([r.randrange(3, 259), r.randrange(32_000), 0, 1, 2, 259, r.randrange(259, 800)])
        rows.append([pick() for _ in range(r.choice([0, 1, 2, 3, 8]))])
    found = own.decode(lists([np.array(x, "<i4").tobytes() for x in rows])).to_pylist()
    assert found == [theirs.decode(x) for x in rows]


def test_long_words(own, theirs):
    for text in ("ab" * 30_000, "a" * 50_000, " " * 20_000, "é" * 20_000, "\n" * 20_000, "x" * 31 + " " + "y" * 33):
        assert ids_of(own.encode(text)) == theirs.encode(text, add_eos=True)


def test_table_that_fills_up(monkeypatch, theirs):
    monkeypatch.setattr(piece_bpe, "TABLE", 3)
    with open(PATH, "rb") as f:
        own = piece_bpe.Model(f.read())
    for text in ("one two  three\nfour five   six one two seven eight " * 3, "one two one three four two one five six two"):
        assert ids_of(own.encode(text)) == theirs.encode(text, add_eos=True)
    assert len(own._marked) <= 3 and len(own._marked.older) <= 3


def test_bad_ids(own):
    for bad in ([32_000], [-1], [None]):
        with pytest.raises(ValueError):
            own.decode(pa.array([bad], pa.list_(pa.int32())))
    assert own.decode(pa.array([], pa.list_(pa.int32()))).to_pylist() == []


def test_table(spark, theirs):
    rows = [(1, "Hello, world", "x"), (2, None, "y"), (3, "", None), (1, "Hello, world", "x"), (None, "z" * 9000, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, decoded string")
    found = piece_bpe.encode(docs, "text", PATH, "ids", "decoded").withColumn("digest", piece_bpe.digest(F.col("ids"))).collect()
    assert len(found) == 5
    texts = sorted((d is not None, d or 0, t or "") for d, t, _ in rows)
    for (_, _, text), row in zip(texts, sorted(found, key=lambda r: (r.doc_id is not None, r.doc_id or 0))):
        assert row.ids == theirs.encode(text, add_eos=True) and row.decoded == theirs.decode(row.ids) == text
    ids = spark.createDataFrame([(1, [9556, 29954]), (2, None), (3, [])], "k int, ids array<int>")
    back = {r.k: r.decoded for r in piece_bpe.decode(ids, "ids", PATH).collect()}
    assert back == {1: theirs.decode([9556, 29954]), 2: "", 3: ""}
    assert piece_bpe.encode(docs.where("false"), "text", PATH).count() == 0
