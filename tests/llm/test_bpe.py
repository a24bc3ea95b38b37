import base64
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from siltline.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def own():
    with open(PATH, "rb") as f:
        return bpe.vocabulary(f.read(), PATTERN)


@pytest.fixture(scope="module")
def theirs():
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_random_texts(own, theirs):
    r = random.Random(1)
    alphabets = ["ab", "aeiou", "0123456789", " \n\t a", "éèüßñ漢字かな한글😀", "!?#*.,-' s", "".join(map(chr, range(32, 600)))]
    for _ in range(1500):
        alphabet = r.choice(alphabets)
        text = "".join(r.choice(alphabet) for _ in range(r.choice([0, 1, 3, 10, 50, 300])))
        ids = own.encode(text)
        assert list(ids) == theirs.encode_ordinary(text), text
        assert own.decode(ids) == text.encode()


def test_long_matches_take_linear_time(own, theirs):
    for text in ("ab" * 60_000, "a" * 100_000, " " * 50_000, "é" * 50_000):
        assert list(own.encode(text)) == theirs.encode_ordinary(text)


def test_backtracking_equals_merging(own):
    r = random.Random(2)
    for _ in range(500):
        piece = bytes(r.choice(b"abcdeinrst \xc3\xa9\xff") for _ in range(r.randint(1, 24))).decode("latin-1")
        assert own.backtrack(piece) == own.merge(piece)


def test_small_vocabulary():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bc": 257, b"abc": 258, b"cd": 259, b"bcd": 260}
    own = bpe.Vocabulary(ranks, r"\w+|\W+")
    for text in ("abcd", "bcd", "abcdabc", "aabbccdd", "xbcdx"):
        assert [own._texts[i] for i in own.backtrack(text)] == [own._texts[i] for i in own.merge(text)]
        assert own.decode(own.encode(text)) == text.encode()


def test_caches_that_fill_up(monkeypatch, theirs):
    monkeypatch.setattr(bpe, "CACHED", 3)
    monkeypatch.setattr(bpe, "CACHED_PAIRS", 2)
    with open(PATH, "rb") as f:
        own = bpe.vocabulary.__wrapped__(f.read(), PATTERN)
    text = "one two  three\nfour five   six one two seven eight Donaudampfschifffahrt " * 3
    assert list(own.encode(text)) == theirs.encode_ordinary(text)


def test_table(spark, theirs):
    rows = [(1, "Hello, world", "x"), (2, None, "y"), (3, "", None), (1, "Hello, world", "x"), (None, "z" * 9000, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, decoded string")
    found = bpe.encode(docs, "text", PATH, PATTERN, "ids", "decoded").withColumn("digest", bpe.digest(F.col("ids"))).collect()
    assert len(found) == 5
    texts = sorted((d is not None, d or 0, t or "") for d, t, _ in rows)
    for (_, _, text), row in zip(texts, sorted(found, key=lambda r: (r.doc_id is not None, r.doc_id or 0))):
        assert row.ids == theirs.encode_ordinary(text) and bytes(row.decoded) == text.encode()
    ids = spark.createDataFrame([(1, [72, 105]), (2, None), (3, [])], "k int, ids array<int>")
    back = {r.k: bytes(r.decoded) for r in bpe.decode(ids, "ids", PATH, PATTERN).collect()}
    with open(PATH, "rb") as f:
        assert back == {1: bpe.vocabulary(f.read(), PATTERN).decode([72, 105]), 2: b"", 3: b""}
    empty = docs.where("false")
    assert bpe.encode(empty, "text", PATH, PATTERN).count() == 0
