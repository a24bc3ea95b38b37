"""Byte-level BPE: exact encoding in linear time, and decoding.

Bytes are mapped to Latin-1 characters, so that an Aho-Corasick automaton of the vocabulary can
read them.  At each position the longest token is tried first, then the next shorter prefix that
is a token.  A token may follow another only if merging the bytes of both by rank gives these
two tokens again; a sequence in which all neighbours may follow each other is the one the merges
make, and there is only one.  Which tokens may follow which is kept in a table, and a position
from which no token leads on is never tried again, so the time is linear in the text.

Texts are cut by the vocabulary's pattern; each match is encoded separately, and one that is a
token itself is that token.  NULL is an empty text.  An id that is NULL or not in the vocabulary
fails the decoding.  Rows are handled on their own, so repeated rows and ties need no rule.
"""


import base64
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType

from siltline.llm.batches import lists, mapped

CACHED = 1 << 18  # results in each of two generations, of pieces and of parts, in each Python worker
CACHED_CHARS = 48  # longer ones are rare and are encoded anew
CACHED_PAIRS = 500_000
SPACED = re.compile(r" (?=\S)")
SPACE_AT_SPACE = re.compile(r" (?!\S)")


class Vocabulary:
    """Ranks of tokens, and what encoding derives from them."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        self.pattern = regex.compile(pattern)
        self.ranks = {token.decode("latin-1"): rank for token, rank in ranks.items()}
        self.tokens = {rank: token for token, rank in ranks.items()}
        last = max(self.tokens, default=-1)
        self._bytes = pa.array([self.tokens.get(i) for i in range(last + 1)], pa.large_binary())
        self._texts = {rank: token for token, rank in self.ranks.items()}
        self._longest = max(map(len, self.ranks), default=0)
        self._follows: dict[int, bool] = {}
        self._cuts: dict[str, str] = {}
        self._cache_pieces = Cache(self._piece)
        self._cache_parts = Cache(lambda part: self._pieces(f" {part}"))
        self._reached = {t: rank for t, rank in self.ranks.items() if self.merge(t) == [rank]}
        self._automaton = ahocorasick.Automaton()
        for token, rank in self._reached.items():
            self._automaton.add_word(token, rank)

    def merge(self, piece: str) -> list[int]:
        """Ids by the definition: again and again the leftmost pair of lowest rank is merged."""
        parts = list(piece)
        while len(parts) > 1:
            ranked = [(self.ranks.get(a + b, 1 << 40), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            rank, i = min(ranked)
            if rank == 1 << 40:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def _may_follow(self, first: int, second: int) -> bool:
        if len(self._follows) >= CACHED_PAIRS:
            self._follows.clear()
        known = self.merge(self._texts[first] + self._texts[second]) == [first, second]
        self._follows[first << 32 | second] = known
        return known

    def _shorter(self, token: str) -> str:
        """The longest token that is a proper prefix of ``token``; empty if there is none."""
        found = self._cuts.get(token)
        if found is None:
            found = token[:-1]
            while found and found not in self._reached:
                found = found[:-1]
            self._cuts[token] = found
        return found

    def backtrack(self, piece: str) -> list[int]:
        """Ids of the bytes of ``piece``, one character for each byte."""
        reached, follows, prefix = self._reached, self._follows, self._automaton.longest_prefix
        ids: list[int] = []
        taken: list[str] = []
        closed: set[int] = set()  # places from which no token leads on
        at, last, n, width = 0, -1, len(piece), self._longest
        window = piece[:width]
        token = window[: prefix(window)]
        while at < n:
            while token:
                rank = reached.get(token)
                if rank is not None and at + len(token) not in closed:
                    if last < 0:
                        break
                    known = follows.get(last << 32 | rank)
                    if known or known is None and self._may_follow(last, rank):
                        break
                token = self._shorter(token)
            if token:
                ids.append(rank)
                taken.append(token)
                at += len(token)
                last = rank
                window = piece[at : at + width]
                token = window[: prefix(window)]
            elif ids:
                closed.add(at)
                ids.pop()
                before = taken.pop()
                at -= len(before)
                last = ids[-1] if ids else -1
                token = self._shorter(before)
            else:
                raise ValueError("the vocabulary lacks single bytes")
        return ids

    def _piece(self, piece: str) -> bytes:
        """Ids of a match of the pattern as 32-bit integers."""

        text = piece.encode().decode("latin-1")
        whole = self.ranks.get(text)
        return array("i", [whole] if whole is not None else self.backtrack(text)).tobytes()

    def _pieces(self, text: str) -> bytes:
        return b"".join([self._cache_pieces.get(m) for m in self.pattern.findall(text)])

    def packed(self, text: str) -> bytes:
        """Ids of a text as 32-bit integers.

        A space before a character that is no white space always begins a match, so the text
        may be cut there and the parts looked up with what they became before.
        """

        first, *rest = SPACED.split(text) if SPACE_AT_SPACE.search(text) else text.split(" ")
        young, get = self._cache_parts.young, self._cache_parts.get
        parts = [young.get(p) or get(p) for p in rest]
        return self._pieces(first) + b"".join(parts)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text as an array."""
        return np.frombuffer(self.packed(text), "<i4")

    def decode(self, ids) -> bytes:
        ids = ids.tolist() if isinstance(ids, np.ndarray) else ids
        return b"".join(map(self.tokens.__getitem__, ids))

    def decode_all(self, ids: pa.ListArray) -> pa.Array:
        """Bytes of many lists of ids, joined at once."""
        flat = ids.flatten()
        if flat.null_count or len(flat) and not 0 <= pc.min(flat).as_py() <= pc.max(flat).as_py() < len(self._bytes):
            raise ValueError("an id is NULL or not in the vocabulary")
        tokens = self._bytes.take(flat)
        if tokens.null_count:
            raise ValueError("an id is not in the vocabulary")
        sizes = pc.list_value_length(ids).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        lines = pa.LargeListArray.from_arrays(pa.array(ends), tokens)
        return pc.binary_join(lines, pa.scalar(b"", pa.large_binary())).cast(pa.binary())


class Cache:
    """Results of a function by key: the latest ones and those that were latest before them."""

    def __init__(self, make):
        self.make, self.young, self.old = make, {}, {}

    def get(self, key: str) -> bytes:
        found = self.young.get(key)
        if found is None:
            found = self.old.get(key)
            if found is None:
                found = self.make(key)
                if len(key) > CACHED_CHARS:
                    return found
            if len(self.young) >= CACHED:
                self.old, self.young = self.young, {}
            self.young[key] = found
        return found


@lru_cache(maxsize=4)
def vocabulary(content: bytes, pattern: str) -> Vocabulary:
    """A vocabulary of a worker, made once: lines of a token in base 64 and its rank."""
    lines = (line.split() for line in content.splitlines())
    return Vocabulary({base64.b64decode(p[0]): int(p[1]) for p in lines if p}, pattern)


def _shared(spark: SparkSession, path: str):
    """The rank file, read by the driver; its size does not depend on the data."""
    with open(path, "rb") as ranks:
        return spark.sparkContext.broadcast(ranks.read())


def encode(df: DataFrame, text: str, path: str, pattern: str, ids: str = "token_ids", decoded: str | None = None) -> DataFrame:
    """``df`` with its ``text`` replaced by the ids, and by the bytes they decode to if asked for."""
    ranks = _shared(df.sparkSession, path)

    def make(texts: pa.Array) -> list[pa.Array]:
        own = vocabulary(ranks.value, pattern)
        found = lists([own.packed(t or "") for t in texts.to_pylist()])
        return [found, own.decode_all(found)] if decoded else [found]

    return mapped(df, text, {ids: ArrayType(IntegerType())} | ({decoded: BinaryType()} if decoded else {}), make)


def decode(df: DataFrame, ids: str, path: str, pattern: str, decoded: str = "decoded") -> DataFrame:
    """``df`` with its ``ids`` replaced by the bytes they stand for; NULL ids stand for none."""
    ranks = _shared(df.sparkSession, path)

    def make(many: pa.Array) -> list[pa.Array]:
        return [vocabulary(ranks.value, pattern).decode_all(many.cast(pa.list_(pa.int32())))]

    return mapped(df, ids, {decoded: BinaryType()}, make)


def digest(ids: Column) -> Column:
    """SHA-256 of the decimal ids joined by commas."""
    return F.sha2(F.array_join(ids.cast("array<string>"), ","), 256)
