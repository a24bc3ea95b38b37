"""SentencePiece encoding and decoding of BPE models with byte fallback, by a table of distinct chunks.

Spaces become markers, one is put before a text that is not empty, and nothing else is normalised.
If no piece of the model has a marker behind another character, no merge joins what stands on the
two sides of one, so a text falls into marked words that are segmented independently.  The same
holds at line feeds, if they are in no piece.  A worker keeps a table of the distinct words it has
met, from batch to batch: each is segmented once, and the ids are joined back in the order of the
words.  A table has two generations of ``TABLE`` words at most, the older one being dropped when the
younger is full, so its memory is bounded however many words there are; what a lost worker knew is
segmented again elsewhere, with the same ids.  Nothing is shuffled.

Segmenting merges, as long as there is one, the neighbours that give the piece of the highest score
(the leftmost of equals); a character in no piece becomes the ids of its UTF-8 bytes.

NULL is an empty text, and has no ids but those of the end.  Rows are handled on their own, so
repeated rows and ties need no rule.  An id that is NULL or not in the model fails the decoding;
NULL in place of ids stands for none.  Bytes that are no UTF-8 are decoded to U+FFFD each.
"""

from __future__ import annotations

import heapq
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from siltline.llm.batches import lists, mapped

MARK = "▁"
TABLE = 1 << 19  # words in each generation of a worker's table
TABLE_CHARS = 64  # longer words are rare and are segmented anew
SHORT = 32  # characters up to which looking through all pairs is faster than a heap
NEVER = 1 << 62  # rank of what is no piece


class Words(dict):
    """Ids of the words met, as packed 32-bit numbers."""

    def __init__(self, segment):
        self.segment = segment
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        found = self.older.get(word)
        if found is None:
            found = np.array(self.segment(word), "<i4").tobytes()
            if len(word) > TABLE_CHARS:
                return found
        if len(self) >= TABLE:
            self.older = dict(self)
            self.clear()
        self[word] = found
        return found


class Model:
    """Pieces with their scores, and what encoding and decoding derive from them."""

    def __init__(self, content: bytes):
        from sentencepiece import SentencePieceProcessor

        own = SentencePieceProcessor(model_proto=content)
        ids = range(own.get_piece_size())
        pieces = [own.id_to_piece(i) for i in ids]
        self.unknown = own.unk_id()
        self.end = own.eos_id()
        self.silent = {i for i in ids if own.is_control(i)}
        self.bytes = {i: bytes([int(pieces[i][3:5], 16)]) for i in ids if own.is_byte(i)}
        self._of_byte = {b[0]: i for i, b in self.bytes.items()}
        special = self.silent | set(self.bytes) | {self.unknown}
        self.ids = {p: i for i, p in enumerate(pieces) if i not in special}
        self._scores = {p: own.get_score(i) for p, i in self.ids.items()}
        order = {score: k for k, score in enumerate(sorted(set(self._scores.values()), reverse=True))}
        self._merged: dict[int, int] = {}  # of two ids, the id of what they make
        self._ranks: dict[int, int] = {}  # of two ids, the place of that piece's score, the highest first
        for piece, i in self.ids.items():
            for k in range(1, len(piece)):
                left, right = self.ids.get(piece[:k]), self.ids.get(piece[k:])
                if left is not None and right is not None:
                    self._merged[left << 32 | right] = i
                    self._ranks[left << 32 | right] = order[self._scores[piece]]
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("pieces of this model cross whitespace markers")
        if len(self.bytes) != 256:
            raise ValueError("the model has no byte fallback")
        apart = "" if any("\n" in p for p in self.ids) else "\n"
        self._chunks = re.compile(f"{MARK}*[^{MARK}{apart}]+|{MARK}+" + (f"|{apart}+" if apart else ""))
        self._words = Words(self.segment)  # as they stand in the text
        self._marked = Words(lambda word: self.segment(MARK + word))  # without the marker before them
        self._feed = None if not apart else np.array(self.segment("\n"), "<i4").tobytes()
        # A byte below 128 is a character wherever it stands.
        ascii_of = {i: b.decode() for i, b in self.bytes.items() if b < b"\x80"}
        surfaces = [
            "" if i in self.silent else " ⁇ " if i == self.unknown else ascii_of.get(i, p) for i, p in enumerate(pieces)
        ]
        self._surfaces = pa.array(surfaces, pa.large_string())
        self._plain = np.array([i != self.unknown and (i not in self.bytes or i in ascii_of) for i in ids])

    def segment(self, word: str) -> list[int]:
        """Ids of a marked word."""
        known = self.ids.get
        found = [known(c) for c in word]
        if len(word) <= SHORT and None not in found:
            return self._merge_few(found)
        parts = self._merge_many(list(word))
        found = [known(p) for p in parts]
        if None in found:
            spelt = [[i] if i is not None else [self._of_byte[b] for b in p.encode()] for i, p in zip(found, parts)]
            found = [i for some in spelt for i in some]
        return found

    def _merge_few(self, ids: list[int]) -> list[int]:
        """Merges among the ids of characters that are all pieces."""
        rank, merged = self._ranks.get, self._merged
        pairs = [rank(a << 32 | b, NEVER) for a, b in zip(ids, ids[1:])]
        while pairs:
            best = min(pairs)
            if best == NEVER:
                break
            at = pairs.index(best)
            one = merged[ids[at] << 32 | ids[at + 1]]
            ids[at : at + 2] = [one]
            del pairs[at]
            if at:
                pairs[at - 1] = rank(ids[at - 1] << 32 | one, NEVER)
            if at < len(pairs):
                pairs[at] = rank(one << 32 | ids[at + 1], NEVER)
        return ids

    def _merge_many(self, parts: list[str]) -> list[str]:
        """The same with a heap of pairs; time n log n in the length of the word."""
        score = self._scores.get
        after = [*range(1, len(parts)), -1]
        before = [*range(-1, len(parts) - 1)]
        heap: list[tuple[float, int, str]] = []

        def put(i: int) -> None:
            if i >= 0 and after[i] >= 0:
                both = parts[i] + parts[after[i]]
                found = score(both)
                if found is not None:
                    heapq.heappush(heap, (-found, i, both))

        for i in range(len(parts) - 1):
            put(i)
        while heap:
            _, i, both = heapq.heappop(heap)
            j = after[i]
            if not parts[i] or j < 0 or parts[i] + parts[j] != both:
                continue  # one of the two has been merged since
            parts[i], parts[j] = both, ""
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            put(before[i])
            put(i)
        return [p for p in parts if p]

    def encode(self, text: str, end: bool = True) -> bytes:
        """Ids of a text as packed 32-bit numbers; with that of the end if wanted."""
        last = np.array([self.end] if end else [], "<i4").tobytes()
        if not text:
            return last
        if self._feed is None or "  " in text or text[0] == " " or MARK in text:
            words = self._chunks.findall(MARK + text.replace(" ", MARK))
            return b"".join(map(self._words.__getitem__, words)) + last
        # Every space is the marker of the word behind it; the first word of a line has none.
        marked, lines, before = self._marked.__getitem__, [], MARK
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            first = before + first
            lines.append((self._words[first] if first else b"") + b"".join(map(marked, rest)))
            before = ""
        return self._feed.join(lines) + last

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """Texts of lists of ids; lists of pieces alone are joined at once."""
        flat = ids.flatten()
        if flat.null_count:
            raise ValueError("an id is NULL")
        numbers = flat.to_numpy()
        if len(numbers) and not 0 <= numbers.min() <= numbers.max() < len(self._surfaces):
            raise ValueError("an id is not in the model")
        sizes = np.asarray(pc.list_value_length(ids).fill_null(0).to_numpy(zero_copy_only=False), np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        lines = pa.LargeListArray.from_arrays(pa.array(ends), self._surfaces.take(flat))
        joined = pc.binary_join(lines, pa.scalar("", pa.large_string()))
        joined = pc.if_else(pc.starts_with(joined, MARK), pc.utf8_slice_codeunits(joined, 1), joined)
        joined = pc.replace_substring(joined, MARK, " ").cast(pa.string())
        odd = np.concatenate([[0], np.cumsum(~self._plain[numbers])])
        odd = np.flatnonzero(odd[ends[1:]] > odd[ends[:-1]])
        if not len(odd):
            return joined
        found = joined.to_pylist()
        for row in odd.tolist():
            found[row] = self._decode_slowly(numbers[ends[row] : ends[row + 1]].tolist())
        return pa.array(found, pa.string())

    def _decode_slowly(self, ids: list[int]) -> str:
        """With runs of byte pieces, which become characters, and with unknown pieces."""
        surfaces, out, run, first = self._surfaces, [], bytearray(), True
        for i in ids:
            if i in self.bytes:
                run += self.bytes[i]
                continue
            out.append(_characters(run))
            run.clear()
            if i in self.silent:
                continue
            text = surfaces[i].as_py()
            if i != self.unknown:
                if first and not any(out) and text.startswith(MARK):
                    text, first = text[1:], False
                text = text.replace(MARK, " ")
            out.append(text)
        return "".join(out) + _characters(run)


def _characters(run: bytes) -> str:
    """Text of bytes, in which every byte that belongs to no character is U+FFFD."""
    run = bytes(run)
    try:
        return run.decode()
    except UnicodeDecodeError:
        pass
    out, at = [], 0
    while at < len(run):
        for width in (1, 2, 3, 4):
            try:
                out.append(run[at : at + width].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            width = 1
        at += width
    return "".join(out)


@lru_cache(maxsize=4)
def model(content: bytes) -> Model:
    """A model of a worker, made once."""
    return Model(content)


def _shared(spark: SparkSession, path: str):
    """The model file, read by the driver; its size does not depend on the data."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encode(
    df: DataFrame, text: str, path: str, ids: str = "token_ids", decoded: str | None = None, end: bool = True
) -> DataFrame:
    """``df`` with its ``text`` replaced by the ids, and by the text they decode to if asked for."""
    content = _shared(df.sparkSession, path)

    def make(texts: pa.Array) -> list[pa.Array]:
        own = model(content.value)
        found = lists([own.encode(t or "", end) for t in texts.to_pylist()])
        return [found, own.decode(found)] if decoded else [found]

    return mapped(df, text, {ids: ArrayType(IntegerType())} | ({decoded: StringType()} if decoded else {}), make)


def decode(df: DataFrame, ids: str, path: str, decoded: str = "decoded") -> DataFrame:
    """``df`` with its ``ids`` replaced by the text they stand for."""
    content = _shared(df.sparkSession, path)

    def make(many: pa.Array) -> list[pa.Array]:
        return [model(content.value).decode(many.cast(pa.list_(pa.int32())))]

    return mapped(df, ids, {decoded: StringType()}, make)


def digest(ids: Column) -> Column:
    """SHA-256 of the decimal ids joined by spaces."""
    return F.sha2(F.array_join(ids.cast("array<string>"), " "), 256)
