"""Spelling variants: words one edit apart, grouped under the frequent form they derive from.

Words hang in a trie by their counts of letters: the length first, then how often each group of
``GROUPS`` occurs, then how often each occurs among the first ``HEAD`` characters.  A word that
differs by one replaced character has at most one letter more of one group and one fewer of
another; with one inserted it is one longer and has one letter more.  A search goes down the trie
with a budget of one surplus and one deficit (none for the inserted), depth first, and compares the
words at the leaves it reaches, which are nodes of ``BUCKET`` words at most.  Deleted characters are
found from the other side.  At the heads one edit moves at most one letter in and one out, so the
budget is given anew there.

The upper levels are walked by Spark, the lower ones in Python workers:

* A node with over ``LIMIT`` words is cut by the next group, and its searches go on to the nodes
  their budgets reach.  This is done for heavy nodes alone, so a word is sent to few of them.
* Nodes are dealt over tasks; a worker holds the words of some nodes, ``LIMIT`` and a batch at most,
  and streams the searches of these past them.  (Words with the same counts in everything cannot
  be cut any further; they stay together, whatever their number.)
* What is shuffled is words and pairs, never occurrences: these are added up where they are read.

NULL texts have no words and a NULL id counts as an empty one.  Repeated rows count again.  Of near
words with the same count the smallest in code-point order is the form.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from siltline.llm.tables import side, stored

LEAST_CHARS, LEAST_COUNT = 7, 2  # of a word
ONE_IN = 31  # of the occurrences, one lost a character
OFTEN = 10  # times as frequent as a word is its form
# Letters by frequency in European languages, so that upper levels split well; all that a run may
# hold and that is not named here is the last group.
GROUPS = (*"enirtsahoucldmgpbvfkzwyxjq", "àáâãäåæ", "èéêëçð", "ìíîïñ", "òóôõöø", "ùúûüýþÿ")
HEAD = 6
MOST = 7  # counts beyond it are one
LIMIT = 100_000  # words of a node
BUCKET = 8  # words of a leaf
BROADCAST_NODES = 1_000_000  # numbers of heavy nodes, 8 bytes each before their hash table
FRONT = 50_000  # steps of a search, or pairs, that are taken together
WIDE = 48  # characters of words that are compared as rows of a matrix

_RUN = r"[A-Za-zÀ-ÿ]"
_LEVELS = 2 * (len(GROUPS) + 1)
_GROUP_OF = np.full(256, len(GROUPS), np.uint8)
for _i, _letters in enumerate(GROUPS):
    _GROUP_OF[list(_letters.encode("latin-1"))] = _i


# --- words -------------------------------------------------------------------------------------


def _lowered(run: Column) -> Column:
    """With A-Z alone in lower case."""
    plain = F.octet_length(run) == F.length(run)
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(plain, F.lower(run)).otherwise(F.translate(run, capitals, capitals.lower()))


def words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): distinct words and their occurrences, after some lost a character.

    Runs of under ``LEAST_CHARS`` letters cannot become words and are not taken out of the text.
    """
    runs = F.regexp_extract_all(F.col(text), F.lit(f"{_RUN}{{{LEAST_CHARS},}}"), F.lit(0))
    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    rows = rows.select("id", _lowered(F.col("run")).alias("run"))
    rows = rows.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    lost = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % ONE_IN == 0, lost).otherwise(F.col("run"))
    counted = rows.groupBy(word.alias("word")).agg(F.count("*").alias("n"))
    return counted.where((F.length("word") >= LEAST_CHARS) & (F.col("n") >= LEAST_COUNT))


# --- the trie's upper levels ---------------------------------------------------------------------


def _count(level: int) -> Column:
    """How often a word has the letters of a level."""
    tier, group = divmod(level, len(GROUPS) + 1)
    part = F.substring("word", 1, HEAD) if tier else F.col("word")
    if group < len(GROUPS):
        left = F.length(F.translate(part, GROUPS[group], ""))
        return F.least(F.length(part) - left, F.lit(MOST))
    return F.least(F.length(F.translate(part, "".join(GROUPS), "")), F.lit(MOST))


def _searches(words: DataFrame, limit: int) -> DataFrame:
    """(node, own, longer, word, n): words in their nodes, and under each node who searches there.

    Own words search as well; ``longer`` are searches for words with a character more.
    """
    kinds = F.array(
        F.struct(F.lit(True).alias("own"), F.lit(False).alias("longer"), F.lit(1).alias("deficit")),
        F.struct(F.lit(False).alias("own"), F.lit(True).alias("longer"), F.lit(0).alias("deficit")),
    )
    rows = words.select("word", "n", F.explode(kinds).alias("k")).select(
        F.xxhash64(F.length("word") + F.col("k.longer").cast("int")).alias("node"),
        "k.own", "k.longer", "word", "n", F.lit(1).alias("surplus"), "k.deficit",
    )
    kept = ["node", "own", "longer", "word", "n"]
    done = []
    for level in range(_LEVELS):
        # Of N words at most N / limit nodes are heavy.
        heavy = rows.where("own").groupBy("node").agg(F.count("*").alias("size")).where(F.col("size") > limit)
        heavy = side(heavy.select("node"), "heavy-nodes", F.lit(1), BROADCAST_NODES)
        if heavy.isEmpty():
            break
        done.append(rows.join(heavy, "node", "left_anti").select(kept))
        rows = stored(_cut(rows.join(heavy, "node", "left_semi"), level), "searches")
    found = rows.select(kept)
    for light in done:
        found = found.union(light)
    return found


def _cut(rows: DataFrame, level: int) -> DataFrame:
    """Rows of nodes under the nodes of the next level that their budgets reach."""
    if level == len(GROUPS) + 1:
        rows = rows.withColumns({"surplus": F.lit(1), "deficit": F.lit(1)})
    more, less = F.when(F.col("surplus") > 0, F.lit(1)), F.when(F.col("deficit") > 0, F.lit(-1))
    steps = F.filter(F.array(F.lit(0), more, less), lambda step: step.isNotNull())
    rows = rows.withColumn("count", _count(level)).withColumn("step", F.explode(steps))
    rows = rows.where(F.col("count") + F.col("step") >= 0)
    return rows.select(
        F.xxhash64("node", F.lit(level), F.col("count") + F.col("step")).alias("node"),
        (F.col("own") & (F.col("step") == 0)).alias("own"), "longer", "word", "n",
        (F.col("surplus") - (F.col("step") > 0).cast("int")).alias("surplus"),
        (F.col("deficit") - (F.col("step") < 0).cast("int")).alias("deficit"),
    )


# --- the trie's lower levels ---------------------------------------------------------------------


def _vectors(words: list[bytes]) -> np.ndarray:
    """Counts of every level, a row for each word."""
    lengths = np.array([len(w) for w in words], np.int64)
    letters = _GROUP_OF[np.frombuffer(b"".join(words), np.uint8)].astype(np.int64)
    row = np.repeat(np.arange(len(words)), lengths)
    place = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    width = len(GROUPS) + 1
    tiers = []
    for some in (slice(None), place < HEAD):
        cells = np.bincount(row[some] * width + letters[some], minlength=len(words) * width)
        tiers.append(np.minimum(cells, MOST).astype(np.uint8).reshape(len(words), width))
    return np.concatenate(tiers, axis=1)


class Trie:
    """The words of some nodes by their counts.

    Of a level: ``tables`` leads from a node that is no leaf and a count to a node of the next
    level; ``starts`` and ``sizes`` are its words in sorted order, ``inner`` its number among
    those that are no leaves.
    """

    def __init__(self, nodes: np.ndarray, vectors: np.ndarray):
        keys = np.concatenate([nodes.astype(">u4").view(np.uint8).reshape(-1, 4), vectors], axis=1)
        keys = np.ascontiguousarray(keys)
        self.order = np.argsort(keys.view(f"S{keys.shape[1]}").ravel(), kind="stable")
        nodes, vectors = nodes[self.order], vectors[self.order]
        apart = vectors[1:] != vectors[:-1]
        first = np.where(apart.any(axis=1), apart.argmax(axis=1) + 1, _LEVELS + 1)
        first = np.concatenate([[0], np.where(nodes[1:] != nodes[:-1], 0, first)])
        self.starts, self.sizes, self.inner, self.tables = [], [], [], []
        for level in range(_LEVELS + 1):
            new = first <= level
            starts = np.flatnonzero(new)
            sizes = np.diff(np.append(starts, len(new)))
            big = sizes > BUCKET
            inner = np.where(big, np.cumsum(big) - 1, -1)
            self.starts.append(starts)
            self.sizes.append(sizes)
            self.inner.append(inner)
            if level:
                above = self.inner[level - 1][np.cumsum(first < level)[starts] - 1]
                held = above >= 0
                table = np.full((int(above.max(initial=-1)) + 1, MOST + 1), -1, np.int32)
                table[above[held], vectors[starts[held], level - 1]] = np.flatnonzero(held)
                self.tables.append(table)
            if not big.any():
                break
        self.roots = {int(n): i for i, n in enumerate(nodes[self.starts[0]])}

    def reached(
        self, roots: np.ndarray, vectors: np.ndarray, longer: np.ndarray
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(search, word) that the budgets do not exclude, in pieces; words by place in ``order``."""
        some = np.flatnonzero(roots >= 0)
        stack = [(0, some, roots[some], np.ones(len(some), bool), ~longer[some])]
        while stack:
            level, at, node, surplus, deficit = stack.pop()
            size = self.sizes[level][node]
            leaf = (size <= BUCKET) | (level == _LEVELS)
            if leaf.any():
                yield from _spread(at[leaf], self.starts[level][node[leaf]], size[leaf])
            inner = self.inner[level][node]
            if level == _LEVELS or leaf.all():
                continue
            if level == len(GROUPS) + 1:
                surplus, deficit = np.ones(len(at), bool), np.ones(len(at), bool)
            count = vectors[at, level].astype(np.int64)
            parts = []
            for step, allowed in ((0, ~leaf), (1, ~leaf & surplus), (-1, ~leaf & deficit)):
                ok = np.flatnonzero(allowed & (count + step >= 0) & (count + step <= MOST))
                child = self.tables[level][inner[ok], count[ok] + step]
                ok, child = ok[child >= 0], child[child >= 0]
                parts.append((at[ok], child, surplus[ok] & (step <= 0), deficit[ok] & (step >= 0)))
            joined = [np.concatenate(column) for column in zip(*parts)]
            for i in range(0, len(joined[0]), FRONT):
                stack.append((level + 1, *[column[i : i + FRONT] for column in joined]))


def _spread(at: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(search, word) of all words of the leaves, in pieces."""
    ends = np.cumsum(sizes)
    total = int(ends[-1])
    for low in range(0, total, FRONT):
        number = np.arange(low, min(low + FRONT, total))
        leaf = np.searchsorted(ends, number, "right")
        yield at[leaf], starts[leaf] + number - (ends[leaf] - sizes[leaf])


def _gathered(pieces: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Small pieces put together."""
    held, size = [], 0
    for piece in pieces:
        held.append(piece)
        size += len(piece[0])
        if size >= FRONT:
            yield tuple(np.concatenate(column) for column in zip(*held))
            held, size = [], 0
    if size:
        yield tuple(np.concatenate(column) for column in zip(*held))


def one_apart(a: bytes, b: bytes) -> bool:
    """Whether ``b`` is ``a`` with one character replaced or inserted."""
    if not 0 <= len(b) - len(a) <= 1 or a == b:
        return False
    low, high = 0, len(a)  # the common prefix, by halves
    while low < high:
        half = (low + high + 1) // 2
        low, high = (half, high) if a[:half] == b[:half] else (low, half - 1)
    return a[low + (len(a) == len(b)) :] == b[low + 1 :]


def _near(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The same for rows of two matrices, padded with zeros, with their lengths."""
    equal = a == b
    first = np.where(equal.all(axis=1), a.shape[1], equal.argmin(axis=1))
    later = np.arange(a.shape[1]) > first[:, None]
    replaced = (n_a == n_b) & (first < n_a) & (equal | ~later).all(axis=1)
    shifted = np.zeros_like(b)
    shifted[:, :-1] = b[:, 1:]
    from_first = later | (np.arange(a.shape[1]) == first[:, None])
    inserted = (n_b == n_a + 1) & ((a == shifted) | ~from_first).all(axis=1)
    return replaced | inserted


class Rows:
    """Words with what a worker needs to compare them."""

    def __init__(self, words: list[bytes]):
        self.words = words
        self.lengths = np.array([len(w) for w in words], np.int64)
        wide = min(WIDE, int(self.lengths.max(initial=1)))
        self.matrix = np.array([w[:wide] for w in words], f"S{wide}").view(np.uint8).reshape(len(words), wide)
        self.vectors = _vectors(words)
        # Of two words an edit apart that have six characters, the first or the last three are the same.
        self.head = np.array([int.from_bytes(w[:3]) for w in words], np.int32)
        self.tail = np.array([int.from_bytes(w[-3:]) for w in words], np.int32)

    def verified(self, a: np.ndarray, b: np.ndarray, longer: np.ndarray, once: np.ndarray) -> np.ndarray:
        """Of pairs of places, which differ by one edit.

        Pairs of one length that are reached from both sides, which are all but those of ``once``, count once.
        """
        fits = (self.head[a] == self.head[b]) | (self.tail[a] == self.tail[b]) | (self.lengths[a] < 6)
        fits &= self.lengths[b] - self.lengths[a] == longer
        a, b, longer, once, kept = a[fits], b[fits], longer[fits], once[fits], np.flatnonzero(fits)
        good = _near(self.matrix[a], self.matrix[b], self.lengths[a], self.lengths[b])
        for i in np.flatnonzero(self.lengths[b] > WIDE).tolist():
            good[i] = one_apart(self.words[a[i]], self.words[b[i]])
        for i in np.flatnonzero(good & ~longer & ~once).tolist():
            good[i] = self.words[a[i]] < self.words[b[i]]
        return kept[good]


def _searched(limit: int):
    """Function for mapInArrow: from rows sorted by node, own words first, to pairs."""
    names = ["node", "own", "longer", "word", "n"]

    def found(rows: pa.Table, asks: np.ndarray) -> Iterator[pa.RecordBatch]:
        node, own, longer, n = (rows.column(c).to_numpy() for c in ("node", "own", "longer", "n"))
        own, longer = own.astype(bool), longer.astype(bool)
        texts = [w.encode("latin-1") for w in rows.column("word").to_pylist()]
        at = np.flatnonzero(own)
        if not len(at):
            return
        held = Rows(texts)
        number = np.unique(node, return_inverse=True)[1]
        trie = Trie(number[at], held.vectors[at])
        at = at[trie.order]
        roots = np.full(int(number.max()) + 1, -1)
        roots[list(trie.roots)] = list(trie.roots.values())
        words = rows.column("word").combine_chunks()
        for ask, word in _gathered(trie.reached(np.where(asks, roots[number], -1), held.vectors, longer)):
            word = at[word]
            # Words that stayed do not ask for the words of their node that came after them.
            good = held.verified(ask, word, longer[ask], own[ask] & ~asks[word])
            a, b = ask[good], word[good]
            yield pa.RecordBatch.from_arrays(
                [words.take(pa.array(a)), pa.array(n[a]), words.take(pa.array(b)), pa.array(n[b])], ["a", "n_a", "b", "n_b"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, kept, asks, size = None, [], [], 0
        for batch in batches:
            schema = batch.schema
            kept.append(batch)
            asks.append(np.ones(batch.num_rows, bool))
            size += batch.num_rows
            if size < limit:
                continue
            rows, asking = pa.Table.from_batches(kept), np.concatenate(asks)
            yield from found(rows, asking)
            # The words of the last node stay for the searches that follow, and ask no more.
            last = rows.column("node").to_numpy()
            stay = (last == last[-1]) & rows.column("own").to_numpy().astype(bool)
            rows = rows.filter(pa.array(stay)).combine_chunks()
            kept, asks, size = rows.to_batches(), [np.zeros(rows.num_rows, bool)], 0
        if size:
            yield from found(pa.Table.from_batches(kept, schema).select(names), np.concatenate(asks))

    return run


def near_words(words: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(a, n_a, b, n_b): pairs of distinct words that are one edit apart, each once.

    ``words`` has (word, n), the words distinct and of characters up to U+00FF.
    """
    rows = _searches(words, limit)
    # Own words come first in a node.  More partitions than that are merged by their size.
    rows = rows.repartition("node").sortWithinPartitions("node", F.desc("own"))
    return rows.mapInArrow(_searched(limit), "a string, n_a bigint, b string, n_b bigint")


# --- groups --------------------------------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of the chain of forms, for all words that have one.

    A form is ``OFTEN`` times as frequent as its word, so a chain has few links; each round
    doubles the links that are followed.
    """
    found = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = found.select(F.col("word").alias("root"), F.col("root").alias("further"))
        found = found.join(further, "root", "left")
        found = stored(found.select("word", F.coalesce("further", "root").alias("root"), "further"), "roots")
        if found.where("further IS NOT NULL").isEmpty():
            return found.select("word", "root")
        found = found.select("word", "root")


def grouped(words: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word."""
    words = stored(words, "words")
    pairs = stored(near_words(words, limit), "near-words")
    both = pairs.union(pairs.select("b", "n_b", "a", "n_a")).toDF("word", "n", "other", "n_other")
    near = both.groupBy("word").agg(F.count("*").alias("n_near"))
    best = F.min(F.struct((-F.col("n_other")).alias("less"), "other")).alias("best")
    forms = both.where(F.col("n_other") >= OFTEN * F.col("n")).groupBy("word").agg(best)
    forms = forms.select("word", F.col("best.other").alias("form"), (-F.col("best.less")).alias("form_n"))
    forms = stored(forms, "forms")
    found = words.join(near, "word", "left").join(forms, "word", "left").join(roots(forms), "word", "left")
    return found.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n",
    )


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """The words of documents, grouped."""
    return grouped(words(docs, doc_id, text), limit)
