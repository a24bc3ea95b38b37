"""Language-model scores by stupid backoff, with counts of the whole corpus.

An n-gram that the corpus has ``LEAST`` times or more scores its count over that of its context;
any other scores ``BACKOFF`` times what its shorter suffix scores; a single word scores its share
of all words.  (Each document is part of the corpus, so an n-gram seen once is seen only in the
document that is scored.)  The score of a document is the sum of the logarithms to base 10, in
whole millionths for each word, so that it does not depend on the order of addition.

Plan.  Documents are dealt into chunks.  Each chunk asks once for every distinct n-gram it holds:
it sends hashes with its own counts, in one array for each hash partition.  A partition adds the
counts of all chunks up and answers each with the totals of what it asked for.  The answers are
joined to the n-grams of the chunk's documents and summed for each document.

* A frequent n-gram is one entry for each chunk, however often it occurs, so no partition is hot.
* Chunks and partitions hold about ``CHUNK_BYTES`` of text and what is counted in as much; their
  numbers grow with the corpus.  Nothing is kept for the whole corpus on the driver.
* Rows that repeat id and text all fall to one chunk.  If they fill a good part of it, they are
  one row there, which counts as often as it occurs, and its score is joined to all of them.
* N-grams, and rows that repeat, are known by 64-bit hashes.

Words are runs without white space; A-Z count as a-z.  NULL is an empty text; texts without words
score 0.  Repeated rows are parts of the corpus like any other, and each is scored.
"""

import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from siltline.llm.tables import side, stored

ORDER = 2
LEAST = 2
BACKOFF = 0.4
CHUNK_BYTES = 16 << 20
ROW_BYTES = 64  # of a row besides its text
BROADCAST_ROWS = 1_000_000  # of 8 bytes, or of a score
MILLION = 1_000_000

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_SEEN = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers without visible order."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Chunk:
    """The n-grams of some texts.

    ``hashes[k]``: the (k+1)-gram that ends at each word; ``whole[k]``: whether the document has
    as many words before it; ``sizes``: words of each text.
    """

    def __init__(self, texts, order: int):
        known: dict[bytes, int] = {}
        places, sizes = [], []
        for text in texts:
            words = _WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())
            sizes.append(len(words))
            places += [known.setdefault(w, len(known)) for w in words]
        single = np.fromiter((xxhash.xxh64_intdigest(w) for w in known), np.uint64, len(known))
        self.sizes = np.array(sizes, np.int64)
        words = single[np.array(places, np.int64)] if places else np.zeros(0, np.uint64)
        starts = np.cumsum(self.sizes) - self.sizes
        within = np.arange(len(words)) - np.repeat(starts, self.sizes)
        self.hashes, self.whole = [words], [np.ones(len(words), bool)]
        for k in range(1, order):
            longer = np.zeros(len(words), np.uint64)
            if len(words) > 1:
                longer[1:] = _mixed(self.hashes[-1][:-1] * _SEEN + _mixed(words[1:]) + np.uint64(k))
            self.hashes.append(longer)
            self.whole.append(within >= k)

    def distinct(self, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Sorted hashes of the n-grams, and how often the chunk has each.

        times: how often each text counts, if not once.
        """
        found = np.concatenate([h[w] for h, w in zip(self.hashes, self.whole)])
        if times is None:
            return np.unique(found, return_counts=True)
        each = np.repeat(times, self.sizes)
        hashes, place = np.unique(found, return_inverse=True)
        weights = np.concatenate([each[w] for w in self.whole])
        return hashes, np.bincount(place, weights=weights, minlength=len(hashes)).astype(np.int64)


def _partition(hashes: np.ndarray, partitions: int) -> np.ndarray:
    """Ends of the runs of sorted hashes that belong to each partition: equal ranges of hashes."""
    edges = [(i + 1 << 64) // partitions - 1 for i in range(partitions)]
    return np.searchsorted(hashes, np.array(edges, np.uint64), side="right")


def _asked(order: int, partitions: int):
    def run(docs: pd.DataFrame) -> pd.DataFrame:
        times = docs["times"].clip(lower=1).to_numpy() if "times" in docs else None
        hashes, counts = Chunk(docs["text"], order).distinct(times)
        counts = counts.astype(np.int32 if counts.max(initial=0) < 1 << 31 else np.int64)
        ends = _partition(hashes, partitions)
        chunk = int(docs["chunk"].iloc[0])
        rows, begin = [], 0
        for part, end in enumerate(ends.tolist()):
            if end > begin:
                rows.append((part, chunk, hashes[begin:end].tobytes(), counts[begin:end].tobytes()))
            begin = end
        return pd.DataFrame(rows, columns=["part", "chunk", "hashes", "counts"])

    return run


def _answered(asked: pd.DataFrame) -> pd.DataFrame:
    """Totals over all chunks for what each has asked for."""
    hashes = [np.frombuffer(h, np.uint64) for h in asked["hashes"]]
    counts = [np.frombuffer(c, np.int32 if len(c) < len(h) else np.int64) for h, c in zip(asked["hashes"], asked["counts"])]
    _, place = np.unique(np.concatenate(hashes), return_inverse=True)
    totals = np.bincount(place, weights=np.concatenate(counts)).astype(np.int64)[place]
    ends = np.cumsum([len(h) for h in hashes])[:-1]
    return pd.DataFrame(
        {"chunk": asked["chunk"], "part": asked["part"], "totals": [t.tobytes() for t in np.split(totals, ends)]}
    )


def _scored(order: int, least: int, backoff: float, n_words: int):
    def run(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        chunk = Chunk(docs["text"], order)
        hashes, _ = chunk.distinct()
        answers = answers.sort_values("part")
        totals = np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(t, np.int64) for t in answers["totals"]]])
        counts = [np.where(w, totals[np.searchsorted(hashes, h) % max(len(hashes), 1)], 0) if len(hashes) else np.zeros(0)
                  for h, w in zip(chunk.hashes, chunk.whole)]
        share = counts[0] / max(n_words, 1)
        backed = np.zeros(len(share), np.int64)
        score = share
        for k in range(1, order):
            context = np.concatenate([[0], counts[k - 1][:-1]])[: len(share)]
            seen = chunk.whole[k] & (counts[k] >= least)
            lower = np.where(chunk.whole[k], backoff * score, score)  # no shorter context, no loss
            backed += chunk.whole[k] & ~seen
            score = np.where(seen, counts[k] / np.maximum(context, 1), lower)
        parts = np.rint(MILLION * np.log10(np.where(score > 0, score, 1))).astype(np.int64)
        of = np.repeat(np.arange(len(docs)), chunk.sizes)
        out = docs.drop(columns=["text", "chunk"]).reset_index(drop=True)
        out["n_words"] = chunk.sizes
        out["n_backoff"] = np.bincount(of, weights=backed, minlength=len(docs)).astype(np.int64)
        out["micro_log10"] = _sums(of, parts, len(docs))
        return out

    return run


def _sums(of: np.ndarray, parts: np.ndarray, n: int) -> np.ndarray:
    sums = np.zeros(n, np.int64)
    np.add.at(sums, of, parts)
    return sums


def score(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    order: int = ORDER,
    least: int = LEAST,
    backoff: float = BACKOFF,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """(doc_id, n_words, n_backoff, micro_log10) of every row.

    n_backoff: steps to a shorter context; micro_log10: the score in millionths.
    """
    words = F.size(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    size = docs.agg(F.sum(F.octet_length(text).cast("bigint")), F.sum(words.cast("bigint"))).first()
    chunks = max(1, -(-(size[0] or 0) // chunk_bytes))
    n_words = size[1] or 0
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(doc_id, text).alias("copy"))
    full = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + ROW_BYTES) > chunk_bytes // 4
    often = docs.groupBy("copy").agg(F.count("*").alias("n"), full.alias("full")).where("n > 1 AND full").select("copy")
    often = side(often, "repeated-rows", F.lit(1), BROADCAST_ROWS)
    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = f"doc_id {kind}, n_words bigint, n_backoff bigint, micro_log10 bigint"
    if often.isEmpty():
        return _score(docs.drop("copy"), F.xxhash64("doc_id", "text"), chunks, order, least, backoff, n_words, columns)

    # times: 0 for a row that stands for itself
    once = docs.join(often, "copy", "left_semi").groupBy("copy", "doc_id", "text").agg(F.count("*").alias("times"))
    rows = docs.join(often, "copy", "left_anti").withColumn("times", F.lit(0).cast("bigint")).unionByName(once)
    found = _score(rows, F.col("copy"), chunks, order, least, backoff, n_words, columns + ", copy bigint, times bigint")
    found = stored(found, "scores")
    shared = side(found.where("times > 0").drop("doc_id", "times"), "repeated-scores", F.lit(1), BROADCAST_ROWS)
    every = docs.select("doc_id", "copy").join(shared, "copy").drop("copy")
    return found.where("times = 0").drop("copy", "times").unionByName(every)


def _score(rows: DataFrame, key, chunks: int, order: int, least: int, backoff: float, n_words: int, columns: str) -> DataFrame:
    """Scores of rows that are dealt into chunks by ``key``."""
    dealt = rows.withColumn("chunk", F.pmod(key, F.lit(chunks)).cast("int"))
    asked = dealt.groupBy("chunk").applyInPandas(
        _asked(order, chunks), "part int, chunk int, hashes binary, counts binary"
    )
    answers = asked.groupBy("part").applyInPandas(_answered, "chunk int, part int, totals binary")
    return dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(
        _scored(order, least, backoff, n_words), columns
    )
