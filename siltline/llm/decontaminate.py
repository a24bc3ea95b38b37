"""Benchmark items in documents: SimHash of item-sized windows, verified by weighted shingles.

Words are lower-cased and lose all that is no letter or digit, so that marks put around words
hide nothing.  Shingles have five words (a shorter text is one shingle).

1. A window can reach ``SIMILARITY`` only if that share of its shingles are the item's, in
   whatever order: what it lacks of the item weighs 1 at most, and what is foreign weighs 1.  The
   shingles of all documents are joined with those of the items; for each length of item, the
   places of the matches are sorted, and every window of that length that holds enough of them is
   proposed.  The others cannot be verified and are never hashed.
2. Windows and items get 64-bit fingerprints (bits set in most of their shingles' hashes).  The
   fingerprints are cut into ``RADIUS + 1`` blocks; two that differ in ``RADIUS`` bits at most
   agree in one block at least, so a join on length, block and value misses none of them.
3. A pair within the radius is kept if the weighted Jaccard similarity of its shingles is at
   least ``SIMILARITY``.  A shingle weighs 1 / (number of items that have it), so what items
   share counts for less; it counts as often as it occurs.

Plan: one scan of the documents for step 1, in which the items' shingles are broadcast if there
are ``BROADCAST_SHINGLES`` at most (checked) and shuffled otherwise; no text is shuffled.  The
proposed windows are few and are joined back to the texts by digest, so that copies of a text
are looked at once; they are broadcast up to ``BROADCAST_WINDOWS`` (checked) and shuffled beyond.

An item of under five words is one shingle of all its words and is found only in texts that have
just those words; within longer texts such items are not searched.

Items and documents without words match nothing; NULL is such a text.  Repeated rows are all
contaminated or all clean.  An item id that occurs with two texts stands for both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from siltline.llm import text as T
from siltline.llm.tables import side

SHINGLE = 5
RADIUS = 20
SIMILARITY = 0.8
BROADCAST_SHINGLES = 500_000  # of 8 bytes and a list of lengths
BROADCAST_WINDOWS = 1_000_000  # of 8 bytes; the digest of a text counts as four


def _plain_words(text: Column) -> Column:
    """Lower-cased words without anything but letters and digits."""
    bare = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}\x20\x09-\x0D]+", "")
    return F.regexp_extract_all(bare, F.lit(T.WORD), F.lit(0))


def _with_shingles(df: DataFrame, text: str) -> DataFrame:
    """Adds ``_n`` (words) and ``_s`` (hashes of the shingles)."""
    df = df.withColumn("_w", F.transform(_plain_words(F.col(text)), lambda w: F.xxhash64(w)))
    df = df.withColumn("_n", F.size("_w"))
    df = df.withColumn("_w2", T.joined(F.col("_w"), F.col("_w"), 1))
    df = df.withColumn("_w4", T.joined(F.col("_w2"), F.col("_w2"), 2))
    five = T.joined(F.col("_w4"), F.col("_w"), SHINGLE - 1)
    few = F.when(F.col("_n") > 0, F.array(F.xxhash64(F.col("_w")))).otherwise(T.empty_longs())
    return df.withColumn("_s", F.when(F.col("_n") >= SHINGLE, five).otherwise(few)).drop("_w", "_w2", "_w4")


def fingerprint(hashes: Column) -> Column:
    """Bits that are set in more than half of the hashes."""
    n = F.size(hashes)
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(63)),
        F.lit(0).cast("bigint"),
        lambda acc, b: acc.bitwiseOR(
            F.when(
                2 * F.aggregate(hashes, F.lit(0), lambda k, h: k + F.getbit(h, b).cast("int")) > n,
                F.call_function("shiftleft", F.lit(1).cast("bigint"), b),
            ).otherwise(F.lit(0).cast("bigint"))
        ),
    )


def _blocks(fp: str) -> Column:
    """(block, value) of each of RADIUS + 1 runs of bits."""
    edges = [64 * i // (RADIUS + 1) for i in range(RADIUS + 2)]
    return F.array(
        *[
            F.struct(
                F.lit(i).alias("block"),
                F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << (high - low)) - 1).cast("bigint")).alias("bits"),
            )
            for i, (low, high) in enumerate(zip(edges, edges[1:]))
        ]
    )


def items_of(benchmark: DataFrame, text: str = "text", item_id: str = "item_id") -> DataFrame:
    """(item_id, key, item_words, item_shingles, item_fp) of the items that have words."""
    df = _with_shingles(benchmark.select(F.col(item_id).alias("item_id"), F.col(text).alias("_text")), "_text")
    df = T.where_late(df, F.col("_n") > 0).select(
        "item_id", F.xxhash64("_n", "_s").alias("key"), F.col("_n").alias("item_words"), F.col("_s").alias("item_shingles")
    )
    return df.withColumn("item_fp", fingerprint(F.col("item_shingles")))


def _with_weights(items: DataFrame) -> DataFrame:
    """Distinct items with array ``weights`` of (shingle, weight)."""
    items = items.dropDuplicates(["key"]).drop("item_id")
    shingles = items.select("key", F.explode(F.array_distinct("item_shingles")).alias("s"))
    holders = shingles.groupBy("s").agg(F.count("*").alias("holders"))
    weight = F.struct("s", (1 / F.col("holders")).alias("weight"))
    weights = shingles.join(holders, "s").groupBy("key").agg(F.sort_array(F.collect_list(weight)).alias("weights"))
    return items.join(weights, "key")


def _similarity(window: Column, item: Column, weights: Column) -> Column:
    """Weighted Jaccard similarity; shingles that the item lacks weigh 1."""

    def count(array: Column, x: Column) -> Column:
        return F.size(array) - F.size(F.array_remove(array, x))

    def weighed(choose) -> Column:
        return F.aggregate(
            weights, F.lit(0.0), lambda acc, w: acc + w["weight"] * choose(count(window, w["s"]), count(item, w["s"]))
        )

    foreign = F.size(F.filter(window, lambda x: ~F.array_contains(item, x)))
    return weighed(F.least) / (weighed(F.greatest) + foreign)


def _shingles_of(words: str) -> Column:
    return F.greatest(F.col(words) - (SHINGLE - 1), F.lit(1))


def _starts(at: str, n: str, words: str) -> Column:
    """Starts of the windows of which a share of ``SIMILARITY`` lies at the sorted places ``at``.

    ``least`` places in a row fit into the windows from where the last is still inside to where the
    first is; of those, the ones up to the place before have been counted with it.
    """
    size = F.least(_shingles_of(n), _shingles_of(words))
    least = F.ceil(SIMILARITY * size - 1e-9).cast("int")

    def starts(first: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get(at, i - 1)).otherwise(-1)
        low = F.greatest(F.get(at, i + least - 1) - size + 1, before + 1)
        high = F.least(first, _shingles_of(n) - size)
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    return F.flatten(F.transform(F.slice(at, F.lit(1), F.greatest(F.size(at) - least + 1, F.lit(0))), starts))


def _digest(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """(text_digest, item_id, start, words, similarity): windows of texts that repeat an item.

    One row for each distinct text, window and item; start and words count words.
    """
    texts = docs.select(_digest(F.col(text)).alias("text_digest"), F.col(text).alias("_text"))
    items = items_of(benchmark, item_text, item_id)
    weighted = _with_weights(items)

    # Step 1: windows that hold enough shingles of items of their length, at any place.
    lengths = items.select("item_words", F.explode("item_shingles").alias("s"))
    lengths = lengths.groupBy("s").agg(F.collect_set("item_words").alias("lengths"))
    small = items.agg(F.coalesce(F.sum(F.size("item_shingles")), F.lit(0))).first()[0] <= BROADCAST_SHINGLES
    held_back = F.broadcast if small else (lambda df: df)
    said = _with_shingles(texts, "_text").select("text_digest", "_n", F.posexplode(T.elements("_s")).alias("p", "s"))
    matches = said.join(held_back(lengths), "s").select("text_digest", "_n", "p", F.explode("lengths").alias("words"))
    matches = matches.groupBy("text_digest", "_n", "words").agg(F.sort_array(F.collect_set("p")).alias("at"))
    windows = matches.select("text_digest", "words", F.explode(_starts("at", "_n", "words")).alias("start"))
    windows = windows.groupBy("text_digest").agg(F.collect_list(F.struct("words", "start")).alias("windows"))
    windows = side(windows, "windows", 4 + F.size("windows"), BROADCAST_WINDOWS)

    # Step 2: fingerprints of windows and items, joined by blocks.
    found = texts.join(windows, "text_digest").dropDuplicates(["text_digest"])
    found = _with_shingles(found, "_text").select("text_digest", "_s", F.inline("windows"))
    found = found.select("text_digest", "words", "start", F.slice("_s", F.col("start") + 1, _shingles_of("words")).alias("window"))
    found = found.withColumn("fp", fingerprint(F.col("window")))
    probes = found.select("*", F.inline(_blocks("fp")))
    held = weighted.select("key", "item_words", "item_fp", F.inline(_blocks("item_fp")).alias("b", "v"))
    pairs = probes.join(held_back(held), F.expr("words = item_words AND block = b AND bits = v"))
    agree = F.zip_with(_blocks("fp"), _blocks("item_fp"), lambda x, y: F.when(x["bits"] == y["bits"], x["block"]))
    first = F.array_min(F.filter(agree, lambda x: x.isNotNull()))  # a pair counts where it meets first
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= RADIUS
    pairs = pairs.where(near).where(F.col("block") == first).select("text_digest", "words", "start", "window", "key")

    # Step 3: exact similarity.
    pairs = pairs.join(held_back(weighted.select("key", "item_shingles", "weights")), "key")
    pairs = pairs.withColumn("similarity", _similarity(F.col("window"), F.col("item_shingles"), F.col("weights")))
    pairs = T.where_late(pairs, F.col("similarity") >= SIMILARITY).select("text_digest", "key", "start", "words", "similarity")
    names = items.select("key", "item_id").distinct()
    return pairs.join(held_back(names), "key").select("text_digest", "item_id", "start", "words", "similarity")


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **names: str) -> DataFrame:
    """Struct ``_row`` with the columns of each contaminated document, and the columns of ``leaks``."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*columns).alias("_row"), _digest(F.col(text)).alias("text_digest"))
    found = side(leaks(docs, benchmark, text, **names), "leaks", F.lit(4), BROADCAST_WINDOWS)
    return rows.join(found, "text_digest")


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", **names: str) -> DataFrame:
    """The documents that repeat no item, with their columns."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*columns).alias("_row"), _digest(F.col(text)).alias("text_digest"))
    bad = leaks(docs, benchmark, text, **names).select("text_digest").distinct()
    bad = side(bad, "contaminated", F.lit(4), BROADCAST_WINDOWS)
    return rows.join(bad, "text_digest", "left_anti").select("_row.*")
