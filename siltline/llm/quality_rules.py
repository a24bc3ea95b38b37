"""Quality rules: how far a document's histograms lie from those of its language.

Two histograms are taken of every whole text: characters by class, and frequent short words.
The reference of a language is the mean histogram of its documents (each document counts the
same, whatever its length), over all documents that are long enough to have a shape.  A
document is rejected if it fails the base rules or if one of its Jensen-Shannon distances (the
root of the divergence to base 2, between 0 and 1) is above a threshold.  Texts with fewer
words than the guard of a histogram are not judged by it: they have too few to compare.

Plan: no text is shuffled.  ``assess`` scans the texts once and keeps the counts of each, a few
hundred bytes, in the shared folder; ``keep_good`` scans them twice, for the reference and for
the verdict.  The reference sums integer parts per million by language, so it does not depend on
the order of addition; it has one row for each language of ``COMMON_WORDS`` and one for all
others, so it can be broadcast.

NULL and empty texts have no words and fail the base rules.  Languages that are NULL or not listed
have one reference together, and no frequent words: only their characters are judged.  Without
any document that is long enough there is no reference, and the base rules decide alone.
Repeated rows are judged like any other.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from siltline.llm import text as T
from siltline.llm.tables import stored

# Frequent words of four languages, by ISO 639-1 code.
COMMON_WORDS = {
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem"),
    "en": ("the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "on", "are", "with", "as", "be"),
    "es": ("de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par"),
}
ANY_COMMON = tuple(sorted({w for words in COMMON_WORDS.values() for w in words}))
BINS = 17  # the frequent words of a language, and all other words
SYMBOLS = "#*$%&|<>"
POINTS = ".,;:!?'\"()-"
MILLION = 1_000_000

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
CHAR_GUARD = 50  # words below which the histogram of characters is not judged
WORD_GUARD = 100  # words below which the histogram of frequent words is not judged
MAX_CHAR_DISTANCE = 0.3
MAX_WORD_DISTANCE = 0.3

_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _removed(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _with_histograms(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """Adds the language, the words and both histograms as counts."""
    raw = F.coalesce(F.col(text), F.lit(""))
    df = docs.withColumn("_language", F.when(F.col(lang).isin(*COMMON_WORDS), F.col(lang)).otherwise("other"))
    df = df.withColumn("_rest", F.regexp_replace(raw, "[a-z]+", ""))
    df = df.withColumn("_lower", F.length(raw) - F.length("_rest"))
    df = df.withColumn("_words", T.words(F.col(text)))
    rest = F.col("_rest")
    counts = {
        "space": _removed(rest, T.SPACES),
        "upper": _removed(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        "digit": _removed(rest, "0123456789"),
        "symbol": _removed(rest, SYMBOLS),
        "point": _removed(rest, POINTS),
    }
    df = df.withColumn(
        "_counts", F.struct(*[c.cast("bigint").alias(n) for n, c in counts.items()], F.length(rest).cast("bigint").alias("all"))
    )
    c = F.col("_counts")
    other = c["all"] - c["space"] - c["upper"] - c["digit"] - c["symbol"] - c["point"]
    df = df.withColumn(
        "_chars",
        F.array(F.col("_lower").cast("bigint"), c["upper"], c["digit"], c["space"], c["symbol"], c["point"], other),
    )
    plain = F.split(F.lower(raw), r"[^\p{L}]+")
    df = df.withColumn("_common", F.filter(plain, lambda w: w.isin(*ANY_COMMON)))
    lists = F.array().cast("array<string>")
    for language, words in COMMON_WORDS.items():
        lists = F.when(F.col("_language") == language, F.array(*[F.lit(w) for w in words])).otherwise(lists)
    found = F.size("_common")
    df = df.withColumn(
        "_hits", F.transform(lists, lambda w: (found - F.size(F.array_remove("_common", w))).cast("bigint"))
    )
    others = F.greatest(F.size("_words") - T.total(F.col("_hits")), F.lit(0)).cast("bigint")
    return df.withColumn("_bins", F.when(F.size("_hits") > 0, F.concat("_hits", F.array(others))))


def _with_total(df: DataFrame, histogram: str) -> DataFrame:
    return df.withColumn(f"{histogram}_n", T.total(F.col(histogram)))


def _share(histogram: str, i: int) -> Column:
    """Parts per million of an entry, rounded down."""
    return F.floor(F.col(histogram)[i] * MILLION / F.greatest(f"{histogram}_n", F.lit(1))).cast("bigint")


def _references(df: DataFrame, words: Column) -> DataFrame:
    """(language, chars, bins): the mean histograms of each language, five rows at most."""
    df = T.where_late(df, words >= CHAR_GUARD)
    df = _with_total(_with_total(df, "_chars"), "_bins")
    sizes = {"_chars": 7, "_bins": BINS}
    sums = [F.sum(_share(n, i)).alias(f"{n}{i}") for n, size in sizes.items() for i in range(size)]
    df = df.groupBy("_language").agg(*sums)
    return df.select(
        "_language",
        F.array(*[f"_chars{i}" for i in range(sizes["_chars"])]).alias("_ref_chars"),
        F.when(F.col("_bins0").isNotNull(), F.array(*[f"_bins{i}" for i in range(BINS)])).alias("_ref_bins"),
    )


def references(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The reference histograms of a table of documents."""
    df = _with_histograms(docs.select(F.col(lang).alias("_lang"), F.col(text).alias("_text")), "_text", "_lang")
    return _references(df, F.size("_words"))


def distance(counts: str, reference: str) -> Column:
    """Jensen-Shannon distance of two histograms with their totals; NULL if one is empty."""
    p_n, q_n = F.col(f"{counts}_n"), F.col(f"{reference}_n")

    def term(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log(2 * a / (a + b)) / (2 * math.log(2))).otherwise(0.0)

    terms = F.zip_with(counts, reference, lambda x, y: term(x / p_n, y / q_n) + term(y / q_n, x / p_n))
    divergence = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    return F.when((p_n > 0) & (q_n > 0), F.sqrt(F.greatest(divergence, F.lit(0.0))))


def _with_repeats(df: DataFrame, text: str) -> DataFrame:
    """Adds the counts of the base rules."""
    df = df.withColumn("_h1", F.transform("_words", lambda w: F.xxhash64(w)))
    gap, at = 1, "_h1"
    while gap < WINDOW:  # windows of 2, 4 and 8 words
        df = df.withColumn(f"_h{2 * gap}", T.joined(F.col(at), F.col(at), gap))
        gap, at = 2 * gap, f"_h{2 * gap}"
    sorted_windows = F.array_sort(F.transform(at, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn(
        "_windows",
        F.when(F.size(F.array_distinct(at)) < F.size(at), sorted_windows).otherwise(
            F.array().cast("array<struct<h:bigint,i:int>>")
        ),
    )
    w = F.col("_windows")
    same = F.filter(
        w, lambda x, k: (F.get(w, k - 1)["h"] == x["h"]) | (F.get(w, k + 1)["h"] == x["h"])
    )
    df = df.withColumn("_at", F.array_sort(F.transform(same, lambda x: x["i"])))
    nexts = F.slice("_at", F.lit(2), F.greatest(F.size("_at") - 1, F.lit(0)))
    covered = F.zip_with(
        "_at", nexts, lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))).cast("bigint")
    )
    lines = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: x.rlike(T.WORD))
    df = df.withColumn("_lines", lines)
    return df.withColumns(
        {
            "n_words": F.size("_words").cast("bigint"),
            "word_chars": F.length(F.coalesce(F.col(text), F.lit(""))).cast("bigint") - F.col("_counts")["space"],
            "n_symbols": F.col("_counts")["symbol"],
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
            "n_repeat_words": T.total(covered),
        }
    )


def _measured(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """Struct ``_row`` with the columns of ``docs``, and all that is counted."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    df = docs.select(F.struct(*columns).alias("_row"), F.col(text).alias("_text"), F.col(lang).alias("_lang"))
    return _with_repeats(_with_histograms(df, "_text", "_lang"), "_text")


def _verdict(measured: DataFrame, reference: DataFrame) -> DataFrame:
    """``_row`` and struct ``quality``."""
    df = measured.join(F.broadcast(reference), "_language", "left")  # five rows at most
    n = F.col("n_words")
    base_failed = (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n)
    for histogram in ("_chars", "_ref_chars", "_bins", "_ref_bins"):
        df = _with_total(df, histogram)
    df = df.withColumn("char_distance", distance("_chars", "_ref_chars"))
    df = df.withColumn("word_distance", distance("_bins", "_ref_bins"))
    far = ((n >= CHAR_GUARD) & (F.coalesce("char_distance", F.lit(0.0)) > MAX_CHAR_DISTANCE)) | (
        (n >= WORD_GUARD) & (F.coalesce("word_distance", F.lit(0.0)) > MAX_WORD_DISTANCE)
    )
    verdict = F.struct(
        *_COLUMNS, "char_distance", "word_distance", base_failed.alias("base_failed"), (~base_failed & ~far).alias("kept")
    )
    return df.select("_row", verdict.alias("quality"))


def assess(docs: DataFrame, keys: list[str], text: str = "text", lang: str = "lang") -> DataFrame:
    """Columns ``keys`` of the documents and struct ``quality``: counts, distances, base_failed, kept."""
    row = F.struct(*[F.col("_row")[k].alias(k) for k in keys]).alias("_row")
    measured = _measured(docs, text, lang).select(row, "_language", "_chars", "_bins", *_COLUMNS)
    measured = stored(measured, "quality-counts")
    return _verdict(measured, _references(measured, F.col("n_words"))).select("_row.*", "quality")


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", reference: DataFrame | None = None) -> DataFrame:
    """The documents that pass, with their columns; ``reference`` is made of them by default."""
    reference = references(docs, text, lang) if reference is None else reference
    judged = _verdict(_measured(docs, text, lang), reference)
    return T.where_late(judged, F.col("quality.kept")).select("_row.*")
