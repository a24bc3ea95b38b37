"""Words and shingles of whole texts as column expressions.

A word is a maximal run of characters other than space and tab to carriage return.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Words of a text; none of NULL."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def empty_longs() -> Column:
    return F.array().cast("array<bigint>")


def joined(hashes: Column, later: Column, gap: int) -> Column:
    """Hash of each element of ``hashes`` with the element of ``later`` that lies ``gap`` behind."""
    n = F.greatest(F.size(later) - gap, F.lit(0))
    return F.zip_with(
        F.slice(hashes, F.lit(1), n), F.slice(later, F.lit(1 + gap), n), lambda a, b: F.xxhash64(a, b)
    )


def total(numbers: Column) -> Column:
    """Sum of an array of longs."""
    return F.aggregate(numbers, F.lit(0).cast("bigint"), lambda a, x: a + x)


def where_late(df: DataFrame, condition: Column) -> DataFrame:
    """Filter that stays above the columns it uses.

    The optimizer would push it below them by repeating their expressions for each use, which
    takes far longer than the rows it saves.  It does not push through a column of random numbers.
    """
    return df.withColumn("_late", F.rand(0)).where(condition & (F.col("_late") >= 0)).drop("_late")


def elements(array: str) -> Column:
    """The array as an expression, from which no filter on its size is derived and pushed down."""
    return F.when(F.size(array) > 0, F.col(array))
