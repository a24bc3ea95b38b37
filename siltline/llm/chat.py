"""Logged conversations: cumulative snapshots collapsed, the rest rendered for training.

A log that is written at every turn holds each conversation many times, as a prefix of itself.
Only conversations that are no prefix of a longer one stay; of equal ones that with the smallest
id stays.  A turn's hash covers its place, role and text; the hash of a prefix is the sum of the
hashes of its turns (modulo 2^64), which rolls from turn to turn.  A conversation goes if the
hash, number of turns and last place of the whole of it are those of a proper prefix of another.

Plan, on built-in functions alone:

* Texts are hashed where they are read; ids, places and hashes are shuffled.
* Running sums are taken over parts of ``PART`` places, and over the sums of the parts, so that a
  conversation with very many turns is not one task.
* Prefixes and whole conversations are aggregated by hash before they are joined: a first turn
  or a conversation that is very frequent is one row.  What goes is taken away by anti-joins.
* A rendered conversation comes in parts of ``PART`` places, to be joined in order; nearly all
  conversations have one part.

Places are the turn numbers as logged.  Turns that are repeated (same place, role and text) count
once.  Turns of one place are ordered by role and text.  NULL places come first, as place -1; NULL
roles and texts are empty.  Turns without a conversation id belong to none and are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

PART = 1024
# The marks of the rendered format.
START, END = "<|im_start|>", "<|im_end|>"

_WIDE = "decimal(38,0)"


def _turns(log: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, part, place, role, text, hash) of every row."""
    place = F.coalesce(F.col(turn).cast("bigint"), F.lit(-1))
    df = log.select(
        F.col(conv_id).alias("conv"), place.alias("place"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).where("conv IS NOT NULL")
    part = F.floor(F.col("place") / PART).cast("bigint")
    return df.select("conv", part.alias("part"), "place", "role", "text", F.xxhash64("place", "role", "text").alias("hash"))


def _rolled(total: Column) -> Column:
    """A sum of hashes modulo 2^64, as a decimal."""
    return F.pmod(total, F.lit(str(2**64)).cast(_WIDE)).cast(_WIDE)


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv, place, hash, n) of the prefix that ends at each place, its turns included."""
    places = turns.select("conv", "part", "place", "hash").distinct()
    places = places.groupBy("conv", "part", "place").agg(
        F.sum(F.col("hash").cast(_WIDE)).alias("hash"), F.count("*").alias("n")
    )
    parts = places.groupBy("conv", "part").agg(F.sum("hash").alias("hash"), F.sum("n").alias("n"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast(_WIDE)
    parts = parts.select(
        "conv", "part",
        F.coalesce(F.sum("hash").over(before), zero).alias("hash_before"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"),
    )
    within = Window.partitionBy("conv", "part").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rolled = places.select("conv", "part", "place", F.sum("hash").over(within).alias("hash"), F.sum("n").over(within).alias("n"))
    rolled = rolled.join(parts, ["conv", "part"])
    return rolled.select(
        "conv", "place", _rolled(F.col("hash") + F.col("hash_before")).alias("hash"), (F.col("n") + F.col("n_before")).alias("n")
    )


def maximal(log: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, n): the conversations that stay, and the number of their turns."""
    rolled = prefixes(_turns(log, conv_id, turn, role, text))
    last = rolled.groupBy("conv").agg(F.max_by(F.struct("place", "hash", "n"), "place").alias("whole"))
    whole = last.groupBy("whole").agg(F.min("conv").alias("conv"))
    ends = last.select("conv", F.col("whole.place").alias("end"))
    proper = rolled.join(ends, "conv").where("place < end").select("place", "hash", "n").distinct()
    whole = whole.select("conv", "whole.*")
    return whole.join(proper, ["place", "hash", "n"], "left_anti").select("conv", "n")


def rendered(log: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, part, n_turns, text) of the conversations that stay; parts count from 0."""
    turns = _turns(log, conv_id, turn, role, text)
    kept = maximal(log, conv_id, turn, role, text).select("conv")
    turns = turns.join(kept, "conv", "left_semi")
    said = F.concat(F.lit(START), "role", F.lit("\n"), "text", F.lit(f"{END}\n"))
    ordered = F.array_sort(F.collect_set(F.struct("place", "role", "text", said.alias("said"))))
    parts = turns.groupBy("conv", "part").agg(ordered.alias("turns"))
    number = F.row_number().over(Window.partitionBy("conv").orderBy("at")) - 1
    numbers = turns.select("conv", F.col("part").alias("at")).distinct().withColumn("number", number.cast("bigint"))
    parts = parts.join(numbers.select(F.col("conv"), F.col("at").alias("part"), "number"), ["conv", "part"])
    return parts.select(
        F.col("conv").alias("conv_id"), F.col("number").alias("part"), F.size("turns").cast("bigint").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: t["said"]), "").alias("text"),
    )
