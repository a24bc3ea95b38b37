"""Near duplicates by SimHash, found with the general pigeonhole principle.

Bits that go together are put into the same of m parts.  Part i gets a threshold t_i so that the
thresholds add up to r - m + 1 (r: the radius; -1 leaves a part out).  Two fingerprints that
differ in r bits at most then differ in t_i bits at most in some part i: else they would differ
in at least sum(t_i + 1) = r + 1 bits.  The numbers of parts and the thresholds are those with
the smallest estimated cost, found by dynamic programming; the estimate comes from counts over
all fingerprints.  Each fingerprint is put under its own value of a part and, if the threshold
allows, under all values near it; what shares a value is verified by comparing all 64 bits.

* Equal fingerprints are one before anything is joined, however many documents have them.
* A value under which more than ``LIMIT`` entries meet is cut again: the bits outside the part
  are split into r + 1 parts, one of which must agree.  This is repeated until r bits are left:
  then only as many entries can meet as there are numbers that near.
* Under a value only the links of a spanning forest are returned, so a group of near copies
  costs about one row for each member and value, not one for each pair.
* Components are found by rounds of star contraction, each written to the shared folder.

A text without words has fingerprint zero and is linked like any other; NULL is such a text.
A NULL id counts as the largest of all.  Repeated rows get the same component.
"""


import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType

from siltline.llm import text as T
from siltline.llm.tables import stored

RADIUS = 3
SHINGLE = 3
BITS = 64
LIMIT = 4096  # entries that are compared with each other in one step
MOST_PARTS = 6
ROW_COST = 300.0  # of putting a fingerprint under a value, in comparisons of two fingerprints
NO_ID = (1 << 63) - 1


def _with_shingles(df: DataFrame, text: str, size: int) -> DataFrame:
    """Adds ``_s``: XXH64 (seed 42) of each shingle; letters A-Z count as a-z."""
    plain = F.translate(F.col(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    df = df.withColumn("_w", T.words(plain)).withColumn("_m", F.greatest(F.size("_w") - (size - 1), F.lit(0)))
    several = F.slice("_w", F.lit(1), F.col("_m"))
    for k in range(1, size):
        several = F.zip_with(several, F.slice("_w", F.lit(1 + k), F.col("_m")), lambda a, b: F.concat(a, F.lit(" "), b))
    whole = F.when(F.size("_w") > 0, F.array(F.xxhash64(F.array_join("_w", " ")))).otherwise(T.empty_longs())
    df = df.withColumn("_s", F.when(F.col("_m") > 0, F.transform(several, lambda x: F.xxhash64(x))).otherwise(whole))
    return df.drop("_w", "_m")


@F.pandas_udf(LongType())
def majority(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The bits that are set in more than half of the hashes of each row."""

    def bits(hashes) -> int:
        n = len(hashes)
        if not n:
            return 0
        counts = np.zeros(BITS, np.int64)
        lanes = np.unpackbits(np.ascontiguousarray(hashes, "<i8").view(np.uint8), bitorder="little").reshape(n, BITS)
        for start in range(0, n, 255 * 1024):  # sums of 255 bits at most fit in a byte
            block = lanes[start : start + 255 * 1024]
            full = len(block) // 255 * 255
            counts += block[:full].reshape(-1, 255, BITS).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
            counts += block[full:].sum(axis=0, dtype=np.uint8)
        return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])

    for rows in batches:
        yield pd.Series([bits(h) for h in rows], dtype="int64")


def with_fingerprint(df: DataFrame, text: str, name: str = "fp", size: int = SHINGLE) -> DataFrame:
    """Adds the 64-bit SimHash of a text as a long."""
    return _with_shingles(df, text, size).withColumn(name, majority("_s")).drop("_s")


def hexadecimal(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


# --- partition of the bits, thresholds ---------------------------------------------------------


def correlations(prints: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of fingerprints, shares of set bits, and correlation of all pairs of bits."""

    def counted(batches):

        n, both = 0, np.zeros((BITS, BITS))
        for batch in batches:
            values = batch["fp"].to_numpy("<i8")
            for start in range(0, len(values), 65536):
                block = np.ascontiguousarray(values[start : start + 65536])
                ones = np.unpackbits(block.view(np.uint8), bitorder="little").reshape(-1, BITS).astype(np.float32)
                n, both = n + len(block), both + ones.T @ ones
        cells = np.append(both.ravel(), n).astype(np.int64)
        yield pd.DataFrame({"cell": np.arange(len(cells)), "n": cells})

    sums = prints.select("fp").mapInPandas(counted, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    cells = np.zeros(BITS * BITS + 1)
    for row in sums.collect():  # 64 x 64 + 1 rows
        cells[row["cell"]] = row["n"]
    n = int(cells[-1])
    both = cells[:-1].reshape(BITS, BITS) / max(n, 1)
    ones = np.diag(both)
    spread = np.sqrt(np.clip(ones * (1 - ones), 1e-9, None))
    return n, ones, (both - np.outer(ones, ones)) / np.outer(spread, spread)


def parts_of(correlation: np.ndarray, m: int) -> list[list[int]]:
    """m parts of nearly equal size; each takes the bits that go with those it has."""
    strength = np.abs(correlation - np.eye(len(correlation)))
    left = list(range(len(correlation)))
    parts = []
    for i in range(m):
        size = len(left) // (m - i)
        part = [max(left, key=lambda b: strength[b, left].sum())]
        left.remove(part[0])
        while len(part) < size:
            best = max(left, key=lambda b: strength[b, part].sum())
            part.append(best)
            left.remove(best)
        parts.append(sorted(part))
    return parts


def expected_pairs(n: int, ones: np.ndarray, correlation: np.ndarray, part: list[int], radius: int) -> list[float]:
    """Estimated pairs that differ in at most 0, 1, .. radius bits of a part."""
    agree = np.clip(ones[part] ** 2 + (1 - ones[part]) ** 2, 0.5, 1.0)
    inner = np.abs(correlation[np.ix_(part, part)] - np.eye(len(part))).sum() / max(len(part), 1)
    free = len(part) / (1 + inner)  # as many bits as would be free of each other
    scale = free / max(len(part), 1)
    exactly = np.zeros(radius + 1)
    exactly[0] = math.exp(np.log(agree).sum() * scale)
    for p in agree:
        odds = (1 - p) / p
        exactly[1:] += exactly[:-1] * odds
    return list(np.cumsum(exactly) * n * n / 2)


def values_near(width: int, threshold: int) -> int:
    return sum(math.comb(width, k) for k in range(threshold + 1)) if threshold >= 0 else 0


def thresholds(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Smallest sum of costs[i][t_i + 1] with thresholds t_i >= -1 that add up to ``total``."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for own in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for done, (cost, chosen) in best.items():
            for t, more in enumerate(own, start=-1):
                found = (cost + more, [*chosen, t])
                if done + t not in step or found < step[done + t]:
                    step[done + t] = found
        best = step
    return best.get(total, (math.inf, []))


def allocate(n: int, ones: np.ndarray, correlation: np.ndarray, radius: int = RADIUS) -> list[tuple[list[int], int]]:
    """Parts with their thresholds, at the smallest estimated cost."""
    n = max(n, 1)
    plans = []
    for m in range(1, MOST_PARTS + 1):
        parts = parts_of(correlation, m)
        costs = []
        for part in parts:
            pairs = expected_pairs(n, ones, correlation, part, radius)
            probes = [values_near(len(part), t) for t in range(radius + 1)]
            costs.append([0.0, *[n * p * ROW_COST + c for p, c in zip(probes, pairs)]])
        cost, chosen = thresholds(costs, radius - m + 1)
        plans.append((cost, [(p, t) for p, t in zip(parts, chosen) if t >= 0]))
    return min(plans, key=lambda plan: plan[0])[1]


# --- links -------------------------------------------------------------------------------------


def _mask(bits: list[int]) -> int:
    return int(np.array([sum(1 << b for b in bits)], np.uint64).view(np.int64)[0])


def _under_values(prints: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """(value, rest, fp, own): each fingerprint under its values; rest: the bits outside."""
    found = None
    for i, (part, threshold) in enumerate(plan):
        own = F.col("fp").bitwiseAND(F.lit(_mask(part)))
        near = [sum(1 << b for b in c) for k in range(threshold + 1) for c in combinations(part, k)]
        flips = np.array(near, np.uint64).view(np.int64).tolist()
        rest = _mask([b for b in range(BITS) if b not in part])
        rows = prints.select(
            "fp", F.lit(rest).alias("rest"), own.alias("v"), F.explode(F.array(*[F.lit(x) for x in flips])).alias("flip")
        ).select(
            F.xxhash64(F.lit(i), F.col("v").bitwiseXOR(F.col("flip"))).alias("value"),
            "rest", "fp", (F.col("flip") == 0).alias("own"),
        )
        found = rows if found is None else found.union(rows)
    return found


def _cut(rows: DataFrame, radius: int) -> DataFrame:
    """The entries of full values again, under radius + 1 parts of the bits not yet fixed."""

    def parts(batches):
        for batch in batches:
            out = []
            rest = batch["rest"].to_numpy()
            for mask in np.unique(rest):
                some = batch[rest == mask]
                bits = [b for b in range(BITS) if int(mask) >> b & 1]
                for j in range(radius + 1):
                    own = _mask(bits[j :: radius + 1])
                    out.append(some.assign(rest=int(mask) & ~own, step=j, sub=some["fp"].to_numpy() & own))
            yield pd.concat(out) if out else batch.assign(step=0, sub=0)

    cut = rows.mapInPandas(parts, "value bigint, rest bigint, fp bigint, own boolean, step int, sub bigint")
    return cut.select(F.xxhash64("value", "step", "sub").alias("value"), "rest", "fp", "own")


def forest(fps: np.ndarray, own: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Pairs of places that link all entries which pairs within the radius link.

    Of two linked entries one at least lies under its own value.
    """
    fps = np.ascontiguousarray(fps, np.int64).view(np.uint64)  # bits of negative numbers count as they are
    pairs = []
    left = np.arange(len(fps))
    while len(left) > 1:
        reached, left = [int(left[0])], left[1:]
        while reached and len(left):
            at = reached.pop()
            near = np.bitwise_count(fps[left] ^ fps[at]) <= radius
            if not own[at]:
                near &= own[left]
            new = left[near].tolist()
            if new:
                left = left[~near]
                reached += new
                pairs += [(at, x) for x in new]
    return pairs


def _linked(radius: int):
    """Function for mapInPandas: from values with their entries to links."""

    def run(batches):
        for batch in batches:
            found = []
            for fps, own in zip(batch["fps"], batch["owns"]):
                fps = np.asarray(fps, np.int64)
                found += [(fps[x], fps[y]) for x, y in forest(fps, np.asarray(own, bool), radius)]
            pairs = np.array(found, np.int64).reshape(-1, 2)
            yield pd.DataFrame({"a": pairs.min(axis=1), "b": pairs.max(axis=1)}).query("a < b")

    return run


def links(prints: DataFrame, radius: int = RADIUS, limit: int = LIMIT) -> DataFrame:
    """(a, b), a < b: links of fingerprints that connect what lies within the radius.

    ``prints`` has distinct fp.  Every link is verified, and all components of the
    graph of pairs within the radius are connected by them.
    """
    n, ones, correlation = correlations(prints)
    rows = _under_values(prints, allocate(n, ones, correlation, radius))
    found = []
    while True:
        # At most n * values / limit values are full.  With hardly a bit left to cut by, a value
        # holds no more entries than there are numbers that near.
        full = rows.groupBy("value").agg(F.count("*").alias("n"), F.max(F.bit_count("rest")).alias("bits"))
        full = stored(full.where((F.col("n") > limit) & (F.col("bits") > radius)).select("value"), "full-values")
        some = not full.isEmpty()
        light = rows.join(full, "value", "left_anti") if some else rows
        grouped = light.groupBy("value").agg(
            F.collect_list("fp").alias("fps"), F.collect_list("own").alias("owns")
        )
        grouped = grouped.where((F.size("fps") > 1) & F.exists("owns", lambda x: x))
        found.append(grouped.select("fps", "owns").mapInPandas(_linked(radius), "a bigint, b bigint"))
        if not some:
            break
        rows = stored(_cut(rows.join(full, "value", "left_semi"), radius), "cut-values")
    result = found[0]
    for more in found[1:]:
        result = result.union(more)
    return stored(result.distinct(), "links")


def components(edges: DataFrame) -> DataFrame:
    """(node, star): the smallest node that is reachable, for all nodes that have a link.

    Alternating rounds: every node links its larger neighbours to the smallest of its
    neighbourhood, then its smaller ones.  Minima are aggregated before the shuffle.
    """
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        own, other = F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.select(F.explode(F.array(own, other)).alias("e"))
        edges = stored(small.select("e.*").where("u <> v").distinct(), "stars")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            centres = edges.select(F.col("v").alias("node"), F.col("v").alias("star")).distinct()
            return edges.select(F.col("u").alias("node"), F.col("v").alias("star")).union(centres)
        before = state


def groups(prints: DataFrame, radius: int = RADIUS, limit: int = LIMIT) -> DataFrame:
    """(fp, star): distinct fingerprints with one fingerprint of their component."""
    nodes = stored(prints.select("fp").distinct(), "fingerprints")
    found = components(links(nodes, radius, limit))
    return nodes.join(found, nodes.fp == found.node, "left").select("fp", F.coalesce("star", "fp").alias("star"))


def near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", radius: int = RADIUS, limit: int = LIMIT
) -> DataFrame:
    """(doc_id, fp, component_id) of every row."""
    prints = with_fingerprint(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text")), "_text")
    prints = stored(prints.select("doc_id", "fp"), "document-fingerprints")
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("id"))
    stars = groups(prints, radius, limit).join(least, "fp")
    named = stars.groupBy("star").agg(F.min("id").alias("component_id"))
    named = stars.join(named, "star").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", radius: int = RADIUS, limit: int = LIMIT
) -> DataFrame:
    """One row of each group of near duplicates: that of the smallest id, NULL being the largest.

    Equal ids go by fingerprint, and of rows that have both in common any one stays.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(
        F.struct(*columns).alias("_row"), F.col(text).alias("_text"), F.coalesce(F.col(doc_id), F.lit(NO_ID)).alias("id")
    )
    rows = with_fingerprint(rows, "_text").drop("_text")
    prints = stored(rows.groupBy("fp", "id").agg(F.count("*").alias("n")), "document-fingerprints")
    stars = groups(prints, radius, limit)
    least = prints.groupBy("fp").agg(F.min("id").alias("id"))
    first = stars.join(least, "fp").groupBy("star").agg(F.min(F.struct("id", "fp")).alias("first"))
    named = stars.join(first, "star").select("fp", "first")
    judged = prints.join(named, "fp")
    stays = (F.col("id") == F.col("first")["id"]) & (F.col("fp") == F.col("first")["fp"])
    judged = stored(judged.select("fp", "id", "n", stays.alias("stays")), "near-duplicates")
    kept = rows.join(judged.where("not stays").select("fp", "id"), ["fp", "id"], "left_anti")
    again = judged.where("stays and n > 1").select("fp", "id")
    if not again.isEmpty():
        once = kept.join(again, ["fp", "id"], "left_anti")
        kept = once.unionByName(kept.join(again, ["fp", "id"], "left_semi").dropDuplicates(["fp", "id"]))
    return kept.select("_row.*")
