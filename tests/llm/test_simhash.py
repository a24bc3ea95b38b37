import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltline.llm import simhash
from tests.llm import brute


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_table_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").where("length(text) < 4000")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute.near_duplicates(rows)
    found = simhash.near_duplicates(docs).withColumn("hex", simhash.hexadecimal(F.col("fp"))).collect()
    assert {r.doc_id: (int(r.hex, 16), r.component_id) for r in found} == want


@pytest.mark.parametrize("limit", [4096, 3])
def test_groups_of_near_fingerprints(spark, limit):
    r = random.Random(limit)
    prints = {0}
    for _ in range(6):  # chains and clouds, also over the sign bit
        x = r.getrandbits(64)
        for _ in range(25):
            prints.add(x)
            y = x
            for _ in range(r.randint(1, 4)):
                y ^= 1 << r.choice([0, 1, 2, 3, 5, 8, 13, 21, 34, 55, 62, 63])
            x = y if r.random() < 0.6 else x
    prints |= {r.getrandbits(64) for _ in range(60)}
    df = spark.createDataFrame([(signed(x),) for x in prints], "fp long").repartition(3)
    got = {row.fp: row.star for row in simhash.groups(df, limit=limit).collect()}
    want = brute.components(prints)
    assert set(got) == {signed(x) for x in prints}
    named = {}
    for x in prints:
        named.setdefault(got[signed(x)], set()).add(want[x])
    assert all(len(v) == 1 for v in named.values()) and len(named) == len(set(want.values()))


def test_large_radius_uses_near_values(spark):
    # Two parts with thresholds above zero, as chosen for very many fingerprints.
    r = random.Random(5)
    prints = {r.getrandbits(64) for _ in range(50)}
    prints |= {x ^ 1 << r.randrange(64) ^ 1 << r.randrange(64) for x in prints}
    df = spark.createDataFrame([(signed(x),) for x in prints], "fp long")
    plan = [(list(range(0, 32)), 1), (list(range(32, 64)), 1)]
    rows = simhash._under_values(df, plan).groupBy("value").agg(F.collect_list("fp").alias("fps"), F.collect_list("own").alias("owns"))
    pairs = rows.select("fps", "owns").mapInPandas(simhash._linked(3), "a long, b long").distinct()
    got = {tuple(x) for x in pairs.collect()}
    for a, b in itertools.combinations(prints, 2):
        linked = tuple(sorted((signed(a), signed(b)))) in got
        assert linked == ((a ^ b).bit_count() <= 3)


def test_thresholds_are_the_best():
    r = random.Random(3)
    for _ in range(50):
        m = r.randint(1, 4)
        costs = [[r.random() for _ in range(5)] for _ in range(m)]
        total = 3 - m + 1
        best = min(
            (sum(costs[i][t + 1] for i, t in enumerate(ts)), ts)
            for ts in itertools.product(range(-1, 4), repeat=m) if sum(ts) == total
        )
        cost, chosen = simhash.thresholds(costs, total)
        assert abs(cost - best[0]) < 1e-12 and tuple(chosen) == best[1]


def test_parts_keep_correlated_bits_together_and_cover_all():
    r = np.random.default_rng(1)
    base = r.integers(0, 2, (400, 16))
    bits = np.concatenate([base] * 4, axis=1)[:, r.permutation(64)]
    parts = simhash.parts_of(np.corrcoef(bits.T), 4)
    assert sorted(itertools.chain(*parts)) == list(range(64)) and {len(p) for p in parts} == {16}
    n, ones, c = 10**6, bits.mean(axis=0), np.corrcoef(bits.T)
    plan = simhash.allocate(n, ones, c)
    # General pigeonhole: whatever 3 bits differ, some part differs in its threshold at most.
    for flips in itertools.combinations(range(0, 64, 3), 3):
        assert any(sum(b in part for b in flips) <= t for part, t in plan)


def test_edge_cases(spark):
    rows = [(5, None), (7, ""), (9, "\t \n"), (2, "one"), (3, "one two"), (8, "ONE"), (2, "one"), (None, "one"), (4, "x " * 30000)]
    docs = spark.createDataFrame([(d, t, "a", 1) for d, t in rows], "doc_id long, text string, fp string, id int")
    got = {(r.doc_id, r.fp): r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert got[5, 0] == got[7, 0] == got[9, 0] == 5
    one = signed(brute.fingerprint("one"))
    assert got[2, one] == got[8, one] == got[None, one] == 2
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(2, "one"), (3, "one two"), (4, "x " * 30000), (5, None)]
    nulls = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (None, "e f g h")], "doc_id long, text string")
    assert sorted(r.text for r in simhash.keep_one(nulls).collect()) == ["a b c d", "e f g h"]
    assert simhash.near_duplicates(docs.where("false")).count() == 0
    assert simhash.keep_one(docs.where("false")).count() == 0
