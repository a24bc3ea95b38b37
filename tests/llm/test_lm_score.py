import math
import re
from collections import Counter

import pytest

from siltline.llm import lm_score


def brute(rows, order, least=2, backoff=0.4):
    docs = [[w for w in re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())] for _, t in rows]
    counts = Counter(tuple(d[i - k : i + 1]) for d in docs for i in range(len(d)) for k in range(order) if i >= k)
    total = sum(map(len, docs))
    out = []
    for (doc_id, _), d in zip(rows, docs):
        micro = backed = 0
        for i in range(len(d)):
            k, factor = min(order - 1, i), 1.0
            while k and counts[tuple(d[i - k : i + 1])] < least:
                k, backed = k - 1, backed + 1
                factor *= backoff
            gram = tuple(d[i - k : i + 1])
            s = factor * (counts[gram] / (counts[gram[:-1]] if k else total))
            micro += round(1_000_000 * math.log10(s))
        out.append((doc_id, len(d), backed, micro))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_equals_brute_force(spark, sf, order):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").where("doc_id < 200")
    rows = [tuple(r) for r in docs.collect()]
    got = {r.doc_id: tuple(r) for r in lm_score.score(docs, order=order, chunk_bytes=50_000).collect()}
    for want in brute(rows, order):
        assert got[want[0]][:3] == want[:3] and abs(got[want[0]][3] - want[3]) <= want[1]


def test_chunks_do_not_matter(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    one = sorted(map(tuple, lm_score.score(docs).collect()))
    many = sorted(map(tuple, lm_score.score(docs.repartition(5), chunk_bytes=100_000).collect()))
    assert one == many


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "a"), (4, "a b a b"), (4, "a b a b"), (None, "B a"), (5, " \t\n "), (6, "x " * 20_000), (7, "é漢 😀 é漢")]
    docs = spark.createDataFrame([(*r, "x", 0) for r in rows], "doc_id long, text string, chunk string, n_words int")
    key = lambda r: (r[0] is not None, *[x or 0 for x in r])
    for size in (1 << 20, 1000):
        got = sorted(map(tuple, lm_score.score(docs, chunk_bytes=size).collect()), key=key)
        assert got == sorted(brute(rows, 2), key=key)
    assert lm_score.score(docs.where("false")).count() == 0


def test_rows_that_repeat_are_one_in_their_chunk(spark, monkeypatch):
    rows = [(1, "a b c a b")] * 400 + [(None, "c a")] * 300 + [(2, "a b d"), (2, "a b d"), (3, None), (4, "d d c a")] + [(5, "")] * 200
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    most = []

    def scored(frame, *rest):
        most.append(max(r["count"] for r in frame.groupBy("doc_id", "text").count().collect()))
        return score(frame, *rest)

    score = lm_score._score
    monkeypatch.setattr(lm_score, "_score", scored)
    key = lambda r: (r[0] is not None, *[x or 0 for x in r])
    got = lm_score.score(docs, chunk_bytes=4000)
    assert got.columns == ["doc_id", "n_words", "n_backoff", "micro_log10"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute(rows, 2), key=key)
    assert most == [2]  # the small group stays as it is


def test_counts_beyond_32_bits():
    docs = lm_score.pd.DataFrame({"doc_id": [1, 2], "text": ["a b", "b"], "chunk": [0, 0], "times": [3 << 31, 0]})
    asked = lm_score._asked(2, 1)(docs)
    totals = lm_score.np.frombuffer(lm_score._answered(asked)["totals"][0], "<i8")
    assert sorted(totals.tolist()) == [3 << 31, 3 << 31, (3 << 31) + 1]
