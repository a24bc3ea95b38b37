import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from siltline.operators import history as H
from siltline.operators import runstats
from tests.plan import plan

T0 = dt.datetime(2025, 1, 1)
SCHEMA = "entity string, seq bigint, time timestamp_ntz, a double, b string"


def sparse(n=3000, seed=7):
    """One entity holds about a third of the rows; some keys are NULL."""
    rnd = random.Random(seed)
    names = ["hot"] * 10 + [f"e{i}" for i in range(19)] + [None]
    rows = []
    for seq in rnd.sample(range(10 * n), n):
        rows.append((
            rnd.choice(names), seq, T0 + dt.timedelta(seconds=seq // 4),
            rnd.random() if rnd.random() < 0.3 else None,
            f"v{seq}" if rnd.random() < 0.05 else None,
        ))
    return rows


@pytest.fixture(scope="module")
def data():
    return sparse()


@pytest.fixture(scope="module")
def df(spark, data):
    return spark.createDataFrame(data, SCHEMA).repartition(8)


def filled(data):
    state, out = {}, []
    for entity, seq, time, a, b in sorted(data, key=lambda r: r[1]):
        last = state.setdefault(entity, [None, None])
        last[0] = a if a is not None else last[0]
        last[1] = b if b is not None else last[1]
        out.append((entity, seq, time, *last))
    return sorted(out, key=lambda r: r[1])


@pytest.mark.parametrize("rows_per_chunk", [10_000, 1_500, 200, 7])
def test_forward_fill_in_any_chunks(df, data, rows_per_chunk):
    got = H.forward_fill(df, ["entity"], "seq", ["a", "b"], rows_per_chunk)
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == filled(data)


def test_forward_fill_of_nothing(df):
    assert H.forward_fill(df.limit(0), ["entity"], "seq", ["a"]).count() == 0


def test_forward_fill_splits_a_hot_entity(df):
    text = plan(H.forward_fill(df, ["entity"], "seq", ["a"], 150))
    assert "_chunk" in text and "_chunk" not in plan(H.forward_fill(df, ["entity"], "seq", ["a"], 2000))
    chunked = H._with_chunk(df, "seq", df.count(), 20)
    sizes = chunked.groupBy("entity", "_chunk").count().agg(F.max("count")).first()[0]
    assert sizes < 150  # of about 1,000 rows of the entity


@pytest.mark.parametrize("n", [1, 5, 100, 5000])
@pytest.mark.parametrize("salts", [None, 3, 256])
def test_last_n(df, data, n, salts):
    got = H.last_n(df, ["entity"], ["time", "seq"], n, salts)
    per_entity = {}
    for row in sorted(data, key=lambda r: (r[2], r[1]), reverse=True):
        per_entity.setdefault(row[0], []).append(row)
    want = [row for rows in per_entity.values() for row in rows[:n]]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == sorted(want, key=lambda r: r[1])


def test_last_n_limits_rows_before_the_first_shuffle(df):
    assert plan(H.last_n(df, ["entity"], ["time", "seq"], 10)).count("WindowGroupLimit") == 2
    assert plan(H.last_n(df, ["entity"], ["time", "seq"], 100)).count("WindowGroupLimit") == 4


def test_range_is_closed_and_may_be_open(df, data):
    times = sorted(r[2] for r in data)
    lo, hi = times[500], times[2000]
    both = H.in_range(df, "time", F.lit(lo), F.lit(hi)).count()
    assert both == sum(lo <= t <= hi for t in times)
    assert H.in_range(df, "time", F.lit(lo)).count() == sum(t >= lo for t in times)
    assert H.in_range(df, "time", None, F.lit(hi)).count() == sum(t <= hi for t in times)
    assert H.in_range(df, "time").count() == len(data)


def test_page_is_newest_first(df, data):
    got = [r.seq for r in H.latest_page(df, "time", "seq", 20).collect()]
    assert got == [r[1] for r in sorted(data, key=lambda r: (r[2], r[1]), reverse=True)[:20]]
    assert "TakeOrderedAndProject" in plan(H.latest_page(df, "time", "seq", 20))


def test_series_of_one_entity(df, data):
    got = H.attribute_series(df, F.col("entity") == "hot", "time", "seq", F.col("a"), "CO").collect()
    want = sorted((r for r in data if r[0] == "hot"), key=lambda r: r[1])
    assert [(r.time, r.CO) for r in got] == [(r[2], r[3]) for r in want]


def test_entity_history_bounds(df, data):
    hot = sorted(r[1] for r in data if r[0] == "hot")
    one = F.col("entity") == "hot"

    def seqs(**args):
        return [r.seq for r in H.entity_history(df, one, "time", "seq", **args).collect()]

    assert seqs() == hot
    assert seqs(last=10) == hot[-10:]
    assert seqs(limit=3) == hot[-3:]
    assert seqs(last=10, limit=4) == hot[-4:]
    assert seqs(last=10**6) == hot


def test_run_statistics(spark):
    runs = spark.createDataFrame(
        [("q1", "x", 1.0), ("q1", "x", 3.0), ("q1", "y", 2.0), ("q2", "x", None), ("q2", "y", 5.0),
         ("q3", "x", None)],
        "analysis string, method string, seconds double",
    )
    stats = runstats.run_stats(runs)
    cells = {(r.analysis, r.method): (r.avg_time_seconds, r.std_dev_seconds, r.n_runs) for r in stats.collect()}
    assert cells == {
        ("q1", "x"): (2.0, 1.414214, 2), ("q1", "y"): (2.0, 0.0, 1),
        ("q2", "x"): (None, None, 1), ("q2", "y"): (5.0, 0.0, 1), ("q3", "x"): (None, None, 1),
    }
    assert sorted(map(tuple, runstats.fastest(stats).collect())) == [("q1", "x", 2.0), ("q2", "y", 5.0)]
    assert sorted(map(tuple, runstats.method_totals(stats).collect())) == [
        ("x", 2.0, 2.0), ("y", 3.5, 7.0),
    ]
    with pytest.raises(ValueError):
        runstats.pivot_methods(stats, ["x"])
    assert runstats.pivot_methods(stats).columns == ["analysis", "x", "y"]
    pivot = runstats.pivot_methods(stats, ["x", "y"])
    assert sorted(map(tuple, pivot.collect())) == [("q1", 2.0, 2.0), ("q2", None, 5.0), ("q3", None, None)]


@pytest.mark.parametrize("n", [0, 1, 40, 600, 100_000])
@pytest.mark.parametrize("unit", ["minute", "hour", "year"])
def test_last_n_by_bucket(df, data, n, unit):
    """Also with NULL times, which are the oldest."""
    rows = [*data, *[("hot", 10**6 + k, None, 0.5, None) for k in range(30)], ("old", 10**7, None, None, None)]
    more = df.sparkSession.createDataFrame(rows, SCHEMA).repartition(5)
    got = H.last_n_by_bucket(more, ["entity"], ["time", "seq"], n, F.date_trunc(unit, "time"))
    per_entity = {}
    for row in sorted(rows, key=lambda r: (r[2] or dt.datetime.min, r[1]), reverse=True):
        per_entity.setdefault(row[0], []).append(row)
    want = [row for some in per_entity.values() for row in some[:n]]
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == sorted(want, key=lambda r: r[1])


def test_only_rows_of_one_bucket_are_ranked(spark, path):
    """A third of 300,000 rows is of one entity; its newest 50,000 are asked for."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("e"), F.col("id") % 1000))
    time = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id"))
    spark.range(0, 300_000, 1, 6).select("id", key.alias("entity"), time.alias("time")).write.parquet(path + "/t")
    rows = spark.read.parquet(path + "/t")
    got = H.last_n_by_bucket(rows, ["entity"], ["time", "id"], 50_000, F.date_trunc("minute", "time"))
    assert got.filter("entity = 'hot'").agg(F.count("*"), F.min("id")).first()[:] == (50_000, 150_000)
    assert got.filter("entity <> 'hot'").count() == 200_000
    text = plan(got)
    assert text.count("Window ") == 1 and "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        again = H.last_n_by_bucket(rows, ["entity"], ["time", "id"], 50_000, F.date_trunc("minute", "time"))
        assert plan(again).count("Exchange hashpartitioning") == 1
        ranked = again._jdf.queryExecution().optimizedPlan().children().apply(1).children().head()
        assert "_rank" in ranked.toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", True)


def test_chunks_without_a_sample(df, data, monkeypatch):
    """Where no row falls into the sample, all rows are one chunk."""
    monkeypatch.setattr(H, "CUT_SAMPLE", 1e-9)
    chunked = H._with_chunk(df, "seq", len(data), 2)
    assert {r[0] for r in chunked.select("_chunk").distinct().collect()} == {0.0}
    got = H.forward_fill(df, ["entity"], "seq", ["a", "b"], 1_500)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == filled(data)


def test_many_chunks_are_cut_by_rank(spark, df, data, monkeypatch):
    """More chunks than a sketch holds borders: exact sizes, and no borders in one task or the driver."""
    monkeypatch.setattr(H, "MOST_CUTS", 5)
    monkeypatch.setattr(H, "_with_chunk", None)
    rows = df.withColumnRenamed("time", "position")  # a name that numbering uses as well
    got = H.forward_fill(rows, ["entity"], "seq", ["a", "b"], 20)
    assert got.columns == rows.columns
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == filled(data)
    sizes = H._with_rank_chunk(df, ["entity"], "seq", 20).groupBy("_chunk").agg(F.count("*"), F.min("seq"), F.max("seq"))
    sizes = sorted(map(tuple, sizes.collect()))
    assert [n for _, n, *_ in sizes] == [20] * (len(data) // 20)
    assert all(a[3] < b[2] for a, b in zip(sizes, sizes[1:]))
