"""Batches of a stream merged while it writes and while others read: each row once."""

import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from siltline.streaming import merges


def batch(spark, path, n, rows=10):
    """What a stream writes for a batch."""
    ids = spark.range(n * 1000, n * 1000 + rows).withColumn("text", F.lit("x"))
    ids.write.mode("overwrite").parquet(f"{path}/batch_id={n}")


def read(spark, path, merged):
    return sorted((r.batch_id, r.id) for r in merges.read_merged(spark, path, merged).collect())


def rows(*batches):
    return [(n, n * 1000 + i) for n in batches for i in range(10)]


@pytest.fixture
def places(path):
    return f"{path}/told", f"{path}/merged"


def test_only_closed_batches_are_merged(spark, places):
    with pytest.raises(ValueError):
        read(spark, *places)
    batch(spark, places[0], 0)
    assert merges.merge_closed(spark, *places) == merges.FIRST and not os.path.exists(places[1])
    for n in (1, 2, 3):
        batch(spark, places[0], n)
    assert merges.merge_closed(spark, *places) == 2 == merges.merge_closed(spark, *places)
    assert read(spark, *places) == rows(0, 1, 2, 3)
    batch(spark, places[0], 3)  # the last one is written again
    assert read(spark, *places) == rows(0, 1, 2, 3)
    assert merges.discard_merged(spark, *places) == 3 and merges.discard_merged(spark, *places) == 0
    assert sorted(x for x in os.listdir(places[0])) == ["batch_id=3"] and read(spark, *places) == rows(0, 1, 2, 3)
    batch(spark, places[0], 4, 0)
    batch(spark, places[0], 5)
    assert merges.merge_closed(spark, *places) == 4
    assert [upto for upto, _ in merges.merges(spark, places[1])] == [2, 4]
    assert read(spark, *places) == rows(0, 1, 2, 3, 5)


def test_small_files_become_one(spark, places):
    for n in range(12):
        batch(spark, places[0], n)
    merges.merge_closed(spark, *places)
    assert len(spark.read.parquet(merges.merges(spark, places[1])[0][1]).inputFiles()) == 1


def test_unfinished_batches_and_merges_are_not_read(spark, places):
    for n in range(4):
        batch(spark, places[0], n)
    os.remove(f"{places[0]}/batch_id=3/_SUCCESS")
    spark.range(5).write.parquet(f"{places[1]}/after=-1/upto=2/died")
    os.remove(f"{places[1]}/after=-1/upto=2/died/_SUCCESS")
    assert merges.boundary(spark, places[1]) == merges.FIRST and read(spark, *places) == rows(0, 1, 2)
    assert merges.merge_closed(spark, *places) == 2 and read(spark, *places) == rows(0, 1, 2)


def test_merges_that_overlap(spark, places):
    """Whatever runs at a time, the boundary only grows and rows are read once."""
    for n in range(9):
        batch(spark, places[0], n)
    borders = []
    for after, upto in ((-1, 3), (3, 6), (-1, 5), (-1, 3), (5, 7), (4, 8)):
        part = merges._batches(spark, places[0], list(range(after + 1, upto + 1)))
        part.write.parquet(f"{places[1]}/after={after}/upto={upto}/run{len(borders)}")
        borders.append(merges.boundary(spark, places[1]))
        assert read(spark, *places) == rows(*range(9))
    assert borders == [3, 6, 6, 6, 7, 7]
    merges.discard_merged(spark, *places)
    assert read(spark, *places) == rows(*range(9))


def test_reader_beside_writer_and_merges(spark, places):
    """A reader always finds the first so many batches, each row once."""
    batch(spark, places[0], 0)
    failed, ended = [], threading.Event()

    def write():
        try:
            for n in range(1, 13):
                batch(spark, places[0], n)
        finally:
            ended.set()

    def merge():
        try:
            while not ended.is_set():
                merges.merge_closed(spark, *places)
                time.sleep(0.2)
        except Exception as error:  # told below
            failed.append(error)

    threads = [threading.Thread(target=f) for f in (write, merge)]
    for t in threads:
        t.start()
    seen = []
    while not ended.is_set():
        got = read(spark, *places)
        last = got[-1][0]
        assert got == rows(*range(last + 1)) and last >= (seen[-1] if seen else 0)
        seen.append(last)
    for t in threads:
        t.join()
    assert not failed and len(seen) > 2
    merges.merge_closed(spark, *places)
    assert read(spark, *places) == rows(*range(13)) and merges.boundary(spark, places[1]) == 11
