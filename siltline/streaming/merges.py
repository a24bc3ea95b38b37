"""Many small batches of a stream merged into few files while the stream goes on writing.

``feeds.start_changes`` writes a folder for each batch.  A batch is closed once a later one has
begun: Spark begins a batch only when the one before is committed, and only the batch that is not
committed may be written again.  Merging takes closed batches alone, so it never meets the writer.

A merge of the batches above L up to H is a folder of its own in ``after=L/upto=H`` and counts once
it is finished.  Readers and writers agree on the boundary: the greatest H that finished merges reach one
after another from the first batch on.  It only grows, whatever merges run at a time, die or overlap;
a merge that is not part of the way to the boundary is not read.  A reader takes the merges up to the
boundary and the finished batches above it, and looks at the boundary again when it has its list of
files: if it has moved meanwhile, the list is made anew.  So each row is read once, also while merges
and ``discard_merged`` run.  Only a list that was made before a discard loses its files, and Spark
ends such a query with an error.

The folders of a stream belong to one checkpoint; one that is started anew needs a new folder.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltline.sinks import layouts

FIRST = -1  # the boundary before the first batch


def _names(spark: SparkSession, path: str) -> list[str]:
    place, system = layouts.hadoop_path(spark, path)
    return [status.getPath().getName() for status in system.listStatus(place)] if system.exists(place) else []


def _numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers of the folders ``name=number`` below a path."""
    start = f"{name}="
    return sorted(int(x.removeprefix(start)) for x in _names(spark, path) if x.startswith(start))


def merges(spark: SparkSession, merged: str) -> list[tuple[int, str]]:
    """(upto, folder) of the finished merges that lead to the boundary, in order."""
    found = []
    for after in _numbers(spark, merged, "after"):
        for upto in _numbers(spark, f"{merged}/after={after}", "upto"):
            place = f"{merged}/after={after}/upto={upto}"
            runs = [f"{place}/{name}" for name in sorted(_names(spark, place))]
            found += [(upto, after, run) for run in runs if layouts.finished(spark, run)]
    ways: dict[int, list[tuple[int, str]]] = {FIRST: []}
    for upto, after, run in sorted(found):
        if after in ways:
            ways.setdefault(upto, [*ways[after], (upto, run)])
    return ways[max(ways)]


def boundary(spark: SparkSession, merged: str) -> int:
    """The last batch that merges contain; all before it are in them as well."""
    return max([FIRST, *[upto for upto, _ in merges(spark, merged)]])


def _batches(spark: SparkSession, path: str, numbers: list[int]) -> DataFrame:
    """The rows of some batches, with ``batch_id``.  Their columns are the same by their origin."""
    paths = [f"{path}/batch_id={n}" for n in numbers]
    rows = spark.read.option("basePath", path).parquet(*paths)
    return rows.withColumn("batch_id", F.col("batch_id").cast("bigint"))


def merge_closed(
    spark: SparkSession, path: str, merged: str, target_bytes: int = layouts.TARGET_FILE_BYTES
) -> int:
    """Merge the closed batches above the boundary, and give the boundary there is then.

    Whole files are packed by Spark's scan up to the target, and nothing is shuffled.  Without a
    newly closed batch nothing is written.  Run it as often as you like, beside the stream too; the
    batches stay until ``discard_merged``.
    """
    while True:
        after = boundary(spark, merged)
        numbers = [n for n in _numbers(spark, path, "batch_id") if n > after]
        closed = numbers[:-1]
        if not closed:
            return after
        rows = _batches(layouts.packing_session(spark, target_bytes), path, closed)
        if boundary(spark, merged) == after:  # none of the listed files was discarded before it was listed
            break
    rows.write.parquet(f"{merged}/after={after}/upto={closed[-1]}/{uuid.uuid4().hex}")
    return boundary(spark, merged)


def read_merged(spark: SparkSession, path: str, merged: str) -> DataFrame:
    """All rows of the finished batches, each once, with their ``batch_id``."""
    while True:
        done = merges(spark, merged)
        after = max([FIRST, *[upto for upto, _ in done]])
        batches = [n for n in _numbers(spark, path, "batch_id") if n > after]
        batches = [n for n in batches if layouts.finished(spark, f"{path}/batch_id={n}")]
        parts = [spark.read.parquet(folder) for _, folder in done]
        if batches:
            parts.append(_batches(spark, path, batches))
        if not parts:
            raise ValueError(f"no batch has been finished in {path}")
        rows = reduce(DataFrame.unionByName, parts)
        if boundary(spark, merged) == after:
            return rows


def discard_merged(spark: SparkSession, path: str, merged: str) -> int:
    """Delete the batches that merges contain, and give their number.

    Queries whose list of files was made before it end with an error, so leave them time.
    """
    after = boundary(spark, merged)
    old = [n for n in _numbers(spark, path, "batch_id") if n <= after]
    for n in old:  # a folder per batch
        place, system = layouts.hadoop_path(spark, f"{path}/batch_id={n}")
        system.delete(place, True)
    return len(old)
