"""Surrogate keys, key samples and key-set lookups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from siltline import scratch
from siltline.sinks.layouts import write_clustered
from siltline.sources import files

# The offsets of the files are broadcast up to this size; a file takes about OFFSET_BYTES of it.
BROADCAST_BYTES = 512 * 1024 * 1024
OFFSET_BYTES = 400
# A key set is broadcast up to this size.
KEY_SET_BYTES = 8 * 1024 * 1024


def number_by_file(
    scan: DataFrame, name: str = "trip_id", first: int = 1, limit: int | None = None
) -> DataFrame:
    """Number the rows of a file scan ``first, first + 1, …`` by file name and position.

    Parquet stores the rows per file, and the scan gives each row its position, so
    no row is moved.  Only the running sum over files passes through one task: a row
    per file.  With ``limit``, files that start beyond it are not opened.  Part files
    are in the order of their number.  Anything but a scan is refused: its rows have
    gaps between their positions.
    """
    _require_scan(scan)
    before = Window.orderBy(files.file_order("path")).rowsBetween(Window.unboundedPreceding, -1)

    def offsets(rows: DataFrame) -> DataFrame:
        running = F.coalesce(F.sum("n_rows").over(before), F.lit(0))
        return files.rows_per_file(rows).select("path", running.alias("rows_before"))

    n_files = len(scan.inputFiles())
    if n_files > 1:
        if limit is not None:
            last = offsets(scan).filter(F.col("rows_before") < limit)
            last = last.agg(F.max(files.file_order("path"))).first()[0]
            scan = scan.filter(files.file_order(files.file_path()) <= F.lit(last))
        start = offsets(scan)
        if n_files * OFFSET_BYTES <= BROADCAST_BYTES:
            start = F.broadcast(start)
        rows = _with_position(scan).join(start, "path")
    else:
        rows = _with_position(scan).withColumn("rows_before", F.lit(0))
    number = F.col("rows_before") + F.col("position")
    if limit is not None:
        rows = rows.filter(number < limit)
    return rows.select((number + first).cast("bigint").alias(name), *scan.columns)


def number_files(
    scans: Sequence[DataFrame], name: str = "trip_id", first: int = 1, limit: int | None = None
) -> list[DataFrame]:
    """As ``number_by_file``, over the files of several scans together, whose columns may differ."""
    for scan in scans:
        _require_scan(scan)
    sizes = reduce(DataFrame.unionByName, [files.rows_per_file(scan) for scan in scans])
    before = Window.orderBy(files.file_order("path")).rowsBetween(Window.unboundedPreceding, -1)
    start = sizes.select("path", F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("rows_before"))
    if limit is not None:
        start = start.filter(F.col("rows_before") < limit)
        last = start.agg(F.max(files.file_order("path"))).first()[0]
        scans = [scan.filter(files.file_order(files.file_path()) <= F.lit(last)) for scan in scans]
    if sum(len(scan.inputFiles()) for scan in scans) * OFFSET_BYTES <= BROADCAST_BYTES:
        start = F.broadcast(start)
    numbered = []
    for scan in scans:
        rows = _with_position(scan).join(start, "path")
        number = F.col("rows_before") + F.col("position")
        rows = rows if limit is None else rows.filter(number < limit)
        numbered.append(rows.select((number + first).cast("bigint").alias(name), *scan.columns))
    return numbered


def _require_scan(scan: DataFrame) -> None:
    node = scan._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "SubqueryAlias"):
        node = node.child()
    if node.nodeName() != "LogicalRelation":
        raise ValueError(f"only the rows of a file scan can be numbered by position, not of {node.nodeName()}")


def _with_position(scan: DataFrame) -> DataFrame:
    return scan.select(
        "*", files.file_path().alias("path"), F.col("_metadata.row_index").alias("position")
    )


def number_by_key(
    spark: SparkSession,
    df: DataFrame,
    order: Sequence[str],
    name: str = "trip_id",
    first: int = 1,
    limit: int | None = None,
    source_bytes: int = 0,
) -> DataFrame:
    """Number rows in the order of a unique key, without a global sort in one task.

    The rows are written once, range-partitioned and sorted, and then numbered by
    file: part files are named in range order.  The written table also makes the
    numbers stable when a task is repeated.
    """
    path = scratch.new_path(spark, f"by-{name}")
    write_clustered(df, path, order, source_bytes=source_bytes)
    return number_by_file(spark.read.parquet(path), name, first, limit)


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()


def sample_keys(df: DataFrame, key: str, k: int = 50) -> DataFrame:
    """k distinct keys (all, if there are fewer), the same ones on every run."""
    return (
        distinct_keys(df, key).orderBy(F.md5(F.col(key).cast("string")), F.col(key)).limit(k)
    )


def count_in_key_set(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """How many rows of ``df`` have one of the keys; repeated keys count once.

    A key set of up to ``KEY_SET_BYTES`` by Spark's estimate is broadcast and the other rows dropped
    where they are read.  For a larger one rows are counted per key before the join, so a frequent
    key is one row there.
    """
    if int(keys.select(key)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= KEY_SET_BYTES:
        hits = df.select(key).join(F.broadcast(keys.select(key)), key, "left_semi")
        return hits.agg(F.count("*").alias("count"))
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    hits = counts.join(keys.select(key).distinct(), key, "left_semi")
    return hits.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("count"))
