"""Table layouts.

Writers that group rows by a value never send all rows of one value to one task:
partitioned writes go through Spark's rebalance (adaptive execution splits what is
too large), clustered writes range-partition on a unique last key.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltline.sources import files

TARGET_FILE_BYTES = 512 * 1024 * 1024
# Input bytes per range of a clustered write.
RANGE_BYTES = 256 * 1024 * 1024
# Table of the files that are compacted, beside the compacted ones.
COMPACTED = "_compacted"
_COMPACTED_TYPES = "run string, path string, length bigint"


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` has come to its end."""
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def write_if_absent(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write unless a finished output is there already; an unfinished one is written anew."""
    if not finished(df.sparkSession, path):
        df.write.mode("overwrite").format(fmt).save(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], fmt: str = "parquet") -> None:
    """Overwrite ``path`` with one directory per value of ``by``.

    Small values share a task and get one file each; a value that holds much of the
    table is split over several tasks and files.
    """
    df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).format(fmt).save(path)


def write_clustered(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    unique: Sequence[str] = (),
    source_bytes: int = 0,
) -> None:
    """Overwrite ``path`` with files that are sorted by ``by`` within and among them.

    Row-group statistics then prune range scans on the leading column.  ``unique``
    breaks ties, so that one frequent value of ``by`` can span several files.  The
    session's shuffle partitions are used unless ``source_bytes`` asks for more.
    """
    order = [*by, *[c for c in unique if c not in by]]
    wanted = -(-source_bytes // RANGE_BYTES)
    if wanted > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        ranged = df.repartitionByRange(wanted, *order)
    else:
        ranged = df.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def land_raw(
    spark: SparkSession, source: str, raw_root: str, name: str, fmt: str = "parquet", merge: bool = False
) -> str:
    """Bring the rows of all source files to ``raw_root/name``, unchanged and unshuffled."""
    target = f"{raw_root}/{name}"
    files.scan_tree(spark, source, fmt=fmt, merge=merge).write.mode("overwrite").parquet(target)
    return target


def append_chunked(df: DataFrame, path: str, rows_per_file: int | None = None) -> None:
    """Append in files of at most ``rows_per_file`` rows."""
    writer = df.write.mode("append")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)


def compact(
    spark: SparkSession,
    scan: DataFrame,
    source_bytes: int,
    path: str,
    overwrite: bool = False,
    target_bytes: int = TARGET_FILE_BYTES,
) -> DataFrame:
    """Rewrite many files as few large ones, without a shuffle.

    The scan already packs small files into one task; ``coalesce`` only joins tasks
    until a file reaches ``target_bytes``.
    """
    n_files = max(1, -(-source_bytes // target_bytes))
    if overwrite or not finished(spark, path):
        scan.coalesce(n_files).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def hadoop_path(spark: SparkSession, path: str):
    """A path and its file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _compacted(spark: SparkSession, path: str) -> DataFrame:
    place, system = hadoop_path(spark, f"{path}/{COMPACTED}")
    if not system.exists(place):
        return spark.createDataFrame([], _COMPACTED_TYPES)
    return spark.read.schema(_COMPACTED_TYPES).parquet(f"{path}/{COMPACTED}")


def packing_session(spark: SparkSession, target_bytes: int) -> SparkSession:
    """A session like this one whose scans put whole files into tasks of up to ``target_bytes``."""
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if session.conf.isModifiable(name):
            session.conf.set(name, value)
    session.conf.set("spark.sql.files.maxPartitionBytes", str(target_bytes))
    session.conf.set("spark.sql.files.openCostInBytes", "0")
    session.conf.set("spark.sql.files.minPartitionNum", "1")
    session.conf.unset("spark.sql.files.maxPartitionNum")
    return session


def compact_small(
    spark: SparkSession,
    root: str,
    path: str,
    target_bytes: int = TARGET_FILE_BYTES,
    fmt: str = "parquet",
    merge: bool = False,
) -> DataFrame:
    """Join the small files below ``root`` by size, and read all rows in as few files.

    Files of half the target or more stay where they are and are not read.  The others are packed
    by Spark's own scan, whole and the largest first, into tasks that write a file each: the sources
    of a file have the target at most, and all but the last more than half of it.  Nothing is
    shuffled.  What was compacted is entered in a table beside the new files when they are complete,
    so a run without new small files, or with less than half a target of them, writes nothing, and
    what a run that died left behind is not read.  Sources are not deleted; one that was entered and
    has another size now is refused.  ``path`` must not lie below ``root``.
    """
    inner, outer = (str(system.makeQualified(p)) for p, system in (hadoop_path(spark, x) for x in (path, root)))
    if f"{inner}/".startswith(f"{outer}/"):
        raise ValueError("the compacted files would be found among the sources")
    found = files.file_sizes(spark, root)
    entered = _compacted(spark, path)
    known = entered.select("path", F.col("length").alias("entered"))
    if not found.join(known, "path").where("length <> entered").isEmpty():
        raise ValueError("a source was changed after it was compacted")
    rest = found.join(known, "path", "left_anti").collect()  # a row per file
    small = sorted((r.path, r.length) for r in rest if 2 * r.length < target_bytes)
    if len(small) > 1 and 2 * sum(length for _, length in small) >= target_bytes:
        run = uuid.uuid4().hex
        session = packing_session(spark, target_bytes)
        scan = files.scan_files(session, [p for p, _ in small], fmt, merge)
        scan.write.format(fmt).save(f"{path}/{run}")
        done = spark.createDataFrame([(run, p, length) for p, length in small], _COMPACTED_TYPES)
        done.coalesce(1).write.mode("append").parquet(f"{path}/{COMPACTED}")
        taken = {p for p, _ in small}
        rest = [r for r in rest if r.path not in taken]
    runs = sorted(r.run for r in _compacted(spark, path).select("run").distinct().collect())
    new = [r.path for run in runs for r in files.file_sizes(spark, f"{path}/{run}").select("path").collect()]
    return files.scan_files(spark, sorted([*[r.path for r in rest], *new]), fmt, merge)


def compaction_report(scan: DataFrame) -> DataFrame:
    """Rows of each input file, and of all of them under a NULL path."""
    return (
        scan.select(files.file_path().alias("path"))
        .rollup("path")
        .agg(F.count("*").alias("n_rows"))
    )
