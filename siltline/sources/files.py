"""File scans.  One file, many files, a glob or a tree give the same rows."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

LOOKS = 16  # footers that are read at a time


def scan_file(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def _load(spark: SparkSession, paths, fmt: str, merge: bool, options: dict) -> DataFrame:
    """One scan over files, which must have the same columns unless they are to be merged.

    Spark takes the columns of many files from one of them and drops what others have more.
    The footers are therefore compared; with ``merge`` a scan has the columns of all files,
    NULL where a file lacks one.
    """
    scan = spark.read.format(fmt).options(**options).load(paths)
    if fmt not in ("parquet", "orc"):
        return scan
    merged = spark.read.format(fmt).options(**options).option("mergeSchema", True).load(paths)
    if merge:
        return merged
    lost = sorted(set(merged.columns) - set(scan.columns))
    if lost:
        raise ValueError(f"only some of the files have the columns {lost}; ask for them to be merged")
    return scan


def scan_files(
    spark: SparkSession, paths: Sequence[str], fmt: str = "parquet", merge: bool = False
) -> DataFrame:
    """One scan over an explicit list of files."""
    if not paths:
        raise ValueError("no files to scan")
    return _load(spark, list(paths), fmt, merge, {})


def scan_tree(
    spark: SparkSession,
    root: str,
    name_glob: str | None = None,
    fmt: str = "parquet",
    merge: bool = False,
) -> DataFrame:
    """Every file below ``root``, directory names ignored, optionally by file name."""
    options = {"recursiveFileLookup": "true"} | ({"pathGlobFilter": name_glob} if name_glob else {})
    return _load(spark, root, fmt, merge, options)


def scan_monthly(
    spark: SparkSession,
    root: str,
    kind: str,
    year: int | None = None,
    fmt: str = "parquet",
    merge: bool = False,
) -> DataFrame:
    """The monthly files of one kind, of one year or of all years.

    A directory of such a name, also as the partition ``file`` of a table, counts as a file.
    """
    months = f"{year}-*" if year else "*-*"
    return _load(spark, f"{root}/{{,file=}}{kind}_tripdata_{months}", fmt, merge, {})


def by_columns(
    spark: SparkSession, paths: Sequence[str], wanted: Sequence[str], fmt: str = "parquet"
) -> dict[tuple[tuple[str, str], ...], list[str]]:
    """The files by which of the wanted columns they have, and of which type.

    Only footers are read, by the executors; a file is a small job, ``LOOKS`` of which run at a time.
    """

    def present(path: str) -> tuple[tuple[str, str], ...]:
        schema = spark.read.format(fmt).load(path).schema
        return tuple((f.name, f.dataType.simpleString()) for f in schema if f.name in wanted)

    found: dict[tuple[tuple[str, str], ...], list[str]] = {}
    with ThreadPoolExecutor(LOOKS) as pool:
        for path, columns in zip(paths, pool.map(present, paths)):
            found.setdefault(columns, []).append(path)
    return found


def file_path() -> Column:
    return F.col("_metadata.file_path")


def file_order(path: Column | str) -> Column:
    """Text that sorts paths by directory, then number of a part file, then name."""
    number = F.lpad(F.regexp_extract(path, r"/part-(\d+)[^/]*$", 1), 12, "0")
    return F.concat(F.regexp_extract(path, "^(.*/)", 1), number, path)


def kind_in_path(path: Column) -> Column:
    """Kind of a monthly file; NULL where the name is no monthly file's."""
    text = F.regexp_extract(path, r"(?:^|/)(?:file=)?([^/=]+)_tripdata_\d{4}-\d{2}\.", 1)
    return F.when(text != "", text)


def year_in_path(path: Column) -> Column:
    text = F.regexp_extract(path, r"_tripdata_(\d{4})-\d{2}\.", 1)
    return F.when(text != "", text.cast("int"))


def month_in_path(path: Column) -> Column:
    """Month number a monthly file carries in its name; NULL without one."""
    text = F.regexp_extract(path, r"_tripdata_\d{4}-(\d{2})\.", 1)
    return F.when(text != "", text.cast("int"))


def rows_per_file(scan: DataFrame) -> DataFrame:
    """(path, n_rows) of a file scan.  Reads no columns, only the file footers."""
    return scan.groupBy(file_path().alias("path")).agg(F.count("*").alias("n_rows"))


def file_sizes(spark: SparkSession, root: str) -> DataFrame:
    """(path, length) of all data files below ``root``; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", "length")
    )


def total_bytes(spark: SparkSession, root: str) -> int:
    return file_sizes(spark, root).agg(F.sum("length")).first()[0] or 0


def scan_bytes(scan: DataFrame) -> int:
    """Size of the files of a file scan, as listed when it was planned."""
    return int(scan._jdf.queryExecution().analyzed().stats().sizeInBytes())
