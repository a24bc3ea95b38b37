"""Conversion of monthly files to another columnar format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from siltline.sources import files

# A table of the months that are converted, beside their directories.
DONE = "_converted"
MONTH = ("file_kind", "file_year", "file_month")
_MONTH_TYPES = "file_kind string, file_year int, file_month int"


def _month_of(path: Column) -> list[Column]:
    parts = (files.kind_in_path(path), files.year_in_path(path), files.month_in_path(path))
    return [part.alias(name) for part, name in zip(parts, MONTH)]


def _done(spark: SparkSession, target: str) -> DataFrame:
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{target}/{DONE}")
    if not root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(root):
        return spark.createDataFrame([], _MONTH_TYPES)
    return spark.read.schema(_MONTH_TYPES).parquet(f"{target}/{DONE}").distinct()


def convert_monthly(
    spark: SparkSession,
    source: str,
    target: str,
    fmt: str = "orc",
    overwrite: bool = False,
    merge: bool = False,
) -> DataFrame:
    """Rewrite the monthly files below ``source``, one directory per kind, year and month.

    A month is converted once: it is entered in a table beside the directories when it is
    complete, and what an earlier attempt left unfinished is replaced.  Each scan task
    writes the months it reads, so nothing is shuffled.  Files without a month in their
    name are refused.
    """
    found = files.file_sizes(spark, source).select("path", *_month_of(F.col("path")))
    if not found.where(F.col("file_month").isNull()).isEmpty():
        raise ValueError("a file has no month in its name")
    todo = found if overwrite else found.join(_done(spark, target), list(MONTH), "left_anti")
    paths = sorted(row.path for row in todo.select("path").collect())  # a row per monthly file
    if paths:
        scan = files.scan_files(spark, paths, merge=merge)
        rows = scan.select("*", *_month_of(files.file_path()))
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*MONTH).format(fmt).save(target)
        todo.select(*MONTH).distinct().coalesce(1).write.mode("append").parquet(f"{target}/{DONE}")
    return spark.read.format(fmt).load(target)


def conversion_report(
    spark: SparkSession, source: str, target: str, months: range = range(1, 13)
) -> DataFrame:
    """Per kind, year and expected month: converted or missing, bytes before and after, their ratio."""
    sizes = files.file_sizes(spark, source).select("length", *_month_of(F.col("path")))
    before = sizes.groupBy(*MONTH).agg(F.sum("length").alias("source_bytes"))
    written = files.file_sizes(spark, target).where(~F.col("path").contains(f"/{DONE}/"))
    place = [F.regexp_extract("path", f"{name}=([^/]+)/", 1).alias(name) for name in MONTH]
    written = written.select("length", *place).where("file_month <> ''")
    written = written.select("length", "file_kind", *[F.col(c).cast("int").alias(c) for c in MONTH[1:]])
    after = written.groupBy(*MONTH).agg(F.sum("length").alias("target_bytes"))
    after = after.join(_done(spark, target), list(MONTH), "left_semi")
    years = before.select("file_kind", "file_year").distinct()
    every = years.withColumn("file_month", F.explode(F.array(*[F.lit(m) for m in months])))
    return (
        every.join(before, list(MONTH), "left")
        .join(after, list(MONTH), "left")
        .select(
            F.col("file_kind").alias("kind"),
            F.col("file_year").alias("year"),
            F.col("file_month").alias("month"),
            F.when(F.col("target_bytes").isNotNull(), "converted").otherwise("missing").alias("status"),
            "source_bytes",
            "target_bytes",
            F.try_divide("target_bytes", "source_bytes").alias("ratio"),
        )
    )
