"""Interleaved layouts: the same rows, and lookups that read few of them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from siltline.sinks import interleaved, layouts

ROWS = 200_000


def scanned(df):
    """Rows of the result, and rows that the scan read for it."""
    n = len(df.collect())
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return n, leaf.metrics().apply("numOutputRows").value()


def made(spark, n=ROWS):
    """Two columns that do not go together and a third of the rows on one key."""
    return spark.range(n).select(
        "id",
        F.when(F.col("id") % 3 == 0, 77).otherwise(F.pmod(F.xxhash64("id"), F.lit(10_000))).cast("bigint").alias("a"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10_000)).cast("int").alias("b"),
        F.md5(F.col("id").cast("string")).alias("c"),
    )


def test_numbers_of_ranges(spark):
    values = [None, -5, 0, 1, 1, 2, 9, 10, 99]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    borders = [0, 1, 9, 10, 50]
    got = df.select("v", interleaved.range_number(F.col("v"), borders, 3).alias("n")).collect()
    assert all(r.n == (0 if r.v is None else sum(b < r.v for b in borders)) for r in got)
    assert df.select(interleaved.range_number(F.col("v"), [], 3).alias("n")).distinct().collect() == [(0,)]


def test_bits_in_turn(spark):
    df = spark.range(64).select((F.col("id") / 8).cast("int").alias("x"), (F.col("id") % 8).cast("int").alias("y"))
    for r in df.select("x", "y", interleaved.interleave([F.col("x"), F.col("y")], 3).alias("z")).collect():
        assert r.z == int("".join(a + b for a, b in zip(f"{r.x:03b}", f"{r.y:03b}")), 2)
    with pytest.raises(ValueError):
        interleaved.interleave([F.col("x")] * 8)


def test_lookups_on_both_columns_skip(spark, path):
    df = made(spark)
    df.repartition(8, "id").write.parquet(path + "/plain")
    layouts.write_clustered(spark.read.parquet(path + "/plain"), path + "/sorted", ["a", "b"], ["id"])
    source = spark.read.parquet(path + "/plain")
    interleaved.write_interleaved(
        source, path + "/z", ["a", "b"], ["id"], {"c": 10_000}, row_group_bytes=256 * 1024
    )
    z, by_a, plain = (spark.read.parquet(f"{path}/{x}") for x in ("z", "sorted", "plain"))
    assert z.schema == plain.schema and z.exceptAll(plain).isEmpty() and z.count() == ROWS
    texts = [r.c for r in plain.where("id in (5, 500, 50000)").collect()]
    for column, values, share in (("a", [1234], 0.25), ("b", [4321], 0.25), ("c", texts, 0.2)):
        want = plain.filter(F.col(column).isin(values)).count()
        n, read = scanned(interleaved.rows_with_values(z, column, values))
        assert n == want and read < share * ROWS, (column, n, read)
    # Sorted by (a, b) only the first of them skips: a value of b is in the range of every file.
    assert scanned(interleaved.rows_with_values(by_a, "b", [4321]))[1] > 0.4 * ROWS
    # The frequent key is in more than one file.
    name = F.col("_metadata.file_path")
    assert z.where("a = 77").select(name).distinct().count() > 1


def test_edges(spark, path):
    day = dt.date(2024, 1, 1)
    rows = [(None, None, None), (1.5, day, None), (float("nan"), day, dt.datetime(2024, 1, 1)), (1.5, day, None)]
    df = spark.createDataFrame(rows, "x double, d date, t timestamp_ntz")
    for k, some in enumerate((df, df.limit(0), df.where("x is null"))):
        interleaved.write_interleaved(some, f"{path}/{k}", ["x", "d", "t"])
        got = spark.read.schema(df.schema).parquet(f"{path}/{k}")
        assert sorted(map(str, got.collect())) == sorted(map(str, some.collect()))
    with pytest.raises(ValueError):
        interleaved.write_interleaved(made(spark, 10), path + "/text", ["c"])


def test_few_and_many_values(spark):
    df = made(spark, 5_000)
    for values in ([], [None], [77, None, 77], list(range(2 * interleaved.MOST_VALUES))):
        want = [v for v in values if v is not None]
        got = interleaved.rows_with_values(df, "b", values)
        assert got.count() == df.filter(F.col("b").isin(want)).count() and got.columns == df.columns
