import os

import pytest
from pyspark.sql import Window, functions as F

from siltline.operators import keys
from siltline.plans import star
from siltline.plans.inputs import table
from siltline.sources import files
from tests.plan import plan


def many_files(spark, path, n=1000, parts=7):
    spark.range(0, n, 1, parts).withColumnRenamed("id", "v").write.parquet(path)
    return spark.read.parquet(path)


def test_numbers_follow_files_and_positions(spark, path):
    scan = many_files(spark, path + "/t")
    assert len(scan.inputFiles()) == 7
    got = keys.number_by_file(scan, "n", first=1)
    assert got.columns == ["n", "v"]
    assert sorted((r.n, r.v) for r in got.collect()) == [(i + 1, i) for i in range(1000)]


def test_numbers_move_no_rows(spark, path):
    text = plan(keys.number_by_file(many_files(spark, path + "/t"), "n"))
    fact = text.split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in fact


def test_numbers_beyond_the_broadcast_limit(spark, path, monkeypatch):
    monkeypatch.setattr(keys, "BROADCAST_BYTES", 3)
    got = keys.number_by_file(many_files(spark, path + "/t"), "n")
    assert sorted((r.n, r.v) for r in got.collect()) == [(i + 1, i) for i in range(1000)]


def test_cap_takes_the_first_rows_and_skips_later_files(spark, path):
    scan = many_files(spark, path + "/t")
    for limit in (0, 1, 142, 143, 500, 999, 1000, 5000):
        got = keys.number_by_file(scan, "n", limit=limit)
        assert sorted(r.v for r in got.collect()) == list(range(min(limit, 1000)))


def test_number_by_key_equals_global_row_number(spark, sf):
    orders = table(spark, sf, "orders").repartition(9)
    order = ["o_orderdate", "o_orderkey"]
    got = keys.number_by_key(spark, orders, order, "n").select("n", "o_orderkey")
    want = orders.select(F.row_number().over(Window.orderBy(*order)).alias("n"), "o_orderkey")
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_number_by_key_with_a_cap(spark):
    rows = spark.range(0, 500, 1, 5).select((F.lit(499) - F.col("id")).alias("k"))
    got = keys.number_by_key(spark, rows, ["k"], "n", limit=10).collect()
    assert sorted((r.n, r.k) for r in got) == [(i + 1, i) for i in range(10)]


def test_sample_is_stable_and_takes_all_of_few(spark):
    rows = spark.range(0, 300, 1, 6).select((F.col("id") % 30).alias("k"))
    first = [r.k for r in keys.sample_keys(rows, "k", 10).collect()]
    again = [r.k for r in keys.sample_keys(rows.repartition(3), "k", 10).collect()]
    assert first == again and len(set(first)) == 10
    assert keys.sample_keys(rows, "k", 50).count() == 30


def test_key_set_count_takes_each_key_once(spark):
    rows = spark.range(0, 300, 1, 6).select((F.col("id") % 30).alias("k"))
    sample = keys.sample_keys(rows, "k", 10)
    assert keys.count_in_key_set(rows, "k", sample).first()[0] == 100
    assert keys.count_in_key_set(rows, "k", sample.union(sample)).first()[0] == 100
    assert keys.count_in_key_set(rows, "k", sample.filter("k < 0")).first()[0] == 0


def test_key_set_count_joins_counts(spark, sf):
    lines = table(spark, sf, "lineitem")
    text = plan(keys.count_in_key_set(lines, "l_partkey", keys.sample_keys(lines, "l_partkey")))
    assert "LeftSemi" in text and "ReadSchema: struct<l_partkey:bigint>" in text
    assert "partial_count" in text


def test_only_a_scan_is_numbered_by_position(spark, path):
    spark.range(100).write.parquet(path + "/t")
    scan = spark.read.parquet(path + "/t")
    assert keys.number_by_file(scan.select("id"), "n").count() == 100
    for rows in (scan.filter("id % 3 = 0"), scan.limit(5), spark.range(5)):
        with pytest.raises(ValueError):
            keys.number_by_file(rows, "n")


def test_part_files_are_in_the_order_of_their_number(spark):
    names = ["/a/part-99999-x.parquet", "/a/part-100000-x.parquet", "/a/part-2-x.parquet", "/b/part-00001", "/a/z.parquet"]
    rows = spark.createDataFrame([(n,) for n in names], "path string")
    got = [r.path for r in rows.orderBy(files.file_order("path")).collect()]
    assert got == ["/a/z.parquet", "/a/part-2-x.parquet", "/a/part-99999-x.parquet", "/a/part-100000-x.parquet", "/b/part-00001"]


def test_a_second_load_goes_on_counting(spark, path):
    spark.range(0, 10, 1, 2).write.parquet(path + "/t")
    scan = spark.read.parquet(path + "/t")
    star.load_capped(spark, scan, path + "/out", limit=7)
    rows = star.load_capped(spark, scan, path + "/out").select("trip_id").collect()
    assert sorted(r.trip_id for r in rows) == list(range(1, 18))


def test_star_fact_projects_renames_casts_and_caps(spark, path):
    raw = spark.range(0, 100, 1, 4).select(
        F.col("id").alias("VendorID"), F.col("id").alias("PULocationID"),
        F.lit(1.5).alias("total_amount"), F.lit("x").alias("unwanted"),
    )
    raw.write.parquet(path + "/raw")
    fact = star.star_fact(spark.read.parquet(path + "/raw"), limit=60)
    assert fact.dtypes == [
        ("trip_id", "bigint"), ("vendor_id", "int"), ("total_amount", "double"), ("pulocation_id", "int"),
    ]
    assert sorted(r.trip_id for r in fact.collect()) == list(range(1, 61))
    first = star.load_star_fact(spark, fact, path + "/fact", ("pulocation_id",)).collect()
    again = star.load_star_fact(spark, fact, path + "/fact2", ("pulocation_id",)).collect()
    assert sorted(first) == sorted(again)


def test_capped_load_writes_chunks(spark, path):
    scan = many_files(spark, path + "/t")
    loaded = star.load_capped(spark, scan, path + "/out", limit=300, chunk=50)
    assert loaded.count() == 300
    assert max(r.n_rows for r in files.rows_per_file(loaded).collect()) <= 50


def rows_of(df):
    return sorted(map(tuple, df.select("load", "trip_id", "id").collect()))


def test_a_load_may_run_again(spark, path):
    spark.range(0, 10, 1, 2).write.parquet(path + "/t")
    scan, out = spark.read.parquet(path + "/t"), path + "/out"
    assert rows_of(star.load_batch(spark, scan, out, "01", limit=7)) == [("01", k + 1, k) for k in range(7)]
    star.load_batch(spark, scan, out, "02", limit=0)
    whole = rows_of(star.load_batch(spark, scan, out, "03", chunk=3))
    assert whole == [*[("01", k + 1, k) for k in range(7)], *[("03", k + 8, k) for k in range(10)]]
    for name, limit in (("03", None), ("01", 7), ("02", 0)):
        assert rows_of(star.load_batch(spark, scan, out, name, limit)) == whole
    for name, limit in (("01", 8), ("01", 6), ("02", 1), ("00", 1)):
        with pytest.raises(ValueError):
            star.load_batch(spark, scan, out, name, limit)
    assert rows_of(star.read_loads(spark, out)) == whole
    with pytest.raises(ValueError):
        star.load_batch(spark, scan, out, "a/b")


def test_a_load_that_died_is_not_read_and_runs_again(spark, path):
    spark.range(0, 10, 1, 2).write.parquet(path + "/t")
    scan, out = spark.read.parquet(path + "/t"), path + "/out"
    with pytest.raises(ValueError):
        star.read_loads(spark, out)
    whole = [rows_of(star.load_batch(spark, scan, out, name)) for name in "abc"][-1]
    for name in "ab":
        os.remove(f"{out}/load={name}/_SUCCESS")
    assert [r[0] for r in rows_of(star.read_loads(spark, out))] == ["c"] * 10
    with pytest.raises(ValueError):
        star.load_batch(spark, scan, out, "b")  # its first number is not known without a
    spark.range(5).write.mode("append").parquet(f"{out}/load=a")  # part of a run that died
    os.remove(f"{out}/load=a/_SUCCESS")
    with pytest.raises(ValueError):
        star.load_batch(spark, scan, out, "a")
    os.remove(f"{out}/load=c/_SUCCESS")
    for name in "ab":
        star.load_batch(spark, scan, out, name)
    assert rows_of(star.load_batch(spark, scan, out, "c")) == whole


def test_a_small_key_set_is_looked_up_where_rows_are_read(spark, path):
    spark.range(0, 50_000, 1, 4).select((F.col("id") % 700).alias("k"), F.lit("x").alias("y")).write.parquet(path + "/t")
    rows = spark.read.parquet(path + "/t")
    wanted = keys.sample_keys(rows, "k", 5)
    want = rows.filter(F.col("k").isin([r.k for r in wanted.collect()])).count()
    found = keys.count_in_key_set(rows, "k", wanted)
    assert found.first()[0] == want and "BroadcastHashJoin" in plan(found)
    twice = spark.createDataFrame([(1,), (1,), (None,), (10**6,)], "k long")
    assert keys.count_in_key_set(rows, "k", twice).first()[0] == rows.filter("k = 1").count()
    assert keys.count_in_key_set(rows, "k", twice.filter("k < 0")).first()[0] == 0


def test_both_ways_of_a_key_set_agree(spark, path, monkeypatch):
    spark.range(0, 9000, 1, 4).select((F.col("id") % 70).alias("k")).write.parquet(path + "/t")
    rows = spark.read.parquet(path + "/t")
    asked = rows.filter("k % 3 = 0")
    small = keys.count_in_key_set(rows, "k", asked).first()[0]
    monkeypatch.setattr(keys, "KEY_SET_BYTES", 0)
    large = keys.count_in_key_set(rows, "k", asked)
    assert large.first()[0] == small == asked.count()
    assert "LeftSemi" in plan(large)
