import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from siltline.functions.numeric import money_sum
from siltline.operators import dimensions
from siltline.plans import lake, star
from siltline.sinks import upsert
from siltline.sources import catalogs, files
from tests.plan import plan


def dim(spark, rows):
    return spark.createDataFrame(rows, "id int, description string")


def test_violations(spark):
    rows = dim(spark, [(1, "a"), (1, "b"), (2, None), (None, "c"), (None, None)])
    found = dimensions.constraint_violations(rows, "id", ["description"]).first()
    assert found.asDict() == {
        "n_rows": 5, "duplicate_keys": 1, "null_keys": 2, "null_description": 2,
    }
    empty = dimensions.constraint_violations(rows.limit(0), "id", ["description"]).first()
    assert tuple(empty) == (0, 0, 0, 0)


def test_bad_dimension_is_refused(spark):
    good = dim(spark, [(1, "a"), (2, "b")])
    assert dimensions.require_valid(good, "id", ["description"]) is good
    with pytest.raises(ValueError, match="duplicate_keys"):
        dimensions.require_valid(dim(spark, [(1, "a"), (1, "b")]), "id")
    with pytest.raises(ValueError, match="null_description"):
        dimensions.require_valid(dim(spark, [(1, None)]), "id", ["description"])


def test_star_dimension_is_replaced_and_checked(spark, path):
    rows = dim(spark, [(2, "b"), (1, "a")])
    for _ in range(2):
        loaded = star.load_star_dimension(spark, rows, path + "/d", "id", ("description",))
        assert sorted(map(tuple, loaded.collect())) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError):
        star.load_star_dimension(spark, dim(spark, [(1, "a"), (1, "b")]), path + "/e", "id")


def test_last_update_wins(spark):
    target = dim(spark, [(1, "a"), (2, "b"), (3, "c")])
    source = spark.createDataFrame(
        [(2, "new", 2), (2, "old", 1), (9, None, 3)], "id int, description string, seq int"
    )
    got = upsert.upserted(target, source, ["id"], "seq")
    assert sorted(map(tuple, got.collect())) == [(1, "a"), (2, "new"), (3, "c"), (9, None)]


def test_upsert_twice_equals_once(spark):
    name = f"{lake.new_schema(spark)}.dim"
    catalogs.create_managed(spark, name, "id int, description string")
    dim(spark, [(1, "a"), (2, "b")]).write.insertInto(name)
    source = spark.createDataFrame([(2, "x", 1), (3, "y", 1)], "id int, description string, seq int")
    for _ in range(2):
        before = spark.table(name)
        after = upsert.upsert_table(spark, name, source, ["id"], "seq")
        assert sorted(map(tuple, after.collect())) == [(1, "a"), (2, "x"), (3, "y")]
    assert before.count() == 3


def facts(spark):
    rows = [(1, 56, 10.0), (1, 57, 5.0), (0, 1, 99.0), (2, 1, 1.0), (None, None, 7.0)]
    return spark.createDataFrame(rows, "payment int, zone int, amount double")


def test_unmatched_facts_drop_out(spark):
    mix = star.payment_mix(
        facts(spark), dim(spark, [(1, "Credit card"), (2, "Cash")]), "payment", "id", "description", "amount"
    )
    assert list(map(tuple, mix.collect())) == [("Credit card", 15.0), ("Cash", 1.0)]


def test_zones_sharing_a_name_are_one(spark):
    zones = spark.createDataFrame(
        [(56, "Queens", "Corona"), (57, "Queens", "Corona"), (1, "EWR", "Newark")],
        "location_id bigint, borough string, zone string",
    )
    got = star.zone_revenue(
        facts(spark).withColumnRenamed("zone", "pu"), zones, "pu", "location_id", "borough", "zone", "amount"
    )
    assert list(map(tuple, got.collect())) == [("EWR", "Newark", 100.0), ("Queens", "Corona", 15.0)]


def test_a_frequent_key_is_added_up_before_the_join(spark):
    hot = spark.range(0, 90_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.lit(1.0).alias("amount")
    )
    names = spark.range(90_000).select(F.col("id").alias("id"), (F.col("id") % 10).alias("name"))
    mix = star.payment_mix(hot, names, "k", "id", "name", "amount")
    text = plan(mix)
    join = text.index("Join")
    assert "partial_sum" in text[join:] and "partial_sum" in text[:join]
    assert mix.agg(F.sum("total_revenue")).first()[0] == 90_000


def test_federation_reads_three_part_names(spark, sf):
    schema = lake.new_schema(spark)
    name = f"spark_catalog.{schema}.nation"
    catalogs.register_existing(spark, name, f"{sf}/nation.parquet")
    assert catalogs.table(spark, name).count() == 25
    assert spark.sql(f"SELECT count(*) FROM {name} WHERE n_nationkey = 1").first()[0] == 1


def test_a_managed_table_is_not_replaced(spark, path):
    name = f"{lake.new_schema(spark)}.kept"
    catalogs.create_managed(spark, name, "id bigint")
    spark.range(5).write.insertInto(name)
    spark.range(2).write.parquet(path + "/t")
    for register in (lambda: catalogs.register_existing(spark, name, path + "/t"),
                     lambda: catalogs.register_external(spark, name, "id bigint", path + "/t")):
        with pytest.raises(ValueError):
            register()
    assert spark.table(name).count() == 5
    other = f"{lake.new_schema(spark)}.outside"
    for _ in range(2):
        assert catalogs.register_existing(spark, other, path + "/t").count() == 2


def test_an_upsert_stays_beside_its_table(spark, path):
    spark.range(3).selectExpr("id", "'old' AS description").write.parquet(path + "/t")
    name = f"{lake.new_schema(spark)}.t"
    catalogs.register_existing(spark, name, path + "/t")
    for k in (2, 3):
        source = spark.createDataFrame([(k, f"new{k}", 1)], "id long, description string, seq int")
        upsert.upsert_table(spark, name, source, ["id"], "seq")
    place = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}["Location"]
    assert place.rpartition("--")[0].endswith(path + "/t")
    assert sorted(map(tuple, spark.table(name).collect())) == [(0, "old"), (1, "old"), (2, "new2"), (3, "new3")]


def test_an_upsert_rewrites_the_partitions_it_touches(spark, path):
    spark.range(10).selectExpr("id", "'old' AS d", "id % 3 AS p").write.partitionBy("p").parquet(path + "/t")
    name = f"{lake.new_schema(spark)}.t"
    catalogs.register_existing(spark, name, path + "/t", partitioned=True)
    before = {f.path for f in files.file_sizes(spark, path + "/t").collect()}
    source = spark.createDataFrame([(1, "new", 1, 1), (50, "new", 1, 1), (51, "new", 7, 1)], "id long, d string, p long, seq int")
    rows = upsert.upsert_table(spark, name, source, ["id", "p"], "seq")
    assert rows.count() == 12 and rows.where("d = 'new'").count() == 3
    after = {f.path for f in files.file_sizes(spark, path + "/t").collect()}
    assert {f for f in before if "p=1/" not in f} <= after
    with pytest.raises(ValueError):
        upsert.upsert_table(spark, name, source, ["id"], "seq")


def partitioned(spark, path):
    rows = [(k, "old", None if k % 3 == 0 else f"p'{k % 3}") for k in range(9)]
    spark.createDataFrame(rows, "id long, d string, p string").write.partitionBy("p").parquet(path + "/t")
    name = f"{lake.new_schema(spark)}.t"
    catalogs.register_existing(spark, name, path + "/t", partitioned=True)
    return name, {(k, d, p) for k, d, p in rows}


def test_an_upsert_keeps_the_rows_of_a_null_partition(spark, path):
    name, rows = partitioned(spark, path)
    for n in range(2):
        new = [(0, f"new{n}", None, 1), (77, f"new{n}", None, 1), (None, f"new{n}", "p'1", 1), (78, f"new{n}", "q", 1)]
        source = spark.createDataFrame(new, "id long, d string, p string, seq int")
        got = upsert.upsert_table(spark, name, source, ["id", "p"], "seq").collect()
        want = {r for r in rows if r[0] != 0} | {r[:3] for r in new}
        assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert spark.table(name).where("p is null").count() == 4


def test_an_upsert_that_dies_leaves_whole_partitions(spark, path, monkeypatch):
    name, rows = partitioned(spark, path)
    new = [(0, "new", None, 1), (1, "new", "p'1", 1), (2, "new", "p'2", 1)]
    source = spark.createDataFrame(new, "id long, d string, p string, seq int")
    bad = source.withColumn("d", F.when(F.col("id") == 2, F.raise_error(F.lit("dies"))).otherwise(F.col("d")))
    with pytest.raises(Exception, match="dies"):
        upsert.upsert_table(spark, name, bad, ["id", "p"], "seq")
    assert {tuple(r) for r in spark.table(name).collect()} == rows
    publish, calls = upsert._publish, []

    def once(*args):
        calls.append(args)
        if len(calls) > 1:
            raise RuntimeError("dies")
        publish(*args)

    monkeypatch.setattr(upsert, "_publish", once)
    with pytest.raises(RuntimeError):
        upsert.upsert_table(spark, name, source, ["id", "p"], "seq")
    spark.catalog.refreshTable(name)
    got = {tuple(r) for r in spark.table(name).collect()}
    assert len(got) == 9 and len(got - rows) == 1
    monkeypatch.undo()
    got = {tuple(r) for r in upsert.upsert_table(spark, name, source, ["id", "p"], "seq").collect()}
    assert got == {r for r in rows if r[0] > 2} | {r[:3] for r in new}


def test_columns_are_judged_file_by_file(spark, path):
    def put(number, rows, columns):
        spark.createDataFrame(rows, columns).coalesce(1).write.parquet(f"{path}/in/{number}")

    put(1, [(1, 1.0, "x"), (2, 2.0, "y")], "VendorID long, total_amount double, note string")
    put(2, [("only",), ("notes",)], "note string")
    put(3, [(3.0,), (4.0,)], "total_amount double")
    put(4, [(None, 5.0, "z"), (6, 6.0, "z")], "VendorID long, total_amount double, note string")
    put(5, [(7, 7.0)], "VendorID int, total_amount double")
    paths = sorted(r.path for r in files.file_sizes(spark, path + "/in").collect())
    want = [(1, 1, 1.0), (2, 2, 2.0), (3, None, 3.0), (4, None, 4.0), (5, None, 5.0), (6, 6, 6.0), (7, 7, 7.0)]
    for limit in (None, 0, 3, 5, 100):
        got = star.star_fact_of_files(spark, paths, limit=limit).select("trip_id", "vendor_id", "total_amount")
        assert sorted(map(tuple, got.collect())) == want[:limit]
    assert dict(got.dtypes)["vendor_id"] == "int"
    again = star.star_fact_of_files(spark, paths[:1], first=100)
    assert [r.trip_id for r in again.collect()] == [100, 101]
    with pytest.raises(ValueError):
        star.star_fact_of_files(spark, [paths[1]])


def test_money_does_not_depend_on_the_partitioning(spark):
    amounts = spark.range(0, 300_000, 1, 7).select((F.col("id") * 333.3301 + 1e7).alias("x"))
    sums = {tuple(amounts.repartition(n).agg(money_sum(F.col("x"))).first()) for n in (1, 3, 11)}
    assert len(sums) == 1


def test_registered_partitions_are_found(spark, path):
    spark.range(10).selectExpr("id", "id % 2 as p").write.partitionBy("p").parquet(path + "/t")
    name = f"{lake.new_schema(spark)}.t"
    assert catalogs.register_existing(spark, name, path + "/t", partitioned=True).count() == 10


@pytest.mark.parametrize("limit", [1, 2, 3, 4, 50, None])
def test_daily_revenue_of_the_first_days(spark, limit):
    day = dt.datetime(2025, 1, 1)
    rows = [
        (None, 1, 1.0), (day, 9, 5.0), (day + dt.timedelta(days=1, hours=23, minutes=59), 1, 2.0),
        (day + dt.timedelta(days=1), 2, 3.0), (day + dt.timedelta(days=2), 2, 4.0),
        (day + dt.timedelta(days=3), None, 8.0), (day + dt.timedelta(days=9), 1, 6.0),
    ]
    fact = spark.createDataFrame(rows, "time timestamp_ntz, id bigint, amount double")
    names = dim(spark, [(1, "a"), (2, "b")])
    got = star.daily_revenue(fact, names, "id", "id", "description", "time", "amount", limit)
    d = day.date()
    want = [
        (None, "a", 1.0), (d + dt.timedelta(1), "a", 2.0), (d + dt.timedelta(1), "b", 3.0),
        (d + dt.timedelta(2), "b", 4.0), (d + dt.timedelta(9), "a", 6.0),
    ]
    assert list(map(tuple, got.collect())) == want[:limit]


def test_a_frequent_key_is_split_when_the_dimension_is_large(spark, path):
    """Sort-merge join of a fact with one key in a third of its rows: several tasks share it."""
    facts_path = path + "/facts"
    spark.range(0, 600_000, 1, 24).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("client_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("name"),
    ).write.parquet(facts_path)
    clients = spark.range(600_000).select(F.col("id").alias("n"), (F.col("id") % 9).alias("company"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        users = spark.read.parquet(facts_path)
        joined = users.join(clients, F.col("client_id") == F.col("n")).groupBy("company").agg(
            F.count("*").alias("n"), F.max("name").alias("last")
        )
        assert sum(r.n for r in joined.collect()) == 600_000
        assert "SortMergeJoin(skew=true)" in plan(joined)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_money_that_is_no_number(spark):
    nan, inf = float("nan"), float("inf")
    rows = [("a", 1.25), ("a", None), ("b", nan), ("b", 2.0), ("c", inf), ("c", 1.0), ("d", -inf), ("e", inf), ("e", -inf), ("f", None), ("g", inf), ("g", nan)]
    fact = spark.createDataFrame([(k, x) for k, x in rows], "k string, x double")
    dim = spark.createDataFrame([(k, k) for k in "abcdefg"], "id string, name string")
    want = {"a": "1.25", "b": "NaN", "c": "Infinity", "d": "-Infinity", "e": "NaN", "f": None, "g": "NaN"}
    sums = fact.groupBy("k").agg(money_sum(F.col("x")).alias("s"))
    assert {r.k: r.s for r in sums.select("k", F.col("s").cast("string").alias("s")).collect()} == want
    by = dimensions.revenue_by_attributes(fact, dim, "k", "id", {"name": "name"}, "x")
    assert {r.name: r.s for r in by.select("name", F.col("total_revenue").cast("string").alias("s")).collect()} == want
    exact = fact.select(F.lit(3).alias("n"), F.lit("1.10").cast("decimal(10,2)").alias("d"))
    assert exact.agg(money_sum(F.col("n")), money_sum(F.col("d"))).first()[:] == (36.0, 13.2)


def test_facts_by_day_are_dealt_by_their_size(spark, path, monkeypatch):
    """A task groups no more as facts grow: none is grouped where it is read, and tasks grow with the size."""
    names = dim(spark, [(k, f"v{k % 3}") for k in range(50)])
    tasks = []
    for n in (20_000, 80_000):
        rows = spark.range(n).selectExpr(
            "id % 50 AS id", "timestamp_ntz'2025-01-01' + make_interval(0, 0, 0, cast(id % 40 AS int)) AS time",
            "cast(xxhash64(id) % 100000 AS double) AS amount",
        )
        rows.repartition(4).write.parquet(f"{path}/{n}")
        fact = spark.read.parquet(f"{path}/{n}")
        found = []
        for size in (2**40, 2_000):
            monkeypatch.setattr(dimensions, "GROUPED_BYTES", size)
            found.append(star.daily_revenue(fact, names, "id", "id", "description", "time", "amount", None))
        assert "REPARTITION_BY_NUM" not in plan(found[0])
        tasks.append(int(re.search(r"hashpartitioning\(time_key#\d+, id#\d+L, (\d+)\), REPARTITION_BY_NUM", plan(found[1]))[1]))
        whole, dealt = (list(map(tuple, rows.collect())) for rows in found)
        assert dealt == whole and len(dealt) == 120
    assert tasks[0] > 8 and tasks[1] > 2 * tasks[0]
