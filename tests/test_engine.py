"""Properties that hold for all registered queries, and the shared folder."""

import pytest
from pyspark.sql import functions as F

from siltline import scratch
from siltline.plans import synthetic
from siltline.plans.registry import QUERIES
from tests.plan import plan


class Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class Session:
    def __init__(self, **conf):
        self.conf = Conf({k.replace("_", "."): v for k, v in conf.items()})


def test_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError):
        scratch.scratch_root(Session(spark_master="yarn", spark_app_id="a1"))


def test_shared_folder_is_the_configured_one():
    session = Session(spark_master="yarn", spark_app_id="a1", spark_checkpoint_dir="s3a://b/ck/")
    assert scratch.scratch_root(session) == "s3a://b/ck/siltline/a1"
    assert scratch.new_path(session, "x") != scratch.new_path(session, "x")


def test_local_session_without_the_setting_gets_a_folder():
    session = Session(spark_master="local[2]", spark_app_id="local-x")
    assert scratch.scratch_root(session) == scratch.scratch_root(session)


def test_derived_tables_are_written_once_until_discarded(spark, path, monkeypatch):
    monkeypatch.setattr(scratch, "scratch_root", lambda _: f"file://{path}/app")
    calls = []

    def write(to):
        calls.append(to)
        spark.range(3).write.parquet(to)

    first = scratch.write_once(spark, "t", "in", write)
    assert scratch.write_once(spark, "t", "in", write) == first and len(calls) == 1
    assert scratch.write_once(spark, "t", "other", write) != first
    assert spark.read.parquet(first).count() == 3
    assert scratch.discard_scratch(spark)
    with pytest.raises(Exception):
        spark.read.parquet(first)
    assert scratch.write_once(spark, "t", "in", write) != first


STREAMS = {"stream_current_state", "stream_update_count", "history_append"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_plans_have_no_cross_join_and_no_python(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    for node in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "PythonUDF", "MapInPandas"):
        assert node not in text
    assert "SinglePartition" not in text.split("BroadcastExchange")[0] or name in (
        "fee_share", "fee_split", "dim_constraint_check", "key_set_lookup",  # one row of partial sums per task
    )


@pytest.mark.parametrize(
    "name, columns",
    [
        ("trips_by_day_of_week", "o_orderdate:timestamp_ntz"),
        ("fee_share", "l_tax:double"),
        ("top_locations", "l_suppkey:bigint"),
        ("payment_type_revenue", "l_extendedprice:double,l_returnflag:string"),
        ("monthly_fee_impact", "l_tax:double,l_shipdate:timestamp_ntz"),
    ],
)
def test_scans_read_only_the_columns_they_need(spark, sf, name, columns):
    assert f"ReadSchema: struct<{columns}>" in plan(QUERIES[name](spark, sf))


@pytest.mark.parametrize("name", ["top_locations", "star_daily_revenue", "star_zone_revenue", "users_preview", "history_page"])
def test_top_k_is_not_a_full_sort(spark, sf, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, sf))


def test_small_dimensions_are_broadcast_and_large_ones_are_not(spark, sf):
    assert "BroadcastHashJoin" in plan(QUERIES["star_daily_revenue"](spark, sf))
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "1")
    try:
        large = QUERIES["star_daily_revenue"](spark, sf)
        assert "SortMergeJoin" in plan(large) and large.count() == 100
    finally:
        spark.conf.set(name, before)


def test_synthetic_rows_are_bounded_and_repeatable(spark):
    numbers = spark.range(0, 5000, 1, 4).withColumnRenamed("id", "i")
    users = synthetic.users(numbers, "i", "2025-01-01 00:00:00")
    assert tuple(users.agg(F.min("age"), F.max("age")).first()) == (18, 65)
    assert users.filter("salary < 30000 or salary > 150000 or updated_at < created_at").count() == 0
    assert users.filter("updated_at > timestamp_ntz'2025-01-01'").count() == 0
    per_client = users.groupBy("client_id").count().agg(F.min("count"), F.max("count"), F.count("*")).first()
    assert tuple(per_client) == (5, 5, 1000)
    again = synthetic.users(numbers.repartition(7), "i", "2025-01-01 00:00:00")
    assert users.exceptAll(again).count() == 0
    clients = synthetic.clients(numbers, "i", "2025-01-01 00:00:00")
    assert clients.filter("number_employments not between 50 and 1000").count() == 0
    assert clients.filter("created_at > updated_at").count() > 0
