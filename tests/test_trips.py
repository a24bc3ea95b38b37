import datetime as dt

import pytest
from pyspark.sql import functions as F

from siltline.functions import calendar as C
from siltline.operators import trips
from siltline.plans.inputs import table

MONDAY = dt.datetime(2025, 3, 3, 12)
TRIPS = "time timestamp_ntz, passengers int, fee double, location long, amount double"


@pytest.fixture
def few(spark):
    rows = [
        (MONDAY, 1, 1.25, 10, 5.0),
        (MONDAY, None, 0.0, 10, 5.5),
        (MONDAY + dt.timedelta(days=6), None, None, 20, 1.0),
        (dt.datetime(2008, 12, 31, 23, 59), 2, 2.5, 30, 2.0),
        (None, 2, -1.0, 20, None),
    ]
    return spark.createDataFrame(rows, TRIPS)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], TRIPS)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_weekdays_by_name(few):
    assert rows(trips.trips_by_weekday(few, "time")) == [
        (None, 1), ("Monday", 2), ("Sunday", 1), ("Wednesday", 1),
    ]


def test_weekdays_in_week_order_unknown_last(few):
    assert rows(trips.trips_by_weekday_ordered(few, "time")) == [
        ("Monday", 2, 0), ("Wednesday", 1, 2), ("Sunday", 1, 6), (None, 1, 99),
    ]


def test_unknown_weekday_name_sorts_last(spark):
    names = spark.createDataFrame([("Sunday",), ("Lunes",)], "name string")
    assert [r[0] for r in names.select(C.weekday_order(F.col("name"))).collect()] == [6, 99]


def test_null_is_a_group_and_comes_first(few):
    assert rows(trips.distribution(few, "passengers")) == [(None, 2), (1, 1), (2, 2)]
    assert rows(trips.distribution(few, "passengers", drop_null=True)) == [(1, 1), (2, 2)]


def test_months_keep_dirty_dates_and_null_fees_do_not_count(few):
    assert rows(trips.monthly_fee_impact(few, "time", "fee")) == [
        (None, 1, -1.0, 0), ("2008-12", 1, 2.5, 1), ("2025-03", 3, 1.25, 1),
    ]


def test_fee_share(few, none):
    assert rows(trips.fee_share(few, "fee")) == [(5, 2, 40.0)]
    assert rows(trips.fee_share(none, "fee")) == [(0, 0, 0.0)]
    assert rows(trips.fee_split(few, "fee")) == [(2, 3, 40.0, 60.0)]
    assert rows(trips.fee_split(none, "fee")) == [(0, 0, 0.0, 0.0)]


def test_empty_groups(none):
    assert rows(trips.trips_by_weekday(none, "time")) == []
    assert rows(trips.top_locations(none, "location")) == []


def test_top_k_breaks_ties_by_key(few):
    assert rows(trips.top_locations(few, "location", 2)) == [(10, 2), (20, 2)]
    assert rows(trips.top_locations(few, "location", 1)) == [(10, 2)]


def test_revenue_per_category(few):
    assert rows(trips.count_and_revenue(few, "location", "amount")) == [
        (10, 2, 10.5), (20, 2, 1.0), (30, 1, 2.0),
    ]


def test_group_counts_add_up_to_the_table(spark, sf):
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    n = lines.count()
    for grouped in (
        trips.monthly_fee_impact(lines, "l_shipdate", "l_tax").select(F.sum("total_rides")),
        trips.distribution(lines, "l_linenumber").select(F.sum("trip_count")),
        trips.count_and_revenue(lines, "l_returnflag", "l_extendedprice").select(F.sum("count")),
        trips.fee_split(lines, "l_tax").select(F.col("with_fee") + F.col("without_fee")),
    ):
        assert grouped.first()[0] == n
    weekdays = trips.trips_by_weekday(orders, "o_orderdate")
    assert weekdays.select(F.sum("trip_count")).first()[0] == orders.count()
