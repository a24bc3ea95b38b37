"""The trip analyses.  Column names are arguments, so any fact table will do.

Each is one scan of the columns it names and one aggregation with a map-side
partial step, so a frequent value costs no more than a rare one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from siltline.functions import calendar as C
from siltline.functions.numeric import money_sum, share_pct


def trips_by_weekday(trips: DataFrame, time: str) -> DataFrame:
    """Trips per weekday name, names ascending."""
    return _per_weekday(trips, time).select("day_of_week", "trip_count").orderBy("day_of_week")


def trips_by_weekday_ordered(trips: DataFrame, time: str) -> DataFrame:
    """Trips per weekday, Monday first, unknown days last."""
    days = _per_weekday(trips, time)
    order = C.weekday_order(F.col("day_of_week")).alias("day_order")
    return days.select("day_of_week", "trip_count", order).orderBy("day_order")


def _per_weekday(trips: DataFrame, time: str) -> DataFrame:
    counts = trips.groupBy(C.weekday_number(F.col(time)).alias("day")).agg(
        F.count("*").alias("trip_count")
    )
    return counts.withColumn("day_of_week", C.weekday_name(F.col("day")))


def count_and_revenue(trips: DataFrame, by: str, amount: str) -> DataFrame:
    """Trips and revenue per category."""
    return (
        trips.groupBy(by)
        .agg(F.count("*").alias("count"), money_sum(F.col(amount)).alias("total_revenue"))
        .orderBy(by)
    )


def distribution(trips: DataFrame, by: str, drop_null: bool = False) -> DataFrame:
    """Trips per value; NULL is a group of its own and comes first."""
    rows = trips.dropna(subset=[by]) if drop_null else trips
    return (
        rows.groupBy(by).agg(F.count("*").alias("trip_count")).orderBy(F.col(by).asc_nulls_first())
    )


def monthly_fee_impact(trips: DataFrame, time: str, fee: str) -> DataFrame:
    """Per month: trips, sum of the fee, trips with a fee above zero."""
    months = trips.groupBy(C.month_start(F.col(time)).alias("first_day")).agg(
        F.count("*").alias("total_rides"),
        money_sum(F.col(fee)).alias("total_congestion_fee"),
        F.count_if(F.col(fee) > 0).alias("rides_with_congestion_fee"),
    )
    return months.select(
        C.month_label(F.col("first_day")).alias("month"),
        "total_rides",
        "total_congestion_fee",
        "rides_with_congestion_fee",
    ).orderBy("month")


def _fee_counts(trips: DataFrame, fee: str) -> tuple[DataFrame, Column, Column]:
    counts = trips.agg(
        F.count("*").alias("total_rides"),
        F.count_if(F.col(fee) > 0).alias("rides_with_airport_fee"),
    )
    return counts, F.col("rides_with_airport_fee"), F.col("total_rides")


def fee_share(trips: DataFrame, fee: str) -> DataFrame:
    """Share of trips with a fee, in percent; one pass, 0.0 on empty input."""
    counts, part, whole = _fee_counts(trips, fee)
    return counts.withColumn("percentage_with_airport_fee", share_pct(part, whole))


def fee_split(trips: DataFrame, fee: str) -> DataFrame:
    """Trips with and without the fee and both percentages."""
    counts, part, whole = _fee_counts(trips, fee)
    return counts.select(
        part.alias("with_fee"),
        (whole - part).alias("without_fee"),
        share_pct(part, whole).alias("pct_with_fee"),
        share_pct(whole - part, whole).alias("pct_without_fee"),
    )


def top_locations(trips: DataFrame, location: str, k: int = 20) -> DataFrame:
    """The k busiest locations; equal counts in ascending order of location."""
    return (
        trips.groupBy(location)
        .agg(F.count("*").alias("trip_count"))
        .orderBy(F.desc("trip_count"), F.asc(location))
        .limit(k)
    )
