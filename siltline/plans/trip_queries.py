"""Registry: the trip analyses over orders and lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltline.operators import keys, trips
from siltline.plans.inputs import table


def _passengers(spark, sf):
    """Line numbers stand for passenger counts; 7 is made NULL."""
    lines = table(spark, sf, "lineitem")
    return lines.select(F.nullif("l_linenumber", F.lit(7)).alias("passenger_count"))


def trips_by_day_of_week(spark, sf):
    return trips.trips_by_weekday(table(spark, sf, "orders"), "o_orderdate")


def weekday_ordered(spark, sf):
    return trips.trips_by_weekday_ordered(table(spark, sf, "orders"), "o_orderdate")


def payment_type_revenue(spark, sf):
    lines = table(spark, sf, "lineitem").withColumnRenamed("l_returnflag", "payment_type")
    return trips.count_and_revenue(lines, "payment_type", "l_extendedprice")


def revenue_not_finite(spark, sf):
    """Revenue by priority, where urgent orders have NaN for some amounts and high ones an infinity."""
    odd = F.col("o_orderkey") % 2 == 0
    orders = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("priority"),
        F.when(odd & (F.col("o_orderpriority") == "1-URGENT"), float("nan"))
        .when(odd & (F.col("o_orderpriority") == "2-HIGH"), float("inf"))
        .otherwise(F.col("o_totalprice"))
        .alias("amount"),
    )
    total = F.col("total_revenue")
    return trips.count_and_revenue(orders, "priority", "amount").select(
        "priority",
        "count",
        F.isnan(total).alias("is_nan"),
        (total == float("inf")).alias("is_infinite"),
        F.when(total < float("inf"), total).alias("total_revenue"),
    )


def passenger_distribution(spark, sf):
    return trips.distribution(_passengers(spark, sf), "passenger_count")


def passenger_distribution_clean(spark, sf):
    return trips.distribution(_passengers(spark, sf), "passenger_count", drop_null=True)


def monthly_fee_impact(spark, sf):
    return trips.monthly_fee_impact(table(spark, sf, "lineitem"), "l_shipdate", "l_tax")


def fee_share(spark, sf):
    return trips.fee_share(table(spark, sf, "lineitem"), "l_tax")


def fee_split(spark, sf):
    return trips.fee_split(table(spark, sf, "lineitem"), "l_tax")


def top_locations(spark, sf):
    lines = table(spark, sf, "lineitem").withColumnRenamed("l_suppkey", "location_id")
    return trips.top_locations(lines, "location_id", 20)


def sample_distinct_keys(spark, sf):
    return keys.sample_keys(table(spark, sf, "lineitem"), "l_partkey", 50)


def key_set_lookup(spark, sf):
    lines = table(spark, sf, "lineitem")
    return keys.count_in_key_set(lines, "l_partkey", keys.sample_keys(lines, "l_partkey", 50))


QUERIES = {
    f.__name__: f
    for f in (
        trips_by_day_of_week,
        weekday_ordered,
        payment_type_revenue,
        revenue_not_finite,
        passenger_distribution,
        passenger_distribution_clean,
        monthly_fee_impact,
        fee_share,
        fee_split,
        top_locations,
        sample_distinct_keys,
        key_set_lookup,
    )
}

ORACLES = {
    "trips_by_day_of_week": """
        SELECT strftime(o_orderdate, '%A') AS day_of_week, count(*) AS trip_count
        FROM orders GROUP BY 1 ORDER BY 1""",
    "weekday_ordered": """
        SELECT strftime(o_orderdate, '%A') AS day_of_week, count(*) AS trip_count,
               cast(isodow(o_orderdate) - 1 AS integer) AS day_order
        FROM orders GROUP BY 1, 3 ORDER BY 3""",
    "payment_type_revenue": """
        SELECT l_returnflag AS payment_type, count(*) AS count,
               round(sum(l_extendedprice), 2) AS total_revenue
        FROM lineitem GROUP BY 1 ORDER BY 1""",
    "revenue_not_finite": """
        WITH sums AS (
            SELECT o_orderpriority AS priority, count(*) AS count,
                   round(sum(CASE WHEN o_orderkey % 2 = 0 AND o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 0
                                  ELSE o_totalprice END), 2) AS total,
                   bool_or(o_orderkey % 2 = 0 AND o_orderpriority = '1-URGENT') AS is_nan,
                   bool_or(o_orderkey % 2 = 0 AND o_orderpriority = '2-HIGH') AS is_infinite
            FROM orders GROUP BY 1)
        SELECT priority, count, is_nan, is_infinite,
               CASE WHEN NOT is_nan AND NOT is_infinite THEN total END AS total_revenue
        FROM sums""",
    "passenger_distribution": """
        SELECT nullif(l_linenumber, 7) AS passenger_count, count(*) AS trip_count
        FROM lineitem GROUP BY 1 ORDER BY 1 NULLS FIRST""",
    "passenger_distribution_clean": """
        SELECT l_linenumber AS passenger_count, count(*) AS trip_count
        FROM lineitem WHERE l_linenumber <> 7 GROUP BY 1 ORDER BY 1""",
    "monthly_fee_impact": """
        SELECT strftime(l_shipdate, '%Y-%m') AS month, count(*) AS total_rides,
               round(sum(l_tax), 2) AS total_congestion_fee,
               cast(sum(CASE WHEN l_tax > 0 THEN 1 ELSE 0 END) AS bigint)
                   AS rides_with_congestion_fee
        FROM lineitem GROUP BY 1 ORDER BY 1""",
    "fee_share": """
        SELECT total_rides, rides_with_airport_fee,
               cast(rides_with_airport_fee AS double) * 100 / total_rides
                   AS percentage_with_airport_fee
        FROM (SELECT count(*) AS total_rides,
                     cast(sum(CASE WHEN l_tax > 0 THEN 1 ELSE 0 END) AS bigint)
                         AS rides_with_airport_fee
              FROM lineitem)""",
    "fee_split": """
        SELECT w AS with_fee, n - w AS without_fee, cast(w AS double) * 100 / n AS pct_with_fee,
               cast(n - w AS double) * 100 / n AS pct_without_fee
        FROM (SELECT count(*) AS n, cast(sum(CASE WHEN l_tax > 0 THEN 1 ELSE 0 END) AS bigint) AS w
              FROM lineitem)""",
    "top_locations": """
        SELECT l_suppkey AS location_id, count(*) AS trip_count
        FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
    "sample_distinct_keys": """
        SELECT l_partkey FROM (SELECT DISTINCT l_partkey FROM lineitem)
        ORDER BY md5(cast(l_partkey AS varchar)), l_partkey LIMIT 50""",
    "key_set_lookup": """
        SELECT count(*) AS count FROM lineitem WHERE l_partkey IN (
            SELECT l_partkey FROM (SELECT DISTINCT l_partkey FROM lineitem)
            ORDER BY md5(cast(l_partkey AS varchar)), l_partkey LIMIT 50)""",
}
