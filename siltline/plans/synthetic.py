"""Synthetic clients and users, derived from any table with a running number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from siltline.functions.numeric import hashed_between

# Sizes and ranges of the generated tables.
N_CLIENTS = 1_000
N_USERS = 200_000
EMPLOYEES = (50, 1_000)
AGES = (18, 65)
SALARY = (30_000, 150_000)
YEAR_SECONDS = 365 * 24 * 3600


def _seconds_before(until: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", -seconds, until)


def clients(numbers: DataFrame, number: str, until: str) -> DataFrame:
    """One client per row; the two times are drawn independently of each other."""
    i, end = F.col(number), F.expr(f"TIMESTAMP_NTZ'{until}'")
    return numbers.select(
        (i + 1).alias("id"),
        F.concat(F.lit("Company "), i + 1).alias("name"),
        hashed_between(i, "employees", *EMPLOYEES).alias("number_employments"),
        _seconds_before(end, hashed_between(i, "client created", 0, 2 * YEAR_SECONDS)).alias("created_at"),
        _seconds_before(end, hashed_between(i, "client updated", 0, YEAR_SECONDS)).alias("updated_at"),
    )


def users(numbers: DataFrame, number: str, until: str, n_clients: int = N_CLIENTS) -> DataFrame:
    """One user per row, dealt to the clients in turn; updated_at is not before created_at."""
    end = F.expr(f"TIMESTAMP_NTZ'{until}'")
    i, age_s = F.col("i"), F.col("age_s")
    drawn = numbers.select(F.col(number).alias("i")).withColumn(
        "age_s", hashed_between(i, "user created", 0, 2 * YEAR_SECONDS)
    )
    since = F.pmod(hashed_between(i, "user updated", 0, 2 * YEAR_SECONDS), age_s + 1)
    cents = hashed_between(i, "salary", SALARY[0] * 100, SALARY[1] * 100)
    return drawn.select(
        (i + 1).alias("id"),
        F.concat(F.lit("User "), i + 1).alias("name"),
        hashed_between(i, "age", *AGES).alias("age"),
        (F.pmod(i, F.lit(n_clients)) + 1).cast("bigint").alias("client_id"),
        F.round(cents / F.lit(100.0), 2).alias("salary"),
        _seconds_before(end, age_s).alias("created_at"),
        _seconds_before(end, age_s - since).alias("updated_at"),
    )
