"""Lookup dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# The lookup rows that facts are decoded with.
VENDORS = [
    (1, "Creative Mobile Technologies"),
    (2, "VeriFone Inc"),
]
RATE_CODES = [
    (1, "Standard rate"),
    (2, "JFK"),
    (3, "Newark"),
    (4, "Nassau or Westchester"),
    (5, "Negotiated fare"),
    (6, "Group ride"),
    (99, "Null/unknown"),
]
PAYMENT_TYPES = [
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
]

# The columns of the zone file, and their names here.
ZONE_FILE_SCHEMA = "LocationID int, Borough string, Zone string, service_zone string"
ZONE_COLUMNS = {"LocationID": "location_id", "Borough": "borough", "Zone": "zone"}


def lookup(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """A literal (id, description) table.  Its exact size is known to the planner."""
    values = ", ".join(f"({key!r}, {text!r})" for key, text in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS lookup(id, description)")


def vendors(spark: SparkSession) -> DataFrame:
    return lookup(spark, VENDORS)


def rate_codes(spark: SparkSession) -> DataFrame:
    return lookup(spark, RATE_CODES)


def payment_types(spark: SparkSession) -> DataFrame:
    return lookup(spark, PAYMENT_TYPES)


def zones_from_csv(spark: SparkSession, path: str, schema: str = ZONE_FILE_SCHEMA) -> DataFrame:
    """Zone dimension from a quoted CSV with a header; the text "N/A" stays a value."""
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .csv(path)
    )
    return rows.withColumnsRenamed(ZONE_COLUMNS)
