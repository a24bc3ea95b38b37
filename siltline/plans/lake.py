"""Raw zone to silver table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from siltline import scratch
from siltline.operators.keys import number_by_file
from siltline.sources import catalogs

# The declared columns of the raw and silver trip tables.
TRIP_COLUMNS = (
    "VendorID bigint, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
    "passenger_count int, trip_distance double, RatecodeID bigint, PULocationID bigint, "
    "DOLocationID bigint, payment_type bigint, fare_amount double, tip_amount double, "
    "total_amount double"
)


def new_schema(spark: SparkSession, prefix: str = "silt") -> str:
    """Create a schema whose managed tables live in the shared folder."""
    name = f"{prefix}_{uuid.uuid4().hex[:8]}"
    catalogs.ensure_schema(spark, name, f"{scratch.scratch_root(spark)}/{name}")
    return name


def raw_to_silver(
    spark: SparkSession,
    schema: str,
    raw_location: str,
    columns: str = TRIP_COLUMNS,
    table: str = "trip",
    limit: int | None = None,
) -> DataFrame:
    """Declare the raw files as a table, and insert its columns into a managed one.

    ``limit`` keeps the first rows in file order; by default all rows are loaded.
    """
    raw = catalogs.register_external(spark, f"{schema}.{table}_raw", columns, raw_location)
    catalogs.create_managed(spark, f"{schema}.{table}_silver", columns)
    rows = raw if limit is None else number_by_file(raw, "_n", limit=limit).drop("_n")
    rows.write.insertInto(f"{schema}.{table}_silver")
    return spark.table(f"{schema}.{table}_silver")
