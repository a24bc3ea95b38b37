"""Catalog tables: registration, three-part names and JDBC catalogs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

JDBC_CATALOG = "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog"


def table(spark: SparkSession, name: str) -> DataFrame:
    """A table by its ``catalog.schema.table`` name."""
    return spark.table(name)


def mount_jdbc_catalog(
    spark: SparkSession, name: str, url: str, driver: str, options: Mapping[str, str] | None = None
) -> None:
    """Make a relational database readable as ``name.schema.table``.

    Filters, projections and limits on such tables are pushed to the database.
    The driver class must be on the class path of driver and executors.
    """
    prefix = f"spark.sql.catalog.{name}"
    settings = {"url": url, "driver": driver, **(options or {})}
    for key, value in settings.items():
        spark.conf.set(f"{prefix}.{key}", value)
    spark.conf.set(prefix, JDBC_CATALOG)


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    name: str,
    split_on: str,
    low: int,
    high: int,
    partitions: int,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A large relational table in parallel, one range of ``split_on`` per task."""
    return (
        spark.read.format("jdbc")
        .options(**(options or {}))
        .option("url", url)
        .option("dbtable", name)
        .option("partitionColumn", split_on)
        .option("lowerBound", low)
        .option("upperBound", high)
        .option("numPartitions", partitions)
        .load()
    )


def ensure_schema(spark: SparkSession, schema: str, location: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{location}'")


def _forget(spark: SparkSession, name: str) -> None:
    """Drop the entry of an external table; a managed one, whose files would go, is refused."""
    if spark.catalog.tableExists(name):
        details = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
        if details.get("Type") != "EXTERNAL":
            raise ValueError(f"{name} is a managed table: its files would be deleted")
        spark.sql(f"DROP TABLE {name}")


def register_external(spark: SparkSession, name: str, columns: str, location: str) -> DataFrame:
    """Declare a table with the given columns over files that already exist."""
    _forget(spark, name)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{location}'")
    return spark.table(name)


def register_existing(
    spark: SparkSession, name: str, location: str, partitioned: bool = False
) -> DataFrame:
    """Register existing files as a table; the schema comes from the files."""
    _forget(spark, name)
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{location}'")
    if partitioned:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def create_managed(spark: SparkSession, name: str, columns: str) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet")
