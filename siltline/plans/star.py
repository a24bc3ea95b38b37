"""Star-schema queries and the star fact load.

The same three queries serve one store and federation: they take DataFrames, and
``spark.table("catalog.schema.table")`` of any mounted catalog is one.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltline.functions import calendar as C
from siltline.operators.dimensions import require_valid, revenue_by_attributes
from siltline.operators.keys import number_by_file, number_files
from siltline.sinks.layouts import append_chunked, finished, write_clustered
from siltline.sources import files

# Raw trip columns and their names in the star fact.
FACT_COLUMNS = {
    "VendorID": "vendor_id",
    "RatecodeID": "rate_code_id",
    "payment_type": "payment_type",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "passenger_count": "passenger_count",
    "trip_distance": "trip_distance",
    "fare_amount": "fare_amount",
    "tip_amount": "tip_amount",
    "total_amount": "total_amount",
    "PULocationID": "pulocation_id",
    "DOLocationID": "dolocation_id",
}
FACT_INTS = (
    "vendor_id", "rate_code_id", "payment_type", "passenger_count", "pulocation_id", "dolocation_id",
)
# Fixed value: rows in a file of the fact load.
LOAD_CHUNK = 100_000


def daily_revenue(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    description: str,
    time: str,
    amount: str,
    limit: int | None = 100,
) -> DataFrame:
    """Revenue per pickup day and vendor, in that order."""
    revenue = revenue_by_attributes(
        fact, dim, fact_key, dim_key, {description: "vendor"}, amount, C.day(F.col(time))
    )
    ordered = revenue.withColumnRenamed("time_key", "pickup_day").orderBy("pickup_day", "vendor")
    return ordered if limit is None else ordered.limit(limit)


def zone_revenue(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    borough: str,
    zone: str,
    amount: str,
    limit: int | None = 50,
) -> DataFrame:
    """Revenue per (borough, zone), highest first; zone ids sharing a name are one zone."""
    revenue = revenue_by_attributes(
        fact, dim, fact_key, dim_key, {borough: "borough", zone: "zone"}, amount
    )
    ordered = revenue.orderBy(F.desc("total_revenue"), "borough", "zone")
    return ordered if limit is None else ordered.limit(limit)


def payment_mix(
    fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, description: str, amount: str
) -> DataFrame:
    """Revenue per payment description, highest first; unknown payment types drop out."""
    revenue = revenue_by_attributes(
        fact, dim, fact_key, dim_key, {description: "payment_type"}, amount
    )
    return revenue.orderBy(F.desc("total_revenue"), "payment_type")


def star_fact(
    scan: DataFrame,
    columns: Mapping[str, str] = FACT_COLUMNS,
    ints: tuple[str, ...] = FACT_INTS,
    limit: int | None = None,
) -> DataFrame:
    """Fact rows with a dense trip_id, from a scan of the raw files.

    Wanted columns the files lack are left out.
    """
    present = [c for c in columns if c in scan.columns]
    if not present:
        raise ValueError("the raw files have none of the fact columns")
    numbered = number_by_file(scan, "trip_id", limit=limit)
    named = numbered.select("trip_id", *present).withColumnsRenamed(
        {c: columns[c] for c in present}
    )
    return named.withColumns({c: F.col(c).cast("int") for c in ints if c in named.columns})


def star_fact_of_files(
    spark: SparkSession,
    paths: Sequence[str],
    columns: Mapping[str, str] = FACT_COLUMNS,
    ints: tuple[str, ...] = FACT_INTS,
    first: int = 1,
    limit: int | None = None,
) -> DataFrame:
    """Fact rows with a dense trip_id from files that need not have the same columns.

    Each file gives the wanted columns that it has, NULL for the others; one that has none of them
    is skipped and its rows are not numbered.  There is one scan for each set of columns, and the
    numbers go on from file to file in the order of their names.
    """
    groups = files.by_columns(spark, paths, tuple(columns))
    scans = [spark.read.parquet(*some).select([c for c, _ in present]) for present, some in groups.items() if present]
    if not scans:
        raise ValueError("the raw files have none of the fact columns")
    named = [rows.withColumnsRenamed(dict(columns)) for rows in number_files(scans, "trip_id", first, limit)]
    named = [rows.withColumns({c: F.col(c).cast("int") for c in ints if c in rows.columns}) for rows in named]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def load_star_fact(
    spark: SparkSession,
    fact: DataFrame,
    path: str,
    cluster_by: tuple[str, ...],
    source_bytes: int = 0,
) -> DataFrame:
    """Write the fact clustered, and read it back."""
    write_clustered(fact, path, cluster_by, unique=["trip_id"], source_bytes=source_bytes)
    return spark.read.parquet(path)


def load_star_dimension(
    spark: SparkSession, dim: DataFrame, path: str, key: str, not_null: tuple[str, ...] = ()
) -> DataFrame:
    """Copy a dimension into the star, ordered by its key.

    It replaces what was there, and is refused if a key is missing or occurs twice:
    loading it again cannot multiply revenue.
    """
    write_clustered(require_valid(dim, key, not_null), path, [key])
    return spark.read.parquet(path)


def load_capped(
    spark: SparkSession,
    scan: DataFrame,
    path: str,
    limit: int | None = None,
    chunk: int = LOAD_CHUNK,
) -> DataFrame:
    """Append the first ``limit`` rows in file order, in files of ``chunk`` rows.

    The numbers go on from the highest that was loaded before.
    """
    first = 1
    if finished(spark, path):
        first += spark.read.parquet(path).agg(F.coalesce(F.max("trip_id"), F.lit(0))).first()[0]
    append_chunked(number_by_file(scan, "trip_id", first, limit), path, chunk)
    return spark.read.parquet(path)


def finished_loads(spark: SparkSession, path: str) -> list[str]:
    """Names of the loads below ``path`` that have come to their end, in their order."""
    markers = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/load=*/_SUCCESS")
    found = markers.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(markers)
    return sorted(f.getPath().getParent().getName().removeprefix("load=") for f in found or ())


def read_loads(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all finished loads, with the name of the ``load``."""
    loads = [f"{path}/load={name}" for name in finished_loads(spark, path)]
    name = F.regexp_extract(files.file_path(), r"/load=([^/]+)/[^/]*$", 1)
    return files.scan_files(spark, loads).withColumn("load", name)


def load_batch(
    spark: SparkSession,
    scan: DataFrame,
    path: str,
    load: str,
    limit: int | None = None,
    chunk: int = LOAD_CHUNK,
) -> DataFrame:
    """Load the first ``limit`` rows in file order as the load of that name; a load may run again.

    Each load has a folder of its own, which a repeated run replaces; one that died is not read.
    Loads are in the order of their names, and numbers go on from the loads before.  So a load runs
    again with the numbers it had, and is refused, before anything is written, if its rows do not
    fit between those of its neighbours.
    """
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", load):
        raise ValueError(f"{load!r} cannot name a load: letters, digits, dots, dashes and underscores can")

    def numbered(names: list[str], pick) -> int | None:
        paths = [f"{path}/load={name}" for name in names]
        return spark.read.parquet(*paths).agg(pick("trip_id")).first()[0] if paths else None

    done = finished_loads(spark, path)
    first = 1 + (numbered([name for name in done if name < load], F.max) or 0)
    after = numbered([name for name in done if name > load], F.min)
    if after is not None:
        n_rows = scan.count() if limit is None else min(scan.count(), limit)
        if first + n_rows != after:
            raise ValueError(f"load {load} has {n_rows} rows, and there are {after - first} numbers before the next one")
    rows = number_by_file(scan, "trip_id", first, limit)
    rows.write.mode("overwrite").option("maxRecordsPerFile", chunk).parquet(f"{path}/load={load}")
    return read_loads(spark, path)
