"""The given tables in the shapes the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from siltline import scratch
from siltline.functions import attributes as A
from siltline.functions import calendar as C
from siltline.sinks.layouts import write_partitioned
from siltline.sources import files

# The event types of the given events table, used as attribute names.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
ENTITY_TYPE = "AirQualityObserved"
TENANTS = 3
# Of events; the documents are larger.  A file is written by one task and, as it has one row group, read by one.
PATCH_FILE_BYTES = 2 * 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def monthly_orders(spark: SparkSession, sf_dir: str) -> str:
    """Folder with the orders in one Parquet folder per month, named like monthly files."""

    def write(path: str) -> None:
        orders = table(spark, sf_dir, "orders")
        month = C.month_label(C.month_start(F.col("o_orderdate")))
        name = F.concat(F.lit("orders_tripdata_"), month, F.lit(".parquet"))
        write_partitioned(orders.withColumn("file", name), path, ["file"])

    return scratch.write_once(spark, "monthly-orders", sf_dir, write)


def patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as entity patches: a signup creates, an error deletes, others update."""
    return patches_of(table(spark, sf_dir, "events"))


def patches_of(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    numbers = {
        name: F.when(kind == name, A.attribute(A.NUMBER, F.col("value"))) for name in EVENT_TYPES
    }
    body = A.document(
        {
            **numbers,
            "dateObserved": A.attribute(A.DATE_TIME, C.iso_utc_text(F.col("ts"))),
            "source": A.attribute(A.TEXT, F.col("props")),
        }
    )
    return events.select(
        tenant().alias("tenant"),
        F.col("event_id").alias("patch_id"),
        entity_id().alias("entity_id"),
        F.lit(ENTITY_TYPE).alias("entity_type"),
        F.when(kind == "signup", "create").when(kind == "error", "delete").otherwise("patch").alias("op"),
        body.alias("body"),
        "ts",
    )


def tenant():
    return F.concat(F.lit("t"), F.pmod("user_id", F.lit(TENANTS)))


def entity_id():
    return F.concat(F.lit("user-"), F.col("user_id"))


def attr_events(spark: SparkSession, sf_dir: str, user: int | None = None) -> DataFrame:
    """Events as attribute events: one per event, named by its type; of one entity if asked for."""
    events = table(spark, sf_dir, "events")
    events = events if user is None else events.filter(F.col("user_id") == user)
    return events.select(
        tenant().alias("tenant"),
        F.col("event_id").alias("patch_id"),
        entity_id().alias("entity_id"),
        F.lit(ENTITY_TYPE).alias("entity_type"),
        F.lit("patch").alias("op"),
        "ts",
        F.col("event_type").alias("attr"),
        F.lit(A.NUMBER).alias("attr_type"),
        F.col("value").cast("string").alias("value"),
        F.col("value").alias("number"),
    )


def history(spark: SparkSession, sf_dir: str, user: int | None = None) -> DataFrame:
    """Events as history rows: one attribute column is set, the others are NULL.

    With ``user`` only those of one entity, chosen by the column that the files hold.
    """
    events = table(spark, sf_dir, "events")
    events = events if user is None else events.filter(F.col("user_id") == user)
    return events.select(
        tenant().alias("tenant"),
        entity_id().alias("entity_id"),
        F.col("event_id").alias("patch_id"),
        F.col("ts").alias("time_index"),
        *[F.when(F.col("event_type") == n, F.col("value")).alias(n) for n in EVENT_TYPES],
    )


def patch_folder(spark: SparkSession, sf_dir: str, batches: int = 4) -> tuple[str, int]:
    """Folder with the patches as files to stream, and files per micro-batch.

    A stream takes files in the order of their age, and streams of entities take a patch that comes
    after newer ones for a late one.  So the patches of a micro-batch are written before those of the
    next; the tasks of one job end in any order.
    """
    size = files.total_bytes(spark, f"{sf_dir}/events.parquet")
    per_batch = max(1, -(-size // (batches * PATCH_FILE_BYTES)))

    def write(path: str) -> None:
        events = table(spark, sf_dir, "events")
        shares = [k / batches for k in range(1, batches)]
        borders = events.agg(F.percentile_approx("event_id", shares)).first()[0] or []
        number = F.col("event_id")
        for low, high in zip([None, *borders], [*borders, None]):
            # The files' statistics leave out what a comparison with the column excludes; NULL comes first.
            some = events if low is None else events.filter(number > low)
            if high is not None:
                some = some.filter((number <= high) | number.isNull() if low is None else number <= high)
            patches_of(some.repartition(per_batch)).write.mode("append").parquet(path)

    return scratch.write_once(spark, "patches", sf_dir, write), per_batch
