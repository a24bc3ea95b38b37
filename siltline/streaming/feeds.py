"""Streams over a folder of patch files.

Every query runs with ``availableNow``: it takes what is there, in micro-batches, and
stops; started again on the same checkpoint it takes only what is new.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from siltline.operators.state import latest_attrs, live_attrs
from siltline.operators.subscriptions import Subscription, notifications
from siltline.sources.patches import PATCH_SCHEMA, explode_attrs

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def patch_stream(
    spark: SparkSession, folder: str, schema: str = PATCH_SCHEMA, files_per_batch: int = 1_000
) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def _trigger(every: str | None) -> dict:
    """All that is there and no more, or again and again after an interval."""
    return {"availableNow": True} if every is None else {"processingTime": every}


def start_changes(
    changes: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Write each batch's changed rows to a partition of its own.

    A batch that is replayed after a failure overwrites the partition it wrote before.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    # Where state expires by time, Spark would run empty batches without end; it expires at the next
    # batch with rows as well.
    settings = {PROVIDER: ROCKSDB, EMPTY_BATCHES: "false"}
    spark = changes.sparkSession
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        return (
            changes.writeStream.outputMode("update")
            .foreachBatch(publish)
            .option("checkpointLocation", checkpoint)
            .trigger(**_trigger(every))
            .start()
        )
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def start_state(
    patches: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Maintain the last value per entity and attribute; ``every`` keeps the stream running.

    The state store holds one row per entity and attribute; a batch writes only the
    rows it changed.
    """
    return start_changes(latest_attrs(explode_attrs(patches)), path, checkpoint, every)


def _changes(spark: SparkSession, path: str, base: str | None, after: int) -> DataFrame:
    """What ``start_state`` wrote after a batch, and the compacted table up to it."""
    changes = spark.read.parquet(path).filter(F.col("batch_id") > after).drop("batch_id")
    return changes if base is None else changes.unionByName(spark.read.parquet(base))


def read_state(
    spark: SparkSession, path: str, base: str | None = None, after: int = -1
) -> DataFrame:
    """Current state of all live entities from what ``start_state`` wrote.

    With a compacted ``base``, only the partitions of later batches are read.
    """
    return live_attrs(latest_attrs(_changes(spark, path, base, after)))


def compact_state(
    spark: SparkSession, path: str, target: str, base: str | None = None, after: int = -1
) -> int:
    """Write the state so far as a table with a row per entity and attribute.

    Returns the last batch it contains: pass both to ``read_state``, or to the next
    compaction.  Earlier batches may then be deleted.  Run it between runs of the
    stream, not beside one.
    """
    batches = spark.read.parquet(path).agg(F.max("batch_id")).first()[0]
    latest_attrs(_changes(spark, path, base, after)).write.parquet(target)
    return max(after, batches)


def start_update_count(
    patches: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Maintain the number of updates per entity.

    A built-in streaming count: partial sums are made before the shuffle, and no
    Python runs in the executors.
    """
    counts = patches.groupBy("tenant", "entity_id").agg(F.count("*").alias("n_updates"))
    return start_changes(counts, path, checkpoint, every)


def read_update_count(spark: SparkSession, path: str) -> DataFrame:
    """Counts only grow, so the newest of an entity is its largest."""
    changes = spark.read.parquet(path)
    return changes.groupBy("tenant", "entity_id").agg(F.max("n_updates").alias("n_updates"))


def start_history(
    patches: DataFrame,
    subscription: Subscription,
    path: str,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Append one row per notification, by tenant.  Stateless, each row exactly once."""
    return (
        notifications(patches, subscription)
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("tenant")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .start()
    )
