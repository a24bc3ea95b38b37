"""Session settings this library is tuned for.

Every operator also runs on a session somebody else built; nothing here is
required for correct results.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Key-set lookups push IN lists of 50 keys; the default of 10 would only push min/max.
    "spark.sql.parquet.pushdown.inFilterThreshold": "128",
    # Do not record a Python stack trace for every column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Streaming state lives on disk beside the executor instead of on its heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(
    app_name: str = "siltline",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session; leave ``master`` unset under spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(SETTINGS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra or {})
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
