"""Tables written to the folder that all executors share."""

from pyspark.sql import Column, DataFrame, functions as F

from siltline import scratch


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read again: it survives lost executors."""
    spark = df.sparkSession
    path = scratch.new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def side(df: DataFrame, name: str, size: Column, most: int) -> DataFrame:
    """The table written and read again; broadcast if its ``size``, summed up, is ``most`` at most.

    A larger one is left to be shuffled, with the same result.
    """
    df = stored(df, name)
    total = df.agg(F.coalesce(F.sum(size.cast("bigint")), F.lit(0))).first()[0]
    return F.broadcast(df) if total <= most else df
