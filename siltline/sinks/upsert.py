"""Keyed upserts without a transactional table format."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from siltline.sources import files


def last_per_key(source: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """The row with the highest ``seq`` of every key, ``seq`` dropped."""
    values = [c for c in source.columns if c not in keys and c != seq]
    latest = source.groupBy(*keys).agg(F.max_by(F.struct(*values), seq).alias("row"))
    return latest.select(*keys, *[F.col(f"row.{c}").alias(c) for c in values])


def _matching(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Join by all columns of ``keys``; NULL matches NULL."""
    named = {c: f"_{c}" for c in keys.columns}
    same = [rows[c].eqNullSafe(F.col(other)) for c, other in named.items()]
    return rows.join(keys.withColumnsRenamed(named), reduce(and_, same), how)


def upserted(target: DataFrame, source: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """``target`` with the rows of ``source`` inserted, or replacing those of equal key; NULL is a key."""
    latest = last_per_key(source, keys, seq)
    return _matching(target, latest.select(*keys), "left_anti").unionByName(latest)


def upsert_table(
    spark: SparkSession, name: str, source: DataFrame, keys: Sequence[str], seq: str
) -> DataFrame:
    """Upsert into a registered Parquet table.

    What changes is written to a new location beside the table's, and published by moving the
    table there, or each partition the source touches: files that a reader may have open are never
    overwritten, and a run that dies before that leaves the old rows.  One that dies between two
    partitions leaves whole ones, and run again it gives the same rows.  Partition columns must be
    among the keys: then no row changes its partition.  Replaced files stay until they are deleted.
    """
    target = spark.table(name)
    details = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    place = re.sub(r"(--[0-9a-f]{12})?/*$", "", details["Location"])
    path = f"{place}--{uuid.uuid4().hex[:12]}"
    by = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    if not by:
        upserted(target, source, keys, seq).write.parquet(path)
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    else:
        if not set(by) <= set(keys):
            raise ValueError(f"partition columns {by} of {name} are not all among the keys {list(keys)}")
        values = source.select(*by).distinct()
        touched = _matching(target.filter(_among(values, by)), values, "left_semi")
        rows = upserted(touched, source, keys, seq)
        typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema]
        rows.select(*typed).write.partitionBy(*by).parquet(path)
        for values_of, folder in _folders(spark, path, target.schema, by):
            _publish(spark, name, values_of, folder)
    spark.catalog.refreshTable(name)
    return spark.table(name)


def _among(values: DataFrame, by: Sequence[str]) -> Column:
    """Whether each partition column has one of its new values: literals, so that partitions are pruned."""
    found = [[r[0] for r in values.select(c).distinct().collect()] for c in by]
    known = [F.col(c).isin([v for v in some if v is not None]) for c, some in zip(by, found)]
    null = [F.col(c).isNull() if None in some else F.lit(False) for c, some in zip(by, found)]
    return reduce(and_, [k | n for k, n in zip(known, null)], F.lit(True))


def _folders(
    spark: SparkSession, path: str, schema: StructType, by: Sequence[str]
) -> list[tuple[dict[str, str | None], str]]:
    """The partitions written to a path: their values as text, and their folder."""
    folder = F.regexp_extract(files.file_path(), "^(.*)/[^/]*$", 1)
    rows = spark.read.schema(schema).parquet(path)
    rows = rows.select(*[F.col(c).cast("string").alias(c) for c in by], folder.alias("_folder")).distinct().collect()
    return [({c: r[c] for c in by}, unquote(r["_folder"])) for r in rows]  # file paths come as URIs


def _publish(spark: SparkSession, name: str, values: dict[str, str | None], folder: str) -> None:
    """Let a partition of a table be read from a folder."""

    def text(value: str) -> str:
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    spec = ", ".join(f"`{c}` = {'null' if v is None else text(v)}" for c, v in values.items())
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({spec})")
    spark.sql(f"ALTER TABLE {name} PARTITION ({spec}) SET LOCATION {text(folder)}")
