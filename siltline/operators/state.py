"""Current state of entities from their attribute events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from siltline.sources.patches import ENTITY, TOMBSTONE


def latest_values(
    events: DataFrame, keys: Sequence[str], values: Sequence[str], seq: str
) -> DataFrame:
    """The row with the highest ``seq`` of every key.

    Values of fixed width (numbers, times) are kept in hash tables; with a text among
    them Spark sorts each partition instead.  Either way every scan task sends one row
    per key.
    """
    return events.groupBy(*keys).agg(
        *[F.max_by(c, seq).alias(c) for c in values], F.max(seq).alias(seq)
    )


def latest_attrs(events: DataFrame) -> DataFrame:
    """The last value of every attribute of every entity, and its patch number.

    ``events`` are exploded patches.  Disorder does not matter: the highest
    ``patch_id`` wins, and it can be fed its own output plus newer events.
    """
    return latest_values(
        events, [*ENTITY, "attr"], ["entity_type", "attr_type", "value", "ts"], "patch_id"
    )


def live_attrs(latest: DataFrame) -> DataFrame:
    """Drop what was set before the entity's last delete, and the tombstones.

    The window holds one row per attribute name of the entity, not its events.
    """
    of_entity = Window.partitionBy(*ENTITY)
    deleted = F.max(F.when(F.col("attr") == TOMBSTONE, F.col("patch_id"))).over(of_entity)
    return (
        latest.withColumn("_deleted", deleted)
        .filter(F.col("attr") != TOMBSTONE)
        .filter(F.col("_deleted").isNull() | (F.col("patch_id") > F.col("_deleted")))
        .drop("_deleted")
    )


def current_state(events: DataFrame) -> DataFrame:
    """One row per entity and live attribute."""
    return live_attrs(latest_attrs(events))


def wide_state(state: DataFrame, columns: dict[str, Column], names: Sequence[str]) -> DataFrame:
    """One row per entity, one column per attribute name.

    ``columns`` maps a suffix to the expression to show, e.g. the number of the value.
    """
    cells = [
        F.max(F.when(F.col("attr") == name, expr)).alias(f"{name}{suffix}")
        for name in names
        for suffix, expr in columns.items()
    ]
    return state.groupBy(*ENTITY).agg(*cells)


def latest_numbers(
    events: DataFrame, keys: Sequence[str], attr: str, number: str, seq: str, names: Sequence[str]
) -> DataFrame:
    """Last number of each named attribute as a column, one row per entity.

    One hash aggregation over fixed-width buffers; nothing is sorted.
    """
    return events.groupBy(*keys).agg(
        *[
            F.max_by(number, F.when(F.col(attr) == name, F.col(seq))).alias(name)
            for name in names
        ]
    )


def list_entities(
    state: DataFrame,
    entity_type: str | None = None,
    tenant: str | None = None,
    after: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Entities of a tenant (or of all) by optional type, in order of id.

    ``after`` and ``limit`` give pages: those behind the last id of the page before.
    """
    rows = _scoped(state, tenant, entity_type)
    rows = rows if after is None else rows.filter(F.col("entity_id") > after)
    listed = rows.groupBy(*ENTITY).agg(F.count("*").alias("n_attrs")).orderBy(*ENTITY)
    return listed if limit is None else listed.limit(limit)


def get_entity(
    state: DataFrame, entity_id: str, entity_type: str | None = None, tenant: str | None = None
) -> DataFrame:
    """The live attributes of one entity, optionally only if it is of a type or tenant."""
    return _scoped(state, tenant, entity_type).filter(F.col("entity_id") == entity_id)


def _scoped(state: DataFrame, tenant: str | None, entity_type: str | None) -> DataFrame:
    rows = state if tenant is None else state.filter(F.col("tenant") == tenant)
    return rows if entity_type is None else rows.filter(F.col("entity_type") == entity_type)
