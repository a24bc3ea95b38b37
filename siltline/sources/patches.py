"""Entity documents and partial updates.

A patch row is ``tenant, patch_id, entity_id, entity_type, op, body, ts``: ``op`` is
create, patch or delete, ``body`` the JSON document ``{attr: {type, value}}`` with
whatever attributes the sender changed, ``patch_id`` the unique order of arrival.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from siltline.functions import attributes as A

PATCH_SCHEMA = (
    "tenant string, patch_id bigint, entity_id string, entity_type string, "
    "op string, body string, ts timestamp_ntz"
)
ENTITY = ["tenant", "entity_id"]
# Attribute name under which a delete is kept; attribute names are never empty.
TOMBSTONE = ""


def with_attrs(patches: DataFrame) -> DataFrame:
    """Parse the body once, into ``attrs``: a map from name to (type, value)."""
    return patches.withColumn("attrs", F.from_json("body", A.ATTRS_SCHEMA)).drop("body")


def explode_attrs(patches: DataFrame) -> DataFrame:
    """One row per changed attribute; a delete gives one row named TOMBSTONE.

    Nested values (addresses, points) stay JSON text.
    """
    deleted = F.create_map(
        F.lit(TOMBSTONE),
        F.struct(F.lit(None).cast("string").alias("type"), F.lit(None).cast("string").alias("value")),
    )
    attrs = F.when(F.col("op") == "delete", deleted).otherwise(F.col("attrs"))
    return (
        with_attrs(patches)
        .select(
            "tenant", "patch_id", "entity_id", "entity_type", "op", "ts",
            F.explode(attrs).alias("attr", "cell"),
        )
        .select(
            "tenant", "patch_id", "entity_id", "entity_type", "op", "ts", "attr",
            F.col("cell.type").alias("attr_type"),
            F.col("cell.value").alias("value"),
        )
    )


def typed(events: DataFrame) -> DataFrame:
    """Add one column per attribute type: number, time and text."""
    tag, value = F.col("attr_type"), F.col("value")
    return events.withColumns(
        {
            "number": A.number_value(tag, value),
            "time": A.time_value(tag, value),
            "text": A.text_value(tag, value),
        }
    )
