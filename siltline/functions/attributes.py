"""Expressions over entity attributes, ``{name: {type, value}}`` documents."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from siltline.functions.calendar import iso_to_utc

# The attribute type tags.
NUMBER = "Number"
TEXT = "Text"
DATE_TIME = "DateTime"
STRUCTURED = "StructuredValue"
GEO_JSON = "geo:json"

ATTRS_SCHEMA = "map<string, struct<type: string, value: string>>"
ADDRESS_SCHEMA = "struct<addressCountry: string, addressLocality: string, streetAddress: string>"


def number_value(attr_type: Column, value: Column) -> Column:
    """The value of a Number attribute; NULL for other tags and for bad text."""
    return F.when(attr_type == NUMBER, value.try_cast("double"))


def time_value(attr_type: Column, value: Column) -> Column:
    return F.when(attr_type == DATE_TIME, iso_to_utc(value))


def text_value(attr_type: Column, value: Column) -> Column:
    return F.when(attr_type == TEXT, value)


def attribute(attr_type: str, value: Column) -> Column:
    return F.struct(F.lit(attr_type).alias("type"), value.alias("value"))


def document(attrs: dict[str, Column]) -> Column:
    """The JSON document of an entity or patch; attributes that are NULL are left out."""
    return F.to_json(F.struct(*[attr.alias(name) for name, attr in attrs.items()]))


def geo_point(longitude: Column, latitude: Column) -> Column:
    """Point value: longitude first, then latitude."""
    return F.struct(
        F.lit("Point").alias("type"),
        F.array(longitude, latitude).alias("coordinates"),
    )


def point_longitude(value: Column) -> Column:
    return F.get_json_object(value, "$.coordinates[0]").try_cast("double")


def point_latitude(value: Column) -> Column:
    return F.get_json_object(value, "$.coordinates[1]").try_cast("double")


def address(value: Column) -> Column:
    return F.from_json(value, ADDRESS_SCHEMA)


def history_table_name(tenant: Column, entity_type: Column) -> Column:
    """Name of the history table of one entity type of one tenant."""
    return F.concat(F.lit("mt"), tenant, F.lit(".et"), F.lower(entity_type))
