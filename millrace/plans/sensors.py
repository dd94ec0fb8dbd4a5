"""Nested sensor readings to a flat table, as one select of built-in expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import item_at, join_all, seconds_to_millis, split_once, split_part, strip, without, zero_pad
from ..operators.shaping import apply_mapping, drop_null_fields, resolve_choice

# The layout of a reading, and the target names and types.
READING = ("timestamp BIGINT, temperature DOUBLE, "
           "sensor STRUCT<number: INT, location: ARRAY<STRING>, address: STRING>")
TARGET = [
    ("at_millis", "bigint", "timestamp", "timestamp"), ("id_digits", "string", "sensorid", "bigint"),
    ("label", "string", "sensorname", "string"), ("lat_text", "string", "latitude", "decimal(8,4)"),
    ("lng_text", "string", "longitude", "decimal(8,4)"), ("address_block", "string", "block", "string"),
    ("address_street", "string", "street", "string"), ("address_city", "string", "city", "string"),
    ("address_state", "string", "state", "string"), ("temperature", "double", "temperature", "double"),
    ("sensor.number", "int", "number", "int"), ("sensor.location", "array", "location", "string"),
    ("sensor.address", "string", "address", "string"),
]


def derived(readings: DataFrame) -> DataFrame:
    """Add the parts of location and address, the sensor id and name, and milliseconds."""
    latitude, longitude = item_at("sensor.location", 0), item_at("sensor.location", 1)
    number = zero_pad("sensor.number", 2)
    first = split_part("sensor.address", ",", 0)
    parts = {
        "lat_text": latitude,
        "lng_text": longitude,
        # Fraction digits of both coordinates, then the number; as a whole number it loses leading zeros.
        "id_digits": F.concat(split_part(latitude, ".", 1), split_part(longitude, ".", 1), number),
        "address_block": strip(split_once(first, " ", 0)),
        "address_street": strip(split_once(first, " ", 1)),
        "address_city": strip(split_part("sensor.address", ",", 1)),
        "address_state": strip(split_part("sensor.address", ",", 2)),
        "at_millis": seconds_to_millis("timestamp"),
    }
    return readings.withColumns(parts).withColumn(
        "label", join_all("-", "address_state", "address_city", without("address_street", " "), "address_block", number)
    )


def flatten(readings: DataFrame) -> DataFrame:
    """Flat rows; a part that is missing from the input gives NULL instead of a failed job."""
    return drop_null_fields(resolve_choice(apply_mapping(derived(readings), TARGET), choice="make_cols"))
