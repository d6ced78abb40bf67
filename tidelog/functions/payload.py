"""Looking into JSON payloads as VARIANT columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBERS = ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT")
# What a payload's type is called in messages.
SPOKEN = {"VOID": "null", "BOOLEAN": "boolean", "BIGINT": "integer", "DECIMAL": "number",
          "DOUBLE": "number", "FLOAT": "number", "STRING": "string", "ARRAY": "array",
          "OBJECT": "object"}


def parsed(payload: Column) -> Column:
    """The payload as a VARIANT; null when it is null or not JSON."""
    return F.try_parse_json(payload)


def kind(v: Column) -> Column:
    """VOID, BOOLEAN, BIGINT, DECIMAL, DOUBLE, STRING, ARRAY or OBJECT; null if absent."""
    return F.substring_index(F.substring_index(F.schema_of_variant(v), "<", 1), "(", 1)


def spoken(v: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in SPOKEN.items() for x in pair])
    return F.coalesce(F.element_at(names, kind(v)), F.lit("missing"))


def get(v: Column, ddl: str) -> Column:
    return F.try_variant_get(v, "$", ddl)


def fields(v: Column) -> Column:
    return get(v, "map<string,variant>")


def items(v: Column) -> Column:
    return get(v, "array<variant>")


def absent(v: Column) -> Column:
    """Missing, or a JSON null."""
    return v.isNull() | F.is_variant_null(v)
