"""JSON Schema compiled to Spark types and checks.

Keywords: type, required, properties, items, minItems, minimum and
``additionalProperties: false``.
"""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import payload as P
from tidelog.functions.scalars import let

ERRORS = "array<struct<path:string,rule:string>>"
KINDS = {"string": ("STRING",), "boolean": ("BOOLEAN",), "null": ("VOID",),
         "integer": ("BIGINT",), "number": P.NUMBERS, "array": ("ARRAY",), "object": ("OBJECT",)}


def parsed_schema(schema: str | dict | None) -> dict | None:
    return json.loads(schema) if isinstance(schema, str) else schema


def spark_type(schema: dict | None) -> T.DataType:
    """The Spark type a valid payload is read as; VARIANT where the schema leaves it open."""
    kind = (schema or {}).get("type")
    plain = {"string": T.StringType(), "boolean": T.BooleanType(), "integer": T.LongType(),
             "number": T.DoubleType()}
    if isinstance(kind, str) and kind in plain:
        return plain[kind]
    if kind == "array" and "items" in schema:
        return T.ArrayType(spark_type(schema["items"]))
    if kind == "array":
        return T.ArrayType(T.VariantType())
    if kind == "object" and schema.get("properties"):
        return T.StructType([T.StructField(n, spark_type(s))
                             for n, s in schema["properties"].items()])
    return T.VariantType()


def errors(payload: Column, schema: str | dict | None) -> Column:
    """Every broken rule with its path; a payload that is no JSON breaks ``json``."""
    schema = parsed_schema(schema)
    bad = F.array(F.struct(F.lit("").alias("path"), F.lit("json").alias("rule")))
    none = F.array().cast(ERRORS)
    checked = lambda v: _errors(v, schema, F.lit("")) if schema else none
    return F.when(payload.isNull(), none).otherwise(let(
        P.parsed(payload), lambda v: F.when(v.isNull(), bad).otherwise(checked(v))))


def _rule(broken: Column, path: Column, rule: str) -> Column:
    one = F.array(F.struct(path.alias("path"), F.lit(rule).alias("rule")))
    return F.when(broken, one).otherwise(F.array().cast(ERRORS))


# Keywords that are checked, and those that say nothing about a payload.
CHECKED = frozenset("type minimum minItems items required properties additionalProperties".split())
SILENT = frozenset("$schema $id $comment title description default examples".split())


def _errors(v: Column, schema: dict, path: Column) -> Column:
    unknown = sorted(set(schema) - CHECKED - SILENT)
    if unknown:
        raise ValueError(f"schema keywords that are not checked: {', '.join(unknown)}")
    parts = []
    kind = P.kind(v)
    if "type" in schema:
        types = schema["type"] if isinstance(schema["type"], list) else [schema["type"]]
        allowed = [k for t in types for k in KINDS[t]]
        parts.append(_rule(~kind.isin(*allowed), path, "type"))
    if "minimum" in schema:
        low = kind.isin(*P.NUMBERS) & (P.get(v, "double") < F.lit(float(schema["minimum"])))
        parts.append(_rule(F.coalesce(low, F.lit(False)), path, "minimum"))
    if "minItems" in schema:
        few = (kind == "ARRAY") & (F.size(P.items(v)) < schema["minItems"])
        parts.append(_rule(F.coalesce(few, F.lit(False)), path, "minItems"))
    if "items" in schema:
        each = F.flatten(F.transform(P.items(v), lambda x, i: _errors(
            x, schema["items"], F.concat(path, F.lit("/"), i.cast("string")))))
        parts.append(F.coalesce(each, F.array().cast(ERRORS)))
    if any(k in schema for k in ("required", "properties", "additionalProperties")):
        parts.append(let(P.fields(v), lambda m: _field_errors(m, schema, path)))
    return F.concat(*parts) if parts else F.array().cast(ERRORS)


def _field_errors(m: Column, schema: dict, path: Column) -> Column:
    """The errors of an object's fields; none for what is no object."""
    none = F.array().cast(ERRORS)
    parts = [none]
    for name in schema.get("required", ()):
        lacking = ~F.map_contains_key(m, name)
        parts.append(_rule(F.coalesce(lacking, F.lit(False)), F.concat(path, F.lit(f"/{name}")),
                           "required"))
    for name, sub in schema.get("properties", {}).items():
        x = F.element_at(m, name)
        parts.append(F.when(x.isNotNull(), _errors(x, sub, F.concat(path, F.lit(f"/{name}"))))
                     .otherwise(none))
    if schema.get("additionalProperties") is False:
        known = F.array(*[F.lit(n) for n in schema.get("properties", {})]).cast("array<string>")
        more = F.transform(F.array_except(F.map_keys(m), known), lambda k: F.struct(
            F.concat(path, F.lit("/"), k).alias("path"),
            F.lit("additionalProperties").alias("rule")))
        parts.append(F.coalesce(more, none))
    return F.concat(*parts)


def value(payload: Column, schema: str | dict | None) -> Column:
    """The payload in the schema's Spark type."""
    t = spark_type(parsed_schema(schema))
    v = P.parsed(payload)
    return v if isinstance(t, T.VariantType) else P.get(v, t.simpleString())
