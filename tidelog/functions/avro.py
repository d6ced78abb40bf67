"""Avro schemas compiled to Spark types, checks and conversions.

``compiled(schema)`` turns an Avro schema text into a tree of types.  Each type
knows its Spark type and builds three column expressions over a JSON payload:
does it match, which errors it has (with their paths), and its typed value.
Everything runs as built-in functions; Avro bytes need the external package.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import payload as P
from tidelog.functions.scalars import canonical_uuid, is_uuid, let

ERRORS = "array<struct<path:string,message:string>>"


def mangled(name: Column | str):
    """Dashes become underscores, as Avro names need it."""
    return name.replace("-", "_") if isinstance(name, str) else F.translate(name, "-", "_")


def unmangled(name: Column | str):
    return name.replace("_", "-") if isinstance(name, str) else F.translate(name, "_", "-")


def renamed(t: T.DataType, fn: Callable[[str], str]) -> T.DataType:
    """A type with every field name passed through ``fn``; cast to it to rename."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(fn(f.name), renamed(f.dataType, fn), f.nullable)
                             for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(renamed(t.elementType, fn), t.containsNull)
    if isinstance(t, T.MapType):
        return T.MapType(t.keyType, renamed(t.valueType, fn), t.valueContainsNull)
    return t


def no_errors() -> Column:
    return F.array().cast(ERRORS)


def error(path: Column, *message) -> Column:
    text = F.concat(*[m if isinstance(m, Column) else F.lit(m) for m in message])
    return F.array(F.struct(path.alias("path"), text.alias("message")))


def _step(path: Column, name) -> Column:
    return F.concat(path, F.lit("/"), name.cast("string") if isinstance(name, Column)
                    else F.lit(name))


class AvroType:
    """One node of a compiled schema."""

    name: str
    spark: T.DataType

    def matches(self, v: Column) -> Column:
        raise NotImplementedError

    def value(self, v: Column) -> Column:
        raise NotImplementedError

    def errors(self, v: Column, path: Column) -> Column:
        return F.when(self.matches(v), no_errors()).otherwise(
            error(path, P.spoken(v), f" where the schema wants {self.name}"))

    def tagged(self, value: Column) -> Column:
        """The typed value as Avro's JSON writes it (union members under their type's name)."""
        return value

    def untagged(self, v: Column) -> Column:
        """The typed value of an Avro JSON payload."""
        return self.value(v)


class Scalar(AvroType):
    def __init__(self, name: str, spark: T.DataType, kinds: tuple[str, ...]):
        self.name, self.spark, self.kinds = name, spark, kinds

    def matches(self, v):
        return F.coalesce(P.kind(v).isin(*self.kinds), F.lit(False))

    def value(self, v):
        return P.get(v, self.spark.simpleString())


class Whole(Scalar):
    """int and long: any number whose integral part is in range."""

    @property
    def top(self) -> int:
        return 2 ** 31 if self.name == "int" else 2 ** 63

    def matches(self, v):
        # beyond the bounds by a whole one: what is cut off towards nought still counts
        number = F.when(P.kind(v).isin(*self.kinds), P.get(v, "decimal(38,9)"))
        low, high = (F.lit(str(n)).cast("decimal(38,9)") for n in (-self.top - 1, self.top))
        return F.coalesce(let(number, lambda n: (n > low) & (n < high)), F.lit(False))

    def value(self, v):
        low, high = (F.lit(str(n)).cast("decimal(38,9)") for n in (-self.top - 1, self.top))
        number = F.when(P.kind(v).isin(*self.kinds), P.get(v, "decimal(38,9)"))
        return let(number, lambda n: F.when((n > low) & (n < high), F.when(
            n < 0, F.ceil(n)).otherwise(F.floor(n))).cast(self.spark))


class Bytes(Scalar):
    def value(self, v):
        return F.encode(P.get(v, "string"), "ISO-8859-1")

    def tagged(self, value):
        return F.decode(value, "ISO-8859-1")


class Null(Scalar):
    def value(self, v):
        return F.lit(None).cast("void")


class Uuid(Scalar):
    def matches(self, v):
        return super().matches(v) & is_uuid(P.get(v, "string"))

    def value(self, v):
        return canonical_uuid(P.get(v, "string"))


class Anything(AvroType):
    """No schema: every payload is as it is."""

    name, spark = "anything", T.VariantType()

    def matches(self, v):
        return F.lit(True)

    def value(self, v):
        return v


class Enum(AvroType):
    spark = T.StringType()

    def __init__(self, name: str, symbols: list[str]):
        self.name, self.full_name, self.symbols = "enum", name, symbols

    def matches(self, v):
        text = mangled(P.get(v, "string"))
        return F.coalesce((P.kind(v) == "STRING") & text.isin(*self.symbols), F.lit(False))

    def value(self, v):
        return F.when(self.matches(v), unmangled(P.get(v, "string")))

    def tagged(self, value):
        return mangled(value)


class Array(AvroType):
    name = "array"

    def __init__(self, item: AvroType):
        self.item, self.spark = item, T.ArrayType(item.spark)

    def matches(self, v):
        return F.coalesce(P.kind(v) == "ARRAY", F.lit(False))

    def errors(self, v, path):
        each = F.flatten(F.transform(
            P.items(v), lambda x, i: self.item.errors(x, _step(path, i))))
        return F.when(self.matches(v), each).otherwise(super().errors(v, path))

    def value(self, v):
        return F.transform(P.items(v), self.item.value)

    def tagged(self, value):
        return F.transform(value, self.item.tagged)

    def untagged(self, v):
        return F.transform(P.items(v), self.item.untagged)


class Map(AvroType):
    name = "map"

    def __init__(self, item: AvroType):
        self.item, self.spark = item, T.MapType(T.StringType(), item.spark)

    def matches(self, v):
        return F.coalesce(P.kind(v) == "OBJECT", F.lit(False))

    def errors(self, v, path):
        each = F.flatten(F.transform(F.map_entries(P.fields(v)), lambda e: self.item.errors(
            e["value"], _step(path, e["key"]))))
        return F.when(self.matches(v), each).otherwise(super().errors(v, path))

    def value(self, v):
        return F.transform_values(P.fields(v), lambda k, x: self.item.value(x))

    def tagged(self, value):
        return F.transform_values(value, lambda k, x: self.item.tagged(x))

    def untagged(self, v):
        return F.transform_values(P.fields(v), lambda k, x: self.item.untagged(x))


class Record(AvroType):
    def __init__(self, name: str):
        self.name, self.full_name = "record", name
        self.fields: list[tuple[str, AvroType, tuple]] = []  # (name, type, (default,) or ())

    @property
    def spark(self):
        return T.StructType([T.StructField(n, t.spark) for n, t, _ in self.fields])

    def _fields(self, v: Column) -> Column:
        return F.transform_keys(P.fields(v), lambda k, _: mangled(k))

    def _known(self) -> Column:
        return F.array(*[F.lit(n) for n, _, _ in self.fields]).cast("array<string>")

    def matches(self, v):
        def all_met(m):
            met = F.size(F.array_except(F.map_keys(m), self._known())) == 0
            for name, t, default in self.fields:
                x = F.element_at(m, name)
                met = met & F.when(x.isNull(), F.lit(bool(default))).otherwise(t.matches(x))
            return met

        return F.when(P.kind(v) == "OBJECT", F.coalesce(let(self._fields(v), all_met), F.lit(False))
                      ).otherwise(F.lit(False))

    def errors(self, v, path):
        def all_errors(m):
            unknown = F.array_except(F.map_keys(m), self._known())
            parts = [F.flatten(F.transform(unknown, lambda k: error(
                path, "no field ", k, f" in {self.full_name}")))]
            for name, t, default in self.fields:
                x = F.element_at(m, name)
                lacking = no_errors() if default else error(
                    path, f"{name} is missing and has no default")
                parts.append(F.when(x.isNull(), lacking).otherwise(t.errors(x, _step(path, name))))
            return F.concat(*parts)

        return F.when(P.kind(v) == "OBJECT", let(self._fields(v), all_errors)).otherwise(
            error(path, P.spoken(v), " where the schema wants record"))

    def _built(self, v: Column, read: Callable[[AvroType, Column], Column]) -> Column:
        def struct(m):
            made = []
            for name, t, default in self.fields:
                x = F.element_at(m, name)
                value = read(t, x)
                if default and default[0] is not None:
                    fallback = read(t, F.parse_json(F.lit(json.dumps(default[0]))))
                    value = F.when(x.isNull(), fallback).otherwise(value)
                made.append(value.alias(name))
            return F.struct(*made)

        return F.when(P.kind(v) == "OBJECT", let(self._fields(v), struct))

    def value(self, v):
        return self._built(v, lambda t, x: t.value(x))

    def untagged(self, v):
        return self._built(v, lambda t, x: t.untagged(x))

    def tagged(self, value):
        return F.when(value.isNotNull(), F.struct(
            *[t.tagged(value[n]).alias(n) for n, t, _ in self.fields]))


# The Avro type behind the names used in messages.
_BASE = {"nil": "null", "bool": "boolean", "uuid": "string"}


class Union(AvroType):
    """The first branch that matches counts.

    Null and one other type is that type, nullable; a wider union is a struct
    with one nullable member per branch.
    """

    def __init__(self, branches: list[AvroType]):
        self.branches = branches
        self.name = "union [" + ", ".join(_BASE.get(b.name, b.name).upper()
                                          for b in branches) + "]"
        self.real = [b for b in branches if not isinstance(b, Null)]
        if len(self.real) == 1:
            self.spark = self.real[0].spark
        else:
            self.spark = T.StructType([T.StructField(self.tag(b), b.spark) for b in self.real])

    @staticmethod
    def tag(branch: AvroType) -> str:
        return getattr(branch, "full_name", branch.name)

    def matches(self, v):
        return reduce(lambda a, b: a | b, [b.matches(v) for b in self.branches])

    def errors(self, v, path):
        out = error(path, P.spoken(v), f" where the schema wants {self.name}")
        for b in reversed(self.branches):
            out = F.when(b.matches(v), b.errors(v, path)).otherwise(out)
        return out

    def value(self, v):
        if len(self.real) == 1:
            return F.when(self.real[0].matches(v), self.real[0].value(v))
        taken = F.lit(False)
        members = []
        for b in self.branches:
            if not isinstance(b, Null):
                members.append(F.when(b.matches(v) & ~taken, b.value(v)).alias(self.tag(b)))
            taken = taken | b.matches(v)
        return F.struct(*members)

    def tagged(self, value):
        if len(self.real) == 1:
            b = self.real[0]
            return F.when(value.isNotNull(), F.struct(b.tagged(value).alias(self.tag(b))))
        # only the member that is there may be written
        return F.coalesce(*[F.when(value[self.tag(b)].isNotNull(), F.to_variant_object(F.struct(
            b.tagged(value[self.tag(b)]).alias(self.tag(b))))) for b in self.real])

    def untagged(self, v):
        m = P.fields(v)
        made = [b.untagged(F.element_at(m, self.tag(b))) for b in self.real]
        if len(self.real) == 1:
            return made[0]
        return F.struct(*[x.alias(self.tag(b)) for b, x in zip(self.real, made)])


def _scalar(name: str) -> AvroType | None:
    numbers = P.NUMBERS
    return {
        "boolean": lambda: Scalar("bool", T.BooleanType(), ("BOOLEAN",)),
        "bytes": lambda: Bytes("bytes", T.BinaryType(), ("STRING",)),
        "double": lambda: Scalar("double", T.DoubleType(), ("DECIMAL", "DOUBLE", "FLOAT")),
        "float": lambda: Scalar("float", T.FloatType(), ("DECIMAL", "DOUBLE", "FLOAT")),
        "int": lambda: Whole("int", T.IntegerType(), numbers),
        "long": lambda: Whole("long", T.LongType(), numbers),
        "string": lambda: Scalar("string", T.StringType(), ("STRING",)),
        "null": lambda: Null("nil", T.NullType(), ("VOID",)),
    }.get(name, lambda: None)()


def compiled(schema: str | dict | list | None) -> AvroType:
    """Compile an Avro schema, given as JSON text or as parsed JSON."""
    if schema is None:
        return Anything()
    if isinstance(schema, str):
        try:
            schema = json.loads(schema)
        except ValueError:
            pass  # a bare type name
    return _compile(schema, {})


def _compile(schema, named: dict[str, AvroType]) -> AvroType:
    if isinstance(schema, list):
        return Union([_compile(s, named) for s in schema])
    if isinstance(schema, str):
        found = _scalar(schema) or named.get(schema)
        if found is None:
            raise ValueError(f"unknown Avro type {schema!r}")
        return found
    kind = schema["type"]
    if kind == "string" and str(schema.get("logicalType", "")).rpartition(".")[2].lower() == "uuid":
        return Uuid("uuid", T.StringType(), ("STRING",))
    if kind == "fixed":
        raise ValueError("the fixed type is not supported")
    if kind == "array":
        return Array(_compile(schema["items"], named))
    if kind == "map":
        return Map(_compile(schema["values"], named))
    if kind == "enum":
        named[schema["name"]] = Enum(schema["name"], schema["symbols"])
        return named[schema["name"]]
    if kind == "record":
        record = named[schema["name"]] = Record(schema["name"])
        for f in schema["fields"]:
            default = (f["default"],) if "default" in f else ()
            record.fields.append((f["name"], _compile(f["type"], named), default))
        return record
    return _compile(kind, named)


def to_avro_json(value: Column, schema) -> Column:
    """A typed value as Avro JSON text; null fields are kept."""
    return F.to_json(compiled(schema).tagged(value), {"ignoreNullFields": "false"})


def from_avro_json(payload: Column, schema) -> Column:
    """Avro JSON text as a typed value."""
    return let(P.parsed(payload), compiled(schema).untagged)


def compatibility(old, new) -> list[tuple[str, str]]:
    """What changed from one record schema to another: (field, added|removed|retyped|...)."""
    before = {n: (t, d) for n, t, d in compiled(old).fields}
    after = {n: (t, d) for n, t, d in compiled(new).fields}
    out = []
    for name in sorted(before.keys() | after.keys()):
        if name not in before:
            out.append((name, "added" if after[name][1] else "added without default"))
        elif name not in after:
            out.append((name, "removed"))
        elif before[name][0].spark != after[name][0].spark:
            out.append((name, "retyped"))
    return out
