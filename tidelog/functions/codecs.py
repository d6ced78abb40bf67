"""Decoding whole logs: payload columns in, typed columns and a quarantine out."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions import avro, json_schema
from tidelog.functions import payload as P
from tidelog.functions.scalars import (bytes_to_long, bytes_to_string, let, long_to_bytes,
                                       string_to_bytes)
from tidelog.operators.log import KEY, VALUE, Log

FORMATS = ("json", "json-schema", "avro", "string", "long")


class ReadOnlyCodec(RuntimeError):
    """The codec was declared read-only."""


@dataclass(frozen=True)
class Codec:
    """How one payload column is decoded, checked and encoded.

    ``errors`` gives an array of structs; it is empty for a good payload.
    """

    format: str
    decode: Callable[[Column], Column]
    errors: Callable[[Column], Column]
    to_payload: Callable[[Column], Column]
    read_only: bool = False

    def encode(self, value: Column) -> Column:
        if self.read_only:
            raise ReadOnlyCodec("cannot encode with a read-only codec")
        return self.to_payload(value)


def codec(config: Mapping) -> Codec:
    """Choose a codec from ``{"format", "schema" | "schema_file" | "read_only", ...}``.

    JSON payloads are text.  An Avro codec needs exactly one of schema, schema
    file and read-only; read-only without a schema decodes to VARIANT.
    """
    name = config.get("format")
    if name not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, got {name!r}")
    given = [k for k in ("schema", "schema_file", "read_only") if config.get(k)]
    if name == "avro" and len(given) != 1:
        raise ValueError(f"an avro codec needs exactly one of schema, schema_file, read_only; "
                         f"got {given}")
    schema = config.get("schema")
    if config.get("schema_file"):
        try:
            schema = Path(config["schema_file"]).read_text()
        except OSError as e:
            raise ValueError(f"could not find schema {config['schema_file']}") from e
    read_only = bool(config.get("read_only"))
    if name == "string":
        return Codec(name, bytes_to_string, lambda c: _flag(F.lit(False), ""), string_to_bytes,
                     read_only)
    if name == "long":
        wrong = lambda c: c.isNotNull() & (F.octet_length(c) != 8)
        return Codec(name, lambda c: F.when(~wrong(c), bytes_to_long(c)),
                     lambda c: _flag(wrong(c), "not eight bytes"), long_to_bytes, read_only)
    not_json = lambda c: c.isNotNull() & P.parsed(c).isNull()
    if name == "json":
        read = (lambda c: F.from_json(c, schema)) if schema else P.parsed
        return Codec(name, read, lambda c: _flag(not_json(c), "not JSON"), F.to_json, read_only)
    if name == "json-schema":
        return Codec(name, lambda c: json_schema.value(c, schema),
                     lambda c: json_schema.errors(c, schema), F.to_json, read_only)
    node = avro.compiled(schema)

    def errors(c):
        return F.when(c.isNull(), avro.no_errors()).otherwise(let(P.parsed(c), lambda v: F.when(
            v.isNull(), avro.error(F.lit(""), "not JSON")).otherwise(node.errors(v, F.lit("")))))

    return Codec(name, lambda c: let(P.parsed(c), node.value), errors,
                 lambda c: F.to_json(c, {"ignoreNullFields": "false"}), read_only)


def _flag(wrong: Column, message: str) -> Column:
    return F.when(wrong, avro.error(F.lit(""), message)).otherwise(avro.no_errors())


@dataclass(frozen=True)
class Decoded:
    good: Log
    bad: DataFrame


def decode_log(log: Log, value: Codec, key: Codec | None = None) -> Decoded:
    """Decode a log's payloads; records that fail go to ``bad`` with their errors."""
    wrong = value.errors(F.col(VALUE))
    if key is not None:
        wrong = F.concat(wrong, key.errors(F.col(KEY)))
    checked = log.df.withColumn("errors", wrong)
    good = checked.where(F.size("errors") == 0).drop("errors")
    good = good.withColumn(VALUE, value.decode(F.col(VALUE)))
    if key is not None:
        good = good.withColumn(KEY, key.decode(F.col(KEY)))
    return Decoded(Log(good, log.order), checked.where(F.size("errors") > 0))


def encode_log(log: Log, value: Codec, key: Codec | None = None) -> Log:
    df = log.df.withColumn(VALUE, value.encode(F.col(VALUE)))
    if key is not None:
        df = df.withColumn(KEY, key.encode(F.col(KEY)))
    return Log(df, log.order)


def decode_topics(log: Log, codecs: Mapping[str, tuple[Codec | None, Codec]]) -> dict[str, Decoded]:
    """Decode a log of many topics by each topic's (key codec, value codec).

    A record of a topic without codecs fails the job.
    """
    known = F.col("topic").isin(*codecs)
    checked = log.df.where(F.when(known, F.lit(True)).otherwise(F.raise_error(F.concat(
        F.lit("record comes from unknown topic: "), F.coalesce("topic", F.lit("null"))
    )).cast("boolean")))
    return {topic: decode_log(Log(checked.where(F.col("topic") == topic), log.order), v, k)
            for topic, (k, v) in codecs.items()}


def in_bytes(text: Codec) -> Codec:
    """A codec of texts for payloads that come and go as UTF-8 bytes."""
    return Codec(text.format, lambda c: text.decode(c.cast("string")),
                 lambda c: text.errors(c.cast("string")),
                 lambda v: F.encode(text.to_payload(v), "UTF-8"), text.read_only)


ByTopic = Mapping[str, tuple[Codec | None, Codec]]


def _for_its_topic(made: Mapping[str, Column]) -> Column:
    """Of one column per topic the one of the record's own; it alone is computed."""
    out = None
    for topic, column in made.items():
        met = F.col("topic") == topic
        out = F.when(met, column) if out is None else out.when(met, column)
    return out.otherwise(F.raise_error(F.concat(
        F.lit("record comes from unknown topic: "), F.coalesce("topic", F.lit("null")))))


def _side_by_side(column: str, fns: Mapping[str, Callable[[Column], Column]]) -> Column:
    return F.struct(*[F.when(F.col("topic") == t, fn(F.col(column))).alias(t)
                      for t, fn in fns.items()])


def decode_mixed(log: Log, codecs: ByTopic) -> Decoded:
    """Decode a log of many topics in one pass.

    The value becomes a struct with a field per topic, of which a record's own is set; so does the
    key if any topic has a key codec (a topic without one then keeps its payload).  A record of a
    topic without codecs fails the job.
    """
    keyed = any(k for k, _ in codecs.values())
    wrong = {t: F.concat(v.errors(F.col(VALUE)), k.errors(F.col(KEY))) if k else v.errors(F.col(VALUE))
             for t, (k, v) in codecs.items()}
    checked = log.df.withColumn("errors", _for_its_topic(wrong))
    good = checked.where(F.size("errors") == 0).drop("errors")
    good = good.withColumn(VALUE, _side_by_side(VALUE, {t: v.decode for t, (_, v) in codecs.items()}))
    if keyed:
        good = good.withColumn(KEY, _side_by_side(KEY, {
            t: k.decode if k else (lambda c: c) for t, (k, _) in codecs.items()}))
    return Decoded(Log(good, log.order), checked.where(F.size("errors") > 0))


def encode_mixed(log: Log, codecs: ByTopic) -> Log:
    """Encode a log of many topics in one pass: what ``decode_mixed`` gives becomes payloads again.

    All topics share the payload column, so their codecs have to give one type (see ``in_bytes``).
    A record of a topic without codecs fails the job, a read-only codec is refused.
    """
    own = {t: v.encode(F.col(VALUE)[t]) for t, (_, v) in codecs.items()}
    df = log.df.withColumn(VALUE, _for_its_topic(own))
    if any(k for k, _ in codecs.values()):
        keys = {t: k.encode(F.col(KEY)[t]) if k else F.col(KEY)[t] for t, (k, _) in codecs.items()}
        df = df.withColumn(KEY, _for_its_topic(keys))
    return Log(df, log.order)


def evolved(frames: list[DataFrame], schema) -> DataFrame:
    """Rows written with several versions of a record schema, read with the newest.

    Fields a version lacks take their default.
    """
    record = avro.compiled(schema)
    out = []
    for df in frames:
        unknown = [c for c in df.columns if c not in {n for n, _, _ in record.fields}]
        if unknown:
            raise ValueError(f"fields {unknown} are not in the reader's schema")
        columns = []
        for name, t, default in record.fields:
            if name in df.columns:
                columns.append(F.col(name).cast(t.spark).alias(name))
            elif default:
                value = F.lit(default[0])
                columns.append(value.cast(t.spark).alias(name))
            else:
                raise ValueError(f"field {name!r} is missing and has no default")
        out.append(df.select(*columns))
    first = out[0]
    for df in out[1:]:
        first = first.unionByName(df)
    return first
