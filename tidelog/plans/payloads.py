"""Decoding, checking and encoding payloads; validation; scalar functions."""

from pyspark.sql import functions as F

from tidelog.functions import avro, codecs, json_schema
from tidelog.functions import scalars as S
from tidelog.operators import validate as V
from tidelog.operators.log import Log
from tidelog.plans.registry import EVENTS, events, exact, query, table

# Payloads of mixed quality, derived from the events: an unknown field, a missing
# field, broken JSON, a wrong type, and good ones.
PAYLOAD = """CASE event_type
  WHEN 'error' THEN replace(props, '}', ', "x": 1}')
  WHEN 'signup' THEN '{"q": 5}'
  WHEN 'view' THEN left(props, 5)
  WHEN 'click' THEN CASE WHEN event_id % 2 = 0 THEN '{"k": "' || event_id || '"}' ELSE props END
  ELSE props END"""


def payloads(spark, d):
    df = table(spark, d, "events").withColumn("payload", F.expr(PAYLOAD))
    return Log.of(df, "user_id", "payload", "ts", "event_id", topic=F.col("event_type"))


@query("json_decode", f"""
SELECT event_id, TRY_CAST(CASE WHEN json_type(payload, '$.k') = 'UBIGINT'
    THEN json_extract_string(payload, '$.k') END AS BIGINT) AS k, FALSE AS bad
FROM (SELECT event_id, {PAYLOAD} AS payload FROM events) WHERE json_valid(payload)
UNION ALL SELECT event_id, NULL, TRUE FROM (SELECT event_id, {PAYLOAD} AS payload FROM events)
WHERE NOT json_valid(payload)""")
def json_decode(spark, d):
    read = codecs.decode_log(payloads(spark, d), codecs.codec(
        {"format": "json", "schema": "k bigint"}))
    return read.good.df.select(F.col("offset").alias("event_id"), "value.k",
                               F.lit(False).alias("bad")).unionByName(
        read.bad.select(F.col("offset").alias("event_id"), F.lit(None).cast("long").alias("k"),
                        F.lit(True).alias("bad")))


@query("json_encode", f"""
SELECT event_id, '{{"user":' || user_id || ',"type":"' || event_type || '"}}' AS payload
FROM ({EVENTS})""")
def json_encode(spark, d):
    log = events(spark, d)
    log = Log(log.df.withColumn("value", F.struct(F.col("key").alias("user"),
                                                  F.col("value.event_type").alias("type"))),
              log.order)
    out = codecs.encode_log(log, codecs.codec({"format": "json"}))
    return out.df.select(F.col("offset").alias("event_id"), F.col("value").alias("payload"))


K_SCHEMA = {"type": "object", "required": ["k"], "additionalProperties": False,
            "properties": {"k": {"type": "integer", "minimum": 10}}}


@query("json_schema_errors", f"""
WITH p AS (SELECT event_id, {PAYLOAD} AS payload FROM events)
SELECT event_id, '' AS path, 'json' AS rule FROM p WHERE NOT json_valid(payload)
UNION ALL SELECT event_id, '/k', 'required' FROM p
  WHERE json_valid(payload) AND json_type(payload, '$.k') IS NULL
UNION ALL SELECT event_id, '/k', 'type' FROM p
  WHERE json_valid(payload) AND json_type(payload, '$.k') = 'VARCHAR'
UNION ALL SELECT event_id, '/k', 'minimum' FROM p
  WHERE json_valid(payload) AND json_type(payload, '$.k') = 'UBIGINT'
    AND CAST(json_extract_string(payload, '$.k') AS BIGINT) < 10
UNION ALL SELECT event_id, '/' || n, 'additionalProperties'
  FROM (SELECT event_id, unnest(json_keys(payload)) AS n FROM p WHERE json_valid(payload))
  WHERE n <> 'k'""")
def json_schema_errors(spark, d):
    wrong = json_schema.errors(F.col("value"), K_SCHEMA)
    return payloads(spark, d).df.select(F.col("offset").alias("event_id"),
                                        F.explode(wrong).alias("e")).select("event_id", "e.*")


# An Avro schema over the payloads: long k, optional int x with default.
RECORD = {"type": "record", "name": "Props", "fields": [
    {"name": "k", "type": "long"}, {"name": "x", "type": ["null", "int"], "default": None},
    {"name": "source", "type": "string", "default": "events"}]}


@query("schema_coerce", f"""
WITH p AS (SELECT event_id, {PAYLOAD} AS payload FROM events)
SELECT event_id, CAST(json_extract_string(payload, '$.k') AS BIGINT) AS k,
  CAST(json_extract_string(payload, '$.x') AS INTEGER) AS x, 'events' AS source
FROM p WHERE json_valid(payload) AND json_type(payload, '$.k') = 'UBIGINT'""")
def schema_coerce(spark, d):
    read = codecs.decode_log(payloads(spark, d), codecs.codec(
        {"format": "avro", "schema": RECORD}))
    return read.good.df.select(F.col("offset").alias("event_id"), "value.*")


@query("schema_coerce_errors", f"""
WITH p AS (SELECT event_id, {PAYLOAD} AS payload FROM events)
SELECT event_id, '' AS path, 'not JSON' AS message FROM p WHERE NOT json_valid(payload)
UNION ALL SELECT event_id, '', 'no field q in Props' FROM p
  WHERE json_valid(payload) AND json_type(payload, '$.q') IS NOT NULL
UNION ALL SELECT event_id, '', 'k is missing and has no default' FROM p
  WHERE json_valid(payload) AND json_type(payload, '$.k') IS NULL
UNION ALL SELECT event_id, '/k', 'string where the schema wants long' FROM p
  WHERE json_valid(payload) AND json_type(payload, '$.k') = 'VARCHAR'""")
def schema_coerce_errors(spark, d):
    read = codecs.decode_log(payloads(spark, d), codecs.codec(
        {"format": "avro", "schema": RECORD}))
    return read.bad.select(F.col("offset").alias("event_id"), F.explode("errors").alias("e")
                           ).select("event_id", "e.*")


ORDER_SCHEMA = {"type": "record", "name": "Order", "fields": [
    {"name": "order_key", "type": "long"},
    {"name": "status", "type": {"type": "enum", "name": "Status", "symbols": ["O", "F", "P"]}},
    {"name": "priority", "type": ["null", "string"]}]}


@query("avro_json", """
SELECT o_orderkey, '{"order_key":' || o_orderkey || ',"status":"' || o_orderstatus
  || '","priority":' || CASE WHEN o_orderpriority = '1-URGENT' THEN 'null'
     ELSE '{"string":"' || o_orderpriority || '"}' END || '}' AS json,
  o_orderstatus AS status,
  CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderpriority END AS priority FROM orders""")
def avro_json(spark, d):
    """To Avro JSON, where union members are tagged, and back."""
    record = F.struct(F.col("o_orderkey").alias("order_key"), F.col("o_orderstatus").alias(
        "status"), F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderpriority")).alias(
            "priority"))
    out = table(spark, d, "orders").select(
        "o_orderkey", avro.to_avro_json(record, ORDER_SCHEMA).alias("json"))
    back = avro.from_avro_json(F.col("json"), ORDER_SCHEMA)
    return out.withColumn("back", back).select("o_orderkey", "json", "back.status",
                                               "back.priority")


ORDER_V3 = {"type": "record", "name": "OrderState", "fields": [
    {"name": "status", "type": "string"},
    {"name": "priority", "type": ["null", "string"], "default": None},
    {"name": "reference", "type": "string", "default": "none"}]}


@query("schema_evolution", """
SELECT o_orderstatus AS status, NULL AS priority, 'none' AS reference FROM orders WHERE o_orderkey % 3 = 0
UNION ALL SELECT o_orderstatus, o_orderpriority, 'none' FROM orders WHERE o_orderkey % 3 = 1
UNION ALL SELECT o_orderstatus, o_orderpriority, CAST(o_orderkey AS VARCHAR) FROM orders
WHERE o_orderkey % 3 = 2""")
def schema_evolution(spark, d):
    """Rows written under three versions of a schema, read with the last."""
    df = table(spark, d, "orders")
    a, b = F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")
    c = F.col("o_orderkey").cast("string").alias("reference")
    part = lambda n, *columns: df.where(F.col("o_orderkey") % 3 == n).select(*columns)
    return codecs.evolved([part(0, a), part(1, a, b), part(2, a, b, c)], ORDER_V3)


JSON_TOPICS = ("view", "error", "signup")
BY_TOPIC = {"click": (None, codecs.codec({"format": "string"})),
            "purchase": (None, codecs.codec({"format": "long"})),
            **{t: (None, codecs.in_bytes(codecs.codec({"format": "json", "schema": "k int"})))
               for t in JSON_TOPICS}}


@query("decode_topics", """
SELECT event_type AS topic, event_id,
  CASE event_type WHEN 'click' THEN CAST(user_id AS VARCHAR)
    WHEN 'purchase' THEN CAST(event_id * 3 AS VARCHAR)
    ELSE CAST(json_extract(props, '$.k') AS VARCHAR) END AS value
FROM events""")
def decode_topics(spark, d):
    """Raw payloads of five topics, each decoded by its own codec, in one pass."""
    read = codecs.decode_mixed(_raw_topics(spark, d), BY_TOPIC).good.df
    value = F.coalesce("value.click", F.col("value.purchase").cast("string"),
                       *[F.col(f"value.{t}.k").cast("string") for t in JSON_TOPICS])
    return read.select("topic", F.col("offset").alias("event_id"), value.alias("value"))


def _raw_topics(spark, d):
    raw = F.when(F.col("event_type") == "click", F.encode(F.col("user_id").cast("string"), "UTF-8"))
    raw = raw.when(F.col("event_type") == "purchase", S.long_to_bytes(F.col("event_id") * 3))
    raw = raw.otherwise(F.encode("props", "UTF-8"))
    return Log.of(table(spark, d, "events"), "user_id", raw, "ts", "event_id",
                  topic=F.col("event_type"))


@query("encode_topics", """
SELECT event_type AS topic, event_id, CASE event_type
    WHEN 'click' THEN hex(CAST(user_id AS VARCHAR))
    WHEN 'purchase' THEN printf('%016X', event_id * 3)
    ELSE hex('{"k":' || json_extract_string(props, '$.k') || '}') END AS payload
FROM events""")
def encode_topics(spark, d):
    """Payloads of five topics, decoded and encoded again by each topic's codec, in one pass."""
    read = codecs.decode_mixed(_raw_topics(spark, d), BY_TOPIC).good
    made = codecs.encode_mixed(read, BY_TOPIC)
    return made.df.select("topic", F.col("offset").alias("event_id"), F.hex("value").alias("payload"))


@query("read_only_decode", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def read_only_decode(spark, d):
    """A read-only codec without a schema decodes whatever the payload holds."""
    codec = codecs.codec({"format": "avro", "read_only": True})
    log = Log.of(table(spark, d, "events"), "user_id", "props", "ts", "event_id")
    read = codecs.decode_log(log, codec).good.df
    return read.select(F.col("offset").alias("event_id"),
                       F.try_variant_get("value", "$.k", "bigint").alias("k"))


@query("mangled_names", """
SELECT '{"event_id":' || event_id || ',"who_is":{"user_id":' || user_id || '}}' AS record,
  event_type || '_v2' AS name, event_type || '-v2' AS back FROM events""")
def mangled_names(spark, d):
    """Names with dashes, of nested fields and in data, made fit for Avro and turned back."""
    df = table(spark, d, "events").select(
        F.struct(F.col("event_id").alias("event-id"),
                 F.struct(F.col("user_id").alias("user-id")).alias("who-is")).alias("r"),
        avro.mangled(F.concat("event_type", F.lit("-v2"))).alias("name"))
    fit = avro.renamed(df.schema["r"].dataType, avro.mangled)
    return df.select(F.to_json(F.col("r").cast(fit)).alias("record"), "name",
                     avro.unmangled(F.col("name")).alias("back"))


# -- validation ---------------------------------------------------------------------------------

RULES = {
    "price": lambda k, v: v["price"] < 400000,
    "status": lambda k, v: v["status"].isin("O", "F"),
    "date": lambda k, v: F.year(v["date"]) >= 1996,
}


def _orders(spark, d):
    value = F.struct(exact("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"),
                     F.col("o_orderdate").alias("date"))
    return Log.of(table(spark, d, "orders"), "o_orderkey", value, "o_orderdate", "o_orderkey")


BROKEN = """list_filter([CASE WHEN NOT o_totalprice < 400000 THEN 'price' END,
  CASE WHEN o_orderstatus NOT IN ('O', 'F') THEN 'status' END,
  CASE WHEN NOT year(o_orderdate) >= 1996 THEN 'date' END], lambda x: x IS NOT NULL)"""


@query("validate_quarantine", f"SELECT o_orderkey, array_to_string({BROKEN}, ',') AS errors FROM orders")
def validate_quarantine(spark, d):
    valid, invalid = V.validate(_orders(spark, d), RULES, "quarantine")
    return valid.df.select(F.col("key").alias("o_orderkey"), F.lit("").alias("errors")).unionByName(
        invalid.df.select(F.col("key").alias("o_orderkey"), F.array_join("errors", ",").alias(
            "errors")))


@query("validate_drop", f"SELECT o_orderkey FROM orders WHERE len({BROKEN}) = 0")
def validate_drop(spark, d):
    return V.validate(_orders(spark, d), RULES, "drop").df.select(F.col("key").alias("o_orderkey"))


@query("validate_fail", "SELECT o_orderkey FROM orders")
def validate_fail(spark, d):
    """A rule no record breaks: everything passes."""
    return V.validate(_orders(spark, d), {"price": lambda k, v: v["price"] > 0}).df.select(
        F.col("key").alias("o_orderkey"))


# -- scalar functions -----------------------------------------------------------------------------

UUID5 = """
SELECT o_orderkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-'
  || substr('89ab', (('0x' || substr(h, 17, 1))::INTEGER % 4) + 1, 1) || substr(h, 18, 3) || '-'
  || substr(h, 21, 12) AS id
FROM (SELECT o_orderkey, sha1(unhex(repeat('0', 32)) || encode(CAST(o_orderkey AS VARCHAR))) AS h
      FROM orders)"""


@query("uuid_v5", UUID5)
def uuid_v5(spark, d):
    return table(spark, d, "orders").select("o_orderkey", S.uuid_v5(
        F.lit(S.NIL_UUID), F.col("o_orderkey").cast("string")).alias("id"))


@query("uuid_canonical", """
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN lower(raw) ELSE raw END AS id FROM (
  SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0
    THEN 'ABCDEF01-2345-6789-ABCD-' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0')
    ELSE 'NOT-A-UUID-' || o_orderkey END AS raw FROM orders)""")
def uuid_canonical(spark, d):
    raw = F.when(F.col("o_orderkey") % 2 == 0, F.concat(
        F.lit("ABCDEF01-2345-6789-ABCD-"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0"))
    ).otherwise(F.concat(F.lit("NOT-A-UUID-"), F.col("o_orderkey").cast("string")))
    return table(spark, d, "orders").select("o_orderkey", S.canonical_uuid(raw).alias("id"))


@query("long_bytes", """
SELECT event_id, lpad(hex(event_id), 16, '0') AS data, event_id - 5000 AS back FROM events""")
def long_bytes(spark, d):
    return table(spark, d, "events").select(
        "event_id", F.hex(S.long_to_bytes(F.col("event_id"))).alias("data"),
        S.bytes_to_long(S.long_to_bytes(F.col("event_id") - 5000)).alias("back"))


@query("string_bytes", "SELECT doc_id, octet_length(encode(text)) AS size, text FROM documents")
def string_bytes(spark, d):
    data = S.string_to_bytes(F.col("text"))
    return table(spark, d, "documents").select(
        "doc_id", F.octet_length(data).cast("long").alias("size"),
        S.bytes_to_string(data).alias("text"))


@query("headers_map", """
SELECT event_id, event_type AS type, CAST(user_id AS VARCHAR) AS id FROM events""")
def headers_map(spark, d):
    """Of two headers with one name the last counts."""
    header = lambda k, v: F.struct(F.lit(k).alias("key"), v.cast("binary").alias("value"))
    headers = F.array(header("id", F.lit("old")), header("type", F.col("event_type")),
                      header("id", F.col("user_id").cast("string")))
    m = S.headers_map(headers)
    return table(spark, d, "events").select("event_id", m["type"].cast("string").alias("type"),
                                            m["id"].cast("string").alias("id"))


@query("dice_sums", """
SELECT event_id, (event_id % 6 + 1) + (user_id % 6 + 1) AS first, 2 * (event_id % 6 + 1) AS second
FROM events""")
def dice_sums(spark, d):
    one, two = (F.col("event_id") % 6 + 1), (F.col("user_id") % 6 + 1)
    sums = S.pair_sums(F.array(F.array(one, two), F.array(one, one)))
    return table(spark, d, "events").select("event_id", sums[0].alias("first"),
                                            sums[1].alias("second"))


