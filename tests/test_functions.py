"""Scalars, partitioning, schemas and codecs."""

import json
import uuid

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import avro, codecs, json_schema
from tidelog.functions import partitioning as P
from tidelog.functions import scalars as S
from tidelog.operators.log import Log

# murmur2 of some strings.
MURMUR2 = {"21": -973932308, "foobar": -790332482, "a-little-bit-long-string": -985981536,
           "a-little-bit-longer-string": -1486304829,
           "lkjh234lh9fiuh90y23oiuhsafujhadof229phr9h19h89h8": -58897971, "abc": 479470107}


def column(spark, values, ddl, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {ddl}")
    return [r[0] for r in df.select("i", expr.alias("y")).orderBy("i").select("y").collect()]




def test_murmur2(spark):
    got = column(spark, list(MURMUR2), "string", P.murmur2(F.encode(F.col("x"), "UTF-8")))
    assert got == list(MURMUR2.values())


def test_default_partition(spark):
    got = column(spark, list(MURMUR2), "string", P.default_partition(F.encode(F.col("x"), "UTF-8"), 7))
    assert got == [(h & 0x7FFFFFFF) % 7 for h in MURMUR2.values()]
    with pytest.raises(ValueError):
        P.default_partition(F.col("x"), 0)


@pytest.mark.parametrize("record_key,payload", [
    ("$.foo", '{"foo": 42}'), ("foo_bar", '{"foo-bar": 42}'), ("foo.bar", '{"foo": {"bar": 42}}')])
def test_key_from_path(spark, record_key, payload):
    assert column(spark, [payload], "string", P.key_from_json(F.col("x"), record_key)) == ["42"]


def test_key_from_struct(spark):
    assert column(spark, [((42,),)], "struct<foo:struct<bar:int>>",
                  P.key_from_struct(F.col("x"), "foo.bar")) == [42]


def addressed(spark, rows, **kwargs):
    df = spark.createDataFrame(rows, "key string, value struct<id:string,a:int>, partition int")
    return [(r["key"], r["partition"]) for r in P.addressed(df, 4, **kwargs).collect()]


def test_addressed_defaults_and_explicit_values(spark):
    value = ("abc", 1)
    own = (479470107 & 0x7FFFFFFF) % 4
    assert addressed(spark, [(None, value, None)]) == [("abc", own)]
    assert addressed(spark, [("21", value, None)]) == [("21", (-973932308 & 0x7FFFFFFF) % 4)]
    assert addressed(spark, [("k", value, 3)]) == [("k", 3)]
    assert addressed(spark, [(None, value, None)], key=lambda v: v["a"].cast("string"),
                     partition=lambda k, v, n: v["a"] + 1) == [("1", 2)]


@pytest.mark.parametrize("partition", [-1, 4])
def test_addressed_refuses_impossible_partitions(spark, partition):
    with pytest.raises(Exception, match="invalid partition"):
        addressed(spark, [("k", ("abc", 1), partition)])


def test_words(spark):
    texts = ["Hello, big  World!", " x", "", "...", None, "one"]
    assert column(spark, texts, "string", S.words(F.col("x"))) == [
        ["hello", "big", "world"], ["", "x"], [""], [], None, ["one"]]


@given(st.lists(st.tuples(st.uuids(), st.text(max_size=20)), min_size=1, max_size=20))
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_uuid_v5(spark, pairs):
    df = spark.createDataFrame([(i, str(n), t) for i, (n, t) in enumerate(pairs)],
                               "i int, ns string, t string")
    got = df.orderBy("i").select(S.uuid_v5(F.col("ns"), F.col("t"))).collect()
    assert [r[0] for r in got] == [str(uuid.uuid5(n, t)) for n, t in pairs]


@given(st.lists(st.integers(-2 ** 63, 2 ** 63 - 1), min_size=1, max_size=50))
@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_long_round_trip(spark, numbers):
    data = S.long_to_bytes(F.col("x"))
    assert column(spark, numbers, "long", S.bytes_to_long(data)) == numbers
    assert [bytes(b) for b in column(spark, numbers, "long", data)] == [
        n.to_bytes(8, "big", signed=True) for n in numbers]


def test_canonical_uuid(spark):
    good = "A8E310D7-F0D6-4F81-A474-AAB5D6234149"
    assert column(spark, [good, "foo", None], "string", S.canonical_uuid(F.col("x"))) == [
        good.lower(), "foo", None]


def test_headers_last_value_wins(spark):
    headers = [[("a", b"1"), ("b", b"2"), ("a", b"3")]]
    got = column(spark, headers, "array<struct<key:string,value:binary>>", S.headers_map(F.col("x")))
    assert {k: bytes(v) for k, v in got[0].items()} == {"a": b"3", "b": b"2"}


def test_pair_sums(spark):
    assert column(spark, [[[1, 2], [3, 4]], []], "array<array<int>>", S.pair_sums(F.col("x"))) == [[3, 7], []]


# -- Avro ---------------------------------------------------------------------------------

# An order and what happened to it, after the columns of orders and events.
HAPPENED = {"type": "record", "name": "Happened", "fields": [
    {"name": "event_id", "type": "long"},
    {"name": "event_type", "type": {"type": "enum", "name": "Kind", "symbols": ["click", "sign_up"]}},
    {"name": "amounts", "type": {"type": "array", "items": ["double", "string"]}, "default": []},
    {"name": "proof", "type": ["bytes", "null"], "default": "none"}]}
ORDER_TRAIL = {"type": "record", "name": "OrderTrail", "fields": [
    {"name": "priority", "type": {"type": "record", "name": "Priority", "fields": [
        {"name": "rank", "type": "int", "default": 5}, {"name": "urgent", "type": "boolean"}]}},
    {"name": "totals", "type": {"type": "array", "items": {"type": "map", "values": "double"}}},
    {"name": "first_event", "type": HAPPENED},
    {"name": "later", "type": {"type": "map", "values": {"type": "array", "items": "Happened"}}, "default": {}},
    {"name": "clerk", "type": ["string", "null", {"type": "map", "values": "string"}]},
    {"name": "session", "type": ["null", {"type": "string", "logicalType": "uuid"}], "default": None}]}
EVENT = {"event-id": 12, "event-type": "sign-up", "amounts": [1.5, "n/a"], "proof": "ok"}
TRAIL = {"priority": {"rank": 2, "urgent": True}, "totals": [{"net": 10.5}, {}], "first-event": EVENT,
         "later": {"may": [EVENT, {**EVENT, "event-id": 13}]}, "clerk": {"desk": "c7"}, "session": S.NIL_UUID}
WANTS = "{} where the schema wants {}"


def changed(*path, to):
    """The trail with one place of it replaced."""
    def within(held, path):
        if not path:
            return to
        copy = list(held) if isinstance(held, list) else dict(held)
        copy[path[0]] = within(copy[path[0]] if isinstance(copy, list) else copy.get(path[0], {}), path[1:])
        return copy

    return within(TRAIL, path)


def lacking(*path):
    """The trail without one field of one of its records."""
    held = TRAIL
    for step in path[:-1]:
        held = held[step]
    return changed(*path[:-1], to={k: v for k, v in held.items() if k != path[-1]})


# What each rule of coercion says of one wrong place, at every kind of nesting.
WRONG = [
    # scalars, inside a record, a map in an array, an array in a map
    (changed("priority", "rank", to=2 ** 31), "/priority/rank", WANTS.format("integer", "int")),
    (changed("priority", "urgent", to="yes"), "/priority/urgent", WANTS.format("string", "bool")),
    (changed("totals", 0, "net", to="ten"), "/totals/0/net", WANTS.format("string", "double")),
    (changed("later", "may", 1, "event-id", to=True), "/later/may/1/event_id", WANTS.format("boolean", "long")),
    (changed("first-event", "event-type", to="signup"), "/first_event/event_type", WANTS.format("string", "enum")),
    # unions name all they take
    (changed("session", to="none"), "/session", WANTS.format("string", "union [NULL, STRING]")),
    (changed("clerk", to=4), "/clerk", WANTS.format("integer", "union [STRING, NULL, MAP]")),
    (changed("first-event", "amounts", to=[1.0, False]), "/first_event/amounts/1",
     WANTS.format("boolean", "union [DOUBLE, STRING]")),
    # containers
    (changed("totals", to={}), "/totals", None), (changed("later", "may", to=EVENT), "/later/may", None),
    (changed("priority", to=[]), "/priority", None),
    # records: no unknown field, and none missing that has no default
    (changed("priority", "note", to=1), "/priority", "no field note in Priority"),
    (lacking("priority", "urgent"), "/priority", "urgent is missing and has no default"),
    (lacking("totals"), "", "totals is missing and has no default"),
]


def test_avro_errors_carry_their_path(spark):
    codec = codecs.codec({"format": "avro", "schema": json.dumps(ORDER_TRAIL)})
    good = [TRAIL, changed("priority", "rank", to=-2 ** 31), changed("clerk", to=None), lacking("later")]
    payloads = [json.dumps(x) for x in [w for w, _, _ in WRONG] + good] + ["{", None]
    got = [[tuple(e) for e in es] for es in column(spark, payloads, "string", codec.errors(F.col("x")))]
    for errors, (_, path, message) in zip(got, WRONG):
        assert [e[0] for e in errors] == [path], errors
        assert message in (None, errors[0][1])
    assert got[len(WRONG):] == [[], [], [], [], [("", "not JSON")], []]


def test_avro_reports_every_wrong_place(spark):
    codec = codecs.codec({"format": "avro", "schema": ORDER_TRAIL})
    bad = {**changed("priority", "rank", to="low"), "totals": [{"net": "x"}, {"net": 1.0}, {"tax": None}]}
    got = column(spark, [json.dumps(bad)], "string", codec.errors(F.col("x")))[0]
    assert sorted(e[0] for e in got) == ["/priority/rank", "/totals/0/net", "/totals/2/tax"]


def test_avro_value_and_json_round_trip(spark):
    codec = codecs.codec({"format": "avro", "schema": ORDER_TRAIL})
    short = {**lacking("later"), "first-event": {"event-id": 1, "event-type": "click"}, "clerk": "c8"}
    short["priority"] = {"urgent": False}
    value, filled = column(spark, [json.dumps(TRAIL), json.dumps(short)], "string", codec.decode(F.col("x")))
    assert value["later"]["may"][1]["event_id"] == 13 and value["first_event"]["event_type"] == "sign-up"
    assert filled["priority"] == Row(rank=5, urgent=False) and filled["later"] == {}
    assert filled["first_event"]["amounts"] == [] and bytes(filled["first_event"]["proof"]) == b"none"
    as_json = avro.to_avro_json(codec.decode(F.col("x")), ORDER_TRAIL)
    tagged = json.loads(column(spark, [json.dumps(TRAIL)], "string", as_json)[0])
    assert tagged["clerk"] == {"map": {"desk": "c7"}}
    assert tagged["first_event"] == {"event_id": 12, "event_type": "sign_up", "proof": {"bytes": "ok"},
                                     "amounts": [{"double": 1.5}, {"string": "n/a"}]}
    back = column(spark, [json.dumps(tagged)], "string", avro.from_avro_json(F.col("x"), ORDER_TRAIL))[0]
    assert back == value


def test_avro_types():
    node = avro.compiled(ORDER_TRAIL).spark
    assert node["totals"].dataType == T.ArrayType(T.MapType(T.StringType(), T.DoubleType()))
    assert node["later"].dataType.valueType.elementType == node["first_event"].dataType
    assert avro.compiled("long").spark == T.LongType()
    for bad in ({"type": "fixed", "size": 4, "name": "f"}, "nosuch"):
        with pytest.raises(ValueError):
            avro.compiled(bad)


def enum(name, *symbols):
    return {"type": "enum", "name": name, "symbols": list(symbols)}


UNION = ["long", "string", enum("enum", "a", "b", "c"),
         {"type": "record", "name": "one", "fields": [{"name": "a", "type": enum("e1", "x")}]},
         {"type": "record", "name": "two", "fields": [
             {"name": "a", "type": enum("e2", "y")}, {"name": "b", "type": ["string", "null"]}]},
         {"type": "record", "name": "three", "fields": [
             {"name": "a", "type": enum("e3", "y")}, {"name": "c", "type": ["string", "null"]}]}]


def test_avro_union_takes_the_first_match(spark):
    payloads = ['123', '"hello"', '"123"', '{"a":"x"}', '{"a":"y","b":"t"}', '{"a":"y","c":"t"}']
    node = avro.compiled(UNION)
    got = column(spark, payloads, "string", node.value(avro.P.parsed(F.col("x"))))
    taken = [[n for n, v in r.asDict().items() if v is not None] for r in got]
    assert taken == [["long"], ["string"], ["string"], ["one"], ["two"], ["three"]]
    wrong = ['{"a":"y"}', '{"a":"x","d":"t"}', '{"a":"x","b":"t"}']
    errors = column(spark, wrong, "string", node.errors(avro.P.parsed(F.col("x")), F.lit("")))
    assert all(len(e) == 1 for e in errors)


def test_long_coercion_truncates_like_an_integer_cast(spark):
    node = avro.compiled("int")
    assert column(spark, ["2", "2.7", "-2.7", "1e3"], "string",
                  node.value(avro.P.parsed(F.col("x")))) == [2, 2, -2, 1000]


def test_compatibility():
    v1 = {"type": "record", "name": "foo", "fields": [{"name": "a", "type": "string"}]}
    v2 = {"type": "record", "name": "foo", "fields": [
        {"name": "a", "type": "long"}, {"name": "b", "type": ["null", "string"], "default": None}]}
    assert avro.compatibility(v1, v2) == [("a", "retyped"), ("b", "added")]
    assert avro.compatibility(v2, v1) == [("a", "retyped"), ("b", "removed")]


def test_mangling():
    t = T.StructType([T.StructField("a-b", T.ArrayType(T.StructType([
        T.StructField("c-d", T.LongType())])))])
    out = avro.renamed(t, avro.mangled)
    assert out.names == ["a_b"] and out["a_b"].dataType.elementType.names == ["c_d"]
    assert avro.renamed(out, avro.unmangled) == t


# -- JSON Schema ---------------------------------------------------------------------------


@pytest.mark.parametrize("schema,good,bad", [
    ({"type": "string"}, ['"foo"'], ["1.1", '["foo"]']),
    ({"type": "boolean"}, ["true", "false"], ["0", '"true"']),
    ({"type": "null"}, ["null"], ["false", '""', "0"]),
    ({"type": "integer"}, ["1"], ["1.1", '"1"']),
    ({"type": "number"}, ["1", "1.1"], ['"1"']),
    ({"type": "array", "items": {"type": "object", "required": ["n", "l"], "properties": {
        "n": {"type": "string"}, "l": {"type": "boolean"}}}},
     ['[{"n":"potato","l":true}]', "[]"], ['{"array":["foo"]}', '[{"n":"x"}]', '[{"n":1,"l":true}]']),
    ({"type": "object", "properties": {"bool": {"type": "boolean"},
                                       "array": {"type": "array", "minItems": 2}}},
     ['{"array":["foo",1,{"foo":"bar"}],"bool":false}'], ['{"array":["foo"]}']),
    ({"type": "object", "additionalProperties": False, "properties": {"nested": {
        "type": "object", "additionalProperties": False,
        "properties": {"foo": {"type": "string"}}}}},
     ['{"nested":{"foo":"bar"}}'], ['{"object":{"foo":1}}', '{"nested":{"bar":"x"}}']),
    ({"type": "object", "properties": {"age": {"type": "integer", "minimum": 0}}},
     ['{"age":0}'], ['{"age":-1}']),
    (None, ['"hello"', "1", "null", '{"hello":3}'], ["{oops"])])
def test_json_schema(spark, schema, good, bad):
    got = column(spark, good + bad, "string", json_schema.errors(F.col("x"), schema))
    assert [len(e) > 0 for e in got] == [False] * len(good) + [True] * len(bad)


def test_json_schema_value(spark):
    schema = {"type": "object", "properties": {"a": {"type": "integer"},
                                               "b": {"type": "array", "items": {"type": "number"}}}}
    assert column(spark, ['{"a":1,"b":[1,2.5]}'], "string", json_schema.value(F.col("x"), schema)) == [
        Row(a=1, b=[1.0, 2.5])]


# -- codecs ----------------------------------------------------------------------------------


def test_codec_configuration(tmp_path):
    for bad in ({}, {"format": "edn"}, {"format": "avro"},
                {"format": "avro", "schema": "long", "read_only": True},
                {"format": "json-schema", "schema_file": str(tmp_path / "none.json")}):
        with pytest.raises(ValueError):
            codecs.codec(bad)
    (tmp_path / "s.avsc").write_text('"long"')
    assert codecs.codec({"format": "avro", "schema_file": str(tmp_path / "s.avsc")}).format == "avro"
    with pytest.raises(codecs.ReadOnlyCodec):
        codecs.codec({"format": "avro", "read_only": True}).encode(F.col("x"))


def test_decode_unknown_topic_fails(spark):
    df = spark.createDataFrame([("a", "k", b"x", 0, 0), ("b", "k", b"y", 0, 1)],
                               "topic string, key string, value binary, ts int, offset int")
    text = codecs.codec({"format": "string"})
    decoded = codecs.decode_topics(Log(df), {"a": (None, text), "b": (None, text)})
    assert [r["value"] for r in decoded["b"].good.df.collect()] == ["y"]
    with pytest.raises(Exception, match="unknown topic"):
        codecs.decode_topics(Log(df), {"a": (None, text)})["a"].good.df.collect()


def test_mixed_topics_in_one_pass(spark):
    text, number = codecs.codec({"format": "string"}), codecs.codec({"format": "long"})
    record = codecs.in_bytes(codecs.codec({"format": "json", "schema": "n int"}))
    rows = [("a", b"1", b"x", 0), ("b", b"2", bytes(7) + b"\x05", 1), ("b", b"2", b"short", 2),
            ("c", b"3", b'{"n":4}', 3), ("c", b"3", b"{", 4), ("a", b"4", None, 5)]
    log = Log(spark.createDataFrame([(*r, 0) for r in rows], "topic string, key binary, value binary, offset int, ts int"))
    by_topic = {"a": (text, text), "b": (None, number), "c": (None, record)}
    read = codecs.decode_mixed(log, by_topic)
    good = {r["offset"]: r for r in read.good.df.collect()}
    assert {n: r["value"] for n, r in good.items()} == {
        0: Row(a="x", b=None, c=None), 1: Row(a=None, b=5, c=None), 3: Row(a=None, b=None, c=Row(n=4)),
        5: Row(a=None, b=None, c=None)}
    assert good[0]["key"] == Row(a="1", b=None, c=None) and good[1]["key"] == Row(a=None, b=b"2", c=None)
    assert sorted(r["offset"] for r in read.bad.collect()) == [2, 4]
    back = {r["offset"]: (r["key"], r["value"]) for r in codecs.encode_mixed(read.good, by_topic).df.collect()}
    assert back == {n: (k, v) for _, k, v, n in rows if n in good}
    scans = read.good.df._jdf.queryExecution().optimizedPlan().collectLeaves().size()
    assert scans == 1
    unknown = {"a": (text, text)}
    for made in (codecs.decode_mixed(log, unknown).good, codecs.encode_mixed(read.good, unknown)):
        with pytest.raises(Exception, match="unknown topic"):
            made.df.collect()
    with pytest.raises(codecs.ReadOnlyCodec):
        codecs.encode_mixed(log, {"a": (None, codecs.codec({"format": "avro", "read_only": True}))})


json_values = st.recursive(
    st.none() | st.booleans() | st.integers(-10 ** 9, 10 ** 9) | st.text(max_size=8),
    lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(max_size=4), x, max_size=3),
    max_leaves=6)


@given(st.lists(json_values, min_size=1, max_size=20))
@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_json_round_trip(spark, values):
    codec = codecs.codec({"format": "json"})
    texts = [json.dumps(v) for v in values]
    got = column(spark, texts, "string", codec.encode(codec.decode(F.col("x"))))
    assert [json.loads(t) for t in got] == values


def test_evolved_needs_defaults(spark):
    schema = {"type": "record", "name": "foo", "fields": [
        {"name": "a", "type": "string"}, {"name": "b", "type": "string", "default": "yolo"}]}
    old = spark.createDataFrame([("hello",)], "a string")
    assert codecs.evolved([old], schema).collect() == [Row(a="hello", b="yolo")]
    with pytest.raises(ValueError):
        codecs.evolved([spark.createDataFrame([("x",)], "b string")], schema)
    with pytest.raises(ValueError):
        codecs.evolved([spark.createDataFrame([("x", 1)], "a string, z int")], schema)
