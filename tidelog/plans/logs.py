"""Addressing a log, partitioning it, looking things up in captured output."""

from pyspark.sql import functions as F

from tidelog.functions import partitioning as P
from tidelog.functions.scalars import long_to_bytes
from tidelog.operators import lookup
from tidelog.operators.log import Log
from tidelog.plans.registry import EVENTS, as_double, events, query, table
from tidelog.sources import addressing as A
from tidelog.sources.topics import topics_of

SHARDS = f"""SELECT event_type AS topic, part AS partition, event_id AS "offset", ts, v, user_id
FROM ({EVENTS})"""
NOON = "TIMESTAMP '2024-01-20 12:00:00'"
LATE = "TIMESTAMP '2024-01-30 23:00:00'"


def at(text):
    return F.lit(text).cast("timestamp_ntz")


@query("count_messages", "SELECT event_type AS topic, count(*) AS messages FROM events GROUP BY 1")
def count_messages(spark, d):
    return A.count_messages(events(spark, d))


@query("count_messages_dense", "SELECT 'events' AS topic, count(*) AS messages FROM events")
def count_messages_dense(spark, d):
    """The whole event log is one partition whose offsets have no gaps."""
    log = events(spark, d)
    whole = Log(log.df.withColumns({"topic": F.lit("events"), "partition": F.lit(0)}), log.order)
    return A.count_messages(whole, dense=True)


@query("topic_partitions", f"""
SELECT topic, list_sort(list(DISTINCT partition)) AS partitions,
  count(DISTINCT partition) AS num_partitions FROM ({SHARDS}) GROUP BY topic""")
def topic_partitions(spark, d):
    return A.partitions_of(events(spark, d))


@query("topic_names", "SELECT DISTINCT event_type AS topic FROM events")
def topic_names(spark, d):
    return topics_of(events(spark, d))


@query("end_offsets", f"""
SELECT topic, partition, min("offset") AS begin_offset, max("offset") + 1 AS end_offset
FROM ({SHARDS}) GROUP BY topic, partition""")
def end_offsets(spark, d):
    return A.offsets(events(spark, d))


@query("describe_topics", f"""
SELECT topic, partition, count(*) AS messages, min("offset") AS begin_offset,
  max("offset") + 1 AS end_offset, min(ts) AS first_ts, max(ts) AS last_ts
FROM ({SHARDS}) GROUP BY topic, partition""")
def describe_topics(spark, d):
    return A.describe(events(spark, d))


@query("offsets_for_times", f"""
WITH asked AS (
  SELECT topic, partition, min(ts) + INTERVAL '3 days' AS "at" FROM ({SHARDS}) GROUP BY 1, 2
  UNION ALL SELECT topic, partition, max(ts) + INTERVAL '1 day' FROM ({SHARDS}) GROUP BY 1, 2)
SELECT topic, partition, "at", min("offset") FILTER (ts >= "at") AS "offset"
FROM asked JOIN ({SHARDS}) USING (topic, partition) GROUP BY 1, 2, 3""")
def offsets_for_times(spark, d):
    log = events(spark, d)
    ends = log.df.groupBy("topic", "partition").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    asked = ends.select("topic", "partition", F.explode(F.array(
        F.col("a") + F.expr("INTERVAL 3 DAYS"), F.col("b") + F.expr("INTERVAL 1 DAY"))).alias("at"))
    return A.offsets_for_times(log, asked)


STARTS = f"""SELECT topic, partition,
  coalesce(min("offset") FILTER (ts >= {LATE}), max("offset") + {{past}}) AS "offset"
FROM ({SHARDS}) GROUP BY topic, partition"""


@query("start_offsets", STARTS.format(past=1))
def start_offsets(spark, d):
    return A.start_offsets(events(spark, d), at("2024-01-30 23:00:00"))


@query("start_offsets_past_end", STARTS.format(past=2))
def start_offsets_past_end(spark, d):
    return A.start_offsets(events(spark, d), at("2024-01-30 23:00:00"), "end_plus_one")


@query("seek_to_timestamp", f"""
SELECT topic, partition, "offset" FROM ({SHARDS}) JOIN (
  SELECT topic, partition, min("offset") FILTER (ts >= {NOON}) AS first
  FROM ({SHARDS}) GROUP BY 1, 2) USING (topic, partition) WHERE "offset" >= first""")
def seek_to_timestamp(spark, d):
    return A.seek_to_timestamp(events(spark, d), at("2024-01-20 12:00:00")).df.select(
        "topic", "partition", "offset")


@query("read_until", f"""SELECT topic, partition, "offset" FROM ({SHARDS}) WHERE ts < {NOON}""")
def read_until(spark, d):
    return A.until(events(spark, d), at("2024-01-20 12:00:00")).df.select(
        "topic", "partition", "offset")


# -- partitioning -------------------------------------------------------------------------

M = 0x5BD1E995


def _swap(word):
    return (f"((({word}) & 255) << 24) | (((({word}) >> 8) & 255) << 16) | "
            f"(((({word}) >> 16) & 255) << 8) | ((({word}) >> 24) & 255)")


def _mul(x):
    return f"((({x})::UBIGINT * {M}::UBIGINT) & 4294967295::UBIGINT)"


def _shift(x, n):
    return f"xor({x}, {x} >> {n})"


# murmur2 of an eight-byte big-endian key, one step per line
MURMUR2 = f"""
WITH s0 AS (SELECT event_id, user_id, ({_swap('user_id >> 32')})::UBIGINT AS a,
              ({_swap('user_id')})::UBIGINT AS b FROM events),
s1 AS (SELECT event_id, user_id, {_mul('a')} AS a, {_mul('b')} AS b FROM s0),
s2 AS (SELECT event_id, user_id, {_mul(_shift('a', 24))} AS a, {_mul(_shift('b', 24))} AS b FROM s1),
s3 AS (SELECT event_id, user_id, b, xor({_mul(f'{0x9747B28C ^ 8}')}, a) AS h FROM s2),
s4 AS (SELECT event_id, user_id, xor({_mul('h')}, b) AS h FROM s3),
s5 AS (SELECT event_id, user_id, {_mul(_shift('h', 13))} AS h FROM s4),
s6 AS (SELECT event_id, user_id, {_shift('h', 15)} AS h FROM s5)
SELECT event_id, CAST(CASE WHEN h > 2147483647 THEN h::BIGINT - 4294967296 ELSE h END AS INTEGER)
  AS hash, CAST((h & 2147483647::UBIGINT) % 12 AS INTEGER) AS partition FROM s6"""


@query("murmur2_partition", MURMUR2)
def murmur2_partition(spark, d):
    log = events(spark, d)
    return log.df.select(
        F.col("offset").alias("event_id"), P.murmur2_of_long(F.col("key")).alias("hash"),
        P.partition_of(F.col("key"), log.key_type, 12).alias("partition"))


@query("murmur2_bytes", MURMUR2)
def murmur2_bytes(spark, d):
    """The same through the serialized key, as any other key type goes."""
    data = long_to_bytes(F.col("key"))
    return events(spark, d).df.select(
        F.col("offset").alias("event_id"), P.murmur2(data).alias("hash"),
        P.default_partition(data, 12).alias("partition"))


@query("key_from_path", "SELECT event_id, json_extract_string(props, '$.k') AS key FROM events")
def key_from_path(spark, d):
    return events(spark, d).df.select(F.col("offset").alias("event_id"),
                                      P.key_from_json(F.col("value.props"), "$.k").alias("key"))


@query("address_records", """
SELECT event_id, CASE WHEN event_type = 'click' THEN -1 ELSE user_id END AS key,
  CAST(CASE WHEN event_type = 'view' THEN 5
    ELSE CASE WHEN event_type = 'click' THEN 1 ELSE user_id % 6 END END AS INTEGER) AS partition
FROM events""")
def address_records(spark, d):
    """Given keys and partitions win; the rest is computed."""
    df = table(spark, d, "events").select(
        "event_id", F.when(F.col("event_type") == "click", F.lit(-1)).cast("long").alias("key"),
        F.struct(F.col("user_id").alias("id"), "value").alias("value"),
        F.when(F.col("event_type") == "view", F.lit(5)).alias("partition"))
    made = P.addressed(df, 6, partition=lambda k, v, n: F.abs(k) % n)
    return made.select("event_id", "key", "partition")


# -- captured output ------------------------------------------------------------------------


def _captured(spark, d):
    """Events whose value carries its id, as output captured from a topic."""
    log = events(spark, d)
    value = F.struct(F.col("key").alias("id"), F.col("value.amount").alias("v"),
                     F.struct("value.event_type").alias("kind"))
    return Log(log.df.withColumn("value", value), log.order)


def _found(df):
    return df.select(F.col("value.id").alias("id"), as_double("value.v").alias("v"),
                     F.col("value.kind.event_type").alias("event_type"))


FOUND = f"SELECT user_id AS id, CAST(v AS DOUBLE) AS v, event_type FROM ({EVENTS})"


@query("journal_messages", FOUND + " WHERE event_type = 'purchase'")
def journal_messages(spark, d):
    return _found(lookup.messages(_captured(spark, d), "purchase"))


@query("journal_where", FOUND + " WHERE v > 90")
def journal_where(spark, d):
    return _found(lookup.messages_where(_captured(spark, d), "v", lambda c: c > 90).df)


@query("journal_equal", FOUND + " WHERE event_type = 'click'")
def journal_equal(spark, d):
    return _found(lookup.messages_equal(_captured(spark, d), "kind.event_type", "click").df)


@query("journal_by_key", f"""
{FOUND} WHERE event_type = 'signup' ORDER BY part, event_id LIMIT 1""")
def journal_by_key(spark, d):
    return _found(lookup.by_key(_captured(spark, d), "kind.event_type", "signup"))


@query("journal_by_id", f"""
{FOUND} WHERE user_id = 7 ORDER BY part, event_id LIMIT 1""")
def journal_by_id(spark, d):
    return _found(lookup.by_id(_captured(spark, d), 7))


@query("journal_by_keys", FOUND + " WHERE event_type IN ('click', 'view')")
def journal_by_keys(spark, d):
    return _found(lookup.by_keys(_captured(spark, d), "kind.event_type", ["click", "view"]).df)


@query("journal_by_key_table", FOUND + " WHERE user_id IN (SELECT c_custkey FROM customer)")
def journal_by_key_table(spark, d):
    ids = table(spark, d, "customer").select("c_custkey")
    return _found(lookup.by_keys(_captured(spark, d), "id", ids).df)


@query("journal_missing_ids", """
SELECT DISTINCT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)""")
def journal_missing_ids(spark, d):
    ids = table(spark, d, "customer").select("c_custkey")
    return lookup.missing_ids(_captured(spark, d), "id", ids)
