"""Filters, projections, routing, topics."""

from datetime import datetime, timezone

from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidelog import session
from tidelog.operators.log import Log
from tidelog.operators.validate import to_validated
from tidelog.plans.registry import (ACCOUNT_STATE, ACCOUNTS, EVENTS, accounts, amounts, as_double,
                                    events, query, typed)
from tidelog.sources.indexed import append_indexed, indexed_offsets, read_indexed
from tidelog.sources.named import NamedTable
from tidelog.sources.sinks import append_log, write_as_text, write_branches, write_log
from tidelog.sources.topics import (Catalog, Topic, read_log, read_logs, read_pattern, subscribe,
                                    topics_of)

DOUBLE_V = "CAST(v AS DOUBLE)"


def plain(log, key="user_id", value="value"):
    return log.df.select(F.col("key").alias(key), as_double("value").alias(value),
                         F.col("offset").alias("event_id"))


@query("filter_stream", f"SELECT user_id, {DOUBLE_V} AS value, event_id FROM ({EVENTS}) WHERE v > 50")
def filter_stream(spark, d):
    return plain(amounts(spark, d).filter(lambda k, v: v > 50))


@query("filter_not_stream", f"""
SELECT user_id, {DOUBLE_V} AS value, event_id FROM ({EVENTS})
WHERE NOT coalesce(CASE WHEN event_type = 'error' THEN NULL ELSE v > 50 END, FALSE)""")
def filter_not_stream(spark, d):
    log = events(spark, d).filter_not(
        lambda k, v: F.when(v["event_type"] != "error", v["amount"] > 50))
    return plain(log.map_values(lambda v: v["amount"]))


@query("map_values", f"SELECT user_id, CAST(v * 2 AS DOUBLE) AS value, event_id FROM ({EVENTS})")
def map_values(spark, d):
    return plain(amounts(spark, d).map_values(lambda v: v * 2))


@query("map_kv", f"SELECT user_id + 1 AS user_id, CAST(v + 1 AS DOUBLE) AS value, event_id FROM ({EVENTS})")
def map_kv(spark, d):
    return plain(amounts(spark, d).map(lambda k, v: (k + 1, v + 1)))


@query("select_key", f"SELECT event_type, {DOUBLE_V} AS value, event_id FROM ({EVENTS})")
def select_key(spark, d):
    log = events(spark, d).select_key(lambda k, v: v["event_type"])
    return plain(log.map_values(lambda v: v["amount"]), key="event_type")


@query("flat_map", f"""
SELECT user_id, {DOUBLE_V} AS value, event_id, 0 AS pos FROM ({EVENTS})
UNION ALL SELECT -user_id, CAST(v * 2 AS DOUBLE), event_id, 1 FROM ({EVENTS})""")
def flat_map(spark, d):
    log = amounts(spark, d).map_values(as_double).flat_map(lambda k, v: [(k, v), (-k, v * 2)])
    return log.df.select(F.col("key").alias("user_id"), "value", F.col("offset").alias("event_id"),
                         F.col(log.order[-1]).alias("pos"))


@query("flat_map_values", f"""
SELECT user_id, unnest([{DOUBLE_V}, {DOUBLE_V} + 1]) AS value, event_id,
       unnest([0, 1]) AS pos FROM ({EVENTS})""")
def flat_map_values(spark, d):
    log = amounts(spark, d).map_values(as_double).flat_map_values(lambda v: [v, v + 1])
    return log.df.select(F.col("key").alias("user_id"), "value", F.col("offset").alias("event_id"),
                         F.col(log.order[-1]).alias("pos"))


@query("branch_route", f"""
SELECT event_id, CASE WHEN event_type = 'purchase' THEN 0 WHEN v > 50 THEN 1
  WHEN event_type = 'click' THEN 2 END AS branch FROM ({EVENTS})
WHERE event_type IN ('purchase', 'click') OR v > 50""")
def branch_route(spark, d):
    routed = events(spark, d).branch_ids([
        lambda k, v: v["event_type"] == "purchase", lambda k, v: v["amount"] > 50,
        lambda k, v: v["event_type"] == "click"])
    return routed.df.where(F.col("branch").isNotNull()).select(
        F.col("offset").alias("event_id"), "branch")


@query("branch_counts", f"""
SELECT 'large' AS branch, count(*) AS n FROM ({EVENTS}) WHERE v > 50
UNION ALL SELECT 'rest', count(*) FROM ({EVENTS}) WHERE NOT v > 50""")
def branch_counts(spark, d):
    large, rest = amounts(spark, d).branch([lambda k, v: v > 50, lambda k, v: F.lit(True)])
    count = lambda log, n: log.df.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(n).alias("branch"), "n")
    return count(large, "large").unionByName(count(rest, "rest"))


@query("merge_streams", f"""
SELECT user_id, {DOUBLE_V} AS value, event_id FROM ({EVENTS}) WHERE event_type = 'purchase'
UNION ALL SELECT user_id, {DOUBLE_V}, event_id FROM ({EVENTS}) WHERE v > 50""")
def merge_streams(spark, d):
    log = events(spark, d)
    both = typed(log, "purchase").merge(log.filter(lambda k, v: v["amount"] > 50))
    return plain(both.map_values(lambda v: v["amount"]))


@query("count_observed", f"SELECT count(*) AS n, max(event_id) AS last FROM ({EVENTS}) WHERE v > 50")
def count_observed(spark, d):
    """A peek measures the records on their way."""
    log = amounts(spark, d).filter(lambda k, v: v > 50)
    seen = log.peek("seen", F.count(F.lit(1)).alias("records"))
    return seen.df.agg(F.count(F.lit(1)).alias("n"), F.max("offset").alias("last"))


@query("peek_metric", f"""
SELECT count(*) AS records, CAST(sum(v) AS DOUBLE) AS total FROM ({EVENTS}) WHERE v > 50""")
def peek_metric(spark, d):
    """What a peek has measured once the records have passed it."""
    seen = Observation()
    log = amounts(spark, d).filter(lambda k, v: v > 50)
    passing = log.peek(seen, F.count(F.lit(1)).alias("records"), F.sum("value").alias("total"))
    passing.map_values(lambda v: v * 2).df.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(seen.get["records"], float(seen.get["total"]))],
                                 "records long, total double")


@query("for_each_effects", f"""
SELECT count(*) AS records, CAST(sum(v) AS DOUBLE) AS total FROM ({EVENTS}) WHERE v > 50""")
def for_each_effects(spark, d):
    """An action called with every record, here adding to counters of the driver."""
    records, cents = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def action(row):
        records.add(1)
        cents.add(int(row["value"] * 100))

    amounts(spark, d).filter(lambda k, v: v > 50).for_each(action)
    return spark.createDataFrame([(records.value, cents.value / 100)], "records long, total double")


@query("branches_to_topics", f"""
SELECT CASE WHEN v > 70 THEN 'high' ELSE 'middle' END AS topic, user_id, {DOUBLE_V} AS value, event_id
FROM ({EVENTS}) WHERE v > 30""")
def branches_to_topics(spark, d):
    """Branches written to a topic each, from one pass; records of no branch are dropped."""
    routes = {0: _topic(spark, "high", partitions=4), 1: _topic(spark, "middle")}
    write_branches(amounts(spark, d).branch_ids([lambda k, v: v > 70, lambda k, v: v > 30]), routes)
    return _read_back(read_logs(spark, list(routes.values())))


# -- topics on storage ----------------------------------------------------------


def _topic(spark, name, **kwargs):
    return Topic(name, "bigint", "decimal(12,2)", path=session.shared_folder(spark, name), **kwargs)


def _event_topics(spark, d):
    """Purchases and clicks, written to one topic each."""
    log, catalog = events(spark, d), Catalog()
    for name in ("purchase", "click"):
        topic = _topic(spark, name, partitions=4)
        write_log(typed(log, name).map_values(lambda v: v["amount"]), topic)
        catalog.add(topic)
    return catalog


def _read_back(log):
    return log.df.select("topic", F.col("key").alias("user_id"), as_double("value").alias("value"),
                         F.col("offset").alias("event_id"))


TOPICS = f"""SELECT event_type AS topic, user_id, {DOUBLE_V} AS value, event_id FROM ({EVENTS})
WHERE event_type IN ('purchase', 'click')"""


@query("multi_topic", TOPICS)
def multi_topic(spark, d):
    catalog = _event_topics(spark, d)
    return _read_back(read_logs(spark, [catalog["purchase"], catalog["click"]]))


@query("subscribed_topics", TOPICS)
def subscribed_topics(spark, d):
    return _read_back(subscribe(spark, _event_topics(spark, d), ["purchase", "click"]))


@query("validated_topic", f"SELECT user_id, {DOUBLE_V} AS value, event_id FROM ({EVENTS}) WHERE v > 50")
def validated_topic(spark, d):
    """Only records that keep the rules are written; one that breaks them fails the write."""
    topic = _topic(spark, "validated", partitions=4)
    to_validated(amounts(spark, d).filter(lambda k, v: v > 50), topic, {"large": lambda k, v: v > 50})
    return plain(read_log(spark, topic))


@query("text_lines", f"SELECT CAST(user_id AS VARCHAR) || ', ' || CAST(v AS VARCHAR) AS line FROM ({EVENTS})")
def text_lines(spark, d):
    """One line of text per record, written and read back."""
    place = session.shared_folder(spark, "text")
    write_as_text(amounts(spark, d), place)
    return spark.read.text(place).withColumnRenamed("value", "line")


@query("topic_exists", """
SELECT event_type AS topic, event_type IN ('purchase', 'click') AS present
FROM events GROUP BY event_type""")
def topic_exists(spark, d):
    """Which of the event types have a topic."""
    catalog = _event_topics(spark, d)
    asked = [r["topic"] for r in topics_of(events(spark, d)).collect()]  # one row per topic
    return spark.createDataFrame([(t, catalog.exists(t)) for t in asked], "topic string, present boolean")


@query("pattern_topic", TOPICS + " AND event_type LIKE 'cl%'")
def pattern_topic(spark, d):
    return _read_back(read_pattern(spark, _event_topics(spark, d), "cl.*"))


@query("through_topic", f"""
SELECT user_id, {DOUBLE_V} AS value, event_id, CAST(user_id % 3 AS INTEGER) AS partition
FROM ({EVENTS})""")
def through_topic(spark, d):
    topic = _topic(spark, "through", partitions=3, partition_fn=lambda k, v, n: k % n)
    log = amounts(spark, d).through(topic)
    return log.df.select(F.col("key").alias("user_id"), as_double("value").alias("value"),
                         F.col("offset").alias("event_id"), "partition")


@query("append_offsets", f"""
SELECT part AS partition, n AS offset, ts FROM (
  SELECT part, ts, row_number() OVER (PARTITION BY part ORDER BY second, ts, event_id) - 1 AS n,
         second
  FROM (SELECT *, CAST(event_type <> 'purchase' AS INTEGER) AS second FROM ({EVENTS})
        WHERE event_type IN ('purchase', 'click')))""")
def append_offsets(spark, d):
    """Two appends: the second goes on where the first ended."""
    topic = _topic(spark, "appended", partitions=4, partition_fn=lambda k, v, n: k % n)
    log = events(spark, d)
    parts = [append_log(typed(log, name).map_values(lambda v: v["amount"]), topic)
             for name in ("purchase", "click")]
    return parts[0].unionByName(parts[1]).select(
        "partition", "offset", F.col("ts").cast("timestamp_ntz").alias("ts"))


INDEXED = f"""SELECT part, ts, event_id, row_number() OVER (
    PARTITION BY part ORDER BY second, ts, event_id) - 1 AS n
  FROM (SELECT *, CAST(event_type <> 'purchase' AS INTEGER) AS second FROM ({EVENTS})
        WHERE event_type IN ('purchase', 'click'))"""


def _indexed(spark, d):
    topic = _topic(spark, "indexed", partitions=4, partition_fn=lambda k, v, n: k % n)
    for name in ("purchase", "click"):
        append_indexed(typed(events(spark, d), name).map_values(lambda v: v["amount"]), topic)
    return topic


@query("indexed_offsets", f"""
SELECT 'indexed' AS topic, part AS partition, 0::BIGINT AS begin_offset, count(*) AS end_offset
FROM ({INDEXED}) GROUP BY part""")
def indexed_topic_offsets(spark, d):
    """Offsets of a topic with a manifest after two appends; no data is read."""
    return indexed_offsets(spark, _indexed(spark, d))


@query("indexed_seek", f"""
SELECT part AS partition, n AS "offset", ts FROM ({INDEXED}) JOIN (
  SELECT part, min(n) FILTER (ts >= TIMESTAMP '2024-01-20 12:00:00') AS head FROM ({INDEXED}) GROUP BY part)
USING (part) WHERE n >= head""")
def indexed_seek(spark, d):
    """From a time on, opening only the folders the manifest names."""
    log = read_indexed(spark, _indexed(spark, d), since=datetime(2024, 1, 20, 12, tzinfo=timezone.utc))
    return log.df.select("partition", "offset", F.col("ts").cast("timestamp_ntz").alias("ts"))


# -- tables -------------------------------------------------------------------------


@query("table_snapshot", f"SELECT user_id, {DOUBLE_V} AS value FROM ({ACCOUNT_STATE})")
def table_snapshot(spark, d):
    return accounts(spark, d).snapshot().select(
        F.col("key").alias("user_id"), as_double("value").alias("value"))


@query("table_from_topic", f"SELECT user_id, {DOUBLE_V} AS value FROM ({ACCOUNT_STATE})")
def table_from_topic(spark, d):
    """The same table, read back from a topic and kept as a named view."""
    from tidelog.plans.registry import accounts_log
    from tidelog.sources.topics import read_table
    topic = _topic(spark, "accounts", partitions=4)
    write_log(accounts_log(spark, d), topic)
    read_table(spark, topic, store="account_state")
    return spark.table("account_state").select(
        F.col("key").alias("user_id"), as_double("value").alias("value"))


def _account_state(spark, d):
    """The accounts, taken in by two upserts with a compaction between them."""
    from tidelog.plans.registry import accounts_log
    log = accounts_log(spark, d)
    kept = NamedTable(session.shared_folder(spark, "accounts"), "bigint", "decimal(12,2)", 8)
    for early in (True, False):
        half = (F.col("ts") < F.lit("2024-01-15").cast("timestamp")) == F.lit(early)
        kept.upsert(Log(log.df.where(half), log.order))
        if early:
            kept.compact(spark)
    return kept


@query("named_table", f"SELECT user_id, {DOUBLE_V} AS value FROM ({ACCOUNT_STATE})")
def named_table(spark, d):
    return _account_state(spark, d).snapshot(spark).select(
        F.col("key").alias("user_id"), as_double("value").alias("value"))


@query("named_table_lookup", f"""
SELECT user_id, {DOUBLE_V} AS value FROM ({ACCOUNT_STATE}) WHERE user_id IN (3, 7, 8)""")
def named_table_lookup(spark, d):
    """Some keys of a table on storage; only their buckets are read."""
    return _account_state(spark, d).lookup(spark, [3, 7, 8]).select(
        F.col("key").alias("user_id"), as_double("value").alias("value"))


FILTERED = f"""
SELECT user_id, event_id, CAST(out AS DOUBLE) AS value FROM (
  SELECT *, lag(out) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM (
    SELECT *, CASE WHEN {{cond}} THEN v END AS out FROM ({ACCOUNTS})))
WHERE out IS NOT NULL OR before IS NOT NULL"""


@query("table_filter_changelog", FILTERED.format(cond="v > 50"))
def table_filter_changelog(spark, d):
    return plain(accounts(spark, d).filter(lambda k, v: v > 50).updates())


@query("table_filter_not_changelog", FILTERED.format(cond="NOT v > 50"))
def table_filter_not_changelog(spark, d):
    return plain(accounts(spark, d).filter_not(lambda k, v: v > 50).updates())


@query("table_filter_snapshot", f"SELECT user_id, {DOUBLE_V} AS value FROM ({ACCOUNT_STATE}) WHERE v > 50")
def table_filter_snapshot(spark, d):
    return accounts(spark, d).filter(lambda k, v: v > 50).snapshot().select(
        F.col("key").alias("user_id"), as_double("value").alias("value"))


@query("table_map_values", f"SELECT user_id, event_id, CAST(v * 3 AS DOUBLE) AS value FROM ({ACCOUNTS})")
def table_map_values(spark, d):
    return plain(accounts(spark, d).map_values(lambda v: v * 3).updates())


@query("table_to_stream", f"SELECT user_id * 10 AS user_id, event_id, {DOUBLE_V} AS value FROM ({ACCOUNTS})")
def table_to_stream(spark, d):
    return plain(accounts(spark, d).to_stream(lambda k, v: k * 10))


@query("read_assigned", f"""
SELECT event_type AS topic, CAST(part AS INTEGER) AS partition, event_id FROM ({EVENTS})
WHERE (event_type = 'click' AND part = 1) OR (event_type = 'view' AND part = 3)""")
def read_assigned(spark, d):
    from tidelog.sources.topics import assign
    log = assign(events(spark, d), ("click", 1), ("view", 3))
    return log.df.select("topic", "partition", F.col("offset").alias("event_id"))


__all__ = ["read_log"]
