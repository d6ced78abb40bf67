"""The streaming forms, run over all events to the end of the input."""

from dataclasses import replace

from pyspark.sql import functions as F

from tidelog import session
from tidelog.operators.log import Log
from tidelog.operators.reducers import largest, total
from tidelog.operators.stateful import Store

from tidelog.plans.aggregates import BAND_EXTREMES, BAND_RUN, FLOORED, FOLDED, SIGNED
from tidelog.plans.joins import ACCOUNTS, AS_OF, CHANGES, FK_CHANGES, LIVE, NEAR, VIEWS, WINDOWED, add, referring
from tidelog.plans.registry import ACCOUNT_STATE, EVENTS, as_double, events_log, query, table, typed
from tidelog.plans.stateless import FILTERED
from tidelog.plans.transforms import RUN
from tidelog.plans.windows import BUCKET, ISLANDS, SESSION_CHANGES, SESSIONS, SIX_HOURS
from tidelog.sources.sinks import write_log
from tidelog.sources.topics import Topic, read_matching
from tidelog.streaming.drain import drain, newest, read_stream


def stream(spark, d):
    """Events as a stream; event time has to be an instant there."""
    df = read_stream(spark, d, "events")
    return events_log(df.withColumn("ts", F.col("ts").cast("timestamp")))


# Rows a micro-batch of ``arriving`` is meant to hold.
ROWS_AT_ONCE = 2_000_000


def arriving(spark, d, mixed=False, fewest=5):
    """Events as a stream of one file per micro-batch, however many there are: pieces of time, in order
    and of about equally many rows, or equally long and in the order of ``MIXED_UP``."""
    df = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    at = F.unix_micros("ts")
    rows, lo, hi = df.agg(F.count("ts"), F.min(at), F.max(at)).first()
    least = -(-rows // ROWS_AT_ONCE)
    if rows and mixed:
        # a record is two pieces late at most, which have to be within the delay
        turns = max(least, -(-(hi - lo + 1) // (TEN_DAYS * 1000 // 2)), 1)
        turns = -(-turns // len(MIXED_UP)) * len(MIXED_UP)
        # a whole number, since a double cannot tell where a piece ends
        piece = F.expr(f"cast((unix_micros(ts) - {lo}L) div {-(-(hi - lo + 1) // turns)}L as int)")
        order = [k + i for k in range(0, turns, len(MIXED_UP)) for i in MIXED_UP]
    else:
        order = range(max(least, fewest))
        shares = [i / len(order) for i in order[1:]]
        cuts = shares and df.agg(F.percentile_approx(at, shares, 10_000)).first()[0] or []
        piece = sum((F.when(at > c, 1).otherwise(0) for c in cuts), F.lit(0))
    whole, place = session.shared_folder(spark, "pieces"), session.shared_folder(spark, "arriving")
    df.withColumn("piece", piece).write.partitionBy("piece").parquet(whole)
    pieces = spark.read.schema(df.withColumn("piece", F.lit(0)).schema).parquet(whole)
    for i, turn in enumerate(order):
        # a file is a micro-batch, and files are taken in the order they were written; its groups of rows
        # are small, so that several tasks read it
        pieces.where(F.col("piece") == turn).drop("piece").coalesce(1).write.option(
            "parquet.block.size", 4 << 20).parquet(f"{place}/{i:06d}")
    files = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option(
        "recursiveFileLookup", "true").parquet(place)
    return events_log(files)


MIXED_UP = (1, 0, 2, 4, 3, 5)
# Records out of order wait for ten days; two pieces of time cover as many at most.
TEN_DAYS = 10 * 24 * 3_600_000


def amounts(spark, d):
    return stream(spark, d).map_values(lambda v: v["amount"])


def local(c):
    return F.col(c).cast("timestamp_ntz")


def _windows(df, *more):
    return df.select(F.col("key").alias("user_id"), local("window.start").alias("start"),
                     local("window.end").alias("end"), as_double("value").alias("value"), *more)


@query("stream_filter", f"SELECT user_id, event_id, CAST(v * 2 AS DOUBLE) AS value FROM ({EVENTS}) WHERE v > 50")
def stream_filter(spark, d):
    log = amounts(spark, d).filter(lambda k, v: v > 50).map_values(lambda v: v * 2)
    return drain(log.df.select(F.col("key").alias("user_id"), F.col("offset").alias("event_id"),
                               as_double("value").alias("value")))


@query("stream_count", f"SELECT user_id, count(*) AS n FROM ({EVENTS}) GROUP BY user_id")
def stream_count(spark, d):
    df = amounts(spark, d).group_by_key().count().snapshot()
    return newest(drain(df.select(F.col("key").alias("user_id"), F.col("value").alias("n")),
                        "update"), ["user_id"])


@query("stream_table", f"SELECT user_id, CAST(v AS DOUBLE) AS value FROM ({ACCOUNT_STATE})")
def stream_table(spark, d):
    """An upsert table kept up to date by a stream, deletes included."""
    log = stream(spark, d)
    log = Log(log.df.where(F.col("topic").isin("purchase", "signup")), log.order)
    log = log.map_values(lambda v: F.struct(F.when(
        v["event_type"] == "purchase", v["amount"]).alias("v")))
    df = newest(drain(log.to_table().snapshot(), "update"), ["key"])
    return df.where("value.v IS NOT NULL").select(
        F.col("key").alias("user_id"), as_double("value.v").alias("value"))


def _accounts(spark, d):
    return _table_of(stream(spark, d))


def _table_of(log):
    log = Log(log.df.where(F.col("topic").isin("purchase", "signup")), log.order)
    return log.map_values(lambda v: F.when(v["event_type"] == "purchase", v["amount"])).to_table()


def _changes(log, key="user_id", *more):
    return drain(log.df.select(F.col("key").alias(key), F.col("offset").alias("event_id"),
                               as_double("value").alias("value"), *more))


@query("stream_table_filter", FILTERED.format(cond="v > 50"))
def stream_table_filter(spark, d):
    return _changes(_accounts(spark, d).filter(lambda k, v: v > 50).updates())


@query("stream_table_group_sum", f"""
SELECT band, event_id, CAST(sum(sign * x) {BAND_RUN} AS DOUBLE) AS value FROM ({SIGNED})""")
def stream_table_group_sum(spark, d):
    """Rows that change group are taken out of the old one and put into the new one."""
    # few bands hold everything, so it is the micro-batch that bounds what a task sorts
    grouped = _table_of(arriving(spark, d, fewest=1)).group_by(lambda k, v: (F.floor(v / 20).cast("long"), v))
    return _changes(grouped.reduce(total()).updates(), "band")


@query("stream_table_join_changelog", CHANGES.format(live=LIVE["outer"]))
def stream_table_join_changelog(spark, d):
    clicks = typed(stream(spark, d), "click").map_values(lambda v: v["amount"]).to_table()
    joined = _accounts(spark, d).outer_join(clicks, add)
    return _changes(joined.updates(), "user_id", "side")


@query("stream_tumbling", f"""
SELECT user_id, start, start + INTERVAL '6 hours' AS "end", CAST(sum(v) AS DOUBLE) AS value
FROM (SELECT *, {BUCKET} AS start FROM ({EVENTS})) GROUP BY user_id, start
HAVING start + INTERVAL '7 hours' <= (SELECT max(ts) FROM events)""")
def stream_tumbling(spark, d):
    """Final windows only: append mode holds a window until the watermark passes its end."""
    log = amounts(spark, d).with_watermark(SIX_HOURS.grace_ms)
    table = log.group_by_key().window_by_time(SIX_HOURS).reduce(total())
    return _windows(drain(table.suppress().df))


@query("stream_session", f"""
SELECT user_id, min(ts) AS start, max(ts) AS "end", CAST(sum(v) AS DOUBLE) AS value
FROM ({ISLANDS}) GROUP BY user_id, s
HAVING max(ts) + INTERVAL '6 hours' <= (SELECT max(ts) FROM events)""")
def stream_session(spark, d):
    log = amounts(spark, d).with_watermark(SESSIONS.grace_ms)
    table = log.group_by_key().window_by_session(SESSIONS).reduce(total())
    return _windows(drain(table.snapshot()))


@query("stream_windowed_join", WINDOWED.format(how="INNER"))
def stream_windowed_join(spark, d):
    left, right = (typed(stream(spark, d), t).map_values(lambda v: v["amount"]).with_watermark(0)
                   for t in ("view", "purchase"))
    log = left.join_windowed(right, add, NEAR)
    return drain(log.df.select(
        F.col("key").alias("user_id"), as_double("value").alias("value"),
        F.col("offset").alias("event_id"), F.col("other_offset").alias("other_id")))


@query("stream_as_of_join", AS_OF.format(how="", where="WHERE r.v IS NOT NULL"))
def stream_as_of_join(spark, d):
    log = stream(spark, d)
    updates = Log(log.df.where(F.col("topic").isin("purchase", "signup")), log.order).map_values(
        lambda v: F.when(v["event_type"] == "purchase", v["amount"]))
    views = typed(log, "view").map_values(lambda v: v["amount"])
    out = views.join(updates.to_table(), lambda a, b: a + b)
    return drain(out.df.select(F.col("key").alias("user_id"), F.col("offset").alias("event_id"),
                               as_double("value").alias("value")))


@query("stream_changelog", f"""
SELECT user_id, event_id, CAST(sum(v) {RUN} AS DOUBLE) AS value FROM ({EVENTS})""")
def stream_changelog(spark, d):
    out = amounts(spark, d).group_by_key().reduce(total()).updates()
    return drain(out.df.select(F.col("key").alias("user_id"), F.col("offset").alias("event_id"),
                               as_double("value").alias("value")))


@query("stream_state_sum", f"""
SELECT user_id, event_id, CAST(sum(v) {RUN} AS DOUBLE) AS value FROM ({EVENTS})""")
def stream_state_sum(spark, d):
    """A user's own step with a named store."""
    def step(ctx, key, value):
        store = ctx.store("sums")
        now = store.get()
        store.put({"value": value if now is None else now["value"] + value})
        return key, store.get()["value"]

    log = amounts(spark, d).transform(step, "long", "decimal(20,2)",
                                      [Store("sums", "struct<value:decimal(20,2)>")])
    return drain(log.df.select(F.col("key").alias("user_id"), F.col("offset").alias("event_id"),
                               as_double("value").alias("value")))


@query("stream_fold", f"SELECT user_id, event_id, CAST(b AS DOUBLE) AS value FROM ({FOLDED})")
def stream_fold(spark, d):
    """A fold that depends on record order, kept as state."""
    table = amounts(spark, d).group_by_key().fold(FLOORED)
    return _changes(table.map_values(lambda v: v["floored"]).updates())


@query("stream_fk_join", FK_CHANGES)
def stream_fk_join(spark, d):
    views = typed(stream(spark, d), "view").map_values(lambda v: v["amount"])
    return _changes(referring(views, _accounts(spark, d)).updates(), "user_id", "side")


@query("stream_session_changelog", SESSION_CHANGES)
def stream_session_changelog(spark, d):
    table = amounts(spark, d).group_by_key().window_by_session(SESSIONS).reduce(total())
    return drain(_windows(table.updates().df, F.col("offset").alias("event_id")))


CLOSED = "HAVING start + INTERVAL '7 hours' <= (SELECT max(ts) FROM events)"
WINDOW_FOLDED = f"""
SELECT user_id, start, start + INTERVAL '6 hours' AS "end",
       CAST(arg_max(s - least(0, low), (ts, event_id)) AS DOUBLE) AS value
FROM (SELECT *, min(s) OVER w AS low FROM (
        SELECT *, sum(v - 50) OVER (PARTITION BY user_id, start ORDER BY ts, event_id) AS s
        FROM (SELECT *, {BUCKET} AS start FROM ({EVENTS})))
      WINDOW w AS (PARTITION BY user_id, start ORDER BY ts, event_id))
GROUP BY user_id, start {CLOSED}"""


@query("stream_window_fold", WINDOW_FOLDED)
def stream_window_fold(spark, d):
    """A fold over windows, kept as state and given once its window has closed."""
    log = arriving(spark, d).map_values(lambda v: v["amount"]).with_watermark(SIX_HOURS.grace_ms)
    table = log.group_by_key().window_by_time(SIX_HOURS).fold(FLOORED)
    df = table.suppress().df
    return drain(_windows(df.withColumn("value", F.col("value.floored"))))


PASSED = f"""l.ts <= (SELECT min(last) - INTERVAL '10 days' FROM (
  SELECT max(ts) AS last FROM ({VIEWS}) UNION ALL SELECT max(ts) FROM ({ACCOUNTS})))"""


@query("stream_as_of_late", AS_OF.format(how="", where=f"WHERE r.v IS NOT NULL AND {PASSED}"))
def stream_as_of_late(spark, d):
    """Views with the balance of their own time, though files come out of order."""
    log = arriving(spark, d, mixed=True).with_watermark(TEN_DAYS)
    updates = Log(log.df.where(F.col("topic").isin("purchase", "signup")), log.order).map_values(
        lambda v: F.when(v["event_type"] == "purchase", v["amount"]))
    views = typed(log, "view").map_values(lambda v: v["amount"])
    out = views.join(updates.to_table(), lambda a, b: a + b)
    return drain(out.df.select(F.col("key").alias("user_id"), F.col("offset").alias("event_id"),
                               as_double("value").alias("value")))


@query("stream_table_group_max", BAND_EXTREMES.format(fn="max"))
def stream_table_group_max(spark, d):
    """The largest balance of each band; the state holds all balances in it."""
    grouped = _table_of(arriving(spark, d)).group_by(lambda k, v: (F.floor(v / 20).cast("long"), v))
    return _changes(grouped.reduce(largest()).updates(), "band")


@query("stream_suppress_bounded", f"""
SELECT user_id, start, start + INTERVAL '6 hours' AS "end", CAST(sum(v) AS DOUBLE) AS value
FROM (SELECT *, {BUCKET} AS start FROM ({EVENTS})) GROUP BY user_id, start {CLOSED}""")
def stream_suppress_bounded(spark, d):
    """Final windows from one buffer per log partition, which may hold so much and no more."""
    log = arriving(spark, d).map_values(lambda v: v["amount"]).with_watermark(SIX_HOURS.grace_ms)
    table = log.group_by_key().window_by_time(SIX_HOURS).reduce(total())
    return drain(_windows(table.suppress(max_records=1_000_000, max_bytes=256 << 20).df))


@query("stream_new_topics", f"""
SELECT event_type AS topic, user_id AS key, event_id, CAST(v AS DOUBLE) AS value,
  CAST(user_id % 4 AS INTEGER) AS partition
FROM ({EVENTS}) WHERE regexp_full_match(event_type, 'pur.*|cl.*')""")
def stream_new_topics(spark, d):
    """A stream over a pattern of topics: some are there at its start, others come while it is stopped."""
    log = events_log(table(spark, d, "events")).map_values(lambda v: v["amount"])
    kinds = sorted(r.topic for r in log.df.select("topic").distinct().collect())
    root, out, place = (session.shared_folder(spark, n) for n in ("topics", "drained", "checkpoint"))
    like = Topic("any", "bigint", "decimal(12,2)", path=root, partitions=4, partition_fn=lambda k, v, n: k % n)
    for late in (False, True):
        for kind in kinds:
            if (kind != "purchase") == late:
                write_log(typed(log, kind), replace(like, name=kind, path=f"{root}/{kind}"))
        found = read_matching(spark, root, "pur.*|cl.*", like, streaming=True).df
        (found.writeStream.format("parquet").option("path", out).option("checkpointLocation", place)
         .trigger(availableNow=True).start().awaitTermination())
    rows = spark.read.schema(found.schema).parquet(out)
    return rows.select("topic", "key", F.col("offset").alias("event_id"), as_double("value").alias("value"), "partition")
