"""Time windows, sessions, late records, suppression."""

from pyspark.sql import functions as F

from tidelog.operators import windows as W
from tidelog.operators.log import Log
from tidelog.operators.reducers import total
from tidelog.plans.registry import EVENTS, amounts, as_double, query

HOUR, MINUTE = 3_600_000, 60_000
# The stream time at which each log partition ended.
ENDS = f"SELECT part, max(ts) AS now FROM ({EVENTS}) GROUP BY part"
BUCKET = "time_bucket(INTERVAL '6 hours', ts)"
SIX_HOURS = W.TimeWindows(6 * HOUR, grace_ms=HOUR)
SESSIONS = W.SessionWindows(6 * HOUR, grace_ms=0)


def windowed(df, value="value", *more):
    return df.select(F.col("key").alias("user_id"), F.col("window.start").alias("start"),
                     F.col("window.end").alias("end"), as_double("value").alias(value), *more)


@query("tumbling_count", f"""
SELECT user_id, {BUCKET} AS start, {BUCKET} + INTERVAL '6 hours' AS "end",
       CAST(count(*) AS DOUBLE) AS value FROM ({EVENTS}) GROUP BY user_id, {BUCKET}""")
def tumbling_count(spark, d):
    return windowed(amounts(spark, d).group_by_key().window_by_time(SIX_HOURS).count().snapshot())


@query("tumbling_sum_changelog", f"""
SELECT user_id, start, start + INTERVAL '6 hours' AS "end", event_id,
  CAST(sum(v) OVER (PARTITION BY user_id, start ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
       AS DOUBLE) AS value
FROM (SELECT *, {BUCKET} AS start FROM ({EVENTS}))""")
def tumbling_sum_changelog(spark, d):
    table = amounts(spark, d).group_by_key().window_by_time(SIX_HOURS).reduce(total())
    return windowed(table.updates().df, "value", F.col("offset").alias("event_id"))


@query("hopping_sum", f"""
SELECT user_id, start, start + INTERVAL '6 hours' AS "end", CAST(sum(v) AS DOUBLE) AS value
FROM (SELECT *, time_bucket(INTERVAL '2 hours', ts) - to_hours(unnest([0, 2, 4])) AS start
      FROM ({EVENTS})) GROUP BY user_id, start""")
def hopping_sum(spark, d):
    hopping = W.TimeWindows(6 * HOUR, 2 * HOUR, 0)
    grouped = amounts(spark, d).group_by_key().window_by_time(hopping)
    return windowed(grouped.reduce(total()).snapshot())


ISLANDS = f"""
SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s
FROM (SELECT *, CASE WHEN last_ts IS NULL OR ts - last_ts > INTERVAL '6 hours' THEN 1 ELSE 0 END
        AS fresh
      FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS last_ts
            FROM ({EVENTS})))"""


@query("session_agg", f"""
SELECT user_id, min(ts) AS start, max(ts) AS "end", CAST(sum(v) AS DOUBLE) AS value
FROM ({ISLANDS}) GROUP BY user_id, s""")
def session_agg(spark, d):
    return windowed(amounts(spark, d).group_by_key().window_by_session(SESSIONS)
                    .reduce(total()).snapshot())


@query("session_count", f"""
SELECT user_id, min(ts) AS start, max(ts) AS "end", CAST(count(*) AS DOUBLE) AS value
FROM ({ISLANDS}) GROUP BY user_id, s""")
def session_count(spark, d):
    return windowed(amounts(spark, d).group_by_key().window_by_session(SESSIONS)
                    .count().snapshot())


SESSION_CHANGES = f"""
SELECT user_id, start, ts AS "end", event_id, CAST(run AS DOUBLE) AS value FROM (
  SELECT *, min(ts) OVER w AS start, sum(v) OVER w AS run FROM ({ISLANDS})
  WINDOW w AS (PARTITION BY user_id, s ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))
UNION ALL
SELECT user_id, start, last_ts, event_id, NULL FROM (
  SELECT *, min(ts) OVER (PARTITION BY user_id, s ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
    AS start FROM ({ISLANDS})) WHERE fresh = 0 AND start < ts"""


@query("session_changelog", SESSION_CHANGES)
def session_changelog(spark, d):
    table = amounts(spark, d).group_by_key().window_by_session(SESSIONS).reduce(total())
    return windowed(table.updates().df, "value", F.col("offset").alias("event_id"))


# Records arrive out of order: blocks of sixteen are shuffled.
ARRIVAL = "event_id - event_id % 16 + (event_id % 16 * 7) % 16"
TEN_MINUTES = W.TimeWindows(10 * MINUTE, grace_ms=10 * MINUTE)


ARRIVED = f"""
SELECT *, start + INTERVAL '20 minutes' <= stream_time AS late FROM (
  SELECT *, time_bucket(INTERVAL '10 minutes', ts) AS start, max(ts) OVER (
    PARTITION BY part ORDER BY arrival ROWS UNBOUNDED PRECEDING) AS stream_time
  FROM (SELECT *, {ARRIVAL} AS arrival FROM ({EVENTS})))"""


def shuffled(spark, d):
    log = amounts(spark, d)
    return Log(log.df.withColumn("event_id", F.col("offset")).withColumn(
        "offset", F.expr(ARRIVAL)), log.order)


@query("late_split", f"SELECT user_id, event_id, late FROM ({ARRIVED})")
def late_split(spark, d):
    return W.with_lateness(shuffled(spark, d), TEN_MINUTES).df.select(
        F.col("key").alias("user_id"), "event_id", "late")


TUMBLING_LATE = """
SELECT user_id, start, start + INTERVAL '10 minutes' AS "end", CAST(sum(v) AS DOUBLE) AS value
FROM ({rows}) WHERE NOT late GROUP BY user_id, start"""


@query("tumbling_late", TUMBLING_LATE.format(rows=ARRIVED))
def tumbling_late(spark, d):
    """Windows do not take records that come after they closed."""
    grouped = shuffled(spark, d).group_by_key().window_by_time(TEN_MINUTES)
    return windowed(grouped.reduce(total()).snapshot())


@query("suppress_late", TUMBLING_LATE.format(rows=f"SELECT * FROM ({ARRIVED}) JOIN ({ENDS}) USING (part)")
       + ", now HAVING start + INTERVAL '20 minutes' <= now")
def suppress_late(spark, d):
    grouped = shuffled(spark, d).group_by_key().window_by_time(TEN_MINUTES)
    return windowed(grouped.reduce(total()).suppress().df)


@query("without_window", f"""
SELECT user_id, event_id, CAST(sum(v) OVER (PARTITION BY user_id, start ORDER BY ts, event_id
  ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS value
FROM (SELECT *, {BUCKET} AS start FROM ({EVENTS}))""")
def without_window(spark, d):
    """Updates of a windowed sum under their plain key."""
    table = amounts(spark, d).group_by_key().window_by_time(SIX_HOURS).reduce(total())
    return table.updates().without_window().df.select(
        F.col("key").alias("user_id"), F.col("offset").alias("event_id"),
        as_double("value").alias("value"))


@query("suppress_closed", f"""
SELECT user_id, start, start + INTERVAL '6 hours' AS "end", CAST(sum(v) AS DOUBLE) AS value
FROM (SELECT *, {BUCKET} AS start FROM ({EVENTS})) JOIN ({ENDS}) USING (part)
GROUP BY user_id, start, now HAVING start + INTERVAL '7 hours' <= now""")
def suppress_closed(spark, d):
    table = amounts(spark, d).group_by_key().window_by_time(SIX_HOURS).reduce(total())
    return windowed(table.suppress().df)


@query("suppress_sessions", f"""
SELECT user_id, min(ts) AS start, max(ts) AS "end", CAST(sum(v) AS DOUBLE) AS value
FROM ({ISLANDS}) JOIN ({ENDS}) USING (part) GROUP BY user_id, s, now
HAVING max(ts) + INTERVAL '6 hours' <= now""")
def suppress_sessions(spark, d):
    table = amounts(spark, d).group_by_key().window_by_session(SESSIONS).reduce(total())
    return windowed(table.suppress().df)


TIME_LIMITED = f"""
WITH RECURSIVE numbered AS (
  SELECT user_id, event_id, ts, v, row_number() OVER (ORDER BY ts, event_id) AS n FROM ({EVENTS})),
ticks AS (SELECT ts, min(n) AS n FROM numbered GROUP BY ts),
held AS (
  SELECT a.user_id, a.event_id, a.v, a.n, t.n AS ends
  FROM (SELECT *, ts + INTERVAL '12 hours' AS due FROM numbered) a
  ASOF LEFT JOIN ticks t ON a.due <= t.ts),
links AS (
  SELECT h.user_id, h.n, h.ends, x.n AS next
  FROM held h ASOF LEFT JOIN held x ON h.user_id = x.user_id AND h.ends < x.n),
chain AS (
  SELECT l.user_id, l.n, l.ends, l.next FROM links l
  JOIN (SELECT user_id, min(n) AS n FROM links GROUP BY user_id) f USING (user_id, n)
  UNION ALL
  SELECT l.user_id, l.n, l.ends, l.next FROM chain c JOIN links l ON l.n = c.next),
let_out AS (
  SELECT c.user_id, c.ends, max(h.n) AS n FROM chain c
  JOIN held h ON h.user_id = c.user_id AND h.n BETWEEN c.n AND c.ends
  WHERE c.ends IS NOT NULL GROUP BY c.user_id, c.ends)
SELECT h.user_id, h.event_id, CAST(h.v AS DOUBLE) AS value
FROM let_out o JOIN held h USING (user_id, n)"""


@query("suppress_time_limit", TIME_LIMITED)
def suppress_time_limit(spark, d):
    """At most one update per user and twelve hours."""
    held = amounts(spark, d).to_table().suppress(until_time_limit_ms=12 * HOUR)
    return held.df.select(F.col("key").alias("user_id"), F.col("offset").alias("event_id"),
                          as_double("value").alias("value"))
