"""Counts, reductions, folds, regrouped tables."""

from decimal import Decimal

from pyspark.sql import functions as F

from tidelog.operators.reducers import Fold, largest, newest, smallest, total
from tidelog.plans.registry import (ACCOUNT_STATE, ACCOUNTS, EVENTS, accounts, amounts, as_double,
                                    query)

RUN = "OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)"


def updates(table):
    return table.updates().df.select(F.col("key").alias("user_id"),
                                     F.col("offset").alias("event_id"),
                                     as_double("value").alias("value"))


def state(table, key="user_id"):
    return table.snapshot().select(F.col("key").alias(key), as_double("value").alias("value"))


@query("count_snapshot", f"SELECT user_id, count(*) AS n FROM ({EVENTS}) GROUP BY user_id")
def count_snapshot(spark, d):
    return amounts(spark, d).group_by_key().count().snapshot().select(
        F.col("key").alias("user_id"), F.col("value").alias("n"))


@query("count_changelog", f"SELECT user_id, event_id, count(*) {RUN} AS n FROM ({EVENTS})")
def count_changelog(spark, d):
    return amounts(spark, d).group_by_key().count().updates().df.select(
        F.col("key").alias("user_id"), F.col("offset").alias("event_id"),
        F.col("value").alias("n"))


@query("count_by_type", f"SELECT event_type, count(*) AS n FROM ({EVENTS}) GROUP BY event_type")
def count_by_type(spark, d):
    """Five groups over all rows: what is shuffled is the partial counts."""
    from tidelog.plans.registry import events
    table = events(spark, d).group_by(lambda k, v: v["event_type"]).count()
    return table.snapshot().select(F.col("key").alias("event_type"), F.col("value").alias("n"))


@query("reduce_sum_snapshot", f"SELECT user_id, CAST(sum(v) AS DOUBLE) AS value FROM ({EVENTS}) GROUP BY user_id")
def reduce_sum_snapshot(spark, d):
    return state(amounts(spark, d).group_by_key().reduce(total()))


@query("reduce_sum_changelog", f"SELECT user_id, event_id, CAST(sum(v) {RUN} AS DOUBLE) AS value FROM ({EVENTS})")
def reduce_sum_changelog(spark, d):
    return updates(amounts(spark, d).group_by_key().reduce(total()))


@query("aggregate_init", f"""
SELECT user_id // 10 AS tens, CAST(sum(v) - 10 AS DOUBLE) AS value FROM ({EVENTS}) GROUP BY 1""")
def aggregate_init(spark, d):
    grouped = amounts(spark, d).group_by(lambda k, v: F.floor(k / 10))
    return state(grouped.aggregate(-10, total()), "tens")


@query("aggregate_init_changelog", f"""
SELECT user_id // 10 AS user_id, event_id, CAST(-10 + sum(v) OVER (PARTITION BY user_id // 10
  ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS value FROM ({EVENTS})""")
def aggregate_init_changelog(spark, d):
    grouped = amounts(spark, d).group_by(lambda k, v: F.floor(k / 10))
    return updates(grouped.aggregate(-10, total()))


@query("reduce_max_snapshot", f"SELECT user_id, CAST(max(v) AS DOUBLE) AS value FROM ({EVENTS}) GROUP BY user_id")
def reduce_max_snapshot(spark, d):
    return state(amounts(spark, d).group_by_key().reduce(largest()))


@query("reduce_last_snapshot", f"""
SELECT user_id, CAST(arg_max(v, (ts, event_id)) AS DOUBLE) AS value FROM ({EVENTS}) GROUP BY user_id""")
def reduce_last_snapshot(spark, d):
    return state(amounts(spark, d).group_by_key().reduce(newest()))


@query("diff_stream", f"""
SELECT user_id, event_id, CAST(v - lag(v) OVER (PARTITION BY user_id ORDER BY ts, event_id)
  AS DOUBLE) AS value FROM ({EVENTS})""")
def diff_stream(spark, d):
    return amounts(spark, d).group_by_key().diff().df.select(
        F.col("key").alias("user_id"), F.col("offset").alias("event_id"),
        as_double("value").alias("value"))


def _step(acc, key, value):
    """``floored`` never drops below nought; ``plain`` is the sum without that floor."""
    x = value - 50
    return {"plain": acc["plain"] + x, "floored": max(Decimal(0), acc["floored"] + x)}


def _merge(key, a, b):
    """Starting from a's balance, b ends where it would from nought, or higher."""
    return {"plain": a["plain"] + b["plain"],
            "floored": max(b["floored"], a["floored"] + b["plain"])}


FLOORED = Fold({"plain": Decimal(0), "floored": Decimal(0)}, _step,
               "struct<plain:decimal(20,2),floored:decimal(20,2)>", _merge)


def _balance(table):
    return table.map_values(lambda v: v["floored"])


FOLDED = f"""
SELECT user_id, event_id, ts, s - least(0, min(s) {RUN}) AS b FROM (
  SELECT user_id, event_id, ts, sum(v - 50) {RUN} AS s FROM ({EVENTS}))"""


@query("ordered_fold", f"SELECT user_id, event_id, CAST(b AS DOUBLE) AS value FROM ({FOLDED})")
def ordered_fold(spark, d):
    """A balance that never drops below nought: its value depends on record order."""
    return updates(_balance(amounts(spark, d).group_by_key().fold(FLOORED)))


@query("ordered_fold_snapshot", f"""
SELECT user_id, CAST(arg_max(b, (ts, event_id)) AS DOUBLE) AS value FROM ({FOLDED}) GROUP BY 1""")
def ordered_fold_snapshot(spark, d):
    return state(_balance(amounts(spark, d).group_by_key().fold(FLOORED)))


# -- tables regrouped -------------------------------------------------------------------

# An account belongs to the band its balance is in, so updates move it between bands.
BAND = "CAST(floor(v / 20) AS BIGINT)"
SIGNED = f"""
SELECT new_band AS band, v AS x, 1 AS sign, ts, event_id, 1 AS pos FROM (
  SELECT *, {BAND} AS new_band FROM ({ACCOUNTS})) WHERE v IS NOT NULL
UNION ALL
SELECT CAST(floor(ov / 20) AS BIGINT), ov, -1, ts, event_id, 0 FROM (
  SELECT *, lag(v) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS ov FROM ({ACCOUNTS}))
WHERE ov IS NOT NULL"""
BAND_RUN = "OVER (PARTITION BY band ORDER BY ts, event_id, pos ROWS UNBOUNDED PRECEDING)"


def _by_band(spark, d):
    return accounts(spark, d).group_by(lambda k, v: (F.floor(v / 20).cast("long"), v))


def _band_updates(table):
    log = table.updates()
    return log.df.select(F.col("key").alias("band"), F.col("offset").alias("event_id"),
                         as_double("value").alias("value"))


@query("table_group_count", f"SELECT band, CAST(sum(sign) AS DOUBLE) AS value FROM ({SIGNED}) GROUP BY band")
def table_group_count(spark, d):
    return state(_by_band(spark, d).count(), "band")


@query("table_group_sum", f"SELECT band, CAST(sum(sign * x) AS DOUBLE) AS value FROM ({SIGNED}) GROUP BY band")
def table_group_sum(spark, d):
    return state(_by_band(spark, d).reduce(total()), "band")


@query("table_group_max", f"SELECT {BAND} AS band, CAST(max(v) AS DOUBLE) AS value FROM ({ACCOUNT_STATE}) GROUP BY 1")
def table_group_max(spark, d):
    return state(_by_band(spark, d).reduce(largest()), "band")


# What is in a band after each change of it: versions that began by then and did not end.
BAND_EXTREMES = f"""
WITH versions AS (
  SELECT {BAND} AS band, v AS x, ts, event_id, to_ts, to_id FROM (
    SELECT *, lead(ts) OVER w AS to_ts, lead(event_id) OVER w AS to_id FROM ({ACCOUNTS})
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE v IS NOT NULL)
SELECT s.band, s.event_id, CAST({{fn}}(v.x) AS DOUBLE) AS value
FROM ({SIGNED}) s LEFT JOIN versions v ON v.band = s.band AND (v.ts, v.event_id, 1) <= (s.ts, s.event_id, s.pos)
  AND (v.to_ts IS NULL OR (v.to_ts, v.to_id, 0) > (s.ts, s.event_id, s.pos))
GROUP BY s.band, s.ts, s.event_id, s.pos"""


@query("table_group_max_changelog", BAND_EXTREMES.format(fn="max"))
def table_group_max_changelog(spark, d):
    """The largest balance of each band, also after the one that held it has left."""
    return _band_updates(_by_band(spark, d).reduce(largest()))


@query("table_group_min_changelog", BAND_EXTREMES.format(fn="min"))
def table_group_min_changelog(spark, d):
    return _band_updates(_by_band(spark, d).reduce(smallest()))


@query("table_group_count_changelog", f"""
SELECT band, event_id, CAST(sum(sign) {BAND_RUN} AS DOUBLE) AS value FROM ({SIGNED})""")
def table_group_count_changelog(spark, d):
    return _band_updates(_by_band(spark, d).count())


@query("table_group_sum_changelog", f"""
SELECT band, event_id, CAST(sum(sign * x) {BAND_RUN} AS DOUBLE) AS value FROM ({SIGNED})""")
def table_group_sum_changelog(spark, d):
    return _band_updates(_by_band(spark, d).reduce(total()))


@query("table_group_aggregate_changelog", f"""
SELECT band, event_id, CAST(100 + sum(sign * x) {BAND_RUN} AS DOUBLE) AS value FROM ({SIGNED})""")
def table_group_aggregate_changelog(spark, d):
    return _band_updates(_by_band(spark, d).aggregate(100, total()))
