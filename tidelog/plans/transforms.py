"""Stateful transforms on batch input."""

from decimal import Decimal

from pyspark.sql import functions as F

from tidelog.operators.log import Log
from tidelog.operators.stateful import Store
from tidelog.plans.registry import EVENTS, amounts, as_double, events, query

RUN = "OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)"


def _both(before, after):
    """Two totals make their sum, so a hot user's records may be split."""
    return after if before is None else before if after is None else before + after


TOTAL = [Store("total", "decimal(20,2)", _both)]
MONEY = "decimal(20,2)"


def _added(ctx, value):
    cell = ctx.store("total")
    cell.put((cell.get() or Decimal(0)) + value)
    return cell.get()


def _out(log):
    return log.df.select(F.col("key").alias("key"), F.col("offset").alias("event_id"),
                         F.col(log.order[-1]).alias("pos"), as_double("value").alias("value"))


@query("transform", f"""
SELECT user_id * 2 AS key, event_id, 0 AS pos, CAST(sum(v) {RUN} AS DOUBLE) AS value
FROM ({EVENTS})""")
def transform(spark, d):
    return _out(amounts(spark, d).transform(
        lambda ctx, k, v: (k * 2, _added(ctx, v)), "long", MONEY, TOTAL))


@query("flat_transform", f"""
SELECT user_id * unnest([10, 20]) AS key, event_id, unnest([0, 1]) AS pos,
  CAST(2 * s - unnest([v, 0]) AS DOUBLE) AS value
FROM (SELECT *, sum(v) {RUN} AS s FROM ({EVENTS}))""")
def flat_transform(spark, d):
    return _out(amounts(spark, d).flat_transform(
        lambda ctx, k, v: [(k * n, _added(ctx, v)) for n in (10, 20)], "long", MONEY, TOTAL))


@query("transform_values", f"""
SELECT user_id AS key, event_id, 0 AS pos, CAST(sum(v) {RUN} AS DOUBLE) AS value FROM ({EVENTS})""")
def transform_values(spark, d):
    return _out(amounts(spark, d).transform_values(_added, MONEY, TOTAL))


@query("flat_transform_values", f"""
SELECT user_id AS key, event_id, unnest([0, 1]) AS pos,
  CAST(2 * s - unnest([v, 0]) + unnest([100, 200]) AS DOUBLE) AS value
FROM (SELECT *, sum(v) {RUN} AS s FROM ({EVENTS}))""")
def flat_transform_values(spark, d):
    return _out(amounts(spark, d).flat_transform_values(
        lambda ctx, v: [_added(ctx, v) + n for n in (100, 200)], MONEY, TOTAL))


@query("state_store_sum", f"""
SELECT user_id AS key, CAST(sum(v) AS DOUBLE) AS value FROM ({EVENTS}) GROUP BY user_id""")
def state_store_sum(spark, d):
    """A named store holding a struct per key; the last output of a key is its total."""
    def step(ctx, key, value):
        store = ctx.store("sums")
        now = store.get()
        store.put({"value": value if now is None else now["value"] + value})
        return key, store.get()

    def merge(a, b):
        return b if a is None else a if b is None else {"value": a["value"] + b["value"]}

    log = amounts(spark, d).transform(step, "long", "struct<value:decimal(20,2)>",
                                      [Store("sums", "struct<value:decimal(20,2)>", merge)])
    return log.to_table().map_values(lambda v: v["value"]).snapshot().select(
        "key", as_double("value").alias("value"))


@query("value_context", f"""
SELECT user_id AS key, event_id, 0 AS pos, CAST(v + 1 AS DOUBLE) AS value, event_type AS topic
FROM ({EVENTS})""")
def value_context(spark, d):
    """A step may read the record's metadata."""
    log = events(spark, d)
    log = log.map_values(lambda v: F.struct(v["amount"].alias("val"), F.col("topic").alias("t")))
    out = log.transform_values(lambda ctx, v: {"new_val": v["val"] + 1, "topic": ctx.topic},
                               "struct<new_val:decimal(20,2),topic:string>")
    return out.df.select("key", F.col("offset").alias("event_id"), F.col(out.order[-1]).alias(
        "pos"), as_double("value.new_val").alias("value"), "value.topic")


@query("process_counts", f"""
SELECT user_id AS key, count(*) AS n FROM ({EVENTS}) WHERE v > 50 GROUP BY user_id""")
def process_counts(spark, d):
    """A step without output of its own per record: the last count of a key is kept."""
    def step(ctx, key, value):
        cell = ctx.store("n")
        if value > 50:
            cell.put((cell.get() or 0) + 1)
            return key, cell.get()
        return None

    log: Log = amounts(spark, d).transform(step, "long", "long", [Store("n", "long", _both)])
    return log.to_table().snapshot().select("key", F.col("value").alias("n"))


@query("process_effects", f"""
SELECT CAST(sum(n) AS BIGINT) AS records, CAST(sum(n // 3) AS BIGINT) AS thirds FROM (
  SELECT user_id, count(*) AS n FROM ({EVENTS}) WHERE v > 50 GROUP BY user_id)""")
def process_effects(spark, d):
    """A step run for its effects only: every third large amount of a user is told to the driver."""
    context = spark.sparkContext
    records, thirds = context.accumulator(0), context.accumulator(0)

    def step(ctx, key, value):
        cell = ctx.store("n")
        cell.put((cell.get() or 0) + 1)
        records.add(1)
        if cell.get() % 3 == 0:
            thirds.add(1)

    amounts(spark, d).filter(lambda k, v: v > 50).process(step, [Store("n", "long")])
    return spark.createDataFrame([(records.value, thirds.value)], "records long, thirds long")
