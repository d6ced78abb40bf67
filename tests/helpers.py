"""Small logs for tests."""

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators.log import Log

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def at(ms):
    return EPOCH + timedelta(milliseconds=ms)


def log_of(spark, records, key=T.LongType(), value=T.LongType(), first_offset=0):
    """Records are (key, value), timed by their place, or (ms, key, value)."""
    rows = [(i + first_offset, *r) if len(r) == 2 else r for i, r in enumerate(records)]
    schema = T.StructType([T.StructField("ms", T.LongType()), T.StructField("offset", T.LongType()),
                           T.StructField("key", key), T.StructField("value", value)])
    df = spark.createDataFrame([(ms, i + first_offset, k, v) for i, (ms, k, v) in enumerate(rows)],
                               schema)
    df = df.select("key", "value", F.timestamp_millis("ms").alias("ts"), "offset",
                   F.lit(0).alias("partition"), F.lit("in").alias("topic"))
    return Log(df)


def two_logs(spark, records, **types):
    """Records are ('L' or 'R', key, value) or ('L' or 'R', ms, key, value), as they arrive."""
    sides = {"L": [], "R": []}
    for i, (side, *r) in enumerate(records):
        sides[side].append((r[0] if len(r) == 3 else i, i, *r[-2:]))
    out = []
    for side in "LR":
        schema = "ms long, offset long, key long, value long"
        df = spark.createDataFrame(sides[side], schema)
        out.append(Log(df.select("key", "value", F.timestamp_millis("ms").alias("ts"), "offset")))
    return out


def keyvals(log):
    """The records of a log, in order, as (key, value)."""
    rows = log.df.orderBy(*log.order).select("key", "value").collect()
    return [(r["key"], r["value"].asDict() if hasattr(r["value"], "asDict") else r["value"])
            for r in rows]


def state(df):
    return {r["key"]: r["value"] for r in df.collect()}


def last_of(log):
    """Last value per key of a changelog, without deleted keys."""
    return {k: v for k, v in dict(keyvals(log)).items() if v is not None}


def safe_add(a, b):
    return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
