"""Slices of hot keys hold about equally many rows, however the rows lie in time."""

import pytest
from pyspark.sql import functions as F

from tidelog import session
from tidelog.operators.timeline import SLICE, Timeline, split

ROWS = 1_000


def _times(spark, kind):
    n = F.col("id")
    second = {
        "one clock is decades off": F.when(n == 0, F.lit(0)).otherwise(n + 1_700_000_000),
        "a burst": F.when(n < 50, n * 86_400).otherwise(4_400_000 + n / 1_000),
        "even": n,
    }[kind]
    return spark.range(ROWS).select(F.lit(7).alias("key"), n.alias("offset"),
                                    F.timestamp_micros((second * 1_000_000).cast("long")).alias("ts"))


@pytest.mark.parametrize("kind", ["one clock is decades off", "a burst", "even"])
def test_equal_depth(spark, monkeypatch, kind):
    monkeypatch.setattr(session, "ROWS_PER_TASK", 100)
    monkeypatch.setattr(session, "ROWS_PER_SLICE", 50)
    cold, cut = split(_times(spark, kind), ["key"], ["ts", "offset"])
    sizes = [r["count"] for r in cut.groupBy(SLICE).count().collect()]
    assert cold.count() == 0 and sum(sizes) == ROWS
    assert len(sizes) == ROWS // 50 and max(sizes) <= 2 * ROWS / len(sizes)


def test_ties_and_missing_times(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_TASK", 10)
    monkeypatch.setattr(session, "ROWS_PER_SLICE", 5)
    n = F.col("id")
    ts = F.when(n % 3 == 0, F.lit(None)).when(n % 3 == 1, F.lit(5)).otherwise(n)
    df = spark.range(60).select(F.lit(None).cast("int").alias("key"), n.alias("offset"),
                                F.timestamp_seconds(ts).alias("ts"))
    line = Timeline.of(df, ["key"], ["ts", "offset"]).running("n", "count", F.lit(1)).frame
    rows = line.orderBy("ts", "offset").collect()
    assert [r["n"] for r in rows] == list(range(1, 61))
    # rows of one time stay together
    cut = split(df, ["key"], ["ts", "offset"])[1]
    assert cut.groupBy("ts").agg(F.count_distinct(SLICE).alias("n")).agg(F.max("n")).first()[0] == 1


def test_ordinary_keys_are_not_cut(spark):
    cold, cut = split(_times(spark, "even"), ["key"], ["ts", "offset"])
    assert cold.count() == ROWS and cut.count() == 0
