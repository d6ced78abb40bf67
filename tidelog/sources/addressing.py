"""Finding places in a log: offsets, times, partitions.

A log here is a frame with topic, partition, offset and ts.  Every answer is one
partially aggregated pass that reads those columns only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.operators.log import Log, need_type
from tidelog.operators.timeline import Timeline, number_of

SHARD = ("topic", "partition")


def count_messages(log: Log, dense: bool = False) -> DataFrame:
    """Records per topic; ``dense`` trusts offsets to be gapless and subtracts them."""
    if not dense:
        return log.df.groupBy("topic").agg(F.count(F.lit(1)).alias("messages"))
    spans = log.df.groupBy(*SHARD).agg((F.max("offset") - F.min("offset") + 1).alias("n"))
    return spans.groupBy("topic").agg(F.sum("n").alias("messages"))


def partitions_of(log: Log) -> DataFrame:
    """The partition ids and their number, per topic."""
    shards = log.df.select(*SHARD).distinct()
    return shards.groupBy("topic").agg(F.sort_array(F.collect_list("partition")).alias(
        "partitions"), F.count(F.lit(1)).alias("num_partitions"))


def offsets(log: Log) -> DataFrame:
    """Begin offset and end offset (one past the last) of every partition."""
    return log.df.groupBy(*SHARD).agg(F.min("offset").alias("begin_offset"),
                                      (F.max("offset") + 1).alias("end_offset"))


def describe(log: Log) -> DataFrame:
    return log.df.groupBy(*SHARD).agg(
        F.count(F.lit(1)).alias("messages"), F.min("offset").alias("begin_offset"),
        (F.max("offset") + 1).alias("end_offset"), F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"))


def offsets_for_times(log: Log, times: DataFrame) -> DataFrame:
    """The first offset at or after a time, per requested (topic, partition, at).

    ``offset`` is null when the partition has nothing that late.  Requests come
    as a table with one row per shard, so the log is aggregated, not collected.
    """
    # Requests and log records as one sequence per shard, latest first: what a request asks for is
    # the lowest offset among the records at or after it, a running minimum that any shard may split.
    asked = times.select(*SHARD, "at").distinct()
    records = log.df.where(F.col("ts").isNotNull()).groupBy(*SHARD, F.col("ts").alias("at")).agg(F.min("offset").alias("offset"))
    both = records.withColumn("__ask", F.lit(0)).unionByName(
        asked.withColumn("__ask", F.lit(1)), allowMissingColumns=True)
    # backwards in time, records before the requests of the same time
    both = both.withColumn("__back", -number_of(both, "at"))
    line = Timeline.of(both, SHARD, ("__back", "__ask"))
    line = line.running("__first", "min", F.col("offset"))
    first = line.frame.where("__ask = 1").select(*SHARD, "at", F.col("__first").alias("offset"))
    return times.select(*SHARD, "at").join(first, [*SHARD, "at"], "left")


def start_offsets(log: Log, at: Column, past_end: str = "end") -> DataFrame:
    """Where each partition has to be read from to see everything since ``at``.

    A partition without anything that late starts at its end, or one past it.
    """
    if past_end not in ("end", "end_plus_one"):
        raise ValueError("past_end must be 'end' or 'end_plus_one'")
    end = F.max("offset") + (1 if past_end == "end" else 2)
    first = F.min(F.when(F.col("ts") >= at, F.col("offset")))
    return log.df.groupBy(*SHARD).agg(F.coalesce(first, end).alias("offset"))


def seek(log: Log, starts: DataFrame) -> Log:
    """Read every shard from its start offset; shards without one are left out."""
    need_type(starts, DataFrame, "starts")
    at = starts.select(*SHARD, F.col("offset").alias("__start"))
    found = log.df.join(at, list(SHARD)).where(F.col("offset") >= F.col("__start"))
    return Log(found.drop("__start"), log.order)


def seek_to_timestamp(log: Log, at: Column, past_end: str = "end") -> Log:
    return seek(log, start_offsets(log, at, past_end))


def seek_to_end(log: Log) -> DataFrame:
    return offsets(log).select(*SHARD, F.col("end_offset").alias("offset"))


def seek_to_beginning(log: Log) -> DataFrame:
    return offsets(log).select(*SHARD, F.col("begin_offset").alias("offset"))


def until(log: Log, end_at: Column) -> Log:
    """A bounded read: everything before a time."""
    return Log(log.df.where(F.col("ts") < end_at), log.order)
