"""Writing logs."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidelog import session
from tidelog.functions.partitioning import partition_of, serialized
from tidelog.operators.log import KEY, VALUE, Log
from tidelog.operators.timeline import Timeline
from tidelog.sources.topics import HEADERS, Topic, read_log


class ReadOnlyTopic(RuntimeError):
    """The topic was declared read-only."""


def placed(log: Log, topic: Topic) -> DataFrame:
    """Rows in the topic's schema, with the partition its partition function gives."""
    if topic.partition_fn:
        partition = topic.partition_fn(F.col(KEY), F.col(VALUE), topic.partitions)
    elif topic.partitions == 1:
        partition = F.lit(0)
    else:
        # records without a key are spread over all partitions
        spread = F.pmod(F.hash(*log.order), F.lit(topic.partitions))
        partition = F.coalesce(
            partition_of(F.col(KEY), log.key_type, topic.partitions), spread)
    df = log.df.withColumn("partition", partition.cast("int"))
    fill = {"headers": F.lit(None).cast(HEADERS), "timestamp_type": F.lit("CreateTime")}
    return df.withColumns({c: v for c, v in fill.items() if c not in df.columns})


def write_log(log: Log, topic: Topic, checkpoint: str | None = None) -> StreamingQuery | None:
    """Append to a topic, one directory per log partition.

    Records keep their order columns; offsets are given out by ``append_log``.
    A streaming log starts a query that drains what is there.
    """
    if not isinstance(topic, Topic):
        raise TypeError(f"a topic is needed, got {type(topic).__name__}")
    if topic.read_only:
        raise ReadOnlyTopic(f"topic {topic.name!r} is read-only")
    if topic.format == "kafka":
        return _write_kafka(log, topic, checkpoint)
    rows = typed_rows(placed(log, topic), topic)
    if log.streaming:
        place = checkpoint or session.shared_folder(rows.sparkSession, "checkpoint")
        return (rows.writeStream.format(topic.format).option("path", topic.path)
                .option("checkpointLocation", place).partitionBy("partition")
                .outputMode("append").trigger(availableNow=True).start())
    rows.write.mode("append").partitionBy("partition").format(topic.format).save(topic.path)
    return None


def typed_rows(df: DataFrame, topic: Topic) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in topic.schema])


def _write_kafka(log: Log, topic: Topic, checkpoint: str | None):
    rows = placed(log, topic).select(
        serialized(F.col(KEY), log.key_type).alias(KEY),
        serialized(F.col(VALUE), log.value_type).alias(VALUE), "headers", "partition")
    if log.streaming:
        place = checkpoint or session.shared_folder(rows.sparkSession, "checkpoint")
        return (rows.writeStream.format("kafka").options(**topic.options)
                .option("topic", topic.name).option("checkpointLocation", place)
                .trigger(availableNow=True).start())
    rows.write.format("kafka").options(**topic.options).option("topic", topic.name).save()
    return None


def write_through(log: Log, topic: Topic, checkpoint: str | None = None) -> Log:
    """Write to a topic and go on reading from it."""
    query = write_log(log, topic, checkpoint)
    if query is not None:
        query.awaitTermination()
    return read_log(log.df.sparkSession, topic)


def write_branches(log: Log, routes: Mapping[int, Topic]) -> None:
    """Write the records of ``Log.branch_ids`` to one topic per branch.

    The records are written once, laid out by branch, to the shared folder; each topic then takes
    the files of its branch.  Their past is computed once, whatever the number of topics; on a
    stream once per micro-batch.
    """
    def one(df: DataFrame) -> None:
        place = session.shared_folder(df.sparkSession, "branches")
        df.where(F.col("branch").isin(*routes)).write.partitionBy("branch").parquet(place)
        laid = df.sparkSession.read.schema(df.schema).parquet(place)
        for branch, topic in routes.items():
            write_log(Log(laid.where(F.col("branch") == branch).drop("branch"), log.order), topic)

    if not log.streaming:
        return one(log.df)
    place = session.shared_folder(log.df.sparkSession, "checkpoint")
    (log.df.writeStream.foreachBatch(lambda df, _id: one(df)).option("checkpointLocation", place)
     .trigger(availableNow=True).start().awaitTermination())


def append_log(log: Log, topic: Topic) -> DataFrame:
    """Append records, give each the next offset of its partition, return their metadata.

    A partition's records are numbered by a split running count, so one partition
    may take any number of them.
    """
    if topic.read_only:
        raise ReadOnlyTopic(f"topic {topic.name!r} is read-only")
    spark = log.df.sparkSession
    line = Timeline.of(placed(log, topic), ("partition",), log.order).running("__n", "count", F.lit(1))
    numbered = line.frame
    last = _last_offsets(spark, topic)
    if last is not None:
        # at most ``topic.partitions`` rows
        numbered = numbered.join(F.broadcast(last), "partition", "left")
    else:
        numbered = numbered.withColumn("__last", F.lit(None).cast("long"))
    offset = F.coalesce(F.col("__last"), F.lit(-1).cast("long")) + F.col("__n")
    rows = session.pinned(typed_rows(numbered.withColumn("offset", offset), topic))
    rows.write.mode("append").partitionBy("partition").format(topic.format).save(topic.path)
    return rows.select(F.lit(topic.name).alias("topic"), "partition", "offset", "ts")


def _last_offsets(spark, topic: Topic) -> DataFrame | None:
    try:
        df = read_log(spark, topic).df
        if not df.inputFiles():
            return None
    except Exception as gone:  # nothing was written yet
        if getattr(gone, "getCondition", str)() == "PATH_NOT_FOUND":
            return None
        raise
    return df.groupBy("partition").agg(F.max("offset").alias("__last"))


def for_each_batch(log: Log, action: Callable[[DataFrame], None], checkpoint: str | None = None):
    """Call ``action(frame)`` on the whole log, or on every micro-batch of a stream."""
    if not log.streaming:
        return action(log.df)
    place = checkpoint or session.shared_folder(log.df.sparkSession, "checkpoint")
    return (log.df.writeStream.foreachBatch(lambda df, _id: action(df))
            .option("checkpointLocation", place).trigger(availableNow=True).start())


def write_as_text(log: Log, path: str) -> None:
    """One line per record: ``key, value``."""
    as_text = lambda c, t: (
        F.to_json(c) if isinstance(t, (T.StructType, T.ArrayType, T.MapType)) else c.cast("string"))
    line = F.concat_ws(", ", as_text(F.col(KEY), log.key_type), as_text(F.col(VALUE),
                                                                        log.value_type))
    log.df.select(line.alias("value")).write.mode("append").text(path)
